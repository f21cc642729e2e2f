"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece there is exactly one last token of its encoding. A
token that ends at the prefix (found by a suffix automaton over all tokens) is that
token if and only if it is compatible with the last token of the prefix before it: the merge
rules must not join anything across the border of the two before both are complete.
Following the stored tokens from the end of the piece back to its start gives the ids. No merge is
ever simulated, and the time is linear in the piece for tokens of bounded length.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import map_rows, need, sha256

# The pattern by which byte-level BPE files of this kind split text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_PIECES = 300_000  # pieces a task remembers; then it starts anew, so memory is bounded
CACHE_PAIRS = 300_000  # compatibility answers it remembers likewise
CACHE_CHARS = 64  # longer pieces are rare and not remembered


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files of byte-level BPE."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A vocabulary file of the tokenizers library: byte-level BPE without normalizer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        if pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("dropout"):
            raise ValueError(f"{path}: options that are not supported")
        letters = byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        vocab = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        singles = [t for t in vocab if len(t) == 1]
        # Inside, tokens are numbered by the order in which merges make them.
        order = {t: i for i, t in enumerate(singles)}
        left, right = list(range(len(singles))), list(range(len(singles)))
        self._pairs: dict[tuple[int, int], int] = {}
        for a, b in merges:
            made = order.setdefault(a + b, len(order))
            if made == len(left):
                left.append(order[a])
                right.append(order[b])
            self._pairs.setdefault((order[a], order[b]), made)
        self._left, self._right = left, right
        self._ids = [vocab[t] for t in order]
        self._bytes = [raw(t) for t in order]
        self._compatible: dict[int, bool] = {}
        self._automaton = ahocorasick.Automaton()
        for number, data in enumerate(self._bytes):
            self._automaton.add_word(data.decode("latin-1"), (number, len(data)))
        self._automaton.make_automaton()
        size = max([*vocab.values(), *[t["id"] for t in spec["added_tokens"]]]) + 1
        self.table: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.table[i] = raw(t)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens with stripping are not supported")
        for t, i in self.special.items():
            self.table[i] = t.encode()
        longest = sorted(self.special, key=len, reverse=True)
        self._split = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self._find = regex.compile(PIECES).findall
        self._pieces: dict[str, bytes] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Do tokens a and b stay apart when their joined text is encoded?

        Undo the later of the two tokens step by step. A merge across the border that has a lower rank
        than the step undone last would have come first and joined them.
        """
        pairs, limit = self._pairs, 1 << 60
        left, right = self._left, self._right
        while True:
            joined = pairs.get((a, b))
            if joined is not None and joined < limit:
                return False
            if a > b:
                limit, a = a, right[a]
                if a == limit:  # a single byte: undo the right one instead
                    limit = b + 1
                    if left[b] == b:
                        return True
                    b = left[b]
            else:
                limit = b + 1
                if left[b] == b:
                    limit = a
                    if right[a] == a:
                        return True
                    a = right[a]
                else:
                    b = left[b]

    def piece_ids(self, data: bytes) -> list[int]:
        """Ids of one piece of split text."""
        n = len(data)
        last = [-1] * (n + 1)
        start = [0] * (n + 1)
        known = self._compatible
        if len(known) > CACHE_PAIRS:
            known.clear()
        for end, (number, length) in self._automaton.iter(data.decode("latin-1")):
            end += 1
            if last[end] < 0:
                before = end - length
                if before:
                    previous = last[before]
                    if previous < 0:
                        continue
                    pair = previous << 32 | number
                    fits = known.get(pair)
                    if fits is None:
                        known[pair] = fits = self.compatible(previous, number)
                    if not fits:
                        continue
                last[end], start[end] = number, before
        out, at = [], n
        while at:
            out.append(self._ids[last[at]])
            at = start[at]
        return out[::-1]

    def _packed(self, piece: str) -> bytes:
        packed = np.array(self.piece_ids(piece.encode("utf-8")), dtype="<u4").tobytes()
        if len(piece) <= CACHE_CHARS:
            if len(self._pieces) >= CACHE_PIECES:
                self._pieces.clear()
            self._pieces[piece] = packed
        return packed

    def _plain(self, text: str) -> bytes:
        """Ids of text without special tokens."""
        known, packed = self._pieces.get, self._packed
        return b"".join([known(p) or packed(p) for p in self._find(text)])

    def encode_packed(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        if self._split is None or not any(t in text for t in self.special):
            return self._plain(text)
        return b"".join(
            np.array([self.special[part]], dtype="<u4").tobytes() if part in self.special else self._plain(part)
            for part in self._split.split(text)
        )

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """One tokenizer per worker process."""
    return ByteBpe(path)


ENCODED = StructType([
    StructField("doc_id", LongType()), StructField("n_tokens", LongType()),
    StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
])


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``ids`` (array of int) and ``decoded`` text.

    A NULL text is an empty one and has no ids; NULL and repeated ids keep their rows; an empty table
    gives an empty one; other columns are ignored.
    """
    key = docs.schema[id_col].dataType

    def make() -> Callable[..., Iterator[tuple]]:
        bpe = load(path)

        def one(row_id: object, text: str | None) -> Iterator[tuple]:
            ids = bpe.encode(text or "")
            yield row_id, ids, bpe.decode(ids)

        return one

    schema = StructType().add("id", key).add("ids", ArrayType(LongType())).add("decoded", "string")
    return map_rows(need(docs, id_col, text_col), schema, make)


def encoding_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number of ids, and digests of the ids and of the text decoded from them.

    The same encoder and decoder as in ``encode_documents``; only digests leave the worker.
    """

    def make() -> Callable[..., Iterator[tuple]]:
        bpe = load(path)

        def one(row_id: int | None, text: str | None) -> Iterator[tuple]:
            packed = bpe.encode_packed(text or "")
            decoded = bpe.decode(np.frombuffer(packed, dtype="<u4").tolist())
            yield row_id, len(packed) // 4, sha256(packed), sha256(decoded.encode("utf-8"))

        return one

    schema = ENCODED
    return map_rows(need(docs, id_col, text_col), schema, make)
