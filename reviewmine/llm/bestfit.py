"""Packing whole documents into few sequences: combinations that fill a gap exactly, then best fit.

Only documents longer than a sequence are cut. The lengths of all pieces form a histogram of at most ``size`` entries
whatever the corpus; over its lengths the sums of single lengths, pairs and triples are indexed. From the
longest length on, the gap that a piece leaves is looked up: a single, pair or triple of just that sum is
consumed as often as the counts of all its members allow. The residual lengths are placed by best fit,
longest first, all pieces of a length together. Pieces are ranked within their length and ranks are dealt to
sequences by intervals, so a piece's place follows from its rank alone.

Ids come from the vocabulary's own library, whose model is asked once per distinct word; texts with signs beyond
the ranges for which words are cut here go to the library whole.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from .bpe import byte_letters
from .common import map_rows, need, stored

SIZE = 2048
KNOWN_WORDS = 400_000  # distinct words whose ids a worker keeps, some 80 MB
KNOWN_CHARS = 64  # longer words are encoded each time

PIECE = StructType([
    StructField("doc_id", LongType()), StructField("piece", IntegerType()), StructField("start", LongType()),
    StructField("length", LongType()), StructField("ids_crc32", LongType()), StructField("part", IntegerType()),
    StructField("nth", LongType()),
])

# Signs whose words are cut here. Fixed by the vocabulary file: lower case, blanks dropped; runs of letters, single
# digits, English endings, runs of other signs. Letters and digits of Latin script up to U+017F.
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_DIGIT = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_BLANK = "\\t-\\r \u0085\u00a0"
WORDS = re.compile(f"[{_LETTER}]+|[{_DIGIT}]|'s|'t|'re|'ve|'m|'ll|'d|[^{_BLANK}{_LETTER}{_DIGIT}]+")
STRANGE = re.compile("[^\u0000-\u012f\u0131-\u017f\u2010-\u2027\u20ac]")


class WordEncoder(dict):
    """Ids of texts as little-endian unsigned 32-bit integers; the dictionary maps words to theirs."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model = self.library.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}

    def _ask(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        symbols = word.encode().decode("latin-1").translate(self.letters)
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(symbols)])
        if len(word) <= KNOWN_CHARS:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if STRANGE.search(text) or any(s in text for s in self.special):
            return self._ask(text)
        return b"".join(map(self.__getitem__, WORDS.findall(text.lower())))


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> WordEncoder:
    """One encoder a worker: its words, KNOWN_WORDS at most, serve the worker's later tasks as well."""
    return WordEncoder(path)


def cut_documents(
    docs: DataFrame, path: str, size: int = SIZE, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents; ``part`` and ``nth`` number equal lengths within their task."""
    end = int(end_id).to_bytes(4, "little")

    def make() -> Callable[..., Iterator[tuple]]:
        encoder = worker_encoder(path)
        part = TaskContext.get().partitionId()
        seen = [0] * (size + 1)

        def one(doc_id: int | None, text: str | None) -> Iterator[tuple]:
            ids = encoder.encode(text or "") + end
            for piece, at in enumerate(range(0, len(ids), 4 * size)):
                own = ids[at:at + 4 * size]
                n = len(own) // 4
                yield doc_id, piece, at // 4, n, zlib.crc32(own), part, seen[n]
                seen[n] += 1

        return one

    return map_rows(need(docs, id_col, text_col), PIECE, make)


class Sums:
    """Sums of one, two and three of the given lengths; pairs and triples start with their longest member."""

    def __init__(self, lengths: np.ndarray, size: int):
        self.size = size
        self.has = np.zeros(size + 1, dtype=bool)
        self.has[lengths] = True
        self.pair = np.zeros(size + 1, dtype=bool)
        for a in lengths:
            at = a + lengths[lengths <= a]
            self.pair[at[at <= size]] = True

    def pairs(self, total: int, longest: int, left: np.ndarray) -> np.ndarray:
        """First members of pairs with this sum that counts still allow, longest first."""
        if total < 2 or not self.pair[total]:
            return np.empty(0, dtype=int)
        a = np.arange(min(longest, total - 1), (total + 1) // 2 - 1, -1)
        b = total - a
        return a[(left[a] > 0) & (left[b] > (a == b))]

    def combinations(self, gap: int, left: np.ndarray, most: int) -> Iterator[tuple[int, ...]]:
        """Singles, pairs and triples (up to ``most`` members) that sum to the gap, by the counts when they are asked for."""
        if self.has[gap] and left[gap]:
            yield (gap,)
        if most < 2:
            return
        for a in self.pairs(gap, gap, left):
            yield int(a), int(gap - a)
        if most < 3:
            return
        first = np.arange(gap - 2, -(-gap // 3) - 1, -1)
        for a in first[(left[first] > 0) & self.pair[gap - first]] if gap >= 3 else ():
            left[a] -= 1
            rest = self.pairs(gap - int(a), int(a), left)
            left[a] += 1
            for b in rest:
                yield int(a), int(b), int(gap - a - b)


def exact_patterns(left: np.ndarray, size: int, most: int = 3) -> list[tuple[dict[int, int], int]]:
    """Full sequences: each length's gap filled by up to ``most`` others; ``left`` (count by length) is used up accordingly."""
    plan = []
    if left[size]:
        plan.append(({size: 1}, int(left[size])))
        left[size] = 0
    sums = Sums(np.flatnonzero(left), size)
    for length in range(size - 1, 0, -1):
        if not left[length]:
            continue
        for members in sums.combinations(size - length, left, most):
            pattern = Counter((length, *members))
            times = min(int(left[k]) // a for k, a in pattern.items())
            if times:
                plan.append((dict(pattern), times))
                for k, a in pattern.items():
                    left[k] -= a * times
                if not left[length]:
                    break
    return plan


def best_fit_patterns(left: np.ndarray, size: int) -> list[tuple[dict[int, int], int]]:
    """Residual pieces, longest first, each into the fullest sequence that takes it."""
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}  # by gap: patterns and how many sequences have them
    gaps: list[int] = []

    def put(gap: int, pattern: dict[int, int], times: int) -> None:
        if gap not in open_:
            open_[gap] = []
            insort(gaps, gap)
        open_[gap].append((pattern, times))

    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                # A new sequence takes the next pieces of this length as well: it is then the only one that does.
                per = size // length
                if n >= per:
                    put(size - per * length, {length: per}, n // per)
                    n %= per
                if n:
                    put(size - n * length, {length: n}, 1)
                n = 0
                continue
            gap = gaps[at]
            pattern, times = open_[gap].pop()
            if not open_[gap]:
                del open_[gap], gaps[at]
            per = min(gap // length, n)
            used = min(times, n // per)
            put(gap - per * length, {**pattern, length: pattern.get(length, 0) + per}, used)
            if times > used:
                put(gap, pattern, times - used)
            n -= used * per
        left[length] = 0
    return [(pattern, times) for kind in open_.values() for pattern, times in kind]


def plan_sequences(histogram: dict[int, int], size: int = SIZE) -> list[tuple[dict[int, int], int]]:
    """Patterns {length: pieces} and how often each is used; together they use every piece once.

    Where short pieces are few, triples can use up what would have served more sequences singly; so the plans
    with triples, with pairs and with singles only are made and the one with the fewest sequences is kept.
    """
    plans = []
    for most in (3, 2, 1):
        left = np.zeros(size + 1, dtype=np.int64)
        for length, n in histogram.items():
            left[length] = n
        plans.append(exact_patterns(left, size, most) + best_fit_patterns(left, size))
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def dealt(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end of ranks, pieces a sequence, offset, first sequence) per pattern and length."""
    upto: Counter[int] = Counter()
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for length, per in sorted(pattern.items(), reverse=True):
            rows.append((length, upto[length], upto[length] + per * times, per, offset, sequence))
            upto[length] += per * times
            offset += per * length
        sequence += times
    return rows


def pack(
    docs: DataFrame, path: str, size: int = SIZE, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every piece of every document (``end_id`` behind its ids) in one sequence of at most ``size`` ids.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A NULL or empty text has ``end_id``
    alone; repeated rows and rows without id are packed each; equal lengths are interchangeable, so ties need
    no rule; an empty table gives an empty one; other columns are not read.

    The plan on the driver follows from the histogram alone: every pattern but the last of a length uses some length up, so
    it has some thousands of rows for any corpus and is broadcast.
    """
    pieces = stored(cut_documents(docs, path, size, end_id, id_col, text_col), "pieces")
    parts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = docs.sparkSession.createDataFrame(
        dealt(plan_sequences(histogram, size)), "_length long, first long, until long, per long, at long, sequence long")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        F.col("length").alias("_l"), F.col("part").alias("_p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, (F.col("length") == F.col("_l")) & (F.col("part") == F.col("_p"))).withColumn(
        "rank", F.col("before") + F.col("nth"))
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("_length")) & F.col("rank").between(
        F.col("first"), F.col("until") - 1))
    inside = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(inside / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(inside, F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )
