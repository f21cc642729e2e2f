"""Packing tokenized documents into fixed-length sequences by cutting-stock column generation.

Documents are cut every ``size`` ids; the rests of all documents are the items. Their length histogram has
fewer than ``size`` entries whatever the corpus, so the linear program over it is solved on the
driver: its columns are patterns (how many items of each length fill a sequence), a knapsack dynamic
program prices new columns with the dual values, and the patterns' counts are rounded down. What
rounding leaves over is filled pattern by pattern. Items are ranked within
their length, and ranks are dealt to patterns by intervals, so a document's place follows from
its rank alone and no task ever sees more than its own rows.

A sequence whose ids number a power of two needs no padding and costs its own length; any other
costs ``size``.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from .bpe import PIECES, byte_letters, load
from .common import map_rows, need, stored

SIZE = 1024
ROUNDS = 300  # pricing rounds at most; every basis on the way is a valid plan
GAP = 0.001  # the linear program ends within this share of its lower bound

PIECE = StructType([StructField(c, LongType()) for c in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place")])


@lru_cache(maxsize=2)
def fast_encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary file of the tokenizers library in tiktoken: the same ids, without its offsets."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
    merged = [bytes(letters[c] for c in "".join(m if isinstance(m, list) else m.split(" "))) for m in spec["model"]["merges"]]
    if [ranks[m] for m in merged] != list(range(256, 256 + len(merged))):
        raise ValueError(f"{path}: ids do not follow the order of merges")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return tiktoken.Encoding("packing", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)


RUN_OF_BLANKS = re.compile(r"(?<!\s)\s{100000}")  # beyond some 700,000 the library's pattern search gives up


def ids_of(encoding: tiktoken.Encoding, path: str, text: str) -> np.ndarray:
    """Ids of a whole text; texts with very long runs of blanks go to this package's own encoder."""
    if len(text) >= 100_000 and RUN_OF_BLANKS.search(text):
        return np.frombuffer(load(path).encode_packed(text), dtype="<u4")
    return encoding.encode_to_numpy(text, allowed_special="all")


def cut_documents(
    docs: DataFrame, path: str, size: int = SIZE, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents; ``part`` and ``place`` number equal lengths within their task."""

    def make() -> Callable[..., Iterator[tuple]]:
        encoding = fast_encoding(path)
        part = TaskContext.get().partitionId()
        seen = [0] * (size + 1)

        def one(doc_id: int | None, text: str | None) -> Iterator[tuple]:
            ids = np.append(ids_of(encoding, path, text or ""), end_id).astype("<u4")
            for start in range(0, len(ids), size):
                piece = ids[start:start + size]
                n = len(piece)
                yield doc_id, start, n, zlib.crc32(piece.tobytes()), len(ids), part, seen[n]
                seen[n] += 1

        return one

    return map_rows(need(docs, id_col, text_col), PIECE, make)


def _cost(total: int, size: int) -> int:
    return total if total & (total - 1) == 0 else size


def _price(lengths: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of items with exactly each total, and the last item of that filling."""
    best = np.full(size + 1, -np.inf)
    best[0] = 0.0
    last = np.full(size + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for total in range(1, size + 1):
        k = fitting[total]
        if k:
            tries = best[total - lengths[:k]] + values[:k]
            i = int(tries.argmax())
            best[total], last[total] = tries[i], i
    return best, last


def greedy(histogram: dict[int, int], size: int) -> Iterator[tuple[dict[int, int], int, list[int]]]:
    """Fill sequence by sequence from the longest item on: pattern, times, lengths that it uses up."""
    left = {k: n for k, n in histogram.items() if n}
    while left:
        longest = max(left)
        rest = {k: n - (k == longest) for k, n in left.items() if n > (k == longest)}
        pattern = _fill(size - longest, rest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[k] // a for k, a in pattern.items())
        ended = []
        for k, a in pattern.items():
            left[k] -= a * times
            if not left[k]:
                del left[k]
                ended.append(k)
        yield pattern, times, ended


def column_generation(lengths: np.ndarray, counts: np.ndarray, size: int = SIZE) -> list[tuple[dict[int, int], float]]:
    """Patterns {length: items} and how often each is used (not whole numbers yet)."""
    m = len(lengths)
    if not m:
        return []
    row_of = {int(k): i for i, k in enumerate(lengths)}
    columns = np.zeros((m, m))
    costs = np.zeros(m)
    # Greedy patterns to start from: each uses up some length for the last time, so they form a basis.
    for pattern, _, ended in greedy(dict(zip(map(int, lengths), map(int, counts), strict=True)), size):
        for i, length in enumerate(ended):
            j = row_of[length]
            own = pattern if i == 0 else {length: size // length}
            for k, a in own.items():
                columns[row_of[k], j] = a
            costs[j] = _cost(sum(k * a for k, a in own.items()), size)
    inverse = np.linalg.inv(columns)
    used = np.maximum(inverse @ counts, 0.0)
    totals = np.arange(size + 1)
    price_of = np.array([size] + [_cost(t, size) for t in range(1, size + 1)], dtype=float)
    ideal = float((lengths * counts).sum())
    for _ in range(ROUNDS):
        duals = costs @ inverse
        best, last = _price(lengths, duals, size)
        steep = np.where(totals > 0, best / price_of, 0.0)
        bound = max(ideal, float(duals @ counts) / max(1.0, float(steep.max())))
        if float(costs @ used) <= bound * (1 + GAP):
            break
        gains = best - price_of
        moved = False
        for total in np.argsort(-gains)[:12]:
            if gains[total] <= 1e-7 * size:
                break
            column, rest = np.zeros(m), int(total)
            while rest:
                column[last[rest]] += 1
                rest -= int(lengths[last[rest]])
            if float((costs @ inverse) @ column) - price_of[total] <= 1e-7 * size:
                continue  # an earlier pivot of this round has used it up
            step = inverse @ column
            ratios = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1.0), np.inf)
            leave = int(ratios.argmin())
            if not np.isfinite(ratios[leave]):
                continue
            pivot = inverse[leave] / step[leave]
            inverse = inverse - np.outer(step, pivot)
            inverse[leave] = pivot
            theta = ratios[leave]
            used = np.maximum(used - theta * step, 0.0)
            used[leave] = theta
            columns[:, leave], costs[leave] = column, price_of[total]
            moved = True
        if not moved:
            break
    return [
        ({int(lengths[i]): int(columns[i, j]) for i in np.flatnonzero(columns[:, j])}, float(used[j])) for j in range(m)
    ]


def _fill(capacity: int, left: dict[int, int]) -> dict[int, int]:
    """Items with the largest total that fits, found over sets of reachable totals."""
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted((k for k in left if k <= capacity), reverse=True):
        for _ in range(min(left[length], capacity // length)):
            grown = (reach | reach << length) & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
            if reach >> capacity & 1:
                break
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for length, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + 1
            total -= length
    return taken


def whole_patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[dict[int, int], int]]:
    """Patterns with whole counts that use every item of the histogram exactly once."""
    left = {k: n for k, n in histogram.items() if n and k < size}
    plan = [({size: 1}, histogram[size])] if histogram.get(size) else []
    lengths = np.array(sorted(left), dtype=int)
    for pattern, times in column_generation(lengths, np.array([left[int(k)] for k in lengths], dtype=float), size):
        whole = min([int(times + 1e-6), *[left.get(k, 0) // a for k, a in pattern.items()]])
        if whole > 0:
            plan.append((pattern, whole))
            for k, a in pattern.items():
                left[k] -= a * whole
    return plan + [(pattern, times) for pattern, times, _ in greedy(left, size)]


def intervals(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, items a sequence, offset, first sequence) of each pattern and length."""
    dealt: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for length in sorted(pattern, reverse=True):
            per = pattern[length]
            first = dealt.get(length, 0)
            dealt[length] = first + per * times
            rows.append((length, first, dealt[length], per, offset, sequence))
            offset += per * length
        sequence += times
    return rows


def pack(
    docs: DataFrame, path: str, size: int = SIZE, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every id of every document (with ``end_id`` behind it) in exactly one place of one sequence.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: a row per piece. A NULL
    text is an empty one and has ``end_id`` alone; repeated rows are packed each; an empty table
    gives an empty one.

    The broadcast table has a row per pattern and length: patterns are at most twice ``size`` and
    hold fewer than ``sqrt(2 * size)`` lengths each, so its bound does not depend on the data.
    """
    pieces = stored(cut_documents(docs, path, size, end_id, id_col, text_col), "pieces")
    parts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = intervals(whole_patterns(histogram, size))
    plan = docs.sparkSession.createDataFrame(
        rows, "length long, first long, until long, per long, at long, sequence long")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("before") + F.col("place"))
    rank = F.col("r.rank") - F.col("p.first")
    placed = ranked.alias("r").join(
        F.broadcast(plan).alias("p"),
        (F.col("r.length") == F.col("p.length")) & (F.col("r.rank") >= F.col("p.first")) & (F.col("r.rank") < F.col("p.until")),
    )
    return placed.select(
        "doc_id", "start", "r.length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor(rank / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(rank, F.col("per")) * F.col("r.length")).cast("long").alias("offset"),
    )
