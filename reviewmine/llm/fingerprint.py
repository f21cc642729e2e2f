"""Order MinHash fingerprints: signatures that feel the edit distance of texts.

Every k-mer of characters is numbered by its occurrence, so repeated k-mers stay distinct. A hash deals
the numbered k-mers into ``SKETCHES`` groups; of each group the ``KEEP`` smallest are selected
and, in the order in which they stand in the text, hashed to one value. Two texts agree in a
group when they share its minimal k-mers and their order. Likeness is the share of agreeing groups
among those that either text fills.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import CHUNK_CHARS, _batch, map_rows, need, sha256

K = 8  # characters of a k-mer
KEEP = 2  # k-mers of a sketch
SKETCHES = 64
ROWS_PER_SLICE = 4_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _kmers(points: np.ndarray, k: int) -> np.ndarray:
    """A hash of every window of k code points; k a power of two: windows are doubled."""
    hashes = points.astype(np.uint64)
    width = 1
    while width < k:
        hashes = _mix(hashes[:-width] * _A + hashes[width:] + np.uint64(width))
        width *= 2
    return hashes


def order_minhash(text: str, k: int = K, keep: int = KEEP, sketches: int = SKETCHES) -> np.ndarray:
    """Signature of one whole text: ``sketches`` unsigned 32-bit values, 0 where a sketch is empty.

    Texts shorter than k are one k-mer; an empty text leaves all sketches empty.
    """
    out = np.zeros(sketches, dtype=np.uint32)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(points):
        return out
    if len(points) < k:
        points = np.append(points, np.zeros(k - len(points), dtype="<u4"))
    hashes = _kmers(points, k)
    n = len(hashes)
    # Occurrence numbers: sort by hash with the position in the low bits, then count within runs.
    bits = np.uint64(max(1, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = np.sort((hashes & ~low) | np.arange(n, dtype=np.uint64))
    group, position = packed >> bits, (packed & low).astype(np.int64)
    index = np.arange(n)
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = group[1:] != group[:-1]
    first = np.maximum.accumulate(np.where(fresh, index, 0))
    numbered = _mix(hashes[position] + (index - first).astype(np.uint64) * _A)
    # The high bits name the sketch, so that one sort puts the smallest of each sketch first.
    order = np.argsort(numbered)
    ranked = numbered[order]
    limits = (np.arange(sketches, dtype=np.uint64) * np.uint64((1 << 64) // sketches))
    starts = np.searchsorted(ranked, limits)
    ends = np.append(starts[1:], n)
    slots = starts[:, None] + np.arange(keep)
    taken = slots < ends[:, None]
    chosen = order[np.minimum(slots, n - 1)]
    text_order = np.argsort(np.where(taken, position[chosen], n), axis=1)
    values = np.arange(sketches, dtype=np.uint64)
    for j in range(keep):  # a sketch with fewer k-mers hashes those it has
        at = np.take_along_axis(chosen, text_order[:, j:j + 1], axis=1)[:, 0]
        there = np.take_along_axis(taken, text_order[:, j:j + 1], axis=1)[:, 0]
        values = np.where(there, _mix(values * _A + numbered[at]), values)
    filled = ends > starts
    out[filled] = np.maximum(values[filled] >> np.uint64(32), np.uint64(1)).astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal sketches among those filled in either; two empty texts are alike."""
    filled = (a != 0) | (b != 0)
    n = int(filled.sum())
    return float(((a == b) & filled).sum() / n) if n else 1.0


def hexed(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint of every text (NULL: empty); needs no shuffle."""

    def make() -> Callable[..., Iterator[tuple]]:
        def one(row_id: object, text: str | None) -> Iterator[tuple]:
            yield row_id, hexed(order_minhash(text or ""))

        return one

    schema = StructType().add("id", docs.schema[id_col].dataType).add("fingerprint", "string")
    return map_rows(need(docs, id_col, text_col), schema, make)


EDITED = StructType([
    StructField("doc_id", LongType()), StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
    StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()),
    StructField("near_edited", DoubleType()), StructField("near_next", DoubleType()),
])


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows in slices by descending id, each slice ended by a copy of the row that follows it.

    Columns id, text, _slice, _guard, sorted within partitions that hold whole slices. Texts are shuffled
    once. Slices come from quantiles of the ids and hold about ROWS_PER_SLICE rows; the row
    that opens a slice is found over ids alone and is the only one sent twice. After the last row
    follows the first. NULL ids come last; rows with equal ids stand in the order of their texts.
    """
    rows = need(docs, id_col, text_col).toDF("id", "text")
    keys = rows.select("id", F.xxhash64("text").alias("mark"))
    total = keys.count()
    n = max(1, -(-total // ROWS_PER_SLICE), docs.sparkSession.sparkContext.defaultParallelism * 2 if total > 5000 else 1)
    shares = [i / n for i in range(1, n)]
    bounds = sorted(set(keys.stat.approxQuantile("id", shares, 0.2 / n))) if shares and total else []
    slices = len(bounds) + 1
    limits = F.array(*[F.lit(int(b)) for b in bounds]) if bounds else F.array().cast("array<bigint>")

    def slice_of(value: F.Column) -> F.Column:
        below = F.size(F.filter(limits, lambda b: b < value))
        return F.when(value.isNull(), slices - 1).otherwise(slices - 1 - below).cast("int")

    keyed = rows.withColumns({"_slice": slice_of(F.col("id")), "mark": F.xxhash64("text")})
    heads = keyed.groupBy("_slice").agg(
        F.min_by(F.struct("id", "mark"), F.struct((-F.col("id")).isNull(), -F.col("id"), "mark")).alias("head")
    ).collect()  # one id and one hash a slice
    opened = sorted((r["_slice"], r["head"]["id"], r["head"]["mark"]) for r in heads)
    if not opened:
        return keyed.select("id", "text", "_slice", F.lit(0).alias("_guard"), "mark")
    pairs = [(opened[i - 1][0], row[1], row[2]) for i, row in enumerate(opened)]
    wanted = docs.sparkSession.createDataFrame(pairs, "_slice int, id long, mark long")
    guards = keyed.drop("_slice").join(
        F.broadcast(wanted),  # one row a slice
        keyed["id"].eqNullSafe(wanted["id"]) & (keyed["mark"] == wanted["mark"]),
    ).select(keyed["id"], "text", wanted["_slice"], F.lit(1).alias("_guard"), keyed["mark"])
    both = keyed.select("id", "text", "_slice", F.lit(0).alias("_guard"), "mark").unionByName(guards)
    return both.repartition(slices, "_slice").sortWithinPartitions(
        "_slice", "_guard", F.desc_nulls_last("id"), "mark")


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of the following text."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see EDITED.

    NULL texts are empty; the only row of a table is followed by itself; an empty table gives an empty one.
    """
    arrow = to_arrow_schema(EDITED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row that waits for the next one
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                for row_id, text, number, guard in zip(*[part.column(i).to_pylist() for i in range(4)], strict=True):
                    text = text or ""
                    signature = order_minhash(text)
                    if held is not None and held[0] == number:
                        _, own_id, own, mark = held
                        edited = edited_text(own, text)
                        changed = order_minhash(edited)
                        out.append((
                            own_id, len(own), sha256(edited.encode("utf-8", "surrogatepass")), hexed(mark), hexed(changed),
                            likeness(mark, changed), likeness(mark, signature),
                        ))
                        size += 2000
                    # Further guards of a slice are repeated rows of the same id and text.
                    held = None if guard else (number, row_id, text, signature)
                    if size >= CHUNK_CHARS:
                        yield _batch(out, arrow)
                        out, size = [], 0
        if out:
            yield _batch(out, arrow)

    return with_next(docs, id_col, text_col).select("id", "text", "_slice", "_guard").mapInArrow(run, EDITED)
