"""Exact top-k search by inner product with MaxScore over the components of integer vectors.

Every component is a term. Within a shard a term's score bounds are the query's weight times the smallest and
the largest value of its posting list; shifted by the lower bound, contributions are never negative. Terms
with the smallest spans are non-essential as long as all of them together cannot lift a vector to the
k-th best score: only the postings of the other, essential terms are traversed, and the
non-essential ones are probed, widest first, for the vectors that can still compete. Shards keep k
rows a query, which are merged by a window over a query's few rows.

Queries are a set apart, streamed against shards of bounded size; no pair of rows is ever built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from .common import need

SHARD_ROWS = 16_384
WARM_ROWS = 512  # scored in full first, to start with a useful k-th best score
PROBE = 8  # non-essential terms looked up between two prunings

HIT = StructType([
    StructField("query_row", LongType()), StructField("query_id", LongType()), StructField("vec_id", LongType()),
    StructField("score", LongType()),
])


class Shard:
    """Postings of up to SHARD_ROWS integer vectors, one row of values per term."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")  # ties go to the smaller id
        self.ids = ids[order]
        whole = np.ascontiguousarray(vectors[order].T)
        self.low, self.high = whole.min(axis=1), whole.max(axis=1)
        self.largest = float(max(-self.low.min(), self.high.max(), 1))
        self.whole = whole
        self.postings = whole.astype(np.float64)  # sums below 2**53 are exact

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best, the query's own id left out."""
        exact = float(np.abs(query).max(initial=1)) * self.largest * len(query) < 2.0 ** 53
        postings = self.postings if exact else self.whole.astype(object)
        weights = query.astype(np.float64) if exact else query.astype(object)
        a, b = weights * self.low, weights * self.high
        lower, spans = np.minimum(a, b), np.abs(b - a)
        order = np.argsort(-spans, kind="stable")
        rest = np.append(np.cumsum(spans[order][::-1])[::-1], 0)  # what terms from here on can still add
        base = lower.sum()
        n = len(self.ids)
        warm = weights @ postings[:, :WARM_ROWS]
        warm = warm[self.ids[:WARM_ROWS] != query_id]
        least = np.sort(warm)[-k] - base if len(warm) >= k else -np.inf
        essential = max(1, int(np.searchsorted(-rest, -least, side="right")))  # all after them add less than it takes
        essential = min(essential, len(order))
        terms = order[:essential]
        partial = weights[terms] @ postings[terms] - lower[terms].sum()
        alive = np.flatnonzero((partial + rest[essential] >= least) & (self.ids != query_id))
        partial = partial[alive]
        at = essential
        while at < len(order):
            terms = order[at:at + PROBE]
            partial = partial + weights[terms] @ postings[np.ix_(terms, alive)] - lower[terms].sum()
            at += len(terms)
            keep = partial + rest[at] >= least
            if not keep.all():
                alive, partial = alive[keep], partial[keep]
        best = np.lexsort((alive, -partial))[:k] if exact else sorted(range(len(alive)), key=lambda i: (-partial[i], alive[i]))[:k]
        return alive[best], partial[best] + base


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """id and floor(scale * x) of every vector whose components are all finite numbers.

    Rows with NULL id or vector, with an empty vector, or with NULL or non-finite components
    are left out. Components beyond the range of a long are held at its ends.
    """
    x = F.col(f"`{vec_col}`")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return need(df, id_col, vec_col).where(F.col(f"`{id_col}`").isNotNull() & (F.size(x) > 0) & ~bad).select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vector"),
    )


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The k best rows of ``vectors`` for each row of ``queries`` (both: id long, vector array<long>).

    Returns query_id, rank, vec_id, score; equal scores go to the smaller id; rows with the query's own id
    take no part. A vector with fewer components than others counts as zero in the rest.
    Repeated query rows are answered each, repeated vectors are candidates each. Without candidates
    there are no rows.
    """
    spark = vectors.sparkSession
    stats = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("terms")).first()
    terms, n = max(stats["terms"] or 1, 1), stats["n"]
    shards = max(1, -(-n // shard_rows), min(2 * spark.sparkContext.defaultParallelism, n // 64))
    rows = F.monotonically_increasing_id()
    dealt = vectors.select(
        F.pmod(F.xxhash64(rows), F.lit(shards)).cast("int").alias("shard"), F.lit(-1).cast("long").alias("query_row"),
        "id", "vector",
    )
    asked = queries.select(rows.alias("query_row"), "id", "vector").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "query_row", "id", "vector",
    )
    arrow = to_arrow_schema(HIT)

    def dense(column: pa.ListArray) -> np.ndarray:
        flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
        sizes = np.diff(column.offsets.to_numpy())
        if (sizes == terms).all():
            return flat.reshape(-1, terms)
        out = np.zeros((len(sizes), terms), dtype=np.int64)
        out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, parts, shard = None, [], [], None
        for batch in batches:
            shard_no, query_row, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            values = dense(batch.column(3))
            out: list[tuple[np.ndarray, ...]] = []
            for i in np.flatnonzero(np.append(True, (shard_no[1:] != shard_no[:-1]) | ((query_row[1:] < 0) != (query_row[:-1] < 0)))):
                later = np.flatnonzero((shard_no[i:] != shard_no[i]) | ((query_row[i:] < 0) != (query_row[i] < 0)))
                end = i + (int(later[0]) if len(later) else len(own) - i)
                if shard_no[i] != current:
                    current, ids, parts, shard = shard_no[i], [], [], None
                if query_row[i] < 0:
                    ids.append(own[i:end])
                    parts.append(values[i:end])
                    continue
                if shard is None and parts:
                    shard, parts = Shard(np.concatenate(ids), np.concatenate(parts)), []
                for j in range(i, end) if shard else ():
                    found, scores = shard.search(own[j], values[j], k)
                    m = len(found)
                    out.append((np.full(m, query_row[j]), np.full(m, own[j]), shard.ids[found], np.asarray(scores).astype(np.int64)))
            if out:
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], schema=arrow)

    # A shard's vectors come before its queries: the first are held, the others stream by.
    hits = dealt.unionByName(asked).repartition(shards, "shard").sortWithinPartitions(
        "shard", F.col("query_row") >= 0).mapInArrow(run, HIT)
    by_score = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(by_score).cast(IntegerType())).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
