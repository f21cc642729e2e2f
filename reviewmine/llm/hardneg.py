"""Hard negatives for contrastive training, found exactly with STR-packed R-trees.

Vectors are dealt by hash to shards of bounded size. A shard packs the rows of each label into a tree by sort-tile-recursive:
rows are sorted by the coordinate of largest spread and cut into slabs, these by the next, until leaves are full; every
16 neighbours share a minimum bounding box above them. A box gives the interval of its inner products with
a query, coordinate by coordinate. The best-first queue drops boxes whose interval misses all score windows
of the query or ends strictly below the k-th best score found in each.

Anchors come to the shards in blocks of rows. A first search finds each anchor's positives under its own label,
a second one the negatives under all other labels, within the windows that the positives' scores set.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from .common import need, stored

SHARD_CELLS = 8_000_000  # components that a shard holds
LEAST_ROWS = 1024  # smaller shards are not worth their anchors
BLOCK_CELLS = 32_768  # components of a block of anchors
LEAF = 128
FAN = 16
EXACT = 2.0 ** 53
WIDE = 1 << 62  # open end of a window

BLOCK = StructType([StructField(c, BinaryType()) for c in ("rows", "ids", "labels", "vectors", "windows")])
HIT = StructType([StructField(c, LongType()) for c in ("row", "window", "id", "score")])


class Tree:
    """Boxes over vectors of one label, packed by sort-tile-recursive; level 0 are the leaves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        spread = np.argsort(-(vectors.max(axis=0).astype(float) - vectors.min(axis=0)), kind="stable") if vectors.shape[1] else []
        order: list[np.ndarray] = []
        cuts: list[int] = []

        def tile(rows: np.ndarray, depth: int) -> None:
            if len(rows) <= LEAF or depth == len(spread):
                for at in range(0, len(rows), LEAF):
                    order.append(rows[at:at + LEAF])
                    cuts.append(len(order[-1]))
                return
            leaves = -(-len(rows) // LEAF)
            slabs = max(2, int(np.ceil(leaves ** (1 / (len(spread) - depth)) - 1e-9)))
            rows = rows[np.argsort(vectors[rows, spread[depth]], kind="stable")]
            for part in np.array_split(rows, slabs):
                if len(part):
                    tile(part, depth + 1)

        tile(np.arange(len(ids)), 0)
        rows = np.concatenate(order)
        self.ids, self.vectors = ids[rows], vectors[rows]
        self.starts = np.concatenate([[0], np.cumsum(cuts)])
        low = np.minimum.reduceat(self.vectors, self.starts[:-1], axis=0)
        high = np.maximum.reduceat(self.vectors, self.starts[:-1], axis=0)
        self.levels = [(low, high)]
        while len(self.levels[-1][0]) > FAN:
            at = np.arange(0, len(self.levels[-1][0]), FAN)
            low, high = self.levels[-1]
            self.levels.append((np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)))

    def bounds(self, level: int, first: int, end: int, plus: np.ndarray, minus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest and least inner products that the boxes allow."""
        low, high = self.levels[level][0][first:end], self.levels[level][1][first:end]
        return high @ plus + low @ minus, low @ plus + high @ minus


class Forest:
    """A tree for each label of a shard."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.largest = float(np.abs(vectors.astype(float)).max(initial=1))
        self.whole = (ids, labels, vectors)
        self.trees: dict[int, Tree] = {}
        self.exact = True
        self._plant(np.float64)

    def _plant(self, kind: type) -> None:
        ids, labels, vectors = self.whole
        order = np.argsort(labels, kind="stable")
        cuts = np.flatnonzero(np.diff(labels[order])) + 1
        self.trees = {int(labels[own[0]]): Tree(ids[own], vectors[own].astype(kind)) for own in np.split(order, cuts) if len(own)}

    def search(
        self, query: np.ndarray, own_id: int, label: int, same: bool, windows: np.ndarray, k: int,
    ) -> list[list[tuple[int, int]]]:
        """Per window (lowest, highest score): ids and scores of the k best rows of the label, or of all others."""
        if self.exact and float(np.abs(query.astype(float)).max(initial=1)) * self.largest * max(1, len(query)) >= EXACT:
            self.exact = False  # from here on with whole numbers of any size
            self._plant(object)
        query = query.astype(np.float64 if self.exact else object)
        plus, minus = np.maximum(query, 0), np.minimum(query, 0)
        trees = [self.trees[label]] if same and label in self.trees else [] if same else [
            t for key, t in self.trees.items() if key != label]
        least, most = windows[:, 0].copy(), windows[:, 1]  # least: the k-th best so far, the window's end before
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        queue: list[tuple] = []
        count = 0

        def push(tree: Tree, level: int, first: int, end: int) -> None:
            nonlocal count
            upper, lower = tree.bounds(level, first, end, plus, minus)
            alive = ((upper[:, None] >= least) & (lower[:, None] <= most)).any(axis=1)
            for i in np.flatnonzero(alive):
                count += 1
                heapq.heappush(queue, (-upper[i], count, lower[i], tree, level, first + int(i)))

        for tree in trees:
            push(tree, len(tree.levels) - 1, 0, len(tree.levels[-1][0]))
        while queue:
            upper, _, lower, tree, level, node = heapq.heappop(queue)
            if not ((-upper >= least) & (lower <= most)).any():
                if (-upper < least).all():
                    break  # all others end lower still
                continue
            if level:
                push(tree, level - 1, node * FAN, min(node * FAN + FAN, len(tree.levels[level - 1][0])))
                continue
            a, b = tree.starts[node], tree.starts[node + 1]
            scores, ids = tree.vectors[a:b] @ query, tree.ids[a:b]
            for w in range(len(windows)):
                found = np.flatnonzero((scores >= least[w]) & (scores <= most[w]) & (ids != own_id))
                if len(found):
                    best[w] = heapq.nsmallest(k, best[w] + [(-int(scores[i]), int(ids[i])) for i in found])
                    if len(best[w]) == k:
                        least[w] = -best[w][-1][0]
        return [[(own, -score) for score, own in row] for row in best]


def integer_rows(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label", scale: int = 256,
) -> DataFrame:
    """id, label and floor(scale * x) of every row that can take part, numbered by ``row``.

    Rows with NULL id or label, with a NULL vector or with NULL or non-finite components take no part. Scaled
    components beyond the range of a long are held at its ends. ``label`` may be an expression.
    """
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    x = F.col(f"`{vec_col}`")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return df.where(F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & x.isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vector"),
    )


def _dense(column: pa.ListArray, terms: int) -> np.ndarray:
    """Shorter vectors count as zero in what they lack."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), terms), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _blocks(anchors: DataFrame, terms: int) -> DataFrame:
    """Anchors (row, id, label, vector, windows: array of lowest and highest scores) packed by hundreds."""
    arrow, size = to_arrow_schema(BLOCK), max(1, BLOCK_CELLS // max(1, terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                part = whole.slice(at, size)
                row, own, label = (np.asarray(part.column(i).to_numpy(zero_copy_only=False), dtype=np.int64) for i in range(3))
                ends = [(j, lo, hi) for j, pairs in enumerate(part.column(4).to_pylist()) for lo, hi in pairs]
                columns = [row, own, label, _dense(part.column(3), terms), np.array(ends, dtype=np.int64).reshape(-1, 3)]
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], type=pa.binary()) for c in columns], schema=arrow)

    return anchors.select("row", "id", "label", "vector", "windows").mapInArrow(run, BLOCK)


def search(
    rows: DataFrame, anchors: DataFrame, same: bool, k: int, terms: int, shards: int,
) -> DataFrame:
    """Hits (row, window, id, score) of every anchor: at most k per window from each shard.

    With ``same`` among the rows of the anchor's label, else among all other rows; rows with the anchor's
    own id are left out. ``window`` numbers an anchor's windows from 0.
    """
    dealt = rows.select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), "id", "label", "vector",
        *[F.lit(None).cast("binary").alias(c) for c in BLOCK.names])
    blocks = _blocks(anchors, terms).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("long").alias("label"), F.lit(None).cast("array<long>").alias("vector"), *BLOCK.names)
    arrow = to_arrow_schema(HIT)

    def block_hits(forest: Forest, payload: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        row, own, label, vectors, ends = (np.frombuffer(p, dtype=np.int64) for p in payload)
        vectors, ends = vectors.reshape(len(row), -1), ends.reshape(-1, 3)
        cuts = np.searchsorted(ends[:, 0], np.arange(len(row) + 1))
        for j in range(len(row)):
            windows = ends[cuts[j]:cuts[j + 1], 1:]
            if len(windows):
                for w, found in enumerate(forest.search(vectors[j], own[j], int(label[j]), same, windows, k)):
                    for i, score in found:
                        yield int(row[j]), w, i, max(-WIDE * 2, min(WIDE * 2 - 1, score))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, forest = None, [], None
        for batch in batches:
            shard = batch.column(0).to_numpy(zero_copy_only=False)
            asking = np.asarray(batch.column(4).is_valid())
            edges = np.flatnonzero((np.diff(shard) != 0) | (asking[1:] != asking[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(shard)]):
                if shard[a] != current:
                    current, held, forest = shard[a], [], None
                if not asking[a]:
                    part = batch.slice(a, b - a)
                    held.append((part.column(1).to_numpy(), part.column(2).to_numpy(), _dense(part.column(3), terms)))
                    continue
                if held:
                    forest, held = Forest(*(np.concatenate(c) for c in zip(*held))), []
                for at in range(a, b) if forest else ():
                    hits = list(block_hits(forest, [batch.column(c)[at].as_py() for c in range(4, 9)]))
                    if hits:
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*hits)], schema=arrow)

    # A shard's rows come before the blocks of anchors: the first are held, the others stream by.
    return dealt.unionByName(blocks).repartition(shards, "shard").sortWithinPartitions(
        "shard", F.col("rows").isNotNull()).mapInArrow(run, HIT)


def _best(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
    return hits.withColumn("rank", ranked.cast(IntegerType())).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchors: Callable[[DataFrame], DataFrame], positives: int = 5, negatives: int = 3,
    least: int = 50, most: int = 95, shard_cells: int = SHARD_CELLS,
) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (row, id, label, vector, from ``integer_rows``).

    ``anchors`` picks the anchor rows. An anchor's positives are its best other rows under the same label;
    the negatives of each are the best rows of other labels whose score is between ``least`` and ``most`` percent of the
    positive's. Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Equal scores go to the smaller id. Rows with the anchor's own id take no part for it; repeated rows
    are candidates each, repeated anchors are answered each. Shorter vectors count as zero in what they lack. Negative
    positive scores leave no window. An empty table gives an empty one; other columns are not read.
    """
    rows = stored(need(rows, "row", "id", "label", "vector"), "vectors")
    spark = rows.sparkSession
    stats = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("terms")).first()
    n, terms = stats["n"], stats["terms"] or 0
    shards = max(1, -(-n * max(1, terms) // shard_cells), min(2 * spark.sparkContext.defaultParallelism, n // LEAST_ROWS))
    asked = need(anchors(rows), "row", "id", "label", "vector")
    window = F.array(F.array(F.lit(-WIDE), F.lit(WIDE)))
    found = search(rows, asked.withColumn("windows", window), True, positives, terms, shards)
    best = stored(_best(found, ["row"], positives).select("row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    def low_end(score: Column) -> Column:
        return F.ceil(score * F.lit(least).cast("decimal(4,0)") / F.lit(100)).cast("long")

    def high_end(score: Column) -> Column:
        return F.floor(score * F.lit(most).cast("decimal(4,0)") / F.lit(100)).cast("long")

    # One window for each different score of an anchor's positives, numbered in their order.
    scores = best.groupBy(F.col("row").alias("_row")).agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    second = asked.join(scores, F.col("row") == F.col("_row")).withColumn(
        "windows", F.transform("scores", lambda s: F.array(low_end(s), high_end(s))))
    hits = search(rows, second, False, negatives, terms, shards)
    named = hits.join(scores, F.col("row") == F.col("_row")).select(
        "row", F.element_at("scores", (F.col("window") + 1).cast("int")).alias("_score"), "id", "score")
    ranked = _best(named, ["row", "_score"], negatives).withColumnRenamed("row", "_row")
    ids = asked.select(F.col("row").alias("_anchor"), F.col("id").alias("anchor_id"))
    return best.join(ranked, (F.col("row") == F.col("_row")) & (F.col("positive_score") == F.col("_score"))).join(
        ids, F.col("row") == F.col("_anchor")).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
