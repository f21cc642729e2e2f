"""K-means of sparse rows from several starts, whose centres stay on the executors.

The rows' entries are dealt to slices of columns. A pass sums, in every slice, the rows of each cluster to its part of the
centres and multiplies the rows with it; the products are added up by rows, which gives the next clusters. Only
clusters and products move, so a pass brings the driver one number a start, however many columns there are. The centres of the
best start alone come to the driver, once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import cut_lineage, drop_scratch, free_files, scratch_path
from .blocks import SparseRows, held, sparse_entries, spread, squeezed, stored_blocks, unsqueezed

BLOCK_ENTRIES = 1 << 18
PASS_BYTES = 1 << 29  # products that a pass may shuffle, whose files lie on disk until the next ones; beyond it starts go one after the other
CHUNK = 1 << 16  # numbers multiplied at a time, few enough for the cache
SLICE_ENTRIES = 40_000_000  # a task holds the entries of one slice, about 8 bytes each

CELL = "slice int, block long, n int, entries int, rows binary, columns binary, values binary"
LABELS = "block long, labels binary, closeness array<double>"


class Clusters:
    """Centres (k x columns); the nearest one of a vector has the largest 2 c x - |c|^2."""

    def __init__(self, centres: np.ndarray):
        self.centres = centres

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        """Adds the number of the nearest centre, inside the row; NULL for a NULL vector."""
        shared = df.sparkSession.sparkContext.broadcast((np.ascontiguousarray(self.centres.T), (self.centres ** 2).sum(axis=1)))

        @F.pandas_udf("int")
        def nearest(indices: pd.Series, values: pd.Series) -> pd.Series:
            c, squares = shared.value
            return pd.Series([None if x is None else int(np.argmax(2 * (x @ c[i]) - squares if len(x) else -squares))
                              for i, x in zip(indices, values)], dtype="Int32")

        return sparse_entries(df, features).withColumn(out, nearest("_i", "_v")).drop("_i", "_v")

    def save(self, path: str) -> str:
        spark = SparkSession.active()
        rows = [(j, c.tobytes()) for j, c in enumerate(self.centres)]
        spark.createDataFrame(rows, "cluster int, centre binary").write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(path: str) -> Clusters:
        rows = SparkSession.active().read.parquet(path).orderBy("cluster").collect()  # one row a centre
        return Clusters(np.stack([np.frombuffer(r["centre"], dtype=float) for r in rows]))


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def one_row(schema: pa.Schema, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema)], schema=schema)


class _Seeds:
    """Chosen rows of all starts, as a dense table over the columns they hold."""

    def __init__(self, chosen: Sequence[Sequence[tuple[np.ndarray, np.ndarray]]]):
        flat = [row for rows in chosen for row in rows]
        self.ends = np.cumsum([0] + [len(rows) for rows in chosen])
        self.columns = np.unique(np.concatenate([np.zeros(0, dtype=np.int32), *[c for c, _ in flat]]))
        self.table = np.zeros((len(self.columns), len(flat)))
        for j, (c, v) in enumerate(flat):
            self.table[np.searchsorted(self.columns, c), j] = v
        self.squares = (self.table ** 2).sum(axis=0)

    def closeness(self, rows: SparseRows) -> np.ndarray:
        """2 c x - |c|^2 for every row and seed."""
        out = np.tile(-self.squares, (len(rows), 1))
        if len(self.columns):
            at = np.minimum(np.searchsorted(self.columns, rows.columns), len(self.columns) - 1)
            here = np.flatnonzero(self.columns[at] == rows.columns)
            row = np.repeat(np.arange(len(rows)), rows.sizes)[here]
            add_products(row, at[here], rows.values[here], 2 * self.table, out)
        return out


def add_products(row: np.ndarray, column: np.ndarray, values: np.ndarray, table: np.ndarray, out: np.ndarray) -> None:
    """Adds the products of entries, sorted by row, with a table (columns x width) to ``out`` (rows x width)."""
    step = max(1, CHUNK // max(1, table.shape[1]))
    part = np.empty((min(step, len(row)), table.shape[1]))
    for a in range(0, len(row), step):
        r = row[a:a + step]
        firsts = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        own = np.take(table, column[a:a + step], axis=0, out=part[:len(r)], mode="clip")  # other modes copy the result once more
        own *= values[a:a + step, None]
        out[r[firsts]] += np.add.reduceat(own, firsts, axis=0)


def _seeds(blocks: DataFrame, k: int, seeds: Sequence[int]) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """First centres of every start: rows drawn one by one with a chance that grows with the squared distance to the nearest drawn one.

    All starts draw in the same pass. The driver gets one row a start and task. A start has fewer centres where the rows have fewer different ones.
    """
    spark, chosen = blocks.sparkSession, [[] for _ in seeds]
    found = "start int, key double, columns binary, values binary"
    schema = arrow_schema(found)
    for step in range(k):
        shared = spark.sparkContext.broadcast(_Seeds(chosen))

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, best = shared.value, [None] * len(seeds)
            for batch in batches:
                for i in range(batch.num_rows):
                    rows, block = SparseRows(batch, i), batch.column(4)[i].as_py()
                    squares = np.zeros(len(rows))
                    full = np.flatnonzero(rows.sizes)
                    if len(full):
                        squares[full] = np.add.reduceat(rows.values ** 2, rows.ends[full])
                    close = now.closeness(rows) if step else None
                    for s, seed in enumerate(seeds):
                        weight = np.ones(len(rows))
                        if step:
                            a, b = now.ends[s], now.ends[s + 1]
                            near = close[:, a:b].argmax(axis=1)
                            weight = squares - close[np.arange(len(rows)), a + near]
                            weight[weight <= 1e-12 * (squares + now.squares[a + near])] = 0.0
                        # The least of exponential numbers divided by their weights is a draw by weight.
                        chance = np.random.default_rng([seed, step, block]).standard_exponential(len(rows))
                        with np.errstate(divide="ignore"):
                            keys = np.where(weight > 0, chance / weight, np.inf)
                        at = int(keys.argmin())
                        if keys[at] < np.inf and (best[s] is None or keys[at] < best[s][0]):
                            part = slice(rows.ends[at], rows.ends[at + 1])
                            best[s] = (float(keys[at]), rows.columns[part].tobytes(), rows.values[part].tobytes())
            for s, own in enumerate(best):
                if own is not None:
                    yield one_row(schema, s, *own)

        drawn = blocks.mapInArrow(draw, found).groupBy("start").agg(
            F.min_by(F.struct("columns", "values"), "key").alias("row")).collect()  # one row a start
        shared.unpersist()
        for r in drawn:
            chosen[r["start"]].append((np.frombuffer(r["row"]["columns"], dtype=np.int32), np.frombuffer(r["row"]["values"], dtype=float)))
        if not drawn:
            break
    return chosen


def _first_labels(blocks: DataFrame, chosen: list) -> DataFrame:
    shared, schema = blocks.sparkSession.sparkContext.broadcast(_Seeds(chosen)), arrow_schema(LABELS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                close = now.closeness(SparseRows(batch, i))
                parts = [close[:, a:b] for a, b in zip(now.ends[:-1], now.ends[1:])]
                yield _labels(schema, batch.column(4)[i].as_py(), parts)

    return blocks.mapInArrow(run, LABELS)


def _labels(schema: pa.Schema, block: int, parts: list[np.ndarray]) -> pa.RecordBatch:
    """Cluster of every row in every start, and the sum of the largest closeness."""
    labels = np.stack([p.argmax(axis=1) for p in parts]).astype(np.int16)
    return one_row(schema, block, labels.tobytes(), [float(p.max(axis=1).sum()) for p in parts])


def slice_count(blocks: DataFrame, columns: int) -> tuple[int, int, int]:
    """Rows of the blocks, the slices of columns that they are worth, and the bytes that a pass may shuffle: a share of theirs, or PASS_BYTES."""
    n, entries = (int(x or 0) // 4 for x in blocks.agg(F.sum(F.length("sizes")), F.sum(F.length("columns"))).head())
    slices = max(1, min(columns, max(blocks.sparkSession.sparkContext.defaultParallelism, -(-entries // SLICE_ENTRIES))))
    return n, slices, max(PASS_BYTES, 2 * entries)


def _parts(spark: SparkSession, slices: int) -> int:
    """Partitions that Spark keeps where they are when other rows come to them."""
    return max(slices, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slice_keys(spark: SparkSession, slices: int) -> list[int]:
    """Numbers that a shuffle into _parts partitions deals to different ones."""
    parts = _parts(spark, slices)
    rows = spark.range(40 * parts).select(F.col("id").cast("int").alias("id")).groupBy(
        F.pmod(F.hash("id"), F.lit(parts)).alias("p")).agg(F.min("id").alias("id")).orderBy("id").limit(slices).collect()  # one row a slice
    keys = [r["id"] for r in rows]
    return keys if len(keys) == slices else list(range(slices))


def sliced_cells(blocks: DataFrame, keys: list[int]) -> DataFrame:
    """The blocks' entries by slices: column c lies in slice c % slices, there as c // slices."""
    schema, slices = arrow_schema(CELL), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = SparseRows(batch, i)
                row = np.repeat(np.arange(len(rows), dtype=np.int32), rows.sizes)
                own = rows.columns % slices
                for s, key in enumerate(keys):
                    at = np.flatnonzero(own == s)
                    yield one_row(schema, key, batch.column(4)[i].as_py(), len(rows), len(at), squeezed(row[at].astype(_row_kind(len(rows)))),
                                 squeezed((rows.columns[at] // slices).astype(np.int32)), squeezed(rows.values[at]))

    # What memory does not hold is read from the shuffle's files again, which lie on disk anyway.
    return blocks.mapInArrow(run, CELL).repartition(_parts(blocks.sparkSession, slices), "slice").persist(StorageLevel.MEMORY_ONLY)


def _row_kind(rows: int) -> type:
    return np.uint16 if rows <= 1 << 16 else np.int32


def opened(cells: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in cells.to_batches():
        for i in range(batch.num_rows):
            n, entries = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
            kinds = (_row_kind(n), np.int32, np.float64)
            yield (batch.column(1)[i].as_py(), n,
                   *[unsqueezed(batch.column(4 + j)[i].as_py(), entries, kind) for j, kind in enumerate(kinds)])


def _own_centres(cells: pa.Table, labels: pa.Table, starts: list[int], counts: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    """A slice's part of the centres (columns x clusters of all starts), and the clusters' rows."""
    places = np.cumsum([0, *counts])
    of_block = {b: np.frombuffer(x, dtype=np.int16).reshape(len(starts), -1) for b, x in zip(*(labels.column(j).to_pylist() for j in (1, 2)))}
    rows = np.zeros(places[-1])
    for x in of_block.values():
        for s, own in enumerate(x):
            rows[places[s]:places[s + 1]] += np.bincount(own, minlength=counts[s])
    total = [np.zeros(width * k) for k in counts]
    held, entries = [], 0

    def add() -> None:
        column, values = (np.concatenate([h[j] for h in held]) for j in (0, 1))
        for s, k in enumerate(counts):
            own = np.concatenate([h[2][s] for h in held])
            total[s] += np.bincount(column.astype(np.int64) * k + own, values, width * k)

    for block, _, row, column, values in opened(cells):
        held.append((column, values, of_block[block][:, row]))
        entries += len(values)
        if entries >= 64 * CHUNK:
            add()
            held, entries = [], 0
    if held:
        add()
    return np.concatenate([t.reshape(width, -1) for t in total], axis=1) / np.maximum(rows, 1), rows


def _with_labels(cells: DataFrame, labels: DataFrame, keys: list[int]):
    by_slice = labels.select(F.explode(F.array(*[F.lit(k) for k in keys])).alias("slice"), "block", "labels")
    return cells.groupBy("slice").cogroup(by_slice.groupBy("slice"))


def _moved(cells: DataFrame, labels: DataFrame, keys: list[int], counts: list[int], columns: int, tasks: int) -> DataFrame:
    """The rows' clusters after the centres have moved to the means of their clusters, with the closeness to them."""
    product = "block long, slice int, product binary"
    schema, out = arrow_schema(product), arrow_schema(LABELS)
    starts, width, places = list(range(len(counts))), -(-columns // len(keys)), np.cumsum([0, *counts])

    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        centres, rows = _own_centres(left, right, starts, counts, width)
        squares = (centres ** 2).sum(axis=0)
        squares[rows == 0] = np.inf  # a cluster that lost its rows gets none again
        parts = []
        for block, n, row, column, values in opened(left):
            close = np.tile(-squares, (n, 1))
            add_products(row, column, values, 2 * centres, close)
            parts.append(one_row(schema, block, left.column(0)[0].as_py(), close.tobytes()))
        return pa.Table.from_batches(parts, schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                block, part = batch.column(0)[i].as_py(), np.frombuffer(batch.column(2)[i].as_py(), dtype=float)
                if block != current and current is not None:
                    yield done(current, total)
                total = part.copy() if block != current else total + part
                current = block
        if current is not None:
            yield done(current, total)

    def done(block: int, total: np.ndarray) -> pa.RecordBatch:
        close = total.reshape(-1, places[-1])
        return _labels(out, block, [close[:, a:b] for a, b in zip(places[:-1], places[1:])])

    products = _with_labels(cells, labels, keys).applyInArrow(multiply, product)
    # Slices are added in one order, so that equal inputs give equal sums.
    return products.repartition(tasks, "block").sortWithinPartitions("block", "slice").mapInArrow(add, LABELS)


def _centres(cells: DataFrame, labels: DataFrame, keys: list[int], counts: list[int], start: int, columns: int) -> np.ndarray:
    """The centres of one start, on the driver (clusters with rows x columns)."""
    schema, slices = arrow_schema("slice int, data binary"), len(keys)
    starts, width = list(range(len(counts))), -(-columns // slices)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        labels = [np.frombuffer(x, dtype=np.int16).reshape(len(starts), -1)[start:start + 1].tobytes() for x in right.column(2).to_pylist()]
        own = pa.table([right.column(0), right.column(1), pa.array(labels, type=pa.binary())], names=right.column_names)
        centres, rows = _own_centres(left, own, [start], [counts[start]], width)
        return pa.Table.from_batches([one_row(schema, left.column(0)[0].as_py(), centres[:, rows > 0].tobytes())])

    parts = {r["slice"]: r["data"] for r in _with_labels(cells, labels, keys).applyInArrow(run, "slice int, data binary").collect()}
    out = np.empty((width * slices, len(next(iter(parts.values()))) // 8 // width))
    for s, key in enumerate(keys):
        out[s::slices] = np.frombuffer(parts.pop(key), dtype=float).reshape(width, -1)
    return np.ascontiguousarray(out[:columns].T)


def fit_clusters(
    vectors: DataFrame, features: str = "features", k: int = 10, restarts: int = 10, max_iter: int = 20, seed: int = 42,
) -> Clusters:
    """K-means from several starts (k-means++), side by side as far as the bytes of a pass allow; the lowest cost wins.

    At most ``max_iter`` passes, fewer once no start comes nearer. There are fewer centres than ``k`` where the rows have fewer different
    ones, or a cluster loses all its rows. Rows with a NULL vector take no part.
    """
    spark = vectors.sparkSession
    columns = vectors.where(F.col(features).isNotNull()).select(F.unwrap_udt(F.col(features)).alias("v")).select(
        F.coalesce(F.col("v.size"), F.size("v.values")).alias("n")).head()
    if columns is None:
        raise ValueError("no rows to cluster")
    columns = columns["n"]
    rows, path = held(vectors, features), scratch_path(spark, "blocks")
    blocks = stored_blocks(spread(rows), features, size=BLOCK_ENTRIES, numbered=True, path=path)
    rows.unpersist()
    n, slices, most = slice_count(blocks, columns)
    keys = slice_keys(spark, slices)
    cells = sliced_cells(blocks, keys)
    group = max(1, min(restarts, most // (8 * n * k * slices)))
    best, centres = -np.inf, None
    for first in range(0, restarts, group):
        chosen = _seeds(blocks, k, [seed + i for i in range(first, min(first + group, restarts))])
        counts, closest = [len(c) for c in chosen], None
        now = cut_lineage(_first_labels(blocks, chosen))
        for _ in range(max_iter):
            after = cut_lineage(_moved(cells, now, keys, counts, columns, slices))
            sums = after.select(F.posexplode("closeness").alias("start", "c")).groupBy("start").agg(F.sum("c").alias("c")).collect()
            close = np.array([r["c"] for r in sorted(sums, key=lambda r: r["start"])])  # one number a start
            free_files(spark, 8 * n * sum(counts) * slices)  # those of earlier passes may go
            if closest is not None and (close <= closest).all():
                break
            now, before, closest = after, now, close
        start = int(closest.argmax())
        if closest[start] > best:
            best, centres = closest[start], _centres(cells, before, keys, counts, start, columns)
    cells.unpersist()
    drop_scratch(spark, path)
    return Clusters(centres)
