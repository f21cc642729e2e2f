"""Truncated SVD of sparse rows without centring: randomized range finder and tall-skinny QR.

A fixed number of passes over the rows' entries, which lie in slices of columns: a pass multiplies the images of the rows with A A', slice by
slice, and adds the products up by rows. Images are brought to triangular form block by block, task by task, so that
only factors of (k + 10) x (k + 10) numbers come to the driver. The vectors stay in a table by slices of columns; projecting new rows
shares them by a few at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import cut_lineage, drop_scratch, free_files, scratch_path
from .blocks import held, sparse_entries, spread, stored_blocks
from .clusters import BLOCK_ENTRIES, add_products, arrow_schema, one_row, opened, slice_count, slice_keys, sliced_cells

EXTRA = 10  # columns of the basis beyond k
PASSES = 5
MOST_CELLS = 1 << 27  # numbers of the vectors with the extra ones, over all executors
RANGE_CELLS = 1 << 23  # numbers of vectors that the driver gathers and shares at a time
TASK_CELLS = 1 << 25  # numbers of the rows' images that a task holds
CHUNK = 1 << 22  # entries transposed at a time

VECTORS = "slice int, slices int, columns int, data binary"
IMAGES = "block long, images binary"


class TruncatedSVD:
    """Right singular vectors and singular values; projects vectors of new texts.

    ``table`` holds the vectors' rows by slices of columns: column c lies in slice c % slices as row c // slices.
    """

    def __init__(self, table: DataFrame, columns: int, singular: np.ndarray):
        self.table, self.columns, self.singular = table, columns, singular

    def gathered(self, first: int, last: int) -> np.ndarray:
        """The vectors from ``first`` to before ``last`` on the driver (columns x vectors)."""
        k, schema = len(self.singular), arrow_schema(VECTORS)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    data = np.frombuffer(batch.column(3)[i].as_py(), dtype=float).reshape(-1, k)[:, first:last]
                    yield one_row(schema, *[batch.column(j)[i].as_py() for j in range(3)], data.tobytes())

        out = np.zeros((self.columns, last - first))
        if last > first:
            for r in self.table.mapInArrow(cut, VECTORS).toLocalIterator():
                own = out[r["slice"]::r["slices"]]
                own[:] = np.frombuffer(r["data"], dtype=float).reshape(-1, last - first)[:len(own)]
        return out

    @property
    def vectors(self) -> np.ndarray:
        """All of them (columns x k), on the driver."""
        return self.gathered(0, len(self.singular))

    def products(self) -> np.ndarray:
        """Inner products of the vectors with each other (k x k)."""
        k = len(self.singular)
        return _summed(self.table, 3, lambda x: x.T @ x, k).reshape(k, k)

    def transform(self, df: DataFrame, features: str = "features", out: str = "point") -> DataFrame:
        """Adds the coordinates of every vector, inside the row; NULL for a NULL vector, zeros for an empty one."""
        k = len(self.singular)
        step = max(1, RANGE_CELLS // max(1, self.columns))
        points = []
        for first in range(0, max(k, 1), step):
            shared = df.sparkSession.sparkContext.broadcast(self.gathered(first, min(first + step, k)))
            points.append(_projection(shared)("_i", "_v"))
        return sparse_entries(df, features).withColumn(out, F.concat(*points)).drop("_i", "_v")

    def save(self, path: str) -> str:
        spark = SparkSession.active()
        self.table.write.mode("overwrite").parquet(f"{path}/vectors")
        spark.createDataFrame([(self.columns, [float(s) for s in self.singular])], "columns int, singular array<double>").write.mode(
            "overwrite").parquet(f"{path}/singular")
        return path

    @staticmethod
    def load(path: str) -> TruncatedSVD:
        spark = SparkSession.active()
        row = spark.read.parquet(f"{path}/singular").head()
        return TruncatedSVD(spark.read.schema(VECTORS).parquet(f"{path}/vectors"), row["columns"], np.array(row["singular"]))


def _projection(shared):
    @F.pandas_udf("array<double>")
    def project(indices: pd.Series, values: pd.Series) -> pd.Series:
        v = shared.value
        return pd.Series([None if x is None else (x @ v[i]).tolist() if len(x) else [0.0] * v.shape[1] for i, x in zip(indices, values)])

    return project


def _summed(table: DataFrame, at: int, small, width: int) -> np.ndarray:
    """Sum of ``small`` over the matrices (rows x width) in column ``at``, added in one order."""
    schema = arrow_schema("part int, r binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(at)[i].as_py(), dtype=float).reshape(-1, width)
                yield one_row(schema, batch.column(0)[i].as_py(), np.ascontiguousarray(small(x)).tobytes())

    rows = sorted(table.mapInArrow(run, "part int, r binary").collect(), key=lambda r: r["part"])  # one small matrix a slice
    return sum((np.frombuffer(r["r"], dtype=float) for r in rows), np.zeros(1))


def _triangle(images: DataFrame, at: int, width: int, turn: np.ndarray, joins: int = 16) -> np.ndarray:
    """R of the QR decomposition of the matrices in column ``at`` times ``turn``, block by block, then over the tasks."""
    schema = "part long, r binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, turn.shape[1]))
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(at)[i].as_py(), dtype=float).reshape(-1, width)
                r = np.linalg.qr(np.vstack([r, x @ turn]), mode="r")
        yield one_row(arrow, TaskContext.get().partitionId(), r.tobytes())

    def then(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, part = np.zeros((0, turn.shape[1])), TaskContext.get().partitionId()
        for batch in batches:
            for i in range(batch.num_rows):
                r = np.linalg.qr(np.vstack([r, np.frombuffer(batch.column(1)[i].as_py(), dtype=float).reshape(-1, turn.shape[1])]), mode="r")
        yield one_row(arrow, part, r.tobytes())

    rows = images.mapInArrow(first, schema).repartition(joins, F.col("part") % joins).sortWithinPartitions("part").mapInArrow(then, schema)
    parts = [np.frombuffer(r["r"], dtype=float).reshape(-1, turn.shape[1]) for r in sorted(rows.collect(), key=lambda r: r["part"])]
    return np.linalg.qr(np.vstack([np.zeros((1, turn.shape[1])), *parts]), mode="r")


def _straightened(images: DataFrame, at: int, width: int) -> np.ndarray:
    """What the images are multiplied with to have orthonormal columns, fewer where their rank is lower; twice, as once leaves rounding."""
    turn = np.eye(width)
    for _ in range(2):
        _, s, right = np.linalg.svd(_triangle(images, at, width, turn))
        kept = s > 1e-14 * max(s.max(initial=0), 1e-300)
        turn = turn @ (right[:len(s)][kept].T / s[kept])
    return turn


def _first_images(blocks: DataFrame, width: int, seed: int) -> DataFrame:
    schema = arrow_schema(IMAGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, n = batch.column(4)[i].as_py(), len(batch.column(1)[i].as_py()) // 4
                yield one_row(schema, block, np.random.default_rng([seed, block]).standard_normal((n, width)).tobytes())

    return blocks.mapInArrow(run, IMAGES)


def _turned(images: DataFrame, turn: np.ndarray, keys: list[int]) -> DataFrame:
    """(slice, block, images times ``turn``) for every slice."""
    schema = arrow_schema(IMAGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(1)[i].as_py(), dtype=float).reshape(-1, turn.shape[0])
                yield one_row(schema, batch.column(0)[i].as_py(), np.ascontiguousarray(x @ turn).tobytes())

    return images.mapInArrow(run, IMAGES).select(F.explode(F.array(*[F.lit(k) for k in keys])).alias("slice"), "block", "images")


def _transposed(cells: pa.Table, images: pa.Table, columns: int, width: int) -> np.ndarray:
    """A'Y of one slice (its columns x width)."""
    y = {b: np.frombuffer(x, dtype=float).reshape(-1, width) for b, x in zip(*(images.column(j).to_pylist() for j in (1, 2)))}
    out, held, entries = np.zeros((columns, width)), [], 0

    def add() -> None:
        column = np.concatenate([h[0] for h in held])
        for j in range(width):
            out[:, j] += np.bincount(column, np.concatenate([h[1] * y[h[2]][h[3], j] for h in held]), columns)

    for block, _, row, column, values in opened(cells):
        held.append((column, values, block, row))
        entries += len(values)
        if entries >= CHUNK:
            add()
            held, entries = [], 0
    if held:
        add()
    return out


def _groups(turn: np.ndarray, n: int, slices: int, most: int) -> list[np.ndarray]:
    """Columns of the images by groups that a task can hold for all rows, and whose images and products of all slices take ``most`` bytes."""
    cells = n * turn.shape[1]
    return np.array_split(turn, min(turn.shape[1], max(-(-cells // TASK_CELLS), -(-16 * slices * cells // most))), axis=1)


def _joined(parts: DataFrame, key: str, out: str) -> DataFrame:
    """Sums of the rows' data (key, g, slice, rows, data) by key and group, groups side by side."""
    schema = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, groups = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                k, g, rows = (batch.column(j)[i].as_py() for j in (0, 1, 3))
                if k != current and current is not None:
                    yield one_row(schema, current, np.concatenate([groups[x] for x in sorted(groups)], axis=1).tobytes())
                    groups = {}
                current, data = k, np.frombuffer(batch.column(4)[i].as_py(), dtype=float).reshape(rows, -1)
                groups[g] = data.copy() if g not in groups else groups[g] + data
        if current is not None:
            yield one_row(schema, current, np.concatenate([groups[x] for x in sorted(groups)], axis=1).tobytes())

    return parts.sortWithinPartitions(key, "g", "slice").mapInArrow(run, out)


def _passed(
    cells: DataFrame, images: DataFrame, turn: np.ndarray, keys: list[int], columns: int, n: int, most: int, back: bool,
) -> DataFrame:
    """A'Y by slices for the images Y times ``turn``; with ``back``, A A'Y by blocks of rows."""
    kind = "block long, g int, slice int, rows int, data binary" if back else "key int, g int, slice int, rows int, data binary"
    schema, own, parts = arrow_schema(kind), -(-columns // len(keys)), None

    def multiply(g: int, width: int):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            z, key, out = _transposed(left, right, own, width), left.column(0)[0].as_py(), []
            if not back:
                return pa.Table.from_batches([one_row(schema, key, g, key, own, z.tobytes())])
            for block, rows, row, column, values in opened(left):
                product = np.zeros((rows, width))
                add_products(row, column, values, z, product)
                out.append(one_row(schema, block, g, key, rows, product.tobytes()))
            return pa.Table.from_batches(out, schema=schema)

        return run

    name, out = ("block", IMAGES) if back else ("key", "slice int, data binary")
    groups = _groups(turn, n, len(keys), most)
    for g, part in enumerate(groups):
        done = cells.groupBy("slice").cogroup(_turned(images, part, keys).groupBy("slice")).applyInArrow(multiply(g, part.shape[1]), kind)
        done = _joined(done.repartition(len(keys), name), name, out)
        if len(groups) == 1:
            return done
        # One group after the other, so that the files of one lie on disk at a time.
        done = cut_lineage(done)
        key, data = (F.col(c) for c in done.columns)
        free_files(cells.sparkSession, 16 * n * part.shape[1] * len(keys))
        done = done.select(key.alias(name), F.lit(g).alias("g"), F.lit(0).alias("slice"), (F.length(data) / (8 * part.shape[1])).cast("int").alias("rows"),
                           data.alias("data"))
        parts = done if parts is None else parts.unionByName(done)
    return _joined(parts.repartition(len(keys), name), name, out)


def _multiplied(parts: DataFrame, keys: list[int], columns: int, turn: np.ndarray) -> DataFrame:
    """Slices (key, data) times ``turn``, as VECTORS."""
    schema, slices, at = arrow_schema(VECTORS), len(keys), {key: s for s, key in enumerate(keys)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(1)[i].as_py(), dtype=float).reshape(-1, turn.shape[0])
                yield one_row(schema, at[batch.column(0)[i].as_py()], slices, columns, np.ascontiguousarray(x @ turn).tobytes())

    return parts.mapInArrow(run, VECTORS)


def _signs(table: DataFrame, width: int) -> np.ndarray:
    """The sign of every vector's largest entry."""
    schema = arrow_schema("part int, r binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(3)[i].as_py(), dtype=float).reshape(-1, width)
                yield one_row(schema, batch.column(0)[i].as_py(), x[np.abs(x).argmax(axis=0), np.arange(width)].tobytes())

    rows = sorted(table.mapInArrow(run, "part int, r binary").collect(), key=lambda r: r["part"])  # one number a slice and vector
    tops = np.stack([np.frombuffer(r["r"], dtype=float) for r in rows])
    return np.sign(tops[np.abs(tops).argmax(axis=0), np.arange(width)])


def fit_truncated_svd(
    df: DataFrame, columns: int, k: int = 50, features: str = "features", passes: int = PASSES, seed: int = 42,
) -> TruncatedSVD:
    """The k largest singular values of the vectors and their right singular vectors, fewer where the rank is lower.

    Signs are fixed so that the largest entry of each vector is positive. Rows with a NULL vector take no part; without
    rows there are no vectors. Passes over the rows: ``passes`` + 1.
    """
    width = min(k + EXTRA, columns)
    if columns * width > MOST_CELLS:
        raise ValueError(f"{columns} terms are too many for {k} vectors; raise min_df")
    spark = df.sparkSession
    rows, stored = held(df, features), scratch_path(spark, "blocks")
    blocks = stored_blocks(spread(rows), features, size=BLOCK_ENTRIES, numbered=True, path=stored)
    rows.unpersist()
    n, slices, most = slice_count(blocks, columns)
    if not n:
        drop_scratch(spark, stored)
        return TruncatedSVD(spark.createDataFrame([], VECTORS), columns, np.zeros(0))
    keys = slice_keys(spark, slices)
    cells = sliced_cells(blocks, keys)
    images = cut_lineage(_first_images(blocks, width, seed))
    turn = np.eye(width)
    for _ in range(passes):
        images = cut_lineage(_passed(cells, images, turn, keys, columns, n, most, True))
        turn = _straightened(images, 1, turn.shape[1])
        free_files(spark, 16 * n * width * slices)  # those of earlier passes may go
        if not turn.shape[1]:
            break
    path, kept, singular = scratch_path(spark, "vectors"), 0, np.zeros(0)
    if turn.shape[1]:
        own = turn.shape[1]
        parts = cut_lineage(_passed(cells, images, turn, keys, columns, n, most, False))
        _, singular, right = np.linalg.svd(_triangle(parts, 1, own, np.eye(own)))
        kept = min(k, int((singular > 1e-9 * max(singular.max(initial=0), 1e-300)).sum())) if singular.max(initial=0) > 0 else 0
    cells.unpersist()
    drop_scratch(spark, stored)
    if not kept:
        return TruncatedSVD(spark.createDataFrame([], VECTORS), columns, np.zeros(0))
    turn = right[:kept].T / singular[:kept]
    # Small singular values leave rounding between the vectors, which a second step takes out.
    products = TruncatedSVD(_multiplied(parts, keys, columns, turn), columns, singular[:kept]).products()
    turn = turn @ np.linalg.inv(np.linalg.cholesky(products)).T
    turn = turn * _signs(_multiplied(parts, keys, columns, turn), kept)
    _multiplied(parts, keys, columns, turn).write.parquet(path)
    return TruncatedSVD(spark.read.schema(VECTORS).parquet(path), columns, singular[:kept])
