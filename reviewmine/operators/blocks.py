"""Sparse vectors packed into blocks of rows for solvers that pass over them many times."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import scratch_path

BLOCK_ENTRIES = 1_000_000
TASK_ROWS = 2048  # rows that are worth a task of their own

BLOCK = "extra binary, sizes binary, columns binary, values binary"


def sparse_entries(df: DataFrame, features: str) -> DataFrame:
    """Columns _i and _v: indices and values of the vectors, dense ones with all their values."""
    v = F.unwrap_udt(F.col(features))
    whole = F.transform(v["values"], lambda x, i: i)
    return df.withColumn("_i", F.coalesce(v["indices"], whole)).withColumn("_v", v["values"])


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt to as many tasks as are worth it, where fewer partitions hold them; for narrow vectors, never texts.

    Counts the rows, so they should be persisted.
    """
    most = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(most, df.count() // TASK_ROWS))
    held = df.rdd.getNumPartitions()
    return df if held >= most == tasks else df if held == tasks else df.repartition(tasks)


def held(df: DataFrame, *columns: str) -> DataFrame:
    """The columns, persisted unless the table is: a second copy would push the first to disk."""
    level, own = df.storageLevel, df.select(*columns)
    return own if level.useMemory or level.useDisk else own.persist()


def stored_blocks(
    df: DataFrame, features: str, extra: Sequence[str] = (), size: int | None = None, numbered: bool = False, path: str | None = None,
) -> DataFrame:
    """Blocks of rows with a vector, written to the shared folder: ``extra`` numeric columns as float64, row sizes, columns, values.

    Zeros and NaN are left out of the entries. ``size`` entries close a block (BLOCK_ENTRIES); ``numbered`` adds the column ``block``.
    """
    most = size or BLOCK_ENTRIES
    schema = to_arrow_schema(StructType.fromDDL(BLOCK))
    k = len(extra)

    def pack(rows: list[list[np.ndarray]]) -> pa.RecordBatch:
        numbers = np.concatenate([np.stack(r[:k], axis=1) if k else np.zeros((len(r[k]), 0)) for r in rows])
        sizes, columns, values = (np.concatenate([r[k + j] for r in rows]) for j in range(3))
        here = (values != 0) & ~np.isnan(values)
        row = np.repeat(np.arange(len(sizes)), sizes)[here]
        parts = [numbers.astype(np.float64), np.bincount(row, minlength=len(sizes)).astype(np.int32), columns[here].astype(np.int32), values[here]]
        return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], type=pa.binary()) for p in parts], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                part = whole.slice(at, 1024)
                numbers = [part.column(j).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(k)]
                sizes = np.diff(part.column(k).offsets.to_numpy())
                indices, values = (part.column(k + j).flatten().to_numpy(zero_copy_only=False) for j in range(2))
                held.append([*numbers, sizes, indices.astype(np.int64), values.astype(np.float64)])
                entries += len(values) + len(sizes)
                if entries >= most:
                    yield pack(held)
                    held, entries = [], 0
        if held:
            yield pack(held)

    rows = sparse_entries(df.where(F.col(features).isNotNull()), features).select(*extra, "_i", "_v").mapInArrow(run, BLOCK)
    if numbered:
        rows = rows.withColumn("block", F.monotonically_increasing_id())
    path = path or scratch_path(df.sparkSession, "blocks")
    rows.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def squeezed(x: np.ndarray) -> bytes:
    """Numbers compressed, their bytes of like weight side by side."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), codec="zstd", asbytes=True)


def unsqueezed(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).reshape(-1).view(kind)


class SparseRows:
    """One block: rows times a matrix, and the transpose times a matrix."""

    def __init__(self, batch: pa.RecordBatch, i: int, extras: int = 0):
        kinds = (np.float64, np.int32, np.int32, np.float64)
        numbers, self.sizes, self.columns, self.values = (np.frombuffer(batch.column(c)[i].as_py(), dtype=k) for c, k in enumerate(kinds))
        self.numbers = numbers.reshape(len(self.sizes), extras)
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])

    def __len__(self) -> int:
        return len(self.sizes)

    def times(self, matrix: np.ndarray) -> np.ndarray:
        out, full = np.zeros((matrix.shape[1], len(self))), np.flatnonzero(self.sizes)
        if len(full):
            for j, column in enumerate(np.ascontiguousarray(matrix.T)):
                out[j, full] = np.add.reduceat(self.values * column.take(self.columns), self.ends[full])
        return out.T

    def transposed_times(self, matrix: np.ndarray, out: np.ndarray) -> None:
        """Adds to ``out`` (columns x width)."""
        known, places = np.unique(self.columns, return_inverse=True)
        sums = np.empty((len(known), matrix.shape[1]))
        for j, column in enumerate(np.ascontiguousarray(matrix.T)):
            sums[:, j] = np.bincount(places, self.values * np.repeat(column, self.sizes), len(known))
        out[known] += sums


def summed(df: DataFrame, cells: int, ranges: int) -> np.ndarray:
    """Sum of (range int, part long, data binary) rows: float64 arrays of equal length, cut into ranges; ``cells`` numbers in all."""
    schema = to_arrow_schema(StructType.fromDDL("range int, data binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                r, data = batch.column(0)[i].as_py(), np.frombuffer(batch.column(2)[i].as_py(), dtype=np.float64)
                if r != current and current is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([current], type=pa.int32()), pa.array([total.tobytes()], type=pa.binary())], schema=schema)
                    total = None
                current, total = r, data.copy() if total is None else total + data
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], type=pa.int32()), pa.array([total.tobytes()], type=pa.binary())], schema=schema)

    # Parts are added in the order of their tasks, so that equal inputs give equal sums.
    rows = df.repartition(ranges, "range").sortWithinPartitions("range", "part").mapInArrow(run, "range int, data binary").collect()
    out = [np.frombuffer(r["data"], dtype=np.float64) for r in sorted(rows, key=lambda r: r["range"])]
    return np.concatenate(out) if out else np.zeros(cells)


def in_ranges(total: np.ndarray, ranges: int, part: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A task's array as rows for ``summed``."""
    for r, data in enumerate(np.array_split(total.ravel(), ranges)):
        columns = [pa.array([r], type=pa.int32()), pa.array([part], type=pa.int64()), pa.array([data.tobytes()], type=pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


PART = "range int, part long, data binary"
