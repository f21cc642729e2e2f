"""What the operators share: row mappers over Arrow batches, scratch tables, column checks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import scratch_path

SLICE = 256  # rows whose texts are Python strings at one time
CHUNK_CHARS = 8_000_000  # rows of an output batch end when their inputs pass this many characters


def need(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that no other column of the input can clash with an output."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def map_rows(
    df: DataFrame, schema: StructType, make: Callable[[], Callable[..., Iterable[tuple]]],
    keep_text: bool = True,
) -> DataFrame:
    """Each row becomes the tuples that the made function yields for it.

    ``make`` runs once per task, so that models and caches are built there. Output
    batches follow the amount of text read, so that memory does not depend on
    the length of single rows beyond the longest one.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                columns = [c.to_pylist() for c in batch.slice(start, SLICE).columns]
                for row in zip(*columns, strict=True):
                    out.extend(fn(*row))
                    size += sum(len(v) for v in row if isinstance(v, (str, bytes))) + 200
                    if size >= CHUNK_CHARS:
                        if out:
                            yield _batch(out, arrow)
                        out, size = [], 0
        if out:
            yield _batch(out, arrow)

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def number_of(fn: Callable[[str], float]) -> Callable[[pa.Array], pa.Array]:
    """A number of every text (NULL: empty) of an Arrow column, a slice at a time."""

    def run(texts: pa.Array) -> pa.Array:
        out = [fn(t or "") for at in range(0, len(texts), SLICE) for t in texts.slice(at, SLICE).to_pylist()]
        return pa.array(out, type=pa.float64())

    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the plan and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
