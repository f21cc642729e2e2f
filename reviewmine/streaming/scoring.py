"""Scoring texts as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.classify import scorable


def read_text_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                     max_files: int | None = None, pattern: str | None = None) -> DataFrame:
    """Files that arrive in a folder; ``pattern`` picks them by name."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def score_texts(df: DataFrame, text: str, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score the non-blank rows of a batch table or a stream; the same plan for both."""
    return score(scorable(df, text))


def write_scores(scored: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append scores to files; one run takes everything that has arrived, then stops.

    The query keeps no state, so no watermark is needed; file sink and
    checkpoint give each row exactly once.
    """
    return (
        scored.writeStream.format(fmt).outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
