"""Global order without a one-task window: dense index and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the lower 33 bits


def _sorted_slices(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-sorted rows that remember their slice and their place in it.

    The checkpoint fixes the slices: both the totals and the rows read the same
    stored result, even when a task is run again elsewhere.
    """
    ordered = df.orderBy(*order).select(
        "*",
        F.spark_partition_id().alias("_slice"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"),
    )
    return cut_lineage(ordered)


def _with_offsets(slices: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Attach to each row the totals of all slices before its own (one row per slice)."""
    per_slice = slices.groupBy("_slice").agg(*[v.alias(k) for k, v in totals.items()])
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        "_slice",
        *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_before_{k}") for k in totals],
    )
    return slices.join(F.broadcast(offsets), "_slice")  # bounded by the partition count


def global_index(df: DataFrame, order: Sequence[Column], index: str = "index") -> DataFrame:
    """Dense index 0..n-1 in the given (total) order."""
    slices = _sorted_slices(df, order)
    placed = _with_offsets(slices, {"n": F.count("*")})
    return placed.withColumn(index, F.col("_before_n") + F.col("_place")).drop(
        "_slice", "_place", "_before_n"
    )


def running_totals(
    df: DataFrame, order: Sequence[Column], columns: Sequence[str], prefix: str = "cum_"
) -> DataFrame:
    """Sums of ``columns`` over all rows up to and including each row."""
    slices = _sorted_slices(df, order)
    placed = _with_offsets(slices, {c: F.sum(c) for c in columns})
    within = (
        Window.partitionBy("_slice")
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = placed.withColumns(
        {f"{prefix}{c}": F.sum(c).over(within) + F.col(f"_before_{c}") for c in columns}
    )
    return out.drop("_slice", "_place", *[f"_before_{c}" for c in columns])
