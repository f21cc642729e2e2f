"""Selection, null handling, derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ratings import binary_label, rating_number, sentiment


def pick(df: DataFrame, **renames: str) -> DataFrame:
    """Select columns under new names: ``pick(df, item='asins')``."""
    return df.select(*[F.col(old).alias(new) for new, old in renames.items()])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or any of the named) columns."""
    return df.dropna(subset=list(subset) if subset else None)


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


def keep_present(df: DataFrame, *names: str) -> DataFrame:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return df.where(condition)


def of_class(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def with_sentiment(
    df: DataFrame, rating: str = "review_rating", out: str = "sentiment",
    fractional: bool = False, drop_null: bool = False,
) -> DataFrame:
    if drop_null:
        df = df.where(rating_number(F.col(rating)).isNotNull())
    return df.withColumn(out, sentiment(F.col(rating), fractional))


def with_binary_label(df: DataFrame, sentiment_class: str = "sentiment", out: str = "label") -> DataFrame:
    return df.withColumn(out, binary_label(F.col(sentiment_class)))


def with_length(df: DataFrame, text: str, out: str = "length") -> DataFrame:
    return df.withColumn(out, F.length(text))


def missing_profile(df: DataFrame) -> DataFrame:
    """NULL-or-empty count of every column, one row per column, in one pass."""
    def missing(name: str) -> Column:
        test = F.col(f"`{name}`").isNull() | (F.col(f"`{name}`").cast("string") == "")
        return F.count_if(test).cast("bigint").alias(name)

    wide = df.agg(*[missing(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("missing")) for c in df.columns]
    )
    return wide.select(F.inline(pairs))


def run_sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """SQL text over registered views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)
