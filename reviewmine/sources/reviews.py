"""Review files: read, write, flatten, nest, preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FILE_SCHEMA, PRODUCT_FIELDS, REVIEW_COLUMNS, REVIEW_FIELDS, to_dotted, to_flat

# What a missing list element becomes in the flat file.
PADDING = {"numHelpful": 0, "rating": 0.0}


# Line breaks stand in files as this sign and a letter, so that every row is one line; the sign itself as sign and "e".
SIGN = "\u241b"
ESCAPES = {SIGN: f"{SIGN}e", "\n": f"{SIGN}n", "\r": f"{SIGN}r"}


def escaped(column: Column) -> Column:
    for plain, written in ESCAPES.items():
        column = F.replace(column, F.lit(plain), F.lit(written))
    return column


def unescaped(column: Column) -> Column:
    whole = column
    for plain, written in reversed(ESCAPES.items()):
        whole = F.replace(whole, F.lit(written), F.lit(plain))
    return F.when(F.contains(column, F.lit(SIGN)), whole).otherwise(column)


def read_reviews(
    spark: SparkSession, path: str, multi_line: bool = False, fmt: str = "csv"
) -> DataFrame:
    """Review table with flat column names, every field as text; line breaks come back as ``write_reviews`` found them.

    ``multi_line`` accepts line breaks within quotes, for files of other writers; each such file is read by one task.
    """
    if fmt == "parquet":
        return to_flat(spark.read.parquet(path))
    reader = (
        spark.read.schema(FILE_SCHEMA)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    rows = reader.csv(path)
    return to_flat(rows.select(*[unescaped(F.col(f"`{c}`")).alias(c) for c in rows.columns]))


def write_reviews(df: DataFrame, path: str, mode: str = "overwrite", max_rows: int = 1_000_000) -> None:
    """The 22 columns in file order, UTF-8, with header; arrays joined by commas, line breaks escaped.

    An empty text is written as nothing, so a reader sees NULL. A file holds at most ``max_rows`` rows.
    """
    dotted = to_dotted(df)
    columns = []
    for name in REVIEW_COLUMNS:
        if name not in dotted.columns:
            columns.append(F.lit("").alias(name))
            continue
        column = F.col(f"`{name}`")
        if isinstance(dotted.schema[name].dataType, T.ArrayType):
            joined = F.array_join(column, ",")
            column = F.concat(F.lit("["), joined, F.lit("]")) if name == "categories" else joined
        columns.append(escaped(column.cast("string")).alias(name))
    (
        dotted.select(*columns)
        .write.mode(mode)
        .option("header", True)
        .option("maxRecordsPerFile", max_rows)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def flatten_reviews(products: DataFrame) -> DataFrame:
    """Parallel arrays per product to one row per review.

    The array of review ids sets the number of rows; shorter arrays are padded.
    A product without reviews keeps one row with blank review fields.
    """
    arrays = [f"review_{f}" for f in REVIEW_FIELDS if f"review_{f}" in products.columns]
    others = [c for c in products.columns if c not in arrays]
    ids = F.coalesce(F.size("review_id"), F.lit(0))
    trimmed = F.slice(F.arrays_zip(*arrays), F.lit(1), F.greatest(ids, F.lit(0)))
    rows = products.select(*others, F.posexplode_outer(trimmed).alias("_pos", "_review"))

    def field(name: str):
        value = F.col(f"_review.{name}")
        key = name.removeprefix("review_")
        if name == "review_dateSeen":
            value = F.array_join(value, ",")
        blank = F.lit(str(PADDING[key])) if key in PADDING else F.lit("")
        text = F.coalesce(value.cast("string"), blank)
        return F.when(F.col("_pos").isNull(), F.lit("")).otherwise(text).alias(name)

    return rows.select(*others, *[field(a) for a in arrays])


def nest_reviews(reviews: DataFrame, order: str = "review_id", parts: int = 1) -> DataFrame:
    """Flat reviews to parallel arrays per product, in the order of one column.

    Every product is one row (``part`` 0). Where products may be too large for a row, ``parts`` spreads each
    over up to that many rows by a hash of the order column, whatever its size; ``flatten_reviews`` reads both
    alike. Product fields take their smallest value.
    """
    fields = [f"review_{f}" for f in REVIEW_FIELDS if f"review_{f}" in reviews.columns]
    product_fields = [c for c in PRODUCT_FIELDS if c in reviews.columns and c != "id"]
    part = F.pmod(F.xxhash64(order), F.lit(parts)).cast("int")
    entry = F.struct(F.col(order).alias("_order"), *fields)
    grouped = reviews.withColumn("part", part).groupBy("id", "part").agg(
        *[F.min(c).alias(c) for c in product_fields],
        F.sort_array(F.collect_list(entry)).alias("_reviews"),
    )
    return grouped.select(
        "id", "part", *product_fields, *[F.col(f"_reviews.{f}").alias(f) for f in fields]
    )


def preview(df: DataFrame, n: int = 20, order: str | None = None) -> DataFrame:
    """First n rows, in a fixed order where one is named."""
    return (df.orderBy(order) if order else df).limit(n)


def describe_columns(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types, as a schema print shows them."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
