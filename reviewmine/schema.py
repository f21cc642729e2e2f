"""The review table: column order, types and the flat names used inside the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header of the review file, in file order.
REVIEW_COLUMNS = [
    "id", "name", "asins", "brand", "categories", "manufacturer",
    "price", "rating", "review_count",
    "reviews.date", "reviews.dateAdded", "reviews.dateSeen",
    "reviews.doRecommend", "reviews.id", "reviews.numHelpful",
    "reviews.rating", "reviews.sourceURLs", "reviews.text",
    "reviews.title", "reviews.userCity", "reviews.userProvince",
    "reviews.username",
]

PRODUCT_FIELDS = [c for c in REVIEW_COLUMNS if not c.startswith("reviews.")]
REVIEW_FIELDS = [c.split(".", 1)[1] for c in REVIEW_COLUMNS if c.startswith("reviews.")]

# As stored in a file every field is text; typed values come from ``typed_reviews``.
FILE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in REVIEW_COLUMNS])

REVIEW_TYPES = {
    "date": "string",
    "dateAdded": "string",
    "dateSeen": "array<string>",
    "doRecommend": "boolean",
    "id": "string",
    "numHelpful": "int",
    "rating": "double",
    "sourceURLs": "string",
    "text": "string",
    "title": "string",
    "userCity": "string",
    "userProvince": "string",
    "username": "string",
}


def flat_name(column: str) -> str:
    """``reviews.text`` -> ``review_text``; names without a dot stay."""
    return column.replace("reviews.", "review_", 1)


FLAT_NAMES = {c: flat_name(c) for c in REVIEW_COLUMNS}
DOTTED_NAMES = {v: k for k, v in FLAT_NAMES.items()}


def to_flat(df: DataFrame) -> DataFrame:
    """Rename dotted columns once, at ingest, so nothing downstream needs backticks."""
    return df.select(*[F.col(f"`{c}`").alias(FLAT_NAMES.get(c, c)) for c in df.columns])


def to_dotted(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(DOTTED_NAMES.get(c, c)) for c in df.columns])


def typed_reviews(df: DataFrame) -> DataFrame:
    """Typed view of a flat all-text review table; malformed values become NULL."""
    return df.withColumns(
        {
            "categories": F.when(
                F.col("categories").isin("", "[]"), F.array().cast("array<string>")
            ).otherwise(F.split(F.regexp_replace("categories", r"^\[|\]$|'", ""), r",\s*")),
            "review_dateAdded": F.try_to_timestamp("review_dateAdded"),
            "review_dateSeen": F.split("review_dateSeen", ","),
            "review_doRecommend": F.col("review_doRecommend").try_cast("boolean"),
            "review_numHelpful": F.col("review_numHelpful").try_cast("int"),
            "review_rating": F.col("review_rating").try_cast("double"),
        }
    )
