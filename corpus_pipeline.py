"""From raw documents to packed sequences: quality, toxicity, near duplicates, personal data, packing.

Every stage gets what the one before it kept, as a table in the shared folder, and returns documents with
all their columns; the last returns the pieces of the sequences. Models are fitted on the labelled rows that
reached their stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmine.llm import neardup, packing, pii, quality, toxicity
from reviewmine.llm.common import stored, table
from reviewmine.llm.queries import TOKENIZER


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least one half."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain does not reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group at five-word similarity 0.8.

    Documents without words are no duplicates and stay.
    """
    dropped = neardup.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["_dropped"], "left_anti")


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by its kind; n_chars follows where the table has it."""
    masked = pii.mask_documents(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.length("text").cast(kind))
    return masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", no_near_duplicates),
    ("personal_data", no_personal_data),
    ("packing", packed),
]

# Trained models and tokenizers cannot be expressed in SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
