"""Topics and clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clusters import fit_clusters  # noqa: F401
from .joins import lookup_join
from .stats import top_per_group


def fit_topics(
    vectors: DataFrame, features: str = "features", k: int = 10, max_iter: int = 20, seed: int = 42
) -> LDAModel:
    return LDA(
        k=k, maxIter=max_iter, optimizer="online", seed=seed, featuresCol=features
    ).fit(vectors)


def topic_words(model: LDAModel, terms: Sequence[str], n: int = 15) -> DataFrame:
    """(topic, rank, term, weight) of the strongest terms."""
    rows = model.describeTopics(n).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("_pos", "_t")
    )
    spark = rows.sparkSession
    table = spark.createDataFrame(list(enumerate(terms)), "_index int, term string")
    named = rows.select(
        "topic", (F.col("_pos") + 1).alias("rank"),
        F.col("_t.termIndices").alias("_index"), F.col("_t.termWeights").alias("weight"),
    )
    return lookup_join(named, table, ["_index"], salt_by=["topic"]).select("topic", "rank", "term", "weight")


def dominant_topic(model: LDAModel, vectors: DataFrame, out: str = "topic") -> DataFrame:
    shares = model.transform(vectors).withColumn("_shares", vector_to_array("topicDistribution"))
    best = F.array_position("_shares", F.array_max("_shares")) - 1
    return shares.withColumn(out, best.cast("int")).withColumn(
        "share", F.array_max("_shares")
    ).drop("_shares")


def cluster_words(
    weights: DataFrame, clusters: DataFrame | None, key: str, cluster: str = "cluster", n: int = 15
) -> DataFrame:
    """Strongest terms per cluster by summed weight, from (key, term, weight) rows.

    Rows that carry their cluster need no ``clusters`` (key, cluster); then only sums per cluster and term are shuffled.
    """
    rows = weights if clusters is None else weights.join(clusters.select(key, cluster), key)
    sums = rows.groupBy(cluster, "term").agg(F.round(F.sum("weight"), 6).alias("weight"))
    return top_per_group(sums, cluster, "term", "weight", n)
