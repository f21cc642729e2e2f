"""Saving and loading fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.clustering import DistributedLDAModel, LDAModel, LocalLDAModel
from pyspark.sql import SparkSession

from ..operators.classify import CalibratedSVM
from ..operators.clusters import Clusters


def save_model(model, path: str) -> str:
    """Write a fitted model (or pipeline) and replace what lies at the path."""
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_topics(path: str) -> LDAModel:
    """A topic model of either optimizer."""
    name = SparkSession.active().read.json(f"{path}/metadata").select("class").first()[0]
    return (DistributedLDAModel if name.endswith("DistributedLDAModel") else LocalLDAModel).load(path)


def load_clusters(path: str) -> Clusters:
    return Clusters.load(path)


def save_calibrated(model: CalibratedSVM, path: str) -> str:
    """The SVM and its sigmoids, side by side."""
    spark = SparkSession.active()
    model.svm.write().overwrite().save(f"{path}/svm")
    rows = [(i, a, b) for i, (a, b) in enumerate(model.sigmoids)]
    spark.createDataFrame(rows, "class int, a double, b double").write.mode("overwrite").parquet(
        f"{path}/sigmoids"
    )
    return path


def load_calibrated(path: str) -> CalibratedSVM:
    spark = SparkSession.active()
    rows = spark.read.parquet(f"{path}/sigmoids").orderBy("class").collect()  # one row per class
    return CalibratedSVM(OneVsRestModel.load(f"{path}/svm"), [(r["a"], r["b"]) for r in rows])
