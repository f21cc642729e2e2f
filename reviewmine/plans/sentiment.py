"""From a review table to a trained, saved and reusable sentiment classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify as M
from ..operators.clean import with_sentiment
from ..operators.evaluate import classification_report, f1_scores
from ..operators.features import fit_vectorizer, label_indexer
from ..operators.linear import CalibratedSVM, fit_calibrated_svm
from ..operators.trees import BoostedTrees, fit_softmax_trees
from ..sources.models import save_model

KINDS = ("logistic", "trees", "svm")


@dataclass
class SentimentModel:
    """Vectorizer, classifier and class names; scores a table or a stream of texts."""

    kind: str
    vectorizer: PipelineModel
    classifier: object
    labels: list[str]

    def score(self, df: DataFrame, out: str = "probabilities") -> DataFrame:
        """Adds ``prediction``, the class ``predicted`` and a {class: probability} map."""
        rows = self.vectorizer.transform(df)
        if self.kind == "logistic":
            rows, column = self.classifier.transform(rows), "probability"
        elif self.kind == "trees":
            rows, column = self.classifier.transform(rows, out="_p"), "_p"
        else:
            rows, column = self.classifier.transform(rows, "_p"), "_p"
        named = M.probability_map(rows, self.labels, column, "_map")
        names = F.array(*[F.lit(x) for x in self.labels])
        return named.select(
            *df.columns, "prediction",
            F.get(names, F.col("prediction").cast("int")).alias("predicted"),
            F.col("_map").alias(out),
        )

    def save(self, path: str) -> str:
        save_model(self.vectorizer, f"{path}/vectorizer")
        if self.kind == "logistic":
            save_model(self.classifier, f"{path}/classifier")
        else:
            self.classifier.save(f"{path}/classifier")
        spark = SparkSession.active()
        rows = [(self.kind, i, x) for i, x in enumerate(self.labels)]
        spark.createDataFrame(rows, "kind string, index int, label string").write.mode(
            "overwrite"
        ).parquet(f"{path}/labels")
        return path

    @staticmethod
    def load(path: str) -> SentimentModel:
        spark = SparkSession.active()
        rows = spark.read.parquet(f"{path}/labels").orderBy("index").collect()  # one row per class
        kind = rows[0]["kind"]
        readers = {"logistic": LogisticRegressionModel.load, "trees": BoostedTrees.load, "svm": CalibratedSVM.load}
        return SentimentModel(
            kind, PipelineModel.load(f"{path}/vectorizer"), readers[kind](f"{path}/classifier"),
            [r["label"] for r in rows],
        )


def train_sentiment(
    reviews: DataFrame, key: str, text: str = "review_text", rating: str = "review_rating",
    kind: str = "logistic", size: int = 5000, train_percent: int = 70, seed: int = 42, **settings,
) -> tuple[SentimentModel, DataFrame]:
    """Fit on the training part, return the model and the scored test part (label, prediction)."""
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    rows = with_sentiment(reviews, rating).where(F.col(text).isNotNull()).select(key, text, "sentiment")
    vectorizer, terms = fit_vectorizer(rows, text, size)
    indexer, _ = label_indexer(rows, "sentiment")
    train, test = M.split_rows(indexer.transform(rows), key, train_percent, seed)
    vectors = vectorizer.transform(train).select(key, "label", "features").persist()
    if kind == "logistic":
        classifier = M.fit_multinomial_lr(vectors, **settings)
    elif kind == "trees":
        classifier = fit_softmax_trees(vectors, len(indexer.labels), len(terms), **settings)
    else:
        folds = settings.pop("folds", 5)
        fold = M.row_bucket(vectors.select(key), key, seed, folds)
        classifier = fit_calibrated_svm(
            vectors, len(terms), len(indexer.labels), fold, folds, passes=settings.pop("max_iter", 100), **settings)
    vectors.unpersist()
    model = SentimentModel(kind, vectorizer, classifier, list(indexer.labels))
    return model, model.score(test)


def report(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classification report and the micro, macro and weighted F1 of scored test rows."""
    named = scored.select(F.col("sentiment").alias("label"), F.col("predicted").alias("prediction"))
    return classification_report(named), f1_scores(named)
