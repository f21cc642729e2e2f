"""Sentiment classifiers and the scoring of texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    LogisticRegressionModel,
    OneVsRest,
    OneVsRestModel,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ratings import seeded_bucket
from .features import hashing_stages


def row_bucket(df: DataFrame, key: str, seed: int, buckets: int = 100) -> Column:
    """Seeded bucket of the key, or of the whole row where the key is NULL."""
    others = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]
    return F.coalesce(
        seeded_bucket(F.col(key), seed, buckets), F.pmod(F.xxhash64(F.lit(seed), *others), F.lit(buckets)).cast("int"))


def split_rows(df: DataFrame, key: str, train_percent: int = 70, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a seeded hash of the key; no shuffle, any engine agrees.

    Rows with a NULL key go by a hash of their other columns, so that every row is in one part.
    """
    bucket = row_bucket(df, key, seed)
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def fit_hashing_lr(df: DataFrame, text: str = "text", max_iter: int = 10, reg: float = 0.01,
                   buckets: int = 1 << 18) -> PipelineModel:
    """Binary classifier on hashed TF-IDF; NULL texts are left out, as the tokenizer needs.

    The hashed counts are kept while idf and classifier are fitted, so the texts
    are read and tokenized once.
    """
    tokenizer, hashing, idf = hashing_stages(text, buckets=buckets)
    rows = df.where(F.col(text).isNotNull()).select(text, "label")
    hashed = hashing.transform(tokenizer.transform(rows)).select("label", hashing.getOutputCol()).persist()
    weights = idf.fit(hashed)
    lr = LogisticRegression(maxIter=max_iter, regParam=reg)
    model = PipelineModel([tokenizer, hashing, weights, lr.fit(weights.transform(hashed))])
    hashed.unpersist()
    return model


def fit_multinomial_lr(df: DataFrame, max_iter: int = 1000, c: float = 1.0, n: int | None = None) -> LogisticRegressionModel:
    """Multinomial logistic regression; penalty C per row equals 1 / (C n) on the mean loss."""
    n = n or df.count()
    return LogisticRegression(
        family="multinomial", maxIter=max_iter, regParam=1.0 / (c * n), standardization=False
    ).fit(df)


def fit_boosted_trees(df: DataFrame, rounds: int = 100, depth: int = 6, eta: float = 0.3,
                      seed: int = 42, parallelism: int = 3) -> OneVsRestModel:
    """One boosted-tree model per class."""
    trees = GBTClassifier(maxDepth=depth, stepSize=eta, maxIter=rounds, seed=seed)
    return OneVsRest(classifier=trees, parallelism=parallelism).fit(df)


def fit_svm(df: DataFrame, max_iter: int = 100, c: float = 1.0, n: int | None = None,
            parallelism: int = 3) -> OneVsRestModel:
    """One linear SVM per class."""
    n = n or df.count()
    svm = LinearSVC(maxIter=max_iter, regParam=1.0 / (c * n), standardization=False)
    return OneVsRest(classifier=svm, parallelism=parallelism).fit(df)


def score_classes(model: OneVsRestModel, df: DataFrame) -> DataFrame:
    """``margins`` array<double>, one per class, and the ``prediction`` of the largest.

    Runs the class models one after the other inside the JVM; the stock
    transform of a one-vs-rest model would send each row through Python.
    """
    scored, columns = df, []
    for i, one in enumerate(model.models):
        raw = f"_raw{i}"
        named = one.copy({one.rawPredictionCol: raw, one.predictionCol: f"_class{i}"})
        if named.hasParam("probabilityCol"):
            named = named.copy({named.getParam("probabilityCol"): ""})
        scored = named.transform(scored).drop(f"_class{i}")
        columns.append(raw)
    margins = F.array(*[F.get(vector_to_array(c), F.lit(1)) for c in columns])
    scored = scored.withColumn("margins", margins).drop(*columns)
    best = F.array_position("margins", F.array_max("margins")) - 1
    return scored.withColumn("prediction", best.cast("double"))


def sigmoid_shares(margins: Column, sigmoids: Sequence[tuple[float, float]]) -> Column:
    """1 / (1 + exp(-(a m + b))) per class, scaled to sum 1."""
    odds = F.array(
        *[1 / (1 + F.exp(-(a * F.get(margins, F.lit(i)) + b))) for i, (a, b) in enumerate(sigmoids)]
    )
    total = F.aggregate(odds, F.lit(0.0), lambda x, y: x + y)
    return F.transform(odds, lambda o: o / total)


def tree_probabilities(scored: DataFrame, k: int, out: str = "probabilities") -> DataFrame:
    """Margins of boosted trees to class shares; factor 2 is the link of their log loss."""
    return scored.withColumn(out, sigmoid_shares(F.col("margins"), [(2.0, 0.0)] * k))


class CalibratedSVM:
    """One-vs-rest SVM with a sigmoid per class, learned on out-of-fold margins."""

    def __init__(self, svm: OneVsRestModel, sigmoids: list[tuple[float, float]]):
        self.svm = svm
        self.sigmoids = sigmoids

    def transform(self, df: DataFrame, out: str = "probabilities") -> DataFrame:
        scored = score_classes(self.svm, df)
        return scored.withColumn(out, sigmoid_shares(F.col("margins"), self.sigmoids))


def fit_calibrated_svm(df: DataFrame, key: str, k: int, folds: int = 5, max_iter: int = 100,
                       seed: int = 42) -> CalibratedSVM:
    """Fold = seeded hash of the key. Targets are smoothed by the class sizes (Platt)."""
    fold = row_bucket(df, key, seed, folds)
    rows = df.withColumn("_fold", fold)
    held = None
    for i in range(folds):
        model = fit_svm(rows.where(F.col("_fold") != i), max_iter)
        part = score_classes(model, rows.where(F.col("_fold") == i)).select(
            F.col("label").alias("_class"), F.col("margins").alias("_margins")
        )
        held = part if held is None else held.unionByName(part)
    held = held.persist()
    counts = {r["_class"]: r["n"] for r in held.groupBy("_class").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    sigmoids = []
    for i in range(k):
        pos = counts.get(float(i), 0)
        high, low = (pos + 1.0) / (pos + 2.0), 1.0 / (total - pos + 2.0)
        target = F.when(F.col("_class") == i, high).otherwise(low)
        weighted = held.select(
            F.get("_margins", F.lit(i)).alias("_margin"),
            F.explode(
                F.array(
                    F.struct(F.lit(1.0).alias("label"), target.alias("weight")),
                    F.struct(F.lit(0.0).alias("label"), (1 - target).alias("weight")),
                )
            ).alias("_t"),
        ).select("_margin", "_t.label", "_t.weight")
        assembled = VectorAssembler(inputCols=["_margin"], outputCol="features").transform(weighted)
        fit = LogisticRegression(weightCol="weight").fit(assembled)
        sigmoids.append((float(fit.coefficients[0]), float(fit.intercept)))
    held.unpersist()
    return CalibratedSVM(fit_svm(df, max_iter), sigmoids)


def probability_map(scored: DataFrame, labels: Sequence[str], column: str = "probability",
                    out: str = "probabilities") -> DataFrame:
    """{class: probability} per row, from a probability vector or array."""
    is_array = scored.schema[column].dataType.typeName() == "array"
    values = F.col(column) if is_array else vector_to_array(column)
    names = F.array(*[F.lit(x) for x in labels])
    return scored.withColumn(out, F.map_from_arrays(names, values))


def scorable(df: DataFrame, text: str) -> DataFrame:
    """Rows with something to score: neither NULL nor blank."""
    return df.where(F.col(text).isNotNull() & (F.trim(F.col(text)) != ""))


def top_features(model: OneVsRestModel, terms: Sequence[str], n: int = 15) -> list[tuple[str, float]]:
    """Mean gain-based importance over the class models, strongest first."""
    total: dict[int, float] = {}
    for one in model.models:
        importance = one.featureImportances
        for i, value in zip(importance.indices, importance.values):
            total[int(i)] = total.get(int(i), 0.0) + float(value) / len(model.models)
    ranked = sorted(total.items(), key=lambda item: (-item[1], terms[item[0]]))
    return [(terms[i], value) for i, value in ranked[:n]]


def search_lr(df: DataFrame, regs=(0.01, 0.1), folds: int = 5, max_iter: int = 10, seed: int = 0,
              parallelism: int = 2) -> tuple[LogisticRegressionModel, list[dict]]:
    """K-fold search over the penalty by accuracy."""
    lr = LogisticRegression(maxIter=max_iter)
    grid = ParamGridBuilder().addGrid(lr.regParam, list(regs)).build()
    measure = MulticlassClassificationEvaluator(metricName="accuracy")
    fitted = CrossValidator(
        estimator=lr, estimatorParamMaps=grid, evaluator=measure, numFolds=folds, seed=seed,
        parallelism=parallelism,
    ).fit(df)
    table = [
        {**{p.name: v for p, v in setting.items()}, "accuracy": float(metric)}
        for setting, metric in zip(grid, fitted.avgMetrics)
    ]
    return fitted.bestModel, table
