"""Metrics as plain aggregations over (label, prediction, score) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import running_totals


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE and R² in one pass; R² from moments, 1 - SSE / SST."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    known = df.where(y.isNotNull() & p.isNotNull())
    sums = known.agg(
        F.count("*").alias("n"),
        F.sum((y - p) * (y - p)).alias("sse"),
        F.var_pop(y).alias("var"),
    )
    return sums.select(
        "n",
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        (1 - F.try_divide(F.col("sse"), F.col("n") * F.col("var"))).alias("r2"),
    )


def error_rate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg(F.abs(F.col(label) - F.col(prediction))).alias("error_rate"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of labelled rows predicted right; as in the other reports, a NULL prediction is a miss."""
    hit = F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("int")
    return df.where(F.col(label).isNotNull()).agg(F.avg(hit).alias("accuracy"))


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: list | None = None
) -> DataFrame:
    """Actual classes as rows, predicted as columns, zeros filled.

    Naming the classes saves the pass that looks them up.
    """
    grouped = df.groupBy(F.col(label).alias("actual")).pivot(prediction, classes)
    return grouped.agg(F.count(F.lit(1))).fillna(0)


def _class_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    counts = confusion_counts(df, label, prediction)
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").alias("class"), F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        )
    )
    sums = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    p = F.coalesce(F.try_divide(F.col("hits"), F.col("predicted")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("hits"), F.col("support")), F.lit(0.0))
    f = F.coalesce(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("predicted")), F.lit(0.0))
    return sums.select(
        F.col("class").cast("string").alias("class"),
        p.alias("precision"), r.alias("recall"), f.alias("f1"), "support", "hits",
    )


def f1_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Micro, macro and weighted F1 (micro equals accuracy with one class per row)."""
    return _class_scores(df, label, prediction).agg(
        (F.sum("hits") / F.sum("support")).alias("f1_micro"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted rows."""
    scores = _class_scores(df, label, prediction)
    measures = ["precision", "recall", "f1"]
    support = F.sum("support").alias("support")
    right = F.sum("hits") / F.sum("support")
    total = scores.agg(
        F.struct(F.lit("accuracy").alias("class"), *[right.alias(m) for m in measures], support).alias("a"),
        F.struct(
            F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], support
        ).alias("b"),
        F.struct(
            F.lit("weighted avg").alias("class"),
            *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures],
            support,
        ).alias("c"),
    )
    rows = total.select(F.inline(F.array("a", "b", "c")))
    return scores.drop("hits").unionByName(rows)


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, highest first.

    Equal scores are counted into one row before anything is sorted, and the
    cumulative counts are range-partitioned, so no task sees the whole table.
    """
    counts = _score_counts(df, label, score)
    curve = running_totals(counts, [F.desc("threshold")], ["pos", "neg"])
    all_pos, all_neg = curve.agg(F.sum("pos"), F.sum("neg")).first()
    return curve.select(
        "threshold",
        F.try_divide(F.col("cum_neg"), F.lit(all_neg)).alias("fpr"),
        F.try_divide(F.col("cum_pos"), F.lit(all_pos)).alias("tpr"),
    )


def area_under_roc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area by the trapezoid rule; NULL where a class is missing."""
    counts = _score_counts(df, label, score)
    curve = running_totals(counts, [F.desc("threshold")], ["pos", "neg"])
    # A step adds neg * (positives above + half of those tied with it).
    step = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2)
    return curve.agg(
        F.try_divide(F.sum(step), F.sum("pos") * F.sum("neg")).alias("auc")
    )


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    # A row without score has no threshold and takes no part; one without label counts in neither class.
    return df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
        F.sum((F.col(label) != 1).cast("bigint")).alias("neg"),
    )
