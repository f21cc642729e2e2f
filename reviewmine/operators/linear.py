"""Many linear SVMs over the same rows, fitted side by side.

Classes, folds and penalties are columns of one weight matrix. A step is one pass: every task multiplies its blocks of
sparse rows with the whole matrix and adds up losses and gradients of all models, which meet by ranges of
columns. The driver keeps the matrix and a short history (L-BFGS) and moves each model at its own pace.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .blocks import PART, SparseRows, in_ranges, sparse_entries, spread, stored_blocks, summed

HISTORY = 8
RANGE_CELLS = 1 << 18
MOST_CELLS = 1 << 25  # numbers of the weight matrix
SUFFICIENT = 1e-4  # share of the promised decrease that a step must bring


@dataclass(frozen=True)
class Problem:
    """One class against the others, trained on all folds but one (-1: on all), with its penalty."""

    label: int
    left_out: int = -1
    c: float = 1.0


class LinearModels:
    """Weights (columns + 1 x models; the last row are the intercepts) with their problems."""

    def __init__(self, problems: Sequence[Problem], weights: np.ndarray):
        self.problems, self.weights = list(problems), weights

    def picked(self, left_out: int = -1) -> LinearModels:
        own = [j for j, p in enumerate(self.problems) if p.left_out == left_out]
        return LinearModels([self.problems[j] for j in own], self.weights[:, own])

    def margins(self, df: DataFrame, features: str = "features", out: str = "margins") -> DataFrame:
        """Adds one margin per model, inside the row; NULL for a NULL vector."""
        shared = df.sparkSession.sparkContext.broadcast(self.weights)  # at most MOST_CELLS numbers

        @F.pandas_udf("array<double>")
        def score(indices: pd.Series, values: pd.Series) -> pd.Series:
            w = shared.value
            return pd.Series([None if v is None else (v @ w[i] + w[-1] if len(v) else w[-1]).tolist() for i, v in zip(indices, values)])

        return sparse_entries(df, features).withColumn(out, score("_i", "_v")).drop("_i", "_v")

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``margins`` per class and the ``prediction`` of the largest."""
        scored = self.margins(df, features)
        return scored.withColumn("prediction", (F.array_position("margins", F.array_max("margins")) - 1).cast("double"))

    def save(self, path: str) -> str:
        spark = SparkSession.active()
        spark.createDataFrame([(j, p.label, p.left_out, p.c) for j, p in enumerate(self.problems)],
                              "model int, label int, left_out int, c double").write.mode("overwrite").parquet(f"{path}/problems")
        spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(self.weights)],
                              "row int, weights array<double>").write.mode("overwrite").parquet(f"{path}/weights")
        return path

    @staticmethod
    def load(path: str) -> LinearModels:
        spark = SparkSession.active()
        problems = spark.read.parquet(f"{path}/problems").orderBy("model").collect()  # one row a model
        rows = spark.read.parquet(f"{path}/weights").orderBy("row").collect()  # the models' columns
        return LinearModels([Problem(r["label"], r["left_out"], r["c"]) for r in problems], np.array([r["weights"] for r in rows]))


def _losses(blocks: DataFrame, weights: np.ndarray, problems: Sequence[Problem], ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared hinge losses and their gradients of all models at their weights, in one pass."""
    shared = blocks.sparkSession.sparkContext.broadcast(weights)
    labels = np.array([p.label for p in problems])
    folds = np.array([p.left_out for p in problems])
    c = np.array([p.c for p in problems])
    schema = to_arrow_schema(StructType.fromDDL(PART))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        total = np.zeros((w.shape[0] + 1, w.shape[1]))  # gradients, and the losses in the last row
        for batch in batches:
            for i in range(batch.num_rows):
                rows = SparseRows(batch, i, 2)
                sign = np.where(rows.numbers[:, :1] == labels, 1.0, -1.0)
                short = np.maximum(0.0, 1.0 - sign * (rows.times(w[:-1]) + w[-1])) * (rows.numbers[:, 1:] != folds)
                push = -2.0 * c * sign * short
                rows.transposed_times(push, total)
                total[-2] += push.sum(axis=0)
                total[-1] += (c * short * short).sum(axis=0)
        yield from in_ranges(total, ranges, TaskContext.get().partitionId(), schema)

    total = summed(blocks.mapInArrow(run, PART), weights.size + len(problems), ranges).reshape(weights.shape[0] + 1, -1)
    shared.unpersist()
    return total[-1] + 0.5 * (weights * weights).sum(axis=0), total[:-1] + weights


class _Descent:
    """L-BFGS of one model; its step is halved until it brings a sufficient decrease."""

    def __init__(self, weights: np.ndarray):
        self.at, self.value, self.gradient = weights, np.inf, None
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.direction, self.pace, self.done, self.first = np.zeros_like(weights), 1.0, False, None

    def tried(self) -> np.ndarray:
        return self.at if self.done or self.gradient is None else self.at + self.pace * self.direction

    def tell(self, value: float, gradient: np.ndarray, tolerance: float) -> None:
        if self.done:
            return
        if self.gradient is None:
            self.first = float(np.linalg.norm(gradient))
        elif value > self.value + SUFFICIENT * self.pace * float(self.direction @ self.gradient):
            self.pace /= 2
            self.done = self.pace < 1e-8
            return
        else:
            move, turn = self.pace * self.direction, gradient - self.gradient
            if move @ turn > 1e-12 * (turn @ turn):
                self.pairs = [*self.pairs[1 - HISTORY:], (move, turn)]
            self.at = self.at + move
        self.value, self.gradient, self.pace = value, gradient, 1.0
        self.done = float(np.linalg.norm(gradient)) <= tolerance * max(self.first, 1e-300)
        q, shares = gradient.copy(), []
        for move, turn in reversed(self.pairs):
            share = (move @ q) / (move @ turn)
            q -= share * turn
            shares.append(share)
        if self.pairs:
            move, turn = self.pairs[-1]
            q *= (move @ turn) / (turn @ turn)
        else:
            self.pace = min(1.0, 1.0 / max(self.first, 1e-300))
        for (move, turn), share in zip(self.pairs, reversed(shares)):
            q += (share - (turn @ q) / (move @ turn)) * move
        self.direction = -q


def fit_linear_svms(
    df: DataFrame, columns: int, problems: Sequence[Problem], label: str = "label", fold: str | Column | None = None,
    features: str = "features", passes: int = 100, tolerance: float = 1e-4,
) -> LinearModels:
    """All the problems' SVMs: penalty 0.5 |w|^2 (intercept included) plus c times the squared hinge losses.

    ``fold`` numbers the rows' folds for problems that leave one out. A model stands still once its gradient has shrunk to
    ``tolerance`` of the first one; ``passes`` bounds the steps. Rows with a NULL label or vector take no part.
    """
    if (columns + 1) * len(problems) > MOST_CELLS:
        raise ValueError(f"{columns} terms x {len(problems)} models are too many; raise min_df")
    number = F.lit(-2) if fold is None else F.col(fold) if isinstance(fold, str) else fold
    rows = df.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(
        F.col(label).cast("double").alias("_label"), number.cast("double").alias("_fold"), features).persist()
    blocks = stored_blocks(spread(rows), features, ["_label", "_fold"])
    rows.unpersist()
    ranges = -(-(columns + 2) * len(problems) // RANGE_CELLS)
    models = [_Descent(np.zeros(columns + 1)) for _ in problems]
    for _ in range(passes):
        moving = [j for j, m in enumerate(models) if not m.done]
        if not moving:
            break
        values, gradients = _losses(blocks, np.stack([models[j].tried() for j in moving], axis=1), [problems[j] for j in moving], ranges)
        for k, j in enumerate(moving):
            models[j].tell(float(values[k]), gradients[:, k], tolerance)
    return LinearModels(problems, np.stack([m.at for m in models], axis=1))


class CalibratedSVM:
    """Mean of the fold models' class shares; each fold's sigmoids are learned on the rows it left out."""

    def __init__(self, models: LinearModels, sigmoids: np.ndarray):
        self.models, self.sigmoids = models, sigmoids  # sigmoids: folds x classes x (slope, offset)

    def transform(self, df: DataFrame, out: str = "probabilities") -> DataFrame:
        """Adds ``out``, one share per class, and the ``prediction`` of the largest."""
        folds, classes = self.sigmoids.shape[:2]
        scored = self.models.margins(df, out="_margins")
        parts = []
        for f in range(folds):
            odds = F.array(*[1 / (1 + F.exp(-(float(a) * F.get("_margins", F.lit(f * classes + k)) + float(b))))
                             for k, (a, b) in enumerate(self.sigmoids[f])])
            parts.append(odds)
        scored = scored.withColumn("_odds", F.array(*parts))
        shares = F.transform("_odds", lambda o: F.transform(o, lambda x: x / F.aggregate(o, F.lit(0.0), lambda a, b: a + b)))
        mean = F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda k: F.aggregate(
            "_shares", F.lit(0.0), lambda total, s: total + F.get(s, k)) / folds)
        scored = scored.withColumn("_shares", shares).withColumn(out, F.when(F.col("_margins").isNotNull(), mean))
        best = (F.array_position(out, F.array_max(out)) - 1).cast("double")
        return scored.drop("_odds", "_shares", "_margins").withColumn("prediction", best)

    def save(self, path: str) -> str:
        self.models.save(f"{path}/models")
        rows = [(f, k, float(a), float(b)) for f, own in enumerate(self.sigmoids) for k, (a, b) in enumerate(own)]
        SparkSession.active().createDataFrame(rows, "fold int, class int, a double, b double").write.mode("overwrite").parquet(f"{path}/sigmoids")
        return path

    @staticmethod
    def load(path: str) -> CalibratedSVM:
        rows = SparkSession.active().read.parquet(f"{path}/sigmoids").orderBy("fold", "class").collect()  # folds x classes
        folds = 1 + max(r["fold"] for r in rows)
        return CalibratedSVM(LinearModels.load(f"{path}/models"), np.array([(r["a"], r["b"]) for r in rows]).reshape(folds, -1, 2))


def fit_sigmoids(held: DataFrame, folds: int, classes: int, steps: int = 30) -> np.ndarray:
    """Slope and offset for each fold and class by Newton's method on (_fold, _label, _margins: own fold's models).

    Targets are smoothed by the class sizes (Platt). All folds and classes share the steps; a step is one aggregation
    inside the JVM.
    """
    held = held.persist()
    counts = np.zeros((folds, classes))
    for r in held.groupBy("_fold", "_label").agg(F.count("*").alias("n")).collect():  # folds x classes rows
        counts[int(r["_fold"]), int(r["_label"])] = r["n"]
    total = counts.sum(axis=1, keepdims=True)
    high, low = (counts + 1) / (counts + 2), 1 / (total - counts + 2)
    found = np.zeros((folds, classes, 2))
    found[:, :, 1] = np.log((counts + 1) / (total - counts + 1))
    slices = F.posexplode("_margins").alias("_k", "_m")
    values = np.full((folds, classes), np.inf)
    best, damping = found.copy(), np.full((folds, classes), 1e-3)
    table = held.select("_fold", "_label", slices).persist()
    for _ in range(steps):
        rows = [(f, k, *map(float, found[f, k]), float(high[f, k]), float(low[f, k])) for f in range(folds) for k in range(classes)]
        now = held.sparkSession.createDataFrame(rows, "_fold int, _k int, a double, b double, high double, low double")
        m = F.col("_m")
        z = F.col("a") * m + F.col("b")
        t = F.when(F.col("_label") == F.col("_k"), F.col("high")).otherwise(F.col("low"))
        p = 1 / (1 + F.exp(-z))
        loss = F.greatest(z, F.lit(0.0)) - z * t + F.log1p(F.exp(-F.abs(z)))
        sums = table.join(F.broadcast(now), ["_fold", "_k"]).groupBy("_fold", "_k").agg(
            F.sum(loss).alias("l"), F.sum((p - t) * m).alias("ga"), F.sum(p - t).alias("gb"),
            F.sum(p * (1 - p) * m * m).alias("haa"), F.sum(p * (1 - p) * m).alias("hab"), F.sum(p * (1 - p)).alias("hbb")).collect()
        moved = 0.0
        for r in sums:
            f, k = int(r["_fold"]), int(r["_k"])
            if r["l"] > values[f, k] + 1e-12:
                damping[f, k] *= 10  # a step too far: back, and a shorter one
                found[f, k] = (found[f, k] + best[f, k]) / 2
                moved = max(moved, float(np.abs(found[f, k] - best[f, k]).max()))
                continue
            values[f, k], best[f, k] = r["l"], found[f, k]
            damping[f, k] = max(damping[f, k] / 10, 1e-10)
            h = np.array([[r["haa"] + damping[f, k], r["hab"]], [r["hab"], r["hbb"] + damping[f, k]]])
            step = np.linalg.solve(h, [r["ga"], r["gb"]])
            found[f, k] = best[f, k] - step
            moved = max(moved, float(np.abs(step).max()))
        if moved < 1e-6:
            break
    table.unpersist()
    held.unpersist()
    return best


def fit_calibrated_svm(
    df: DataFrame, columns: int, classes: int, fold: Column, folds: int = 5, c: float = 1.0, label: str = "label",
    features: str = "features", passes: int = 100,
) -> CalibratedSVM:
    """SVMs on all folds but one, fitted side by side, and their sigmoids on the folds left out."""
    problems = [Problem(k, f, c) for f in range(folds) for k in range(classes)]
    rows = df.withColumn("_fold", fold)
    models = fit_linear_svms(rows, columns, problems, label, "_fold", features, passes)
    own = models.margins(rows.where(F.col(label).isNotNull() & F.col(features).isNotNull()), features, "_all").select(
        "_fold", F.col(label).alias("_label"), F.slice("_all", F.col("_fold") * classes + 1, F.lit(classes)).alias("_margins"))
    return CalibratedSVM(models, fit_sigmoids(own, folds, classes))
