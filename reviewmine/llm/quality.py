"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors: one per word and one per character n-gram inside words, both by
hashing, and one marker for a word that repeats the word before it. A softmax layer over the average gives the
classes. Vectors and layer are trained together by stochastic gradient descent in numpy, on a bounded
sample of labelled rows. For scoring, vectors and layer fold into one number a bucket, so a whole text is
scored by one pass over its hashed windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import map_rows, need, number_of

WORD_BUCKETS = 1 << 16
GRAM_BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
REPEAT = WORD_BUCKETS + GRAM_BUCKETS  # bucket of "this word equals the one before"
BUCKETS = REPEAT + 1
DIMENSIONS = 16
EPOCHS = 6
RATE = 0.5
MAX_LABELLED = 3_000  # labelled rows at most that a model is fitted on
_STEP = 1 << 18  # code points hashed at once, so that long texts need little memory

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _segments(points: np.ndarray) -> Iterator[np.ndarray]:
    """Stretches of a text that begin and end at white space; only a word longer than a stretch is cut."""
    at = 0
    while at < len(points):
        end = min(at + _STEP, len(points))
        if end < len(points):
            blanks = np.flatnonzero(points[at:end] <= 32)
            if len(blanks) and blanks[-1] > 0:
                end = at + int(blanks[-1])
        yield points[at:end]
        at = end


def buckets_of(text: str) -> Iterator[np.ndarray]:
    """Buckets of all words and n-grams of a whole text, with repetition, stretch by stretch."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    last = np.uint64(0)
    for segment in _segments(points):
        c = np.concatenate(([32], segment, [32])).astype(np.uint64)
        blank = (c <= 32) | (c == 160) | (c == 0x3000)
        c[blank] = 32
        out = []
        starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        if len(starts):
            # Hash of a word: its letters weighed by powers counted from its own start.
            powers = np.cumprod(np.full(len(c), _ODD))
            sums = np.concatenate(([np.uint64(0)], np.cumsum(_mix(c) * powers)))
            back = np.cumprod(np.full(len(c), _INVERSE))
            words = _mix((sums[ends] - sums[starts]) * back[starts])
            out.append((words % np.uint64(WORD_BUCKETS)).astype(np.int64))
            before = np.concatenate(([last], words[:-1]))
            out.append(np.full(int((words == before).sum()), REPEAT, dtype=np.int64))
            last = words[-1]
        for n in GRAMS:
            if len(c) < n + 1:
                continue
            m = len(c) - n + 1
            h = np.full(m, np.uint64(n))
            for i in range(n):
                h = (h + c[i:m + i]) * _ODD
            inside = np.ones(m, dtype=bool)
            for i in range(1, n - 1):
                inside &= ~blank[i:m + i]
            inside &= ~(blank[:m] & blank[n - 1:m + n - 1]) if n == 2 else True
            out.append((_mix(h[inside]) % np.uint64(GRAM_BUCKETS)).astype(np.int64) + WORD_BUCKETS)
        if out:
            yield np.concatenate(out)


@dataclass
class SubwordModel:
    """Fitted vectors, and the same folded to one number a bucket for scoring two classes."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def folded(self) -> tuple[np.ndarray, float]:
        direction = self.layer[1] - self.layer[0]
        return (self.vectors @ direction).astype(np.float32), float(self.bias[1] - self.bias[0])


def score_text(text: str, weights: np.ndarray, bias: float) -> float:
    """Probability of class 1 for a whole text; an empty text has the bias alone."""
    total, n = 0.0, 0
    for buckets in buckets_of(text):
        total += float(weights[buckets].sum(dtype=np.float64))
        n += len(buckets)
    return float(1 / (1 + np.exp(-(bias + (total / n if n else 0.0)))))


def train(
    documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, dimensions: int = DIMENSIONS,
    epochs: int = EPOCHS, rate: float = RATE, seed: int = 7,
) -> SubwordModel:
    """Fit on documents given as (distinct buckets, their counts) by plain SGD, one document a step."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / dimensions, 1 / dimensions, (BUCKETS, dimensions)).astype(np.float32)
    layer = np.zeros((2, dimensions), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    steps, done = max(1, epochs * len(documents)), 0
    for _ in range(epochs):
        for i in draw.permutation(len(documents)):
            buckets, counts = documents[i]
            pace = rate * (1 - done / steps)
            done += 1
            share = counts / counts.sum() if len(counts) else counts
            hidden = share @ vectors[buckets]
            logits = layer @ hidden + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[labels[i]] -= 1
            back = chance @ layer
            layer -= pace * np.outer(chance, hidden).astype(np.float32)
            bias -= pace * 0.1 * chance
            # The step of a vector follows its share, times a constant that keeps long texts learning.
            vectors[buckets] -= np.outer(np.minimum(share * 20, 1.0) * pace, back).astype(np.float32)
    return SubwordModel(vectors, layer, bias)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents (doc_id, text, the label), chosen by a hash of their id.

    The ids are chosen among those of the documents at hand, so rows that an earlier stage rejected use none of them up. Only ids
    and labels are joined and sorted, and at most ``rows`` of them are broadcast, so no text is shuffled. An id with several
    labels takes part once, with the largest.
    """
    known = need(labels, "doc_id", label).where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("label"))
    chosen = known.join(need(docs, "doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return need(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = MAX_LABELLED) -> SubwordModel:
    """Train on at most ``rows`` labelled documents; tasks hash their texts, the driver gets bucket counts.

    With one class or none among them the model answers by the bias towards that class, or 0.5.
    """
    sample = labelled_sample(docs, labels, label, rows)

    def make() -> Callable[..., Iterator[tuple]]:
        def one(doc_id: int, text: str | None, y: int) -> Iterator[tuple]:
            parts = list(buckets_of(text or ""))
            flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
            buckets, counts = np.unique(flat, return_counts=True)
            yield doc_id, y, buckets.astype("<i4").tobytes(), counts.astype("<i4").tobytes()

        return one

    schema = sample.select("doc_id", "label").schema.add("buckets", "binary").add("counts", "binary")
    rows_ = sorted(map_rows(sample.select("doc_id", "text", "label"), schema, make).collect(), key=lambda r: (r[0], r[2]))
    documents = [(np.frombuffer(r[2], "<i4"), np.frombuffer(r[3], "<i4").astype(np.float32)) for r in rows_]
    return train(documents, np.array([r[1] for r in rows_], dtype=int))


def score_documents(docs: DataFrame, model: SubwordModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every whole text (NULL: empty)."""
    weights, bias = model.folded()

    def make() -> Callable[..., Iterator[tuple]]:
        def one(row_id: object, text: str | None) -> Iterator[tuple]:
            yield row_id, score_text(text or "", weights, bias)

        return one

    schema = StructType().add("doc_id", docs.schema[id_col].dataType).add("score", "double")
    return map_rows(need(docs, id_col, text_col), schema, make)


def keep_good(docs: DataFrame, model: SubwordModel, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose text scores at least ``least``, with all their columns; no row moves."""
    weights, bias = model.folded()

    score = F.arrow_udf(number_of(lambda text: score_text(text, weights, bias)), "double")
    return docs.where(score(F.col(f"`{text_col}`")) >= least)
