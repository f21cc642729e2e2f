"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. Each category's model reads which words a text has, and the
probabilities that the models before it gave; in training these come from models that did not see the row
(out of fold), so later models learn how far earlier ones can be trusted. The last category is the
verdict.

Models are logistic regressions over the words, and beginnings of words, that tell a category apart in the
training rows; both classes weigh alike in the fit, so that a rare category is not missed. A
text's words are taken as a set, so one passage counts alike in short and long texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import map_rows, need, number_of
from .quality import labelled_sample

BUCKETS = 1 << 20
MAX_LABELLED = 6_000  # labelled rows at most that a chain is fitted on
FOLDS = 3
PREFIXES = (4, 5, 6)
Z_LEAST = 5.0  # standard errors by which a word must be more frequent in a category
CATEGORIES = ("insult", "abuse", "toxic")
# Insults that name the first category; words of other kinds are learned.
INSULTS = frozenset(
    "idiot moron stupid dumb loser clown trash garbage scum pathetic worthless disgusting fool jerk imbecile"
    " bastard filth vermin pig liar coward creep freak".split())

_WORDS = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> set[str]:
    return set(_WORDS(text.lower()))


def buckets_of(words: set[str]) -> set[int]:
    """Buckets of the words and of the beginnings of longer ones, so that their other endings count too."""
    out = {zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in words}
    for n in PREFIXES:
        out.update(zlib.crc32(p.encode("utf-8", "surrogatepass"), n) % BUCKETS for p in {w[:n] for w in words if len(w) > n})
    return out


@dataclass
class Linear:
    """Weights by bucket, weights of earlier probabilities, bias."""

    words: dict[int, float]
    earlier: np.ndarray
    bias: float

    def probability(self, buckets: set[int], before: Sequence[float]) -> float:
        z = self.bias + sum(self.words[b] for b in buckets if b in self.words)
        z += float(np.dot(self.earlier, before)) if len(self.earlier) else 0.0
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _telling(rows: list[np.ndarray], y: np.ndarray, least: float = Z_LEAST) -> np.ndarray:
    """Buckets that rows of the category have more often than chance would have it."""
    if not rows or y.min() == y.max():
        return np.zeros(0, dtype=np.int64)
    flat = np.concatenate(rows)
    sign = np.repeat(y, [len(r) for r in rows])
    buckets, inverse = np.unique(flat, return_inverse=True)
    has = np.bincount(inverse, minlength=len(buckets)).astype(float)
    positive = np.bincount(inverse, weights=sign, minlength=len(buckets))
    n, base = len(y), float(y.mean())
    expected = has * base
    spread = np.sqrt(np.maximum(has * base * (1 - base) * (1 - has / n), 1e-9))
    return buckets[(positive - expected > least * spread) & (has >= 2)]


def fit_linear(rows: list[np.ndarray], y: np.ndarray, before: np.ndarray, steps: int = 250, decay: float = 1e-5) -> Linear:
    """Logistic regression by Adam over the telling words and the earlier probabilities."""
    chosen = _telling(rows, y)
    lengths = [len(r) for r in rows]
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    at = np.searchsorted(chosen, flat)
    known = (at < len(chosen)) & (chosen[np.minimum(at, max(len(chosen) - 1, 0))] == flat if len(chosen) else False)
    row, column = np.repeat(np.arange(len(rows)), lengths)[known], at[known]
    m, k = len(chosen), before.shape[1]
    w = np.zeros(m + k + 1)
    both = len(y) > 0 and y.min() != y.max()
    if not both:  # nothing to tell apart: the only class, or no answer
        w[-1] = 0.0 if not len(y) else (8.0 if y[0] else -8.0)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1 if both else 1):
        z = np.bincount(row, weights=w[column], minlength=len(y)) + before @ w[m:m + k] + w[-1]
        miss = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * weight
        slope = np.concatenate((np.bincount(column, weights=miss[row], minlength=m), miss @ before, [miss.sum()]))
        slope[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope ** 2
        w -= 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Linear({int(b): float(v) for b, v in zip(chosen, w[:m], strict=True)}, w[m:m + k].copy(), float(w[-1]))


@dataclass
class Chain:
    categories: tuple[str, ...]
    models: list[Linear]

    def probabilities(self, text: str) -> list[float]:
        buckets = buckets_of(words_of(text))
        out: list[float] = []
        for model in self.models:
            out.append(model.probability(buckets, out))
        return out


def fit_chain(rows: list[np.ndarray], targets: np.ndarray, categories: Sequence[str] = CATEGORIES, folds: int = FOLDS) -> Chain:
    """Fit the models in order; column j of ``targets`` is category j, rows are distinct buckets."""
    fold = np.arange(len(rows)) % folds
    before = np.zeros((len(rows), 0))
    models = []
    for j in range(len(categories)):
        y = targets[:, j].astype(float)
        models.append(fit_linear(rows, y, before))
        unseen = np.zeros(len(rows))
        for f in range(folds):
            inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            model = fit_linear([rows[i] for i in inside], y[inside], before[inside])
            for i in outside:
                unseen[i] = model.probability(set(rows[i].tolist()), before[i])
        before = np.column_stack((before, unseen))
    return Chain(tuple(categories), models)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = MAX_LABELLED) -> Chain:
    """Fit on at most ``rows`` labelled documents, chosen by a hash of their ids.

    Categories of a toxic row: "insult" if it has a listed insult, "abuse" if it has none, and "toxic" always. Without labelled
    rows, or with one class only, the chain answers by that class's share.
    """
    sample = labelled_sample(docs, labels, label, rows)

    def make() -> Callable[..., Iterator[tuple]]:
        def one(doc_id: int, text: str | None, y: int) -> Iterator[tuple]:
            words = words_of(text or "")
            buckets = np.array(sorted(buckets_of(words)), dtype="<i4")
            yield doc_id, y, bool(words & INSULTS), buckets.tobytes()

        return one

    schema = sample.select("doc_id", "label").schema.add("insult", "boolean").add("buckets", "binary")
    got = sorted(map_rows(sample.select("doc_id", "text", "label"), schema, make).collect(), key=lambda r: (r[0], r[3]))
    targets = np.array([[r[1] and r[2], r[1] and not r[2], r[1]] for r in got], dtype=int).reshape(-1, len(CATEGORIES))
    return fit_chain([np.frombuffer(r[3], "<i4").astype(np.int64) for r in got], targets)


def score_documents(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per whole text (NULL: empty) the probability of every category, and ``toxic`` (0 or 1) by the last."""

    def make() -> Callable[..., Iterator[tuple]]:
        def one(row_id: object, text: str | None) -> Iterator[tuple]:
            p = chain.probabilities(text or "")
            yield (row_id, *p, int(p[-1] >= 0.5))

        return one

    schema = StructType().add("doc_id", docs.schema[id_col].dataType)
    for name in chain.categories:
        schema = schema.add(f"p_{name}", "double")
    return map_rows(need(docs, id_col, text_col), schema.add("toxic", "integer"), make)


def keep_clean(docs: DataFrame, chain: Chain, most: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose verdict stays below ``most``, with all their columns; no row moves."""

    verdict = F.arrow_udf(number_of(lambda text: chain.probabilities(text)[-1]), "double")
    return docs.where(verdict(F.col(f"`{text_col}`")) < most)
