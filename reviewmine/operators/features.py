"""Term weights, vectors and indexes.

Term weights are kept in long form (key, term, weight) where they are reported
or summed, and as sparse vectors where a model is trained on them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    IDF,
    IndexToString,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
)
from pyspark.ml.linalg import Vectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..session import cut_lineage
from .joins import lookup_join
from .ordering import global_index
from .text import explode_words
from .words import broadcast_words, weigh_words


# ---- counts and weights in long form ---------------------------------------------------


def document_frequency(df: DataFrame, tokens: str, out: str = "term") -> DataFrame:
    """Texts per term and the plain inverse frequency ln((n + 1) / (df + 1))."""
    n = df.agg(F.count("*").alias("n")).scalar()
    terms = explode_words(df, F.array_distinct(tokens), (), out)
    counts = terms.groupBy(out).agg(F.count("*").alias("df"))
    return counts.withColumn("idf", F.log((n + 1) / (F.col("df") + 1)))


def vocabulary(
    df: DataFrame, tokens: str, size: int | None = 5000, min_df: int = 1, max_df: float = 1.0
) -> DataFrame:
    """Terms with corpus count, text count and smooth idf.

    Terms in fewer than ``min_df`` texts or in more than the share ``max_df`` are
    left out; of the rest the ``size`` most frequent stay, ties by spelling. The
    smooth idf is ln((1 + n) / (1 + df)) + 1. ``size`` bounds what a model
    carries; None keeps all terms.

    Both counts come from one explode, so only one partial count per term and
    task is shuffled.
    """
    n = df.agg(F.count("*").alias("n")).scalar()
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    marks = F.concat(
        F.transform(tokens, lambda t: F.struct(t.alias("term"), one.alias("tf"), zero.alias("df"))),
        F.transform(
            F.array_distinct(tokens),
            lambda t: F.struct(t.alias("term"), zero.alias("tf"), one.alias("df")),
        ),
    )
    counts = df.select(F.inline(marks)).groupBy("term").agg(
        F.sum("tf").alias("tf"), F.sum("df").alias("df")
    )
    kept = counts.where((F.col("df") >= min_df) & (F.col("df") <= n * max_df)).withColumn(
        "idf", F.log((1 + n) / (1 + F.col("df"))) + 1
    )
    if size is None:
        return kept
    return kept.orderBy(F.desc("tf"), "term").limit(size)


def tfidf_terms(
    df: DataFrame, key: str, tokens: str, size: int | None = 5000,
    min_df: int = 1, max_df: float = 1.0, keep: Sequence[str] = (),
) -> DataFrame:
    """(key, *keep, term, tf, weight): tf times smooth idf, each text scaled to length 1.

    Rows look the idf of their words up in a broadcast table and are weighted where they stand. Beyond TABLE_WORDS terms
    the words are counted by key and joined by shuffle, hot terms salted.
    """
    terms = vocabulary(df, tokens, size, min_df, max_df).select("term", "idf", "df")
    if size is None:
        terms = cut_lineage(terms)  # counted once, then measured and joined
    table = broadcast_words(terms, "term", ["idf"])
    if table is not None:
        weighed = df.select(key, *keep, weigh_words(X.no_null_array(F.col(tokens)), table).alias("_terms"))
        # A plain inline would add a size test that weighs the words a second time, in workers of its own.
        return weighed.select(key, *keep, F.inline_outer("_terms")).where("term is not null")
    counts = explode_words(df, F.col(tokens), [key, *keep], "term").groupBy(key, *keep, "term").agg(
        F.count("*").alias("tf")
    )
    weighted = lookup_join(
        counts, terms, ["term"], how="inner", salt_by=[key], bound=size, weight="df"
    ).withColumn(
        "_raw", F.col("tf") * F.col("idf")
    )
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key)))
    return weighted.select(key, *keep, "term", "tf", (F.col("_raw") / norm).alias("weight"))


# ---- vectors for models ----------------------------------------------------------------


MODEL_TERMS = 1 << 20  # terms that a model's arrays on the driver are sized for


def word_tokenizer(text: str, out: str = "words") -> RegexTokenizer:
    """Stage form of the word tokenizer."""
    return RegexTokenizer(inputCol=text, outputCol=out, pattern=X.WORD_PATTERN, gaps=False)


def _vocabulary_model(spark: SparkSession, names: Sequence[str]) -> CountVectorizerModel:
    """A model of the terms, which go to the JVM in one text: one by one, as ``from_vocabulary`` sends them, each takes two calls."""
    if any("\n" in name for name in names) or not all(names):
        return CountVectorizerModel.from_vocabulary(list(names), inputCol="")
    terms = spark._jvm.org.apache.commons.lang3.StringUtils.splitPreserveAllTokens("\n".join(names), "\n")
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", terms)
    return model._set(vocabSize=len(names))


def fit_vectorizer(
    df: DataFrame, text: str, size: int | None = 5000, min_df: int = 1, max_df: float = 1.0,
    stopwords: Sequence[str] | None = None, tfidf: bool = True, out: str = "features",
) -> tuple[PipelineModel, list[str]]:
    """Count or TF-IDF vectorizer as a fitted pipeline, with its vocabulary.

    ``size`` keeps the most frequent terms, None all that pass the limits. One aggregation gives
    terms and idf, which come to the driver, because a model has to carry them. So more than
    MODEL_TERMS are refused, never cut: raise ``min_df`` or take ``hashing_stages``.
    """
    words = X.word_tokens(F.col(text))
    stages = [
        SQLTransformer(statement=f"SELECT *, coalesce({text}, '') AS _text FROM __THIS__"),
        word_tokenizer("_text", "_words"),
    ]
    if stopwords:
        words = X.remove_stopwords(words, stopwords)
        stages.append(StopWordsRemover(inputCol="_words", outputCol="_kept", stopWords=list(stopwords)))
    source = "_kept" if stopwords else "_words"
    terms = vocabulary(df.select(words.alias("_w")), "_w", size, min_df, max_df)
    if size is None:
        terms = terms.orderBy(F.desc("tf"), "term").limit(MODEL_TERMS + 1)
    rows = terms.select("term", "idf").collect()  # at most ``size`` or MODEL_TERMS + 1 rows
    if size is None and len(rows) > MODEL_TERMS:
        n = vocabulary(df.select(words.alias("_w")), "_w", None, min_df, max_df).count()
        raise ValueError(f"{n} terms are too many for a model; raise min_df or use hashing_stages")
    if not rows:
        raise ValueError("no term is left; lower min_df or raise max_df")
    names = [r["term"] for r in rows]
    counts_out = "_counts" if tfidf else out
    model = _vocabulary_model(df.sparkSession, names).setInputCol(source).setOutputCol(counts_out)
    stages.append(model)
    drops = ["_text", "_words"] + (["_kept"] if stopwords else [])
    if tfidf:
        stages += [
            ElementwiseProduct(
                scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_counts", outputCol="_scaled"
            ),
            Normalizer(p=2.0, inputCol="_scaled", outputCol=out),
        ]
        drops += ["_counts", "_scaled"]
    stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(drops)}) FROM __THIS__"))
    return Pipeline(stages=stages).fit(df.limit(0)), names


def hashed_counts(df: DataFrame, tokens: str, out: str = "hashed", buckets: int = 1 << 18) -> DataFrame:
    return HashingTF(inputCol=tokens, outputCol=out, numFeatures=buckets).transform(df)


def hashing_stages(text: str = "text", out: str = "features", buckets: int = 1 << 18) -> list:
    """Tokenizer, hashing counts and idf as pipeline stages."""
    return [
        Tokenizer(inputCol=text, outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="_hashed", numFeatures=buckets),
        IDF(inputCol="_hashed", outputCol=out),
    ]


# ---- indexes ---------------------------------------------------------------------------


def frequency_index(df: DataFrame, column: str, out: str = "index") -> DataFrame:
    """Index per value, most frequent 0, ties by spelling, as a table (column, n, out).

    Values are counted first and ordered by range partitions, so the table may
    hold any number of values; nothing is gathered on the driver.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return global_index(counts, [F.desc("n"), F.col(column)], out)


def label_indexer(df: DataFrame, column: str, out: str = "label"):
    """Alphabetical indexer of a few classes, and its inverse."""
    model = StringIndexer(inputCol=column, outputCol=out, stringOrderType="alphabetAsc").fit(df)
    return model, IndexToString(inputCol="prediction", outputCol="predicted", labels=model.labels)


# ---- truncated SVD ---------------------------------------------------------------------


def truncated_svd(vectors: DataFrame, features: str, terms: Sequence[str], k: int = 50):
    """Right singular vectors as (term, v array<double>) and the singular values.

    No centring. Signs are fixed so that the largest entry of each vector is positive.
    ``vectors`` should be persisted: the solver passes over the rows repeatedly. It gives
    fewer than ``k`` vectors where the rows have a lower rank.
    """
    rows = MLUtils.convertVectorColumnsFromML(vectors.select(features), features)
    matrix = RowMatrix(rows, numCols=len(terms))
    svd = matrix.computeSVD(min(k, len(terms)), computeU=False)
    v, singular = svd.V.toArray(), svd.s.toArray()
    tops = np.abs(v).argmax(axis=0)
    v = v * np.sign(v[tops, np.arange(v.shape[1])])
    table = vectors.sparkSession.createDataFrame(
        [(t, [float(x) for x in row]) for t, row in zip(terms, v)], "term string, v array<double>"
    )
    return table, [float(x) for x in singular]


def project_terms(
    weights: DataFrame, key: str, vectors: DataFrame, k: int, texts: DataFrame | None = None,
    out: str = "point",
) -> DataFrame:
    """Coordinates of each text: its weights times the term vectors, summed per text.

    With ``texts`` (holding the key) a text without any known term lies at zero.
    """
    joined = lookup_join(weights, vectors, ["term"], how="inner", salt_by=[key]).select(
        key, "weight", "v"
    )
    if texts is not None:
        joined = joined.unionByName(texts.select(key), allowMissingColumns=True)
    sums = [
        F.coalesce(F.sum(F.col("weight") * F.get("v", F.lit(i))), F.lit(0.0)).alias(f"_c{i}")
        for i in range(k)
    ]
    return joined.groupBy(key).agg(*sums).select(
        key, F.array(*[F.col(f"_c{i}") for i in range(k)]).alias(out)
    )


def document_map(points: DataFrame, key: str, groups: DataFrame, n: int = 1000, seed: int = 42) -> DataFrame:
    """Two coordinates and the group of n sampled texts, for a scatter plot."""
    flat = points.select(key, F.get("point", F.lit(0)).alias("x"), F.get("point", F.lit(1)).alias("y"))
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    sampled = flat.orderBy(order, key).limit(n)
    return lookup_join(groups, sampled, [key], how="inner", salt_by=[key], bound=n).select(
        key, "x", "y", *[c for c in groups.columns if c != key]
    )
