"""The reports of the dashboard as tables: what each page shows, without the drawing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH
from ..functions.text import tokens
from ..operators import features as FE
from ..operators import recommend as RC
from ..operators import stats as S
from ..operators import text as TX
from ..operators import topics as U
from ..operators.classify import split_rows
from ..operators.clean import keep_present, with_sentiment
from ..operators.evaluate import regression_metrics


def rating_overview(
    reviews: DataFrame, item: str = "asins", rating: str = "review_rating", levels: Sequence[int] = range(6)
) -> dict[str, DataFrame]:
    """Sentiment shares, ratings, item frequencies and mean ratings."""
    labelled = with_sentiment(reviews, rating)
    return {
        "sentiment": S.class_counts(labelled, "sentiment"),
        "rating_levels": S.rating_distribution(reviews, rating, levels),
        "item_frequency": S.item_frequency(reviews, item),
        "item_ratings": S.item_ratings(reviews, item, rating),
        "top_items": S.top_items(reviews, item, rating),
    }


def preprocessed(reviews: DataFrame, text: str = "review_text") -> DataFrame:
    """Tokens, tokens without stop words, and their stems; reviews without text are left out."""
    rows = keep_present(reviews, text)
    return TX.with_stems(TX.with_filtered(TX.with_tokens(rows, text)))


def ngram_report(reviews: DataFrame, n: int = 2, k: int = 50, text: str = "review_text") -> DataFrame:
    rows = keep_present(reviews, text).select(tokens(F.col(text)).alias("tokens"))
    return TX.top_ngrams(rows, "tokens", n, k)


def cloud_words(
    reviews: DataFrame, text: str = "review_text", rating: str | None = None, stopwords: Sequence[str] = ENGLISH
) -> DataFrame:
    """Word counts of the cloud: of all reviews, or per sentiment where a rating is named."""
    if rating is None:
        return TX.word_frequency(reviews, text, (), stopwords)
    return TX.word_frequency(with_sentiment(reviews, rating), text, ["sentiment"], stopwords)


def topic_report(
    reviews: DataFrame, key: str, text: str = "review_text", k: int = 8, size: int | None = None, words: int = 15,
    max_iter: int = 20, restarts: int = 10, sample: int = 1000, seed: int = 42,
    stopwords: Sequence[str] = ENGLISH,
) -> dict[str, DataFrame]:
    """Topics and clusters with their words, one label of each per review, and a 2-D sample map.

    ``size`` limits the vocabulary; without it every term between the text limits takes part.
    """
    rows = reviews.select(key, text)
    limits = {"size": size, "min_df": 5, "max_df": 0.9, "stopwords": stopwords}
    counter, terms = FE.fit_vectorizer(rows, text, tfidf=False, **limits)
    weigher, weighed_terms = FE.fit_vectorizer(rows, text, tfidf=True, **limits)
    counts = counter.transform(rows).select(key, "features").persist()
    vectors = weigher.transform(rows).select(key, "features").persist()
    lda = U.fit_topics(counts, k=k, max_iter=max_iter, seed=seed)
    clusters = U.fit_clusters(vectors, k=k, restarts=restarts, seed=seed).transform(vectors).select(
        key, F.col("prediction").alias("cluster")
    )
    kept = FE.X.remove_stopwords(FE.X.word_tokens(F.col(text)), stopwords)
    weights = FE.tfidf_terms(rows.select(key, kept.alias("_w")), key, "_w", size, 5, 0.9)
    basis, _ = FE.truncated_svd(vectors, "features", weighed_terms, 2)
    points = FE.project_terms(weights, key, basis, 2, vectors)
    return {
        "topic_words": U.topic_words(lda, terms, words),
        "topics": U.dominant_topic(lda, counts).select(key, "topic", "share"),
        "clusters": clusters,
        "cluster_words": U.cluster_words(weights, clusters, key, n=words),
        "map": FE.document_map(points, key, clusters, sample, seed),
    }


def recommendation_report(
    reviews: DataFrame, user: str = "id", item: str = "asins", rating: str = "review_rating",
    train_percent: int = 80, seed: int = 0, rank: int = 5, max_iter: int = 5, reg: float = 0.05,
) -> tuple[RC.Recommender, DataFrame]:
    """A fitted recommender and the RMSE and R² of its held-out ratings."""
    triples, users, items = RC.rating_triples(reviews, user, item, rating)
    keyed = triples.withColumn("_pair", F.concat_ws("|", "u", "i"))
    train, test = split_rows(keyed, "_pair", train_percent, seed)
    model = RC.als(rank, max_iter, reg, seed).fit(train)
    scored = RC.predict_ratings(model, test)
    return RC.Recommender(model, users, items), regression_metrics(scored, "r", "prediction")
