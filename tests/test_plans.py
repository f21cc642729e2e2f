"""Whole flows on a review table with a planted signal."""

import random

import pytest
from pyspark.sql import functions as F

from reviewmine.plans import reports, sentiment

WORDS = {"1.0": "awful broken poor refund".split(), "3": "okay average plain usual".split(), "5": "great lovely perfect superb".split()}


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(7)
    rows = []
    for i in range(150):
        rating = ["1.0", "3", "5"][i % 3]
        text = " ".join(rng.choices(WORDS[rating], k=6) + ["tablet", "it's"])
        rows.append((f"prod{i % 10}", f"asin{i % 7}", f"rev{i}", rating, text))
    rows.append(("prod1", "asin1", "rev900", None, None))
    schema = "id string, asins string, review_id string, review_rating string, review_text string"
    return spark.createDataFrame(rows, schema).repartition(4).cache()


SETTINGS = {"logistic": {"max_iter": 20}, "trees": {"rounds": 3, "depth": 2}, "svm": {"folds": 2, "max_iter": 5}}


@pytest.mark.parametrize("kind", sentiment.KINDS)
def test_train_score_save_load(spark, reviews, tmp_path, kind):
    model, scored = sentiment.train_sentiment(reviews, "review_id", kind=kind, size=50, **SETTINGS[kind])
    table, f1 = sentiment.report(scored)
    assert f1.first()["f1_micro"] > (0.6 if kind == "trees" else 0.95)
    assert {r["class"] for r in table.collect()} == {"Negative", "Neutral", "Positive", "accuracy", "macro avg", "weighted avg"}
    texts = spark.createDataFrame([("superb great tablet",), ("broken refund",)], "review_text string")
    rows = model.score(texts).collect()
    assert all(abs(sum(r["probabilities"].values()) - 1) < 1e-9 for r in rows)
    assert kind == "trees" or [r["predicted"] for r in rows] == ["Positive", "Negative"]
    loaded = sentiment.SentimentModel.load(model.save(str(tmp_path / "model")))
    assert [r["probabilities"] for r in loaded.score(texts).collect()] == [r["probabilities"] for r in rows]


def test_unknown_kind(reviews):
    with pytest.raises(ValueError):
        sentiment.train_sentiment(reviews, "review_id", kind="forest")


def test_overview(reviews):
    tables = reports.rating_overview(reviews)
    assert {r["sentiment"]: r["n"] for r in tables["sentiment"].collect()} == {"Negative": 50, "Neutral": 51, "Positive": 50}
    assert {r["rating"]: r["n"] for r in tables["rating_levels"].collect()} == {0: 0, 1: 50, 2: 0, 3: 50, 4: 0, 5: 50}
    assert tables["top_items"].count() == 7 and tables["item_frequency"].agg(F.sum("n")).first()[0] == 151


def test_text_reports(reviews):
    row = reports.preprocessed(reviews).where("review_id = 'rev0'").first()
    assert "it's" in row["tokens"] and "it's" not in row["filtered"] and "tablet" in row["stems"]
    assert reports.preprocessed(reviews).count() == 150
    assert reports.ngram_report(reviews, 2, 1).first()["ngram"] == "tablet it's"
    top = reports.cloud_words(reviews).orderBy(F.desc("n")).first()
    assert (top["word"], top["n"]) == ("tablet", 150)
    split = reports.cloud_words(reviews, rating="review_rating")
    assert {r["sentiment"] for r in split.where("word = 'great'").collect()} == {"Positive"}


def test_topic_report(reviews):
    tables = reports.topic_report(reviews, "review_id", k=3, size=30, words=3, max_iter=5, restarts=2, sample=20)
    assert tables["topic_words"].count() == 9 and tables["cluster_words"].count() == 9
    assert tables["topics"].count() == tables["clusters"].count() == 151
    assert tables["map"].count() == 20 and tables["map"].columns == ["review_id", "x", "y", "cluster"]


def test_recommendation_report(reviews):
    rec, metrics = reports.recommendation_report(reviews)
    assert metrics.first()["n"] > 0 and rec.users.count() == 10 and rec.items.count() == 7
