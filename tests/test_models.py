"""Models on planted data: they must find what was planted, and survive saving."""

import random

import pytest
from pyspark.sql import functions as F

from reviewmine.operators import classify as M
from reviewmine.operators import features as FE
from reviewmine.operators import recommend as RC
from reviewmine.operators import topics as U
from reviewmine.sources import models as SM
from reviewmine.streaming import scoring as ST

LABELS = ["Negative", "Neutral", "Positive"]
WORDS = {
    "Negative": "bad awful broken poor refund".split(),
    "Neutral": "okay average plain usual fine".split(),
    "Positive": "great lovely perfect superb best".split(),
}


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        label = LABELS[i % 3]
        words = rng.choices(WORDS[label], k=6) + rng.choices(["the", "tablet", "screen"], k=3)
        rows.append((i, " ".join(words), label))
    return spark.createDataFrame(rows, "k int, t string, sentiment string").repartition(4).cache()


@pytest.fixture(scope="module")
def vectors(texts):
    model, terms = FE.fit_vectorizer(texts, "t", 50)
    indexer, inverse = FE.label_indexer(texts, "sentiment")
    rows = indexer.transform(model.transform(texts)).cache()
    return rows, terms, model, inverse, indexer


def accuracy(scored):
    return scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]


def test_labels_are_alphabetical(vectors):
    rows, _, _, inverse, indexer = vectors
    assert list(indexer.labels) == LABELS
    back = inverse.setInputCol("label").setOutputCol("back").transform(rows)
    assert back.where("back <> sentiment").count() == 0


def test_multinomial_lr_and_probability_map(vectors):
    rows, _, _, _, _ = vectors
    scored = M.fit_multinomial_lr(rows, max_iter=50).transform(rows)
    assert accuracy(scored) > 0.95
    maps = M.probability_map(scored, LABELS).select("probabilities").collect()
    assert all(set(r[0]) == set(LABELS) and abs(sum(r[0].values()) - 1) < 1e-9 for r in maps)


def test_svm_margins_match_the_stock_transform(vectors):
    rows, _, _, _, _ = vectors
    model = M.fit_svm(rows, max_iter=10)
    mine = M.score_classes(model, rows)
    assert accuracy(mine) > 0.95
    stock = {r["k"]: r["prediction"] for r in model.transform(rows).select("k", "prediction").collect()}
    assert {r["k"]: r["prediction"] for r in mine.collect()} == stock


def test_calibrated_svm_sums_to_one_and_is_saved(vectors, tmp_path):
    rows, _, _, _, _ = vectors
    model = M.fit_calibrated_svm(rows, "k", 3, folds=3, max_iter=5)
    scored = model.transform(rows)
    assert accuracy(scored) > 0.95
    first = {r["k"]: r["probabilities"] for r in scored.collect()}
    assert all(abs(sum(p) - 1) < 1e-9 for p in first.values())
    assert sum(p[int(r["label"])] for r in rows.collect() for p in [first[r["k"]]]) / len(first) > 0.7
    loaded = SM.load_calibrated(SM.save_calibrated(model, str(tmp_path / "svm")))
    assert {r["k"]: r["probabilities"] for r in loaded.transform(rows).collect()} == first


def test_boosted_trees_and_importance(vectors):
    rows, terms, _, _, _ = vectors
    model = M.fit_boosted_trees(rows, rounds=3, depth=2)
    scored = M.tree_probabilities(M.score_classes(model, rows), 3)
    assert accuracy(scored) > 0.6
    assert all(abs(sum(r[0]) - 1) < 1e-9 for r in scored.select("probabilities").collect())
    top = M.top_features(model, terms, 15)
    assert top and all(t not in ("the", "tablet", "screen") for t, _ in top[:3])
    assert [v for _, v in top] == sorted((v for _, v in top), reverse=True)


def test_hashing_classifier_round_trip(spark, texts, tmp_path):
    rows = texts.select("k", F.col("t").alias("text"), (F.col("sentiment") == "Positive").cast("double").alias("label"))
    model = M.fit_hashing_lr(rows.unionByName(spark.createDataFrame([(999, None, 0.0)], rows.schema)), buckets=1 << 10)
    scored = model.transform(rows)
    assert accuracy(scored) > 0.95
    path = SM.save_model(model, str(tmp_path / "m"))
    SM.save_model(model, path)  # replaces
    again = SM.load_pipeline(path).transform(rows)
    assert again.select("k", "prediction").exceptAll(scored.select("k", "prediction")).count() == 0


def test_cross_validation_prefers_the_weaker_penalty(vectors):
    rows, _, _, _, _ = vectors
    model, table = M.search_lr(rows, regs=(0.001, 50.0), folds=2, max_iter=10)
    assert len(table) == 2 and model.getRegParam() == 0.001


def test_split_is_stable_and_complete(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    train, test = M.split_rows(df, "k", 70, 42)
    assert train.count() + test.count() == 1000 and 600 < train.count() < 800
    again, _ = M.split_rows(df.repartition(9), "k", 70, 42)
    assert sorted(r[0] for r in again.collect()) == sorted(r[0] for r in train.collect())


def test_stream_scores_equal_batch_scores(spark, texts, vectors, tmp_path):
    rows, _, vectorizer, _, _ = vectors
    model = M.fit_multinomial_lr(rows, max_iter=10)
    source = str(tmp_path / "in")
    blanks = spark.createDataFrame([(900, None, "x"), (901, "  ", "x"), (902, "", "x")], texts.schema)
    texts.unionByName(blanks).write.parquet(source)
    score = lambda df: model.transform(vectorizer.transform(df)).select("k", "prediction")
    batch = ST.score_texts(spark.read.parquet(source), "t", score)
    stream = ST.score_texts(ST.read_text_stream(spark, source, texts.schema, max_files=1), "t", score)
    for _ in range(2):  # the second run finds nothing new
        run = ST.write_scores(stream, str(tmp_path / "out"), str(tmp_path / "progress"))
        run.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert got.count() == 120


@pytest.fixture(scope="module")
def planted_ratings(spark):
    rng = random.Random(3)
    users = [(rng.uniform(0.5, 1.5), rng.uniform(0.5, 1.5)) for _ in range(60)]
    items = [(rng.uniform(0.5, 1.5), rng.uniform(0.5, 1.5)) for _ in range(25)]
    rows = [
        (f"u{a}", f"i{b}", str(round(u[0] * i[0] + u[1] * i[1], 4)))
        for a, u in enumerate(users) for b, i in enumerate(items) if rng.random() < 0.8
    ]
    rows += [("u0", None, "3"), (None, "i0", "3"), ("u0", "i0", None), ("u1", "i1", "bad")]
    return spark.createDataFrame(rows, "user string, item string, rating string").cache()


def test_triples_drop_or_zero_bad_ratings(planted_ratings):
    whole = planted_ratings.dropna().count()
    dropped, users, items = RC.rating_triples(planted_ratings, "user", "item", "rating")
    zero, _, _ = RC.rating_triples(planted_ratings, "user", "item", "rating", "zero")
    assert dropped.count() == whole - 1 and zero.count() == whole and zero.where("r = 0").count() == 1
    assert users.count() == 60 and items.count() == 25
    assert sorted(r["i"] for r in items.collect()) == list(range(25))
    with pytest.raises(ValueError):
        RC.rating_triples(planted_ratings, "user", "item", "rating", "other")


def test_als_recovers_planted_factors(spark, planted_ratings, tmp_path):
    triples, users, items = RC.rating_triples(planted_ratings, "user", "item", "rating")
    train, test = M.split_rows(triples.withColumn("_k", F.concat_ws("|", "u", "i")), "_k", 80, 0)
    rec = RC.Recommender(RC.als(2, 10, 0.01).fit(train), users, items)
    error = RC.predict_ratings(rec.model, test).agg(F.sqrt(F.avg(F.pow(F.col("r") - F.col("prediction"), 2)))).first()[0]
    assert error < 0.3
    everyone = RC.recommend_all(rec, 5)
    assert everyone.count() == 300 and everyone.select("user").distinct().count() == 60
    rec.save(str(tmp_path / "rec"))
    rec.save(str(tmp_path / "rec"))
    loaded = RC.Recommender.load(spark, str(tmp_path / "rec"))
    asked = spark.createDataFrame([("u3",), ("nobody",)], "user string")
    mine = sorted((r["rank"], r["item"]) for r in RC.recommend_for(loaded, asked, 5).collect())
    assert mine == sorted((r["rank"], r["item"]) for r in everyone.where("user = 'u3'").collect()) and len(mine) == 5
    RC.write_recommendations(rec, str(tmp_path / "csv"), 20)
    stored = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert stored.count() == 100 and stored.columns == ["user", "rank", "item", "rating"]


def test_blocks_of_als_grow_with_the_ratings(planted_ratings, monkeypatch):
    few, many = RC.sized(RC.als(), 36_000_000), RC.sized(RC.als(), 216_000_000)
    assert (few.getNumUserBlocks(), few.getNumItemBlocks(), few.getCheckpointInterval()) == (10, 10, 10)
    assert (many.getNumUserBlocks(), many.getNumItemBlocks(), many.getCheckpointInterval()) == (52, 52, 1)
    triples, _, _ = RC.rating_triples(planted_ratings, "user", "item", "rating")
    triples = triples.cache()
    monkeypatch.setattr(RC, "BLOCK_RATINGS", -(-triples.count() // 12))
    model = RC.fit_als(triples, 2, 10, 0.01)
    error = RC.predict_ratings(model, triples).agg(F.sqrt(F.avg(F.pow(F.col("r") - F.col("prediction"), 2)))).first()[0]
    assert error < 0.3 and model.userFactors.count() == 60


def test_als_grid(planted_ratings):
    triples, _, _ = RC.rating_triples(planted_ratings, "user", "item", "rating")
    model, table = RC.search_als(triples.cache(), ranks=(2,), iters=(3,), regs=(0.01, 5.0), folds=2)
    assert len(table) == 2 and model.rank == 2
    assert min(table, key=lambda r: r["rmse"])["regParam"] == 0.01


def test_als_grid_lets_go_of_each_fit(planted_ratings, monkeypatch):
    calls = []
    monkeypatch.setattr(RC.gc, "collect", lambda: calls.append(1) or 0)
    triples, _, _ = RC.rating_triples(planted_ratings, "user", "item", "rating")
    RC.search_als(triples.cache(), ranks=(2,), iters=(2,), regs=(0.01, 5.0), folds=2)
    assert len(calls) == 4  # every setting of every fold


@pytest.fixture(scope="module")
def planted_topics(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices([f"{'abc'[i % 3]}word{j}" for j in range(8)], k=15)), i % 3) for i in range(120)]
    return spark.createDataFrame(rows, "k int, t string, g int").repartition(4).cache()


def purity(rows):
    """Share of rows that sit in the main group of their cluster."""
    best = {}
    for c, g in rows:
        best.setdefault(c, {}).setdefault(g, 0)
        best[c][g] += 1
    return sum(max(v.values()) for v in best.values()) / len(rows)


def test_topics_and_their_words(planted_topics):
    model, terms = FE.fit_vectorizer(planted_topics, "t", 100, tfidf=False)
    rows = model.transform(planted_topics).cache()
    lda = U.fit_topics(rows, k=3, max_iter=30)
    found = U.dominant_topic(lda, rows).select("topic", "g").collect()
    assert purity([tuple(r) for r in found]) > 0.85
    words = U.topic_words(lda, terms, 5).collect()
    assert len(words) == 15 and all(r["term"] in terms for r in words)


def test_clusters_and_their_words(planted_topics):
    model, _ = FE.fit_vectorizer(planted_topics, "t", 100)
    rows = model.transform(planted_topics).cache()
    found = U.fit_clusters(rows, k=3, restarts=4).transform(rows).select("k", "g", F.col("prediction").alias("cluster"))
    assert purity([(r["cluster"], r["g"]) for r in found.collect()]) == 1.0
    words = FE.tfidf_terms(planted_topics.select("k", FE.X.word_tokens(F.col("t")).alias("w")), "k", "w", None)
    top = U.cluster_words(words, found, "k", n=3).collect()
    letters = {}
    for r in top:
        letters.setdefault(r["cluster"], set()).add(r["term"][0])
    assert len(top) == 9 and all(len(v) == 1 for v in letters.values())


def test_terms_go_to_the_jvm_in_one_text(spark, monkeypatch):
    from pyspark.ml.feature import CountVectorizerModel

    rows = spark.createDataFrame([(1, "rare bb bb"), (2, "bb cc"), (3, None)], "doc_id long, text string")
    monkeypatch.setattr(CountVectorizerModel, "_new_java_array", None)  # two calls a term
    model, terms = FE.fit_vectorizer(rows, "text", None, tfidf=False)
    assert terms == ["bb", "cc", "rare"]
    found = {r.doc_id: r.features.toArray().tolist() for r in model.transform(rows).collect()}
    assert found == {1: [2, 0, 1], 2: [1, 1, 0], 3: [0, 0, 0]}
    assert [list(s.vocabulary) for s in model.stages if isinstance(s, CountVectorizerModel)] == [terms]


def test_vocabulary_without_size_is_whole_or_refused(planted_topics, monkeypatch):
    _, every = FE.fit_vectorizer(planted_topics, "t", None)
    words = FE.vocabulary(planted_topics.select(FE.X.word_tokens(F.col("t")).alias("w")), "w", None)
    ranked = [r["term"] for r in sorted(words.collect(), key=lambda r: (-r["tf"], r["term"]))]
    assert every == ranked and FE.fit_vectorizer(planted_topics, "t", 3)[1] == ranked[:3]
    monkeypatch.setattr(FE, "MODEL_TERMS", len(every))
    assert FE.fit_vectorizer(planted_topics, "t", None)[1] == every
    monkeypatch.setattr(FE, "MODEL_TERMS", len(every) - 1)
    with pytest.raises(ValueError, match=str(len(every))):
        FE.fit_vectorizer(planted_topics, "t", None)


def test_svd_equals_numpy(planted_topics):
    import numpy as np

    model, terms = FE.fit_vectorizer(planted_topics, "t", 100)
    rows = model.transform(planted_topics).select("k", "features").cache()
    dense = np.array([r["features"].toArray() for r in rows.orderBy("k").collect()])
    want = np.linalg.svd(dense, compute_uv=False)[:4]
    weights = FE.tfidf_terms(planted_topics.select("k", FE.X.word_tokens(F.col("t")).alias("w")), "k", "w", 100)
    table, values = FE.truncated_svd(rows, "features", terms, 4)
    assert values == pytest.approx(list(want), rel=1e-6)
    v = {r["term"]: r["v"] for r in table.collect()}
    basis = np.array([v[t] for t in terms])
    assert np.allclose(basis.T @ basis, np.eye(4), atol=1e-8)
    points = {r["k"]: r["point"] for r in FE.project_terms(weights, "k", table, 4, rows).collect()}
    assert np.allclose(dense @ basis, np.array([points[k] for k in range(120)]), atol=1e-8)
    groups = planted_topics.select("k", "g")
    drawn = FE.document_map(FE.project_terms(weights, "k", table, 2), "k", groups, 30)
    assert drawn.count() == 30 and drawn.columns == ["k", "x", "y", "g"]
