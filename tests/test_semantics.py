"""Small literal tables for the corner cases of each operator."""

import pytest
from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from reviewmine.functions import ratings as RT
from reviewmine.functions import text as X
from reviewmine.functions.porter import stem_text, stem_tokens
from reviewmine.functions.stopwords import ENGLISH
from reviewmine.operators import classify as CL
from reviewmine.operators import clean as C
from reviewmine.operators import evaluate as E
from reviewmine.operators import features as FE
from reviewmine.operators import stats as S
from reviewmine.operators import text as TX
from reviewmine.sources import pages as PG

RATINGS = ["4.0", "2.5", "3.5", "3", "x", "", None, "2.99", "5", "0"]


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "k int, t string")


def test_sentiment_cuts_ratings_to_whole_numbers(spark):
    df = spark.createDataFrame([(r,) for r in RATINGS], "r string")
    assert one(df, RT.sentiment(F.col("r"))) == [
        "Positive", "Negative", "Neutral", "Neutral", "Neutral", "Neutral", "Neutral", "Negative", "Positive", "Negative",
    ]
    assert one(df, RT.sentiment(F.col("r"), fractional=True))[1:3] == ["Negative", "Positive"]


def test_null_rating_is_neutral_and_label_zero(spark):
    df = spark.createDataFrame([(None,), ("5",)], "review_rating string")
    labelled = C.with_binary_label(C.with_sentiment(df))
    assert [tuple(r) for r in labelled.collect()] == [(None, "Neutral", 0), ("5", "Positive", 1)]
    assert C.with_sentiment(df, drop_null=True).count() == 1


def test_label_of_unknown_class_is_null(spark):
    df = spark.createDataFrame([("Positive",), ("Other",), (None,)], "sentiment string")
    assert one(C.with_binary_label(df), "label") == [1, None, None]


TOKEN_TEXTS = ["A  b c. ", "", " the QUICK fox ", "   ", "\tx\n\ny", "ÉTÉ d'été", "a\x0bb\x0cc", "no\xa0break"]


def test_tokens_equal_the_ml_stages(spark):
    df = texts(spark, *TOKEN_TEXTS)
    ml = Tokenizer(inputCol="t", outputCol="w").transform(df)
    assert one(df, X.tokens(F.col("t"))) == one(ml, "w")
    kept = StopWordsRemover(inputCol="w", outputCol="f").transform(ml)
    assert one(ml, X.remove_stopwords(F.col("w"))) == one(kept, "f")
    for n in (1, 2, 3):
        grams = NGram(n=n, inputCol="w", outputCol="g").transform(ml)
        assert one(ml, X.ngrams(F.col("w"), n)) == one(grams, "g")


def test_stop_words_are_the_stock_list(spark):
    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_of_null_are_empty(spark):
    df = texts(spark, None)
    assert one(df, X.tokens(F.col("t"))) == [[]]
    assert one(df, X.word_tokens(F.col("t"))) == [[]]
    assert one(df, X.clean_text(F.col("t"))) == [""]


def test_exploded_ngrams_equal_the_array_form(spark):
    df = texts(spark, *TOKEN_TEXTS, "a b c d a b").withColumn("w", X.tokens(F.col("t")))
    for n in (1, 2, 3):
        want = sorted(g for row in one(df, X.ngrams(F.col("w"), n)) for g in row)
        assert sorted(one(TX.explode_ngrams(df, "w", n), "ngram")) == want


def test_drop_blank_ngrams(spark):
    df = texts(spark, "a  b c").withColumn("w", X.tokens(F.col("t")))
    assert one(df, X.ngrams(F.col("w"), 2)) == [["a ", " b", "b c"]]
    assert one(df, X.ngrams(F.col("w"), 2, drop_blank=True)) == [["b c"]]


def test_bigram_filters(spark):
    df = spark.createDataFrame([(g,) for g in ["a_b", "/><br_/><br", "", "_x", "x_", "m_n"]], "g string")
    assert one(df.where(X.ngram_kept(F.col("g"))), "g") == ["a_b", "", "m_n"]


def test_cloud_weights(spark):
    df = spark.createDataFrame([("a b", 250), ("c d", 99), ("e f", 100), (" g", 900)], "ngram string, n bigint")
    assert {r["ngram"]: r["weight"] for r in TX.ngram_cloud(df).collect()} == {"a_b": 2, "c_d": 0, "e_f": 1}


def test_word_weights_round_half_up(spark):
    rows = [("w" if i < 50 else "v", 1) for i in range(99)]
    df = spark.createDataFrame(rows, "t string, label int")
    assert {r["word"]: r["weight"] for r in S.class_word_weights(df, "t", "label").collect()} == {"w": 1, "v": 0}


def test_unicode_blanks_collapse(spark):
    df = texts(spark, "  a  b \n c　", None, "\x1c")
    assert one(df, X.clean_text(F.col("t"))) == ["a b c", "", ""]


STEMS = dict(
    caresses="caress", ponies="poni", ties="tie", feed="feed", agreed="agre", plastered="plaster", motoring="motor",
    conflated="conflat", sized="size", hopping="hop", falling="fall", filing="file", happy="happi", relational="relat",
    conditional="condit", hesitanci="hesit", digitizer="digit", radicalli="radic", vietnamization="vietnam",
    decisiveness="decis", sensibiliti="sensibl", electriciti="electr", hopeful="hope", adjustable="adjust",
    adoption="adopt", effective="effect", probate="probat", rate="rate", cease="ceas", controll="control", roll="roll",
    dying="die", enjoy="enjoy", flies="fli", dies="die", spied="spi", died="die", theologi="theolog", by="by", cry="cri",
    say="say", skies="sky", proceed="proceed", sing="sing", Running="run",
)


def test_porter_stems(spark):
    df = spark.createDataFrame([(list(STEMS),)], "w array<string>")
    got = dict(zip(STEMS, df.select(stem_tokens(F.col("w"))).first()[0]))
    assert got == STEMS
    assert df.select(stem_text(F.array(F.lit("hopping"), F.lit("cats")))).first()[0] == "hop cat"


def test_helpful_votes(spark):
    df = spark.createDataFrame(
        [("1,234 people found this helpful",), ("One person found this helpful",), ("12 person",), ("Nobody",), (None,)], "s string"
    )
    assert one(df, RT.helpful_votes(F.col("s"))) == [1234, 1, 12, 0, 0]
    assert one(df, RT.helpful_votes(F.col("s"), repaired=False)) == [0, None, 12, 0, 0]


def test_extremes_and_ties(spark):
    df = spark.createDataFrame([(1, "aa"), (2, "bbbb"), (3, "cccc"), (4, "d"), (5, None)], "k int, t string")
    rows = {r["which"]: (r["key"], r["text"]) for r in S.extreme_texts(df, "t", "k").collect()}
    assert rows == {"longest": (2, "bbbb"), "shortest": (4, "d")}
    assert sorted((r["k"], r["which"]) for r in S.extreme_ties(df, "t").collect()) == [
        (2, "longest"), (3, "longest"), (4, "shortest"),
    ]


def test_rating_levels_are_zero_filled(spark):
    df = spark.createDataFrame([("5",), ("5.0",), ("2.5",), ("x",), (None,)], "r string")
    levels = {r["rating"]: r["n"] for r in S.rating_distribution(df, "r", range(6)).collect()}
    assert levels == {0.0: 0, 1.0: 0, 2.0: 0, 3.0: 0, 4.0: 0, 5.0: 2}
    assert {r["rating"]: r["n"] for r in S.rating_distribution(df, "r").collect()} == {5.0: 2, 2.5: 1}


def test_missing_profile(spark):
    df = spark.createDataFrame([("a", 1, None), ("", None, "x")], "a string, `b.c` int, d string")
    assert {r["column"]: r["missing"] for r in C.missing_profile(df).collect()} == {"a": 1, "b.c": 1, "d": 1}


def predictions(spark, rows):
    return spark.createDataFrame(rows, "label double, prediction double, score double")


def test_metrics_of_perfect_and_wrong_predictions(spark):
    good = predictions(spark, [(1.0, 1.0, 0.9), (0.0, 0.0, 0.1)])
    bad = predictions(spark, [(1.0, 0.0, 0.1), (0.0, 1.0, 0.9)])
    assert E.area_under_roc(good).first()[0] == 1.0 and E.area_under_roc(bad).first()[0] == 0.0
    assert E.accuracy(good).first()[0] == 1.0 and E.accuracy(bad).first()[0] == 0.0
    assert E.error_rate(bad).first()[0] == 1.0
    assert E.regression_metrics(good).first()[1:] == (0.0, 1.0)


def test_metrics_with_one_class_or_ties(spark):
    single = predictions(spark, [(1.0, 1.0, 0.9), (1.0, 0.0, 0.2)])
    assert E.area_under_roc(single).first()[0] is None
    assert E.regression_metrics(single).first()["r2"] is None
    tied = predictions(spark, [(1.0, 1.0, 0.5), (0.0, 1.0, 0.5), (0.0, 0.0, 0.5)])
    assert E.area_under_roc(tied).first()[0] == 0.5
    report = {r["class"]: r for r in E.classification_report(single).collect()}
    assert report["0.0"]["precision"] == 0.0 and report["0.0"]["support"] == 0
    assert report["accuracy"]["f1"] == 0.5 and report["accuracy"]["support"] == 2


def test_auc_equals_the_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = [(float(i % 3 == 0), 0.0, ((i * 37) % 50) / 50) for i in range(200)]
    df = predictions(spark, rows)
    stock = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(df)
    assert E.area_under_roc(df).first()[0] == pytest.approx(stock, abs=1e-9)


def test_lemmas_by_dictionary_tag_and_rules(spark):
    lemmas = spark.createDataFrame(
        [("was", "v", "be"), ("saw", "v", "see"), ("saw", "n", "saw"), ("geese", "n", "goose")], "word string, pos string, lemma string"
    )
    verbs = spark.createDataFrame([("was",), ("walking",)], "word string")
    df = texts(spark, "He was  SAW geese walking boxes", "", None)
    got = {r["k"]: r["lemmatized"] for r in TX.lemmatize(df, "k", "t", lemmas, verbs).collect()}
    assert got == {0: "he be saw goose walking boxes", 1: "", 2: ""}
    got = {r["k"]: r["lemmatized"] for r in TX.lemmatize(df, "k", "t", lemmas, verbs, True).collect()}
    assert got[0] == "he be saw goose walk box"


def test_gazetteer_finds_phrases_in_order(spark):
    gazetteer = spark.createDataFrame(
        [("Paris", "GPE"), ("New York City", "GPE"), ("new york", "GPE"), ("Acme", "ORG")], "phrase string, label string"
    )
    df = texts(spark, "Acme left New York City for paris", "nothing here", None, "", "I saw (Paris), then NEW YORK. Paris, new")
    found = {
        r["k"]: [tuple(e) for e in r["entities"]]
        for r in TX.gazetteer_entities(df, "k", "t", gazetteer).collect()
    }
    assert found == {
        0: [("Acme", "ORG"), ("New York", "GPE"), ("New York City", "GPE"), ("paris", "GPE")], 1: [], 2: [], 3: [],
        4: [("Paris", "GPE"), ("NEW YORK", "GPE"), ("Paris", "GPE")],
    }
    counts = TX.entity_frequency(TX.gazetteer_entities(df, "k", "t", gazetteer))
    assert sorted((r["label"], r["text"], r["n"]) for r in counts.collect())[0] == ("GPE", "NEW YORK", 1)


def test_pattern_entities(spark):
    df = texts(spark, "Mail a.b@c.org, pay $1,200.50 by 2024-05-06 to John Smith via https://x.org/a?b=1", None)
    rows = TX.pattern_entities(df, "t").collect()
    assert {(e["label"], e["text"]) for e in rows[0]["entities"]} == {
        ("EMAIL", "a.b@c.org"), ("MONEY", "$1,200.50"), ("DATE", "2024-05-06"), ("CAPS", "John Smith"),
        ("URL", "https://x.org/a?b=1"),
    }
    assert rows[1]["entities"] == []


def test_polarity_sign_and_negation(spark):
    lexicon = spark.createDataFrame([("good", 0.8), ("bad", -0.6)], "word string, score double")
    df = texts(spark, "a good thing", "not good", "bad good", "plain", None)
    got = {r["k"]: (r["polarity"], r["class"]) for r in TX.polarity(df, "k", "t", lexicon).collect()}
    assert got == {0: (0.8, "Positif"), 1: (-0.4, "Négatif"), 2: (0.1, "Positif"), 3: (0.0, "Neutre"), 4: (0.0, "Neutre")}


def test_smooth_idf_and_unit_length(spark):
    import math

    df = texts(spark, "aa bb bb", "aa cc", "aa").withColumn("w", X.word_tokens(F.col("t")))
    terms = {r["term"]: r for r in FE.vocabulary(df, "w", 2).collect()}
    assert set(terms) == {"aa", "bb"} and terms["bb"]["tf"] == 2 and terms["bb"]["df"] == 1
    assert terms["bb"]["idf"] == pytest.approx(math.log(4 / 2) + 1)
    weights = FE.tfidf_terms(df, "k", "w", 2).collect()
    for k in (0, 1, 2):
        assert sum(r["weight"] ** 2 for r in weights if r["k"] == k) == pytest.approx(1.0)


def test_vectorizer_equals_long_form(spark):
    df = texts(spark, "aa bb bb the", "aa cc dd", None, "zz the")
    model, terms = FE.fit_vectorizer(df, "t", 4, stopwords=ENGLISH)
    assert model.transform(df).columns == ["k", "t", "features"]
    vectors = {r["k"]: r["features"] for r in model.transform(df).collect()}
    words = df.withColumn("w", X.remove_stopwords(X.word_tokens(F.col("t"))))
    for r in FE.tfidf_terms(words, "k", "w", 4).collect():
        assert vectors[r["k"]][terms.index(r["term"])] == pytest.approx(r["weight"])
    assert vectors[2].numNonzeros() == 0


def test_max_features_ties_go_by_spelling(spark):
    df = texts(spark, "bb aa cc").withColumn("w", X.word_tokens(F.col("t")))
    assert sorted(one(FE.vocabulary(df, "w", 2), "term")) == ["aa", "bb"]


def test_negated_contractions_turn_scores(spark):
    rows = spark.createDataFrame([(1, "I don't like it"), (2, "I like it"), (3, "isn’t good")], "id long, text string")
    lexicon = spark.createDataFrame([("like", 1.0), ("good", 1.0)], "word string, score double")
    got = {r.id: r["class"] for r in TX.polarity(rows, "id", "text", lexicon).collect()}
    assert got == {1: "Négatif", 2: "Positif", 3: "Négatif"}


def test_rows_without_key_or_score_follow_one_rule(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "key string, x long")
    train, test = CL.split_rows(rows, "key")
    assert train.count() + test.count() == 4
    scored = spark.createDataFrame([(1.0, 0.9, 1.0), (0.0, 0.1, 0.0), (0.0, None, None)], "label double, score double, prediction double")
    assert E.area_under_roc(scored).first().auc == 1.0
    assert E.accuracy(scored).first().accuracy == pytest.approx(2 / 3)


def test_cards_on_two_pages_do_not_repeat_details(spark):
    details = spark.createDataFrame([("u", "d1"), ("v", "d2")], "product_url string, name string")
    cards = spark.createDataFrame([("u", "1", "4", "9"), ("u", "1", "4", "9"), ("u", "2", "4", "9")], "product_url string, price string, rating string, review_count string")
    assert sorted((r.product_url, r.price) for r in PG.merge_cards(details, cards).collect()) == [("u", "1"), ("v", None)]
