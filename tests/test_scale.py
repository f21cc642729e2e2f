"""Paths that only large or skewed tables take, forced on small ones."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewmine.operators import features as FE
from reviewmine.operators import joins
from reviewmine.functions import text as X
from reviewmine.functions.porter import stem_tokens
from reviewmine.operators import ordering as O
from reviewmine.operators import text as TX
from reviewmine.operators.stats import bootstrap_intervals, hash_sample, top_per_group


def test_size_check(spark):
    assert joins.fits_broadcast(spark.range(10), max_rows=10)
    assert not joins.fits_broadcast(spark.range(11), max_rows=10)
    assert not joins.fits_broadcast(spark.range(10), max_rows=10, max_bytes=20)


def test_salted_join_equals_broadcast_join(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"w{i % 7}") for i in range(300)] + [(400, None)], "k int, w string")
    table = spark.createDataFrame([("hot", 1, 100), ("w1", 2, 30), ("w2", 3, 30), ("none", 4, 0)], "w string, v int, n bigint")
    for how in ("left", "inner"):
        direct = sorted(map(str, joins.lookup_join(rows, table, ["w"], how).select("k", "w", "v").collect()))
        for weight in (None, "n"):
            salted = joins.lookup_join(rows, table, ["w"], how, salt_by=["k"], max_rows=1, hot_rows=10, weight=weight)
            assert sorted(map(str, salted.select("k", "w", "v").collect())) == direct


def test_hot_keys_get_salts_by_their_size(spark):
    counts = spark.createDataFrame([("hot", 1000), ("warm", 25), ("cold", 9)], "w string, n bigint")
    found = {r["w"]: r["_salts"] for r in joins.hot_keys(counts, ["w"], "n", 10).collect()}
    assert found == {"hot": 100, "warm": 3}
    assert joins.hot_keys(counts, ["w"], "n").count() == 0


def test_hot_key_is_spread_over_tasks(spark):
    rows = spark.range(4000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("w"))
    table = rows.select("w").distinct().withColumn("v", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.lookup_join(rows, table, ["w"], salt_by=["k"], max_rows=10, hot_rows=100)
        parts = [r["count"] for r in joined.where("w = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(parts) == 1334 and len(parts) == 4 and max(parts) < 700


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_running_totals_equal_a_loop(spark, values):
    rows = [(v, i, 1) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v int, i int, one bigint")
    got = {r["i"]: (r["cum_v"], r["cum_one"]) for r in O.running_totals(df, [F.col("v"), F.col("i")], ["v", "one"]).collect()}
    total, want = 0, {}
    for n, (v, i, _) in enumerate(sorted(rows), 1):
        total += v
        want[i] = (total, n)
    assert got == want


def test_global_index_is_dense(spark):
    df = spark.range(997).select((F.col("id") * 7919 % 997).alias("x"))
    rows = O.global_index(df, [F.col("x")]).collect()
    assert all(r["index"] == r["x"] for r in rows) and len(rows) == 997


def test_frequency_index_with_one_hot_value(spark):
    df = spark.createDataFrame([("hot",)] * 40 + [(f"v{i:02d}",) for i in range(40)] + [(None,)], "x string")
    rows = {r["x"]: (r["n"], r["index"]) for r in FE.frequency_index(df, "x").collect()}
    assert rows["hot"] == (40, 0) and rows["v00"] == (1, 1) and rows["v39"] == (1, 40) and None not in rows


def test_top_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), F.col("id").cast("string").alias("t"), F.col("id").alias("n"))
    top = top_per_group(df, "g", "t", "n", 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["g"], r["n"]) for r in top.collect()) == [(0, 94), (0, 96), (0, 98), (1, 95), (1, 97), (1, 99)]


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(200)
    first = sorted(r["id"] for r in hash_sample(df.repartition(1), "id", 20).collect())
    assert first == sorted(r["id"] for r in hash_sample(df.repartition(7), "id", 20).collect()) and len(first) == 20


def test_weights_of_terms_are_not_shuffled(spark):
    df = spark.createDataFrame([(i, [f"w{i % 5}", "all"]) for i in range(50)], "k int, w array<string>")
    executed = FE.tfidf_terms(df, "k", "w", 10)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in executed


def test_words_are_looked_up_in_place_or_joined(spark):
    texts = [(i, f"The Running dogs, was 'studies' {w} {w} and") for i, w in enumerate(["flies", "", "caresses", "was", "der  die"] * 8)]
    df = spark.createDataFrame(texts + [(90, None), (91, ""), (92, "   ")], "k int, t string")
    lemmas = spark.createDataFrame([("was", "v", "be"), ("dogs,", "n", "dog")], "word string, pos string, lemma string")
    verbs = spark.createDataFrame([("was",), ("running",)], "word string")
    both = [TX.lemmatize(df, "k", "t", lemmas, verbs, True, most=m) for m in (1000, 0)]
    assert sorted(map(tuple, both[0].collect())) == sorted(map(tuple, both[1].collect()))
    tokens = df.withColumn("w", X.tokens(F.col("t")))
    both = [TX.with_stems(tokens, "w", "s", most=m).select("k", "s") for m in (1000, 0)]
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))


def test_weights_in_place_equal_joined_ones(spark, monkeypatch):
    draw = random.Random(2)
    rows = [(i, draw.choices(["a", "b", "c", "dd", "e"], k=draw.randint(0, 9)), i % 2) for i in range(60)] + [(99, None, 1)]
    df = spark.createDataFrame(rows, "k int, w array<string>, g int")
    place = lambda: sorted((r["k"], r["g"], r["term"], r["tf"], round(r["weight"], 9)) for r in FE.tfidf_terms(df, "k", "w", 4, keep=["g"]).collect())
    direct = place()
    monkeypatch.setattr(FE, "broadcast_words", lambda *a: None)
    assert direct and place() == direct


def test_no_text_or_token_is_shuffled(spark):
    df = spark.createDataFrame([(1, "some words here"), (2, "more of them")], "k int, t string").withColumn("w", X.tokens(F.col("t")))
    lemmas = spark.createDataFrame([("words", "n", "word")], "word string, pos string, lemma string")
    for made in (TX.lemmatize(df, "k", "t", lemmas), TX.with_stems(df, "w"), FE.tfidf_terms(df, "k", "w", 10)):
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()


def test_phrases_of_any_length(spark, monkeypatch):
    phrases = [("the Quick brown fox jumps", "LONG"), ("fox", "ANIMAL"), ("C++", "TOOL"), ("of the", "X"), (".net core", "TOOL")]
    gazetteer = spark.createDataFrame(phrases, "phrase string, label string")
    texts = [(1, 'See: "The quick brown fox jumps", twice'), (2, "C++ and c++, .NET core of  the"), (3, None), (4, "- fox"), (5, "nothing")]
    df = spark.createDataFrame(texts, "k int, t string")

    def found():
        return {r["k"]: [(e["text"], e["label"]) for e in r["entities"]] for r in TX.gazetteer_entities(df, "k", "t", gazetteer).collect()}

    direct = found()
    assert direct[1] == [("The quick brown fox jumps", "LONG"), ("fox", "ANIMAL")] and direct[3] == direct[5] == []
    assert [e for e, _ in direct[2]] == ["C++", ".NET core"] and ("fox", "ANIMAL") in direct[4]
    monkeypatch.setattr(TX, "FIRST_WORDS", 1)
    assert found() == direct


def test_bootstrap_intervals_cover_the_mean(spark):
    draw = random.Random(8)
    rows = [("big", str(float(draw.randint(1, 5)))) for _ in range(3000)] + [("one", "4.0")] + [("few", r) for r in ("1.0", "5.0", "3.0", "x", None)]
    rows += [(None, "5.0"), ("none", "bad")]
    df = spark.createDataFrame(rows, "item string, rating string")
    got = {r["item"]: r for r in bootstrap_intervals(df, "item", "rating", replicates=400).collect()}
    assert set(got) == {"big", "one", "few"} and (got["one"]["low"], got["one"]["high"], got["one"]["n_rated"]) == (4.0, 4.0, 1)
    values = [float(r) for i, r in rows if i == "big"]
    mean = sum(values) / len(values)
    spread = (sum((v - mean) ** 2 for v in values) / (len(values) - 1)) ** 0.5 / len(values) ** 0.5
    assert abs(got["big"]["low"] - (mean - 1.96 * spread)) < spread / 2 and abs(got["big"]["high"] - (mean + 1.96 * spread)) < spread / 2
    assert got["few"]["low"] < 3 < got["few"]["high"] and got["few"]["mean_rating"] == 3
    again = bootstrap_intervals(df.repartition(7), "item", "rating", replicates=400).collect()
    assert {r["item"]: r for r in again} == got


def test_long_texts_are_split_once_for_all_runs(spark):
    # 40,000 runs: an operator that takes or copies the words anew for each of them needs minutes.
    import time

    text = " ".join(["de la", "x."] * 20_000)
    df = spark.createDataFrame([(1, text), (2, None)], "k int, t string")
    gazetteer = spark.createDataFrame([("de la", "GPE"), ("x y", "NONE")], "phrase string, label string")
    began = time.monotonic()
    found = {r["k"]: r["entities"] for r in TX.gazetteer_entities(df, "k", "t", gazetteer).collect()}
    assert len(found[1]) == 20_000 and found[2] == [] and time.monotonic() - began < 30


def test_more_terms_than_a_python_table_are_weighed_in_place(spark):
    # 300,001 terms once went to a join that shuffles every token.
    df = spark.range(300_001).select(F.col("id").alias("k"), F.array(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("w"))
    found = FE.tfidf_terms(df, "k", "w", None)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and sum("ArrowEvalPython" in line and "+-" in line for line in plan.splitlines()) == 1
    assert found.agg(F.count("*"), F.min("weight"), F.max("tf")).first()[:] == (300_001, 1.0, 1)


def test_stems_need_no_pass_over_all_words(spark, monkeypatch):
    """Each batch stems its own words, however many the texts hold; equal to the column form."""
    def refused(*a, **b):
        raise AssertionError("all words are gathered first")

    monkeypatch.setattr(TX, "broadcast_words", refused)
    draw = random.Random(5)
    ends = ["", "s", "ies", "ed", "ing", "eed", "ational", "logi", "ion", "sion", "ll", "alli", "y", "e", "at ed", "\x85"]
    words = ["".join(draw.choices("aeiouybcdlstwxzÉ", k=draw.randint(0, 5))) + draw.choice(ends) + draw.choice(ends) for _ in range(600)]
    rows = [(i, draw.choices([*words, "Dying", None], k=9)) for i in range(200)] + [(900, None), (901, []), (902, [""])]
    df = spark.createDataFrame(rows, "k int, w array<string>")
    column = stem_tokens(X.no_null_array(F.col("w")))
    want = sorted(map(str, df.select("k", column.alias("s"), F.array_join(column, " ").alias("j")).collect()))
    for most in (0, 7, 1000):
        got = TX.with_stems(TX.with_stems(df, "w", "s", most=most), "w", "j", joined=True, most=most)
        assert sorted(map(str, got.select("k", "s", "j").collect())) == want


def test_few_top_ngrams_are_found_without_counting_all(spark, monkeypatch):
    """Rare n-grams are counted by bucket only; whatever the buckets, the rows are those of the whole count."""
    draw = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    rows = [(draw.choices(words, weights=range(12, 0, -1), k=draw.randint(0, 9)),) for _ in range(150)] + [(None,), ([],), (["", "", "w1"],)]
    df = spark.createDataFrame(rows, "w array<string>")
    want = {(n, k): list(map(tuple, TX.ngram_counts(df, "w", n).orderBy(F.desc("n"), "ngram").limit(k).collect())) for n in (1, 3) for k in (2, 40)}
    monkeypatch.setattr(TX, "ngram_counts", None)
    for buckets in (1, 64, 1 << 16):
        monkeypatch.setattr(TX, "GRAM_BUCKETS", buckets)
        for (n, k), counted in want.items():
            assert list(map(tuple, TX.top_ngrams(df, "w", n, k).collect())) == counted
    assert TX.top_ngrams(df.where("w is null"), "w", 2, 5).count() == 0
