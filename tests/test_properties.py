"""Laws that hold for any input."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewmine.functions import text as X
from reviewmine.operators import evaluate as E
from reviewmine.operators import text as TX
from reviewmine.sources import reviews as R

few = settings(max_examples=6, deadline=None)


@few
@given(st.lists(st.text(alphabet="ab \t\nÉ.", max_size=25), min_size=1, max_size=12))
def test_ngram_count_law(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, t string").withColumn("w", X.tokens(F.col("t")))
    for n in (1, 2, 3):
        wrong = df.where(F.size(X.ngrams(F.col("w"), n)) != F.greatest(F.lit(0), F.size("w") - (n - 1)))
        assert wrong.count() == 0
        total = df.agg(F.sum(F.greatest(F.lit(0), F.size("w") - (n - 1)))).first()[0]
        assert TX.explode_ngrams(df, "w", n).count() == total


@few
@given(st.lists(st.text(alphabet="ab \t\n 　\x1f é", max_size=20), min_size=1, max_size=12))
def test_clean_text_equals_split_and_join(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, t string").select("k", X.clean_text(F.col("t")).alias("c"))
    assert {r["k"]: r["c"] for r in df.collect()} == {i: " ".join(v.split()) for i, v in enumerate(values)}


@few
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("abcd")), min_size=1, max_size=40))
def test_metric_laws(spark, pairs):
    df = spark.createDataFrame(pairs, "label string, prediction string")
    assert E.confusion_counts(df).agg(F.sum("n")).first()[0] == len(pairs)
    right = sum(a == b for a, b in pairs) / len(pairs)
    f = E.f1_scores(df).first()
    assert abs(f["f1_micro"] - right) < 1e-12 and abs(E.accuracy(df).first()[0] - right) < 1e-12
    assert all(0 <= v <= 1 for v in f)


@few
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 9)), min_size=1, max_size=40))
def test_roc_is_monotone_and_its_area_is_the_rank_sum(spark, rows):
    df = spark.createDataFrame([(float(a), b / 10) for a, b in rows], "label double, score double")
    points = E.roc_points(df).orderBy(F.desc("threshold")).collect()
    for x, y in zip(points, points[1:]):
        assert (x["fpr"] or 0) <= (y["fpr"] or 0) and (x["tpr"] or 0) <= (y["tpr"] or 0)
    pos, neg = [b for a, b in rows if a], [b for a, b in rows if not a]
    area = E.area_under_roc(df).first()[0]
    if not pos or not neg:
        assert area is None
    else:
        wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
        assert abs(area - wins / len(pos) / len(neg)) < 1e-12


@few
@given(st.lists(st.tuples(st.sampled_from(["p", "q", "r"]), st.text(alphabet="xyz,\" ", max_size=5)), min_size=1, max_size=20))
def test_flatten_undoes_nest(spark, rows):
    flat = [(p, f"r{i:03d}", t) for i, (p, t) in enumerate(rows)]
    df = spark.createDataFrame(flat, "id string, review_id string, review_title string")
    for parts in (1, 3):
        back = R.flatten_reviews(R.nest_reviews(df, parts=parts).drop("part"))
        assert sorted(map(tuple, back.select("id", "review_id", "review_title").collect())) == sorted(flat)
