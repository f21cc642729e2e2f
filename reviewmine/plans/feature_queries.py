"""Term weights, vectors, indexes, splits and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH
from ..functions.text import remove_stopwords, tokens, word_tokens
from ..operators import clean as C
from ..operators import evaluate as E
from ..operators import features as FE
from ..operators.classify import split_rows
from . import tables as T
from .catalog import query
from .sql_text import kept, tokens as tokens_sql, words as words_sql

_R = f"with {T.REVIEWS_SQL} "


def _words(spark, folder, stop=False):
    words = word_tokens(F.col("text"))
    words = remove_stopwords(words) if stop else words
    return T.documents(spark, folder).select("doc_id", words.alias("w"))


@query("fe1_hashed_counts", f"select doc_id, cast(len({tokens_sql('text')}) as double) total from documents")
def _(spark, folder):
    df = T.documents(spark, folder).select("doc_id", tokens(F.col("text")).alias("w"))
    hashed = FE.hashed_counts(df, "w")
    values = F.unwrap_udt("hashed")["values"]
    return hashed.select("doc_id", F.aggregate(values, F.lit(0.0), lambda a, b: a + b).alias("total"))


@query("fe2_idf", f"""
with t as (select doc_id, {tokens_sql('text')} w from documents),
d as (select term, count(distinct doc_id) df from (select doc_id, unnest(w) term from t) group by term)
select term, df, round(ln(((select count(*) from documents) + 1.0) / (df + 1.0)), 6) idf from d""")
def _(spark, folder):
    df = T.documents(spark, folder).select("doc_id", tokens(F.col("text")).alias("w"))
    return FE.document_frequency(df, "w").withColumn("idf", F.round("idf", 6))


def _tfidf_sql(words: str, limits: str = "", size: int | None = 5000) -> str:
    cut = f"order by tf desc, term limit {size}" if size else ""
    return f"""
with t as (select doc_id, {words} w from documents),
c as (select doc_id, term, count(*) tf from (select doc_id, unnest(w) term from t) group by all),
v as (select term, cast(sum(tf) as bigint) tf, count(*) df from c group by term),
k as (select * from v {limits} {cut}),
r as (select c.doc_id, c.term, c.tf, c.tf * (ln((1.0 + (select count(*) from documents)) / (1.0 + k.df)) + 1) raw from c join k using (term)),
n as (select doc_id, sqrt(sum(raw * raw)) norm from r group by doc_id)
"""


_LIMITS = "where df >= 5 and df <= 0.9 * (select count(*) from documents)"
_KEPT_WORDS = kept("(" + words_sql("text") + ")")


@query("fe3_tfidf_weights", _tfidf_sql(words_sql("text")) + "select doc_id, term, tf, round(raw / norm, 6) weight from r join n using (doc_id)")
def _(spark, folder):
    return FE.tfidf_terms(_words(spark, folder), "doc_id", "w", 5000).withColumn("weight", F.round("weight", 6))


@query("fe4_limited_vocabulary", _tfidf_sql(_KEPT_WORDS, _LIMITS, None) + "select term, tf, df from k")
def _(spark, folder):
    return FE.vocabulary(_words(spark, folder, True), "w", None, min_df=5, max_df=0.9).select("term", "tf", "df")


@query("fe4_count_vectors", _tfidf_sql(_KEPT_WORDS, _LIMITS, 2000) + """
select doc_id, coalesce(s, 0.0) total, coalesce(m, 0) n_terms from documents left join
  (select doc_id, cast(sum(c.tf) as double) s, cast(count(*) as integer) m from c join k using (term) group by doc_id) using (doc_id)""")
def _(spark, folder):
    docs = T.documents(spark, folder).select("doc_id", "text")
    model, _ = FE.fit_vectorizer(docs, "text", 2000, 5, 0.9, ENGLISH, tfidf=False)
    values = F.unwrap_udt("features")["values"]
    return model.transform(docs).select(
        "doc_id", F.aggregate(values, F.lit(0.0), lambda a, b: a + b).alias("total"), F.size(values).alias("n_terms")
    )


@query("fe5_limited_tfidf", _tfidf_sql(_KEPT_WORDS, _LIMITS, None) + "select doc_id, term, tf, round(raw / norm, 6) weight from r join n using (doc_id)")
def _(spark, folder):
    weights = FE.tfidf_terms(_words(spark, folder, True), "doc_id", "w", None, 5, 0.9)
    return weights.withColumn("weight", F.round("weight", 6))


@query("fe5_tfidf_vectors", _tfidf_sql(_KEPT_WORDS, _LIMITS, 2000) + """
select doc_id, coalesce(s, 0.0) total from documents left join
  (select doc_id, round(sum(raw / norm), 6) s from r join n using (doc_id) group by doc_id) using (doc_id)""")
def _(spark, folder):
    docs = T.documents(spark, folder).select("doc_id", "text")
    model, _ = FE.fit_vectorizer(docs, "text", 2000, 5, 0.9, ENGLISH)
    values = F.unwrap_udt("features")["values"]
    return model.transform(docs).select(
        "doc_id", F.round(F.aggregate(values, F.lit(0.0), lambda a, b: a + b), 6).alias("total")
    )


@query("fe6_frequency_index", f"""
with {T.RATINGS_SQL}, c as (select item, count(*) n from ratings group by item)
select item, n, row_number() over (order by n desc, item) - 1 as "index" from c""")
def _(spark, folder):
    return FE.frequency_index(T.ratings(spark, folder), "item").select("item", "n", "index")


@query("fe7_label_index", _R + f"""
, s as (select doc_id, {T.SENTIMENT_SQL} sentiment from reviews)
select doc_id, sentiment, cast(dense_rank() over (order by sentiment) - 1 as double) as label, sentiment back from s""")
def _(spark, folder):
    df = C.with_sentiment(T.reviews(spark, folder), "rating_raw").select("doc_id", "sentiment")
    indexer, inverse = FE.label_indexer(df, "sentiment")
    inverse = inverse.setInputCol("label").setOutputCol("back")
    return inverse.transform(indexer.transform(df))


@query("ml6_split", _R + """
select doc_id, case when cast('0x' || substr(md5(concat(review_id, '|42')), 1, 4) as bigint) % 100 < 70 then 'train' else 'test' end part from reviews""")
def _(spark, folder):
    train, test = split_rows(T.reviews(spark, folder).select("doc_id", "review_id"), "review_id", 70, 42)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.select("doc_id", "part")


_J = f"with {T.JUDGED_SQL} "
_G = f"with {T.GUESSED_SQL} "


@query("ev1_regression_metrics", _J + """
select count(*) n, round(sqrt(avg((label - score) * (label - score))), 6) rmse,
  round(1 - sum((label - score) * (label - score)) / (count(*) * var_pop(label)), 6) r2 from judged""")
def _(spark, folder):
    m = E.regression_metrics(T.judged(spark, folder), "label", "score")
    return m.select("n", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("ev2_area_under_roc", _J + """
, r as (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 rk from judged),
s as (select sum(case when label = 1 then rk end) sr, count(*) filter (label = 1) p, count(*) filter (label <> 1) q from r)
select round((sr - p * (p + 1) / 2.0) / (cast(p as double) * q), 6) auc from s""")
def _(spark, folder):
    return E.area_under_roc(T.judged(spark, folder)).select(F.round("auc", 6).alias("auc"))


@query("ev3_error_rate", _J + "select round(avg(abs(label - prediction)), 6) error_rate from judged")
def _(spark, folder):
    return E.error_rate(T.judged(spark, folder)).select(F.round("error_rate", 6).alias("error_rate"))


@query("ev4_accuracy", _G + "select round(avg(case when label = prediction then 1.0 else 0.0 end), 6) accuracy from guessed")
def _(spark, folder):
    return E.accuracy(T.guessed(spark, folder)).select(F.round("accuracy", 6).alias("accuracy"))


_CLASS_SQL = _G + """
, k as (select label c from guessed union select prediction from guessed),
s as (select c, (select count(*) from guessed where label = c) sup, (select count(*) from guessed where prediction = c) prd,
        (select count(*) from guessed where prediction = c and label = c) hit from k),
m as (select c, sup, hit, case when prd = 0 then 0.0 else cast(hit as double) / prd end p, case when sup = 0 then 0.0 else cast(hit as double) / sup end r,
        case when sup + prd = 0 then 0.0 else 2.0 * hit / (sup + prd) end f from s)"""


@query("ev5_f1_scores", _CLASS_SQL + """
select round(sum(hit) / sum(sup), 6) f1_micro, round(avg(f), 6) f1_macro, round(sum(f * sup) / sum(sup), 6) f1_weighted from m""")
def _(spark, folder):
    f = E.f1_scores(T.guessed(spark, folder))
    return f.select(*[F.round(c, 6).alias(c) for c in f.columns])


@query("ev6_classification_report", _CLASS_SQL + """
select c "class", round(p, 6) "precision", round(r, 6) recall, round(f, 6) f1, cast(sup as bigint) support from m
union all select 'accuracy', round(sum(hit) / sum(sup), 6), round(sum(hit) / sum(sup), 6), round(sum(hit) / sum(sup), 6), cast(sum(sup) as bigint) from m
union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(sup) as bigint) from m
union all select 'weighted avg', round(sum(p * sup) / sum(sup), 6), round(sum(r * sup) / sum(sup), 6), round(sum(f * sup) / sum(sup), 6), cast(sum(sup) as bigint) from m""")
def _(spark, folder):
    report = E.classification_report(T.guessed(spark, folder))
    return report.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("ev7_confusion_matrix", _G + """
select label actual, count(*) filter (prediction = 'de') de, count(*) filter (prediction = 'en') en,
  count(*) filter (prediction = 'es') es, count(*) filter (prediction = 'fr') fr from guessed group by label""")
def _(spark, folder):
    return E.confusion_matrix(T.guessed(spark, folder), classes=["de", "en", "es", "fr"])


@query("ev8_roc_points", _J + """
, c as (select score, count(*) filter (label = 1) p, count(*) filter (label <> 1) q from judged group by score)
select score threshold, round(cast(sum(q) over (order by score desc) as double) / (select sum(q) from c), 6) fpr,
  round(cast(sum(p) over (order by score desc) as double) / (select sum(p) from c), 6) tpr from c""")
def _(spark, folder):
    points = E.roc_points(T.judged(spark, folder))
    return points.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))
