"""Counts, distributions, extremes, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import tokens
from ..operators import clean as C
from ..operators import stats as S
from ..operators import text as TX
from . import tables as T
from .catalog import query
from .sql_text import STOPWORD_LIST, kept, ngrams, tokens as tokens_sql, words as words_sql

_R = f"with {T.REVIEWS_SQL} "
_S = T.SENTIMENT_SQL


def _labelled(spark, folder):
    df = C.with_sentiment(T.reviews(spark, folder), "rating_raw")
    return C.with_binary_label(df).select("doc_id", "review_text", "sentiment", "label")


@query("ag1_length_range", _R + "select cast(max(length(review_text)) as bigint) max_length, cast(min(length(review_text)) as bigint) min_length from reviews")
def _(spark, folder):
    return S.length_range(T.reviews(spark, folder), "review_text")


@query("ag2_extreme_texts", _R + """
select 'longest' which, doc_id "key", cast(length(review_text) as bigint) as length, review_text "text" from (select * from reviews order by length(review_text) desc, doc_id limit 1)
union all
select 'shortest', doc_id, cast(length(review_text) as bigint), review_text from (select * from reviews order by length(review_text), doc_id limit 1)""")
def _(spark, folder):
    return S.extreme_texts(T.reviews(spark, folder), "review_text", "doc_id")


@query("ag2_extreme_ties", _R + """
, m as (select doc_id, cast(length(review_text) as bigint) as length from reviews)
select doc_id, length, case when length = (select max(length) from m) then 'longest' else 'shortest' end which
from m where length = (select max(length) from m) or length = (select min(length) from m)""")
def _(spark, folder):
    return S.extreme_ties(T.reviews(spark, folder).select("doc_id", "review_text"), "review_text").drop("review_text")


@query("ag3_rating_levels", _R + """
select cast(v as double) rating, count(r.doc_id) n from range(0, 6) t(v)
left join reviews r on try_cast(r.rating_raw as double) = v group by v""")
def _(spark, folder):
    return S.rating_distribution(T.reviews(spark, folder), "rating_raw", range(6))


@query("ag3_rating_values", _R + """
select try_cast(rating_raw as double) rating, count(*) n from reviews where try_cast(rating_raw as double) is not null group by 1""")
def _(spark, folder):
    return S.rating_distribution(T.reviews(spark, folder), "rating_raw")


@query("ag4_sentiment_counts", _R + f"""
select {_S} sentiment, count(*) n, round(count(*) / sum(count(*)) over (), 6) as share from reviews group by 1""")
def _(spark, folder):
    return S.class_counts(_labelled(spark, folder), "sentiment")


@query("ag5_item_frequency", _R + "select asins, count(*) n from reviews where asins is not null group by asins order by n desc, asins")
def _(spark, folder):
    return S.item_frequency(T.reviews(spark, folder), "asins").select("asins", "n")


@query("ag6_log_item_frequency", _R + "select id, round(log10(count(*)), 6) log10_n from reviews group by id")
def _(spark, folder):
    return S.item_frequency(T.reviews(spark, folder), "id").select("id", F.round("log10_n", 6).alias("log10_n"))


@query("ag7_item_ratings", _R + """
, v as (select id, try_cast(rating_raw as double) r from reviews),
g as (select id, count(*) n, count(r) n_rated, avg(r) m, stddev_samp(r) s from v group by id)
select id, n, n_rated, round(m, 6) mean_rating, round(m - 1.96 * s / sqrt(n_rated), 6) low, round(m + 1.96 * s / sqrt(n_rated), 6) high from g""")
def _(spark, folder):
    stats = S.item_ratings(T.reviews(spark, folder), "id", "rating_raw")
    return stats.select("id", "n", "n_rated", *[F.round(c, 6).alias(c) for c in ("mean_rating", "low", "high")])


_POISSON_SQL = """case when n < 60 then list_reduce(list_prepend({'k': 0.0::double, 'p': exp(-n), 's': exp(-n)},
    list_transform(range(1, cast(trunc(n * 3 + 20) as bigint) + 1), lambda i: {'k': 0.0::double, 'p': 0.0::double, 's': 0.0::double})),
    lambda a, b: case when a.s >= u then a else {'k': a.k + 1, 'p': a.p * n / (a.k + 1), 's': a.s + a.p * n / (a.k + 1)} end).k
  else greatest(0.0, floor(n + sqrt(n) * sqrt(-2 * ln(u)) * cos(6.283185307179586 * v) + 0.5)) end"""


@query("ag7_bootstrap_intervals", _R + f"""
, c as (select id, try_cast(rating_raw as double) r, cast(count(*) as double) n from reviews where try_cast(rating_raw as double) is not null group by all),
h as (select *, md5(concat_ws('|', id, cast(r as varchar), cast(rep as varchar), '42')) d from c, range(1, 1001) t(rep)),
u as (select *, (cast('0x' || substr(d, 1, 8) as bigint) + 0.5::double) / 4294967296.0::double u, (cast('0x' || substr(d, 9, 8) as bigint) + 0.5::double) / 4294967296.0::double v from h),
w as (select *, {_POISSON_SQL} w from u),
m as (select id, rep, sum(w * r) / nullif(sum(w), 0) m from w group by all),
b as (select id, quantile_cont(m, 0.025) low, quantile_cont(m, 0.975) high from m group by id),
g as (select id, cast(sum(n) as bigint) n_rated, sum(n * r) / sum(n) mean_rating from c group by id)
select id, n_rated, round(mean_rating, 9) mean_rating, round(low, 9) low, round(high, 9) high from g join b using (id)""")
def _(spark, folder):
    found = S.bootstrap_intervals(T.reviews(spark, folder), "id", "rating_raw")
    return found.select("id", "n_rated", *[F.round(c, 9).alias(c) for c in ("mean_rating", "low", "high")])


@query("ag8_share_recommended", _R + """
select asins, count(*) n, round(avg(case when coalesce(try_cast(rating_raw as double) >= 4, true) then 1 else 0 end), 6) share_recommended
from reviews group by asins""")
def _(spark, folder):
    df = T.full_reviews(spark, folder).select("asins", "review_doRecommend")
    return S.share_recommended(df, "asins", "review_doRecommend").withColumn(
        "share_recommended", F.round("share_recommended", 6)
    )


@query("ag9_top_items", _R + """
select id, count(*) n, round(avg(try_cast(rating_raw as double)), 6) mean_rating from reviews group by id order by n desc, id limit 10""")
def _(spark, folder):
    return S.top_items(T.reviews(spark, folder), "id", "rating_raw").withColumn("mean_rating", F.round("mean_rating", 6))


@query("ag10_class_word_weights", _R + f"""
, w as (select case when {_S} = 'Positive' then 1 else 0 end as label, unnest(regexp_split_to_array(review_text, '[ .]')) word from reviews),
c as (select label, word, count(*) n from w group by all),
t as (select *, row_number() over (partition by label order by n desc, word) rk from c)
select cast(label as integer) as label, word, n, cast(round(n / 100) as bigint) weight from t where rk <= 1000 and word not in ('', '<br', '/><br')""")
def _(spark, folder):
    return S.class_word_weights(_labelled(spark, folder), "review_text", "label")


@query("ag11_ngram_top50", f"""
with t as (select {tokens_sql('text')} w from documents where text is not null)
select ngram, count(*) n from (select unnest({ngrams('w', 2)}) ngram from t) group by ngram order by n desc, ngram limit 50""")
def _(spark, folder):
    docs = T.documents(spark, folder).where(F.col("text").isNotNull())
    return TX.top_ngrams(docs.select(tokens(F.col("text")).alias("w")), "w", 2, 50)


@query("ag11_trigram_top15", f"""
with t as (select {tokens_sql('text')} w from documents where text is not null)
select ngram, count(*) n from (select unnest({ngrams('w', 3)}) ngram from t) group by ngram order by n desc, ngram limit 15""")
def _(spark, folder):
    docs = T.documents(spark, folder)
    return TX.top_ngrams(docs.select(tokens(F.col("text")).alias("w")), "w", 3, 15)


@query("ag12_ngram_top_per_class", _R + f"""
, t as (select case when {_S} = 'Positive' then 1 else 0 end as label, {kept('(' + tokens_sql('review_text') + ')')} w from reviews),
c as (select label, unnest({ngrams('w', 2)}) ngram from t),
g as (select label, ngram, count(*) n from c group by all),
r as (select *, row_number() over (partition by label order by n desc, ngram) rk from g)
select cast(label as integer) as label, ngram, n, cast(rk as integer) "rank" from r where rk <= 1000""")
def _(spark, folder):
    df = TX.with_filtered(TX.with_tokens(_labelled(spark, folder), "review_text"))
    return S.top_per_group(TX.ngram_counts(df, "filtered", 2, ["label"]), "label", "ngram")


@query("ag12_ngram_cloud", _R + f"""
, t as (select {kept('(' + tokens_sql('review_text') + ')')} w from reviews where {_S} = 'Positive'),
g as (select ngram, count(*) n from (select unnest({ngrams('w', 2)}) ngram from t) group by all order by n desc, ngram limit 1000),
j as (select replace(ngram, ' ', '_') ngram, n from g)
select ngram, n, cast(floor(round(n) / 100) as bigint) weight from j
where not contains(ngram, '/><br') and not starts_with(ngram, '_') and not ends_with(ngram, '_')""")
def _(spark, folder):
    df = C.of_class(_labelled(spark, folder), "sentiment", "Positive")
    df = TX.with_filtered(TX.with_tokens(df, "review_text"))
    return TX.ngram_cloud(TX.top_ngrams(df, "filtered", 2, 1000))


@query("ag13_word_frequency", f"""
select word, count(*) n from (select unnest({words_sql('text')}) word from documents) where word not in {STOPWORD_LIST} group by word""")
def _(spark, folder):
    return TX.word_frequency(T.documents(spark, folder), "text")


@query("ag13_word_frequency_by_sentiment", _R + f"""
select sentiment, word, count(*) n from (select {_S} sentiment, unnest({words_sql('review_text')}) word from reviews)
where word not in {STOPWORD_LIST} group by all""")
def _(spark, folder):
    return TX.word_frequency(_labelled(spark, folder), "review_text", ["sentiment"])


@query("ag14_hash_sample", "select doc_id, lang from documents order by md5(concat(cast(doc_id as varchar), '|42')), doc_id limit 100")
def _(spark, folder):
    return S.hash_sample(T.documents(spark, folder).select("doc_id", "lang"), "doc_id", 100)
