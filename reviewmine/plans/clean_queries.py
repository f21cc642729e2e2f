"""Projection, filters and null handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ratings import rating_number
from ..functions.text import markup_kept, no_null_array, ngram_kept, tokens, underscore_ngram
from ..operators import clean as C
from ..operators import text as TX
from . import tables as T
from .catalog import query
from .sql_text import ngrams, tokens as tokens_sql

_R = f"with {T.REVIEWS_SQL} "
_S = T.SENTIMENT_SQL


@query("pf1_select_rename", _R + """select id reviewer, asins item, rating_raw rating, upper(brand) brand_code from reviews""")
def _(spark, folder):
    df = T.reviews(spark, folder)
    picked = C.pick(df, reviewer="id", item="asins", rating="rating_raw", brand="brand")
    return picked.withColumn("brand_code", F.upper("brand")).drop("brand")


@query("pf2_drop_columns", _R + "select id, asins, brand, doc_id, rating_raw from reviews")
def _(spark, folder):
    return C.drop_columns(T.reviews(spark, folder), "review_id", "review_text")


@query("pf3_drop_incomplete", _R + "select id, doc_id, rating_raw from reviews where rating_raw is not null")
def _(spark, folder):
    return C.drop_incomplete(T.reviews(spark, folder).select("id", "doc_id", "rating_raw"))


@query("pf4_fill_missing", _R + "select doc_id, coalesce(rating_raw, '') rating_raw, coalesce(try_cast(rating_raw as double), 0) rating from reviews")
def _(spark, folder):
    df = T.reviews(spark, folder).select("doc_id", "rating_raw", rating_number(F.col("rating_raw")).alias("rating"))
    return C.fill_missing(df, {"rating_raw": "", "rating": 0.0})


@query("pf5_keep_present", _R + "select doc_id, try_cast(rating_raw as double) rating from reviews where try_cast(rating_raw as double) is not null")
def _(spark, folder):
    df = T.reviews(spark, folder).select("doc_id", rating_number(F.col("rating_raw")).alias("rating"))
    return C.keep_present(df, "rating")


@query("pf6_of_class", _R + f"select doc_id, {_S} sentiment from reviews where {_S} = 'Positive'")
def _(spark, folder):
    df = C.with_sentiment(T.reviews(spark, folder), "rating_raw").select("doc_id", "sentiment")
    return C.of_class(df, "sentiment", "Positive")


@query("pf7_like_filters", _R + f"""
, t as (select {tokens_sql('review_text')} w from reviews where not contains(review_text, '/><br')),
g as (select replace(unnest({ngrams('w', 2)}), ' ', '_') gram from t)
select gram, count(*) n from g
where not contains(gram, '/><br') and not starts_with(gram, '_') and not ends_with(gram, '_') group by gram""")
def _(spark, folder):
    df = T.reviews(spark, folder).where(markup_kept(F.col("review_text")))
    grams = TX.explode_ngrams(df.select(tokens(F.col("review_text")).alias("w")), "w", 2, out="gram")
    joined = grams.select(underscore_ngram(F.col("gram")).alias("gram")).where(ngram_kept(F.col("gram")))
    return joined.groupBy("gram").agg(F.count("*").alias("n"))


@query("pf8_sentiment", _R + f"""select doc_id, {_S} sentiment,
  case when try_cast(rating_raw as double) < 3 then 'Negative' when try_cast(rating_raw as double) > 3 then 'Positive' else 'Neutral' end sentiment_fractional
from reviews""")
def _(spark, folder):
    df = C.with_sentiment(T.reviews(spark, folder), "rating_raw")
    df = C.with_sentiment(df, "rating_raw", "sentiment_fractional", fractional=True)
    return df.select("doc_id", "sentiment", "sentiment_fractional")


@query("pf9_binary_label", _R + f"select doc_id, cast(case when {_S} = 'Positive' then 1 else 0 end as integer) as label from reviews")
def _(spark, folder):
    df = C.with_binary_label(C.with_sentiment(T.reviews(spark, folder), "rating_raw"))
    return df.select("doc_id", "label")


@query("pf10_safe_casts", _R + """select doc_id, try_cast(rating_raw as double) as_double,
  cast(trunc(try_cast(rating_raw as double)) as integer) as_int, cast(doc_id as double) key_double from reviews""")
def _(spark, folder):
    number = rating_number(F.col("rating_raw"))
    return T.reviews(spark, folder).select(
        "doc_id", number.alias("as_double"), number.try_cast("int").alias("as_int"),
        F.col("doc_id").cast("double").alias("key_double"),
    )


@query("pf11_text_length", "select doc_id, cast(length(text) as integer) as length from documents")
def _(spark, folder):
    return C.with_length(T.documents(spark, folder), "text").select("doc_id", "length")


@query("pf12_missing_profile", _R + """
select 'id' "column", count(*) filter (id is null or id = '') missing from reviews
union all select 'asins', count(*) filter (asins is null or asins = '') from reviews
union all select 'brand', count(*) filter (brand is null or brand = '') from reviews
union all select 'review_id', count(*) filter (review_id is null or review_id = '') from reviews
union all select 'review_text', count(*) filter (review_text is null or review_text = '') from reviews
union all select 'doc_id', count(*) filter (doc_id is null) from reviews
union all select 'rating_raw', count(*) filter (rating_raw is null or rating_raw = '') from reviews""")
def _(spark, folder):
    return C.missing_profile(T.reviews(spark, folder))


@query("pf13_no_null_arrays", _R + f"""
select doc_id, cast(case when rating_raw is null then 0 else len({tokens_sql('review_text')}) end as integer) n_tokens from reviews""")
def _(spark, folder):
    words = F.when(F.col("rating_raw").isNotNull(), tokens(F.col("review_text")))
    return T.reviews(spark, folder).select("doc_id", F.size(no_null_array(words)).alias("n_tokens"))


_VIEW_SQL = """
select brand, count(*) as n, round(count(*) / 100.0) as hundreds
from {name} where review_text not like '%/><br%' and brand is not null
group by brand order by n desc, brand"""


@query("pf14_sql_view", _R + _VIEW_SQL.format(name="reviews"))
def _(spark, folder):
    rows = C.run_sql(spark, _VIEW_SQL.format(name="mined_reviews"), mined_reviews=T.reviews(spark, folder))
    return rows.select("brand", "n", F.col("hundreds").cast("double").alias("hundreds"))
