"""Sources, sinks and field extraction."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.ratings import helpful_votes, leading_number, recommends
from ..functions.text import clean_text
from ..operators.features import hashing_stages
from ..schema import FLAT_NAMES, REVIEW_COLUMNS
from ..session import scratch_path
from ..sources import pages as P
from ..sources import reviews as R
from ..sources.models import load_pipeline, save_model
from ..sources.tables import read_table
from . import tables as T
from .catalog import query
from .sql_text import clean

FLAT = list(FLAT_NAMES.values())
_FLAT_SQL = ", ".join(f'"{c}"' for c in FLAT)
# A file keeps nothing of an empty text, so the two blank columns come back as NULL.
_FILE_SQL = (
    f"with {T.FULL_REVIEWS_SQL} select {_FLAT_SQL} from full_reviews"
).replace('"review_userCity", "review_userProvince"', 'nullif("review_userCity", \'\') "review_userCity", nullif("review_userProvince", \'\') "review_userProvince"')


def _stored(spark, folder):
    path = scratch_path(spark, "reviews")
    R.write_reviews(T.full_reviews(spark, folder), path)
    return path


@query("io1_read_reviews", f"""
with {T.FULL_REVIEWS_SQL}
select id, review_id, review_rating, "review_dateSeen", review_title, review_text from full_reviews""")
def _(spark, folder):
    return R.read_reviews(spark, _stored(spark, folder)).select(
        "id", "review_id", "review_rating", "review_dateSeen", "review_title", "review_text"
    )


@query("io2_write_reviews", _FILE_SQL)
def _(spark, folder):
    stored = (
        spark.read.option("header", True).option("escape", '"')
        .csv(_stored(spark, folder))
    )
    if stored.columns != REVIEW_COLUMNS:
        raise ValueError("column order of the file changed")
    return stored.select(*[R.unescaped(F.col(f"`{c}`")).alias(FLAT_NAMES[c]) for c in REVIEW_COLUMNS])


_NESTED_COLUMNS = ["id", "name", "review_id", "review_title", "review_rating", "review_numHelpful"]


def _products(spark, folder):
    """Products with parallel arrays; titles are kept for rated reviews only, so they run short."""
    rows = T.full_reviews(spark, folder).select(*_NESTED_COLUMNS)
    nested = R.nest_reviews(rows)
    short = F.filter("review_title", lambda t: ~F.endswith(t, F.lit("7")))
    nested = nested.withColumn("review_title", short)
    # Parts nobody reviewed are products without any review.
    part = read_table(spark, folder, "part", ["p_partkey", "p_name"]).select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name")
    )
    return nested.drop("part").unionByName(part, allowMissingColumns=True)


@query("io3_flatten_reviews", f"""
with {T.FULL_REVIEWS_SQL},
ranked as (select *, row_number() over (partition by id order by review_id) rn from full_reviews),
titles as (select id, review_title, row_number() over (partition by id order by review_id) rn
           from full_reviews where not ends_with(review_title, '7'))
select r.id, r.name, r.review_id, coalesce(t.review_title, '') review_title, r.review_rating,
       r."review_numHelpful"
from ranked r left join titles t on r.id = t.id and r.rn = t.rn
union all
select concat('part_', cast(p_partkey as varchar)), p_name, '', '', '', '' from part""")
def _(spark, folder):
    return R.flatten_reviews(_products(spark, folder)).select(*_NESTED_COLUMNS)


@query("io4_nest_reviews", f"""
with {T.FULL_REVIEWS_SQL}
select id, cast(0 as integer) part, name, count(*) n_reviews,
       string_agg(review_id, '|' order by review_id) review_ids,
       string_agg(review_title, '|' order by review_id) titles,
       string_agg("review_numHelpful", '|' order by review_id) votes
from full_reviews group by id, name""")
def _(spark, folder):
    rows = T.full_reviews(spark, folder).select(*_NESTED_COLUMNS)
    return R.nest_reviews(rows).select(
        "id", "part", "name", F.size("review_id").cast("bigint").alias("n_reviews"),
        F.array_join("review_id", "|").alias("review_ids"),
        F.array_join("review_title", "|").alias("titles"),
        F.array_join(F.col("review_numHelpful").cast("array<string>"), "|").alias("votes"),
    )


@query("io6_model_save_load", "select doc_id, true as same_after_loading from documents where text is not null")
def _(spark, folder):
    docs = T.documents(spark, folder).select(
        "doc_id", "text", (F.col("lang") == "en").cast("double").alias("label")
    )
    stages = [*hashing_stages("text"), LogisticRegression(maxIter=10, regParam=0.01)]
    fitted = Pipeline(stages=stages).fit(docs)
    loaded = load_pipeline(save_model(fitted, scratch_path(spark, "model")))
    before = fitted.transform(docs).select("doc_id", F.col("probability").alias("before"))
    after = loaded.transform(docs).select("doc_id", F.col("probability").alias("after"))
    return before.join(after, "doc_id").select(
        "doc_id", (vector_to_array("before") == vector_to_array("after")).alias("same_after_loading")
    )


@query("io7_preview", f"""
with {T.REVIEWS_SQL} select id, asins, brand, review_id, rating_raw, doc_id from reviews order by doc_id limit 20""")
def _(spark, folder):
    return R.preview(T.reviews(spark, folder), 20, "doc_id").select(
        "id", "asins", "brand", "review_id", "rating_raw", "doc_id"
    )


@query("ex1_page_urls", """
select page_id, cast(page as integer) page, concat(url, '&page=', cast(page as varchar)) page_url
from pages, range(1, 6) t(page)""")
def _(spark, folder):
    pages = read_table(spark, folder, "pages", ["page_id", "url"])
    return P.page_urls(pages, "url", 5).select("page_id", "page", "page_url")


@query("ex2_clean_text", f"select doc_id, {clean('text')} as cleaned from documents")
def _(spark, folder):
    return T.documents(spark, folder).select("doc_id", clean_text(F.col("text")).alias("cleaned"))


@query("ex3_product_cards", f"""
with {T.CARDS_SQL}
select search_page, name, product_url, price, rating, review_count from cards""")
def _(spark, folder):
    return P.extract_product_cards(T.search_pages(spark, folder)).drop("position")


@query("ex3_page_links", r"""
select page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) as target from pages""")
def _(spark, folder):
    pages = read_table(spark, folder, "pages", ["page_id", "html"])
    return pages.select("page_id", F.explode(P.link_targets(F.col("html"))).alias("target"))


@query("ex4_technical_details", f"""
with {T.DETAILS_SQL} select product_url, name, asins, brand, manufacturer from details""")
def _(spark, folder):
    return P.extract_technical_details(T.product_pages(spark, folder).drop("p_partkey")).drop("categories")


_REVIEW_FIELDS_SQL = f"""
with {T.REVIEWS_SQL}
select id, cast(floor(doc_id / 970) + 1 as integer) page, review_id,
  concat('Reviewed on day ', cast(doc_id % 28 as varchar)) review_date,
  coalesce(coalesce(try_cast(rating_raw as double), cast(null as double)) >= 4, true) "review_doRecommend",
  cast(case when doc_id % 7 = 0 then 0 when doc_id % 7 = 1 then 1 else 1000 + doc_id % 1000 end as integer) "review_numHelpful",
  coalesce(try_cast(rating_raw as double), 0.0) review_rating,
  concat('https://shop.example/dp/', id) "review_sourceURLs",
  {clean('review_text')} review_text,
  concat('Title "', cast(doc_id as varchar), '" été') review_title,
  case when doc_id % 5 = 0 then 'Anonymous' else concat('user_', cast(doc_id % 50 as varchar)) end review_username
from reviews"""


@query("ex5_extract_reviews", _REVIEW_FIELDS_SQL)
def _(spark, folder):
    found = P.extract_reviews(T.review_pages(spark, folder), seen_at=F.lit("2024-02-01T00:00:00Z"))
    return found.select(
        "id", "page", "review_id", "review_date", "review_doRecommend", "review_numHelpful", "review_rating",
        "review_sourceURLs", "review_text", "review_title", "review_username",
    )


@query("ex6_stars", f"""
with {T.REVIEWS_SQL}
select doc_id, try_cast(rating_raw as double) stars,
       coalesce(try_cast(rating_raw as double) >= 4, true) recommends from reviews""")
def _(spark, folder):
    stars = leading_number(F.concat(F.col("rating_raw"), F.lit(" out of 5 stars")))
    return T.reviews(spark, folder).select("doc_id", stars.alias("stars")).withColumn(
        "recommends", recommends(F.col("stars"))
    )


@query("ex7_helpful_votes", """
select event_id,
  cast(case when event_id % 3 = 0 then 1 when event_id % 3 = 1 then user_id + 1000 else 0 end as integer) votes,
  cast(case when event_id % 3 = 0 then null when event_id % 3 = 1 then 0 else 0 end as integer) votes_narrow
from events""")
def _(spark, folder):
    user = F.format_number(F.col("user_id") + 1000, 0)
    statement = (
        F.when(F.col("event_id") % 3 == 0, "One person found this helpful")
        .when(F.col("event_id") % 3 == 1, F.concat(user, F.lit(" people found this helpful")))
        .otherwise("Helpful")
    )
    events = read_table(spark, folder, "events", ["event_id", "user_id"])
    return events.select(
        "event_id",
        helpful_votes(statement).alias("votes"),
        helpful_votes(statement, repaired=False).alias("votes_narrow"),
    )


@query("ex8_review_page_url", """
select p_partkey, cast(page as integer) page,
  concat('https://www.amazon.com/product-reviews/', cast(p_partkey as varchar), '?reviewerType=all_reviews',
         case when page > 1 then concat('&pageNumber=', cast(page as varchar)) else '' end) review_url
from part, range(1, 4) t(page)""")
def _(spark, folder):
    products = T.product_pages(spark, folder).select("p_partkey", "product_url")
    pages = products.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(3))))
    return pages.select(
        "p_partkey", "page", P.review_page_url(F.col("product_url"), F.col("page")).alias("review_url")
    )


@query("ex9_visited_pages", f"""
with {T.REVIEWS_SQL},
counted as (select id, cast(floor(doc_id / 970) + 1 as integer) page, count(rating_raw) n_reviews from reviews group by all),
marked as (select *, max(case when n_reviews < 10 then 1 else 0 end)
             over (partition by id order by page rows between unbounded preceding and 1 preceding) short from counted)
select id, page, n_reviews from marked where coalesce(short, 0) = 0""")
def _(spark, folder):
    counted = T.reviews(spark, folder).groupBy(
        "id", (F.floor(F.col("doc_id") / 970) + 1).cast("int").alias("page")
    ).agg(F.count("rating_raw").alias("n_reviews"))
    return P.visited_pages(counted, "id", "page", "n_reviews")


@query("ex10_merge_cards", f"""
with {T.DETAILS_SQL}, {T.CARDS_SQL}
select d.product_url, d.name, d.asins, c.price, c.rating, c.review_count
from details d left join (select * from cards where product_url <> 'N/A') c using (product_url)""")
def _(spark, folder):
    details = P.extract_technical_details(T.product_pages(spark, folder).drop("p_partkey"))
    cards = P.extract_product_cards(T.search_pages(spark, folder)).where("product_url <> 'N/A'")
    return P.merge_cards(details, cards).select("product_url", "name", "asins", "price", "rating", "review_count")


@query("ex11_page_titles", f"""
with raw as (select page_id, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) h from pages),
bare as (select page_id, regexp_replace(h, '<[^>]*>', '', 'g') h from raw),
decoded as (select page_id, replace(replace(replace(replace(replace(replace(h, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
   '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&') h from bare)
select page_id, {clean('h')} as title from decoded""")
def _(spark, folder):
    pages = read_table(spark, folder, "pages", ["page_id", "html"])
    return pages.select("page_id", P.page_title(F.col("html")).alias("title"))


def _decoded(text: str) -> str:
    for name, char in H.ENTITIES.items():
        text = f"replace({text}, '{name}', chr({ord(char)}))"
    return f"replace({text}, '&amp;', '&')"


@query("ex11_page_text", f"""
with bare as (select page_id, regexp_replace(regexp_replace(regexp_replace(html, '{H.UNSEEN}', ' ', 'g'),
   '{H.INLINE_TAGS}', '', 'g'), '<[^>]*>', ' ', 'g') h from pages),
decoded as (select page_id, {_decoded('h')} h from bare)
select page_id, {clean('h')} as body from decoded""")
def _(spark, folder):
    pages = read_table(spark, folder, "pages", ["page_id", "html"])
    return pages.select("page_id", H.page_text(F.col("html")).alias("body"))
