"""Review tables and page tables that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ratings import rating_number, recommends
from ..sources.tables import read_table


def spread_rows(df: DataFrame) -> DataFrame:
    """Rows of a table as stored, dealt to all cores where its files give fewer tasks: each row has much work before it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(3 * cores)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents", ["doc_id", "text", "lang", "source"])


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews; ratings hold NULL, 'N/A' and fractions besides whole stars."""
    doc = F.col("doc_id")
    rating = (
        F.when(doc % 41 == 0, F.lit(None).cast("string"))
        .when(doc % 43 == 0, "N/A")
        .when(doc % 17 == 0, "3.5")
        .otherwise(F.concat((1 + (doc * 7) % 5).cast("string"), F.lit(".0")))
    )
    return documents(spark, folder).select(
        F.concat(F.lit("prod_"), (doc % 97).cast("string")).alias("id"),
        F.col("source").alias("asins"),
        F.col("lang").alias("brand"),
        F.concat(F.lit("rev_"), doc.cast("string")).alias("review_id"),
        F.col("text").alias("review_text"),
        "doc_id",
        rating.alias("rating_raw"),
    )


# The same table as SQL text, for the comparison queries.
REVIEWS_SQL = """reviews as (
  select concat('prod_', cast(doc_id % 97 as varchar)) id, source asins, lang brand,
         concat('rev_', cast(doc_id as varchar)) review_id, text review_text, doc_id,
         case when doc_id % 41 = 0 then null when doc_id % 43 = 0 then 'N/A' when doc_id % 17 = 0 then '3.5'
              else concat(cast(1 + (doc_id * 7) % 5 as varchar), '.0') end rating_raw
  from documents)"""

SENTIMENT_SQL = (
    "case when trunc(try_cast(rating_raw as double)) < 3 then 'Negative' "
    "when trunc(try_cast(rating_raw as double)) > 3 then 'Positive' else 'Neutral' end"
)


def full_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """All 22 columns under their flat names."""
    doc = F.col("doc_id")
    rating = rating_number(F.col("rating_raw"))
    day = F.lpad((1 + doc % 28).cast("string"), 2, "0")
    return reviews(spark, folder).select(
        "id",
        F.concat(F.lit("Product "), (doc % 97).cast("string")).alias("name"),
        "asins", "brand",
        F.array().cast("array<string>").alias("categories"),
        F.upper("asins").alias("manufacturer"),
        F.concat(F.lit("$"), (doc % 97).cast("string"), F.lit(".99")).alias("price"),
        F.lit("4.1 out of 5 stars").alias("rating"),
        F.concat((doc % 97).cast("string"), F.lit(" ratings")).alias("review_count"),
        F.concat(F.lit("Reviewed on 2024-01-"), day).alias("review_date"),
        F.concat(F.lit("2024-02-"), day, F.lit("T00:00:00Z")).alias("review_dateAdded"),
        F.array(
            F.concat(F.lit("2024-02-"), day, F.lit("T00:00:00Z")), F.lit("2024-03-01T00:00:00Z")
        ).alias("review_dateSeen"),
        recommends(rating).alias("review_doRecommend"),
        "review_id",
        (doc % 13).cast("int").alias("review_numHelpful"),
        F.coalesce(rating, F.lit(0.0)).alias("review_rating"),
        F.concat(F.lit("https://shop.example/product-reviews/"), F.col("id")).alias("review_sourceURLs"),
        "review_text",
        F.concat(F.lit("Title, \"no\" "), doc.cast("string")).alias("review_title"),
        F.lit("").alias("review_userCity"),
        F.lit("").alias("review_userProvince"),
        F.concat(F.lit("user_"), (doc % 50).cast("string")).alias("review_username"),
    )


FULL_REVIEWS_SQL = REVIEWS_SQL + """, full_reviews as (
  select id, concat('Product ', cast(doc_id % 97 as varchar)) name, asins, brand, '[]' categories,
    upper(asins) manufacturer, concat('$', cast(doc_id % 97 as varchar), '.99') price,
    '4.1 out of 5 stars' rating, concat(cast(doc_id % 97 as varchar), ' ratings') review_count,
    concat('Reviewed on 2024-01-', lpad(cast(1 + doc_id % 28 as varchar), 2, '0')) review_date,
    concat('2024-02-', lpad(cast(1 + doc_id % 28 as varchar), 2, '0'), 'T00:00:00Z') "review_dateAdded",
    concat('2024-02-', lpad(cast(1 + doc_id % 28 as varchar), 2, '0'), 'T00:00:00Z,2024-03-01T00:00:00Z') "review_dateSeen",
    case when coalesce(try_cast(rating_raw as double) >= 4, true) then 'true' else 'false' end "review_doRecommend",
    review_id, cast(doc_id % 13 as varchar) "review_numHelpful",
    cast(coalesce(try_cast(rating_raw as double), 0.0) as varchar) review_rating,
    concat('https://shop.example/product-reviews/', id) "review_sourceURLs",
    review_text, concat('Title, "no" ', cast(doc_id as varchar)) review_title,
    '' "review_userCity", '' "review_userProvince",
    concat('user_', cast(doc_id % 50 as varchar)) review_username, doc_id
  from reviews)"""


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Customers rating parts: 1..5 by ordered quantity."""
    lines = read_table(spark, folder, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    orders = read_table(spark, folder, "orders", ["o_orderkey", "o_custkey"])
    rating = (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("float")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("user"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("item"),
        rating.cast("string").alias("rating"),
    )


RATINGS_SQL = """ratings as (
  select concat('c', cast(o_custkey as varchar)) "user", concat('p', cast(l_partkey as varchar)) item,
         floor((l_quantity - 1) / 10) + 1 rating
  from lineitem join orders on l_orderkey = o_orderkey)"""


def judged(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, label, prediction, score): quality labels against a score by text length."""
    labels = read_table(spark, folder, "labels", ["doc_id", "quality"])
    docs = read_table(spark, folder, "documents", ["doc_id", "n_chars"])
    score = F.round(F.col("n_chars") / (F.col("n_chars") + 1500.0), 2)
    return labels.join(docs, "doc_id").select(
        "doc_id",
        F.col("quality").cast("double").alias("label"),
        (score >= 0.5).cast("double").alias("prediction"),
        score.alias("score"),
    )


JUDGED_SQL = """judged as (
  select doc_id, cast(quality as double) label, cast(case when score >= 0.5 then 1 else 0 end as double) prediction, score
  from (select doc_id, quality, round(n_chars / (n_chars + 1500.0), 2) score
        from labels join documents using (doc_id)))"""


def guessed(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, label, prediction): the language against a guess by small words."""
    text = F.lower("text")
    guess = (
        F.when(F.contains(text, F.lit(" der ")), "de")
        .when(F.contains(text, F.lit(" el ")), "es")
        .when(F.contains(text, F.lit(" le ")), "fr")
        .otherwise("en")
    )
    return documents(spark, folder).select("doc_id", F.col("lang").alias("label"), guess.alias("prediction"))


GUESSED_SQL = """guessed as (
  select doc_id, lang label, case when contains(lower(text), ' der ') then 'de' when contains(lower(text), ' el ') then 'es'
    when contains(lower(text), ' le ') then 'fr' else 'en' end prediction from documents)"""


def _escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def review_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Review pages as a shop shows them: up to ten review blocks per product and page."""
    doc = F.col("doc_id")
    stars = F.when(
        F.col("rating_raw").isNotNull(),
        F.concat(
            F.lit('<i data-hook="review-star-rating"><span class="a-icon-alt">'),
            F.col("rating_raw"), F.lit(" out of 5 stars</span></i>"),
        ),
    ).otherwise("")
    votes = (
        F.when(doc % 7 == 0, "")
        .when(doc % 7 == 1, '<span data-hook="helpful-vote-statement">One person found this helpful</span>')
        .otherwise(
            F.concat(
                F.lit('<span data-hook="helpful-vote-statement"> 1,'), F.lpad((doc % 1000).cast("string"), 3, "0"),
                F.lit("\n people found this helpful</span>"),
            )
        )
    )
    block = F.concat(
        F.lit('<div id="'), F.col("review_id"), F.lit('" data-hook="review" class="a-section review"><div class="a-row">'),
        F.when(doc % 5 == 0, "").otherwise(
            F.concat(F.lit('<span class="a-profile-name">user_'), (doc % 50).cast("string"), F.lit("</span>"))
        ),
        F.lit("</div>"), stars,
        F.lit('<a data-hook="review-title" href="/x"><span>Title &quot;'), doc.cast("string"),
        F.lit('&quot; &#233;t&#xE9;</span></a><span data-hook="review-date">Reviewed on day '),
        (doc % 28).cast("string"), F.lit('</span><span data-hook="review-body" class="x"><span>'),
        _escaped(F.col("review_text")), F.lit("</span></span>"), votes, F.lit("</div>\n"),
    )
    rows = reviews(spark, folder).select(
        "id", (F.floor(doc / 970) + 1).cast("int").alias("page"), "doc_id", block.alias("block")
    )
    # At most ten documents share a product and a page.
    pages = rows.groupBy("id", "page").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "block"))).alias("blocks")
    )
    return pages.select(
        "id", "page",
        F.concat(F.lit("https://shop.example/dp/"), F.col("id")).alias("url"),
        F.concat(
            F.lit("<html><body><div id='list'>"), F.array_join("blocks.block", ""),
            F.lit("</div><span class='a-profile-name'>Footer</span></body></html>"),
        ).alias("html"),
    )


def search_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Result pages of a shop: up to sixteen parts as product cards on each."""
    key = F.col("p_partkey")
    part = read_table(spark, folder, "part", ["p_partkey", "p_name", "p_size"])
    name = F.concat(F.lit("<span>"), F.col("p_name"), F.lit("</span>"))
    heading = (
        F.when(key % 11 == 0, F.concat(F.lit("<h2>"), name, F.lit("</h2>")))
        .when(key % 13 == 0, "")
        .otherwise(F.concat(F.lit('<h2 class="s"><a class="l" href="/dp/'), key.cast("string"), F.lit('">'), name, F.lit("</a></h2>")))
    )
    price = F.when(key % 7 == 0, "").otherwise(
        F.concat(F.lit('<span class="a-price"><span class="a-offscreen">$'), F.col("p_size").cast("string"), F.lit(".00</span></span>"))
    )
    rating = F.when(key % 5 == 0, "").otherwise(
        F.concat(F.lit('<i class="a-icon"><span>'), (1 + key % 5).cast("string"), F.lit(".0 out of 5 stars</span></i>"))
    )
    count = F.when(key % 3 == 0, "").otherwise(
        F.concat(F.lit('<span class="a-size-base s-underline-text"> '), (key * 3).cast("string"), F.lit("</span>"))
    )
    card = F.concat(
        F.lit('<div class="s" data-component-type="s-search-result"><div>'), heading, price, rating, count, F.lit("</div></div>")
    )
    rows = part.select(F.floor(key / 16).alias("search_page"), key.alias("key"), card.alias("card"))
    return rows.groupBy("search_page").agg(  # at most sixteen parts each
        F.array_join(F.sort_array(F.collect_list(F.struct("key", "card"))).getField("card"), "").alias("html")
    )


CARDS_SQL = """cards as (
  select p_partkey, cast(floor(p_partkey / 16) as bigint) search_page,
    case when p_partkey % 11 <> 0 and p_partkey % 13 = 0 then 'N/A' else trim(regexp_replace(p_name, '[ \\t\\n]+', ' ', 'g')) end as name,
    case when p_partkey % 11 = 0 or p_partkey % 13 = 0 then 'N/A'
         else concat('https://www.amazon.com/dp/', cast(p_partkey as varchar)) end product_url,
    case when p_partkey % 7 = 0 then 'N/A' else concat('$', cast(p_size as varchar), '.00') end price,
    case when p_partkey % 5 = 0 then 'N/A' else concat(cast(1 + p_partkey % 5 as varchar), '.0 out of 5 stars') end rating,
    case when p_partkey % 3 = 0 then 'N/A' else cast(p_partkey * 3 as varchar) end review_count
  from part)"""


def product_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Product pages with a specification table, bullets, both or neither."""
    key = F.col("p_partkey")
    part = spread_rows(read_table(spark, folder, "part", ["p_partkey", "p_name", "p_brand", "p_type"]))

    def row(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"<tr><th class='h'> {label} </th><td> "), value, F.lit(" </td></tr>"))

    def bullet(label: str, value: Column) -> Column:
        return F.concat(
            F.lit(f'<li><span class="a-list-item"><span class="a-text-bold">{label} : </span> <span>'),
            value, F.lit("</span></span></li>"),
        )

    asin = F.concat(F.lit("A"), key.cast("string"))
    table = F.when(
        key % 4 < 2,
        F.concat(
            F.lit('<table class="a prodDetTable"><tbody>'), row("ASIN", F.lit("old")), row("Brand Name", F.col("p_brand")),
            row("ASIN code", asin), F.lit("</tbody></table>"),
        ),
    ).otherwise("")
    bullets = F.when(
        (key % 4).isin(1, 2),
        F.concat(
            F.lit('<div id="detailBullets_feature_div"><ul>'), bullet("ASIN", F.concat(F.lit("B"), key.cast("string"))),
            bullet("Manufacturer", F.col("p_type")), bullet("Brand", F.lit("Other")), F.lit("</ul></div>"),
        ),
    ).otherwise("")
    return part.select(
        "p_partkey",
        F.concat(F.lit("https://www.amazon.com/dp/"), key.cast("string")).alias("product_url"),
        F.concat(
            F.lit('<html><span id="productTitle" class="t">\n '), F.col("p_name"), F.lit(" </span>"), table, bullets, F.lit("</html>")
        ).alias("html"),
    )


DETAILS_SQL = """details as (
  select p_partkey, concat('https://www.amazon.com/dp/', cast(p_partkey as varchar)) product_url,
    trim(regexp_replace(p_name, '[ \\t\\n]+', ' ', 'g')) as name,
    case when p_partkey % 4 < 2 then concat('A', cast(p_partkey as varchar))
         when p_partkey % 4 = 2 then concat('B', cast(p_partkey as varchar)) else '' end asins,
    case when p_partkey % 4 < 2 then p_brand when p_partkey % 4 = 2 then 'Other' else '' end brand,
    case when p_partkey % 4 in (1, 2) then p_type else '' end manufacturer
  from part)"""
