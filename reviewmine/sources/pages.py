"""From stored pages to products and reviews.

Input is a table of pages (url, html); crawling itself is not part of this
package. The markers that name the blocks are parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.ratings import helpful_votes, leading_number, recommends
from ..operators.joins import lookup_join


@dataclass(frozen=True)
class Markers:
    """Where a shop page keeps its fields, as (tag, attribute pattern)."""

    site: str = "https://www.amazon.com"
    card: tuple = ("div", H.attr_marker("data-component-type", "s-search-result"))
    card_price: tuple = ("span", H.class_marker("a-offscreen"))
    card_count: tuple = ("span", H.attr_marker("class", "a-size-base s-underline-text"))
    title: tuple = ("span", H.attr_marker("id", "productTitle"))
    spec_table: tuple = ("table", H.class_marker("prodDetTable"))
    bullets: tuple = ("div", H.attr_marker("id", "detailBullets_feature_div"))
    bullet: tuple = ("span", H.class_marker("a-list-item"))
    review: tuple = ("div", H.attr_marker("data-hook", "review"))
    review_date: tuple = ("span", H.attr_marker("data-hook", "review-date"))
    review_text: tuple = ("span", H.attr_marker("data-hook", "review-body"))
    review_title: tuple = ("a", H.attr_marker("data-hook", "review-title"))
    review_stars: tuple = ("i", H.attr_marker("data-hook", "review-star-rating"))
    other_stars: tuple = ("i", H.attr_marker("data-hook", "cmps-review-star-rating"))
    review_user: tuple = ("span", H.class_marker("a-profile-name"))
    review_votes: tuple = ("span", H.attr_marker("data-hook", "helpful-vote-statement"))
    labels: dict = field(
        default_factory=lambda: {"asins": "ASIN", "manufacturer": "Manufacturer", "brand": "Brand"}
    )


SHOP = Markers()


def page_urls(df: DataFrame, base: str, n: int, out: str = "page_url") -> DataFrame:
    """Result pages 1..n of every base address."""
    pages = df.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(n))))
    return pages.withColumn(out, F.concat(base, F.lit("&page="), F.col("page").cast("string")))


def review_page_url(product_url: Column, page: Column | None = None) -> Column:
    """Address of a product's reviews; every 'dp' is replaced."""
    url = F.concat(
        F.replace(product_url, F.lit("dp"), F.lit("product-reviews")),
        F.lit("?reviewerType=all_reviews"),
    )
    if page is None:
        return url
    return F.when(page > 1, F.concat(url, F.lit("&pageNumber="), page.cast("string"))).otherwise(url)


def _blocks(pages: DataFrame, keep: list[str], found: Column) -> DataFrame:
    """One row (_pos, _block) per element of an array that is computed once.

    Outer, because a plain explode would add a size test that cuts the page a
    second time.
    """
    made = pages.select(*keep, found.alias("_found"))
    rows = made.select(*keep, F.posexplode_outer("_found").alias("_pos", "_block"))
    return rows.where(F.col("_block").isNotNull())


def extract_product_cards(pages: DataFrame, html: str = "html", markers: Markers = SHOP) -> DataFrame:
    """One row per product card of a result page, 'N/A' where a field is missing."""
    keep = [c for c in pages.columns if c != html]
    cards = _blocks(pages, keep, H.blocks(F.col(html), markers.card))
    card = F.col("_block")
    heading = H.inner_html(card, "h2")
    href = H.attribute(heading, "a", "href")
    missing = F.lit("N/A")
    has_link = H.has_element(heading, "a")
    rows = cards.select(
        *keep,
        (F.col("_pos") + 1).alias("position"),
        F.coalesce(H.visible_text(heading), missing).alias("name"),
        F.when(has_link, F.concat(F.lit(markers.site), H.decode_entities(href)))
        .otherwise(missing).alias("product_url"),
        H.element_text(card, *markers.card_price, default="N/A").alias("price"),
        H.element_text(card, "i", default="N/A").alias("rating"),
        H.element_text(card, *markers.card_count, default="N/A").alias("review_count"),
    )
    return rows.where(F.col("product_url").isNotNull())  # a link without an address drops the card


def _spec_rows(rows: Column) -> Column:
    """(heading, value) of every full row of the specification tables."""
    full = F.filter(rows, lambda r: H.has_element(r, "th") & H.has_element(r, "td"))
    return F.transform(
        full,
        lambda r: F.struct(
            H.element_text(r, "th").alias("heading"), H.element_text(r, "td").alias("value")
        ),
    )


def _spec_value(rows: Column, name: str, markers: Markers) -> Column:
    """Last row whose heading holds the label; a heading counts for the first label it holds."""
    labels = list(markers.labels.values())
    earlier = labels[: labels.index(markers.labels[name])]

    def decides(row):
        test = F.contains(row["heading"], F.lit(markers.labels[name]))
        for label in earlier:
            test = test & ~F.contains(row["heading"], F.lit(label))
        return test

    return F.coalesce(F.try_element_at(F.filter(rows, decides), F.lit(-1))["value"], F.lit(""))


def _bullet_value(texts: Column, name: str, markers: Markers) -> Column:
    """First bullet with the label and something after its last colon."""
    hits = F.filter(texts, lambda t: F.contains(t, F.lit(markers.labels[name])))
    values = F.transform(hits, lambda t: F.trim(F.element_at(F.split(t, ":"), -1)))
    return F.coalesce(F.get(F.filter(values, lambda v: v != ""), F.lit(0)), F.lit(""))


def extract_technical_details(pages: DataFrame, html: str = "html", markers: Markers = SHOP) -> DataFrame:
    """asins, brand, manufacturer and the (always empty) categories of a product page."""
    keep = [c for c in pages.columns if c != html]
    box = H.inner_html(F.col(html), *markers.bullets)
    cut = pages.select(*keep, html, H.blocks(F.col(html), markers.spec_table, ("tr", "")).alias("_tr"))
    parts = cut.select(
        *keep,
        H.element_text(F.col(html), *markers.title, default="").alias("name"),
        _spec_rows(F.col("_tr")).alias("_rows"),
        F.transform(H.elements(box, *markers.bullet), H.visible_text).alias("_bullets"),
    )

    def value(name):
        spec = _spec_value(F.col("_rows"), name, markers)
        return F.when(spec != "", spec).otherwise(
            _bullet_value(F.col("_bullets"), name, markers)
        ).alias(name)

    return parts.select(
        *keep, "name", value("asins"), value("brand"), value("manufacturer"),
        F.array().cast("array<string>").alias("categories"),
    )


def page_title(html: Column) -> Column:
    """First heading of any page, else its title element, else ''."""
    return F.coalesce(H.element_text(html, "h1"), H.element_text(html, "title"), F.lit(""))


def link_targets(html: Column) -> Column:
    """Addresses of all list links of a page, in order."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)<li\b[^>]*>\s*<a\b[^>]*\shref\s*=\s*["']([^"']*)["']"""), F.lit(1))


def extract_reviews(
    pages: DataFrame, html: str = "html", url: str = "url", seen_at: Column | None = None,
    markers: Markers = SHOP, repaired: bool = True,
) -> DataFrame:
    """One row per review block with the 13 review fields.

    ``repaired=False`` drops a review whose stars or votes cannot be read, as a
    strict reader does; the default keeps it with the field's default value.
    """
    seen = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if seen_at is None else seen_at
    keep = [c for c in pages.columns if c != html]
    blocks = _blocks(
        pages.withColumn("_seen", seen), [*keep, "_seen"], H.blocks(F.col(html), markers.review)
    )
    block = F.col("_block")
    stars = F.coalesce(
        H.element_text(block, *markers.review_stars), H.element_text(block, *markers.other_stars)
    )
    votes = H.element_text(block, *markers.review_votes)
    fields = blocks.select(
        *keep, "_seen", (F.col("_pos") + 1).alias("position"),
        H.element_text(block, *markers.review_date, default="").alias("review_date"),
        stars.alias("_stars"), votes.alias("_votes"),
        F.coalesce(
            H.attribute(block, markers.review[0], "id", markers.review[1]),
            F.concat(F.lit("rev_"), F.md5(F.concat_ws("|", F.col(url), F.col("_pos").cast("string")))),
        ).alias("review_id"),
        H.element_text(block, *markers.review_text, default="").alias("review_text"),
        H.element_text(block, *markers.review_title, default="").alias("review_title"),
        H.element_text(block, *markers.review_user, default="Anonymous").alias("review_username"),
    )
    fields = fields.withColumn("_rating", leading_number(F.col("_stars")))
    counted = F.when(F.col("_votes").isNull(), 0).otherwise(helpful_votes(F.col("_votes"), repaired))
    if not repaired:
        fields = fields.where(
            (F.col("_stars").isNull() | F.col("_rating").isNotNull()) & counted.isNotNull()
        )
    return fields.select(
        *keep, "position", "review_date",
        F.col("_seen").alias("review_dateAdded"),
        F.array("_seen").alias("review_dateSeen"),
        recommends(F.col("_rating")).alias("review_doRecommend"),
        "review_id",
        counted.alias("review_numHelpful"),
        F.coalesce("_rating", F.lit(0.0)).alias("review_rating"),
        F.col(url).alias("review_sourceURLs"),
        "review_text", "review_title",
        F.lit("").alias("review_userCity"), F.lit("").alias("review_userProvince"),
        "review_username",
    )


def visited_pages(
    pages: DataFrame, product: str = "product", page: str = "page", n_reviews: str = "n_reviews",
    full: int = 10,
) -> DataFrame:
    """Review pages up to and including the first that is not full."""
    last = (
        pages.where(F.col(n_reviews) < full).groupBy(product).agg(F.min(page).alias("_last"))
    )
    marked = lookup_join(pages, last, [product], salt_by=[page])
    return marked.where(F.col("_last").isNull() | (F.col(page) <= F.col("_last"))).drop("_last")


def merge_cards(details: DataFrame, cards: DataFrame, on: str = "product_url") -> DataFrame:
    """Card price, rating and review count laid over the details of the same address.

    An address that several cards name, as when a product is on two result pages, takes the smallest of them, so
    no row of the details is repeated.
    """
    fields = ["price", "rating", "review_count"]
    base = details.drop(*[f for f in fields if f in details.columns])
    linked = cards.where((F.col(on) != "N/A") & F.col(on).isNotNull())
    card = linked.groupBy(on).agg(F.min(F.struct(*fields)).alias("_card")).select(on, "_card.*")
    return base.join(card, on, "left")
