"""Files and pages."""

import pytest
from pyspark.sql import functions as F

from reviewmine.functions import html as H
from reviewmine.functions.html import element_text, visible_text
from reviewmine.schema import FLAT_NAMES, REVIEW_COLUMNS, typed_reviews
from reviewmine.sources import pages as P
from reviewmine.sources import reviews as R


def block(rid, stars="4.0 out of 5 stars", votes="", body="Fine", kind="review-star-rating", user="Ann"):
    rating = f'<i data-hook="{kind}"><span>{stars}</span></i>' if stars else ""
    helpful = f'<span data-hook="helpful-vote-statement">{votes}</span>' if votes else ""
    name = f'<span class="a-profile-name">{user}</span>' if user else ""
    ident = f'id="{rid}" ' if rid else ""
    return (
        f'<div {ident}data-hook="review" class="a"><div>{name}</div>{rating}'
        f'<a data-hook="review-title"><span>Title</span></a><span data-hook="review-date">May 1</span>'
        f'<span data-hook="review-body"><span>{body}</span> more<span> end</span></span>{helpful}</div>'
    )


@pytest.fixture(scope="module")
def review_pages(spark):
    rows = [
        ("u1", "<html>" + "".join(block(f"r{i}") for i in range(10)) + "</html>"),
        ("u2", "<html>" + block("a", stars="", user="", body="x &amp; y<br>z")
         + block("b", votes="1,234 people found this helpful", stars="2.0 out", kind="cmps-review-star-rating")
         + block("", votes="One person found this helpful")
         + '<span class="a-profile-name">Footer</span></html>'),
        ("u3", "<html>none</html>"), ("u4", None),
    ]
    return spark.createDataFrame(rows, "url string, html string")


def test_extract_reviews(review_pages):
    rows = P.extract_reviews(review_pages, seen_at=F.lit("2024-01-01T00:00:00Z")).collect()
    assert sum(r["url"] == "u1" for r in rows) == 10 and {r["url"] for r in rows} == {"u1", "u2"}
    a, b, c = sorted((r for r in rows if r["url"] == "u2"), key=lambda r: r["position"])
    assert (a["review_rating"], a["review_doRecommend"], a["review_username"]) == (0.0, True, "Anonymous")
    assert a["review_text"] == "x & yz more end"
    assert (b["review_rating"], b["review_doRecommend"], b["review_numHelpful"]) == (2.0, False, 1234)
    assert c["review_numHelpful"] == 1 and c["review_id"].startswith("rev_")
    assert c["review_dateSeen"] == ["2024-01-01T00:00:00Z"] and c["review_sourceURLs"] == "u2"


def test_strict_reading_drops_unreadable_reviews(review_pages):
    rows = P.extract_reviews(review_pages, repaired=False).where("url = 'u2'").collect()
    assert sorted(r["review_id"] for r in rows) == ["a", "b"]
    assert all(r["review_numHelpful"] == 0 for r in rows)


PRODUCT = '<span id="productTitle"> Big\n Tab </span>'
SPEC = (
    '<table class="x prodDetTable"><tr><th> ASIN </th><td>A1</td></tr><tr><th>Brand, Manufacturer</th><td>M1</td></tr>'
    '<tr><th>no value</th></tr><tr><th>ASIN 2</th><td> A2 </td></tr></table>'
)
BULLETS = (
    '<div id="detailBullets_feature_div"><span class="a-list-item"><span>ASIN :</span> <span>B:1</span></span>'
    '<span class="a-list-item"><span>Brand :</span></span><span class="a-list-item">Brand : Acme</span>'
    '<span class="a-list-item">Manufacturer: Other</span></div>'
)


def test_technical_details(spark):
    rows = [("spec", PRODUCT + SPEC), ("bullets", BULLETS), ("both", SPEC + BULLETS), ("none", "<p>x</p>")]
    df = spark.createDataFrame(rows, "url string, html string")
    got = {r["url"]: (r["asins"], r["brand"], r["manufacturer"]) for r in P.extract_technical_details(df).collect()}
    assert got == {
        "spec": ("A2", "", "M1"), "bullets": ("1", "Acme", "Other"), "both": ("A2", "Acme", "M1"), "none": ("", "", ""),
    }
    assert P.extract_technical_details(df).where("url = 'spec'").first()["name"] == "Big Tab"


def test_product_cards(spark):
    card = '<div data-component-type="s-search-result">{}</div>'
    html = "".join(
        card.format(x) for x in [
            '<h2><a href="/dp/1?a=1&amp;b=2">One  <b>item</b></a></h2><span class="x a-offscreen">$5</span><i>4.1</i>'
            '<span class="a-size-base s-underline-text">12</span>',
            "<h2>Plain</h2>", "<p>x</p>", "<h2><a>no address</a></h2>",
        ]
    )
    df = spark.createDataFrame([("p", html)], "page string, html string")
    rows = [tuple(r)[2:] for r in P.extract_product_cards(df).orderBy("position").collect()]
    assert rows == [
        ("One item", "https://www.amazon.com/dp/1?a=1&b=2", "$5", "4.1", "12"),
        ("Plain", "N/A", "N/A", "N/A", "N/A"), ("N/A", "N/A", "N/A", "N/A", "N/A"),
    ]


def test_entities_are_decoded(spark):
    df = spark.createDataFrame([("<p>a&lt;b &#233;&#xE9; &amp;lt; &euro;&nbsp;x &#9999999; &unknown;</p>",)], "h string")
    assert df.select(visible_text(F.col("h"))).first()[0] == "a<b éé &lt; € x &#9999999; &unknown;"


def test_nested_elements_do_not_end_early(spark):
    df = spark.createDataFrame([("<div><span class='t'>a<span>b<span>c</span></span>d</span>e</div>",)], "h string")
    assert df.select(element_text(F.col("h"), "span", "class='t'")).first()[0] == "abcd"


def test_last_page_rule(spark):
    rows = [("a", 1, 10), ("a", 2, 3), ("a", 3, 10), ("b", 1, 10), ("b", 2, 10), ("c", 1, 0)]
    df = spark.createDataFrame(rows, "product string, page int, n_reviews int")
    got = sorted((r["product"], r["page"]) for r in P.visited_pages(df).collect())
    assert got == [("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1)]


def test_review_urls(spark):
    df = spark.createDataFrame([("http://x/dp/dp1", 1), ("http://x/dp/2", 3)], "u string, p int")
    got = [r[0] for r in df.select(P.review_page_url(F.col("u"), F.col("p"))).collect()]
    assert got == [
        "http://x/product-reviews/product-reviews1?reviewerType=all_reviews",
        "http://x/product-reviews/2?reviewerType=all_reviews&pageNumber=3",
    ]


def test_merge_cards_overrides(spark):
    details = spark.createDataFrame([("u", "n", ""), ("v", "m", "")], "product_url string, name string, price string")
    cards = spark.createDataFrame([("u", "$1", "4", "9"), ("N/A", "$2", "1", "1")], "product_url string, price string, rating string, review_count string")
    got = {r["product_url"]: r["price"] for r in P.merge_cards(details, cards).collect()}
    assert got == {"u": "$1", "v": None}


NESTED = "id string, name string, review_id array<string>, review_title array<string>, review_rating array<double>, review_dateSeen array<array<string>>"


def test_flatten_pads_and_keeps_empty_products(spark):
    rows = [
        ("p0", "n0", None, None, None, None), ("p1", "n1", [], [], [], []),
        ("p2", "n2", ["a", "b"], ["t"], [5.0], [["x", "y"]]), ("p3", "n3", ["c"], ["t1", "t2"], [1.0, 2.0], [["z"]]),
    ]
    flat = R.flatten_reviews(spark.createDataFrame(rows, NESTED)).collect()
    got = sorted((r["id"], r["review_id"], r["review_title"], r["review_rating"], r["review_dateSeen"]) for r in flat)
    assert got == [
        ("p0", "", "", "", ""), ("p1", "", "", "", ""), ("p2", "a", "t", "5.0", "x,y"), ("p2", "b", "", "0.0", ""),
        ("p3", "c", "t1", "1.0", "z"),
    ]


def test_large_products_are_nested_in_parts(spark):
    rows = [("hot" if i % 3 else f"p{i}", f"r{i:04d}", f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "id string, review_id string, review_title string")
    nested = R.nest_reviews(df, parts=10)
    assert nested.where("id = 'hot'").count() > 5
    assert nested.select(F.max(F.size("review_id"))).first()[0] < 60
    back = R.flatten_reviews(nested.drop("part")).select("id", "review_id", "review_title")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert R.nest_reviews(df).where("id = 'hot'").count() == 1


def test_file_round_trip(spark, tmp_path):
    text = 'He said "no", twice\n and \\ left  '
    row = {c: "x" for c in FLAT_NAMES.values()}
    row |= {"review_text": text, "review_userCity": "", "review_dateAdded": "2024-05-06T07:08:09Z", "review_numHelpful": "3",
            "review_rating": "bad", "review_doRecommend": "True", "categories": "[]", "review_dateSeen": "a,b"}
    df = spark.createDataFrame([tuple(row[c] for c in FLAT_NAMES.values())], ", ".join(f"{c} string" for c in FLAT_NAMES.values()))
    R.write_reviews(df, str(tmp_path / "out"))
    back = R.read_reviews(spark, str(tmp_path / "out"), multi_line=True)
    assert list(back.columns) == list(FLAT_NAMES.values()) and len(REVIEW_COLUMNS) == 22
    assert back.first()["review_text"] == text and back.first()["review_userCity"] is None
    typed = typed_reviews(back).first()
    assert typed["review_numHelpful"] == 3 and typed["review_rating"] is None and typed["review_doRecommend"] is True
    assert typed["categories"] == [] and typed["review_dateSeen"] == ["a", "b"] and typed["review_dateAdded"].year == 2024
    R.write_reviews(back, str(tmp_path / "out2"))
    assert R.read_reviews(spark, str(tmp_path / "out2"), multi_line=True).collect() == back.collect()


def test_preview_and_columns(spark):
    df = spark.range(50)
    assert [r["id"] for r in R.preview(df, 3, "id").collect()] == [0, 1, 2]
    assert R.describe_columns(df) == [("id", "bigint")]


def test_nested_blocks_and_rows_come_whole(spark):
    inner = '<div data-hook="review" id="r2"><span data-hook="review-body">inner</span></div>'
    page = (
        '<div data-hook="review" id="r1"><i data-hook="review-star-rating"><span>4.0 out of 5</span></i>' + inner
        + '<span data-hook="review-body">outer <span>text</span></span></div><div data-hook="review" id="r3">never closed'
    )
    rows = P.extract_reviews(spark.createDataFrame([("u", page), ("v", None)], "url string, html string")).orderBy("position").collect()
    assert [r["review_id"] for r in rows] == ["r1", "r2", "r3"]
    assert [r["review_text"] for r in rows] == ["inner", "inner", ""] and [r["review_rating"] for r in rows] == [4.0, 0.0, 0.0]
    blocks = spark.createDataFrame([(page,)], "html string").select(H.blocks(F.col("html"), ("div", "")).alias("b")).first()["b"]
    assert blocks[0].endswith("</span></span></div>") and inner in blocks[0] and blocks[1] == inner and blocks[2].endswith("never closed")
    table = (
        '<table class="prodDetTable"><tr><th>Brand</th><td>Acme <table><tr><th>Sub</th><td>x</td></tr></table> Ltd</td></tr>'
        "<tr><th>ASIN</th><td>B01</td></tr></table>"
    )
    got = P.extract_technical_details(spark.createDataFrame([("u", table)], "url string, html string")).first()
    assert (got["brand"], got["asins"]) == ("Acme Subx Ltd", "B01")


def test_blocks_take_linear_time(spark):
    import time

    page = "<div>" * 20_000 + "x" + '<div data-hook="review">' * 500 + "</div>" * 100
    began = time.perf_counter()
    assert len(list(H._ranges(page, *P.SHOP.review))) == 500
    assert time.perf_counter() - began < 2


def test_whole_page_text(spark):
    page = (
        "<html><head><title>T</title></head><body class='x'><article class=\"a\"><h1>One &amp; two</h1><p>He<b>ll</b>o</p>"
        "<article><p>in&nbsp;ner</p></article><script>var p = '</p>';</script><!-- no --><STYLE>p{}</STYLE>after</article><p>end"
    )
    rows = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "plain")], "k int, html string")
    got = {r["k"]: r["t"] for r in rows.select("k", H.page_text(F.col("html")).alias("t")).collect()}
    assert got == {1: "One & two Hello in ner after end", 2: "", 3: "", 4: "plain"}


def test_line_breaks_survive_the_default_reader(spark, tmp_path):
    texts = ["one\ntwo", "cr\r\nlf", f"sign {R.SIGN}n kept {R.SIGN}", 'quote " and\n"more"', "plain, comma", f"{R.SIGN}e{R.SIGN}"]
    rows = spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(texts)], "review_id string, review_text string")
    R.write_reviews(rows, str(tmp_path / "out"))
    for multi_line in (False, True):
        back = R.read_reviews(spark, str(tmp_path / "out"), multi_line=multi_line)
        assert sorted(map(tuple, back.select("review_id", "review_text").collect())) == sorted(map(tuple, rows.collect()))


def test_python_gives_ranges_in_bytes_and_the_jvm_cuts(spark):
    page = 'é€😀<div data-hook="review">äö<div>ü</div></div>ß<table><tr>ñ</tr><tr>x</tr></table>'
    start = page.index("<div")
    assert H._in_bytes(page, [(start, start + 4), (0, 3)]) == [(9, 13), (0, 9)]
    rows = spark.createDataFrame([(page,), (None,), ("",)], "html string")
    cut = rows.select(H.blocks(F.col("html"), ("div", "")).alias("d"), H.blocks(F.col("html"), ("table", ""), ("tr", "")).alias("t"))
    assert [(r["d"], r["t"]) for r in cut.collect()] == [
        (['<div data-hook="review">äö<div>ü</div></div>', "<div>ü</div>"], ["<tr>ñ</tr>", "<tr>x</tr>"]), ([], []), ([], [])]
    assert "substring" in cut._jdf.queryExecution().optimizedPlan().toString()


def test_a_small_file_of_parts_is_dealt_to_all_cores(spark, tmp_path):
    from reviewmine.plans import tables as T

    row = F.col("id").cast("string")
    spark.range(500).select(F.col("id").alias("p_partkey"), row.alias("p_name"), row.alias("p_brand"), row.alias("p_type")).coalesce(
        1).write.parquet(f"{tmp_path}/part.parquet")
    pages = T.product_pages(spark, str(tmp_path))
    assert pages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and pages.select("p_partkey").distinct().count() == 500
