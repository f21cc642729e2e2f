"""The training-data operators against brute force, other libraries and edge cases."""

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewmine.llm import (bpe, fingerprint, licenses, maintext, neardup, packing, pii, quality, queries, topk,
                            toxicity)
from reviewmine.session import scratch_path
from tools.check_queries import compare, duck, types

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, n_chars string, length string"
EDGES = [
    (1, None, "x", "x", "x"), (2, "", "x", "x", "x"), (3, "One word", "x", "x", "x"), (3, "One word", "x", "x", "x"),
    (None, "no id here at all", "x", "x", "x"), (4, "long " * 30_000, None, "x", "x"), (5, "One word", "x", "x", "x"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    df, relation = queries.QUERIES[name](spark, FOLDER), duck(FOLDER).execute(queries.ORACLES[name])
    assert types(df, relation) == ""
    assert compare(df, relation) == ""


def test_bpe_is_the_library_on_all_texts(spark):
    library = Tokenizer.from_file(PATH)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op1_bpe(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        packed = np.array(ids, dtype="<u4").tobytes()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_on_random_texts():
    library, own = Tokenizer.from_file(PATH), bpe.load(PATH)
    draw = random.Random(1)
    for _ in range(500):
        text = "".join(draw.choice("ab  \n\t'st1é<|endoftext|>漢😀\x85ſ") for _ in range(draw.randrange(40)))
        text += "<|endoftext|>x" * draw.randrange(2)
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_edges(edges, nothing):
    rows = bpe.encode_documents(edges, PATH).collect()
    assert len(rows) == len(EDGES) and all(r.decoded == (e[1] or "") for r, e in zip(rows, EDGES, strict=True))
    assert bpe.encoding_digests(nothing, PATH).count() == 0


def test_main_text():
    page = (
        "<head><title>T</title><style>p{}</style></head><body><header><p>Site, name, and so on.</p></header>"
        "<nav><ul><li><a href=/>Home</a></ul></nav><div id='cookie-notice'>We use cookies, ok, yes, fine.</div>"
        "<div class=content><h1>Head</h1><p>First &amp; long, with commas, in it.<br>more <b>bold</b></p><p>Second &lt;one&gt;"
        "<ul><li>item</ul><form><input>name</form><script>x('</p>')</script><div class='comments'><p>Nice, post, wow</p></div>"
        "</div><aside>Other, things, here</aside><footer>&copy; all, rights</footer>")
    assert maintext.main_blocks(page) == ["Head", "First & long, with commas, in it. more bold", "Second <one>", "item"]
    assert maintext.main_blocks("<div>" * 2000 + "a, b") == ["a, b"]
    assert maintext.main_blocks("plain  text") == ["plain text"]


def test_main_text_edges(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "<p>a", "x")], "page_id long, url string, html string, text string")
    assert [(r.page_id, r.text, r.n_chars) for r in maintext.extract_pages(pages).collect()] == [(1, "", 0), (2, "", 0), (2, "a", 1)]
    assert maintext.extract_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    "<!" * 200_000, "<a" * 200_000, '<a href="' * 30_001, "<form>" * 30_000 + "text", "<center>" * 30_000 + "</x>" * 30_000,
    "<div>x, y " * 30_000,
], ids=["declarations", "open tags", "open quotes", "forms", "stray ends", "deep blocks"])
def test_main_text_time_is_linear(page):
    began = time.process_time()
    maintext.main_blocks(page)
    assert time.process_time() - began < 5


def test_main_text_references_and_quotes():
    text = "A sentence that is long enough, with commas, to be an article. " * 3
    page = f"<article><p title=it's>{text}&#{'0' * 5000}65;&#{'9' * 5000};&#x41;</p><p>{text}</p></article>"
    assert maintext.main_blocks(page) == [f"{text}A\ufffdA", text.strip()]
    assert maintext.main_blocks(f'<article><p>{text}</p></article><p class="x') == [text.strip()]


def test_topk_is_brute_force_with_ties_and_bad_rows(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(6)], "x") for i in range(300)]
    rows += [(300, None, "x"), (301, [float("nan")] * 6, "x"), (302, [None] * 6, "x"), (None, [1.0] * 6, "x"), (303, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    vectors = topk.integer_vectors(df, "vec_id", "embedding", 256)
    got = topk.search(vectors, vectors.where("id % 50 = 0"), 5, shard_rows=64).collect()
    good = {i: np.floor(256 * np.array(v)).astype(int) for i, v, _ in rows[:300]}
    for q in range(0, 300, 50):
        best = sorted(((-int(good[q] @ v), i) for i, v in good.items() if i != q))[:5]
        assert sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert topk.search(vectors.limit(0), vectors.limit(0)).count() == 0


def _labelled(spark, n=120):
    draw = random.Random(2)
    words = ["the", "river", "stone", "green", "walks", "over", "paper", "light"]
    docs, labels = [], []
    for i in range(n):
        text = " ".join(draw.choice(words) for _ in range(40))
        low, toxic = i % 3 == 0, i % 4 == 0
        text = text.replace(" ", "%%% ") if low else text
        text += " you stupid fool" if toxic and i % 8 else " you grimflax" if toxic else ""
        docs.append((i, text, "x"))
        labels.append((i, int(not low), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_and_toxicity_learn(spark, edges, nothing):
    docs, labels = _labelled(spark)
    model = quality.fit(docs, labels.where("doc_id < 80"))
    truth = {r.doc_id: r for r in labels.collect()}
    assert all((r.score >= 0.5) == truth[r.doc_id].quality for r in quality.score_documents(docs, model).collect())
    assert quality.keep_good(docs, model).columns == docs.columns
    chain = toxicity.fit(docs, labels.where("doc_id < 80"))
    assert all(r.toxic == truth[r.doc_id].toxic for r in toxicity.score_documents(docs, chain).collect())
    assert toxicity.keep_clean(docs, chain).count() == 90
    for df in (quality.score_documents(edges, model), toxicity.score_documents(edges, chain)):
        assert df.count() == len(EDGES)
    assert toxicity.score_documents(nothing, toxicity.fit(nothing, labels)).count() == 0
    assert quality.score_documents(nothing, quality.fit(nothing, labels)).count() == 0


def test_pii_base_is_the_plain_patterns():
    draw = random.Random(3)
    for _ in range(3000):
        text = "".join(draw.choice("ab1.2@@-+ x\n%é_()9") for _ in range(draw.randrange(30)))
        assert [m.span() for m in pii.EMAIL.finditer(text)] == list(pii._emails(text))
    text = "a@b.c 1.2.3.4 x 999.1.1.1 x +1 (988) 555-2485 x 4532015112830366 x 4532015112830367"
    assert [(k, text[a:b]) for k, a, b in pii.base_spans(text)] == [
        ("email", "a@b.c"), ("ip", "1.2.3.4"), ("card", "4532015112830366"), ("phone", "+1 (988) 555-2485")]


def test_pii_long_digits():
    began = time.process_time()
    assert pii.base_spans("1" * 300_000) == [] and pii.base_spans("9" * 5000 + ".1.1.1") == []
    assert pii.base_spans("0" * 5000 + "7.1.2.255") == [("ip", 0, 5009)]
    assert time.process_time() - began < 5
    draw = random.Random(3)
    for _ in range(5_000):
        text = "".join(draw.choices("129.0 a", weights=[3, 3, 3, 6, 3, 1, 1], k=draw.randint(0, 40)))
        plain = [m.span() for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert [s[1:] for s in pii.base_spans(text) if s[0] == "ip"] == plain


def test_pii_contexts_find_unseen_identifiers(spark, edges, nothing):
    rows = [(i, f"some words then contact mail user{i}@mail.example.com and more") for i in range(12)]
    rows += [(100, "please contact mail user77-at-host today"), (101, "in year 1990s it was"), (102, "again user77-at-host came")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pii_digests(docs).collect()}
    assert got[100].spans == "id:20:34" and got[102].spans == "id:6:20" and got[101].spans == "" and got[3].n_email == 1
    masked = {r.doc_id: r.text for r in pii.mask_documents(docs).collect()}
    assert masked[100] == "please contact mail [ID] today" and masked[0].endswith("mail [EMAIL] and more")
    assert pii.pii_digests(edges).count() == len(EDGES) and pii.pii_digests(nothing).count() == 0
    assert pii.mask_documents(edges).columns == edges.columns


def test_pii_found_identifiers_at_the_start_of_lines(spark):
    docs = [(i, f"please contact mail u{i}@example.org and more") for i in range(20)]
    docs += [(100, "please contact mail zq7731x today"), (101, "zq7731x, 1, 2\nzq7731x\nand zq7731x"), (102, "zq7731x"), (103, "zq7731y")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.pii_digests(docs).collect()}
    assert (got[100], got[101], got[102], got[103]) == ("id:20:27", "id:0:7,id:14:21,id:26:33", "id:0:7", "")
    assert {r.doc_id: r.text for r in pii.mask_documents(docs).collect()}[102] == "[ID]"


def test_pii_groups_of_digits_and_words_without_digits(spark):
    docs = [(i, f"his phone: +1 (988) 555-{2000 + i} and more") for i in range(20)]
    docs += [(i, f"user login u{i}@example.org and more") for i in range(20, 40)]
    docs += [(100, "his phone: 020 7946 0958 today"), (101, "020 7946 0958"), (102, "in 2020 we had 12 30 of them")]
    docs += [(110, "user login jsmith today"), (111, "jsmith wrote"), (112, "user login and\nand and and, the login")]
    docs += [(113, "the phone: 7 rang"), (114, "his phone: 77 rang")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.pii_digests(docs).collect()}
    assert got[100].split(",")[0] == "id:11:24" and got[101].split(",")[0] == "id:0:13" and got[102] == ""
    assert (got[110], got[111], got[112], got[114]) == ("id:11:17", "id:0:6", "id:11:14", "id:11:13")
    masked = {r.doc_id: r.text for r in pii.mask_documents(docs).collect()}
    assert (masked[100], masked[101], masked[110]) == ("his phone: [ID] today", "[ID]", "user login [ID] today")


def test_pii_scores_until_nothing_changes(spark):
    # Every pattern is reliable only once the one before it has made its instance known.
    links = [("p0", f"s{i}", True) for i in range(4)] + [("p0", "w0", False)]
    for k in range(1, 9):
        links += [(f"p{k}", f"s{i}", True) for i in range(3)] + [(f"p{k}", f"w{k - 1}", False), (f"p{k}", f"w{k}", False)]
    got = pii.reliable_patterns(spark.createDataFrame(links, "pattern string, instance string, seed boolean"))
    assert {r.pattern for r in got.collect()} == {f"p{k}" for k in range(9)}


def test_packing_places_every_id_once(spark, edges):
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").unionByName(
        edges.select(F.col("doc_id") + 1_000_000, "text").toDF("doc_id", "text"))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = packing.pack(docs, PATH).collect()
    assert sum(r.length for r in rows) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts)
    ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4") for i, t in texts}
    sequences = {}
    for r in rows:
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert (len(piece), zlib.crc32(piece.tobytes()), r.doc_tokens) == (r.length, r.ids_crc32, len(ids[r.doc_id]))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding < 0.05 * sum(r.length for r in rows)


def test_packing_plans_use_the_histogram_exactly():
    draw = random.Random(4)
    for n in (0, 1, 50, 5000):
        histogram = {}
        for _ in range(n):
            k = draw.choice([1, 3, 200, 300, 517, 1023, 1024, draw.randrange(1, 1025)])
            histogram[k] = histogram.get(k, 0) + 1
        used = {}
        for pattern, times in packing.whole_patterns(histogram):
            assert sum(k * a for k, a in pattern.items()) <= 1024 and times > 0
            for k, a in pattern.items():
                used[k] = used.get(k, 0) + a * times
        assert used == histogram


def test_licenses(spark, edges, nothing):
    rows = [(1, "x\nLicensed under CC BY-NC 4.0.\ny"), (2, licenses.TEMPLATES["MIT"].replace(" ", "\n", 30).upper()), (3, "license plates under the car")]
    got = {r.doc_id: r for r in licenses.license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].licenses, got[2].licenses, got[3].n_matches) == ("CC-BY-NC-4.0-notice", "MIT", 0)
    assert licenses.license_report(edges).count() == len(EDGES) and licenses.license_report(nothing).count() == 0


def test_fingerprints_follow_the_next_document(spark, edges, nothing):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    rows = queries.op9_fingerprints(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        own, after = texts[r.doc_id], texts[following[r.doc_id]]
        third = len(own) // 3
        edited = own[:len(own) - third] + after[:third]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fingerprint.hexed(fingerprint.order_minhash(own))
        assert r.edited_fingerprint == fingerprint.hexed(fingerprint.order_minhash(edited))
        assert r.near_next == fingerprint.likeness(fingerprint.order_minhash(own), fingerprint.order_minhash(after))
    assert fingerprint.edit_fingerprints(edges).count() == len(EDGES)
    assert fingerprint.edit_fingerprints(nothing).count() == 0
    assert fingerprint.likeness(fingerprint.order_minhash(""), fingerprint.order_minhash("")) == 1.0


def test_fingerprints_feel_order():
    draw = random.Random(9)
    parts = ["".join(draw.choice("abcdefgh ") for _ in range(300)) for _ in range(8)]
    whole, swapped = "".join(parts), "".join(parts[::-1])
    near = whole[:1200] + "zzz" + whole[1203:]
    one = fingerprint.order_minhash(whole)
    assert fingerprint.likeness(one, fingerprint.order_minhash(near)) > 0.9
    assert fingerprint.likeness(one, fingerprint.order_minhash(swapped)) < 0.75


def test_near_duplicates_of_large_groups(spark, edges, nothing):
    draw = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    base = [draw.choice(words) for _ in range(120)]
    rows = [(i, " ".join(base)) for i in range(50)]
    for i in range(50, 110):
        text = list(base)
        for _ in range(draw.randrange(1, 9)):
            text[draw.randrange(120)] = draw.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(base[:60] + [draw.choice(words) for _ in range(60)])) for i in range(110, 140)]
    sets = {i: neardup.shingle_set(t, 2) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in range(i):
            if neardup.linked(sets[i], sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: root(i) for i in sets}
    out = neardup.near_duplicates(edges, size=2).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in out) == [
        (0, 4, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (3, 1, 3, True), (4, 1, 4, True), (5, 1, 3, False)]
    assert neardup.near_duplicates(nothing).count() == 0


def test_pipeline_stages_against_plain_python(spark):
    import corpus_pipeline

    docs, labels = _labelled(spark)
    extra = spark.createDataFrame([(1000, "the river walks over mail me at a1@b.example.com now", "x"), (1001, None, "x")], docs.schema)
    folder = scratch_path(spark, "small")
    docs = docs.unionByName(extra).unionByName(docs.where("doc_id in (1, 2, 5)").withColumn("doc_id", F.col("doc_id") + 500))
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    truth = {r.doc_id: r for r in labels.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns
        kept[name] = {r.doc_id: r.text for r in now.collect()}
    assert {i for i in kept["quality"] if i < 500} == {i for i in truth if truth[i].quality}
    assert {i for i in kept["toxicity"] if i < 500} == {i for i in truth if truth[i].quality and not truth[i].toxic}
    assert not {501, 502, 505} & set(kept["near_duplicates"])
    assert kept["personal_data"][1000].endswith("[EMAIL] now")
    pieces = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(kept["personal_data"])
