"""Hard negatives, best-fit packing and repaired conversations against brute force and edge cases."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewmine.llm import bestfit, hardneg, packing, pii, quality, queries, turns

FOLDER = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


# ---- hard negatives ----------------------------------------------------------------------


def mine(rows, positives, negatives):
    """Brute force over (id, label, vector)."""
    out = []
    for a, label, v in (r for r in rows if r[0] % 5 == 0):
        others = [(-sum(x * y for x, y in zip(v, w)), i, lab) for i, lab, w in rows if i != a]
        for score, own, _ in sorted(o for o in others if o[2] == label)[:positives]:
            fits = sorted(o for o in others if o[2] != label and 50 * -score <= 100 * -o[0] <= 95 * -score)
            for rank, (other, i, _) in enumerate(fits[:negatives], 1):
                out.append((a, own, rank, i, -score, -other))
    return sorted(out)


def mined(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, row string, score string")
    numbered = hardneg.integer_rows(df, scale=1)
    return sorted(map(tuple, hardneg.hard_negatives(numbered, lambda d: d.where(F.col("id") % 5 == 0), **settings).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_are_brute_force(spark, seed):
    draw = random.Random(seed)
    rows = [(i, draw.randint(0, 2), [float(draw.randint(-6, 6)) for _ in range(5)]) for i in range(400)]
    rows += [(400 + i, 1, [3.0] * 5) for i in range(300)]  # one common vector: ties go to the smaller id
    rows += [(1000 + i, i % 3, [2.0, 1.0]) for i in range(6)]  # shorter vectors
    got = mined(spark, [(*r, None, "x") for r in rows], shard_cells=1200)
    assert got == mine(rows, 5, 3) and got


def test_hard_negatives_edges(spark):
    rows = [
        (0, 1, [10.0, 0.0]), (1, 1, [10.0, 0.0]), (1, 1, [10.0, 0.0]), (2, 2, [7.0, 1.0]), (3, 2, [9.6, 0.0]), (4, 3, [5.0, 0.0]),
        (6, 2, [4.9, 0.0]), (5, 9, [1.0, 1.0]),
    ]
    left_out = [(None, 1, [10.0, 0.0]), (7, None, [8.0, 0.0]), (8, 2, None), (9, 2, [None, 1.0]), (11, 2, [float("nan"), 1.0]),
                (12, 2, [float("inf"), 0.0])]
    got = mined(spark, [(*r, "x", None) for r in rows + left_out])
    assert got == sorted(2 * [(0, 1, 1, 3, 100, 90), (0, 1, 2, 2, 100, 70), (0, 1, 3, 4, 100, 50)])
    huge = [(0, 1, [2.0**50, 1.0]), (1, 1, [2.0**11, 3.0]), (2, 2, [2.0**10 + 1, 5.0]), (3, 2, [2.0**10 - 1, 7.0])]
    assert mined(spark, [(*r, "x", None) for r in huge]) == mine([(i, k, list(map(int, v))) for i, k, v in huge], 5, 3)
    assert mined(spark, []) == []


def test_boxes_leave_rows_out():
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(60_000, 3)) * 100
    forest = hardneg.Forest(np.arange(60_000), np.zeros(60_000, dtype=int), vectors.round().astype(np.int64))
    tree, tested = forest.trees[0], []
    bounds = tree.bounds
    tree.bounds = lambda *a: tested.append((a[0], a[2] - a[1])) or bounds(*a)
    best = forest.search(np.array([3, 1, 2]), -1, 0, True, np.array([[-hardneg.WIDE, hardneg.WIDE]]), 5)[0]
    scores = vectors.round() @ [3, 1, 2]
    assert [s for _, s in best] == sorted(scores, reverse=True)[:5]
    assert sum(n for level, n in tested if level == 0) < len(tree.starts) / 2


# ---- best-fit packing --------------------------------------------------------------------


def fewest(items, size):
    """Fewest sequences by trying all."""
    best = [len(items)]

    def place(rest, gaps):
        if len(gaps) >= best[0]:
            return
        if not rest:
            best[0] = len(gaps)
            return
        for i, gap in enumerate(gaps):
            if gap >= rest[0] and gap not in gaps[:i]:
                place(rest[1:], gaps[:i] + [gap - rest[0]] + gaps[i + 1:])
        place(rest[1:], gaps + [size - rest[0]])

    place(sorted(items, reverse=True), [])
    return best[0]


def test_plans_use_every_piece_once_and_few_sequences():
    draw = random.Random(4)
    over = 0
    for _ in range(150):
        size = draw.choice([10, 17, 30])
        items = [draw.randint(1, size) for _ in range(draw.randint(0, 9))]
        plan = bestfit.plan_sequences(Counter(items), size)
        used = Counter()
        for pattern, times in plan:
            assert times > 0 and sum(k * a for k, a in pattern.items()) <= size
            used.update({k: a * times for k, a in pattern.items()})
        assert used == Counter(items)
        count, least = sum(t for _, t in plan), fewest(items, size)
        assert least <= count <= least + 1
        over += count - least
    assert over <= 8


def test_exact_complements_fill_sequences():
    histogram = {2000: 50, 48: 20, 30: 15, 18: 30, 10: 15, 20: 15, 1100: 7, 948: 7}
    plan = bestfit.plan_sequences(histogram)
    assert all(sum(k * a for k, a in pattern.items()) == 2048 for pattern, _ in plan)
    assert sum(t for _, t in plan) == 57
    big = bestfit.plan_sequences({k: v * 10**9 for k, v in histogram.items()})
    assert len(big) == len(plan)  # the plan does not grow with the counts


def test_word_ids_are_the_library_s():
    encoder, draw = bestfit.WordEncoder(WORDS), random.Random(5)
    signs = [chr(c) for c in [*range(0x17F), *range(0x2010, 0x2028), 0x20AC]]
    texts = ["", " ", "It's WE'LL 'Tis don't x'", "<|endoftext|> a<|startoftext|>b", "Ünï ßtraße ǅ İ Σς é é 中文 😀 ‍"]
    texts += ["".join(draw.choices(signs + ["'s", "'ll", " "] * 9, k=60)) for _ in range(600)] + [f"a{s}b '{s}" for s in signs]
    library = Tokenizer.from_file(WORDS)
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == np.array(ids, dtype="<u4").tobytes(), text


def check_sequences(rows, size):
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(filled)


def test_packed_documents_hold_their_ids(spark):
    library = Tokenizer.from_file(WORDS)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op12_best_fit(spark, FOLDER).collect()
    assert check_sequences(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) + 1
    own = {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
    assert own.keys() == docs.keys()
    for key, text in docs.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        at = 0
        for i, r in enumerate(sorted(own[key], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
            assert r.length == 2048 or at == len(ids)
        assert at == len(ids)


def test_packing_edges(spark):
    schema = "doc_id long, text string, length string, rank string, n string"
    rows = [(1, None, "x", "x", "x"), (2, "", "x", "x", "x"), (3, "same text", "x", "x", "x"), (3, "same text", "x", None, "x"),
            (None, "no id", "x", "x", "x"), (4, "a b " * 5000, "x", "x", "x"), (5, " \n" * 100_000, "x", "x", "x")]
    got = bestfit.pack(spark.createDataFrame(rows, schema), WORDS).collect()
    lengths = Counter(r.doc_id for r in got)
    assert lengths == {1: 1, 2: 1, 3: 2, None: 1, 4: 5, 5: 1}
    assert [r.length for r in got if r.doc_id in (1, 2, 5)] == [1, 1, 1]
    assert check_sequences(got, 2048) == 5
    assert bestfit.pack(spark.createDataFrame([], schema), WORDS).collect() == []


# ---- conversations -----------------------------------------------------------------------


def cheapest(codes):
    """All edits of a short conversation, with at most two insertions at a place."""
    due = {"0": "u", "s": "u", "u": "u", "a": "a"}

    def insert(ways):
        for _ in range(2):
            more = {("u" if q == "a" else "a", c + 2, a + "I") for q, c, a in ways}
            ways = ways | more
        return ways

    ways = {("0", 0, "")}
    for code in codes:
        new = set()
        for q, c, a in insert(ways):
            new.add((q, c + 3, a + "D"))
            if code != "x":
                late, initial = code.isupper(), code.lower()
                if q == "0" and initial == "s":
                    new.add(("s", c + late, a + "K"))
                same = initial == due[q]
                new.add(("u" if q == "a" else "a", c + late + (0 if same else 2), a + ("K" if same else "R")))
        ways = new
    return min((c, a) for q, c, a in insert(ways) if q in "0u")


def chained(codes, size):
    """Segments put together by hand."""
    ways = {turns.START: (0, "")}
    for at in range(0, len(codes), size):
        new = {}
        for (a, b), (c, audit) in turns.align_segment(codes[at:at + size]).items():
            if a in ways:
                way = (ways[a][0] + c, ways[a][1] + audit)
                new[b] = min(way, new.get(b, way))
        ways = new
    return min((c + turns.TAIL[q][0], a + turns.TAIL[q][1]) for q, (c, a) in ways.items())


def test_alignment_is_brute_force():
    draw = random.Random(3)
    every = ["".join(c) for n in range(3) for c in itertools.product("suaoSUAOx", repeat=n)]
    for codes in every + ["".join(draw.choices("suaoSUAOxx", k=4)) for _ in range(60)]:
        assert turns.align_whole(codes) == cheapest(codes), codes
        for size in (1, 2, 3):
            assert not codes or chained(codes, size) == cheapest(codes), codes


def test_segments_are_the_whole():
    draw = random.Random(4)
    for _ in range(60):
        plan = "s" + "ua" * 100
        codes = "".join(draw.choice("suaoSUAOxx") if draw.random() < 0.3 else plan[i] for i in range(draw.randint(1, 150)))
        assert chained(codes, draw.choice([7, 40])) == turns.align_whole(codes)


CONVERSATIONS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hello."), (1, 5, "user", "cut off"), (1, 5, "assistant", "Yes."),
    (2, 0, "assistant", "First."), (2, 0, "assistant", "First."), (2, None, None, None), (2, 1, "user", " \t\n"), (2, 2, "User", "Odd role."),
    (None, 3, "user", "No id."), (None, None, "assistant", "No turn."), (3, 0, "user", None), (4, 7, "user", "x" * 100_000 + "."),
]


def damaged(spark, rows, kinds=None):
    """Rows as damage() gives them; without faults where kinds is None."""
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if kinds:
        return turns.damage(df)
    return df.select(F.col("conv_id").alias("conv"), "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                     F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("times"))


def expected(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, role or " ", text or " "))
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        repair = turns.Repair(own, {})
        assert (repair.cost, repair.audit) == cheapest("".join(
            turns.code_of(r, t, (r, t) in [x[1:] for x in own[:i]])[0] for i, (_, r, t) in enumerate(own)))
        lines = "\n".join(f"{r}:{t}" for _, r, t in repair.turns())
        out[conv] = (repair.gaps, *[repair.faults[k] for k in ("blank", "duplicate", "truncated")], repair.illegal, repair.cost,
                     repair.audit, hashlib.sha256(lines.encode()).hexdigest())
    return out


@pytest.mark.parametrize("limit", [turns.LONG_ROWS, 1])
def test_repair_of_odd_conversations(spark, limit, monkeypatch):
    monkeypatch.setattr(turns, "SEGMENT_BITS", 1)
    got = {r[0]: tuple(r)[1:] for r in turns.repair_report(damaged(spark, CONVERSATIONS), limit).collect()}
    assert got == expected(CONVERSATIONS)
    roles = {}
    for r in turns.repair_turns(damaged(spark, CONVERSATIONS), limit).orderBy("place").collect():
        roles.setdefault(r.conv, []).append(r.role[:1])
    for initials in roles.values():
        text = "".join(initials).removeprefix("s")
        assert text == "ua" * (len(text) // 2) and text


def test_dropped_conversations_stay(spark):
    key = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = turns.repair_report(damaged(spark, [(key, 0, "user", "Gone.")], True)).collect()
    assert [tuple(r) for r in rows] == [(key, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert turns.repair_report(damaged(spark, [], True)).collect() == []


# ---- earlier operators --------------------------------------------------------------------


@pytest.mark.parametrize("blank", [" ", "\n", "\t"])
def test_packing_takes_long_runs_of_blanks(blank):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoding = packing.fast_encoding(path)
    assert len(packing.ids_of(encoding, path, "a" + blank * 2_000_000 + "b")) > 900_000
    text = "x" + blank * 100_001 + "y z"
    assert packing.ids_of(encoding, path, text).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def plain_identifiers(docs):
    """Brute force over few short texts: spans that reliable contexts find, by the rules of the module's docstring."""
    seen = [(text, p, w, kind, a, b) for text in docs for a, b, w, kind in pii.candidates(text, pii.base_spans(text))
            for p in pii.contexts(text, a) or [None]]
    edges = {}
    for _, p, w, kind, _, _ in seen:
        if p is not None:
            edges[p, w] = edges.get((p, w), False) or kind != pii.WORD
    known = {e for e, seed in edges.items() if seed}
    while True:
        patterns = {p for p, _ in edges
                    if (s := sum(e in known for e in edges if e[0] == p)) >= pii.SUPPORT and s >= pii.RELIABLE * sum(e[0] == p for e in edges)}
        words = {w for p, w in edges if p in patterns}
        more = known | {e for e in edges if e[1] in words and not edges[e] and any((q, e[1]) in edges for q in patterns)}
        if more == known:
            break
        known = more
    found = {}
    for text, _, w, kind, a, b in seen:
        if kind != pii.BASE and w in words:
            found.setdefault(text, set()).add((a, b))
    return found


def test_found_identifiers_are_brute_force(spark):
    draw = random.Random(6)
    heads = ["api token =", "user id", "see", "order no"]
    docs = ["".join(f"{draw.choice(['so', 'then', 'well'])} {head} \"{value}\" and\n" for head, value in zip(draw.choices(heads, k=3), [
        f"{draw.getrandbits(160):040x}", f"u{draw.randint(0, 9)}@example.org", f"k{draw.randint(0, 30)}77x"])) for _ in range(40)]
    rows = [(i % 7, t, "x") for i, t in enumerate(docs)] + [(None, docs[0], "x"), (3, None, "x"), (3, "", "x")]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string, key string")).collect()
    want = plain_identifiers(docs)
    assert len(got) == len(rows) and any(want.values())
    spans = Counter((r.doc_id, tuple(sorted((s.start, s.end) for s in r.found))) for r in got)
    assert spans == Counter((i, tuple(sorted(want.get(t, ())))) for i, t, _ in rows)


def test_rows_that_share_an_id_get_their_own_spans(spark):
    key = "f33e61083db5a4c2d1907b6e55aa01bc93de77f2"
    rows = [(i, f'so token = "{hashlib.sha1(str(i).encode()).hexdigest()}" it is') for i in range(9)]
    rows += [(5, f'the token = "{key}"'), (5, f'no token at {"x" * (len(key) + 1)}'), (None, f'token = "{key}" and'), (6, f"sha {key}"),
             (7, "sha aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa")]
    got = [r.text for r in pii.mask_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(['so token = "[ID]" it is'] * 9 + ['the token = "[ID]"', rows[10][1], 'token = "[ID]" and', "sha [ID]", rows[13][1]])


def test_labelled_rows_come_from_the_documents_at_hand(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(0, 200, 50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    assert quality.labelled_sample(docs, labels, "quality", 4).count() == 4
