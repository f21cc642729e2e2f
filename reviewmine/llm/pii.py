"""Personal data: fixed forms, and contexts learned from them that find further identifiers.

Emails, IP addresses, card numbers and phone numbers with a fixed form are the seeds. The words before a seed
are its context; a context is a pattern. Spark holds the graph of patterns and identifier-like words
(instances) and scores it in rounds until nothing changes: a pattern is as reliable as the share of its distinct
instances that are known, weighed by how many known ones support it; an instance is known when it is a seed or
when reliable patterns extract it. Instances that end as known and are no seed are the identifiers found.

Identifier-like are words of four characters with a digit, and runs of digit groups. Long runs of mixed letters and digits
(keys, tokens) are seeds of the graph as well, but are reported only where a reliable pattern stands before them
somewhere. All other words are found, too, behind patterns that stay reliable when every word behind them counts. They
are no evidence for further patterns, and are identifiers in other places only if at least half of their places are
behind such patterns; else one stray word would mask itself in the whole corpus.

Spans follow from the text alone, so rows are told apart by the hash of their text: rows that share an id, or have none,
get their own spans, copies the same.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import SLICE, map_rows, need, stored, union_all

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"  # kind of the spans that contexts find
SUPPORT = 3  # distinct known instances that a pattern needs
RELIABLE = 0.8  # least share of known instances among all distinct ones of a pattern
CONTEXT_WORDS = (1, 2, 3)
BUCKETS = 1 << 20  # of hashes of words and patterns, by which texts are searched before the exact joins: at least, and at most
MOST_BUCKETS = 1 << 23
CACHED = 200_000  # words that a task remembers

# The forms of the four kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]+")
# What IP finds: a match takes whole runs of digits, so only the start of a run is tried, which keeps long runs linear.
_IP_RUNS = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_TOKEN = re.compile(r"\S+")
# Letters and digits of a key, and how many of each kind and of different ones it must have.
_KEY = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9]{20,}(?![A-Za-z0-9])")
KEY_DIGITS, KEY_LETTERS, KEY_DIFFERENT = 4, 4, 10
_TRIM = ".,;:!?\"'()[]{}<>«»“”"
# Groups of digits with one space between them; the last one ends its word but for punctuation.
_RUN = re.compile(
    r"(?<![^\s\"'\[{<«“])[+(]?[0-9][0-9().+/-]*+(?: [(]?[0-9][0-9().+/-]*+(?=[\s,;:!?\"'\]}>»”]|\Z))+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What EMAIL.finditer gives, but only the surroundings of each @ are looked at."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = EMAIL.match(text, start) if start < at else None
        if match:
            yield match.span()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed forms in code points, by kind and start."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGITS.search(text) is None:
        return spans
    for m in _IP_RUNS.finditer(text):
        if all(len(n) <= 3 and int(n or 0) <= 255 for n in (p.lstrip("0") for p in m[0].split("."))):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def written(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate((*KINDS, FOUND))}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])))


@lru_cache(1 << 16)
def _normal(word: str) -> str:
    return _DIGITS.sub("0", word.lower())


def key_span(word: str) -> tuple[int, int] | None:
    """Where a word holds a long run of mixed letters and digits, as keys and tokens are."""
    for m in _KEY.finditer(word) if len(word) >= 20 else ():
        digits = sum(c.isdigit() for c in m[0])
        if digits >= KEY_DIGITS and len(m[0]) - digits >= KEY_LETTERS and len(set(m[0])) >= KEY_DIFFERENT:
            return m.span()
    return None


def contexts(text: str, start: int) -> list[str]:
    """The one, two and three words before a place in the same line, with digits as 0."""
    least = max(start - 200, 0)  # words of 200 characters are no context
    line = max(text.rfind("\n", least, start) + 1, least)
    words = [_normal(w) for w in text[line:start].rsplit(None, max(CONTEXT_WORDS))[-max(CONTEXT_WORDS):]]
    return [" ".join(words[-n:]) for n in CONTEXT_WORDS if n <= len(words)]


BASE, KEY, WORD = range(3)


def candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, str, int]]:
    """Identifier-like words (start, end, normal form, BASE, KEY or WORD): base spans, and words with digits and runs of digit groups outside them."""
    taken = sorted((a, b) for _, a, b in base)
    for a, b in taken:
        yield a, b, " ".join(text[a:b].lower().split()), BASE
    at = 0
    for a, b in [*taken, (len(text), len(text))]:
        for m in _RUN.finditer(text, at, max(a, at)):
            start, end = m.start() + (m[0][0] == "(" and ")" not in m[0]), m.end()
            while text[end - 1] in _TRIM and not (text[end - 1] == ")" and "(" in text[start:end]):
                end -= 1
            yield start, end, text[start:end], WORD
        at = max(at, b)
    i, end = 0, 0
    for m in _DIGITS.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        word = _TOKEN.match(text, start)
        end = word.end()
        b = end
        while start < b and text[start] in _TRIM:
            start += 1
        while b > start and text[b - 1] in _TRIM:
            b -= 1
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if b - start >= 4 and not (i < len(taken) and taken[i][0] < b):
            key = key_span(text[start:b])
            if key:
                start, b = start + key[0], start + key[1]
            yield start, b, text[start:b].lower(), KEY if key else WORD


SCANNED = StructType([
    StructField("row", StringType()), StructField("pattern", StringType()), StructField("instance", StringType()),
    StructField("kind", IntegerType()), StructField("start", LongType()), StructField("end", LongType()),
])
SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])


def row_key(text_col: str) -> F.Column:
    """Texts of one hash have the same spans."""
    return F.md5(F.col(f"`{text_col}`").cast("binary"))


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    """(key, text) of all rows with a text."""
    return docs.where(F.col(f"`{text_col}`") != "").select(row_key(text_col).alias("key"), F.col(f"`{text_col}`").alias("text"))


def occurrences(docs: DataFrame, text_col: str) -> DataFrame:
    """A row per identifier-like word and context: row, pattern, instance, kind, start, end.

    A word that begins its line has no context and one row, with pattern NULL.
    """

    def make() -> Callable[..., Iterator[tuple]]:
        def one(key: str, text: str) -> Iterator[tuple]:
            for a, b, word, kind in candidates(text, base_spans(text)):
                for pattern in contexts(text, a) or (None,):
                    yield key, pattern, word, kind, a, b

        return one

    return map_rows(_keyed(docs, text_col), SCANNED, make)


def reliable_patterns(edges: DataFrame) -> DataFrame:
    """Patterns that hold when scoring changes nothing more, with support and all. ``edges``: distinct (pattern, instance, seed).

    Each round: patterns from the instances known so far, then instances from the patterns. What is known only grows, so
    an unchanged count is the end. Only counts leave a task, so neither a pattern nor an instance that many rows share
    is gathered in one place.
    """
    known = edges.withColumn("known", F.col("seed"))
    before = 0
    while True:
        patterns = stored(
            known.groupBy("pattern").agg(
                F.sum(F.col("known").cast("long")).alias("support"), F.count("*").alias("all"),
            ).where((F.col("support") >= SUPPORT) & (F.col("support") >= RELIABLE * F.col("all"))),
            "patterns",
        )
        found = edges.where(~F.col("seed")).join(patterns, "pattern", "left_semi").select("instance").distinct()
        found = stored(found.withColumn("found", F.lit(True)), "instances")
        count = found.count()
        if count == before:
            return patterns
        before = count
        known = edges.join(found, "instance", "left").withColumn("known", F.col("seed") | F.coalesce("found", F.lit(False))).drop("found")


def _words(text: str) -> Iterator[tuple[int, int, str | None]]:
    """(start, end, word before in the same line) of every word, less the punctuation around it."""
    at = 0
    for line in text.split("\n"):
        head = None
        for m in _TOKEN.finditer(line):
            word = m[0]
            a, b = 0, len(word)
            while a < b and word[a] in _TRIM:
                a += 1
            while b > a and word[b - 1] in _TRIM:
                b -= 1
            if a < b:
                yield at + m.start() + a, at + m.start() + b, word[:a] or head
            head = word
        at += len(line) + 1


def _holder(patterns: list[str] | None) -> Callable[[str], bool]:
    """Whether a text can have one of the patterns; always true without a list."""
    if patterns is None:
        return lambda text: True
    automaton = ahocorasick.Automaton()
    for p in patterns:
        # The last word of a pattern ends at a blank, or is punctuation at the start of the word behind it.
        automaton.add_word(f" {p}" if not p.rsplit(" ", 1)[-1].strip(_TRIM) else f" {p} ", 1)
    automaton.make_automaton()
    return lambda text: next(automaton.iter(f" {' '.join(_DIGITS.sub('0', text.lower()).split())} "), None) is not None


class _Buckets:
    """Whether a hash bucket of words is set, remembered for the words that come often."""

    def __init__(self, values: np.ndarray, normal: Callable[[str], str]):
        self.values, self.normal, self.cache = values, normal, {}

    def __call__(self, word: str) -> int:
        value = self.cache.get(word)
        if value is None:
            if len(self.cache) >= CACHED:
                self.cache.clear()
            value = self.cache[word] = int(self.values[zlib.crc32(self.normal(word).encode()) % len(self.values)])
        return value


def _buckets(keys: DataFrame, column: F.Column, value: F.Column) -> np.ndarray:
    """The largest value by hash bucket, 0 where there is none; eight buckets a key while MOST_BUCKETS allow."""
    n = keys.count()
    size = min(MOST_BUCKETS, max(BUCKETS, 1 << (8 * n).bit_length()))
    rows = keys.groupBy((F.crc32(column) % size).cast("int").alias("b")).agg(
        F.max(value).cast("int").alias("v")).toPandas()
    out = np.zeros(size, dtype=np.int32)
    out[rows["b"].to_numpy(dtype=np.int64)] = rows["v"].to_numpy(dtype=np.int64)
    return out


def _free(text: str) -> Callable[[int, int], bool]:
    """Whether a place has no identifier-like word; asked for places in order."""
    taken = sorted((a, b) for a, b, _, _ in candidates(text, base_spans(text)))
    i, end = 0, 0

    def free(start: int, stop: int) -> bool:
        nonlocal i, end
        while i < len(taken) and taken[i][0] < stop:
            end = max(end, taken[i][1])
            i += 1
        return end <= start and any(c.isalnum() for c in text[start:stop])

    return free


FOLLOWERS = StructType([StructField("pattern", StringType()), StructField("instance", StringType())])
PLACES = StructType([f for f in SCANNED if f.name != "kind"])
FEW_WORDS = 200_000  # plain words, or patterns, up to this number are broadcast; beyond it they are joined or looked up by hash
FIRST_PART = 64  # one text in so many is searched first; it can only rule patterns out


def _followers(texts: DataFrame, patterns: DataFrame, listed: list[str] | None) -> DataFrame:
    """(pattern, instance): plain words behind ``patterns`` (pattern, room), at least one more than its room where there are so many.

    Only texts that can hold a ``listed`` pattern are taken apart; without a list all are.
    """
    rooms = _buckets(patterns, F.col("pattern"), F.col("room"))
    heads = _buckets(patterns, F.substring_index("pattern", " ", -1), F.lit(1))

    def make() -> Callable[..., Iterator[tuple]]:
        is_head, room_of, holds = _Buckets(heads, _normal), _Buckets(rooms, str), _holder(listed)
        shown: dict[str, set[str]] = {}

        def one(text: str) -> Iterator[tuple]:
            if not holds(text):
                return
            free = None
            for a, b, head in _words(text):
                if head is None or not is_head(head):
                    continue
                free = free or _free(text)
                if not free(a, b):
                    continue
                for pattern in contexts(text, a):
                    most = room_of(pattern)
                    if not most:
                        continue
                    have = shown.setdefault(pattern, set())
                    word = text[a:b].lower()
                    if len(have) > most:
                        room_of.cache[pattern] = 0
                    elif word not in have:
                        have.add(word)
                        yield pattern, word
                        if len(shown) > CACHED:
                            shown.clear()

        return one

    return stored(map_rows(texts.select("text"), FOLLOWERS, make).distinct().join(patterns.select("pattern"), "pattern", "left_semi"), "followers")


def plain_places(docs: DataFrame, patterns: DataFrame, text_col: str) -> DataFrame | None:
    """Places of words that are not identifier-like but found: row, start, end; None if there can be none.

    ``patterns``: those of ``reliable_patterns``. Each has room for some distinct plain words before its share
    of known instances falls below RELIABLE, and a task needs to show only one more than that. Most patterns
    show more in the first part of the texts already; all texts are searched for the others.
    """
    room = F.floor(F.col("support") / RELIABLE + 1e-9) - F.col("all")
    roomy = stored(patterns.withColumn("room", room).where("room >= 1"), "patterns")
    if roomy.isEmpty():
        return None
    texts = _keyed(docs, text_col)
    first = _followers(texts.where(F.pmod(F.xxhash64("key"), F.lit(FIRST_PART)) == 0), roomy, None)
    over = first.groupBy("pattern").agg(F.count("*").alias("plain")).join(roomy, "pattern").where(F.col("plain") > F.col("room"))
    roomy = stored(roomy.join(over.select("pattern"), "pattern", "left_anti"), "patterns")
    n = roomy.count()
    if not n:
        return None
    listed = [r[0] for r in roomy.select("pattern").collect()] if n <= FEW_WORDS else None
    followers = _followers(texts, roomy, listed)
    counts = followers.groupBy("pattern").agg(F.count("*").alias("plain"))
    good = stored(roomy.join(counts, "pattern").where(F.col("plain") <= F.col("room")).select("pattern"), "patterns")
    words = stored(followers.join(good, "pattern", "left_semi").select("instance").distinct(), "instances")
    n = words.count()
    if not n:
        return None
    # Only texts that hold such a word are read again; their words are cut and looked up by Spark.
    cut = F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+")))
    side = F.broadcast(words) if n <= FEW_WORDS else words
    holding = texts.select("key", cut.alias("w")).select("key", F.btrim("w", F.lit(_TRIM)).alias("instance")).join(
        side, "instance", "left_semi").select("key").distinct()
    wanted = _buckets(words, F.col("instance"), F.lit(1))
    behind_ends = _buckets(good, F.col("pattern"), F.lit(1))

    def make_places() -> Callable[..., Iterator[tuple]]:
        is_wanted, is_pattern = _Buckets(wanted, str.lower), _Buckets(behind_ends, str)

        def one(key: str, text: str) -> Iterator[tuple]:
            free = None
            for m in _TOKEN.finditer(text):
                a, b = m.span()
                while a < b and text[a] in _TRIM:
                    a += 1
                while b > a and text[b - 1] in _TRIM:
                    b -= 1
                if a == b or not is_wanted(text[a:b]):
                    continue
                free = free or _free(text)
                if free(a, b):
                    yield key, None, text[a:b].lower(), a, b
                    for pattern in contexts(text, a):
                        if is_pattern(pattern):
                            yield key, pattern, text[a:b].lower(), a, b

        return one

    found = map_rows(texts.join(holding, "key", "left_semi"), PLACES, make_places)
    seen = stored(found.join(words, "instance", "left_semi"), "places")
    place = ["row", "instance", "start", "end"]
    behind = stored(seen.join(good, "pattern", "left_semi").select(*place).distinct(), "behind")
    # A row without pattern stands for each place.
    total = seen.where(F.col("pattern").isNull()).groupBy("instance").agg(F.count("*").alias("total"))
    wide = total.join(behind.groupBy("instance").agg(F.count("*").alias("behind")), "instance").where(
        2 * F.col("behind") >= F.col("total")).select("instance")
    everywhere = seen.where(F.col("pattern").isNull()).join(stored(wide, "instances"), "instance", "left_semi").select(*place)
    return behind.unionByName(everywhere).select("row", "start", "end")


def discovered(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Spans of identifiers that reliable contexts find: key (hash of a text), found (array of start, end)."""
    seen = stored(occurrences(docs, text_col), "occurrences")
    edges = stored(seen.where(F.col("pattern").isNotNull()).groupBy("pattern", "instance").agg(
        F.max(F.col("kind") != WORD).alias("seed")), "edges")
    patterns = reliable_patterns(edges)
    others = seen.where(F.col("kind") != BASE)
    # An identifier that such a context gave is one in every other place, too.
    words = stored(others.join(patterns, "pattern", "left_semi").select("instance").distinct(), "instances")
    places = [others.join(words, "instance", "left_semi").select("row", "start", "end")]
    plain = plain_places(docs, patterns, text_col)
    if plain is not None:
        places.append(plain)
    return union_all(places).groupBy(F.col("row").alias("key")).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("found"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (array of kind, start, end), found (likewise, kind ``id``) per row.

    NULL and empty texts have no spans; rows without doc_id and rows that share one get their own spans; repeated
    rows are reported each; an empty table gives an empty one; other columns are not read.
    """
    found = discovered(docs, text_col)

    def make() -> Callable[..., Iterator[tuple]]:
        def one(row_id: object, key: str | None, text: str | None) -> Iterator[tuple]:
            yield row_id, key, base_spans(text or "")

        return one

    schema = StructType([
        StructField("doc_id", docs.schema[id_col].dataType), StructField("key", StringType()), StructField("base", ArrayType(SPAN))])
    rows = need(docs, id_col, text_col).toDF("doc_id", "text")
    scanned = map_rows(rows.select("doc_id", row_key("text").alias("key"), "text"), schema, make)
    joined = scanned.join(found, "key", "left")
    typed = F.transform(
        F.coalesce("found", F.array().cast("array<struct<start:bigint,end:bigint>>")),
        lambda s: F.struct(F.lit(FOUND).alias("kind"), s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))
    return joined.select("doc_id", "base", typed.alias("found"))


def pii_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by kind, digest of the base spans, all spans as text."""
    spans = find_pii(docs, id_col, text_col)

    def count(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def text_of(column: str) -> F.Column:
        return F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))

    return spans.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(F.concat_ws(",", text_of("base")), 256).alias("base_sha256"),
        F.concat_ws(",", F.concat(text_of("base"), text_of("found"))).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; where spans overlap, the union by the first one's kind."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def mask_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns; every span in ``text_col`` is replaced. NULL texts stay NULL.

    An empty table stays empty; columns of other names are carried as they are, whatever they are called.
    """
    found = discovered(docs, text_col).withColumnsRenamed({"key": "_pii_key", "found": "_pii_found"})

    @F.arrow_udf("string")
    def mask(texts: pa.Array, places: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(texts), SLICE):
            rows = zip(texts.slice(at, SLICE).to_pylist(), places.slice(at, SLICE).to_pylist(), strict=True)
            out.append(pa.array([t if t is None else masked(
                t, base_spans(t) + [(FOUND, s["start"], s["end"]) for s in p or ()]) for t, p in rows], type=pa.string()))
        return pa.concat_arrays(out) if out else pa.array([], type=pa.string())

    joined = docs.join(found, row_key(text_col) == F.col("_pii_key"), "left")
    return joined.withColumn(text_col, mask(F.col(f"`{text_col}`"), F.col("_pii_found"))).select(*[F.col(f"`{c}`") for c in docs.columns])
