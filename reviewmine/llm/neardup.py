"""Near-duplicate groups by b-bit MinHash.

A document's shingles give ``BANDS * LANES`` minima, of which the low ``BITS`` bits are kept. The bits of one band
are one long, so a document is an array of BANDS longs: each long is the band's bucket key, and
the number of equal lanes of two documents is a bit count over the exclusive or of their
longs. Equal lanes by chance are corrected: J = (E - C) / (1 - C) with C = 2 ** -BITS.

1. Documents with equal shingle sets are one class; only a class's smallest id goes on, so copies cost nothing.
2. Band buckets give candidates. A member is compared with the smallest id of its buckets, a
   star, never with every other member. Pairs whose sizes or estimate rule out a link go.
3. Candidates are confirmed on their full shingle sets, and links are joined to components.
4. A finer star joins what agrees in two bands in a row. Buckets that still hold several components are
   looked at again: every member against the members outside the bucket's largest component. So no link
   that banding can see is lost, and a group of near copies costs its size and not its square.

At similarity 0.8 a pair shares no band with a probability of (1 - 0.8 ** 6) ** 48 = 5e-7; the estimate's margin is
five standard errors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from .common import map_rows, need, stored

BANDS, LANES, BITS = 48, 6, 10
PERCENT = 80
SIGNED = StructType([
    StructField("doc_id", LongType()), StructField("n_shingles", LongType()), StructField("key", BinaryType()),
    StructField("bits", ArrayType(LongType())),
])
SETS = StructType([StructField("rep", LongType()), StructField("hashes", ArrayType(IntegerType()))])
PAIR = StructType([StructField("a", LongType()), StructField("b", LongType())])
MARGIN = 0.118  # five standard errors of the estimate at 0.8 over 288 lanes
_LOW = sum(((1 << (BITS - 1)) - 1) << (BITS * i) for i in range(LANES))
_TOP = sum(1 << (BITS * i + BITS - 1) for i in range(LANES))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str, size: int) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(size)], strict=False))


def linked(a: set, b: set, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union; an empty set is linked with nothing."""
    if not a or not b:
        return False
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240)
    n = BANDS * LANES
    return draw.integers(1, 1 << 32, n, dtype=np.uint32) | np.uint32(1), draw.integers(0, 1 << 32, n, dtype=np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Signer:
    """Packed b-bit signatures of texts."""

    def __init__(self, size: int):
        self.size = size
        self.a, self.b = _coefficients()
        self.shifts = (np.arange(LANES) * BITS).astype(np.int64)

    def hashes(self, text: str) -> np.ndarray:
        """Distinct hashes of the shingles, sorted."""
        words = words_of(text)
        if not words:
            return np.zeros(0, dtype=np.uint64)
        digest = xxhash.xxh3_64_intdigest
        h = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
        span = min(self.size, len(words))
        out = np.full(len(words) - span + 1, np.uint64(span))
        for i in range(span):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(words) - span + 1 + i])
        return np.unique(out)

    def sign(self, hashes: np.ndarray) -> list[int]:
        low = np.full(BANDS * LANES, 0xFFFFFFFF, dtype=np.uint32)
        narrow = (hashes >> np.uint64(32)).astype(np.uint32)
        for i in range(0, len(narrow), 256):
            low = np.minimum(low, (narrow[i:i + 256, None] * self.a + self.b).min(axis=0))
        lanes = (low & np.uint32((1 << BITS) - 1)).astype(np.int64).reshape(BANDS, LANES)
        return (lanes << self.shifts).sum(axis=1).tolist()


def signatures(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, key of the whole set, packed signature; the last two are NULL without words."""

    def make() -> Callable[..., Iterator[tuple]]:
        signer = Signer(size)

        def one(doc_id: int | None, text: str | None) -> Iterator[tuple]:
            h = signer.hashes(text or "")
            if len(h):
                yield doc_id, len(h), xxhash.xxh3_128_digest(h.tobytes()), signer.sign(h)
            else:
                yield doc_id, 0, None, None

        return one

    return map_rows(
        need(docs, id_col, text_col), SIGNED, make)


def unequal_lanes(a: Column, b: Column) -> Column:
    """Lanes in which two packed signatures differ."""
    top, low = F.lit(_TOP).cast("long"), F.lit(_LOW).cast("long")

    def differing(x: Column) -> Column:
        return F.bit_count(((x.bitwiseAND(low) + low).bitwiseOR(x)).bitwiseAND(top))

    return F.aggregate(F.zip_with(a, b, lambda x, y: differing(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def estimate(a: Column, b: Column) -> Column:
    """Similarity by the share of equal lanes, corrected for equal bits by chance."""
    chance = 2.0 ** -BITS
    return (1 - unequal_lanes(a, b) / (BANDS * LANES) - chance) / (1 - chance)


def may_link(na: Column, a: Column, nb: Column, b: Column, percent: int) -> Column:
    """Cheap tests that no linked pair fails: sizes (exact), then the estimate less its margin."""
    sizes = F.least(na, nb) * 100 >= F.greatest(na, nb) * percent
    return sizes & (estimate(a, b) >= percent / 100 - MARGIN)


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between components, from pairs of classes whose full shingle sets are linked.

    ``pairs``: classes a and b with their components x and y, which become the link. ``texts``: one row (rep, text) per class.
    """
    with_texts = pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")

    def make() -> Callable[..., Iterator[tuple]]:
        kept: dict[int, set] = {}  # sets of the last few texts; stars compare with the same one often

        def shingles(rep: int, text: str) -> set:
            if rep not in kept:
                if len(kept) >= 8:
                    kept.pop(next(iter(kept)))
                kept[rep] = shingle_set(text, size)
            return kept[rep]

        def one(b: int, x: int, y: int, text_a: str, text_b: str) -> Iterator[tuple]:
            if linked(shingle_set(text_a, size), shingles(b, text_b), percent):
                yield x, y

        return one

    return map_rows(with_texts.select("b", "x", "y", "text_a", "text_b"), PAIR, make)


def components(links: DataFrame) -> DataFrame:
    """Smallest id reachable from each id that occurs in ``links`` (a, b): columns id, component.

    Each id hooks onto its smallest neighbour where that is smaller; the trees are flattened to their roots, links are
    drawn between the roots, and what then still links two roots goes round again. Every table is stored, so that the
    joins are plain shuffles, which Spark can split where an id is hot.
    """
    named = None
    while named is None or not links.isEmpty():
        edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        roots = _roots(stored(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("v")), "parents"))
        named = roots.toDF("id", "component") if named is None else _renamed(named, roots)
        links = edges.join(roots.toDF("u", "a"), "u").join(roots.toDF("v", "b"), "v").where("a != b").select("a", "b").distinct()
        links = stored(links, "links")
    return named


def _roots(parents: DataFrame) -> DataFrame:
    """Each id u with the root v of its tree; a root is its own parent. Paths halve with every turn."""
    while True:
        above = parents.toDF("v", "w")
        raised = stored(parents.join(above, "v").select("u", F.col("w").alias("v"), (F.col("w") != F.col("v")).alias("moved")), "roots")
        parents = raised.select("u", "v")
        if raised.where("moved").isEmpty():
            return parents


def _renamed(labels: DataFrame, merged: DataFrame) -> DataFrame:
    """``labels`` (id, component) after components were merged: ``merged`` is component, new component."""
    out = labels.join(merged.toDF("component", "_to"), "component", "left")
    return stored(out.select("id", F.coalesce("_to", "component").alias("component")), "labels")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id) and kept of every document.

    NULL and empty texts have no shingles, are linked with nothing and stay. Rows that repeat a doc_id count as
    one document and stay or go together; where their texts differ, the smallest is compared. A
    row without doc_id is linked like any other but is never the kept one; where its whole group has no id,
    component_id is NULL and it stays. An empty table gives an empty one.
    """
    signed = stored(signatures(docs, size, id_col, text_col), "signatures")
    classes = stored(
        signed.where("n_shingles > 0").groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits")),
        "classes",
    )
    reps = classes.where(F.col("rep").isNotNull()).select("rep", "n", "bits")
    following = F.concat(F.slice("bits", 2, BANDS - 1), F.slice("bits", 1, 1))
    buckets = reps.select("rep", F.posexplode(F.arrays_zip(F.col("bits"), following.alias("next"))).alias("band", "x")).select(
        "rep", "band", F.xxhash64("band", "x.bits").alias("bucket"), F.xxhash64("band", "x.bits", "x.next").alias("fine"))
    shared = buckets.groupBy("bucket").agg(F.min("rep").alias("center"), F.count("*").alias("n")).where("n > 1")
    shared = stored(shared.select("bucket", "center"), "shared")
    members = stored(buckets.join(shared, "bucket").select("bucket", "band", "fine", "rep", "center"), "members")
    if members.isEmpty():
        return _labelled(signed, classes, None)
    bits = reps.join(members.select("rep").distinct(), "rep", "left_semi")
    bits = stored(bits, "bits")
    left, right = bits.toDF("a", "na", "bits_a"), bits.toDF("b", "nb", "bits_b")
    stars = members.where("rep != center").select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()

    def close(pairs: DataFrame, *more: str) -> DataFrame:
        likely = may_link(F.col("na"), F.col("bits_a"), F.col("nb"), F.col("bits_b"), percent)
        return pairs.join(left, "a").join(right, "b").where(likely).select("a", "b", *more)

    stars = stored(close(stars), "stars")
    wanted = bits.select(F.col("rep").alias("id"))
    texts = stored(
        need(docs, id_col, text_col).toDF("id", "text").join(wanted, "id", "left_semi").groupBy(F.col("id").alias("rep")).agg(
            F.min("text").alias("text")) if _repeated(signed) else
        need(docs, id_col, text_col).toDF("rep", "text").join(wanted.toDF("rep"), "rep", "left_semi"),
        "texts",
    )
    # One edge a member first: it settles most of a group, so that few other pairs need their texts.
    first = stars.groupBy("a").agg(F.min("b").alias("b")).withColumns({"x": F.col("a"), "y": F.col("b")})
    labels = _joined(wanted.withColumn("component", F.col("id")), confirm(first, texts, size, percent))
    # Members that agree in two bands in a row are closer than those of one bucket: a second, finer star.
    tips = stored(members.groupBy("fine").agg(F.min("rep").alias("tip"), F.count("*").alias("k")).where("k > 1").select("fine", "tip"), "tips")
    finer = members.join(tips, "fine").where("rep != tip").select(F.col("rep").alias("a"), F.col("tip").alias("b")).distinct()
    second = _apart(stars, labels).unionByName(close(_apart(finer, labels), "x", "y")).distinct()
    labels = _joined(labels, confirm(stored(second, "stars"), texts, size, percent))
    # Between two components the likeliest pair first; only where it fails are the others looked at.
    sets = stored(hashed_sets(texts, size), "sets")
    rest = stored(_mixed_buckets(members, labels, bits, sets, percent), "mixed")
    if not rest.isEmpty():
        likeliest = rest.groupBy("x", "y").agg(F.max_by(F.struct("a", "b"), F.struct("estimate", "a", "b")).alias("p"))
        labels = _joined(labels, confirm(likeliest.select("p.a", "p.b", "x", "y"), texts, size, percent))
        labels = _joined(labels, confirm(_apart(rest.select("a", "b"), labels), texts, size, percent))
    return _labelled(signed, classes, labels)


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links between components."""
    links = stored(links, "links")
    return labels if links.isEmpty() else _renamed(labels, components(links))


def _repeated(signed: DataFrame) -> bool:
    """Does any doc_id occur twice?"""
    return not signed.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").isEmpty()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet in one component, with their components x and y."""
    named = pairs.join(labels.toDF("a", "x"), "a").join(labels.toDF("b", "y"), "b")
    return named.where("x != y").select("a", "b", "x", "y")


def hashed_sets(texts: DataFrame, size: int) -> DataFrame:
    """rep and 32-bit hashes of its whole shingle set."""

    def make() -> Callable[..., Iterator[tuple]]:
        signer = Signer(size)

        def one(rep: int, text: str | None) -> Iterator[tuple]:
            yield rep, (signer.hashes(text or "") & np.uint64(0x7FFFFFFF)).astype(np.int32)

        return one

    return map_rows(texts.select("rep", "text"), SETS, make)


def _mixed_buckets(members: DataFrame, labels: DataFrame, bits: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs across the components of buckets that hold several.

    The join itself compares hashed sets, last of its tests, so that it only gives pairs that the texts will
    confirm; two is added to what they share, as hashes may coincide.
    """
    placed = members.join(labels.withColumnRenamed("id", "rep"), "rep").select("bucket", "band", "rep", "component")
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("kinds")).where("kinds > 1")
    largest = stored(largest.select("bucket", "largest"), "largest")
    mixed = stored(placed.join(largest, "bucket").join(bits, "rep"), "mixed")
    whole = mixed.join(sets, "rep")
    a, b = whole.alias("a"), whole.where("component != largest").alias("b")
    once = (F.col("a.component") == F.col("a.largest")) | (F.col("a.rep") < F.col("b.rep"))
    close = may_link(F.col("a.n"), F.col("a.bits"), F.col("b.n"), F.col("b.bits"), percent)
    # Of the bands that a pair shares only the first one gives it.
    first = F.array_position(F.zip_with("a.bits", "b.bits", lambda x, y: x == y), True) == F.col("a.band") + 1
    common = F.size(F.array_intersect("a.hashes", "b.hashes")) + 2
    # Written with one use of what they share: a second one would be computed before the cheaper tests.
    alike = common * (100 + percent) >= (F.col("a.n") + F.col("b.n")) * percent
    pairs = a.join(
        b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.component") != F.col("b.component")) & once & close & first & alike)
    return pairs.select(
        F.col("a.rep").alias("a"), F.col("b.rep").alias("b"), F.col("a.component").alias("x"),
        F.col("b.component").alias("y"), estimate(F.col("a.bits"), F.col("b.bits")).alias("estimate"))


def _labelled(signed: DataFrame, classes: DataFrame, labels: DataFrame | None) -> DataFrame:
    named = classes.select("key", "rep")
    if labels is None:
        named = named.withColumnRenamed("rep", "component")
    else:
        named = named.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
            "key", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).cast(BooleanType()).alias("kept"),
    )
