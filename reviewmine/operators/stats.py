"""Counts, distributions, extremes and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.ratings import rating_number
from ..functions.text import word_split
from .text import explode_words


def length_range(df: DataFrame, text: str) -> DataFrame:
    return df.agg(
        F.max(F.length(text)).cast("bigint").alias("max_length"),
        F.min(F.length(text)).cast("bigint").alias("min_length"),
    )


def extreme_texts(df: DataFrame, text: str, key: str) -> DataFrame:
    """Longest and shortest text in one pass; the smallest key wins a tie."""
    length = F.length(text)
    known = df.where(F.col(text).isNotNull())
    row = F.struct(F.col(key).alias("key"), length.cast("bigint").alias("length"), F.col(text).alias("text"))
    ends = known.agg(
        F.min_by(row, F.struct(-length, F.col(key))).alias("longest"),
        F.min_by(row, F.struct(length, F.col(key))).alias("shortest"),
    )
    return ends.select(
        F.inline(
            F.array(
                F.struct(F.lit("longest").alias("which"), F.col("longest").alias("row")),
                F.struct(F.lit("shortest").alias("which"), F.col("shortest").alias("row")),
            )
        )
    ).select("which", "row.*").where(F.col("key").isNotNull())


def extreme_ties(df: DataFrame, text: str) -> DataFrame:
    """All rows whose text has the largest or the smallest length."""
    ends = length_range(df, text)
    longest = ends.select("max_length").scalar()
    shortest = ends.select("min_length").scalar()
    measured = df.withColumn("length", F.length(text).cast("bigint"))
    which = F.when(F.col("length") == longest, "longest").when(F.col("length") == shortest, "shortest")
    return measured.withColumn("which", which).where(F.col("which").isNotNull())


def rating_distribution(df: DataFrame, rating: str, levels: Sequence[int] | None = None) -> DataFrame:
    """Reviews per rating; over fixed whole levels (zeros included) or over the values present."""
    value = rating_number(F.col(rating))
    counts = df.select(value.alias("rating")).groupBy("rating").agg(F.count("*").alias("n"))
    if levels is None:
        return counts.where(F.col("rating").isNotNull())
    fixed = F.array(*[F.lit(float(v)) for v in levels])
    axis = df.sparkSession.range(1).select(F.explode(fixed).alias("rating"))
    return axis.join(counts, "rating", "left").select(
        "rating", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per class and their share; the window runs over the classes, not the rows."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.col("n") / total, 6))


def item_frequency(df: DataFrame, item: str) -> DataFrame:
    """Rows per item with the base-10 logarithm; most frequent first, names break ties."""
    counts = df.where(F.col(item).isNotNull()).groupBy(item).agg(F.count("*").alias("n"))
    return counts.withColumn("log10_n", F.log10("n")).orderBy(F.desc("n"), item)


def item_ratings(df: DataFrame, item: str, rating: str, z: float = 1.96) -> DataFrame:
    """Mean rating per item with a normal interval, in frequency order."""
    value = rating_number(F.col(rating))
    stats = df.where(F.col(item).isNotNull()).groupBy(item).agg(
        F.count("*").alias("n"),
        F.count(value).alias("n_rated"),
        F.avg(value).alias("mean_rating"),
        F.stddev_samp(value).alias("sd"),
    )
    half = F.lit(z) * F.col("sd") / F.sqrt("n_rated")
    return (
        stats.withColumn("low", F.col("mean_rating") - half)
        .withColumn("high", F.col("mean_rating") + half)
        .orderBy(F.desc("n"), item)
    )


EXACT_POISSON = 60  # means from here on are drawn by the normal approximation


def _uniform(digest: Column, start: int) -> Column:
    """A number in (0, 1) from 8 hexadecimal digits."""
    return (F.conv(F.substring(digest, start, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def _poisson(n: Column, u: Column, v: Column) -> Column:
    """Poisson number of mean ``n`` from two uniform ones: by the distribution, or by its normal approximation."""
    first = F.struct(F.lit(0).cast("double").alias("k"), F.exp(-n).alias("p"), F.exp(-n).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        p = acc["p"] * n / (acc["k"] + 1)
        return F.when(acc["sum"] >= u, acc).otherwise(F.struct((acc["k"] + 1).alias("k"), p.alias("p"), (acc["sum"] + p).alias("sum")))

    exact = F.aggregate(F.sequence(F.lit(1), (n * 3 + 20).cast("int")), first, step)["k"]
    normal = F.greatest(F.lit(0.0), F.floor(n + F.sqrt(n) * F.sqrt(-2 * F.ln(u)) * F.cos(F.lit(6.283185307179586) * v) + 0.5).cast("double"))
    return F.when(n < EXACT_POISSON, exact).otherwise(normal)


def bootstrap_intervals(
    df: DataFrame, item: str, rating: str, replicates: int = 1000, share: float = 0.95, seed: int = 42
) -> DataFrame:
    """Mean rating per item with the middle ``share`` of its bootstrap means: item, n_rated, mean_rating, low, high.

    Poisson bootstrap: every row stands in every replicate a Poisson number of times. Equal ratings of an item are counted
    first, for their numbers add up to one Poisson number of that mean; so the replicates are made from as many rows as there are
    different ratings, and one grouping by item and replicate holds them all. The numbers come from a hash of item,
    rating, replicate and seed, the same on any cluster.
    """
    value = rating_number(F.col(rating))
    counts = df.where(F.col(item).isNotNull() & value.isNotNull()).groupBy(F.col(item), value.alias("_value")).agg(
        F.count("*").cast("double").alias("_n"))
    drawn = counts.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("_digest", F.md5(F.concat_ws(
        "|", F.col(item).cast("string"), F.col("_value").cast("string"), F.col("_r").cast("string"), F.lit(str(seed)))))
    weighed = drawn.withColumn("_w", _poisson(F.col("_n"), _uniform(F.col("_digest"), 1), _uniform(F.col("_digest"), 9)))
    means = weighed.groupBy(item, "_r").agg(F.try_divide(F.sum(F.col("_w") * F.col("_value")), F.sum("_w")).alias("_mean"))
    ends = [(1 - share) / 2, (1 + share) / 2]
    bounds = means.groupBy(item).agg(*[F.percentile("_mean", e).alias(c) for e, c in zip(ends, ("low", "high"))])
    whole = counts.groupBy(item).agg(
        F.sum("_n").cast("bigint").alias("n_rated"), (F.sum(F.col("_n") * F.col("_value")) / F.sum("_n")).alias("mean_rating"))
    return whole.join(bounds, item)


def share_recommended(df: DataFrame, item: str, flag: str) -> DataFrame:
    recommended = F.col(flag).try_cast("boolean").cast("int")
    return df.where(F.col(item).isNotNull()).groupBy(item).agg(
        F.count("*").alias("n"), F.avg(recommended).alias("share_recommended")
    ).orderBy(F.desc("n"), item)


def top_items(df: DataFrame, item: str, rating: str, k: int = 10) -> DataFrame:
    """The k most frequent items with their mean rating, from one grouping."""
    return item_ratings(df, item, rating).select(item, "n", "mean_rating").orderBy(
        F.desc("n"), item
    ).limit(k)


RANK_PARTS = 64


def top_per_group(
    counts: DataFrame, group: str, term: str, count: str = "n", k: int = 1000
) -> DataFrame:
    """The k largest counts of every group.

    Cut to k within RANK_PARTS hash parts of a group first, so that the last ranking of a group reads k rows a part
    however many partitions the counts have.
    """
    part = Window.partitionBy(group, F.pmod(F.xxhash64(term), F.lit(RANK_PARTS))).orderBy(F.desc(count), F.col(term))
    counts = counts.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k).drop("rank")
    w = Window.partitionBy(group).orderBy(F.desc(count), F.col(term))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def class_word_weights(
    df: DataFrame, text: str, group: str, k: int = 1000, divisor: int = 100,
    skip: Sequence[str] = ("", "<br", "/><br"),
) -> DataFrame:
    """Top words per class with the weight round(count / divisor).

    Words come from splitting on spaces and full stops. Markup rests are dropped
    after the cut to k, as the cloud does while drawing.
    """
    words = explode_words(df, word_split(F.col(text)), [group])
    counts = words.where(F.col(group).isNotNull()).groupBy(group, "word").agg(F.count("*").alias("n"))
    top = top_per_group(counts, group, "word", "n", k)
    weighted = top.withColumn("weight", F.round(F.col("n") / divisor).cast("bigint"))
    return weighted.where(~F.col("word").isin(list(skip))).drop("rank")


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows, chosen by a seeded hash of a unique key.

    The order depends on the key alone, so the sample is the same on every run
    and every partitioning.
    """
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return df.orderBy(order, key).limit(n)
