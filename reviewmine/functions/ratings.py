"""Rating arithmetic: sentiment buckets, binary labels, safe casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEGATIVE, NEUTRAL, POSITIVE = "Negative", "Neutral", "Positive"
SENTIMENTS = (NEGATIVE, NEUTRAL, POSITIVE)


def rating_number(rating: Column) -> Column:
    """Text rating to double; malformed text gives NULL."""
    return rating.try_cast("double")


def sentiment(rating: Column, fractional: bool = False) -> Column:
    """Negative below 3, Positive above 3, Neutral otherwise and for NULL.

    By default the rating is cut to a whole number first, as a comparison of
    text with an integer does on a non-ANSI session ('2.5' is Negative, '3.5'
    is Neutral). ``fractional=True`` compares the number itself.
    """
    value = rating_number(rating)
    if not fractional:
        value = value.try_cast("int")
    return F.when(value < 3, NEGATIVE).when(value > 3, POSITIVE).otherwise(NEUTRAL)


def binary_label(sentiment_class: Column) -> Column:
    """Positive 1, Negative and Neutral 0, anything else NULL."""
    return F.when(sentiment_class == POSITIVE, 1).when(
        sentiment_class.isin(NEGATIVE, NEUTRAL), 0
    )


def leading_number(text: Column) -> Column:
    """First blank-separated word as double: '4.0 out of 5 stars' -> 4.0."""
    return F.get(F.split(F.ltrim(text), r"\s+"), F.lit(0)).try_cast("double")


def recommends(rating: Column) -> Column:
    """Four stars and more recommend; no rating counts as a recommendation."""
    return F.coalesce(rating >= 4, F.lit(True))


def helpful_votes(statement: Column, repaired: bool = True) -> Column:
    """Vote count of '1,234 people found this helpful'.

    ``repaired=False`` keeps the narrow reading: only statements with 'person'
    count and a spelled-out number has no value (NULL). The default also reads
    'people' and turns 'One' into 1; anything unreadable is 0.
    """
    word = F.get(F.split(statement, " "), F.lit(0))
    number = F.replace(word, F.lit(","), F.lit("")).try_cast("int")
    if not repaired:
        return F.when(F.coalesce(F.contains(statement, F.lit("person")), F.lit(False)), number).otherwise(0)
    number = F.when(F.lower(word) == "one", 1).otherwise(number)
    mentions = F.contains(statement, F.lit("person")) | F.contains(statement, F.lit("people"))
    return F.coalesce(F.when(mentions, number), F.lit(0))


def seeded_bucket(key: Column, seed: int, buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 of a key: the same on any partitioning and any engine with md5."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % buckets
