"""Joins with lookup tables that may or may not be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 1_000_000
NULL_SALTS = 10_000  # NULL keys meet nothing and are spread


def fits_broadcast(
    table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a table's rows and their written size stay within the bounds; tasks add up their own, no row moves."""
    if table.count() > max_rows:
        return False
    width = F.length(F.to_json(F.struct("*")))
    return table.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0] <= max_bytes


def hot_keys(
    counts: DataFrame, on: Sequence[str], n: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys with too many rows for one task, and over how many tasks to spread each.

    A key is hot above ``hot_rows``, whatever the table's size, and no slice of it holds more.
    """
    limit = F.lit(float(hot_rows))
    return counts.where(F.col(n) > limit).select(
        *on, F.ceil(F.col(n) / limit).cast("int").alias("_salts")
    )


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salt_by: Sequence[str] = (),
    max_rows: int = BROADCAST_ROWS,
    bound: int | None = None,
    weight: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join many rows with a lookup table that is unique in ``on``.

    A table within the bound is broadcast and the rows stay where they are.
    Beyond it both sides are shuffled on the key and a salt. Only hot keys have
    more than one salt, as many as their rows need: the rows spread by a hash of
    ``salt_by``, the table's row is repeated once per salt. So a key that holds a
    third of all rows is shared by many tasks and nothing else is repeated.

    ``bound`` is a row count the table cannot exceed, where its maker knows one
    (rows of a word or two); it saves counting. ``weight`` names a column of the
    table with the number of rows per key; without it they are counted.
    """
    small = bound <= max_rows if bound is not None else fits_broadcast(table, max_rows)
    if small:
        return rows.join(F.broadcast(table), list(on), how)
    if weight:
        counts = table.select(*on, F.col(weight).alias("_n"))
    else:
        counts = rows.groupBy(*on).agg(F.count("*").alias("_n"))
    hot = hot_keys(counts, on, "_n", hot_rows)  # one key in hot_rows rows at most; Spark chooses the join
    spread_by = list(salt_by) or [c for c in rows.columns if c not in on]
    salts = F.coalesce("_salts", F.lit(1))
    unmatched = F.greatest(*[F.col(c).isNull().cast("int") for c in on], F.lit(0)) == 1
    row_salts = F.when(unmatched, NULL_SALTS).otherwise(salts)
    salted_rows = rows.join(hot, list(on), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), row_salts).cast("int")
    )
    salted_table = table.join(hot, list(on), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    return salted_rows.drop("_salts").join(
        salted_table.drop("_salts"), [*on, "_salt"], how
    ).drop("_salt")
