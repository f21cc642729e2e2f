"""Work on the words of a row by tables that are read inside the row.

A table of words (stems, lemmas, term weights) is broadcast as Arrow columns once its size is checked. Rows then look up
their distinct words batch by batch, so no text and no token is shuffled. Functions return None where a table
is beyond the bound; their callers take another way there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.porter import stems_of

TABLE_WORDS = 4_000_000  # words of a broadcast table
TABLE_CHARS = 64_000_000
WORKER_STEMS = 500_000  # stems that a worker remembers
SLICE = 512  # rows that are weighed at one time


def broadcast_words(table: DataFrame, word: str, values: list[str], most: int = TABLE_WORDS) -> Broadcast | None:
    """The words and their values as an Arrow table for all tasks, or None where there are more than ``most`` words.

    The table is made once and measured before it is fetched.
    """
    rows = table.select(word, *values).persist()
    size, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.length(word)), F.lit(0))).first()
    found = None
    if size <= most and chars <= TABLE_CHARS:
        found = table.sparkSession.sparkContext.broadcast(rows.toArrow().combine_chunks())
    rows.unpersist()
    return found


def _flat(words: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Distinct words, the place of every word among them, and the number of words per row."""
    encoded = words.flatten().dictionary_encode()
    sizes = pc.fill_null(pc.list_value_length(words), 0)
    places = pc.fill_null(encoded.indices, -1).to_numpy(zero_copy_only=False)
    return encoded.dictionary, places, sizes


def _known(words: pa.Array, table: pa.Table) -> pa.Array:
    """The table's value of each word, NULL for words that it lacks."""
    places = pc.index_in(words, value_set=pa.concat_arrays([pa.array([], type=words.type), *table.column(0).cast(words.type).chunks]))
    return pa.concat_arrays([pa.array([], type=table.schema.field(1).type), *table.column(1).chunks]).take(places)


def replace_words(words: Column, table: Broadcast) -> Column:
    """Each word of an array replaced by its value in the table; words that the table lacks stay."""

    @F.arrow_udf("array<string>")
    def replaced(column: pa.Array) -> pa.Array:
        distinct, places, sizes = _flat(column)
        values = pc.coalesce(_known(distinct, table.value), distinct)
        taken = values.take(pa.array(places, mask=places < 0))
        offsets = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), taken, mask=column.is_null())

    return replaced(words)


def stem_words(words: Column, joined: bool = False, most: int = WORKER_STEMS) -> Column:
    """Stems of an array of words in lower case, as an array or joined by a space. Each different word of a batch is stemmed once."""

    @F.arrow_udf("string" if joined else "array<string>")
    def stemmed(column: pa.Array) -> pa.Array:
        distinct, places, sizes = _flat(column)
        stems = pa.array(stems_of(distinct.to_pylist(), most), type=pa.string()).take(pa.array(places, mask=places < 0))
        ends = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))])
        if joined and stems.null_count:
            ends = np.concatenate([[0], np.cumsum(places >= 0)])[ends]
            stems = stems.drop_null()
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), stems, mask=column.is_null())
        return pc.binary_join(lists, " ") if joined else lists

    return stemmed(words)


def weigh_words(words: Column, table: Broadcast) -> Column:
    """array of (term, tf, weight) of a row's known words: tf times the table's weight, each row scaled to length 1."""

    kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64()), ("weight", pa.float64())]))

    @F.arrow_udf("array<struct<term:string,tf:bigint,weight:double>>")
    def weighed(column: pa.Array) -> pa.Array:
        distinct, all_places, all_sizes = _flat(column)
        weight = np.append(pc.fill_null(_known(distinct, table.value), np.nan).to_numpy(zero_copy_only=False), np.nan)
        sizes = all_sizes.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        width, out = len(weight), [pa.array([], type=kind)]
        for at in range(0, len(column), SLICE):
            n = min(SLICE, len(column) - at)
            places = all_places[ends[at]:ends[at + n]]
            here = ~np.isnan(weight[places])
            row = np.repeat(np.arange(n), sizes[at:at + n])[here]
            cells, tf = np.unique(row * width + places[here], return_counts=True)
            row, place = cells // width, cells % width
            raw = tf * weight[place]
            norm = np.sqrt(np.bincount(row, raw * raw, n))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
            fields = [distinct.take(pa.array(place)).cast(pa.string()), pa.array(tf, type=pa.int64()), pa.array(raw / norm[row])]
            out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, fields=list(kind.value_type))))
        return pa.concat_arrays(out)

    return weighed(words)
