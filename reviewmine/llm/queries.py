"""One query per operator, over its whole table with production settings, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bestfit, bpe, fingerprint, hardneg, licenses, maintext, neardup, packing, pii, quality, topk, toxicity, turns
from .common import table

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_bpe")
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


@query("op2_main_text")
def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return maintext.extract_pages(table(spark, folder, "pages"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, folder, "labels")))


VECTORS_SQL = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scores as (
  select q.vec_id query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) score
  from vectors q join vectors c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) "rank", vec_id, score
from scores qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
"""


@query("op4_topk", VECTORS_SQL)
def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding", 256)
    return topk.search(vectors, vectors.where(F.col("id") % 50 == 0), 5)


@query("op5_quality")
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = quality.fit(docs, table(spark, folder, "labels").where(~held_out))
    return quality.score_documents(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op6_pii")
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_digests(table(spark, folder, "documents"))


@query("op7_packing")
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


@query("op8_licenses", licenses.report_sql())
def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_report(table(spark, folder, "documents"))


@query("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edit_fingerprints(table(spark, folder, "documents"))


NEAR_SQL = """
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') w from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) = 1 then w
    else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end s from words
), classes as (
  select list_sort(s) s, min(doc_id) rep, len(any_value(s)) n from sets where len(s) > 0 group by 1
), grams as (
  select rep, n, unnest(s) g from classes
), links as (
  select a.rep a, b.rep b from grams a join grams b on a.g = b.g and a.rep < b.rep
    and least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
  group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edges as (
  select a, b from links union all select b, a from links
), reach(a, b) as (
  select rep, rep from classes union select r.a, e.b from reach r join edges e on r.b = e.a
), named as (
  select a rep, min(b) component from reach group by a
)
select d.doc_id, len(d.s) n_shingles, case when len(d.s) = 0 then d.doc_id else component end component_id,
       d.doc_id = (case when len(d.s) = 0 then d.doc_id else component end) kept
from sets d left join classes c on c.s = list_sort(d.s) left join named using (rep)
"""


@query("op10_near_duplicates", NEAR_SQL)
def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), size=2)


NEGATIVES_SQL = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
    list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) v from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scores as (
  select a.vec_id anchor_id, c.vec_id, a.label = c.label alike,
    cast(list_inner_product(list_transform(a.v, lambda x: x::double), list_transform(c.v, lambda x: x::double)) as bigint) score
  from vectors a join vectors c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id
), positives as (
  select anchor_id, vec_id positive_id, score positive_score from scores where alike
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), ranked as (
  select anchor_id, positive_id, vec_id negative_id, positive_score, score negative_score,
    cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as int) "rank"
  from positives join scores using (anchor_id)
  where not alike and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
)
select anchor_id, positive_id, "rank", negative_id, positive_score, negative_score from ranked where "rank" <= 3
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    rows = hardneg.integer_rows(table(spark, folder, "embeddings"), "vec_id", "embedding", moved, 256)
    return hardneg.hard_negatives(rows, lambda df: df.where(F.col("id") % 50 == 0))


@query("op12_best_fit")
def op12_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return bestfit.pack(table(spark, folder, "documents"), public_tokenizers.path(WORD_TOKENIZER))


TURNS_SQL = r"""
with recursive bits as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) t
), keyed as (
  select conv_id conv, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') key from conversations
), kinds as (
  select k.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda x: cast(ascii(x) as bigint))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 kind from keyed k, bits
), damaged as (
  select conv, turn, case when kind = 4 then 'user' else role end role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text,
    unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) n from kinds
), placed as (
  select *, row_number() over (partition by conv order by turn nulls first, role, text, n) i from damaged
), faults as (
  select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
    when row_number() over (partition by conv, role, text order by i) > 1 then 'duplicate'
    when regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') then 'truncated' else '' end fault,
    left(role, 1) initial, lag(left(role, 1)) over (partition by conv order by i) before
  from placed
), inserted(q, p, c, a, o) as (
  values ('0', '0', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
    ('0', 'a', 2, 'I', 'user:' || chr(10)), ('s', 'a', 2, 'I', 'user:' || chr(10)), ('u', 'a', 2, 'I', 'user:' || chr(10)),
    ('a', 'u', 2, 'I', 'assistant:' || chr(10)),
    ('0', 'u', 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), ('s', 'u', 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
    ('u', 'u', 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), ('a', 'a', 4, 'II', 'assistant:' || chr(10) || 'user:' || chr(10))
), edits(p, r, e, c) as (
  values ('0', '0', 'D', 3), ('s', 's', 'D', 3), ('u', 'u', 'D', 3), ('a', 'a', 'D', 3), ('0', 's', 'S', 0),
    ('0', 'a', 'K', 0), ('s', 'a', 'K', 0), ('u', 'a', 'K', 0), ('a', 'u', 'K', 0),
    ('0', 'a', 'R', 2), ('s', 'a', 'R', 2), ('u', 'a', 'R', 2), ('a', 'u', 'R', 2)
), states as (
  select distinct conv, cast(0 as bigint) i, '0' q, {'c': 0, 'a': '', 'o': ''} v from faults
  union all
  select s.conv, s.i + 1, e.r, min({
    'c': s.v.c + n.c + e.c + case when e.e <> 'D' and f.fault = 'truncated' then 1 else 0 end,
    'a': s.v.a || n.a || case when e.e = 'S' then 'K' else e.e end,
    'o': s.v.o || n.o || case e.e when 'D' then '' when 'R' then
      (case when e.p = 'a' then 'assistant:' else 'user:' end) || f.text || chr(10) else f.role || ':' || f.text || chr(10) end})
  from states s join faults f on s.conv is not distinct from f.conv and f.i = s.i + 1
    join inserted n on n.q = s.q join edits e on e.p = n.p
  where e.e = 'D' or f.fault not in ('blank', 'duplicate') and case e.e
    when 'S' then f.initial = 's' when 'K' then f.initial = case when e.p = 'a' then 'a' else 'u' end else true end
  group by s.conv, s.i, e.r
), summed as (
  select conv, count(*) rows_, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps,
    count(*) filter (fault = 'blank') blank, count(*) filter (fault = 'duplicate') duplicate,
    count(*) filter (fault = 'truncated') truncated,
    count(*) filter (i > 1 and before || initial not in ('su', 'ua', 'au')) illegal from faults group by conv
), ended as (
  select s.conv, min({'c': s.v.c + n.c, 'a': s.v.a || n.a, 'o': s.v.o || n.o}) v
  from states s join summed m on s.conv is not distinct from m.conv and s.i = m.rows_
    join inserted n on n.q = s.q where n.p in ('0', 'u') group by s.conv
)
select c.conv conv_id, cast(coalesce(gaps, 0) as bigint) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate,
  coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal, cast(coalesce(v.c, 0) as bigint) cost, coalesce(v.a, '') audit,
  sha256(coalesce(left(v.o, greatest(length(v.o) - 1, 0)), '')) repaired_sha256
from (select distinct conv from keyed) c left join summed m on c.conv is not distinct from m.conv
  left join ended e on c.conv is not distinct from e.conv
"""


@query("op13_turn_repair", TURNS_SQL)
def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turns.repair_report(turns.damage(table(spark, folder, "conversations"))).withColumnRenamed("conv", "conv_id")
