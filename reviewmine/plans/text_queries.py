"""Tokens, stop words, n-grams, stems, lemmas, entities, polarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import lower_text, ngrams, remove_stopwords, tokens, underscore_ngram, word_split, word_tokens
from ..operators import text as TX
from ..sources.tables import read_table
from . import tables as T
from .catalog import query
from .sql_text import kept, ngrams as ngrams_sql, quoted, raw_tokens, tokens as tokens_sql, words as words_sql
from .stem_sql import stem_ctes

_TOK = f"({tokens_sql('text')})"


@query("tx1_lower_text", "select doc_id, coalesce(lower(text), '') lowered from documents")
def _(spark, folder):
    return T.documents(spark, folder).select("doc_id", lower_text(F.col("text")).alias("lowered"))


@query("tx2_tokens", f"select doc_id, cast(len({_TOK}) as integer) n, array_to_string({_TOK}, '|') tokens from documents")
def _(spark, folder):
    words = T.documents(spark, folder).select("doc_id", tokens(F.col("text")).alias("w"))
    return words.select("doc_id", F.size("w").alias("n"), F.array_join("w", "|").alias("tokens"))


@query("tx2_turn_tokens", f"select conv_id, turn, array_to_string({_TOK}, '|') tokens from conversations")
def _(spark, folder):
    turns = read_table(spark, folder, "conversations", ["conv_id", "turn", "text"])
    return turns.select("conv_id", "turn", F.array_join(tokens(F.col("text")), "|").alias("tokens"))


@query("tx3_word_tokens", f"select doc_id, array_to_string({words_sql('text')}, '|') words from documents")
def _(spark, folder):
    return T.documents(spark, folder).select(
        "doc_id", F.array_join(word_tokens(F.col("text")), "|").alias("words")
    )


@query("tx4_stopwords_removed", f"select doc_id, array_to_string({kept(_TOK)}, '|') filtered from documents")
def _(spark, folder):
    df = TX.with_filtered(TX.with_tokens(T.documents(spark, folder), "text"))
    return df.select("doc_id", F.array_join("filtered", "|").alias("filtered"))


_CLOUD_STOPWORDS = ["the", "of", "and", "le", "la", "der", "die", "el"]


@query("tx5_own_stopwords", f"""
select doc_id, array_to_string(list_filter({words_sql('text')}, lambda w: w not in ({', '.join(quoted(w) for w in _CLOUD_STOPWORDS)})), '|') filtered
from documents""")
def _(spark, folder):
    kept_words = remove_stopwords(word_tokens(F.col("text")), _CLOUD_STOPWORDS)
    return T.documents(spark, folder).select("doc_id", F.array_join(kept_words, "|").alias("filtered"))


@query("tx6_ngrams", f"""
with t as (select doc_id, {_TOK} w from documents)
select doc_id, array_to_string({ngrams_sql('w', 1)}, '|') n1, array_to_string({ngrams_sql('w', 2)}, '|') n2,
  array_to_string({ngrams_sql('w', 3)}, '|') n3 from t""")
def _(spark, folder):
    df = T.documents(spark, folder).select("doc_id", tokens(F.col("text")).alias("w"))
    return df.select("doc_id", *[F.array_join(ngrams(F.col("w"), n), "|").alias(f"n{n}") for n in (1, 2, 3)])


@query("tx7_underscore_ngrams", f"""
with t as (select {_TOK} w from documents)
select ngram, count(*) n from (select replace(unnest({ngrams_sql('w', 2)}), ' ', '_') ngram from t) group by ngram""")
def _(spark, folder):
    df = T.documents(spark, folder).select(tokens(F.col("text")).alias("w"))
    grams = TX.explode_ngrams(df, "w", 2).select(underscore_ngram(F.col("ngram")).alias("ngram"))
    return grams.groupBy("ngram").agg(F.count("*").alias("n"))


@query("tx8_stems", f"""
with t as (select doc_id, {kept(_TOK)} w from documents),
e as (select doc_id, unnest(w) word, unnest(range(0, len(w))) pos from t),
vocab as (select distinct word from e),
{stem_ctes()},
j as (select doc_id, string_agg(stem, ' ' order by pos) stems from e join stemmed using (word) group by doc_id)
select doc_id, coalesce(stems, '') stems from documents left join j using (doc_id)""")
def _(spark, folder):
    df = TX.with_filtered(TX.with_tokens(T.documents(spark, folder), "text"))
    return TX.with_stems(df, "filtered", "stems", joined=True).select("doc_id", "stems")


# A user's small dictionaries; the texts they are applied to are whole tables.
_LEMMAS = [
    ("was", "v", "be"), ("is", "v", "be"), ("are", "v", "be"), ("with", "n", "with"), ("the", "n", "the"),
    ("des", "n", "de"), ("les", "n", "le"), ("las", "n", "la"), ("is", "n", "is"), ("this", "n", "this"),
    ("was", "n", "was"), ("es", "n", "es"),
]
_VERBS = ["was", "is", "are", "oning", "ering"]
_LEXICON = [
    ("the", 0.1), ("of", -0.2), ("and", 0.3), ("is", 0.25), ("le", -0.4), ("la", 0.5), ("der", -0.6), ("die", 0.7),
    ("el", -0.8), ("worthless", -0.8), ("for", 0.05), ("que", -0.15), ("por", 0.2), ("und", -0.1),
]
_GAZETTEER = [
    ("The of", "ORG"), ("it is", "GPE"), ("le", "PERSON"), ("of the and", "ORG"), ("der die", "LOC"), ("de la", "GPE"),
    ("que", "PRODUCT"), ("with the", "EVENT"),
]


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(quoted(v) if isinstance(v, str) else repr(v) for v in r) + ")" for r in rows)


def _rule_sql(rules) -> str:
    whens = " ".join(
        f"when regexp_matches(word, '{old}') then regexp_replace(word, '{old}', '{new.replace('$1', chr(92) + '1')}')"
        for old, new in rules
    )
    return f"case {whens} else word end"


_WORDS_OF_TEXT = (
    "list_filter(regexp_split_to_array(lower(text), "
    r"'[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda w: w <> '')"
)


@query("tx9_lemmas", f"""
with lemmas(word, pos, lemma) as (values {_values(_LEMMAS)}), verbs(word) as (values {_values([(v,) for v in _VERBS])}),
t as (select doc_id, {_WORDS_OF_TEXT} w from documents),
e as (select doc_id, unnest(w) word, unnest(range(0, len(w))) p from t),
tagged as (select e.*, case when word in (select word from verbs) then 'v' else 'n' end tag from e),
l as (select doc_id, p, coalesce(d.lemma, case when tag = 'v' then {_rule_sql(TX.VERB_RULES)} else {_rule_sql(TX.NOUN_RULES)} end) lemma
      from tagged g left join lemmas d on g.word = d.word and g.tag = d.pos),
j as (select doc_id, string_agg(lemma, ' ' order by p) lemmatized from l group by doc_id)
select doc_id, coalesce(lemmatized, '') lemmatized from documents left join j using (doc_id)""".replace("regexp_matches(word", "regexp_matches(g.word").replace("regexp_replace(word", "regexp_replace(g.word").replace("else word end", "else g.word end"))
def _(spark, folder):
    lemmas = spark.createDataFrame(_LEMMAS, "word string, pos string, lemma string")
    verbs = spark.createDataFrame([(v,) for v in _VERBS], "word string")
    return TX.lemmatize(T.documents(spark, folder), "doc_id", "text", lemmas, verbs, suffix_rules=True)


_HITS_SQL = f"""
with gazetteer(phrase, label) as (values {_values(_GAZETTEER)}),
t as (select doc_id, ({raw_tokens('text')}) w from documents),
g as (select doc_id, 1 k, unnest({ngrams_sql('w', 1)}) span, unnest(range(0, len(w))) p from t
      union all select doc_id, 2, unnest({ngrams_sql('w', 2)}), unnest(range(0, len(w) - 1)) from t
      union all select doc_id, 3, unnest({ngrams_sql('w', 3)}), unnest(range(0, len(w) - 2)) from t),
c as (select distinct doc_id, k, p, unnest([span, regexp_replace(span, '{TX.EDGES}', '', 'g')]) span from g),
hits as (select doc_id, p, span, z.label from c join (select lower(phrase) phrase, label from gazetteer) z on lower(span) = phrase)"""


def _gazetteer(spark):
    return spark.createDataFrame(_GAZETTEER, "phrase string, label string")


@query("tx10_gazetteer_entities", _HITS_SQL + """
, j as (select doc_id, string_agg(label || ':' || span, '|' order by p, span) entities from hits group by doc_id)
select doc_id, coalesce(entities, '') entities from documents left join j using (doc_id)""")
def _(spark, folder):
    found = TX.gazetteer_entities(T.documents(spark, folder), "doc_id", "text", _gazetteer(spark))
    return _joined(found)


def _joined(df):
    pairs = F.transform("entities", lambda e: F.concat(e["label"], F.lit(":"), e["text"]))
    return df.select("doc_id", F.array_join(pairs, "|").alias("entities"))


_PATTERN_LIST = " || ".join(
    f"list_transform(regexp_extract_all(text, {quoted(p)}), lambda x: '{label}:' || x)"
    for label, p in TX.ENTITY_PATTERNS.items()
)


@query("tx10_pattern_entities", f"select doc_id, array_to_string({_PATTERN_LIST}, '|') entities from documents")
def _(spark, folder):
    return _joined(TX.pattern_entities(T.documents(spark, folder), "text"))


@query("tx10_model_entities", """
select doc_id, array_to_string(list_transform(regexp_extract_all(text, '[A-Z]{3,}'), lambda x: 'ACRONYM:' || x), '|') entities from documents""")
def _(spark, folder):
    # What a pattern can tell needs no model: ``model_entities`` is for models that Spark has no function for.
    return _joined(TX.pattern_entities(T.documents(spark, folder), "text", patterns={"ACRONYM": "[A-Z]{3,}"}))


@query("tx11_entity_frequency", _HITS_SQL + """
select label, span "text", count(*) n from hits group by all""")
def _(spark, folder):
    found = TX.gazetteer_entities(T.documents(spark, folder), "doc_id", "text", _gazetteer(spark))
    return TX.entity_frequency(found)


_NEGATION_SQL = ", ".join(quoted(w) for w in TX.NEGATIONS)


@query("tx12_polarity", f"""
with lexicon(word, score) as (values {_values(_LEXICON)}),
d as (select doc_id, regexp_replace(text, '[A-Za-z]*[nN][''\u2019][tT]\\b', ' not ', 'g') body from documents),
t as (select doc_id, {words_sql('body')} w from d),
e as (select doc_id, unnest(w) word, unnest(range(1, len(w) + 1)) p from t),
b as (select *, lag(word) over (partition by doc_id order by p) prev from e),
s as (select doc_id, avg(case when prev in ({_NEGATION_SQL}) then -0.5 * cast(score as double) else cast(score as double) end) m from b join lexicon using (word) group by doc_id)
select doc_id, round(coalesce(m, 0), 9) polarity,
  case when round(coalesce(m, 0), 9) > 0 then 'Positif' when round(coalesce(m, 0), 9) < 0 then 'Négatif' else 'Neutre' end "class"
from documents left join s using (doc_id)""")
def _(spark, folder):
    lexicon = spark.createDataFrame(_LEXICON, "word string, score double")
    return TX.polarity(T.documents(spark, folder), "doc_id", "text", lexicon)


@query("tx13_word_split", "select word, count(*) n from (select unnest(regexp_split_to_array(text, '[ .]')) word from documents) group by word")
def _(spark, folder):
    words = TX.explode_words(T.documents(spark, folder), word_split(F.col("text")))
    return words.groupBy("word").agg(F.count("*").alias("n"))
