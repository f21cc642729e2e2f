"""Text operators over a table of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions import text as X
from ..functions.stopwords import ENGLISH
from ..session import cut_lineage
from .joins import lookup_join
from .words import TABLE_WORDS, WORKER_STEMS, broadcast_words, replace_words, stem_words


def explode_words(
    df: DataFrame, words: Column, keep: Sequence[str] = (), out: str = "word"
) -> DataFrame:
    """One row per element of a computed array.

    The array is made in a projection of its own and exploded as outer: a plain
    explode would add a size test that computes the array a second time.
    """
    made = df.select(*keep, words.alias("_words"))
    return made.select(*keep, F.explode_outer("_words").alias(out)).where(F.col(out).isNotNull())


def with_tokens(df: DataFrame, text: str, out: str = "tokens") -> DataFrame:
    return df.withColumn(out, X.tokens(F.col(text)))


def with_filtered(
    df: DataFrame, tokens: str = "tokens", out: str = "filtered", stopwords: Sequence[str] = ENGLISH
) -> DataFrame:
    return df.withColumn(out, X.remove_stopwords(F.col(tokens), stopwords))


def distinct_words(df: DataFrame, words: Column) -> DataFrame:
    """Table (word) of all different words; tasks send each of theirs once."""
    made = df.select(F.array_distinct(words).alias("_words"))
    return explode_words(made, F.col("_words")).distinct()


def with_stems(
    df: DataFrame, tokens: str = "filtered", out: str = "stems", joined: bool = False, most: int = WORKER_STEMS
) -> DataFrame:
    """Stems of a token array, as an array or joined by a space.

    Texts are read once and no token is shuffled: rows are stemmed batch by batch, each different word of a batch once, and
    workers remember up to ``most`` stems between batches.
    """
    return df.withColumn(out, stem_words(F.transform(X.no_null_array(F.col(tokens)), F.lower), joined, most))


def with_ngrams(df: DataFrame, tokens: str, n: int, out: str = "ngrams", drop_blank: bool = False) -> DataFrame:
    return df.withColumn(out, X.ngrams(F.col(tokens), n, drop_blank))


def explode_ngrams(df: DataFrame, tokens: str, n: int, keep: Sequence[str] = (), out: str = "ngram") -> DataFrame:
    """One row per n-gram, made by zipping the token array with its own shifts."""
    if n == 1:
        return explode_words(df, F.col(tokens), keep, out)
    shifted = [
        F.col(tokens) if i == 0 else F.slice(F.col(tokens), F.lit(i + 1), F.size(tokens))
        for i in range(n)
    ]
    zipped = F.arrays_zip(*[s.alias(f"_t{i}") for i, s in enumerate(shifted)])
    rows = df.select(*keep, F.inline(zipped))
    grams = rows.where(F.col(f"_t{n - 1}").isNotNull())
    return grams.select(*keep, F.concat_ws(" ", *[f"_t{i}" for i in range(n)]).alias(out))


def ngram_counts(
    df: DataFrame, tokens: str, n: int, by: Sequence[str] = (), out: str = "ngram"
) -> DataFrame:
    grams = explode_ngrams(df, tokens, n, by, out)
    return grams.groupBy(*by, out).agg(F.count("*").alias("n"))


GRAM_BUCKETS = 1 << 16  # numbers that come to the driver before n-grams are counted by themselves
FEW_GRAMS = 100  # of which the most frequent are found by their buckets


def top_ngrams(df: DataFrame, tokens: str, n: int, k: int = 50, out: str = "ngram") -> DataFrame:
    """The k most frequent n-grams, ties by spelling.

    For few of them all n-grams are first counted by GRAM_BUCKETS hash buckets, which is a bound for each n-gram in a bucket.
    Those of the fullest buckets are then counted by themselves; the k-th of these counts is at most the k-th of all, so
    buckets below it hold none of the k. Buckets that reach it are counted, too. So n-grams that occur a few
    times are neither gathered nor shuffled. Reads ``df`` up to three times.
    """
    best = [F.desc("n"), F.col(out)]
    if k > FEW_GRAMS or df.isStreaming:
        return ngram_counts(df, tokens, n, (), out).orderBy(*best).limit(k)
    grams = explode_ngrams(df, tokens, n, (), out)
    bucket = F.xxhash64(out).bitwiseAND(F.lit(GRAM_BUCKETS - 1))
    sizes = {r["bucket"]: r["n"] for r in grams.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).collect()}

    def counted(buckets: list[int]) -> DataFrame:
        return grams.where(bucket.isin(buckets)).groupBy(out).agg(F.count("*").alias("n")).orderBy(*best).limit(k)

    full = sorted(sizes, key=sizes.get, reverse=True)
    first = cut_lineage(counted(full[:4 * k]))
    found = first.agg(F.count("*"), F.min("n")).first()
    least = found[1] if found[0] == k else 1
    others = [b for b in full[4 * k:] if sizes[b] >= least]
    if not others:
        return first.orderBy(*best)
    return first.unionByName(counted(others)).orderBy(*best).limit(k)


def ngram_cloud(counts: DataFrame, ngram: str = "ngram", count: str = "n", divisor: int = 100) -> DataFrame:
    """Cloud weight of counted n-grams: joined by '_', cut to whole hundreds, markup and blank edges out."""
    joined = counts.withColumn(ngram, X.underscore_ngram(F.col(ngram)))
    kept = joined.where(X.ngram_kept(F.col(ngram)))
    return kept.withColumn("weight", F.floor(F.round(count) / divisor).cast("bigint"))


def word_frequency(
    df: DataFrame, text: str, by: Sequence[str] = (), stopwords: Sequence[str] = ENGLISH
) -> DataFrame:
    """Words of the cloud: two characters or more, no stop words, counted overall or per class."""
    words = explode_words(df, X.word_tokens(F.col(text)), by)
    kept = words.where(~F.col("word").isin([w.lower() for w in stopwords]))
    return kept.groupBy(*by, "word").agg(F.count("*").alias("n"))


# Noun and verb endings with their base form, tried in this order.
NOUN_RULES = [
    ("sses$", "ss"), ("ches$", "ch"), ("shes$", "sh"), ("xes$", "x"), ("zes$", "z"),
    ("ves$", "f"), ("men$", "man"), ("ies$", "y"), ("([^su])s$", "$1"),
]
VERB_RULES = [("ies$", "y"), ("ied$", "y"), ("([^aeiou])ing$", "$1"), ("ing$", "e"), ("ed$", "e"), ("([^su])s$", "$1")]


def _by_rules(word: Column, rules: list[tuple[str, str]]) -> Column:
    out = None
    for pattern, new in rules:
        fits, changed = word.rlike(pattern), F.regexp_replace(word, pattern, new)
        out = F.when(fits, changed) if out is None else out.when(fits, changed)
    return out.otherwise(word)


def lemmatize(
    df: DataFrame, key: str, text: str, lemmas: DataFrame, verbs: DataFrame | None = None,
    suffix_rules: bool = False, out: str = "lemmatized", most: int = TABLE_WORDS,
) -> DataFrame:
    """Lemmas of a text's words, joined by a space; (key, out) per row, '' for no words.

    ``lemmas`` (word, pos, lemma) is the user's dictionary, ``verbs`` (word) says
    which words count as verbs (pos 'v'); all others are nouns ('n'). Words the
    dictionary lacks stay, or go through suffix rules. Each different word gets its lemma once and rows look theirs
    up; beyond ``most`` different words the words are joined by shuffle, hot ones salted, and ``key`` must be unique.
    """
    words = X.blank_split(X.lower_text(F.col(text)))
    per_word = lemmas.groupBy("word").agg(
        F.min(F.when(F.col("pos") == "v", F.col("lemma"))).alias("_as_verb"),
        F.min(F.when(F.col("pos") == "n", F.col("lemma"))).alias("_as_noun"),
    )
    if verbs is not None:
        marked = verbs.select("word").distinct().withColumn("_verb", F.lit(True))
        per_word = per_word.join(marked, "word", "full")
    else:
        per_word = per_word.withColumn("_verb", F.lit(False))
    is_verb = F.coalesce("_verb", F.lit(False))
    word = F.col("word")
    fallback = word
    if suffix_rules:
        fallback = F.when(is_verb, _by_rules(word, VERB_RULES)).otherwise(_by_rules(word, NOUN_RULES))
    lemma = F.coalesce(F.when(is_verb, F.col("_as_verb")).otherwise(F.col("_as_noun")), fallback)
    each = lookup_join(distinct_words(df, words), per_word, ["word"]).select("word", lemma.alias("lemma"))
    table = broadcast_words(each.where("word <> lemma"), "word", ["lemma"], most)
    if table is not None:
        return df.select(key, F.array_join(replace_words(words, table), " ").alias(out))
    placed = df.select(key, words.alias("_w")).repartition(F.col(key))
    rows = placed.select(key, F.posexplode_outer("_w").alias("pos", "word"))
    joined = lookup_join(rows, per_word, ["word"], salt_by=[key, "pos"])
    entries = F.collect_list(F.when(word.isNotNull(), F.struct("pos", lemma.alias("lemma"))))
    grouped = joined.groupBy(key).agg(F.sort_array(entries).alias("_words"))
    return grouped.select(key, F.array_join(F.col("_words.lemma"), " ").alias(out))


# Entity patterns in a dialect that Java and RE2 read alike.
ENTITY_PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "URL": r"https?://[A-Za-z0-9./?=&%_#~:-]+",
    "MONEY": r"[$€£][0-9][0-9,]*(?:\.[0-9]+)?",
    "DATE": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "CAPS": r"[A-Z][a-z]+(?: [A-Z][a-z]+)+",
}


def pattern_entities(
    df: DataFrame, text: str, out: str = "entities", patterns: dict[str, str] = ENTITY_PATTERNS
) -> DataFrame:
    """Entities by pattern as array of (text, label): by label, then in text order."""
    def found(label: str, pattern: str) -> Column:
        hits = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(pattern), F.lit(0))
        return F.transform(hits, lambda t: F.struct(t.alias("text"), F.lit(label).alias("label")))

    return df.withColumn(out, F.concat(*[found(*item) for item in patterns.items()]))


EDGES = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"  # punctuation around a phrase
_SIGN = rf"[^\p{{L}}\p{{N}}{X.BLANKS}]"
WORD_EDGES = rf"(?<![^{X.BLANKS}]){_SIGN}++|(?<!{_SIGN}){_SIGN}++(?![^{X.BLANKS}])"  # and around every word


FIRST_WORDS = 20_000  # phrases, and different first words of them, that are tested inside the row


def gazetteer_entities(
    df: DataFrame, key: str, text: str, gazetteer: DataFrame, max_words: int | None = None, out: str = "entities"
) -> DataFrame:
    """Entities by dictionary (phrase, label), ignoring case; phrases have any number of words, or ``max_words`` at most.

    A run of words is looked up as it stands and without the punctuation around it, and the entity keeps the text's spelling.
    One (key, out) row per text, in text order; a text without a hit has [].

    Punctuation is taken off all words of a text at once. Only a word that begins some phrase, or that is nothing but
    punctuation, opens a run, and only runs that are phrases leave their row. With more than FIRST_WORDS
    different first words every word opens a run, with as many phrases every run is looked up by a join.
    """
    table = gazetteer.where("phrase <> ''").select(F.lower("phrase").alias("phrase"), "label").groupBy("phrase").agg(
        F.min("label").alias("label")
    )
    parts = F.split("phrase", f"[{X.BLANKS}]")
    if max_words is None:
        max_words = table.agg(F.max(F.size(parts))).first()[0] or 1
    first = F.regexp_replace(F.get(parts, F.lit(0)), EDGES, "")
    firsts = [r[0] for r in table.select(first).distinct().limit(FIRST_WORDS + 1).collect()]
    phrases = [r[0] for r in table.select("phrase").limit(FIRST_WORDS + 1).collect()]
    # The same words, in lower case and without the punctuation at their edges, in one pass over the text.
    bare = X.raw_tokens(F.col(text), lambda body: F.regexp_replace(F.lower(body), WORD_EDGES, ""))

    def opened(words: Column) -> Column:
        places = F.transform(bare, lambda w, i: F.when(w.isin([*firsts, ""]), i) if len(firsts) <= FIRST_WORDS else i)
        # A slice would copy the whole text's words for every run.
        return F.transform(F.array_compact(places), lambda i: F.struct(i.alias("pos"), F.array_compact(
            F.transform(F.sequence(F.lit(0), F.lit(max_words - 1)), lambda n: F.get(words, (i + n).cast("int")))).alias("w")))

    def spans(run: Column) -> Column:
        lengths = F.filter(F.sequence(F.lit(1), F.lit(max_words)), lambda n: n <= F.size(run["w"]))
        return F.flatten(F.transform(lengths, lambda n: H.let(
            F.array_join(F.slice(run["w"], F.lit(1), n), " "),
            lambda whole: F.transform(
                F.array_distinct(F.array(whole, F.regexp_replace(whole, EDGES, ""))),
                lambda s: F.struct(run["pos"].alias("pos"), s.alias("span"), F.lower(s).alias("phrase"))))))

    # A text is split once: inside a function over an array, a bare expression would be computed for every element.
    made = F.flatten(H.let(X.raw_tokens(F.col(text)), lambda words: F.transform(opened(words), spans)))
    if len(phrases) <= FIRST_WORDS:
        made = F.filter(made, lambda s: s["phrase"].isin(phrases))
    grams = df.select(key, made.alias("_spans")).select(key, F.explode_outer("_spans").alias("_s")).select(key, "_s.*")
    hits = lookup_join(grams, table, ["phrase"], salt_by=[key, "pos"])
    entry = F.when(
        F.col("label").isNotNull(), F.struct("pos", F.col("span").alias("text"), "label")
    )
    grouped = hits.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_hits"))
    return grouped.select(
        key, F.transform("_hits", lambda h: F.struct(h["text"], h["label"])).alias(out)
    )


def model_entities(
    df: DataFrame, text: str, load: Callable[[], Callable[[str], list[tuple[str, str]]]],
    out: str = "entities",
) -> DataFrame:
    """Entities from a user's own model, loaded once per Python worker."""
    schema = T.StructType(df.schema.fields + [
        T.StructField(out, T.ArrayType(T.StructType([
            T.StructField("text", T.StringType()), T.StructField("label", T.StringType()),
        ])))
    ])

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = load()
        for batch in batches:
            found = [
                None if t is None else [{"text": e, "label": k} for e, k in find(t)]
                for t in batch[text]
            ]
            yield batch.assign(**{out: pd.Series(found, index=batch.index, dtype=object)})

    return df.mapInPandas(tag, schema)


def entity_frequency(df: DataFrame, entities: str = "entities") -> DataFrame:
    rows = df.select(F.inline(entities))
    return rows.groupBy("label", "text").agg(F.count("*").alias("n"))


# Words that turn the next word's score, and the factor they apply.
NEGATIONS = ("not", "no", "never", "cannot", "n't", "don't", "isn't", "wasn't", "doesn't", "didn't")
CONTRACTIONS = "[A-Za-z]*[nN]['\u2019][tT]\\b"
NEGATION_FACTOR = -0.5


def polarity(
    df: DataFrame, key: str, text: str, lexicon: DataFrame, negations: Sequence[str] = NEGATIONS
) -> DataFrame:
    """Mean lexicon score of a text's words and its class; no scored word gives 0 and 'Neutre'.

    The word before each word is paired with it in place, so negation needs no
    window. ``lexicon`` has (word, score); ``key`` must be unique.
    """
    # The tokenizer parts words at apostrophes, so contractions of "not" are written out before.
    plain = F.regexp_replace(F.col(text), CONTRACTIONS, " not ")
    words = df.select(key, X.word_tokens(plain).alias("_words"))
    paired = F.arrays_zip(
        F.col("_words").alias("word"), F.concat(F.array(F.lit("")), "_words").alias("before")
    )
    rows = words.select(key, F.inline_outer(paired))
    scores = lexicon.groupBy("word").agg(F.max("score").alias("score"))
    joined = lookup_join(rows, scores, ["word"], salt_by=[key, "before"])
    score = F.when(F.col("before").isin(list(negations)), F.col("score") * NEGATION_FACTOR).otherwise(
        F.col("score")
    )
    # Rounding takes out the noise of the order of summation, which could flip a sign.
    mean = F.round(F.coalesce(F.avg(score), F.lit(0.0)), 9)
    means = joined.groupBy(key).agg(mean.alias("polarity"))
    return means.withColumn(
        "class",
        F.when(F.col("polarity") > 0, "Positif").when(F.col("polarity") < 0, "Négatif").otherwise("Neutre"),
    )
