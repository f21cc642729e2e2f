"""Text expressions: cleaning, tokens, stop words, n-grams. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stopwords import ENGLISH

# Blanks of the ML tokenizer, and all characters Unicode calls white space.
BLANKS = " \t\n\x0b\f\r"
UNICODE_BLANKS = (
    r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
)
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def empty_tokens() -> Column:
    return F.array().cast("array<string>")


def no_null_array(tokens: Column) -> Column:
    return F.coalesce(tokens, empty_tokens())


def clean_text(text: Column) -> Column:
    """Blank runs to one space, no blanks at the ends, NULL to ''."""
    return F.coalesce(F.trim(F.regexp_replace(text, UNICODE_BLANKS, " ")), F.lit(""))


def lower_text(text: Column) -> Column:
    return F.coalesce(F.lower(text), F.lit(""))


def tokens(text: Column) -> Column:
    """Lower-case and split on every single blank, as ``ml.feature.Tokenizer`` does.

    Leading and inner empty tokens stay, trailing ones go, '' gives [''], an
    all-blank text gives []. NULL gives [] instead of an error.
    """
    return raw_tokens(F.lower(text))


def raw_tokens(text: Column, change: Callable[[Column], Column] = lambda body: body) -> Column:
    """As ``tokens``, in the text's own case; ``change`` may alter anything but blanks before the split."""
    body = F.rtrim(text, F.lit(BLANKS))
    return (
        F.when(text.isNull() | ((body == "") & (text != "")), empty_tokens())
        .otherwise(F.split(change(body), f"[{BLANKS}]"))
    )


def word_tokens(text: Column) -> Column:
    """Lower-case runs of at least two word characters, accents and digits included."""
    return no_null_array(F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0)))


def blank_split(text: Column) -> Column:
    """Tokens between white space, without empty ones."""
    return F.filter(F.split(clean_text(text), " "), lambda w: w != "")


def word_split(text: Column) -> Column:
    """Split on every space and on every full stop."""
    return F.split(text, "[ .]")


def remove_stopwords(words: Column, stopwords: Sequence[str] = ENGLISH) -> Column:
    """Drop stop words, ignoring case; the rest keeps its order and spelling."""
    known = [w.lower() for w in stopwords]
    return F.filter(words, lambda w: ~F.lower(w).isin(known))


def ngrams(words: Column, n: int, drop_blank: bool = False) -> Column:
    """Neighbouring tokens joined by a space; fewer than n tokens give []."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    grams = F.when(F.size(words) >= n, grams).otherwise(empty_tokens())
    if drop_blank:
        grams = F.filter(grams, lambda g: ~g.rlike(r"^ | $|  |^$"))
    return grams


def underscore_ngram(gram: Column) -> Column:
    return F.replace(gram, F.lit(" "), F.lit("_"))


def ngram_kept(gram: Column) -> Column:
    """Keep n-grams without the markup rest '/><br' and without a blank edge token."""
    return (
        ~F.contains(gram, F.lit("/><br"))
        & ~F.startswith(gram, F.lit("_"))
        & ~F.endswith(gram, F.lit("_"))
    )


def markup_kept(text: Column) -> Column:
    """The three joined LIKE tests of the n-gram report amount to this one."""
    return ~F.contains(text, F.lit("/><br"))
