"""SQL fragments shared by the comparison queries (DuckDB dialect)."""

from __future__ import annotations

from ..functions.stopwords import ENGLISH

BLANK_CLASS = r"[ \t\n\x0B\f\r]"
UNICODE_BLANK_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
WORD_CLASS = r"[\p{L}\p{N}_]{2,}"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOPWORD_LIST = "(" + ", ".join(quoted(w) for w in ENGLISH) + ")"


def clean(column: str) -> str:
    return f"coalesce(trim(regexp_replace({column}, '{UNICODE_BLANK_CLASS}', ' ', 'g')), '')"


def tokens(column: str) -> str:
    return raw_tokens(column, f"lower({column})")


def raw_tokens(column: str, value: str = "") -> str:
    body = f"regexp_replace({value or column}, '{BLANK_CLASS}+$', '')"
    return (
        f"case when {column} is null or ({body} = '' and {column} <> '') then cast([] as varchar[]) "
        f"else regexp_split_to_array({body}, '{BLANK_CLASS}') end"
    )


def words(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '{WORD_CLASS}')"


def kept(array: str) -> str:
    return f"list_filter({array}, lambda w: w not in {STOPWORD_LIST})"


def ngrams(array: str, n: int) -> str:
    """n-grams of an array-valued column name."""
    parts = " || ' ' || ".join(f"{array}[i + {j}]" for j in range(n))
    return f"list_transform(range(1, len({array}) - {n - 2}), lambda i: {parts})"
