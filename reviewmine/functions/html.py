"""Field extraction from stored HTML.

Elements are cut by balancing their own tag, so nested elements of the same
kind do not end a field early. Blocks are cut in one scan of a page that notes where every
element begins and ends (Arrow columns, linear in the page); fields within a block are SQL functions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text

# Named character references that are decoded; '&amp;' comes last.
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ",
    "&copy;": "©", "&reg;": "®", "&trade;": "™", "&deg;": "°",
    "&euro;": "€", "&pound;": "£", "&yen;": "¥", "&cent;": "¢",
    "&sect;": "§", "&para;": "¶", "&middot;": "·", "&bull;": "•",
    "&hellip;": "…", "&ndash;": "–", "&mdash;": "—",
    "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”",
    "&laquo;": "«", "&raquo;": "»", "&times;": "×", "&frac12;": "½",
    "&agrave;": "à", "&aacute;": "á", "&acirc;": "â", "&auml;": "ä",
    "&ccedil;": "ç", "&egrave;": "è", "&eacute;": "é", "&ecirc;": "ê",
    "&euml;": "ë", "&iacute;": "í", "&icirc;": "î", "&iuml;": "ï",
    "&ntilde;": "ñ", "&oacute;": "ó", "&ocirc;": "ô", "&ouml;": "ö",
    "&szlig;": "ß", "&uacute;": "ú", "&ucirc;": "û", "&uuml;": "ü",
}


def attr_marker(name: str, value: str) -> str:
    """Pattern for an attribute with exactly this value."""
    return rf"\b{name}\s*=\s*[\"']{value}[\"']"


def class_marker(name: str) -> str:
    """Pattern for a class list that holds this class."""
    return rf"\bclass\s*=\s*[\"'](?:[^\"']*\s)?{name}(?:\s[^\"']*)?[\"']"


def _opening(tag: str, marker: str) -> str:
    return rf"<{tag}\b(?=[^>]*{marker})[^>]*>" if marker else rf"<{tag}\b[^>]*>"


def _numeric_reference(piece: Column) -> Column:
    """'#' was cut off: '233;t' -> 'ét'; anything that is no code point stays."""
    pattern = r"(?s)^(?:[xX]([0-9a-fA-F]{1,6})|([0-9]{1,7}));(.*)$"
    hexa = F.regexp_extract(piece, pattern, 1)
    number = F.when(hexa != "", F.conv(hexa, 16, 10)).otherwise(F.regexp_extract(piece, pattern, 2))
    code = number.try_cast("int")
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(
        valid, F.concat(char, F.regexp_extract(piece, pattern, 3))
    ).otherwise(F.concat(F.lit("&#"), piece))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def decode_entities(text: Column) -> Column:
    named = text
    for name, char in ENTITIES.items():
        named = F.replace(named, F.lit(name), F.lit(char))

    def join_pieces(pieces: Column) -> Column:
        rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _numeric_reference)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))

    numeric = let(F.split(named, "&#"), join_pieces)
    return F.replace(numeric, F.lit("&amp;"), F.lit("&"))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<!--.*?-->|<[^>]*>", "")


def visible_text(html: Column) -> Column:
    """Tags out, references decoded, blanks collapsed; NULL stays NULL."""
    return let(
        strip_tags(html),
        lambda t: F.when(
            t.isNotNull(),
            clean_text(F.when(F.contains(t, F.lit("&")), decode_entities(t)).otherwise(t)),
        ),
    )


def has_element(html: Column, tag: str, marker: str = "") -> Column:
    return F.coalesce(html.rlike(_opening(tag, marker)), F.lit(False))


def _balanced(rest: Column, tag: str) -> Column:
    """Text after an opening tag, up to the closing tag that matches it."""
    pieces = F.split(rest, rf"(?=<{tag}\b)|(?=</{tag}\b)")

    def step(acc, piece):
        depth = (
            acc["depth"]
            + F.when(piece.rlike(rf"^<{tag}\b"), 1).when(piece.rlike(rf"^</{tag}\b"), -1).otherwise(0)
        )
        return F.when(acc["depth"] == 0, acc).otherwise(
            F.struct(
                depth.alias("depth"),
                (acc["kept"] + F.when(depth == 0, 0).otherwise(1)).alias("kept"),
            )
        )

    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("kept"))
    return let(
        pieces,
        lambda ps: F.array_join(F.slice(ps, F.lit(1), F.aggregate(ps, start, step)["kept"]), ""),
    )


def inner_html(html: Column, tag: str, marker: str = "") -> Column:
    """Content of the first such element, NULL where there is none.

    Most elements hold none of their own kind and end at the next closing tag;
    only the others are balanced.
    """
    opening = _opening(tag, marker)

    def content(h: Column) -> Column:
        nearest = F.regexp_extract(h, rf"(?s){opening}(.*?)(?:</{tag}\b|\z)", 1)
        whole = _balanced(F.regexp_extract(h, rf"(?s){opening}(.*)\z", 1), tag)
        found = let(nearest, lambda n: F.when(n.rlike(rf"<{tag}\b"), whole).otherwise(n))
        return F.when(has_element(h, tag, marker), found)

    return let(html, content)


def elements(html: Column, tag: str, marker: str = "") -> Column:
    """All such elements, each with its opening tag and balanced content."""
    pieces = F.split(html, rf"(?={_opening(tag, marker)})")
    found = F.filter(pieces, lambda p: p.rlike(rf"^{_opening(tag, marker)}"))
    return F.transform(
        F.coalesce(found, F.array().cast("array<string>")),
        lambda p: F.concat(
            F.regexp_extract(p, rf"^({_opening(tag, marker)})", 1),
            _balanced(F.regexp_extract(p, rf"(?s)^{_opening(tag, marker)}(.*)\z", 1), tag),
        ),
    )


def _ranges(page: str, tag: str, marker: str) -> Iterator[tuple[int, int]]:
    """(start, end) of every such element in page order; one that is never closed ends before the next one."""
    opening = re.compile(_opening(tag, marker))
    starts, ends, open_ = [], {}, []
    for m in re.finditer(rf"<(/?){tag}\b[^>]*>?", page):
        if m[1]:
            if open_:
                ends[open_.pop()] = m.end()
        else:
            open_.append(m.start())
            if opening.match(page, m.start()):
                starts.append(m.start())
    for i, start in enumerate(starts):
        yield start, ends.get(start) or (starts[i + 1] if i + 1 < len(starts) else len(page))


def _in_bytes(page: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same ranges counted in bytes of UTF-8, in one pass over the page."""
    if page.isascii():
        return ranges
    offsets, last, size = {}, 0, 0
    for at in sorted({x for r in ranges for x in r}):
        size += len(page[last:at].encode())
        offsets[at], last = size, at
    return [(offsets[a], offsets[b]) for a, b in ranges]


def blocks(html: Column, *path: tuple[str, str]) -> Column:
    """All elements (tag, marker) with their tags and all they hold, nested ones as well; of a longer path, those inside the ones before.

    An element that several outer ones hold is given once for the innermost scan of each outermost element. NULL has none.
    Python gives byte ranges only and the JVM cuts them, so a worker never holds the blocks of a batch of pages.
    """

    def cut(page: str, steps: tuple[tuple[str, str], ...], base: int = 0) -> list[tuple[int, int]]:
        found, done = [], 0
        for a, b in _ranges(page, *steps[0]):
            if len(steps) == 1:
                found.append((base + a, base + b))
            elif a >= done:
                found += cut(page[a:b], steps[1:], base + a)
                done = b
        return found

    kind = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))

    @F.arrow_udf("array<struct<start:int,size:int>>")
    def run(pages: pa.Array) -> pa.Array:
        out = [pa.array([], type=kind)]
        for at in range(0, len(pages), 256):
            ranges = [_in_bytes(p or "", cut(p or "", path)) for p in pages.slice(at, 256).to_pylist()]
            out.append(pa.array([[{"start": a, "size": b - a} for a, b in r] for r in ranges], type=kind))
        return pa.concat_arrays(out)

    def pieces(page: Column) -> Column:
        piece = lambda r: F.substring(page["bytes"], r["start"] + 1, r["size"]).cast("string")
        return F.transform(page["ranges"], piece)

    return let(F.struct(run(html).alias("ranges"), html.cast("binary").alias("bytes")), pieces)


# Elements that do not break a line of text.
INLINE = ("a", "abbr", "b", "bdi", "cite", "code", "em", "font", "i", "kbd", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "u", "var")
UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>|<head\b.*?</head\s*>"
INLINE_TAGS = rf"(?i)</?(?:{'|'.join(INLINE)})(?:\s[^>]*)?>"


def page_text(html: Column) -> Column:
    """Visible text of a whole page: no head, scripts, styles and comments; block elements part words, inline ones do not. NULL gives ''."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, UNSEEN, " "), INLINE_TAGS, ""), "<[^>]*>", " ")
    return let(bare, lambda t: clean_text(F.when(F.contains(t, F.lit("&")), decode_entities(t)).otherwise(t)))


def element_text(html: Column, tag: str, marker: str = "", default: str | None = None) -> Column:
    text = visible_text(inner_html(html, tag, marker))
    return text if default is None else F.coalesce(text, F.lit(default))


def attribute(html: Column, tag: str, name: str, marker: str = "") -> Column:
    """Attribute of the first such element, NULL where it is missing."""
    pattern = rf"\s{name}\s*=\s*[\"']([^\"']*)[\"']"
    return let(
        F.regexp_extract(html, f"({_opening(tag, marker)})", 1),
        lambda opening: F.when(opening.rlike(pattern), F.regexp_extract(opening, pattern, 1)),
    )
