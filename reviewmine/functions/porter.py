"""Porter stemming as column expressions.

Each step is one ``transform`` over the token array, so a whole review table is
stemmed in the map stage: no shuffle, no Python worker, nothing to broadcast.
``stem`` is the same for one lower-case word, for tasks that stem each different word once.
The rules are M. F. Porter's (1980) with the usual later departures: short words
stay, a few irregular forms, 'ies'/'ied' in four-letter words, 'y' only after a
consonant, 'fulli' and 'logi'.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffix tables of the algorithm, in the order they are tried.
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def shape(word: Column) -> Column:
    """Consonants to 'c', vowels to 'v'; 'y' is a vowel after a consonant only."""
    s = F.regexp_replace(word, "[^aeiouy]", "c")
    s = F.translate(s, "aeiou", "vvvvv")
    s = F.regexp_replace(s, "(^|v)y", "$1c")
    s = F.replace(s, F.lit("yy"), F.lit("vc"))
    return F.replace(s, F.lit("y"), F.lit("v"))


def _positive(stem: Column) -> Column:
    return F.contains(shape(stem), F.lit("vc"))


def _above_one(stem: Column) -> Column:
    return shape(stem).rlike("vc.*vc")


def _exactly_one(stem: Column) -> Column:
    return _positive(stem) & ~_above_one(stem)


def _has_vowel(stem: Column) -> Column:
    return F.contains(shape(stem), F.lit("v"))


def _cvc(stem: Column) -> Column:
    form = shape(stem)
    return (F.endswith(form, F.lit("cvc")) & ~stem.rlike("[wxy]$")) | (form == "vc")


def _cut(word: Column, n: int) -> Column:
    return F.left(word, F.length(word) - n)


def _rules(word: Column, rules: list) -> Column:
    """The first fitting suffix decides; its condition then tells change or keep."""
    out = None
    for suffix, new, condition in rules:
        stem = _cut(word, len(suffix))
        changed = F.concat(stem, F.lit(new)) if new else stem
        if condition is not None:
            changed = F.when(condition(stem), changed).otherwise(word)
        fits = F.endswith(word, F.lit(suffix))
        out = F.when(fits, changed) if out is None else out.when(fits, changed)
    return out.otherwise(word)


def _plurals(w: Column) -> Column:
    four = F.length(w) == 4
    return F.when(
        F.endswith(w, F.lit("s")),
        F.when(F.endswith(w, F.lit("ies")), F.when(four, _cut(w, 1)).otherwise(_cut(w, 2)))
        .when(F.endswith(w, F.lit("sses")), _cut(w, 2))
        .when(F.endswith(w, F.lit("ss")), w)
        .otherwise(_cut(w, 1)),
    ).otherwise(w)


def _past_forms(w: Column) -> Column:
    """Word after removing 'ed' or 'ing', with a flag telling that it was removed."""
    def state(word, removed):
        return F.struct(word.alias("w"), F.lit(removed).alias("cut"))

    return (
        F.when(
            F.endswith(w, F.lit("ied")),
            F.when(F.length(w) == 4, state(_cut(w, 1), False)).otherwise(state(_cut(w, 2), False)),
        )
        .when(
            F.endswith(w, F.lit("eed")),
            F.when(_positive(_cut(w, 3)), state(_cut(w, 1), False)).otherwise(state(w, False)),
        )
        .when(F.endswith(w, F.lit("ed")) & _has_vowel(_cut(w, 2)), state(_cut(w, 2), True))
        .when(F.endswith(w, F.lit("ing")) & _has_vowel(_cut(w, 3)), state(_cut(w, 3), True))
        .otherwise(state(w, False))
    )


def _repair(s: Column) -> Column:
    """Restore the ending of a stem that lost 'ed' or 'ing'."""
    w = s["w"]
    last = F.right(w, F.lit(1))
    doubled = (last == F.substring(w, -2, 1)) & (F.length(w) >= 2) & F.endswith(shape(w), F.lit("c"))
    with_e = F.concat(w, F.lit("e"))
    return (
        F.when(~s["cut"], w)
        .when(w.rlike("(at|bl|iz)$"), with_e)
        .when(doubled, F.when(last.isin("l", "s", "z"), w).otherwise(_cut(w, 1)))
        .when(_exactly_one(w) & _cvc(w), with_e)
        .otherwise(w)
    )


def _past_and_repair(w: Column) -> Column:
    """Both halves of step 1b: a one-element array carries the state between them."""
    return F.get(F.transform(F.array(_past_forms(w)), _repair), F.lit(0))


def _final_y(w: Column) -> Column:
    stem = _cut(w, 1)
    return F.when(
        F.endswith(w, F.lit("y")) & (F.length(w) > 2) & F.endswith(shape(stem), F.lit("c")),
        F.concat(stem, F.lit("i")),
    ).otherwise(w)


def _step2(w: Column) -> Column:
    rules = [(old, new, _positive) for old, new in STEP2]
    # 'logi' keeps its 'l' with the stem when the stem is measured.
    rules.append(("logi", "log", lambda stem: _positive(F.concat(stem, F.lit("l")))))
    return F.when(w.rlike("[ilmnrs]$"), _rules(w, rules)).otherwise(w)


def _alli(w: Column) -> Column:
    """'alli' is shortened before step 2 looks at the word."""
    return F.when(
        F.endswith(w, F.lit("alli")) & _positive(_cut(w, 4)), _cut(w, 2)
    ).otherwise(w)


def _step3(w: Column) -> Column:
    return F.when(
        w.rlike("[eils]$"), _rules(w, [(old, new, _positive) for old, new in STEP3])
    ).otherwise(w)


def _step4(w: Column) -> Column:
    def condition(suffix):
        if suffix == "ion":
            return lambda stem: _above_one(stem) & stem.rlike("[st]$")
        return _above_one

    return F.when(
        w.rlike("[celmnrstiu]$"), _rules(w, [(s, "", condition(s)) for s in STEP4])
    ).otherwise(w)


def _step5(w: Column) -> Column:
    stem = _cut(w, 1)
    return F.when(
        F.endswith(w, F.lit("e")) & (_above_one(stem) | (_exactly_one(stem) & ~_cvc(stem))), stem
    ).otherwise(w)


def _double_l(w: Column) -> Column:
    return F.when(F.endswith(w, F.lit("ll")) & _above_one(_cut(w, 1)), _cut(w, 1)).otherwise(w)


def stem_tokens(words: Column) -> Column:
    """Stem every token of an array, keeping the order."""
    lowered = F.transform(words, F.lower)
    stems = lowered
    for step in (
        _plurals, _past_and_repair, _final_y, _alli, _step2, _step3, _step4, _step5, _double_l
    ):
        stems = F.transform(stems, step)
    irregular = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    return F.zip_with(
        lowered,
        stems,
        lambda word, stem: F.when(F.length(word) <= 2, word)
        .when(word.isin(list(IRREGULAR)), irregular[word])
        .otherwise(stem),
    )


def stem_text(words: Column) -> Column:
    """Stems joined by a space."""
    return F.array_join(stem_tokens(words), " ")


# ---- one word ----------------------------------------------------------------------------


_OTHERS = re.compile("[^aeiouy]")
_Y_FIRST = re.compile("(^|v)y")
_VOWELS = str.maketrans("aeiou", "vvvvv")
_RULES2 = [*STEP2, ("logi", "log")]
_RULES4 = [(s, "") for s in STEP4]
_LINE_END = re.compile("(?:\r\n|[\n\r\x85\u2028\u2029])\\Z")  # '$' of the column form stands before it, too


def _form(word: str) -> str:
    s = _Y_FIRST.sub(r"\1c", _OTHERS.sub("c", word).translate(_VOWELS))
    return s.replace("yy", "vc").replace("y", "v")


def _many(stem: str) -> bool:
    return _form(stem).count("vc") > 1


def _ends(word: str, ends: tuple[str, ...]) -> bool:
    return word.endswith(ends) or _LINE_END.sub("", word).endswith(ends)


def _short(stem: str) -> bool:
    form = _form(stem)
    return (form.endswith("cvc") and not _ends(stem, ("w", "x", "y"))) or form == "vc"


def _changed(word: str, rules: list[tuple[str, str]], condition: Callable[[str, str], bool]) -> str:
    for suffix, new in rules:  # the first fitting suffix decides
        if word.endswith(suffix):
            kept = word[:-len(suffix)]
            return kept + new if condition(suffix, kept) else word
    return word


def _without_past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if "vc" in _form(w[:-3]) else w
    if w.endswith("ed") and "v" in _form(w[:-2]):
        w = w[:-2]
    elif w.endswith("ing") and "v" in _form(w[:-3]):
        w = w[:-3]
    else:
        return w
    if _ends(w, ("at", "bl", "iz")):
        return w + "e"
    form = _form(w)
    if len(w) > 1 and w[-1] == w[-2] and form.endswith("c"):
        return w if w[-1] in "lsz" else w[:-1]
    return w + "e" if form.count("vc") == 1 and _short(w) else w


def stem(word: str) -> str:
    """Stem of one word in lower case, as ``stem_tokens`` gives it."""
    if len(word) <= 2:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    w = word
    if w.endswith("s"):
        w = (w[:-1] if len(w) == 4 else w[:-2]) if w.endswith("ies") else w[:-2] if w.endswith("sses") else w if w.endswith("ss") else w[:-1]
    w = _without_past(w)
    if w.endswith("y") and len(w) > 2 and _form(w[:-1]).endswith("c"):
        w = w[:-1] + "i"
    if w.endswith("alli") and "vc" in _form(w[:-4]):
        w = w[:-2]
    w = _changed(w, _RULES2, lambda s, kept: "vc" in _form(kept + "l" if s == "logi" else kept))
    w = _changed(w, STEP3, lambda s, kept: "vc" in _form(kept))
    w = _changed(w, _RULES4, lambda s, kept: _many(kept) and (s != "ion" or _ends(kept, ("s", "t"))))
    if w.endswith("e"):
        measure = _form(w[:-1]).count("vc")
        if measure > 1 or (measure == 1 and not _short(w[:-1])):
            w = w[:-1]
    return w[:-1] if w.endswith("ll") and _many(w[:-1]) else w


_KNOWN: dict[str, str] = {}  # of this worker process


def stems_of(words: Sequence[str], most: int) -> list[str]:
    """Stems of words in lower case; a worker remembers up to ``most`` of them."""
    out = []
    for word in words:
        found = _KNOWN.get(word)
        if found is None:
            found = stem(word)
            if len(_KNOWN) >= most:
                _KNOWN.clear()
            if most:
                _KNOWN[word] = found
        out.append(found)
    return out
