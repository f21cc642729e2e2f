"""The stemming algorithm as SQL over a table ``vocab`` (word), for comparison.

Written apart from the column version: consonant-vowel sequences are matched by
regular expressions on the word itself (a 'y' after a consonant is a vowel).
"""

from __future__ import annotations

from ..functions.porter import IRREGULAR, STEP2, STEP3, STEP4
from .sql_text import quoted


def _shape(expr: str) -> str:
    s = f"regexp_replace({expr}, '[^aeiouy]', 'c', 'g')"
    s = f"regexp_replace({s}, '[aeiou]', 'v', 'g')"
    s = f"regexp_replace({s}, '(^|v)y', '\\1c', 'g')"
    return f"replace(replace({s}, 'yy', 'vc'), 'y', 'v')"


def _m(expr: str) -> str:
    """The measure: how often a vowel is followed by a consonant."""
    return f"((length({_shape(expr)}) - length(replace({_shape(expr)}, 'vc', ''))) // 2)"


def _stem(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _cvc(expr: str) -> str:
    return (
        f"((ends_with({_shape(expr)}, 'cvc') and not regexp_matches({expr}, '[wxy]$')) or {_shape(expr)} = 'vc')"
    )


def _table(rules, least: int) -> str:
    whens = "".join(
        f" when ends_with(w, '{old}') then case when {_m(_stem(len(old)))} > {least - 1} "
        f"then {_stem(len(old))} || '{new}' else w end"
        for old, new in rules
    )
    return f"case{whens} else w end"


def stem_ctes() -> str:
    """CTEs from vocab(word) to stemmed(word, stem)."""
    logi = f" when ends_with(w, 'logi') then case when {_m('left(w, length(w) - 3)')} > 0 then left(w, length(w) - 1) else w end"
    step2 = _table(STEP2, 1)
    step2 = step2[: -len(" else w end")] + logi + " else w end"
    step4 = "case" + "".join(
        f" when ends_with(w, '{s}') then case when {_m(_stem(len(s)))} > 1"
        + (f" and regexp_matches({_stem(3)}, '[st]$')" if s == "ion" else "")
        + f" then {_stem(len(s))} else w end"
        for s in STEP4
    ) + " else w end"
    irregular = "case word" + "".join(f" when {quoted(a)} then {quoted(b)}" for a, b in IRREGULAR.items())
    doubled = "right(w, 1) = substring(w, length(w) - 1, 1) and length(w) >= 2 and ends_with(" + _shape("w") + ", 'c')"
    steps = [
        # plural
        "select word, case when ends_with(w, 'ies') and length(w) = 4 then left(w, 3) when ends_with(w, 'sses') then "
        "left(w, length(w) - 2) when ends_with(w, 'ies') then left(w, length(w) - 2) when ends_with(w, 'ss') then w "
        "when ends_with(w, 's') then left(w, length(w) - 1) else w end w, false cut from {0}",
        # past forms
        f"select word, case when ends_with(w, 'ied') then left(w, length(w) - case when length(w) = 4 then 1 else 2 end) "
        f"when ends_with(w, 'eed') then case when {_m(_stem(3))} > 0 then {_stem(1)} else w end "
        f"when ends_with(w, 'ed') and contains({_shape(_stem(2))}, 'v') then {_stem(2)} "
        f"when ends_with(w, 'ing') and contains({_shape(_stem(3))}, 'v') then {_stem(3)} else w end w, "
        f"not ends_with(w, 'ied') and not ends_with(w, 'eed') and ((ends_with(w, 'ed') and contains({_shape(_stem(2))}, 'v')) "
        f"or (ends_with(w, 'ing') and contains({_shape(_stem(3))}, 'v'))) cut from {{0}}",
        f"select word, case when not cut then w when regexp_matches(w, '(at|bl|iz)$') then w || 'e' "
        f"when {doubled} then case when right(w, 1) in ('l', 's', 'z') then w else {_stem(1)} end "
        f"when {_m('w')} = 1 and {_cvc('w')} then w || 'e' else w end w, cut from {{0}}",
        # y
        f"select word, case when ends_with(w, 'y') and length(w) > 2 and ends_with({_shape(_stem(1))}, 'c') "
        f"then {_stem(1)} || 'i' else w end w, cut from {{0}}",
        f"select word, case when ends_with(w, 'alli') and {_m(_stem(4))} > 0 then {_stem(2)} else w end w, cut from {{0}}",
        f"select word, {step2} w, cut from {{0}}",
        f"select word, {_table(STEP3, 1)} w, cut from {{0}}",
        f"select word, {step4} w, cut from {{0}}",
        f"select word, case when ends_with(w, 'e') and ({_m(_stem(1))} > 1 or ({_m(_stem(1))} = 1 and not {_cvc(_stem(1))})) "
        f"then {_stem(1)} else w end w, cut from {{0}}",
        f"select word, case when ends_with(w, 'll') and {_m(_stem(1))} > 1 then {_stem(1)} else w end w, cut from {{0}}",
    ]
    ctes = ["s0 as (select word, lower(word) w, false cut from vocab)"]
    for i, text in enumerate(steps, 1):
        ctes.append(f"s{i} as ({text.format(f's{i - 1}')})")
    ctes.append(
        f"stemmed as (select word, {irregular} else case when length(word) <= 2 then word else w end end stem from s{len(steps)})"
    )
    return ",\n".join(ctes)
