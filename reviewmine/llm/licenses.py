"""License scans: lines, paragraphs and whole documents against licence templates.

Texts are normalised to lower-case words. A unit of text and a template are alike by the Dice coefficient
of their sets of word bigrams: 2 * common / (one + other). A coefficient of at least t bounds the sizes of the
two sets by t / (2 - t) and its inverse, so templates whose size lies outside are never compared. Everything
is SQL expressions within the row: no shuffle, no Python.
"""

from __future__ import annotations

import re
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import need

LEAST = Fraction(4, 5)

# Published licence notices and texts.
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-notice": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def words_of(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip().split()


def bigrams_of(text: str) -> list[str]:
    words = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def anchors(templates: dict[str, str], least: Fraction = LEAST) -> list[str]:
    """Words of which every unit that is alike to some template has at least one.

    A unit alike to a template with n bigrams shares at least t * n / (2 - t) of them. So words that
    touch more of the n than it may miss cannot all be missing; the longest, rarest ones are taken.
    """
    out: set[str] = set()
    for text in templates.values():
        bigrams = bigrams_of(text)
        may_miss = len(bigrams) - ceil(least * len(bigrams) / (2 - least))
        touched = {b for b in bigrams if out & set(b.split())}
        for word in sorted({w for b in bigrams for w in b.split()}, key=lambda w: (-len(w), w)):
            if len(touched) > may_miss:
                break
            out.add(word)
            touched |= {b for b in bigrams if word in b.split()}
    return sorted(out)


def normal_words(unit: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(unit), "[^a-z0-9]+", " ")), " ")


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, least: Fraction = LEAST, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id and ``matches``: (license, dice) of the best template of every unit that reaches ``least``.

    Units are the distinct lines, paragraphs and the whole text. Equal coefficients go to the later name. NULL and empty
    texts, and units of fewer than two words, match nothing; repeated rows are scanned each; every row of the table
    is in the result.
    """
    templates = TEMPLATES if templates is None else templates
    known = {name: bigrams_of(text) for name, text in sorted(templates.items())}
    known = {name: b for name, b in known.items() if b}
    low = float(least / (2 - least))
    smallest, largest = min(map(len, known.values())) * low, max(map(len, known.values())) / low
    table = F.array(*[
        F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, b)).alias("bigrams"), F.lit(len(b)).alias("n")) for name, b in known.items()])
    pattern = "(?i)(" + "|".join(map(re.escape, anchors(templates, least))) + ")"
    text = F.col(f"`{text_col}`")
    pieces = F.concat(F.split(text, "\n"), F.split(text, "\n[ \t\r]*\n"), F.array(text))
    units = F.array_distinct(F.filter(pieces, lambda u: u.rlike(pattern)))
    words = F.filter(
        F.transform(units, normal_words),
        lambda w: (F.size(w) - 1 >= smallest) & (F.size(F.array_distinct(w)) - 1 <= largest) & (F.size(w) > 1))
    sets = F.transform(words, lambda w: F.array_distinct(
        F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b))))

    def best(own: Column) -> Column:
        fitting = F.filter(table, lambda t: (F.size(own) >= t["n"] * low) & (t["n"] >= F.size(own) * low))
        return F.array_max(F.transform(fitting, lambda t: F.struct(
            (F.size(F.array_intersect(own, t["bigrams"])) * 2 / (F.size(own) + t["n"])).alias("dice"), t["name"].alias("license"))))

    matches = F.filter(F.transform(sets, best), lambda m: m["dice"] >= float(least))
    none = F.array().cast("array<struct<dice:double,license:string>>")
    return need(docs, id_col, text_col).select(
        F.col(f"`{id_col}`").alias("doc_id"), F.when(text.rlike(pattern), matches).otherwise(none).alias("matches"))


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number of alike units, the licences found and the best coefficient (NULL if none)."""
    return scan(docs, id_col=id_col, text_col=text_col).select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))).alias("licenses"),
        F.round(F.array_max(F.transform("matches", lambda m: m["dice"])), 6).alias("best_dice"),
    )


def report_sql() -> str:
    """``license_report`` over the table documents as DuckDB SQL, without pruning."""
    rows = ",\n".join("('{}', [{}])".format(name, ", ".join("'" + b + "'" for b in bigrams_of(text))) for name, text in sorted(TEMPLATES.items()))
    return f"""
with templates(license, bigrams) as (values
{rows}
), units as (
  select distinct rid, doc_id, unit from (
    select rid, doc_id, unnest(list_concat(list_concat(
      string_split(text, chr(10)), regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')), [text])) unit
    from (select row_number() over () rid, doc_id, text from documents))
), split_units as (
  select rid, unit, string_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ') w from units
), sets as (
  select rid, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) b
  from split_units where len(w) > 1
), alike as (
  select rid, unit, license, 2.0::double * len(list_intersect(b, bigrams)) / (len(b) + len(bigrams)) dice
  from sets join templates on len(b) >= len(bigrams) * {float(LEAST / (2 - LEAST))!r} and len(bigrams) >= len(b) * {float(LEAST / (2 - LEAST))!r}
), best as (
  select rid, unit, license, dice from alike where dice >= {float(LEAST)}
  qualify row_number() over (partition by rid, unit order by dice desc, license desc) = 1
)
select d.doc_id, count(license) n_matches, coalesce(string_agg(distinct license, ',' order by license), '') licenses,
       round(max(dice), 6) best_dice
from (select row_number() over () rid, doc_id from documents) d left join best using (rid)
group by d.rid, d.doc_id
"""
