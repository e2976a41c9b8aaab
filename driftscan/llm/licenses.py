"""License scans: Dice coefficient over distinct word bigrams of normalised text against templates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: License id and notice, header or paragraph; fixed values, in the words of the licences and of the notes in which they ask to be cited.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]


def normalise(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    w = normalise(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})


def bigrams(text: Column, more_than: int = 1) -> Column:
    """The distinct word bigrams of a unit of text; empty for a unit of no more words than more_than."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")

    def pairs(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.concat(F.element_at(w, i), F.lit(" "), F.element_at(w, i + 1)))
        return F.when(F.size(w) > max(1, more_than), F.array_distinct(each)).otherwise(F.array().cast("array<string>"))

    # bound by a lambda, the words are split once, wherever the planner moves the expression
    return F.transform(F.array(words), pairs)[0]


def size_bounds(n: int, least: float) -> tuple[int, int]:
    """Sizes between which a set can reach a Dice coefficient of `least` with one of n."""
    low = next(k for k in range(1, n + 1) if 2 * k / (k + n) >= least)
    high = max(k for k in range(n, int(n * 2 / least) + 2) if 2 * n / (k + n) >= least)
    return low, high


def scan_licenses(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """doc_id, license, dice, n_units: the licences whose templates a unit of the document matches.

    Units are the lines and the blocks between blank lines; dice is the best of
    them, n_units how many distinct units match. Only templates whose size lets
    `least` be reached are compared. A null or empty text has no units; rows with
    one id are taken together, those with a null id too. Documents that match
    nothing give no row.
    """
    known = [(name, bigrams_of(text)) for name, text in templates]
    known = [(name, grams, *size_bounds(len(grams), least)) for name, grams in known]
    lo = min(k[2] for k in known)
    units = documents.filter("text is not null").select("doc_id", F.explode(F.array_union(F.split("text", "\n"), F.split("text", r"\n[ \t]*\n+"))).alias("unit"))
    units = units.select("doc_id", "unit", bigrams(F.col("unit"), lo).alias("grams")).select("doc_id", "unit", "grams", F.size("grams").alias("n"))

    def hit(k):
        name, grams, low, high = k
        both = F.size(F.array_intersect("grams", F.array(*map(F.lit, grams))))
        dice = F.when(F.col("n").between(low, high), 2.0 * both / (F.col("n") + len(grams)))
        return F.struct(F.lit(name).alias("license"), dice.alias("dice"))

    hits = units.select("doc_id", "unit", F.explode(F.filter(F.array(*map(hit, known)), lambda h: h["dice"] >= least)).alias("h"))
    return hits.groupBy("doc_id", "h.license").agg(F.round(F.max("h.dice"), 6).alias("dice"), F.count_distinct("unit").alias("n_units"))


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.8) -> str:
    rows = ", ".join("('{}', [{}])".format(name, ", ".join(f"'{g}'" for g in bigrams_of(text))) for name, text in templates)
    return rf"""
WITH templates(license, grams) AS (VALUES {rows}),
units AS (
  SELECT DISTINCT doc_id, unit FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM documents WHERE text IS NOT NULL
    UNION ALL SELECT doc_id, unnest(string_split_regex(text, '\n[ \t]*\n+')) FROM documents WHERE text IS NOT NULL)
), worded AS (
  SELECT doc_id, unit, string_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM units
), paired AS (
  SELECT doc_id, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM worded WHERE len(w) > 1
), scored AS (
  SELECT p.doc_id, p.unit, t.license, 2.0::DOUBLE * len(list_intersect(p.grams, t.grams)) / (len(p.grams) + len(t.grams)) AS dice
  FROM paired p, templates t WHERE 2.0 * least(len(p.grams), len(t.grams)) / (len(p.grams) + len(t.grams)) >= {least}
)
SELECT doc_id, license, round(max(dice), 6) AS dice, count(DISTINCT unit) AS n_units FROM scored WHERE dice >= {least} GROUP BY doc_id, license
"""
