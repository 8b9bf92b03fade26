"""License scans by Dice coefficient over word bigrams, in DataFrame functions only.

A text's units are its lines, and its paragraphs (parts between lines without letters or
digits, as blank ones and bare comment signs) of several lines; lines end at CR, LF or both. Units and templates are normalised alike: lower case, all runs of characters other
than letters and digits become one space. With A and B the distinct word bigrams of unit
and template, Dice = 2 |A and B| / (|A| + |B|) can reach a threshold t only if |A| lies
between |B| t / (2 - t) and |B| (2 - t) / t; templates outside these bounds are dropped
before any bigrams are compared. Shared bigrams are counted by an equi-join of the units'
bigrams with the templates' (a fixed list, so its broadcast is bounded).

Defined results: null and empty texts, and units of fewer than two words, match nothing;
documents without a match have null licence columns and n_matches 0; of a document's
matches the best is the highest Dice, then the licence's name, then the first unit;
repeated rows and null ids each get their row; other columns are ignored."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: A word that no normalised text has.
ITSELF = "\x00"

# Notices as their licences ask for them: name, kind, text.
TEMPLATES = [
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "permissive", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("Apache-2.0", "permissive", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "permissive", "Released under the MIT License."),
    ("MIT", "permissive", "This project is licensed under the terms of the MIT license."),
    ("MIT", "permissive", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MIT", "permissive", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "permissive", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "permissive", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "permissive", "SPDX-License-Identifier: BSD-3-Clause"),
    ("ISC", "permissive", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "copyleft", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "copyleft", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "copyleft", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "copyleft", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "copyleft", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-2.1", "copyleft", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "copyleft", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "copyleft", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "permissive", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "permissive", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "copyleft", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "copyleft", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "non-commercial", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "non-commercial", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "public-domain", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "public-domain", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "proprietary", "All rights reserved."),
    ("proprietary", "proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher."),
]


#: Ends of lines, and of paragraphs.
LINE = r"\r\n|[\r\n]"
PARAGRAPH = r"(?:\r\n|[\r\n])(?:[^\p{L}\p{N}\r\n]*(?:\r\n|[\r\n]))+"


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def templates() -> list[tuple[str, str, list[str]]]:
    return [(name, kind, template_bigrams(text)) for name, kind, text in TEMPLATES]


def bounds(n: int, threshold: float) -> tuple[float, float]:
    return n * threshold / (2 - threshold), n * (2 - threshold) / threshold


def units(docs: DataFrame, id_col: str, text_col: str, possible) -> DataFrame:
    """(at, doc_id, unit, n, bigram): the distinct bigrams of each unit whose number ``n`` of
    them is ``possible``; units are lines, then paragraphs of several lines. Unit -1 with
    the bigram ``ITSELF`` stands for the row; ``at`` tells rows apart."""
    docs = docs.select(F.monotonically_increasing_id().alias("at"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    parts = F.concat(F.split(text, LINE), F.filter(F.split(text, PARAGRAPH), lambda p: p.rlike("[\r\n]")))
    words = F.transform(parts, lambda p: F.split(F.trim(F.regexp_replace(F.lower(p), r"[^\p{L}\p{N}]+", " ")), " "))
    rows = docs.select("at", "doc_id", F.posexplode(F.concat(words, F.array(F.array(F.lit(ITSELF))))).alias("place", "words"))
    itself = F.get("words", F.lit(0)) == ITSELF
    bigrams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("words") - 1),
                                           lambda i: F.concat_ws(" ", F.get("words", i - 1), F.get("words", i))))
    bigrams = F.when(itself, F.col("words")).when(F.size("words") >= 2, bigrams)
    # exploding an array of none or one keeps the bigrams from being computed again for each use
    kept = F.filter(F.array(bigrams), lambda b: possible(F.size(b)) | itself)
    rows = rows.select("at", "doc_id", F.when(itself, -1).otherwise(F.col("place")).alias("unit"), F.explode(kept).alias("bigrams"))
    return rows.select("at", "doc_id", "unit", F.size("bigrams").alias("n"), F.explode("bigrams").alias("bigram"))


def compared(docs: DataFrame, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(at, doc_id, unit, license, kind, dice) of units and templates that share a bigram,
    and one row of unit -1 and null Dice for each input row."""
    spark = docs.sparkSession
    known = [(t, name, kind, b, len(bigrams), *bounds(len(bigrams), threshold))
             for t, (name, kind, bigrams) in enumerate(templates()) for b in bigrams]
    known.append((-1, None, None, ITSELF, 0, 0.0, 1.0))
    table = spark.createDataFrame(known, "template int, license string, kind string, bigram string, size int, low double, high double")
    sizes = sorted({bounds(len(b), threshold) for _, _, b in templates()})

    def possible(n):
        found = F.lit(False)
        for low, high in sizes:
            found = found | ((n >= low) & (n <= high))
        return found

    shared = (units(docs, id_col, text_col, possible).join(F.broadcast(table), "bigram")
              .where((F.col("n") >= F.col("low")) & (F.col("n") <= F.col("high")))
              .groupBy("at", "doc_id", "unit", "template", "license", "kind", "n", "size").agg(F.count("*").alias("shared")))
    dice = F.when(F.col("unit") >= 0, 2.0 * F.col("shared") / (F.col("n") + F.col("size")))
    return shared.select("at", "doc_id", "unit", "license", "kind", dice.alias("dice"))


def matches(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, unit, license, kind, dice) for every unit and template at or above the threshold."""
    return compared(docs, threshold, id_col, text_col).where(F.col("dice") >= threshold).drop("at")


def scan(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, kind, dice, unit, n_matches) per row: the best match of each document."""
    found = F.col("dice") >= threshold
    best = compared(docs, threshold, id_col, text_col).groupBy("at", "doc_id").agg(
        F.min(F.when(found, F.struct((-F.col("dice")).alias("less"), "license", "unit", "kind"))).alias("b"),
        F.count(F.when(found, 1)).alias("n_matches"))
    return best.select("doc_id", F.col("b.license").alias("license"), F.col("b.kind").alias("kind"), (-F.col("b.less")).alias("dice"),
                       F.col("b.unit").alias("unit"), "n_matches")


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ",\n    ".join(f"({t}, {quoted(name)}, {quoted(kind)}, [{', '.join(map(quoted, b))}], {bounds(len(b), THRESHOLD)[0]!r}::DOUBLE, {bounds(len(b), THRESHOLD)[1]!r}::DOUBLE)"
                        for t, (name, kind, b) in enumerate(templates()))
    return rf"""
WITH templates(template, license, kind, bigrams, low, high) AS (VALUES
    {rows}),
parts AS (
  SELECT doc_id, list_concat(string_split_regex(coalesce(text, ''), '{LINE}'),
    list_filter(string_split_regex(coalesce(text, ''), '{PARAGRAPH}'), lambda x: regexp_matches(x, '[\r\n]'))) AS p FROM documents),
units AS (SELECT doc_id, i - 1 AS unit, string_split(trim(regexp_replace(lower(p[i]), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w
  FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM parts)),
pairs AS (SELECT doc_id, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigrams
  FROM units WHERE len(w) >= 2),
matched AS (
  SELECT doc_id, unit, license, kind, 2.0::DOUBLE * len(list_intersect(p.bigrams, t.bigrams)) / (len(p.bigrams) + len(t.bigrams)) AS dice
  FROM pairs p JOIN templates t ON len(p.bigrams) >= t.low AND len(p.bigrams) <= t.high),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, license, unit, kind) AS k,
  count(*) OVER (PARTITION BY doc_id) AS n FROM matched WHERE dice >= {THRESHOLD})
SELECT d.doc_id, b.license, b.kind, b.dice, b.unit::INTEGER AS unit, coalesce(b.n, 0)::BIGINT AS n_matches
FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id AND b.k = 1
"""


OP4_SQL = _sql()
