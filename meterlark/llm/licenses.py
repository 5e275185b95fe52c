"""Licence scans by sentence rules, with DataFrame functions only.

A text is cut into sentences twice: line by line, and with line breaks taken as spaces, since
licence texts are wrapped. Sentences are lower-cased, everything but letters and digits becomes
one space, and a sentence that is known gets its identifier. The identifiers of a text, in order,
form a sequence that is broken where more than GAP unknown sentences lie in between; a rule fires
if its own sequence occurs in it without a break.

Only texts that hold one of TRIGGERS are cut; every known sentence holds one. The tables of
sentences and rules are constants of this module, so the join on the sentence is a broadcast of a
known size, and texts are never shuffled by a sentence: each row keeps its own sequence.

A null or empty text has no sentences and fires no rule. A text of any length is scanned whole.
Rows that repeat are scanned each; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Unknown sentences that may lie between two sentences of a rule.
GAP = 3

#: Fixed values: (licence, notices and texts by which it is known). Each is cut into sentences by the same rules as a document.
RULES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License "
        'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and '
        "limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        'provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Words, of which every rule's sentences hold at least one.
TRIGGERS = ["licen", "warrant", "copyright", "permission", "redistribut", "mpl", "public domain", "as is"]
_TRIGGER = re.compile("|".join(TRIGGERS))

#: Where a sentence ends, and what is kept of it.
END, SPACE, OTHER = "([.!?;:])[ \\t\\r\\n]+", "[ \\t\\r\\n]+", "[^a-z0-9]+"


def _sentences(text: str) -> list[str]:
    """Normalised sentences of a rule's text that hold a trigger word."""
    cut = re.sub(END, "\\1\n", text).split("\n")
    plain = [re.sub(OTHER, " ", s.lower()).strip() for s in cut]
    return [s for s in plain if _TRIGGER.search(s)]


def known_sentences() -> dict[str, int]:
    """Identifier of each known sentence, from 1 on."""
    out: dict[str, int] = {}
    for _, text in RULES:
        for s in _sentences(text):
            out.setdefault(s, len(out) + 1)
    return out


def rules() -> list[tuple[str, str]]:
    """(licence, sequence of identifiers as text) of each rule."""
    known = known_sentences()
    return [(licence, "".join(f"|{known[s]}" for s in _sentences(text)) + "|") for licence, text in RULES]


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, END, "$1\n"), "\n", -1)


def _flowing(text: Column) -> Column:
    return F.split(F.regexp_replace(F.regexp_replace(text, SPACE, " "), "([.!?;:]) ", "$1\n"), "\n", -1)


def _sequence(sentences: Column) -> Column:
    """Identifiers of the known sentences as text: |3|4|, with # where a gap is too long."""
    table = F.create_map(*(F.lit(x) for pair in known_sentences().items() for x in pair))
    plain = F.transform(sentences, lambda s: F.trim(F.regexp_replace(F.lower(s), OTHER, " ")))
    hits = F.filter(
        F.transform(plain, lambda s, k: F.struct(k.alias("k"), F.when(s.rlike("|".join(TRIGGERS)), F.try_element_at(table, s)).alias("id"))), lambda h: h["id"].isNotNull()
    )
    state = F.aggregate(
        hits,
        F.struct(F.lit("").alias("text"), F.lit(-1).alias("last")),
        lambda s, h: F.struct(
            F.concat(
                s["text"],
                F.when(s["text"] == "", F.lit("|")).when(h["k"] - s["last"] > GAP + 1, F.lit("#|")).otherwise(F.lit("")),
                h["id"].cast("string"),
                F.lit("|"),
            ).alias("text"),
            h["k"].alias("last"),
        ),
    )
    return state["text"]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, licences, n_rules, line_sequence, flow_sequence) of every row.

    `licences` holds the names of all rules that fire, sorted, joined by commas; empty if none do.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # A line may be wrapped inside a trigger.
    some = F.lower(body).rlike("|".join(TRIGGERS).replace(" ", r"\s+"))
    rows = docs.select(F.col(key), F.when(some, body).alias("_body"))
    rows = rows.select(
        key,
        F.when(F.col("_body").isNotNull(), _sequence(_lines(F.col("_body")))).otherwise("").alias("line_sequence"),
        F.when(F.col("_body").isNotNull(), _sequence(_flowing(F.col("_body")))).otherwise("").alias("flow_sequence"),
    )
    table = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(ids).alias("ids")) for name, ids in rules()))
    fired = F.filter(table, lambda r: F.col("line_sequence").contains(r["ids"]) | F.col("flow_sequence").contains(r["ids"]))
    rows = rows.withColumn("_fired", F.when((F.col("line_sequence") != "") | (F.col("flow_sequence") != ""), fired).otherwise(F.slice(table, 1, 0)))
    return rows.select(
        key,
        F.array_join(F.array_sort(F.array_distinct(F.transform("_fired", lambda r: r["name"]))), ",").alias("licences"),
        F.size("_fired").alias("n_rules"),
        "line_sequence",
        "flow_sequence",
    )


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle_sql() -> str:
    """The same scan for DuckDB, by joins."""
    triggers = "|".join(TRIGGERS)
    known = ", ".join(f"({i}, {_quoted(s)})" for s, i in known_sentences().items())
    fixed = ", ".join(f"({k}, {_quoted(name)}, {_quoted(ids)})" for k, (name, ids) in enumerate(rules()))
    return f"""
WITH known(id, sentence) AS (VALUES {known}),
rules(k, name, ids) AS (VALUES {fixed}),
cut AS (
  SELECT doc_id, 'line' AS how, string_split(regexp_replace(text, '([.!?;:])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM documents
  UNION ALL
  SELECT doc_id, 'flow', string_split(regexp_replace(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g'), '([.!?;:]) ', '\\1' || chr(10), 'g'), chr(10)) FROM documents
),
sentences AS (SELECT doc_id, how, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM cut),
hits AS (
  SELECT doc_id, how, s.k, known.id, lag(s.k) OVER (PARTITION BY doc_id, how ORDER BY s.k) AS last
  FROM (SELECT doc_id, how, k, trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM sentences WHERE regexp_matches(lower(part), '{triggers}')) s
  JOIN known USING (sentence)
),
sequences AS (
  SELECT doc_id, how, string_agg(CASE WHEN last IS NULL THEN '|' WHEN k - last > {GAP + 1} THEN '#|' ELSE '' END || id || '|', '' ORDER BY k) AS ids FROM hits GROUP BY doc_id, how
),
both_ways AS (
  SELECT doc_id, coalesce(max(ids) FILTER (how = 'line'), '') AS line_sequence, coalesce(max(ids) FILTER (how = 'flow'), '') AS flow_sequence FROM sequences GROUP BY doc_id
),
fired AS (SELECT doc_id, name, k FROM both_ways, rules WHERE contains(line_sequence, ids) OR contains(flow_sequence, ids)),
per_doc AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS licences, count(DISTINCT k) AS n FROM fired GROUP BY doc_id)
SELECT d.doc_id, coalesce(p.licences, '') AS licences, cast(coalesce(p.n, 0) AS integer) AS n_rules,
  coalesce(b.line_sequence, '') AS line_sequence, coalesce(b.flow_sequence, '') AS flow_sequence
FROM documents d LEFT JOIN per_doc p USING (doc_id) LEFT JOIN both_ways b USING (doc_id)
"""
