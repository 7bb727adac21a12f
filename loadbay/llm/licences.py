"""Licence recognition by known sentences and ordered rules, in DataFrame functions only.

A text is cut into pieces (at line breaks, and at full stops, colons, question and exclamation marks
before white space), each normalised to lower-case ASCII letters and digits with single spaces. The known
sentences are cut the same way, so a sentence with a colon or an abbreviation inside is a sequence of
pieces. Pieces become tokens, everything else is dropped, complete sequences become the identifier of their
sentence, and the identifiers are matched against an ordered list of rules: each rule is a pattern over
identifiers, and what a rule has matched is used up before the next one looks. Hard-wrapped notices are read a
second time with line breaks as spaces; there, lines without letters or digits and copyright lines end a
piece. Only texts holding one of the words that every known sentence has are cut up.

Everything is a narrow transformation: no shuffle, no join, no state.

Defined cases: null and empty texts have no sentence; rows without a doc_id are scanned like any
other; repeated rows come back repeated. Only doc_id and text are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and of the usual references to them.
SENTENCES = {
    "mit_title": "The MIT License (MIT)",
    "mit_name": "MIT License",
    "mit_ref": "Released under the MIT License.",
    "mit_ref_by": "Licensed under the MIT License.",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
                 " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
                 " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
                 " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
                 " subject to the following conditions:",
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial"
                  " portions of the Software.",
    "apache2_title": "Apache License, Version 2.0",
    "apache2_ref": "Licensed under the Apache License, Version 2.0.",
    "apache2_ref_released": "Released under the Apache License, Version 2.0.",
    "apache2_notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except"
                      " in compliance with the License.",
    "apache2_copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2_as_is": "Unless required by applicable law or agreed to in writing, software distributed under the License"
                     " is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express"
                     " or implied.",
    "apache2_see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3_title": "GNU General Public License, version 3",
    "gpl3_ref": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3_ref_released": "Released under the GNU General Public License, version 3.",
    "gpl2_ref": "This work is licensed under the GNU General Public License, version 2.",
    "gpl3_notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
                   " General Public License as published by the Free Software Foundation, either version 3 of the License,"
                   " or (at your option) any later version.",
    "gpl2_notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
                   " General Public License as published by the Free Software Foundation; either version 2 of the License,"
                   " or (at your option) any later version.",
    "gpl_purpose": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even"
                   " the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl_see": "See the GNU General Public License for more details.",
    "gpl_received": "You should have received a copy of the GNU General Public License along with this program.",
    "lgpl3_ref": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl3_ref": "This work is licensed under the GNU Affero General Public License, version 3.",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
                 " that the following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
                  " following disclaimer.",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and"
                  " the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd_names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
                 " promote products derived from this software without specific prior written permission.",
    "bsd_ref": "Licensed under the BSD License.",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
                 " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl2_notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2_ref": "Licensed under the Mozilla Public License, version 2.0.",
    "ccby4_ref": "Licensed under CC BY 4.0.",
    "ccbysa4_ref": "Licensed under CC BY-SA 4.0.",
    "ccbync4_ref": "Licensed under CC BY-NC 4.0.",
    "ccbyncsa4_ref": "Licensed under CC BY-NC-SA 4.0.",
    "ccbyncnd4_ref": "Licensed under CC BY-NC-ND 4.0.",
    "ccbynd4_ref": "Licensed under CC BY-ND 4.0.",
    "ccby4_work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "ccbysa4_work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "ccbync4_work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "rights": "All rights reserved.",
}
# Rules in the order they are tried; tokens in angle brackets are sentences.
RULES = [
    ("MIT", "(<mit_title>|<mit_name>)?<mit_grant><mit_notice>"),
    ("BSD-3-Clause", "<bsd_grant><bsd_source><bsd_binary><bsd_names>"),
    ("BSD-2-Clause", "<bsd_grant><bsd_source><bsd_binary>"),
    ("Apache-2.0", "(<apache2_title>)?<apache2_notice>(<apache2_copy>)?(<apache2_as_is>)?(<apache2_see>)?"),
    ("GPL-3.0-or-later", "(<gpl3_title>)?<gpl3_notice>(<gpl_purpose>)?(<gpl_see>)?(<gpl_received>)?"),
    ("GPL-2.0-or-later", "<gpl2_notice>(<gpl_purpose>)?(<gpl_see>)?(<gpl_received>)?"),
    ("ISC", "<isc_grant>"),
    ("MPL-2.0", "<mpl2_notice>|<mpl2_ref>"),
    ("MIT", "<mit_ref>|<mit_ref_by>|<mit_title>|<mit_name>"),
    ("Apache-2.0", "<apache2_ref>|<apache2_ref_released>|<apache2_title>"),
    ("GPL-3.0", "<gpl3_ref>|<gpl3_ref_released>|<gpl3_title>"),
    ("GPL-2.0", "<gpl2_ref>"),
    ("LGPL-3.0", "<lgpl3_ref>"),
    ("AGPL-3.0", "<agpl3_ref>"),
    ("BSD", "<bsd_ref>"),
    ("CC-BY-4.0", "<ccby4_ref>|<ccby4_work>"),
    ("CC-BY-SA-4.0", "<ccbysa4_ref>|<ccbysa4_work>"),
    ("CC-BY-NC-4.0", "<ccbync4_ref>|<ccbync4_work>"),
    ("CC-BY-NC-SA-4.0", "<ccbyncsa4_ref>"),
    ("CC-BY-NC-ND-4.0", "<ccbyncnd4_ref>"),
    ("CC-BY-ND-4.0", "<ccbynd4_ref>"),
    ("Unlicense", "<unlicense>"),
    ("All-Rights-Reserved", "<rights>"),
]
# every sentence above holds one of these once normalised
HINTS = "licen|permission|redistribut|warrant|unencumbered|rights|without any"
ENDS = r"[.!?:]+(?:[ \t\r]+|$)|[.!?:]*\n"
WRAPPED = (r"(?:^|\n)[^A-Za-z0-9]*[Cc]opyright[ \t]+(?:\([cC]\)|©|[0-9]{4})[^\n]*|[.!?:]*\n(?:[^A-Za-z0-9\n]*\n)+"
           r"|[.!?:]+(?:\s+|$)")
MARK = "\x01"


def pieces(sentence: str) -> list[str]:
    """A known sentence cut and normalised as texts are."""
    cut = re.sub(r"[.!?:]+(?:\s+|$)", MARK, sentence).lower()
    return [p for p in (x.strip() for x in re.sub(f"[^a-z0-9{MARK}]+", " ", cut).split(MARK)) if p]


def _known() -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Token of every piece, and (sequence of tokens, identifier) of the sentences of several pieces."""
    tokens, longer = {}, []
    for name, sentence in SENTENCES.items():
        parts = pieces(sentence)
        for n, p in enumerate(parts, 1):
            tokens.setdefault(p, f"<{name}>" if len(parts) == 1 else f"<{name}.{n}>")
        if len(parts) > 1:
            longer.append(("".join(tokens[p] for p in parts), f"<{name}>"))
    return tokens, longer


TOKENS, SEQUENCES = _known()
PARTIAL = r"<\w+\.\d+>"


def _ids(text: Column, ends: str) -> Column:
    """The identifiers of a text's known sentences, in order, as one string of tokens."""
    marked = F.lower(F.regexp_replace(text, ends, MARK))
    plain = F.regexp_replace(marked, f"[^a-z0-9{MARK}]+", " ")
    known = F.create_map(*[F.lit(v) for pair in TOKENS.items() for v in pair])
    found = F.transform(F.split(plain, MARK), lambda s: F.try_element_at(known, F.trim(s)))
    out = F.array_join(F.filter(found, lambda s: s.isNotNull()), "")
    for sequence, name in SEQUENCES:
        out = F.replace(out, F.lit(sequence), F.lit(name))
    return F.regexp_replace(out, PARTIAL, "")


def _apply(ids: Column) -> Column:
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("pattern")) for n, p in RULES])
    start = F.struct(ids.alias("rest"), F.array().cast("array<string>").alias("found"))

    def step(state, rule):
        hit = F.regexp_like(state["rest"], rule["pattern"])
        return F.when(hit, F.struct(
            F.regexp_replace(state["rest"], rule["pattern"], F.lit("-")).alias("rest"),
            F.array_append(state["found"], rule["name"]).alias("found"))).otherwise(state)

    return F.aggregate(rules, start, step, lambda s: F.array_distinct(s["found"]))


def licences(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, sentence_ids (tokens in order), licenses (in the order of the
    rules, comma-joined), n_licenses."""
    hinted = F.regexp_like(F.lower("text"), F.lit(HINTS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(hinted, F.col("text")).alias("t"))
    ids = rows.select("doc_id", F.when(F.col("t").isNotNull(), F.struct(
        _ids(F.col("t"), ENDS).alias("lines"), _ids(F.col("t"), WRAPPED).alias("wrapped"))).alias("s"))
    some = (F.col("s.lines") != "") | (F.col("s.wrapped") != "")
    found = F.when(some, F.array_union(_apply(F.col("s.lines")), _apply(F.col("s.wrapped")))).otherwise(
        F.array().cast("array<string>"))
    longer = F.when(F.length("s.wrapped") > F.length("s.lines"), F.col("s.wrapped")).otherwise(F.col("s.lines"))
    return ids.select("doc_id", F.coalesce(longer, F.lit("")).alias("sentence_ids"), found.alias("found")).select(
        "doc_id", "sentence_ids", F.array_join("found", ",").alias("licenses"),
        F.size("found").cast("long").alias("n_licenses"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql() -> str:
    known = ", ".join(f"({_quoted(p)}, {_quoted(t)})" for p, t in TOKENS.items())
    seq = "string_agg(id, '' ORDER BY pos)"
    for sequence, name in SEQUENCES:
        seq = f"replace({seq}, {_quoted(sequence)}, {_quoted(name)})"
    rules = ", ".join(f"({n}, {_quoted(a)}, {_quoted(p)})" for n, (a, p) in enumerate(RULES))
    return f"""
WITH RECURSIVE known(s, id) AS (VALUES {known}),
rules(n, name, pattern) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS row_no, doc_id, text FROM documents),
cuts AS (
  SELECT row_no, way, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM (
    SELECT row_no, way, string_split(regexp_replace(lower(regexp_replace(text, ends, chr(1), 'g')),
                                                    '[^a-z0-9\\x01]+', ' ', 'g'), chr(1)) AS parts
    FROM d, (VALUES (1, {_quoted(ENDS)}), (2, {_quoted(WRAPPED)})) AS e(way, ends)
    WHERE text IS NOT NULL)),
ids AS (
  SELECT row_no, way, regexp_replace({seq}, {_quoted(PARTIAL)}, '', 'g') AS seq
  FROM cuts JOIN known ON trim(part) = s GROUP BY row_no, way),
run(row_no, way, n, rest, found) AS (
  SELECT row_no, way, 0, seq, CAST([] AS VARCHAR[]) FROM ids
  UNION ALL
  SELECT row_no, way, run.n + 1, regexp_replace(rest, pattern, '-', 'g'),
         CASE WHEN regexp_matches(rest, pattern) THEN list_append(found, name) ELSE found END
  FROM run JOIN rules ON run.n = rules.n),
done AS (SELECT row_no, way, found FROM run WHERE n = {len(RULES)}),
first AS (
  SELECT row_no, name, min(way * 1000 + p) AS place
  FROM (SELECT row_no, way, unnest(found) AS name, generate_subscripts(found, 1) AS p FROM done) GROUP BY 1, 2),
named AS (SELECT row_no, string_agg(name, ',' ORDER BY place) AS licenses, count(*) AS n_licenses FROM first GROUP BY 1)
SELECT doc_id,
       coalesce(CASE WHEN length(coalesce(w.seq, '')) > length(coalesce(l.seq, '')) THEN w.seq ELSE l.seq END, '') AS sentence_ids,
       coalesce(licenses, '') AS licenses, coalesce(n_licenses, 0) AS n_licenses
FROM d LEFT JOIN ids l ON l.row_no = d.row_no AND l.way = 1 LEFT JOIN ids w ON w.row_no = d.row_no AND w.way = 2
LEFT JOIN named ON named.row_no = d.row_no
"""


SQL = _sql()
