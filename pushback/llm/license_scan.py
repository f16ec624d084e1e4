"""Licence scans by sentence rules, with DataFrame functions only.

A text is cut into sentences, each sentence is normalised (lower case, runs of
anything but ``a-z0-9`` become one space) and looked up among known licence
sentences; a text becomes the sequence of their identifiers, with a gap mark
wherever other sentences stand between.  List marks (a lone number, letter or
Roman numeral) are no sentences, and the stop of ``v. 2`` ends none.  Ordered rules (longer before shorter,
first match wins, matches do not overlap) then turn identifier sequences into
licences.

Texts are read in two ways: with every line end as a sentence end (notices of
one line), and with single line ends as white space (wrapped notices).  The
licences of both readings are merged.

The scan is a projection of each row: no shuffle, no group that can be hot,
and the rule tables are literals of the plan.

Edge cases: a null or empty text has no sentences and no licences; rows are
judged one by one, so repeated rows repeat their result; an empty table gives
an empty result; other columns are passed through by ``scan`` (its own columns
start with ``license_``; an input column of such a name is replaced).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Known licence sentences, as normalised text, by identifier.
SENTENCES: dict[str, str] = {
    "mit_title": "the mit license",
    "mit_title_short": "mit license",
    "mit_title_paren": "the mit license mit",
    "mit_released": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_project": "this project is licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc_title": "isc license",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd_grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "apache_licensed": "licensed under the apache license version 2 0",
    "apache_licensed_the": "licensed under the apache license version 2 0 the license",
    "apache_may_not": "you may not use this file except in compliance with the license",
    "apache_obtain": "you may obtain a copy of the license at",
    "apache_url": "http www apache org licenses license 2 0",
    "apache_as_is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl_licensed_3": "this work is licensed under the gnu general public license version 3",
    "gpl_licensed_2": "this work is licensed under the gnu general public license version 2",
    "gpl_redistribute_3": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl_redistribute_2": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_free_software": "this program is free software",
    "gpl_free_software_3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl_free_software_2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_details": "see the gnu general public license for more details",
    "lgpl_redistribute_3": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl_redistribute_3": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mpl_subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl_copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "unlicense_public": "this is free and unencumbered software released into the public domain",
    "cc_by_nc": "licensed under cc by nc 4 0",
    "cc_by": "licensed under cc by 4 0",
    "cc_by_sa": "licensed under cc by sa 4 0",
    "cc_by_work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc_by_nc_work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc_by_sa_work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "spdx_mit": "spdx license identifier mit",
    "spdx_apache": "spdx license identifier apache 2 0",
    "spdx_gpl_3": "spdx license identifier gpl 3 0 or later",
    "spdx_gpl_2": "spdx license identifier gpl 2 0 or later",
    "spdx_bsd_3": "spdx license identifier bsd 3 clause",
}

# Rules in the order in which they are tried; identifiers must follow one another.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is", "mit_liability")),
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("ISC", ("isc_title", "isc_grant")),
    ("ISC", ("isc_grant",)),
    ("Apache-2.0", ("apache_licensed_the", "apache_may_not", "apache_obtain", "apache_url", "apache_as_is", "apache_see")),
    ("Apache-2.0", ("apache_licensed_the", "apache_may_not", "apache_obtain")),
    ("Apache-2.0", ("apache_licensed_the", "apache_may_not")),
    ("Apache-2.0", ("apache_licensed",)),
    ("GPL-3.0-or-later", ("gpl_free_software_3", "gpl_hope", "gpl_details")),
    ("GPL-3.0-or-later", ("gpl_free_software_3",)),
    ("GPL-3.0-or-later", ("gpl_free_software", "gpl_redistribute_3")),
    ("GPL-2.0-or-later", ("gpl_free_software_2", "gpl_hope", "gpl_details")),
    ("GPL-2.0-or-later", ("gpl_free_software_2",)),
    ("GPL-2.0-or-later", ("gpl_free_software", "gpl_redistribute_2")),
    ("LGPL-3.0-or-later", ("gpl_free_software", "lgpl_redistribute_3")),
    ("AGPL-3.0-or-later", ("gpl_free_software", "agpl_redistribute_3")),
    ("GPL-3.0-only", ("gpl_licensed_3",)),
    ("GPL-2.0-only", ("gpl_licensed_2",)),
    ("MPL-2.0", ("mpl_subject", "mpl_copy")),
    ("MPL-2.0", ("mpl_subject",)),
    ("Unlicense", ("unlicense_public",)),
    ("CC-BY-NC-4.0", ("cc_by_nc",)),
    ("CC-BY-4.0", ("cc_by",)),
    ("CC-BY-SA-4.0", ("cc_by_sa",)),
    ("CC-BY-4.0", ("cc_by_work",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_work",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_work",)),
    ("MIT", ("spdx_mit",)),
    ("Apache-2.0", ("spdx_apache",)),
    ("GPL-3.0-or-later", ("spdx_gpl_3",)),
    ("GPL-2.0-or-later", ("spdx_gpl_2",)),
    ("BSD-3-Clause", ("spdx_bsd_3",)),
    ("MIT", ("mit_title_paren",)),
    ("MIT", ("mit_title",)),
    ("MIT", ("mit_title_short",)),
    ("MIT", ("mit_released",)),
    ("MIT", ("mit_licensed",)),
    ("MIT", ("mit_project",)),
]

#: Sentence ends when a line end is one, and when only an empty line is one.
LINES = "[.;:!?]+[ \\t\\r\\n]+|[ \\t\\r]*\\n[ \\t\\r\\n]*"
PARAGRAPHS = "[.;:!?]+[ \\t\\r\\n]+|\\n[ \\t\\r]*\\n[ \\t\\r\\n]*"
GAP = "."
#: The stop of an abbreviated version, and what is left of a list mark.
VERSION_STOP = "(?<![a-z0-9_])v\\.(?=[ \\t\\r\\n]+[0-9])"
LIST_MARK = "^([0-9]+( [0-9]+)*|[a-z]|[ivx]+)$"
_FIRST = 0xE000  # private-use code points stand for sentence identifiers


def _codes(sentences: dict[str, str]) -> dict[str, str]:
    return {name: chr(_FIRST + k) for k, name in enumerate(sentences)}


def _normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(sentence, "[^a-z0-9]+", " "))


def identifiers(text: Column, ends: str, sentences: dict[str, str]) -> Column:
    """The text's sentences as one string: a code point per known sentence, ``GAP`` per other one, nothing per list mark."""
    codes = _codes(sentences)
    known = F.create_map(*[F.lit(x) for name, s in sentences.items() for x in (s, codes[name])])
    cut = F.filter(F.split(F.regexp_replace(F.lower(text), VERSION_STOP, "v"), ends), lambda s: F.length(s) > 0)
    return F.array_join(F.transform(F.transform(cut, _normalised), lambda s: F.coalesce(
        F.element_at(known, s), F.when(F.rlike(s, F.lit(LIST_MARK)), F.lit("")).otherwise(F.lit(GAP)))), "")


def anchors(sentences: dict[str, str]) -> list[str]:
    """Few words such that every known sentence holds one of them.

    Normalising keeps runs of letters and digits whole, so a text without any
    of these words (as substrings) has no known sentence.
    """
    left, out = [set(s.split()) for s in sentences.values()], []
    while left:
        counts: dict[str, int] = {}
        for words in left:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
        best = max(counts, key=lambda w: (counts[w] * len(w), w))
        out.append(best)
        left = [words for words in left if best not in words]
    return out


def matches(sequence: Column, sentences: dict[str, str], rules: list[tuple[str, tuple[str, ...]]]) -> Column:
    """Array of licences whose rules match, in order of occurrence."""
    codes = _codes(sentences)
    strings = ["".join(codes[name] for name in names) for _, names in rules]
    if not strings:
        return F.array().cast("array<string>")
    to_license = F.create_map(*[F.lit(x) for s, lic in {s: lic for s, (lic, _) in reversed(list(zip(strings, rules)))}.items()
                                for x in (s, lic)])
    found = F.regexp_extract_all(sequence, F.lit(f"({'|'.join(strings)})"), F.lit(1))
    return F.transform(found, lambda s: F.element_at(to_license, s))


def scan(docs: DataFrame, text: str = "text", sentences: dict[str, str] = SENTENCES,
         rules: list[tuple[str, tuple[str, ...]]] = RULES) -> DataFrame:
    """Add license_n_known (known sentences of the line reading) and licenses (sorted, distinct, comma-joined)."""
    lower = F.lower(F.col(text))
    maybe = reduce(Column.__or__, (F.contains(lower, F.lit(w)) for w in anchors(sentences)), F.lit(False))
    out = docs.withColumns({name: F.when(maybe, identifiers(F.col(text), ends, sentences)).otherwise("")
                            for name, ends in (("license_lines", LINES), ("license_paragraphs", PARAGRAPHS))})
    found = reduce(F.concat, (matches(F.col(c), sentences, rules) for c in ("license_lines", "license_paragraphs")))
    return out.withColumns({
        "license_n_known": F.length(F.replace("license_lines", F.lit(GAP), F.lit(""))).cast("long"),
        "licenses": F.array_join(F.array_sort(F.array_distinct(found)), ","),
    }).drop("license_lines", "license_paragraphs")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).select("doc_id", F.col("license_n_known").alias("n_known"), "licenses")


def _oracle() -> str:
    codes = _codes(SENTENCES)
    known = ", ".join(f"('{s}', '{codes[name]}')" for name, s in SENTENCES.items())
    rules = [("".join(codes[n] for n in names), lic) for lic, names in RULES]
    by_rule = ", ".join(f"('{s}', '{lic}')" for s, lic in rules)
    pattern = "|".join(s for s, _ in rules)
    return f"""
WITH known(s, code) AS (VALUES {known}), rule(s, lic) AS (VALUES {by_rule}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
low AS (SELECT r, regexp_replace(lower(text), '\\bv\\.([ \\t\\r\\n]+[0-9])', 'v\\1', 'g') AS t FROM d),
cut AS (
  SELECT r, kind, unnest(parts) AS s, generate_subscripts(parts, 1) AS i FROM (
    SELECT r, 'l' AS kind, regexp_split_to_array(t, '{LINES}') AS parts FROM low
    UNION ALL SELECT r, 'p', regexp_split_to_array(t, '{PARAGRAPHS}') FROM low)),
coded AS (
  SELECT r, kind, string_agg(coalesce(code, CASE WHEN regexp_matches(c.n, '{LIST_MARK}') THEN '' ELSE '{GAP}' END), '' ORDER BY i) AS seq
  FROM (SELECT r, kind, i, trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) AS n FROM cut WHERE s <> '') c
  LEFT JOIN known ON known.s = c.n GROUP BY r, kind),
hit AS (
  SELECT r, string_agg(DISTINCT lic, ',' ORDER BY lic) AS licenses
  FROM (SELECT r, unnest(regexp_extract_all(seq, '{pattern}')) AS s FROM coded) JOIN rule USING (s) GROUP BY r)
SELECT d.doc_id, coalesce(length(replace(seq, '{GAP}', '')), 0)::BIGINT AS n_known, coalesce(licenses, '') AS licenses
FROM d LEFT JOIN (SELECT * FROM coded WHERE kind = 'l') USING (r) LEFT JOIN hit USING (r)
"""


ORACLE = _oracle()
