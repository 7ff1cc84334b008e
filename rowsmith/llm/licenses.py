"""Licence scans by sentence rules.

Known licence sentences are looked for in a text, case and everything between words aside, and what
remains of the text is the sequence of identifiers found. Ordered rules are matched against that
sequence. Everything is one projection over the scan: no shuffle, no Python, and a text without any
word that a known sentence needs is not searched at all.

Sentences end at end marks and at lines without a word, so a line break with its comment mark is a
blank. A known sentence may also begin or end at any line break, colon or semicolon, as one-line
notices and list heads do; of two that begin at the same place the longer one counts.

Defined cases: a null or empty text has no sentences and no licence. Sentences that are not known may
stand between two of a rule, up to ``MAX_GAP`` of them; a wider gap breaks the sequence. A rule is
reported if it matches at some place where it is not part of a longer rule's match. Rows are neither
joined nor grouped, so null, repeated and tied ids change nothing, and further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import whole_text

# Sentences of public licences and notices, normalised (lower case, one blank between words).
SENTENCES = (
    "licensed under the apache license version 2 0",
    "released under the mit license",
    "licensed under the mit license",
    "this work is licensed under the gnu general public license version 3",
    "licensed under cc by nc 4 0",
    "licensed under cc by 4 0",
    "licensed under cc by sa 4 0",
    "licensed under the apache license version 2 0 the license",
    "you may not use this file except in compliance with the license",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "see the license for the specific language governing permissions and limitations under the license",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "see the gnu general public license for more details",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
)
# Rule, licence, and the sentence numbers (from 1) that follow one another.
RULES = (
    ("apache-short", "Apache-2.0", (1,)),
    ("mit-released", "MIT", (2,)),
    ("mit-short", "MIT", (3,)),
    ("gpl3-short", "GPL-3.0", (4,)),
    ("ccbync-short", "CC-BY-NC-4.0", (5,)),
    ("ccby-short", "CC-BY-4.0", (6,)),
    ("ccbysa-short", "CC-BY-SA-4.0", (7,)),
    ("apache-header", "Apache-2.0", (8, 9, 10, 11)),
    ("mit-text", "MIT", (12, 13, 14)),
    ("mit-grant", "MIT", (12, 13)),
    ("gpl3-notice", "GPL-3.0-or-later", (15, 16, 17)),
    ("gpl3-notice-short", "GPL-3.0-or-later", (15, 16)),
    ("bsd3-text", "BSD-3-Clause", (18, 19, 20, 21)),
    ("bsd2-text", "BSD-2-Clause", (18, 19, 20)),
    ("isc-grant", "ISC", (22,)),
)
# What the SQL of this query knows: the sentences and rules above.
SQL_SENTENCES, SQL_RULES = SENTENCES, RULES
# Rule, licence and one sentence that is enough for it: notices, and the headings of whole texts.
SINGLE = (
    ("apache-full", "Apache-2.0", "apache license version 2 0 january 2004"),
    ("gpl3-full", "GPL-3.0", "gnu general public license version 3 29 june 2007"),
    ("gpl2-full", "GPL-2.0", "gnu general public license version 2 june 1991"),
    ("lgpl3-full", "LGPL-3.0", "gnu lesser general public license version 3 29 june 2007"),
    ("lgpl21-full", "LGPL-2.1", "gnu lesser general public license version 2 1 february 1999"),
    ("agpl3-full", "AGPL-3.0", "gnu affero general public license version 3 19 november 2007"),
    ("mpl2-full", "MPL-2.0", "mozilla public license version 2 0"),
    ("epl2-full", "EPL-2.0", "eclipse public license v 2 0"),
    ("epl1-full", "EPL-1.0", "eclipse public license v 1 0"),
    ("cc0-full", "CC0-1.0", "cc0 1 0 universal"),
    ("gpl2-notice", "GPL-2.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl2-only-notice", "GPL-2.0-only", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("lgpl3-notice", "LGPL-3.0-or-later", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl21-notice", "LGPL-2.1-or-later", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("agpl3-notice", "AGPL-3.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("mpl2-notice", "MPL-2.0", "this source code form is subject to the terms of the mozilla public license v"),  # the text goes on with '. 2.0'
    ("epl2-notice", "EPL-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("unlicense", "Unlicense", "this is free and unencumbered software released into the public domain"),
)
# Tags 'SPDX-License-Identifier: X' of one licence.
SPDX = (
    "Apache-2.0", "MIT", "ISC", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "EPL-1.0", "EPL-2.0",
    *(f"{x}{end}" for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for end in ("", "-only", "-or-later")),
)
SINGLE += tuple((f"spdx-{x.lower()}", x, "spdx license identifier " + x.lower().replace("-", " ").replace(".", " ")) for x in SPDX)
RULES += tuple((name, licence, (i,)) for i, (name, licence, _) in enumerate(SINGLE, len(SENTENCES) + 1))
SENTENCES += tuple(s for _, _, s in SINGLE)
# Every known sentence holds one of these.
ANCHORS = ("licens", "copyright", "software", "warrant", "permission", "redistribut", "cc0")
MAX_GAP = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Where the SQL of this query splits; it takes texts whose sentences are on one line each.
BREAK = r"[.!?]+[ \t\r\n\f\x0b]+|\n+"
# What ends a sentence: end marks before a blank, or lines without a word. Capitals are free as marks, texts are in lower case.
# No place is tried twice and no group recurses, so long runs of marks or empty lines cost linear time.
END = r"(?<![.!?])[.!?]++[ \t\r\n\f\x0b]++|\n(?:[^\p{L}\p{N}\n]*+\n)++"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(sentence, "[^a-z0-9]+", " "))


def known_pattern(sentences: tuple[str, ...]) -> str:
    """A known sentence between two places where one may begin or end; ``H`` stands for an END."""
    one_of = "|".join(s.replace(" ", "[^a-z0-9H]++") for s in sorted(sentences, key=len, reverse=True))
    begin = r"(?:(?<![^H])|(?<=[a-z0-9])(?=[^a-z0-9H\n;:]*+[\n;:]))[^a-z0-9H]*+"
    return rf"{begin}({one_of})(?=[^a-z0-9H\n;:]*+(?:[H\n;:]|$))"


def anchors_of(sentences: tuple[str, ...]) -> tuple[str, ...]:
    """ANCHORS, and the longest word of each sentence that holds none of them."""
    return ANCHORS + tuple(sorted({max(s.split(), key=len) for s in sentences if not any(a in s for a in ANCHORS)}))


def identifier_sequence(text: Column, sentences: tuple[str, ...] = SENTENCES, max_gap: int = MAX_GAP) -> Column:
    """Numbers of the known sentences in order, like ``,12,13,0,2,``; 0 marks a gap that is too wide."""
    low = F.translate(text, UPPER, LOWER)
    known = F.array(*(F.lit(s) for s in sentences))
    marked = F.regexp_replace(F.regexp_replace(low, END, "H"), known_pattern(sentences), "HK$1H")
    pieces = F.filter(F.split(marked, "H", -1), lambda s: F.rlike(s, F.lit(r"[\p{L}\p{N}]")))
    numbers = F.transform(pieces, lambda s: F.when(F.startswith(s, F.lit("K")), F.array_position(known, normalised(s)).cast("int")))
    hits = F.filter(F.transform(numbers, lambda n, i: F.struct(i.alias("at"), n.alias("n"))), lambda h: h["n"] > 0)
    # A hit further than the gap from the one before is preceded by a 0.
    spelled = F.aggregate(
        hits,
        F.struct(F.lit(",").alias("s"), F.lit(-1).alias("at")),
        lambda seen, h: F.struct(
            F.concat(seen["s"], F.when((seen["at"] >= 0) & (h["at"] - seen["at"] > max_gap + 1), "0,").otherwise(""), h["n"].cast("string"), F.lit(",")).alias("s"),
            h["at"].alias("at"),
        ),
        lambda seen: seen["s"],
    )
    anchored = F.lit(False)
    for word in anchors_of(sentences):
        anchored = anchored | F.contains(low, F.lit(word))
    return F.when(anchored, spelled).otherwise(F.lit(","))


def _spelled(numbers: tuple[int, ...]) -> str:
    return "," + ",".join(map(str, numbers)) + ","


def _free(numbers: tuple[int, ...], rules: tuple) -> str:
    """A pattern of these numbers where they are not part of a longer rule's numbers."""
    own = ",".join(map(str, numbers)) + ","
    inside = ""
    for _, _, longer in rules:
        if len(longer) > len(numbers):
            for i in range(len(longer) - len(numbers) + 1):
                if longer[i : i + len(numbers)] == numbers:
                    before, after = _spelled(longer[:i]) if i else ",", "".join(f"{n}," for n in longer[i + len(numbers) :])
                    inside += f"(?!(?<={before}){own}{after})"
    return f"(?<=,){inside}{own}"


def matched_rules(sequence: Column, rules: tuple = RULES) -> Column:
    """Names of the rules whose numbers stand in the sequence somewhere outside a longer rule's numbers."""
    return F.array_compact(F.array(*(F.when(F.rlike(sequence, F.lit(_free(numbers, rules))), F.lit(name)) for name, _, numbers in rules)))


def scan(docs: DataFrame, rules: tuple = RULES, sentences: tuple[str, ...] = SENTENCES) -> DataFrame:
    """``doc_id, sentence_ids, rules, licenses, n_licenses`` of every document; ``sentences`` are normalised."""
    licence_of = F.create_map(*(F.lit(x) for name, licence, _ in rules for x in (name, licence)))
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), identifier_sequence(whole_text(), sentences).alias("seq"))
    found = found.select("doc_id", "seq", matched_rules(F.col("seq"), rules).alias("named"))
    licences = F.array_sort(F.array_distinct(F.transform("named", lambda n: licence_of[n])))
    return found.select(
        "doc_id", F.trim(F.col("seq"), F.lit(",")).alias("sentence_ids"), F.array_join("named", ",").alias("rules"),
        F.array_join(licences, ",").alias("licenses"), F.size(licences).cast("bigint").alias("n_licenses"),
    )


def oracle() -> str:
    """The same as SQL, for SQL_RULES: sentences as rows, gaps by a window, rules by joins."""
    quoted = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SQL_SENTENCES, 1))
    rules = ", ".join(f"({k}, '{n}', '{c}', '{_spelled(x)}', {len(x)})" for k, (n, c, x) in enumerate(SQL_RULES))
    return rf"""
    WITH known(n, s) AS (VALUES {quoted}),
    rules(k, name, licence, seq, len) AS (VALUES {rules}),
    split AS (SELECT doc_id, string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BREAK}') AS l FROM documents),
    sentences AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS pos FROM split),
    hits AS (
      SELECT doc_id, pos, n, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS gap
      FROM sentences JOIN known ON known.s = trim(regexp_replace(sentences.s, '[^a-z0-9]+', ' ', 'g'))),
    seqs AS (
      SELECT doc_id, ',' || string_agg(CASE WHEN gap > {MAX_GAP + 1} THEN '0,' ELSE '' END || n, ',' ORDER BY pos) || ',' AS seq
      FROM hits GROUP BY doc_id),
    found AS (SELECT doc_id, k, name, licence, rules.seq, len FROM seqs JOIN rules ON contains(seqs.seq, rules.seq)),
    best AS (
      SELECT doc_id, k, name, licence FROM found f
      WHERE NOT EXISTS (SELECT 1 FROM found g WHERE g.doc_id = f.doc_id AND g.len > f.len AND contains(g.seq, f.seq))),
    named AS (
      SELECT doc_id, string_agg(name, ',' ORDER BY k) AS rules, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licenses,
             count(DISTINCT licence) AS n_licenses
      FROM best GROUP BY doc_id)
    SELECT d.doc_id, coalesce(trim(s.seq, ','), '') AS sentence_ids, coalesce(n.rules, '') AS rules,
           coalesce(n.licenses, '') AS licenses, coalesce(n.n_licenses, 0) AS n_licenses
    FROM documents d LEFT JOIN seqs s ON s.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id
    """
