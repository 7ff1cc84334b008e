import textwrap
from datetime import datetime

from rowsmith.llm import licenses, url_filter


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r["doc_id"]: (r["sentence_ids"], r["rules"], r["licenses"]) for r in licenses.scan(df).collect()}


def test_every_sentence_has_an_anchor():
    assert all(any(a in s for a in licenses.ANCHORS) for s in licenses.SENTENCES)


def test_rules(spark):
    s = licenses.SENTENCES
    found = scan(
        spark,
        [
            "Prose.\nLicensed under the Apache License, Version 2.0.",
            "RELEASED UNDER THE MIT LICENSE! More. Licensed under CC BY-NC 4.0.",
            ". ".join(s[17:21]),  # three-clause text: the two-clause rule is part of it
            ". ".join(s[17:20]),
            ". ".join([s[11], "One", "Two", s[12], s[13]]),  # two unknown sentences in between
            ". ".join([s[11], "One", "Two", "Three", s[12], s[13]]),  # too many
            None,
            "",
            "the license of nothing known",
            ". ".join([s[14], s[15]]) + "\n" + "x " * 50_000,
        ],
    )
    assert found[0] == ("1", "apache-short", "Apache-2.0")
    assert found[1] == ("2,5", "mit-released,ccbync-short", "CC-BY-NC-4.0,MIT")
    assert found[2] == ("18,19,20,21", "bsd3-text", "BSD-3-Clause")
    assert found[3] == ("18,19,20", "bsd2-text", "BSD-2-Clause")
    assert found[4] == ("12,13,14", "mit-text", "MIT")
    assert found[5] == ("12,0,13,14", "", "")
    assert found[6] == found[7] == found[8] == ("", "", "")
    assert found[9] == ("15,16", "gpl3-notice-short", "GPL-3.0-or-later")


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL ...
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD2 = BSD3[: BSD3.index("3. ")]
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
WRAPPED = [
    (MIT, "12,13,14", "mit-text", "MIT"),
    (APACHE, "8,9,10,11", "apache-header", "Apache-2.0"),
    (GPL3, "15,16,17", "gpl3-notice", "GPL-3.0-or-later"),
    (BSD3, "18,19,20,21", "bsd3-text", "BSD-3-Clause"),
    (BSD2, "18,19,20", "bsd2-text", "BSD-2-Clause"),
    (ISC, "22", "isc-grant", "ISC"),
]


def commented(text, mark, first="", last=""):
    return first + "".join(f"{mark}{line}".rstrip() + "\n" for line in text.splitlines()) + last


def test_wrapped_and_commented_texts(spark):
    ways = [
        lambda t: t,
        lambda t: commented(t, "# ", "#!/bin/sh\n"),
        lambda t: commented(t, " * ", "/*\n", " */\nint main() { return 0; }\n"),
        lambda t: commented(t, "// ").replace("\n", "\r\n"),
        lambda t: "Copyright 2020 A. Person\n" + t,  # no end mark before
        lambda t: "\n\n".join(textwrap.fill(p, 40) for p in t.split("\n\n")),
        lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),  # not wrapped
    ]
    found = scan(spark, [way(text) for way in ways for text, *_ in WRAPPED])
    assert list(found.values()) == [tuple(expected) for _ in ways for _, *expected in WRAPPED]


def test_sentences_and_line_breaks(spark):
    s = licenses.SENTENCES
    wrapped = "Some words of\na long sentence\nover many lines\nof the file. "
    found = scan(
        spark,
        [
            "words without an end\nReleased under the MIT License\nand further words",
            "Released under\n\nthe MIT License.",  # a blank line ends a sentence
            "Released under\n#\n# the MIT License.",
            "words Released under the MIT License.",
            f"{s[11]}. {wrapped}{wrapped}{s[12]}.",
            f"{s[11]}. {wrapped}{wrapped}{wrapped}{s[12]}.",
            f"{s[11]}.\n日本\n\n日本\n\n日本\n\n{s[12]}.",
            f"{s[11]}.\n---\n***\n\n+++\n{s[12]}.",
        ],
    )
    assert [r[0] for r in found.values()] == ["2", "", "", "", "12,13", "12,0,13", "12,0,13", "12,13"]


def test_part_of_a_longer_rule_elsewhere(spark):
    other = "One. Two. Three.\n\n"
    found = scan(spark, [BSD3 + other + BSD2, BSD2 + other + BSD3, BSD3 + other + BSD3, BSD3 + BSD2, BSD3 + BSD3, GPL3 + other + GPL3[: GPL3.index("See")]])
    assert [r[1:] for r in found.values()] == [
        ("bsd3-text,bsd2-text", "BSD-2-Clause,BSD-3-Clause"),
        ("bsd3-text,bsd2-text", "BSD-2-Clause,BSD-3-Clause"),
        ("bsd3-text", "BSD-3-Clause"),
        ("bsd3-text,bsd2-text", "BSD-2-Clause,BSD-3-Clause"),
        ("bsd3-text", "BSD-3-Clause"),
        ("gpl3-notice,gpl3-notice-short", "GPL-3.0-or-later"),
    ]


def test_places_of_rules(spark):
    rules = (("a", "A", (1, 2, 1)), ("b", "B", (1, 2)), ("c", "C", (2,)), ("d", "D", (2, 1)), ("e", "E", (1,)))
    expected = {
        ",1,2,1,": ["a"],
        ",1,2,1,2,1,": ["a"],  # overlapping matches of the longer rule
        ",1,2,1,2,": ["a", "b"],
        ",2,1,0,1,2,1,": ["a", "d"],
        ",2,0,11,12,": ["c"],
        ",1,2,0,1,": ["b", "e"],
        ",": [],
    }
    df = spark.createDataFrame([(s,) for s in expected], "s string")
    assert {r["s"]: r["n"] for r in df.select("s", licenses.matched_rules(df["s"], rules).alias("n")).collect()} == expected


def test_more_licences(spark):
    texts = {
        "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n": "Apache-2.0",
        "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright": "GPL-2.0",
        "                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n": "LGPL-3.0",
        commented(GPL3.replace("version 3", "version 2"), " * ", "/*\n", " */\n"): "GPL-2.0-or-later",
        commented(GPL3.replace("GNU General", "GNU Affero General"), "# "): "AGPL-3.0-or-later",
        "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\n": "MPL-2.0",
        "This is free and unencumbered software released into the public domain.\n": "Unlicense",
        "CC0 1.0 Universal\n\nStatement of Purpose": "CC0-1.0",
        "// SPDX-License-Identifier: GPL-2.0-or-later\nint x;\n": "GPL-2.0-or-later",
        "/* SPDX-License-Identifier: MIT */\nint x;\n": "MIT",
        "# SPDX-License-Identifier: LGPL-2.1-only\n": "LGPL-2.1-only",
    }
    assert [r[2] for r in scan(spark, list(texts)).values()] == list(texts.values())


def test_own_sentences(spark):
    df = spark.createDataFrame([(1, "Words. Use it\nas you like. End."), (2, "Released under the MIT License.")], "doc_id int, text string")
    found = licenses.scan(df, (("own", "Own-1.0", (1,)),), ("use it as you like",)).collect()
    assert {r["doc_id"]: (r["sentence_ids"], r["licenses"]) for r in found} == {1: ("1", "Own-1.0"), 2: ("", "")}


def test_long_runs(spark):
    long = ["\n" * 300_000, "#\n" * 150_000, "." * 300_000, ":;" * 150_000, "日\n" * 150_000, "a\n" * 150_000]
    found = scan(spark, [f"Released under the MIT License.{run}\nThe license. Licensed under\nthe MIT License" for run in long])
    assert {r[2] for r in found.values()} == {"MIT"}


def test_cases(cases, nothing):
    assert licenses.scan(cases).count() == cases.count()
    assert licenses.scan(nothing).count() == 0


def day(n):
    return datetime(2020, 1, n)


ENTRIES = [
    ("domain", "Bad.example", "add", day(5)),
    ("domain", "bad.example", "add", day(5)),
    ("domain", "bad.example", "add", day(6)),
    ("domain", "bad.example", "remove", day(10)),
    ("domain", "bad.example", "remove", day(20)),
    ("domain", "bad.example", "add", day(20)),
    ("prefix", "good.example/ads", "add", day(3)),
    ("domain", None, "add", day(1)),
    ("domain", "good.example", "add", None),
    ("domain", "good.example", "allow", day(1)),
]


def judged(spark, rows, entries=ENTRIES):
    captures = spark.createDataFrame([(i, u, t, "x") for i, (u, t) in enumerate(rows)], "id int, url string, fetched_at timestamp, key string")
    listed = spark.createDataFrame(entries, "scope string, value string, action string, dated timestamp")
    out = url_filter.judge(captures, listed)
    assert out.columns == ["id", "url", "fetched_at", "key", "n_hits", "hits", "blocked"]
    return {r["id"]: (r["n_hits"], r["hits"], r["blocked"]) for r in out.collect()}


def test_as_of(spark):
    url = "https://user@www.BAD.example.:8080/a?b#c"
    yes, no = (1, "domain:bad.example", True), (0, "", False)
    got = judged(spark, [(url, day(4)), (url, day(5)), (url, day(9)), (url, day(10)), (url, day(20)), (url, day(25))])
    assert got == {0: no, 1: yes, 2: yes, 3: no, 4: no, 5: no}  # on day 20 the removal holds
    got = judged(
        spark,
        [
            ("http://good.example/ads", day(4)),
            ("http://good.example/ads/x?y", day(4)),
            ("http://good.example/adserver", day(4)),
            ("http://notbad.example/", day(6)),
            (None, day(6)),
            ("http://bad.example", None),
            ("", day(6)),
            ("nonsense", day(6)),
            ("http://bad.example", day(6)),
            ("http://bad.example", day(6)),
        ],
    )
    hit = (1, "prefix:good.example/ads", True)
    assert got == {0: hit, 1: hit, 2: no, 3: no, 4: no, 5: no, 6: no, 7: no, 8: yes, 9: yes}


def test_prefixes_with_capitals_and_slashes(spark):
    urls = [
        "http://site.org/Private/x", "http://SITE.org/Private", "http://site.org/private/x", "http://site.org/Private2",
        "http://ads.org/ads", "http://ads.org/ads/", "http://ads.org/ads/x?y", "http://ads.org//ads//y", "http://ads.org/adserver",
        "http://whole.org", "http://whole.org/?q", "http://whole.org/a/b", "http://www.whole.org/",
    ]
    entries = [
        ("prefix", "Site.org/Private", "add", day(2)),
        ("prefix", "site.org/Private/", "add", day(3)),  # the same entry
        ("prefix", "ads.org/ads/", "add", day(2)),
        ("prefix", "whole.org/", "add", day(2)),
    ]
    got = judged(spark, [(u, day(5)) for u in urls], entries)
    private, ads, whole, no = [(1, f"prefix:{k}", True) for k in ("site.org/Private", "ads.org/ads", "whole.org")] + [(0, "", False)]
    assert list(got[i] for i in range(len(urls))) == [private, private, no, no, ads, ads, ads, ads, no, whole, whole, whole, no]


def test_top_level_domain(spark):
    urls = ["http://a.zip/x", "http://a.b.ZIP", "http://zip/", "http://a.unzip", "http://zip.example/zip", "http://b.zip"]
    entries = [("domain", "zip", "add", day(2)), ("domain", "b.zip", "add", day(3))]
    got = judged(spark, [(u, day(5)) for u in urls] + [("http://a.zip/x", day(1))], entries)
    yes, no = (1, "domain:zip", True), (0, "", False)
    assert got == {0: yes, 1: (2, "domain:b.zip domain:zip", True), 2: yes, 3: no, 4: no, 5: (2, "domain:b.zip domain:zip", True), 6: no}


def test_hot_top_level_domain(spark):
    rows = [(f"http://h{i}.zip/p{i}", day(1 + i % 25)) for i in range(300)]
    got = judged(spark, rows, [("domain", "zip", "add", day(5)), ("domain", "zip", "remove", day(10))])
    assert all(got[i] == ((1, "domain:zip", True) if day(5) <= t < day(10) else (0, "", False)) for i, (_, t) in enumerate(rows))


def test_hot_domain_is_salted_alike(spark):
    rows = [(f"http://h{i % 3}.bad.example/p{i}", day(1 + i % 25)) for i in range(300)]
    got = judged(spark, rows)
    assert all(got[i][2] == (day(5) <= t < day(10)) for i, (_, t) in enumerate(rows))


def test_empty_list(spark):
    assert judged(spark, [("http://bad.example", day(6))], []) == {0: (0, "", False)}
    assert judged(spark, [], ENTRIES) == {}


def test_captures_with_names_of_the_result(spark):
    """Columns named like the result are replaced, others are kept; captures without URL or time are not blocked."""
    T = datetime(2024, 1, 1)
    captures = spark.createDataFrame(
        [(1, "http://a.org/x", T, 9, "old", True, "u"), (1, "http://a.org/x", T, 9, "old", True, "u"), (2, None, T, 1, "h", True, "v"),
         (3, "http://a.org/x", None, 1, "h", True, "v"), (4, "http://b.org/", T, 1, "h", True, "v")],
        "page_id int, url string, fetched_at timestamp, n_hits int, Hits string, blocked boolean, at_url string",
    )
    entries = spark.createDataFrame([("domain", "a.org", "add", T)], "scope string, value string, action string, dated timestamp")
    out = url_filter.judge(captures, entries)
    assert out.columns == ["page_id", "url", "fetched_at", "at_url", "n_hits", "hits", "blocked"]
    got = sorted((r["page_id"], r["at_url"], r["n_hits"], r["hits"], r["blocked"]) for r in out.collect())
    hit, none = (1, "u", 1, "domain:a.org", True), [(2, "v", 0, "", False), (3, "v", 0, "", False), (4, "v", 0, "", False)]
    assert got == [hit, hit, *none]
    assert url_filter.judge(captures.limit(0), entries).count() == 0
    assert url_filter.judge(captures, entries.limit(0)).where("blocked").count() == 0
