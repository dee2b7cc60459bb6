"""Cases in which an operator once did less than the whole job."""

import hashlib
import random

from sunfleet.llm import decontaminate, html_extract, license_scan, suffix_dedup

from .test_operators import brute_spans


def prose(r, n):
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 7))) for _ in range(n))


def test_crowded_anchors_send_no_text(spark, monkeypatch):
    r = random.Random(5)
    passage, most = prose(r, 50), 5
    texts = [f"{prose(r, 20)} {passage} {prose(r, 20)}" for _ in range(30)] + ["ab" * 300, passage[20:170], "short"]
    whole = suffix_dedup.compare_contexts

    def bounded(length):
        def run(batches):
            def seen():
                for batch in batches:
                    sizes = batch.column("anchor").value_counts().field("counts").to_pylist()
                    assert max(sizes, default=0) <= most, sizes
                    yield batch
            return whole(length)(seen())
        return run

    monkeypatch.setattr(suffix_dedup, "compare_contexts", bounded)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    spans = {x.id: x.spans for x in suffix_dedup.duplicate_spans(docs, most=most).collect()}
    want = brute_spans(list(enumerate(texts)), 100)
    for key, text in enumerate(texts):
        gone = {p for s in spans.get(key, ()) for p in range(s.low, s.high)}
        kept = bytes(b for p, b in enumerate(text.encode()) if p not in gone)
        assert (len(gone), hashlib.sha256(kept).hexdigest()) == (want[key][1], want[key][3]), key


def test_repeated_rows_keep_first_occurrences(spark):
    r = random.Random(6)
    passage = [prose(r, 50) for _ in range(4)]
    around = lambda k: f"{prose(r, 20)} {passage[k]} {prose(r, 20)}"
    texts = [(k, around(k % 4)) for k in range(12)] + [(2, around(1)), (None, around(0)), (None, around(2)), (None, prose(r, 60))]
    rows = texts + texts[:6] + texts[:3] + texts[-4:] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    parts = {(x.doc_id, x.text): x.part for x in docs.selectExpr("*", "pmod(xxhash64(text), 1073741824) as part").collect()}
    order = sorted(parts, key=lambda k: (k[0] is None, k[0] or 0, parts[k]))
    want = brute_spans([(k, k[1]) for k in order], 100)
    got = sorted((str(x.doc_id), x.n_bytes, x.n_removed, x.kept_sha256) for x in suffix_dedup.digests(docs).collect())
    assert got == sorted((str(k[0]), want[k][0], want[k][1], want[k][3]) for k in rows)


BSD = """Copyright (c) 2015, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the documentation.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER BE LIABLE FOR ANY DAMAGES."""
ENDORSE = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES."""
MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software, to deal in the Software without restriction, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM."""
GNU = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU {}General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY.  See the
GNU {}General Public License for more details."""


def test_wrapped_licences():
    def ids(text):
        found, names = license_scan.recognise(text)
        return [x.split(":")[0] for x in found], names

    bare = ["CopyrightLine", "AllRights", "BSDgrant", "BSDsource", "BSDbinary"]
    texts = [
        (BSD.format(""), [*bare, "AsIsProvided", "NoLiability"], "BSD-2-Clause"),
        (BSD.format(ENDORSE), [*bare, "BSDendorse", "AsIsProvided", "NoLiability"], "BSD-3-Clause"),
        (APACHE, ["CopyrightLine", "ApacheRef", "ApacheComply", "ApacheObtain", "ApacheAsIs", "ApacheSee"], "Apache-2.0"),
        (ISC, ["ISCgrant", "AsIsProvided"], "ISC"),
        (MIT, ["MITtitle", "CopyrightLine", "MITgrant", "MITnotice", "AsIsProvided", "NoLiability"], "MIT"),
        (GNU.format(":", "", ",", 3, ""), ["GPLrefPlus", "GNUsee"], "GPL-3-or-later"),
        (GNU.format(";", "", ";", 2, ""), ["GPLrefPlus", "GNUsee"], "GPL-2-or-later"),
        (GNU.format(":", "Lesser ", ",", 2.1, "Lesser "), ["LGPLrefPlus", "GNUsee"], "LGPL-2.1-or-later"),
        (GNU.format(":", "Affero ", ",", 3, "Affero "), ["AGPLrefPlus", "GNUsee"], "AGPL-3-or-later"),
    ]
    for text, want, name in texts:
        assert ids(text) == (want, [name])
        for mark in ("# ", "// ", " * ", "-- ", "; "):
            assert ids("\n".join(f"{mark}{line}".rstrip() for line in text.split("\n"))) == (want, [name]), (mark, name)
        assert ids("/*\n" + text + "\n*/")[1] == [name]
    assert ids("This project is licensed under the MIT License - see the LICENSE file for details.") == (["MITref"], ["MIT"])
    assert ids("This project is licensed under the MIT\nLicense - see the LICENSE file\nfor details.") == (["MITref"], ["MIT"])
    assert ids("Licensed under the MIT License\nCopyright 2020 Foo\nReleased into the public domain")[1] == ["MIT", "Public-Domain"]
    assert ids("The software is provided as is\nLicensed under the GNU GPL version 2\nor any later version")[1] == ["GPL-2-or-later"]


def test_leaks_among_null_and_repeated_ids(spark):
    r = random.Random(7)
    item = prose(r, 30)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    leak = lambda: f"{prose(r, 20)} {item} {prose(r, 9)}"
    clean = [(None, prose(r, 60)), (None, prose(r, 70)), (None, None), (4, prose(r, 60)), (5, prose(r, 50))]
    leaks = [(None, leak()), (4, leak()), (6, leak()), (6, leak())]
    docs = spark.createDataFrame(clean + leaks + clean[3:4] + leaks[:1], "doc_id long, text string").repartition(5)
    assert sorted(map(str, decontaminate.clean(docs, items).collect())) == sorted(map(str, spark.createDataFrame(clean + clean[3:4], docs.schema).collect()))
    found = decontaminate.matches(docs, items).collect()
    assert sorted((str(x.doc_id), x.similarity, x.start) for x in found) == [("4", 1.0, 20), ("6", 1.0, 20), ("None", 1.0, 20)]


def test_similar_pairs_beyond_fifteen_bits(spark):
    r = random.Random(8)
    item = prose(r, 50).split(" ")
    altered = [" ".join([*item[:p], w, *item[p + 1:]]) for p in range(4, 46) for w in ("other", "words", "here", "stand")]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(altered)), "doc_id long, text string")
    pairs = docs.selectExpr("doc_id", f"{decontaminate.WORDS.format(text='text')} as v", f"{decontaminate.WORDS.format(text=repr(' '.join(item)))} as w")
    for a, b in (("s", "v"), ("t", "w")):
        pairs = pairs.selectExpr("*", f"{decontaminate.weighted(b, '1', '46', 5)} as {a}")
    pairs = pairs.selectExpr("doc_id", f"bit_count({decontaminate.simhash('s')} ^ {decontaminate.simhash('t')}) as h", f"{decontaminate.shared_weight('s', 't')} as c", f"{decontaminate.total_weight('s')} + {decontaminate.total_weight('t')} as n")
    similar = {x.doc_id: x.h for x in pairs.filter("100 * c >= 80 * (n - c)").collect()}
    found = {x.doc_id for x in decontaminate.matches(docs, items).collect()}
    assert any(15 < h <= 19 for h in similar.values()) and {k for k, h in similar.items() if h <= 19} <= found <= set(similar)


def test_elements_without_an_end_hide_no_more_than_themselves():
    texts = lambda page: [b.text for b in html_extract.leaf_blocks(page)]
    for form in (
        "<datalist><option value=a><option value=b></datalist>", "<select><option>a<option>b</select>", "<button>Go", "<select><option>a<option>b",
        "<svg><path d=x>", "<iframe src=x>", "<datalist><option>a<option>b</datalist><select><option>c</option></select>", "<button>Go<button>Stop</button>",
    ):
        assert texts(f"<body><form>{form}</form><article><p>One text.</p></article><select><option>z</option></select><button>x</button>") == ["One text."], form
    assert texts("<body><canvas><article><p>One text.</p></article>") == ["One text."]
    assert texts("<html><head><title>No</title><meta charset=x><p>One text.<div>Two</div>") == ["One text.", "Two"]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> be <svg><text>no</text></svg>so.") == ["Let x=2 be so."]
    assert texts("<p>A <span><button>Go <b>on</b> now</span> text") == ["A text"]
    assert texts("<p>One</p><script>var t = '<p>'") == ["One"]


def test_words_around_an_article_say_nothing_about_it():
    labels = lambda page: html_extract.markup_labels(html_extract.leaf_blocks(page))
    page = "<body class='has-sidebar'><div id=header-search><article class=post><p>One</p><div class=share>x</div><section><article class=comment><p>c</p></article></section></article></div><p>out</p>"
    assert labels(page) == [1, 0, 0, 0]
    assert labels("<body class=menu><div itemprop=articleBody><p>One</p><nav>x</nav></div>") == [1, 0]
    assert labels("<body><p>One</p>") is None
