"""Fingerprints, Jaccard join, licences, toxicity and language against brute force and planted cases."""
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import edge
from edge import ROWS
from stratum.llm import fingerprint as fp, jaccard, langid, licences, queries, toxicity


# ------------------------------------------------------------------ fingerprints

def test_fingerprints_add_up():
    a, b = fp.vectors(["one line\nanother line here\nlast", "last\none line\nanother line here"])
    assert (a == b).all()
    assert (fp.insert(fp.vectors(["one line\nlast"])[0], "another line here") == a).all()
    assert (fp.delete(a, "last") == fp.vectors(["one line\nanother line here"])[0]).all()
    x = fp.vectors(["", "\n", "a", "b", "a a"])
    assert len({fp.digest(v) for v in x}) == 5
    assert fp.likeness(x[:1], x[:1])[0] == 1 and fp.likeness(x[2:3], x[3:4])[0] == 0


def test_likeness_follows_shared_part():
    rng = random.Random(1)
    w = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(900)]
    v = fp.vectors([" ".join(w[:600]), " ".join(w[:300] + w[600:]), " ".join(w[300:600] + w[600:] + w[:0])[::-1]])
    assert 0.4 < fp.likeness(v[:1], v[1:2])[0] < 0.6 and fp.likeness(v[:1], v[2:])[0] < 0.15


def compare(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, r in enumerate(rows):
        t, nxt = r[1] or "", rows[(i + 1) % len(rows)][1] or ""
        h = len(t) // 2
        e = t[:len(t) - h] + nxt[:h]
        v = fp.vectors([t, e, nxt])
        out.append((r[0], len(t), hashlib.sha256(e.encode()).hexdigest(), fp.digest(v[0]), fp.digest(v[1]),
                    round(float(fp.likeness(v[:1], v[1:2])[0]), 9), round(float(fp.likeness(v[:1], v[2:])[0]), 9)))
    return out


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], ROWS[1:3]], ids=["all", "one", "empty texts"])
def test_compare_next(spark, rows):
    got = fp.compare_next(edge.documents(spark, rows)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=key) == sorted(compare(rows), key=key)


def test_fingerprints_of_documents(spark, docs):
    got = {r.doc_id: r.fingerprint for r in fp.fingerprints(docs).collect()}
    assert got[1] == got[6] and got[2] == got[3] and got[1] != got[8]
    assert fp.compare_next(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ Jaccard join

def family(seed=3, copies=60):
    """A base text and copies with few to many changed words, copies of copies, and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows, base = [], [word() for _ in range(120)]
    passage = [word() for _ in range(60)]
    for i in range(copies):
        w = list(base if i % 3 else rows[-1][1].split() if rows else base)
        for _ in range(rng.choice([0, 1, 2, 4, 8, 20])):
            w[rng.randrange(len(w))] = word()
        rows.append((1000 + i, " ".join(w), "en", "src0"))
    for i in range(40):
        rows.append((2000 + i, " ".join(passage + [word() for _ in range(rng.randint(1, 300))]), "en", "src0"))
    for n in range(1, 25):  # short texts around every threshold
        rows += [(3000 + 2 * n, " ".join(base[:n]), "en", "src0"), (3001 + 2 * n, " ".join(base[:n - 1] + ["zz"]), "en", "src0")]
    return rows


@pytest.mark.parametrize("k,num,den", [(3, 9, 10), (5, 4, 5), (1, 1, 2)])
def test_jaccard_equals_all_pairs(spark, monkeypatch, k, num, den):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rows = family() + [r for r in ROWS if r[0] is not None]
    sets = {d: edge.shingle_set(t, k) for d, t, *_ in rows}
    want = edge.components(sets, num, den)
    got = jaccard.join(edge.documents(spark, rows), k, num, den).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {d: (len(s), want[d]) for d, s in sets.items()}


def test_jaccard_null_ids_and_empty(spark, docs):
    got = jaccard.join(docs, 3, 9, 10).collect()
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(3, None)]
    assert {r.component_id for r in got if r.doc_id in (1, 6, 12)} == {1}
    assert jaccard.join(docs.limit(0), 3, 9, 10).count() == 0


@pytest.mark.parametrize("num,den", [(9, 10), (4, 5), (1, 2)])
def test_allocation_covers_the_gap(num, den):
    """What is left of the segments' budget, after all that may be left out, exceeds the possible difference."""
    bands = jaccard.Bands(num, den, 5000)
    sizes = np.arange(1, 5001)
    band = bands.of(sizes)
    early, late = bands.budget(sizes, band)
    whole = bands.eq[band] + 2 * bands.near[band]
    assert (whole - np.minimum(early + late, bands.eq[band]) >= bands.gap(sizes) + 1).all()
    assert (bands.eq[band] - early - late >= 0).all()
    for a in range(1, 300):  # linked sizes lie in one band or in neighbours that the smaller set is indexed in
        b = np.arange(a, a * den // num + 1)
        step = bands.of(b) - bands.of(np.array([a]))
        assert (step <= 1).all() and (~(step == 1) | bands.meets_next(np.full(len(b), a), bands.of(np.full(len(b), a)))).all()


@pytest.mark.parametrize("num,den,low,high", [(9, 10, 33, 38), (4, 5, 12, 19)])
def test_jaccard_links_isolated_pairs(spark, num, den, low, high):
    """Pairs of short texts as different as they may be, their sizes on both sides of a step of the late count."""
    rows = []
    for a in range(low, high + 1):
        for b in range(a, high + 1):
            both = -(-num * (a + b) // (num + den))
            for _ in range(300 if both <= a else 0):
                i = len(rows)
                w = [f"w{i}x{j}" for j in range(a + b - both)]
                rows += [(i, " ".join(w[:a])), (i + 1, " ".join(w[a - both:]))]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), 1, num, den).collect()
    assert len(got) == len(rows) and [r.doc_id for r in got if r.component_id != r.doc_id - r.doc_id % 2] == []


def test_intersections():
    rng = np.random.default_rng(0)
    x, y = ([np.unique(rng.integers(0, 60, n)) for n in sizes] for sizes in ((5, 40, 0, 9), (50, 3, 20)))
    assert jaccard.intersections(x, y, cells=20).tolist() == [[len(set(a) & set(b)) for b in y] for a in x]


def test_jaccard_signatures_are_not_stored(spark, monkeypatch):
    """The table of all documents holds a digest a row; of the signatures only those of two sets or more are written."""
    written, keep = {}, jaccard.stored

    def kept(df, name):
        written[name] = keep(df, name)
        return written[name]

    monkeypatch.setattr(jaccard, "stored", kept)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(80))) for i in range(40)] + [(40, " ".join(f"w7x{j}" for j in range(79)))]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 9, 10).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: 7 if i == 40 else i for i in range(41)}
    assert written["jaccard-index"].dtypes == [("doc_id", "bigint"), ("n", "bigint"), ("node", "bigint")]
    assert written["jaccard-shared"].select("rid").distinct().count() == 2


# ------------------------------------------------------------------ licences

def test_licence_rules(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nx"),
            (2, "Released under the MIT License. All rights reserved."), (3, "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: MIT"),
            (4, "See the GNU General Public License for more details."), (5, None), (6, ""), (7, "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3.")]
    got = {r.doc_id: (r.licences, r.unmatched) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("licences", F.lit(1)).withColumn("_seq", F.lit(2))).collect()}
    assert got == {1: (["Apache-2.0"], 0), 2: (["All-rights-reserved", "MIT"], 0), 3: (["MIT"], 0), 4: ([], 1), 5: ([], 0), 6: ([], 0), 7: (["GPL-3.0"], 0)}


def test_every_known_sentence_has_an_anchor_and_is_found(spark):
    rows = [(i, s.upper() + ".") for i, s in enumerate(licences.SENTENCES)]
    got = {r.doc_id: r.sentence_ids for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == [[v] for v in licences.SENTENCES.values()]
    assert {x for _, ids in licences.RULES for x in ids} <= set(licences.SENTENCES.values())


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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission."""
GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful. See the
GNU General Public License for more details."""


def test_licences_of_wrapped_headers(spark):
    want = {MIT: "MIT", BSD: "BSD-3-Clause", GPL: "GPL-3.0-or-later", GPL.replace("version 3", "version 2"): "GPL-2.0-or-later"}
    rows, names = [], []
    for text, name in want.items():
        lines = text.split("\n")
        for t in (text, text.replace("\n", "\r\n"), "int a;\n/*\n" + "\n".join(" * " + x for x in lines) + "\n */\nint b;",
                  "\n".join(("# " + x).rstrip() for x in lines), "\n".join("!! " + x for x in lines), "\n".join("dnl " + x for x in lines)):
            rows.append((len(rows), t))
            names.append([name])
    # a notice of one line stays one beside other lines; blank lines and ends of sentences are not run over
    rows += [(len(rows), "SPDX-License-Identifier: MIT\nimport os"), (len(rows) + 1, "Licensed under\n#\n# the MIT License"), (len(rows) + 2, "All rights. Reserved")]
    names += [["MIT"], [], []]
    got = {r.doc_id: (r.licences, r.unmatched) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == [(n, 0) for n in names]


LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details."""
EPL = """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/"""
ZERO = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
ISC = ZERO.replace("is hereby granted.", "is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.")


def test_licences_of_more_families(spark):
    lettered = BSD.replace("1. ", "a) ").replace("2. ", "b) ").replace("3. ", "(c) ")
    agpl = GPL.replace("General Public License", "Affero General Public License")
    cases = [(LGPL, ["LGPL-2.1-or-later"]), (EPL, ["EPL-2.0"]), (ZERO, ["0BSD"]), (ISC, ["ISC"]), (agpl, ["AGPL-3.0-or-later"]), (lettered, ["BSD-3-Clause"]),
             ("License: Apache License, Version 2.0", ["Apache-2.0"]), ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
             ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
             ("# SPDX-License-Identifier: BSD-3-Clause\nimport os", ["BSD-3-Clause"]), ("// SPDX-License-Identifier: GPL-3.0-only", ["GPL-3.0-only"]),
             ("/* SPDX-License-Identifier: GPL-3.0-or-later */", ["GPL-3.0-or-later"]), ("SPDX-License-Identifier: Apache-2.0 OR MIT", ["Apache-2.0", "MIT"]),
             ("SPDX-License-Identifier: (GPL-3.0-or-later OR MIT) AND BSD-2-Clause\nor ISC", ["BSD-2-Clause", "GPL-3.0-or-later", "MIT"]),
             ("SPDX-License-Identifier: MIT or else", []), ("MIT OR Apache-2.0", [])]
    got = {r.i: r.licences for r in licences.scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, text string")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_licences_of_edge_documents(docs):
    out = licences.scan(docs)
    assert out.count() == len(ROWS) and set(docs.columns) <= set(out.columns)
    assert licences.scan(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ toxicity

def labelled(n=400, seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioubdfg") for _ in range(rng.randint(2, 6)))
    rows, labels = [], []
    for i in range(n):
        w = [word() for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(["stupid", "idiot"]) if i % 2 else "zorkle" + word()
        rows.append((i, " ".join(w), "en", "src0"))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_finds_words_and_patterns(spark):
    rows, labels = labelled()
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = edge.documents(spark, rows)
    model = toxicity.fit(docs, labels.where("doc_id % 3 <> 0"))
    got = toxicity.score(docs, model).join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    assert set(toxicity.score(docs, model).columns) == set(docs.columns)
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_toxicity_edges(spark, docs):
    rows, labels = labelled(100)
    model = toxicity.fit(edge.documents(spark, rows), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int"))
    got = toxicity.score(docs, model)
    assert got.count() == len(ROWS)
    assert {r.predicted for r in got.where("text is null or text = ''").collect()} == {0}
    none = toxicity.fit(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {r.score for r in toxicity.score(docs.limit(1), none).collect()}
    assert toxicity.score(docs.limit(0), model).count() == 0


# ------------------------------------------------------------------ language

def test_languages_held_out(spark):
    df = queries.op9_language_id(spark, "/root/testdata/sf0.01").join(queries.table(spark, "/root/testdata/sf0.01", "documents"), "doc_id")
    rows = df.where("held_out").select("lang", "lang_pred").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_language_edges(spark, docs):
    model = langid.fit(docs)
    got = langid.predict(docs, model)
    assert got.count() == len(ROWS) and sorted(got.columns) == sorted(docs.columns)
    named = {r.doc_id: r.lang_pred for r in got.collect()}
    assert named[2] == named[3] == named[7] == named[13] == "und" and named[9] == "de"
    assert langid.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_presence_is_of_distinct_lower_case_ngrams():
    a, b, c = langid.presence(["abcab", "ABCAB", "abcabcab"])
    assert (a == b).all() and c.sum() >= a.sum() and langid.presence([""]).sum() == 0


def test_likeness_of_long_repetitive_texts():
    """Counts far beyond 16 bits do not wrap."""
    v = fp.vectors(["word " * 70_000, "word " * 60_000, "word " * 200_000 + "other " * 200_000])
    assert fp.likeness(v[:1], v[1:2])[0] == pytest.approx(1.0)
    assert 0.5 < fp.likeness(v[:1], v[2:])[0] < 0.9


def test_likeness_estimates_the_cosine_of_shingle_counts():
    from collections import Counter
    rng = np.random.default_rng(12)
    vocabulary = [f"w{i}" for i in range(400)]
    for share in (0.0, 0.3, 0.7, 0.95):
        a = rng.choice(vocabulary, 900)
        b = np.where(rng.random(900) < share, a, rng.choice(vocabulary, 900))
        x, y = (Counter(zip(w, w[1:])) for w in (a.tolist(), b.tolist()))
        norm = lambda c: sum(n * n for n in c.values()) ** 0.5
        want = sum(n * y[k] for k, n in x.items()) / norm(x) / norm(y)
        v = fp.vectors([" ".join(a), " ".join(b)])
        assert abs(fp.likeness(v[:1], v[1:])[0] - want) < 0.12


def test_licences_with_named_holders(spark):
    """A BSD-3 text names its holder; without the last condition it is BSD-2."""
    head = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
            "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
            "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution.\n")
    tail = "3. Neither the name{} of {} nor the names of {} contributors may be used to endorse or promote products\n   derived from this software without specific prior written permission.\n"
    texts = [head, head + tail.format("", "Example Inc.", "its").replace("Inc.", "Inc"), head + tail.format("", "the copyright holder", "its"), head + tail.format("s", "the Example\n   University and others", "their"),
             tail.format("", "Example", "any"), tail.format("", " ".join("abcdefghijklmno"), "its")]
    got = {r.doc_id: (r.sentence_ids, r.licences) for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    plain = [x for x in ("BSDpre", "BSDsource", "BSDbinary") if x in got[2][0]]
    assert [got[i][1] for i in (1, 2, 3)] == [got[2][1]] * 3
    assert got[4][0] == ["BSDendorse"] and got[5][0] == []
    assert all("BSDendorse" in got[i][0] for i in (1, 2, 3)) and got[0][0] == plain
