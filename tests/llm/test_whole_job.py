"""Places where the operators once did less than the whole job."""

from __future__ import annotations

import random

import duckdb
import pytest

from swipeflow.llm import license_scan, line_dedup, pii, substring_dedup, toxicity

SF = "/root/testdata/sf0.001"


def repeated(docs, min_words):
    """(doc_id, line) of the lines in a run of min_words words or more that begins at an earlier place too."""
    first, gone = {}, set()
    for doc, text in docs:
        lines = [(i, x, len(x.split())) for i, x in enumerate(text.split("\n")) if x.split()]
        for a in range(len(lines)):
            words, run = 0, 0
            for b in range(a, len(lines)):
                words, run = words + lines[b][2], hash((run, lines[b][1]))
                if first.setdefault(run, (doc, a)) != (doc, a) and words >= min_words:
                    gone.update((doc, lines[i][0]) for i in range(a, b + 1))
    return gone


def test_op7_whole_runs(spark):
    long, tail = "one line of a dozen words that two of the documents both have", "and three words"
    made = [(10**6, f"{long}\n{tail}\nother end"), (10**6 + 1, f"{long}\n{tail}\nthis end"), (10**6 + 2, f"x\n{tail}\ny")]
    docs = made + duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc, r.raw) for r in line_dedup.repeated_lines(df, whole=True).collect()}
    assert got == repeated(sorted(docs), line_dedup.MIN_WORDS)
    assert {(10**6 + 1, 0), (10**6 + 1, 1)} <= got
    plain = {(r.doc, r.raw) for r in line_dedup.repeated_lines(df).collect()}
    assert plain < got and (10**6 + 1, 1) not in plain


def test_op7_maximal_runs(spark):
    """Every place's maximal repeated run, far longer than the ten lines that decide in the SQL, and the lines cut from it."""
    rng = random.Random(5)
    pool = ["\n".join(" ".join(rng.choice("abc") for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 25))) for _ in range(6)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 3)))) for i in range(25)] + [(99, "\n".join(["a b"] * 20))]
    first, wanted = {}, {}
    for doc, text in docs:
        lines = [x for x in text.split("\n") if x.split()]
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                earliest = first.setdefault(tuple(lines[a:b]), (doc, a))
                if earliest != (doc, a) and len(" ".join(lines[a:b]).split()) >= line_dedup.MIN_WORDS:
                    wanted[doc, a] = (wanted.get((doc, a), (b - a,))[0], b - a, earliest)
    df = spark.createDataFrame([*docs, docs[3], (None, None), (None, "a")], "doc_id long, text string").repartition(3)
    got = {(r.doc, r.at): (r.depth, r.lines, (r.first.doc, r.first.at)) for r in line_dedup.repeated_runs(df).collect()}
    assert got == wanted and wanted[99, 1] == (5, 19, (99, 0)) and max(n for _, n, _ in wanted.values()) > 20
    assert {(r.doc, r.raw) for r in line_dedup.repeated_lines(df, whole=True).collect()} == repeated(docs, line_dedup.MIN_WORDS)
    assert line_dedup.repeated_runs(df.filter("doc_id is null")).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person
obtaining a copy of this software, to deal in it without restriction.

The above copyright notice and this permission notice shall be
included in all copies.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO FITNESS."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice in the documentation.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS
IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
APACHE = """Licensed under the Apache License, Version
2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License
at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY.

You should have received a copy of the GNU General
Public License along with this program."""
WRAPPED = {
    "MIT": (MIT, "MITgrant,MITnotice,MITasIs"), "BSD-3-Clause": (BSD, "BSDgrant,BSDsource,BSDbinary,BSDendorse,BSDasIs"),
    "Apache-2.0": (APACHE, "Apache2,ApacheCompliance,ApacheObtain,ApacheAsIs,ApacheLanguage,?"),
    "GPL-3.0-or-later": (GPL, "GPL3,GPLlater,GPLnowarranty,GPLcopy"),
}


@pytest.mark.parametrize("leader", ["", " * ", "# ", "// "])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_op1_wrapped_licences(spark, leader, end):
    rows = [(i, "Some file." + end + end.join(leader + x for x in text.split("\n"))) for i, (text, _) in enumerate(WRAPPED.values())]
    rows += [(9, f"MIT License{end}{leader}An unknown licence{end}{leader}BSD License"), (10, f"This is in the public{end}{leader}domain")]
    found = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (licence, (_, sequence)) in enumerate(WRAPPED.items()):
        assert (found[i].licences, found[i].sequence) == (licence, sequence)
    assert found[9].sequence == "MITname,?,BSDname"


@pytest.mark.parametrize("words", [50, 200, 700])
def test_op4_longer_texts_keep_their_strength(words):
    lexicon = toxicity.Lexicon({" idiot ": 4.0, " fooi": 5.0, " scum ": 3.0}, 1.0, 0.0, ())
    text = " ".join(["idiot", "fool", "scum", "idiot"] * 2 + ["word"] * (words - 8)) + " "
    strengths = [lexicon.strength(lexicon.automaton(), text * n) for n in (1, 2, 10, 100, 1000)]
    assert strengths == sorted(strengths) and strengths[0] > 0


def test_op6_large_anchors(monkeypatch):
    """A phrase in every document: no automaton takes all its runs, windows still meet."""
    monkeypatch.setattr(substring_dedup, "AUTOMATON_WORDS", 400)
    sizes = []
    close = substring_dedup.SuffixAutomaton.close
    monkeypatch.setattr(substring_dedup.SuffixAutomaton, "close", lambda self: (sizes.append(max(self.length) and len(self.length)), close(self))[1])
    window, buckets = 13, 4
    texts = [" ".join([*(f"a{i % 150}x{j}" for j in range(12)), "as a matter of fact", *(f"b{i % 150}x{j}" for j in range(12))]).encode() for i in range(300)]
    texts += [b"again and " * 300, b"again and " * 200]
    chunks = [(list(range(at, min(at + 50, len(texts)))), texts[at:at + 50]) for at in range(0, len(texts), 50)]
    sent = [list(substring_dedup._send_anchors(window, buckets)(*c)) for c in chunks]
    cells = {b: [(str(i), substring_dedup.packs.unpack(p)) for i, cs in enumerate(sent) for x, p in cs if x == b] for b in range(buckets)}
    answers = [[] for _ in chunks]
    for b, own in cells.items():
        for (i, _), a in zip(own, substring_dedup._shared_anchors(window)(own)):
            answers[int(i)].append({"bucket": b, "payload": substring_dedup.packs.pack(a)})
    owned, large = {}, 0
    for i, (ids, held) in enumerate(chunks):
        runs = substring_dedup._Runs(held, answers[i], window, buckets)
        large += runs.large.sum()
        for k, doc in enumerate(ids):
            for key, start, n, text in runs.of(k):
                owned.setdefault(key % buckets, []).append((key // buckets % 2**31, doc, start, n, text))
    assert large > 0
    first, got = {}, set()
    for own in owned.values():
        cell = (b"\n".join(t for *_, t in own), substring_dedup.np.array([[s, d] for s, d, *_ in own], substring_dedup.np.int64))
        found = substring_dedup.packs.from_planes(substring_dedup._first_documents(window)([("0", cell)])[0], substring_dedup.np.int64)
        at = 0
        for _, doc, start, n, _ in own:
            got |= {(doc, start + k) for k in range(n) if found[at + k] < doc}
            at += n
    wanted = set()
    for doc, text in enumerate(texts):
        words = text.split()
        for i in range(len(words) - window + 1):
            if first.setdefault(tuple(words[i:i + window]), doc) < doc:
                wanted.add((doc, i))
    assert got == wanted and max(sizes) < 10 * 400


def test_op6_words_are_hashed_once(monkeypatch):
    """The passes after the first take the runs from the chunk's cell; only texts with a large anchor are hashed again."""
    window, buckets = 13, 4
    shared = " ".join(f"s{j}" for j in range(20))
    texts = [f"{' '.join(f'a{i}x{j}' for j in range(30))} {shared} {' '.join(f'b{i}x{j}' for j in range(9))}".encode() for i in range(8)] + [b"", b"few words"]
    chunks = [([0, 1, 2, None, 4], texts[:5]), ([5, 6, 7, 8, 9], texts[5:])]
    sent = [list(substring_dedup._send_anchors(window, buckets)(*c)) for c in chunks]
    answers = [[], []]
    for b in range(buckets):
        own = [(str(i), substring_dedup.packs.unpack(p)) for i, cells in enumerate(sent) for x, p in cells if x == b]
        for (i, _), a in zip(own, substring_dedup._shared_anchors(window)(own) if own else []):
            answers[int(i)].append({"bucket": b, "payload": substring_dedup.packs.pack(a)})
    found = [substring_dedup._Runs(c[1], a, window, buckets) for c, a in zip(chunks, answers)]
    found = [[list(runs.of(k)) for k in range(5)] for runs in found]
    assert all(found[0]) and sum(n for _, _, n, _ in found[0][0]) >= 8 and not found[1][3] and not found[1][4]

    def never(*_):
        raise AssertionError("hashed again")

    monkeypatch.setattr(substring_dedup, "_anchors", never)
    monkeypatch.setattr(substring_dedup, "word_hashes", never)
    cells = [[{"payload": p, "chunk": str(i), "answers0": answers[i]} for x, p in own if x == substring_dedup.packs.CHUNK] for i, own in enumerate(sent)]
    again = []
    for (row,) in cells:
        ids, held, kept = substring_dedup.packs.unpack(row["payload"])
        runs = substring_dedup._Runs(held, row["answers0"], window, buckets, kept)
        again.append([list(runs.of(k)) for k in range(len(ids))])
    assert again == found
    assert list(substring_dedup._send_runs(window, buckets)([substring_dedup.pa.RecordBatch.from_pylist(c) for c in cells]))


def test_op5_terms_far_from_their_entity(spark):
    gap = " and so on" * 40
    rows = [(i, f"Dear Zbigniew,{gap} {'one two three four'.split()[i]} is the way to zb@x.org today") for i in range(4)]
    rows += [(10 + i, f"Dear all,{gap} this is the way today, number {i}") for i in range(40)]
    marked = {r.doc_id: r.spans for r in pii.found(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(marked[i].startswith("term:5:13,email") and marked[i].count("term") == 1 for i in range(4))


def test_op5_documents_are_counted_once(spark):
    """One document with many contexts is no evidence, and repeats do not raise a common word's disclosure."""
    words = "alpha beta gamma delta omega sigma kappa lambda".split()
    rows = [(0, " ".join(f"{w} quorum {w}a zb@x.org {w}b quorum" for w in words))]
    rows += [(1 + i, f"{w} quorum yy@x.org {w}c" + f" quorum {w} yy@x.org" * 50) for i, w in enumerate("red green blue".split())]
    rows += [(10 + i, f"quorum number {i}") for i in range(20)] + [(40 + i, f"text number {i}") for i in range(60)]
    marked = {r.doc_id: r.spans for r in pii.found(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any("term" in spans for spans in marked.values())
