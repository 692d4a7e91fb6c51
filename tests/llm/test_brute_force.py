"""Queries without a SQL form against brute force, over the whole smallest tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from swipeflow.llm import exact_dedup, line_dedup, mixing, queries
from swipeflow.llm.near_dedup import sketch, likely_similarity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') AS text, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def near_groups(texts, k, percent):
    """Component of each id by all pairs that share a shingle."""
    sets, holders = {}, {}
    for doc, text in texts.items():
        words = text.encode().lower().split()
        sets[doc] = {tuple(words[j:j + k]) for j in range(max(len(words) - k + 1, 1))} if words else set()
        for s in sets[doc]:
            holders.setdefault(s, []).append(doc)
    shared = Counter((a, b) for held in holders.values() for i, a in enumerate(held) for b in held[i + 1:])
    root = {doc: doc for doc in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {doc: find(doc) for doc in texts}, {doc: len(s) for doc, s in sets.items()}


def encoded(text):
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def test_op4_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op4_toxicity(spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.01/labels.parquet' WHERE toxic IS NOT NULL").fetchall()
    seen = Counter((toxic, rows[i].predicted) for i, toxic in labels if rows[i].held_out)
    assert seen[0, 0] / (seen[0, 0] + seen[0, 1]) > 0.95
    assert seen[1, 1] / (seen[1, 1] + seen[1, 0]) > 0.5


def test_op5_base_spans(spark, docs):
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]

    def passes(kind, value):
        digits = [int(c) for c in value if c.isdigit()]
        luhn = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")),
                "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}[kind]

    rows = {r.doc_id: r for r in queries.op5_pii(spark, SF).collect()}
    for doc, text, _ in docs:
        spans = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(kinds) for m in re.finditer(p, text, re.ASCII) if passes(kind, m[0]))
        own = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in spans)
        assert rows[doc].base_sha256 == sha(own) and set(filter(None, own.split(","))) <= set(rows[doc].spans.split(","))


def test_op6_windows(spark, docs):
    first = {}
    for doc, text, _ in docs:
        words = text.encode().split()
        for i in range(len(words) - 12):
            first.setdefault(tuple(words[i:i + 13]), doc)
    rows = {r.doc_id: r for r in queries.op6_substring_dedup(spark, SF).collect()}
    for doc, text, _ in docs:
        words = text.encode().split()
        gone = {j for i in range(len(words) - 12) if first[tuple(words[i:i + 13])] < doc for j in range(i, i + 13)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert (rows[doc].n_words, rows[doc].n_removed, rows[doc].kept_sha256) == (len(words), len(gone), sha(kept))


def test_op8_edited_texts_and_likeness(spark, docs):
    rows = {r.doc_id: r for r in queries.op8_fingerprints(spark, SF).collect()}

    def shingles(text):
        words = WORD.findall(text)
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    for at, (doc, text, _) in enumerate(docs):
        following = docs[at - 1][1]
        half = len(text) // 2
        edit = text[:len(text) - half] + following[:half]
        row = rows[doc]
        assert (row.n_chars, row.edited_sha256) == (len(text), sha(edit))
        for other, likeness in ((edit, row.near_edited), (following, row.near_next)):
            a, b = shingles(text), shingles(other)
            assert abs(likeness - len(a & b) / max(1, len(a | b))) < 0.2


def test_op9_components(spark, docs):
    rows = {r.doc_id: r for r in queries.op9_near_dedup(spark, SF).collect()}
    component, sizes = near_groups({d: t for d, t, _ in docs}, 4, 80)
    for doc, _, _ in docs:
        assert (rows[doc].component_id, rows[doc].n_shingles, rows[doc].kept) == (component[doc], sizes[doc], component[doc] == doc)


def test_op9_estimate():
    rng = np.random.default_rng(3)
    shared, left, right = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (4000, 500, 500))
    a, b = (sketch(np.unique(np.concatenate([shared, own]))) for own in (left, right))
    likely = likely_similarity(np.array([(a > b).sum()]), np.array([(a < b).sum()]), np.array([4500.0]), np.array([4500.0]))
    assert abs(likely[0] - 0.8) < 0.15


def test_op10_round_trip(spark, docs):
    rows = {r.doc_id: r for r in queries.op10_bpe(spark, SF).collect()}
    for doc, text, _ in docs:
        ids, decoded = encoded(text)
        assert (rows[doc].n_tokens, rows[doc].ids_sha256, rows[doc].decoded_sha256) == (
            len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded))


def test_exact_index_chains_collisions(spark):
    """Keys of three bits: buckets split to the last bit, and chains hold many texts."""
    texts = [f"text {i % 40}" for i in range(200)] + ["A", "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in exact_dedup.duplicates(df, capacity=2, key_bits=3).collect()}
    for i, text in enumerate(texts):
        same = [j for j, t in enumerate(texts) if t.lower() == text.lower()]
        assert (rows[i].keep_id, rows[i].group_size, rows[i].kept) == (max(same), len(same), i == max(same))


def test_pii_terms_that_reveal(spark):
    from swipeflow.llm import pii

    places = ["near the old harbour", "at our second office", "during last summer fair", "beside a quiet river"]
    rows = [(i, f"Ask Zbigniew {p} or write zb@x.org about it, said number {w}.") for i, (p, w) in enumerate(zip(places, "one two three four".split()))]
    rows += [(10 + i, f"Ask or write about it, said the office near the harbour of number {i}.") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marked = {r.doc_id: r.spans for r in pii.found(df).collect()}
    assert marked[0].split(",")[0] == "term:4:12" and "email" in marked[0] and marked[12] == ""
    clean = {r.doc_id: r.text for r in pii.cleaned(df, {"zbigniew": "[PERSON]"}).collect()}
    assert clean[1].startswith("Ask [PERSON] at our second office or write [EMAIL]")


def test_pipeline_stages(spark, docs):
    """Each stage against its own input: scores, SQL, all pairs, SQL, the tokenizer."""
    con = duckdb.connect()
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    clean = stages[0](spark, frame, SF).collect()
    scores = {r.doc_id: r.predicted for r in queries.op4_toxicity(spark, SF).collect()}
    assert sorted(r.doc_id for r in clean) == sorted(d for d in scores if not scores[d])

    def frames(rows):
        df = spark.createDataFrame(rows, frame.schema)
        con.execute("CREATE OR REPLACE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [tuple(r) for r in rows])
        return df

    cut = stages[1](spark, frames(clean), SF).collect()
    wanted = {d: (n, gone, digest) for d, n, gone, digest in con.execute(line_dedup.ORACLE).fetchall()}
    assert {r.doc_id for r in cut} == {d for d, (n, gone, _) in wanted.items() if not n or gone < n}
    assert all(sha(r.text or "") == wanted[r.doc_id][2] and r.n_chars == len(r.text) for r in cut)

    one = stages[2](spark, frames(cut), SF).collect()
    component, _ = near_groups({r.doc_id: r.text for r in cut}, 5, 80)
    assert sorted(r.doc_id for r in one) == sorted(d for d in component if component[d] == d)

    mixed = stages[3](spark, frames(one), SF).collect()
    result = con.execute(mixing.ORACLE)
    names = [c[0] for c in result.description]
    uses = {(row := dict(zip(names, r)))["doc_id"]: row["uses"] if row["size"] else 1 for r in result.fetchall()}
    assert Counter(r.doc_id for r in mixed) == Counter({d: n for d, n in uses.items() if n})

    last = stages[4](spark, spark.createDataFrame(mixed, frame.schema), SF).collect()
    text_of = {r.doc_id: r.text for r in mixed}
    assert len(last) == len(mixed)
    for row in last:
        ids, decoded = encoded(text_of[row.doc_id])
        assert row.ids == np.array(ids, "<u4").tobytes() and row.decoded == decoded
