"""Whitening, SimHash and periodic runs against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from swipeflow.llm import periodic_runs, simhash, whitening
from swipeflow.llm.queries import op12_simhash, op13_periodic_runs

SMALL = "/root/testdata/sf0.001"


# ---- periodic runs ------------------------------------------------------------

def _smallest_period(seq) -> int:
    fail, k = [0] * len(seq), 0
    for i in range(1, len(seq)):
        while k and seq[i] != seq[k]:
            k = fail[k - 1]
        if seq[i] == seq[k]:
            k += 1
        fail[i] = k
    return len(seq) - fail[-1]


def naive_runs(words):
    n, found = len(words), set()
    for q in range(1, n // 3 + 1):
        k = 0
        while k < n - q:
            if words[k] != words[k + q]:
                k += 1
                continue
            s = k
            while k < n - q and words[k] == words[k + q]:
                k += 1
            length = k + q - s
            if length >= max(24, 3 * q) and _smallest_period(words[s:s + length]) == q:
                found.add((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _sequences():
    rng = random.Random(7)
    out = [["a"] * 100, ["a", "b"] * 40 + ["c"] + ["a", "b"] * 13, [str(i) for i in range(200)]]
    for _ in range(150):
        alphabet = rng.choice([1, 2, 3, 5, 30])
        seq = [chr(97 + rng.randrange(alphabet)) for _ in range(rng.randrange(0, 160))]
        for _ in range(rng.randrange(0, 3)):
            if len(seq) > 2:
                a = rng.randrange(len(seq))
                p = rng.randrange(1, 12)
                seq = seq[:a] + (seq[a:a + p] * rng.randrange(2, 12)) + seq[a:]
        out.append(seq)
    return out


@pytest.mark.parametrize("seq", _sequences())
def test_runs_equal_brute_force(seq):
    assert periodic_runs.runs_of(seq) == naive_runs(seq)


def test_collapsed_keeps_first_period():
    seq = ["x"] + ["a", "b", "c"] * 10 + ["y"]
    runs = periodic_runs.runs_of(seq)
    assert runs == [(1, 30, 3)]
    assert periodic_runs.collapsed(seq, runs) == "x a b c y"


def _planted(doc_id, text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_op13_whole_query_against_brute_force(spark):
    got = {r["doc_id"]: r for r in op13_periodic_runs(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted_runs = 0
    for doc in docs:
        words = _planted(doc["doc_id"], doc["text"])
        runs = naive_runs(words)
        row = got[doc["doc_id"]]
        assert row["n_runs"] == len(runs)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        kept = periodic_runs.collapsed(words, runs)
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        if runs:
            best = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[0]
            assert (row["start"], row["length"], row["period"]) == best
            assert row["exponent_milli"] == 1000 * best[1] // best[2]
            planted_runs += 1
        else:
            assert row["start"] is None and row["exponent_milli"] is None
    assert planted_runs > 0


# ---- SimHash -----------------------------------------------------------------

def _fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(str.maketrans(simhash.UPPER, simhash.LOWER))) if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))


def _components(ids, prints):
    parent = {i: i for i in range(len(ids))}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i + 1, len(ids)):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    lowest = {}
    for i, d in enumerate(ids):
        if d is not None:
            lowest[root(i)] = min(lowest.get(root(i), d), d)
    return [lowest.get(root(i)) for i in range(len(ids))]


def _near_copies(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    base = " ".join(f"word{i}" for i in range(300))
    extra = [(10_000 + k, base.replace(f"word{k * 7}", "changed", 1)) for k in range(30)]
    return rows + extra + [(20_000, None), (20_001, ""), (None, base)]


@pytest.mark.parametrize("tree_size", [simhash.TREE_SIZE, 3])
def test_simhash_against_brute_force(spark, tree_size):
    rows = _near_copies(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = simhash.groups(df, tree_size=tree_size).collect()
    prints = [_fingerprint(t) for _, t in rows]
    comps = _components([d for d, _ in rows], prints)
    want = [(d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, comps)]
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == sorted(want, key=str)
    assert len({c for d, _, c in want if d and d >= 10_000 and d < 20_000}) < 30


def test_bk_tree_finds_all_within_radius():
    rng = random.Random(3)
    values = list({rng.getrandbits(64) for _ in range(400)} | {0, 1, 3, 7, 15, 31})
    tree = simhash.BKTree(values)
    for q in values[:60] + [rng.getrandbits(64) for _ in range(20)]:
        want = sorted(v for v in values if (v ^ q).bit_count() <= 4)
        assert sorted(tree.within(q, 4)) == want


def test_op12_query_shape(spark):
    got = op12_simhash(spark, SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id", "n_shingles"]
    assert got.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


# ---- whitening ---------------------------------------------------------------

def _reference(vectors):
    x = np.array([[np.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors])
    n = len(x)
    cov = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) / n
    values, vecs = np.linalg.eigh(cov)
    return x, cov, values[::-1], vecs[:, ::-1]


def test_whitening_against_numpy(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = rows + [(9_001, None), (9_002, [1.0, float("nan")] + [0.0] * 62), (9_003, [None] * 64), (9_004, [float("inf")] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    out = whitening.whitened(df).collect()
    good = [r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    x, cov, values, vecs = _reference([r[1] for r in good])
    n = len(x)
    k = min(32, x.shape[1])
    assert len(out) == n * k
    assert {r["n"] for r in out} == {n}
    spread = n * x - x.sum(axis=0)
    want_dev = {r[0]: int(sum(int(v) ** 2 for v in s)) for r, s in zip(good, spread.astype(np.int64))}
    explained = {r["component"]: r["explained"] for r in out}
    for c in range(1, k + 1):
        assert explained[c] == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
    by_id = {}
    for r in out:
        assert r["deviation"] == want_dev[r["vec_id"]]
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    ids = [r[0] for r in good]
    w = np.array([[by_id[i][c] for c in range(1, k + 1)] for i in ids])
    ref = (x - x.mean(axis=0)) @ vecs[:, :k] / np.sqrt(values[:k])
    assert np.allclose(np.abs(w), np.abs(ref), atol=1e-7)
    assert out[0]["identity_error"] <= 1e-4
    assert np.abs(w.T @ w / n - np.eye(k)).max() <= 1e-6


def test_eigen_steps_on_a_clustered_matrix():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    values = np.concatenate([[5.0, 5.0, 5.0 + 1e-9, 3.0], np.linspace(2, 0, 36)])
    a = q @ np.diag(values) @ q.T
    got_values, got_vectors = whitening.components(a, 10)
    assert np.allclose(got_values, np.sort(values)[::-1][:10], rtol=1e-12, atol=1e-12)
    assert np.allclose(got_vectors.T @ got_vectors, np.eye(10), atol=1e-10)
    assert np.allclose(a @ got_vectors, got_vectors * got_values, atol=1e-9)


# ---- edge cases ----------------------------------------------------------------

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id " * 20), (None, None), (5, LONG), (6, LONG),
        (7, ("a b c " * 40).strip()), (-8, "ONE")]
CLASHES = "row words runs collapsed n_words fingerprint component node shingles h part sub block value member a b x".split()


@pytest.fixture(scope="module")
def edge_docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("lang", F.lit("en"))
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def test_runs_edges(spark, edge_docs):
    got = periodic_runs.detected(periodic_runs.planted(edge_docs)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in got) == sorted((d is None, d) for d, _ in ROWS)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[1]["n_words"] == 0 and by_id[1]["runs"] == [] and by_id[1]["collapsed"] == ""
    assert [tuple(r) for r in by_id[7]["runs"]] == [(0, 120, 3)] and by_id[7]["collapsed"] == "a b c"
    assert by_id[5]["n_words"] == 30_000 and len(by_id[5]["runs"]) == 1
    assert periodic_runs.detected(periodic_runs.planted(edge_docs.limit(0))).count() == 0


def test_simhash_edges(spark, edge_docs):
    got = simhash.groups(edge_docs).collect()
    assert len(got) == len(ROWS)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == "0000000000000000"
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == by_id[3]["component_id"] == 1
    assert by_id[4]["fingerprint"] == by_id[-8]["fingerprint"] and by_id[4]["component_id"] == -8
    assert by_id[5]["component_id"] == by_id[6]["component_id"] == 5
    assert simhash.groups(edge_docs.limit(0)).count() == 0


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>, x string, n string, component string"
    empty = spark.createDataFrame([], schema)
    assert whitening.whitened(empty).count() == 0
    one = spark.createDataFrame([(1, [0.5, 0.25], "c", "c", "c"), (1, [0.5, 0.25], "c", "c", "c"), (None, None, "c", "c", "c")], schema)
    assert whitening.whitened(one).count() == 0
    two = spark.createDataFrame([(1, [0.5, 0.25], "c", "c", "c"), (None, [0.0, 1.0], "c", "c", "c"), (3, [0.0, 1.0], "c", "c", "c")], schema)
    rows = whitening.whitened(two).collect()
    assert len(rows) == 3 and {r["component"] for r in rows} == {1}
    assert rows[0]["identity_error"] <= 1e-9
