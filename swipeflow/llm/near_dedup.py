"""Near-duplicate documents by SetSketch.

1. A document is the set of hashes of its word shingles. Its sketch holds, for each of 128 hash functions,
   the minimum over the set on an exponential scale with base 1.001, cut to 16 bits: mergeable, and two
   sketches agree in a register with about the probability that is the sets' Jaccard similarity.
2. Equal sets are one class. Four registers make a band; classes that share a band are candidates. A band
   is linked as a star around its smallest member (no pairs), which gives coarse groups.
3. Coarse groups are compared inside one task, in blocks of bounded size: the likelihood of the register
   comparisons with both cardinalities estimates the similarity, and pairs near or above the threshold are
   confirmed on the full sets. A pair that confirmed links already connect needs no check.
4. Components of the confirmed links are the groups.

At a similarity of 0.8 all 32 bands of a pair differ with a probability below 5e-8, and the margin of 0.2
below the threshold is over five standard deviations of the estimate.

Null and blank texts have no set and link with nothing. Rows that share a doc_id are one document; rows
without a doc_id link with nothing (component null, kept). Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.links import components
from swipeflow.llm.packs import lean
from swipeflow.llm.tables import raw_texts, saved

REGISTERS = 128
BAND_ROWS = 4
BASE = 1.001
RATE = 20.0
MARGIN = 0.2
#: A block of a coarse group: so many documents, and so many shingles, at most on average.
BLOCK_DOCS = 600
BLOCK_SHINGLES = 2_000_000

_FACTORS = np.random.default_rng(20).integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hashes of words, kept while they recur."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.array([known[w] for w in words], dtype=np.uint64)


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words."""
    n = len(hashes) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(k):
        out = (out ^ hashes[j:j + len(out)]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def shingle_set(text: bytes, k: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of k-word shingles of the text with A-Z lowered; fewer words are one shingle."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    return np.unique(window_hashes(word_hashes(words, known), k))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a non-empty set."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 256):
        np.minimum(least, (hashes[at:at + 256, None] * _FACTORS).min(axis=0), out=least)
    uniform = np.minimum((least.astype(np.float64) + 0.5) / 2.0**64, 1 - 1e-15)
    levels = np.floor(1 - np.log(-np.log1p(-uniform) / RATE) / np.log(BASE))
    return np.clip(levels, 0, 65535).astype(np.uint16)


def _log_share(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def likely_similarity(above: np.ndarray, below: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs, from the counts of larger and smaller registers and both set sizes."""
    u, v = left / (left + right), right / (left + right)
    most = np.minimum(u / v, v / u)
    equal = REGISTERS - above - below
    best, top = np.zeros(len(u)), np.full(len(u), -np.inf)
    for step in np.linspace(0, 1, 51):
        j = step * most
        more, less = _log_share(u - v * j), _log_share(v - u * j)
        score = sum(n * np.log(np.maximum(p, 1e-300)) for n, p in ((above, more), (below, less), (equal, 1 - more - less)))
        better = score > top
        best[better], top[better] = j[better], score[better]
    return best


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for at in range(0, batch.num_rows, 2000):
                counts, keys, bands = [], [], []
                for text in texts.slice(at, 2000):
                    found = shingle_set(text.as_py(), k, known)
                    counts.append(len(found))
                    keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest() if len(found) else None)
                    bands.append(sketch(found).view(np.int64) if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 2000), pa.array(counts, pa.int64()), pa.array(keys, pa.string()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "set_key", "bands"])

    return lean(run)


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), k, known) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("component"), batch.column("blocks"), batch.column("block"),
                 pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([sketch(s).tobytes() for s in sets], pa.binary())],
                names=["node", "component", "blocks", "block", "hashes", "registers"])

    return lean(run)


def _links(percent: int):
    def find(root: list[int], i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def run(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_pylist()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("hashes")]
        registers = np.frombuffer(b"".join(x.as_py() for x in group.column("registers")), np.uint16).reshape(-1, REGISTERS)
        block = np.array(group.column("block").to_pylist())
        across = group.column("i")[0].as_py() != group.column("j")[0].as_py()
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        lefts, rights, larger, smaller = [], [], [], []
        for i in range(len(nodes) - 1):
            others = np.arange(i + 1, len(nodes))
            if across:
                others = others[block[others] != block[i]]
            low, high = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
            others = others[100 * low >= percent * high]
            above = (registers[i] > registers[others]).sum(axis=1)
            below = (registers[i] < registers[others]).sum(axis=1)
            near = REGISTERS - above - below >= REGISTERS * (percent / 100 - 2 * MARGIN)
            lefts.append(np.full(near.sum(), i))
            rights.append(others[near])
            larger.append(above[near])
            smaller.append(below[near])
        root, found = list(range(len(nodes))), []
        if lefts:
            left, right = np.concatenate(lefts), np.concatenate(rights)
            likely = likely_similarity(np.concatenate(larger), np.concatenate(smaller), sizes[left], sizes[right])
            for p in np.argsort(-likely, kind="stable"):
                if likely[p] < percent / 100 - MARGIN:
                    break
                i, j = int(left[p]), int(right[p])
                if find(root, i) == find(root, j):
                    continue
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    root[find(root, i)] = find(root, j)
                    found.append((nodes[i], nodes[j]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row: sets with 100 * shared >= percent * union are linked."""
    rows = saved(raw_texts(docs).mapInArrow(
        _sketches(shingle), "doc_id long, n_shingles long, set_key string, bands array<long>"), "near-sketches")
    full = rows.filter("doc_id is not null and set_key is not null")
    classes = full.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    banded = classes.select("node", F.posexplode("bands").alias("band", "value"))
    shared = banded.groupBy("band", "value").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z")
    stars = banded.join(shared, ["band", "value"]).filter("node != a").select("a", F.col("node").alias("b")).distinct()
    coarse = saved(components(stars).join(classes.select("node", "n"), "node"), "near-coarse")
    sizes = coarse.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(BLOCK_DOCS)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES))).alias("blocks"))
    members = coarse.select("node", "component").distinct().join(sizes, "component").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # the members grow with the documents: joined by shuffle at every size, never sent whole to the tasks
    found = raw_texts(docs).join(members.hint("merge"), F.col("doc_id") == F.col("node")).select("node", "component", "blocks", "block", "text")
    sets = found.mapInArrow(_sets(shingle), "node long, component long, blocks long, block long, hashes binary, registers binary")
    spread = sets.filter(F.length("hashes") > 0).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block", "hashes", "registers")
    confirmed = spread.groupBy("component", "i", "j").applyInArrow(_links(percent), "a long, b long")
    copies = full.join(classes.select("set_key", "node"), "set_key").filter("doc_id != node").select(
        F.col("node").alias("a"), F.col("doc_id").alias("b"))
    joined = components(confirmed.union(copies))
    return rows.join(joined.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """docs without the documents that are not the first of their group."""
    gone = groups(docs, shingle, percent).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)
