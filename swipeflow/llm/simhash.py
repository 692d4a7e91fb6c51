"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by BK-trees.

A document's fingerprint has bit b set when more than half of its shingle hashes have bit b set
(shingles: ``SHINGLE`` consecutive lower-cased words, repeats included, joined by one space; fewer words give
the whole sequence as one shingle; no words give fingerprint zero). Hashes are XXH64 of the UTF-8 shingle
with seed 42 (the same as Spark's ``xxhash64``). Fingerprints are made by Arrow-batched tasks, one pass
over the documents without a shuffle: shingles of a text are hashed by the xxhash library and their bits
counted with numpy. (A form by built-in expressions, shingles exploded and 64 bit sums per row, took
about 8,000 CPU seconds a GB here: the shingle lambda is not compiled.)

Fingerprints within ``RADIUS`` differing bits are linked. Only distinct fingerprints take part (exact copies
are one node). Linking by BK-trees, sharded so that no tree and no task grows with the corpus:

* pigeonhole: two fingerprints within ``RADIUS`` bits agree exactly on at least one of ``RADIUS + 1`` bit
  blocks, so a fingerprint goes into one shard per block, keyed by (block, block value);
* a shard with more than ``TREE_SIZE`` fingerprints is split into sub-shards of at most that many by a
  hash of the fingerprint, and its queries into as many query parts; each task (block, value, sub-shard,
  query part) builds one BK-tree (children keyed by integer Hamming distance to their parent) over its
  members and sends its queries through it, following only the children whose key lies within the radius
  of the query's distance to the node. The tree is shipped to exactly the queries that share its shard key
  (a keyed shuffle); a global broadcast would grow with the corpus.
* a pair agreeing on several blocks is reported only from the first of them, and only as (smaller,
  larger) fingerprint, so every link appears once.

Every link between different fingerprints within the radius is found (no cap on partners); components of
the links (``links.components``) give each document the smallest doc_id it reaches.

Edge cases: a null text or doc_id is kept; null and blank texts have fingerprint zero and link like any
other fingerprint; a document with a null doc_id gets the smallest non-null doc_id of its component (null
when it has none); repeated rows keep one result row each; an empty table gives an empty result; very long
texts are exploded into shingles, never cut; other columns of the input, whatever their names, are left
behind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm import packs
from swipeflow.llm.links import components
from swipeflow.llm.tables import saved

SHINGLE = 4
RADIUS = 4
TREE_SIZE = 20_000
BITS = 64
SEED = 42
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def blocks(radius: int = RADIUS) -> list[tuple[int, int]]:
    """(first bit, width) of the radius + 1 blocks that cover the 64 bits as evenly as possible."""
    parts, first = [], 0
    for j in range(radius + 1):
        width = BITS // (radius + 1) + (1 if j < BITS % (radius + 1) else 0)
        parts.append((first, width))
        first += width
    return parts


_FOLD = str.maketrans(UPPER, LOWER)
_SPLIT = re.compile(SPACE)


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> tuple[int, int]:
    """(fingerprint as a signed 64-bit integer, number of shingles) of one text."""
    words = [w for w in _SPLIT.split((text or "").translate(_FOLD)) if w]
    if len(words) >= shingle:
        pieces = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)]
    else:
        pieces = [" ".join(words)] if words else []
    if not pieces:
        return 0, 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(p.encode(), seed=SEED) for p in pieces), dtype=np.uint64, count=len(pieces))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    value = int(np.packbits(2 * bits > len(pieces), bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >= 1 << 63 else value, len(pieces)


def _printed(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [fingerprint_of(t, shingle) for t in batch["text"]]
            yield pd.DataFrame({"row": batch["row"], "doc_id": batch["doc_id"],
                                "fingerprint": pd.Series([f for f, _ in found], dtype="int64"),
                                "n_shingles": pd.Series([n for _, n in found], dtype="int64")})
        packs.release()
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """row (a key of the input row), doc_id, fingerprint (signed 64-bit long), n_shingles for every input row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       docs["text"].alias("text"))
    return rows.mapInPandas(_printed(shingle), "row long, doc_id long, fingerprint long, n_shingles long")


def _unsigned(value: int) -> int:
    return value & 0xFFFF_FFFF_FFFF_FFFF


class BKTree:
    """A BK-tree of distinct 64-bit fingerprints; children are keyed by their Hamming distance to the parent."""

    def __init__(self, values):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        for value in values:
            self.add(value)

    def add(self, value: int) -> None:
        if not self.values:
            self.values.append(value)
            self.children.append({})
            return
        node = 0
        while True:
            distance = (self.values[node] ^ value).bit_count()
            if distance == 0:
                return
            child = self.children[node].get(distance)
            if child is None:
                self.children[node][distance] = len(self.values)
                self.values.append(value)
                self.children.append({})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        """Every stored value within radius bits of value."""
        found, todo = [], [0] if self.values else []
        while todo:
            node = todo.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(self.values[node])
            for key, child in self.children[node].items():
                if distance - radius <= key <= distance + radius:
                    todo.append(child)
        return found


def _first_common_block(a: int, b: int, parts: list[tuple[int, int]]) -> int:
    for j, (first, width) in enumerate(parts):
        mask = ((1 << width) - 1) << first
        if a & mask == b & mask:
            return j
    return -1


KEYS = ["block", "value", "sub", "part"]


def _searched(radius: int):
    """Sorted rows of (block, value, sub, part) groups in, links out; a group may span Arrow batches."""
    parts = blocks(radius)
    signed = lambda xs: [x - (1 << 64) if x >= 1 << 63 else x for x in xs]

    def search(block: int, member: np.ndarray, values: np.ndarray, a: list, b: list) -> None:
        tree = BKTree(_unsigned(int(v)) for v in values[member])
        for query in (_unsigned(int(v)) for v in values[~member]):
            for match in tree.within(query, radius):
                if query < match and _first_common_block(query, match, parts) == block:
                    a.append(query)
                    b.append(match)

    def groups(frame: pd.DataFrame, a: list, b: list) -> None:
        keys = frame[KEYS].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        ends = np.append(starts[1:], len(frame))
        member, values = frame["member"].to_numpy(dtype=bool), frame["fingerprint"].to_numpy()
        for first, last in zip(starts, ends):
            search(int(keys[first, 0]), member[first:last], values[first:last], a, b)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None
        for batch in batches:
            frame = batch if carry is None else pd.concat([carry, batch], ignore_index=True)
            if not len(frame):
                continue
            keys = frame[KEYS].to_numpy()
            open_group = (keys == keys[-1]).all(axis=1)
            carry = frame[open_group]
            a, b = [], []
            if (~open_group).any():
                groups(frame[~open_group], a, b)
            yield pd.DataFrame({"a": pd.Series(signed(a), dtype="int64"), "b": pd.Series(signed(b), dtype="int64")})
        if carry is not None and len(carry):
            a, b = [], []
            groups(carry, a, b)
            yield pd.DataFrame({"a": pd.Series(signed(a), dtype="int64"), "b": pd.Series(signed(b), dtype="int64")})
        packs.release()

    return run


def links(prints: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """(a, b): every pair of distinct fingerprints within radius bits, once, a < b as unsigned numbers."""
    distinct = prints.select("fingerprint").distinct()
    keyed = distinct.select("fingerprint", F.explode(F.array(*[
        F.struct(F.lit(j).alias("block"), F.shiftrightunsigned("fingerprint", first).bitwiseAND((1 << width) - 1).alias("value"))
        for j, (first, width) in enumerate(blocks(radius))])).alias("key")).select("fingerprint", "key.block", "key.value")
    keyed = saved(keyed, "simhash-keys")
    parts = saved(keyed.groupBy("block", "value").agg(F.count("*").alias("size"))
                  .select("block", "value", F.ceil(F.col("size") / tree_size).cast("int").alias("parts")), "simhash-shards")
    sized = keyed.join(parts, ["block", "value"])
    members = sized.select("block", "value", F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("parts")).cast("int").alias("sub"),
                           F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "fingerprint", F.lit(True).alias("member"))
    queries = sized.select("block", "value", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("sub"),
                           F.pmod(F.xxhash64("fingerprint", F.lit(2)), F.col("parts")).cast("int").alias("part"), "fingerprint",
                           F.lit(False).alias("member"))
    return (members.unionByName(queries).repartition(*KEYS).sortWithinPartitions(*KEYS)
            .mapInPandas(_searched(radius), "a long, b long"))


def groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id, n_shingles for every row of docs."""
    prints = saved(fingerprints(docs, shingle), "simhash-prints")
    edges = saved(links(prints, radius, tree_size), "simhash-links")
    nodes = saved(components(edges).select(F.col("node").alias("fingerprint"), F.col("component")), "simhash-components")
    placed = prints.join(nodes, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    lowest = saved(placed.groupBy("component").agg(F.min("doc_id").alias("component_id")), "simhash-lowest")
    return placed.join(lowest, "component").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id", "n_shingles")
