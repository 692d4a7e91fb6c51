"""Exact duplicates through an extendible-hash index on shared files.

Texts are equal when identical after lower-casing A-Z. The index has a directory over the first bits of the
text's 64-bit key: while a bucket holds more different keys than fit, the directory doubles and the bucket
splits. Each bucket, a range of keys, belongs to one owner task. It reads its entries in key order, compares
the bytes of texts with the same key, and chains different ones. Map tasks combine copies before they send
them, so a text that a third of all rows hold reaches its owner as a few entries.

Rows find their chain entry by key and SHA-256 of the normalised text.

Null text counts as empty. Of equal texts the largest doc_id stays; rows that share it stay together, and
rows without doc_id stay only where no equal text has one. Other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.tables import partitions, raw_texts, saved

#: Different keys in a bucket before it splits.
CAPACITY = 16_384
#: Bits that the directory can use.
MOST_BITS = 40
#: Directory rows (24 bytes each) up to which every task gets a copy; beyond, rows are joined to it by shuffle.
SENT_ROWS = 2_000_000
#: Texts, and their bytes, that a map task combines at once.
COMBINE_ROWS, COMBINE_BYTES = 20_000, 32_000_000


def key_of(text: bytes, bits: int) -> int:
    """The key's first bits are at the top of a non-negative 63-bit number."""
    return xxhash.xxh64_intdigest(text) >> 1 >> (63 - bits) << (63 - bits)


def _entries(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py().lower() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([key_of(t, bits) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())], names=["doc_id", "key", "text_sha256"])

    return run


def _combined(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def rows() -> pa.RecordBatch:
            texts = list(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([key_of(t, bits) for t in texts], pa.int64()), pa.array(texts, pa.binary()),
                 pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1] for v in held.values()], pa.int64())],
                names=["key", "text", "keep_id", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py().lower()
                if text not in held:
                    held[text] = [None, 0]
                    size += len(text)
                entry = held[text]
                entry[0] = doc_id if entry[0] is None else max(entry[0], doc_id if doc_id is not None else entry[0])
                entry[1] += 1
                if len(held) >= COMBINE_ROWS or size >= COMBINE_BYTES:
                    yield rows()
                    held.clear()
                    size = 0
        if held:
            yield rows()

    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in key order: one chain at a time."""

    def links(bucket, key, chain) -> list[tuple]:
        return [(bucket, key, place, hashlib.sha256(text).hexdigest(), keep, n, text) for place, (text, keep, n) in enumerate(chain)]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          names=["bucket", "key", "place", "text_sha256", "keep_id", "group_size", "text"])

    at, chain, out = None, [], []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "key", "keep_id", "n")]
        for bucket, key, keep, n, text in zip(*columns, batch.column("text")):
            if (bucket, key) != at:
                out += links(*at, chain) if at else []
                at, chain = (bucket, key), []
                if len(out) >= 5000:
                    yield made(out)
                    out = []
            text = text.as_py()
            for entry in chain:
                if entry[0] == text:
                    entry[1] = max((x for x in (entry[1], keep) if x is not None), default=None)
                    entry[2] += n
                    break
            else:
                chain.append([text, keep, n])
    out += links(*at, chain) if at else []
    if out:
        yield made(out)


def directory(keys: DataFrame, capacity: int = CAPACITY, most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) for every slot of the directory, and the bits that make a slot.

    keys: one column `key`. A bucket is named by its first key. Copies of a key count once.
    """
    live = saved(keys.select(F.shiftright("key", 63 - most_bits).alias("cell")).distinct(), "directory-keys")
    leaves, bits = None, 0
    while True:
        prefix = F.shiftright("cell", most_bits - bits)
        loads = live.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("load")).withColumn("depth", F.lit(bits))
        over = F.col("load") > (capacity if bits < most_bits else F.lit(2**62))
        fit = loads.filter(~over).select("prefix", "depth")
        leaves = fit if leaves is None else leaves.union(fit)
        full = loads.filter(over).select("prefix")
        if full.isEmpty():
            break
        live = saved(live.join(full, prefix == F.col("prefix"), "left_semi"), "directory-keys")
        bits += 1
    first = F.expr(f"shiftleft(prefix, {bits} - depth)")
    last = F.expr(f"shiftleft(prefix + 1, {bits} - depth) - 1")
    slots = leaves.select(F.explode(F.sequence(first, last)).alias("slot"), first.alias("bucket"), "depth")
    return saved(slots, "directory"), bits


def build_index(docs: DataFrame, keys: DataFrame, capacity: int = CAPACITY, key_bits: int = 63) -> DataFrame:
    """The index on shared files: bucket, key, place in the chain, text_sha256, keep_id, group_size, text."""
    slots, bits = directory(keys, capacity)
    small = slots.count() <= SENT_ROWS
    sent = raw_texts(docs).mapInArrow(_combined(key_bits), "key long, text binary, keep_id long, n long")
    placed = sent.withColumn("slot", F.shiftright("key", 63 - bits)).join(F.broadcast(slots) if small else slots, "slot")
    owned = placed.select("bucket", "key", "keep_id", "n", "text").repartition(
        partitions(docs.sparkSession), "bucket").sortWithinPartitions("bucket", "key")
    return saved(owned.mapInArrow(_own, "bucket long, key long, place int, text_sha256 string, keep_id long, group_size long, text binary"),
                 "exact-index")


def duplicates(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = 63) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of docs."""
    entries = saved(raw_texts(docs).mapInArrow(_entries(key_bits), "doc_id long, key long, text_sha256 string"), "exact-entries")
    index = build_index(docs, entries.select("key"), capacity, key_bits).select("key", "text_sha256", "keep_id", "group_size")
    return entries.join(index, ["key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), "text_sha256")


#: The same in SQL.
ORACLE = """
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
grouped AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY t)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept, sha256(t) AS text_sha256
FROM normal JOIN grouped USING (t)
"""
