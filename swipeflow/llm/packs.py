"""Packed rows: a chunk of documents, or what it sends to one owner task, travels as one compressed cell.

A cell holds what one map task saw, so its size is bounded by the chunk and not by any key of the data.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bucket: the owner task a cell is for; CHUNK for the chunk's own documents.
SCHEMA = "chunk string, bucket int, payload binary"
CHUNK = -1


def release() -> None:
    """Gives freed memory back to the system: Spark keeps Python workers for the next tasks, with what they hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable) -> Callable:
    """A mapInArrow function that releases memory when its task is done."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


def pack(value: object, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(value, protocol=5))


def unpack(payload: bytes) -> object:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


def planes(values: np.ndarray) -> np.ndarray:
    """The bytes of numbers, all lowest bytes first: small numbers then compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)


def from_planes(parts: np.ndarray, dtype: type) -> np.ndarray:
    return np.ascontiguousarray(parts.T).view(dtype).ravel()


def chunks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[bytes]]]:
    """Document ids and texts in lists of about `size` bytes; a longer text is alone at the end of its list."""
    ids: list = []
    held: list[bytes] = []
    n = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(doc_id)
            held.append(text)
            n += len(text) + 64
            if n >= size:
                yield ids, held
                ids, held, n = [], [], 0
    if ids:
        yield ids, held


def code_bytes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**30 with small ones most frequent: one byte for those below 192, four for the others."""
    large = codes >= 192
    rest = codes[large] - 192
    first = codes.astype(np.uint8)
    first[large] = 192 + (rest >> 16 & 63)
    return first, np.stack([rest & 255, rest >> 8 & 255, rest >> 22]).astype(np.uint8)


def from_code_bytes(first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    codes = first.astype(np.uint32)
    large = first >= 192
    low, middle, top = rest.astype(np.uint32)
    codes[large] = 192 + (low | middle << 8 | (codes[large] - 192) << 16 | top << 22)
    return codes


def cells(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    chunk, bucket, payload = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.string()), pa.array(bucket, pa.int32()), pa.array(payload, pa.binary())],
        names=["chunk", "bucket", "payload"])


def from_chunks(make: Callable[[list, list[bytes]], Iterator[tuple[int, bytes]]], size: int) -> Callable:
    """A mapInArrow function: make(ids, texts) gives (bucket, payload) cells of one chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, (ids, held) in enumerate(chunks(batches, size)):
            yield cells([(f"{task}-{n}", bucket, payload) for bucket, payload in make(ids, held)])

    return lean(run)


def by_owner(cells_table: DataFrame, own: Callable[[list[tuple[str, object]]], list[object]], level: int = 3) -> DataFrame:
    """Each bucket's cells in one owner task; own() answers every cell, in the order given."""

    def run(group: pa.Table) -> pa.Table:
        names = group.column("chunk").to_pylist()
        bucket = group.column("bucket")[0].as_py()
        order = sorted(range(len(names)), key=names.__getitem__)
        payloads = group.column("payload")
        answers = own([(names[i], unpack(payloads[i].as_py())) for i in order])
        out = pa.Table.from_batches([cells([(names[i], bucket, pack(a, level)) for i, a in zip(order, answers)])])
        del answers, payloads, group
        release()
        return out

    return cells_table.groupBy("bucket").applyInArrow(run, SCHEMA)


def with_answers(cells_table: DataFrame, *answers: DataFrame) -> DataFrame:
    """A row for each chunk: its own cell, and a list of (bucket, payload) from each table of answers."""
    out = cells_table.filter(F.col("bucket") == CHUNK).select("chunk", "payload")
    for i, table in enumerate(answers):
        listed = table.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "payload")).alias(f"answers{i}"))
        out = out.join(listed, "chunk", "left")
    return out
