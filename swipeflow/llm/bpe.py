"""BPE encoding and decoding through a table of distinct words.

Texts are split at ASCII white space, which no piece of the tokenizer spans. A map task turns its chunk of
documents into positions in a list of the chunk's distinct words; the words go to owner tasks by hash,
where each distinct word of the corpus is encoded once; the ids come back to the chunk and are joined to
the positions. Decoding looks the ids up in the id-to-piece table, whose size is the vocabulary's.

What moves is one entry for each distinct word of a chunk, never one for each word of a text. A very
frequent word is one entry a chunk.

Null texts are empty texts (no ids, decoded ""), null or repeated doc_ids keep their rows, other columns
are ignored, an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from swipeflow.llm import packs
from swipeflow.llm.tables import partitions, raw_texts, saved

#: Bytes of text that a map task codes at once.
CHUNK_BYTES = 24_000_000
ENCODED = "doc_id long, n_tokens long, ids binary, decoded string"


def _positions(buckets: int):
    def make(ids: list, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        index: dict[bytes, int] = {}
        place = index.setdefault
        counts = np.empty(len(texts), np.int64)
        parts = []
        for i in range(len(texts)):
            words, texts[i] = texts[i].split(), b""
            counts[i] = len(words)
            parts.append(np.array([place(w, len(index)) for w in words], dtype=np.uint32))
        codes = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        words = list(index)
        del index, place, parts
        owner = np.fromiter((zlib.crc32(w) % buckets for w in words), np.uint32, len(words))
        # frequent words get small numbers; among equally frequent ones owners and letters are in order, which packs well
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        order = order[np.lexsort((owner[order], -np.bincount(codes, minlength=len(words))[order]))]
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        words, owner = [words[i] for i in order], owner[order]
        yield packs.CHUNK, packs.pack((ids, counts, packs.code_bytes(rank[codes]), packs.planes(owner)), level=6)
        order = np.argsort(owner, kind="stable")
        edges = np.searchsorted(owner[order], np.arange(buckets + 1))
        for b in range(buckets):
            if edges[b] < edges[b + 1]:
                yield b, packs.pack(b" ".join(words[i] for i in order[edges[b]:edges[b + 1]]), level=12)

    return make


def _encode_once(tokenizer_json):
    def own(cells: list[tuple[str, bytes]]) -> list[object]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(tokenizer_json.value)
        lists = [words.split(b" ") for _, words in cells]
        distinct = list(dict.fromkeys(chain.from_iterable(lists)))
        ids: list[list[int]] = []
        for at in range(0, len(distinct), 2000):
            part = [w.decode() for w in distinct[at:at + 2000]]
            ids += [e.ids for e in tokenizer.encode_batch(part, add_special_tokens=False)]
        of = dict(zip(distinct, ids))
        answers = []
        for words in lists:
            found = [of[w] for w in words]
            flat = np.fromiter(chain.from_iterable(found), np.uint32)
            answers.append((packs.planes(np.fromiter(map(len, found), np.uint32, len(found))), packs.planes(flat)))
        return answers

    return own


def _join_back(pieces):
    """Ids of each word by position, and the text that they decode to."""

    def one(ids, counts, codes, owner, answers) -> Iterator[pa.RecordBatch]:
        lengths = np.zeros(len(owner), np.int64)
        starts = np.zeros(len(owner), np.int64)
        flats, offset = [], 0
        for answer in answers or []:
            lens, flat = (packs.from_planes(x, np.uint32) for x in packs.unpack(answer["payload"]))
            mine = np.flatnonzero(owner == answer["bucket"])
            lengths[mine] = lens
            starts[mine] = offset + np.cumsum(lens, dtype=np.int64) - lens
            flats.append(flat)
            offset += len(flat)
        flat = np.concatenate(flats) if flats else np.empty(0, np.uint32)
        piece = pieces.value
        decoded = [" ".join([piece[t] for t in flat[s:s + n].tolist()]) for s, n in zip(starts.tolist(), lengths.tolist())]
        ends = np.cumsum(counts)
        for at in range(0, len(ids), 500):
            rows = []
            for i in range(at, min(at + 500, len(ids))):
                own = codes[ends[i] - counts[i]:ends[i]]
                n = lengths[own]
                total = int(n.sum())
                within = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
                text = " ".join([d for c in own.tolist() if (d := decoded[c])])
                rows.append((ids[i], total, flat[np.repeat(starts[own], n) + within].astype("<u4").tobytes(), text))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()),
                 pa.array(columns[3], pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, answers = batch.column("payload"), batch.column("answers0")
            for i in range(batch.num_rows):
                ids, counts, codes, owner = packs.unpack(payloads[i].as_py())
                yield from one(ids, counts, packs.from_code_bytes(*codes), packs.from_planes(owner, np.uint32),
                               answers[i].as_py())

    return packs.lean(run)


def piece_table(tokenizer_json: str) -> list[str]:
    """Id to piece: the vocabulary and the added tokens."""
    spec = json.loads(tokenizer_json)
    pieces = dict((i, p) for p, i in spec["model"]["vocab"].items())
    pieces.update((t["id"], t["content"]) for t in spec["added_tokens"])
    return [pieces.get(i, "") for i in range(max(pieces) + 1)]


def encode(docs: DataFrame, vocabulary: str, buckets: int | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded, one row for each row of docs.

    vocabulary: the path of a tokenizers file whose pre-tokenizer drops white space and which has no decoder
    (pieces are then joined by blanks) and no unknown token.
    """
    with open(vocabulary, encoding="utf-8") as file:
        spec = file.read()
    if json.loads(spec).get("decoder"):
        raise ValueError("a tokenizer with a decoder of its own is not decoded word by word")
    spark = docs.sparkSession
    context = spark.sparkContext
    buckets = buckets or partitions(spark)
    coded = saved(raw_texts(docs).mapInArrow(packs.from_chunks(_positions(buckets), chunk_bytes), packs.SCHEMA), "bpe-chunks")
    encoded = packs.by_owner(coded.filter(coded["bucket"] != packs.CHUNK), _encode_once(context.broadcast(spec)), level=12)
    return packs.with_answers(coded, encoded).mapInArrow(_join_back(context.broadcast(piece_table(spec))), ENCODED)
