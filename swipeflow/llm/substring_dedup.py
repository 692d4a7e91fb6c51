"""Repeated word runs across documents, found with suffix automata of reference shards.

A window is 13 consecutive words. A word is removed if a window that covers it also starts in a document with
a smaller doc_id.

1. The anchor of a window is its 5-word sequence with the smallest hash, so equal windows have equal anchors
   and neighbouring windows mostly share one. Owner tasks tell each chunk of documents which of its anchors
   other documents have too (one bit each); all other windows are unique and stay where they are. The chunk's
   cell keeps the length and anchor number of its runs, so later passes hash no words again.
2. Runs of windows with a shared anchor are the reference. They go to the shard of their anchor: each
   different run of a chunk once, with the smallest doc_id that has it. The runs of an anchor that would fill an
   automaton are sent window by window, each to the shard of the window's own hash: equal windows still meet.
3. A shard builds suffix automata over its runs. Every state keeps the smallest doc_id among the places where
   its strings end. Matching statistics of the runs then give, for each window, the state of its last 13 words
   and so the first document that has it. The answers go back to the chunks.

The reference is the whole corpus, so automata of all of it cannot be broadcast within a bound; a shard's
automata are built where the documents' runs are sent instead, one bounded automaton after another.

Null texts are empty; words are never changed. Rows that share a doc_id are one document; rows without
doc_id come after all others. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from swipeflow.llm import packs
from swipeflow.llm.near_dedup import WordHashes, window_hashes, word_hashes
from swipeflow.llm.tables import partitions, raw_texts, saved

CHUNK_BYTES = 8_000_000
#: Words of one suffix automaton, and words of the runs of one anchor that stay together.
AUTOMATON_WORDS = 100_000
#: Words of an anchor.
ANCHOR = 5
_LAST = np.iinfo(np.int64).max


class SuffixAutomaton:
    """Over word ids; low[state] is the smallest document among the ends of the state's strings, once closed."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.low = [-1], [0], [_LAST]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.low.append(_LAST)
        return len(self.next) - 1

    def _split(self, state: int, word: int) -> int:
        """The state of the longest string of `state` plus word, split off from longer ones if need be."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list[int], doc: int) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word)
            else:
                new = self._state(self.length[last] + 1, {}, 0)
                at = last
                while at >= 0 and word not in self.next[at]:
                    self.next[at][word] = new
                    at = self.link[at]
                if at >= 0:
                    self.link[new] = self._split(at, word)
                last = new
            if doc < self.low[last]:
                self.low[last] = doc

    def close(self) -> None:
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.low[state] < self.low[up]:
                self.low[up] = self.low[state]

    def first_documents(self, words: list[int], window: int) -> list[int]:
        """For each window of the words, the first document that has it (_LAST if none)."""
        out = []
        state = matched = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            while state and self.length[self.link[state]] >= window:
                state = self.link[state]
                matched = self.length[state]
            out.append(self.low[state] if matched >= window else _LAST)
        return out[window - 1:]


def _anchors(words: list[bytes], window: int, known: WordHashes) -> np.ndarray:
    """The anchor of each window."""
    k = min(ANCHOR, window)
    if len(words) < window:
        return np.empty(0, np.uint64)
    low = window_hashes(word_hashes(words, known), k)
    count, reach = len(words) - window + 1, 1
    while reach < window - k + 1:
        step = min(reach, window - k + 1 - reach)
        low = np.minimum(low[:len(low) - step], low[step:])
        reach += step
    return low[:count]


def _starts(anchors: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]]) if len(anchors) else np.empty(0, np.int64)


def _numbers(ids: list) -> list[int]:
    return [_LAST if i is None else i for i in ids]


def _runs_of(texts: list[bytes], window: int, buckets: int) -> tuple[tuple, np.ndarray, np.ndarray]:
    """The runs of a chunk, as its cell keeps them; the chunk's different anchors by bucket; the places of the runs in that order.

    Kept are the runs of each document, the windows and the anchor's place of each run, and the anchors of each bucket.
    """
    known = WordHashes()
    found, lengths = [], []
    for text in texts:
        anchors = _anchors(text.split(), window, known)
        starts = _starts(anchors)
        found.append(anchors[starts])
        lengths.append(np.diff(np.r_[starts, len(anchors)]).astype(np.int32))
    anchors = np.concatenate(found)
    bucket = anchors % np.uint64(buckets)
    order = np.lexsort((anchors, bucket))
    starts = _starts(anchors[order])
    place = np.empty(len(anchors), np.int32)
    place[order] = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.r_[starts, len(anchors)]))
    sizes = np.bincount(bucket[order][starts].astype(np.int64), minlength=buckets)
    counts = np.array([len(f) for f in found], np.int64)
    return (counts, packs.planes(np.concatenate(lengths)), packs.planes(place), sizes), anchors[order][starts], order


def _send_anchors(window: int, buckets: int):
    def make(ids: list, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        kept, distinct, order = _runs_of(texts, window, buckets)
        yield packs.CHUNK, packs.pack((ids, texts, kept))
        if not len(distinct):
            return
        counts, lengths, places, sizes = kept
        place = packs.from_planes(places, np.int32)[order]
        starts = np.searchsorted(place, np.arange(len(distinct)))
        docs = np.repeat(np.array(_numbers(ids), np.int64), counts)[order]
        # in runs of the usual length at most
        length = (packs.from_planes(lengths, np.int32)[order] + 2 * window - 2) // (2 * window)
        runs = np.add.reduceat(length, starts).astype(np.int32)
        several = np.minimum.reduceat(docs, starts) < np.maximum.reduceat(docs, starts)
        ends = np.cumsum(sizes)
        for b in np.flatnonzero(sizes).tolist():
            mine = slice(ends[b] - sizes[b], ends[b])
            yield b, packs.pack((distinct[mine], several[mine], packs.planes(runs[mine])))

    return make


def _shared_anchors(window: int):
    def own(cells: list[tuple[str, tuple]]) -> list[object]:
        """For each anchor of a cell whether other documents have it, and whether its runs would fill an automaton; the shared ones again."""
        anchors = np.concatenate([a for _, (a, _, _) in cells])
        several = np.concatenate([s for _, (_, s, _) in cells])
        runs = np.concatenate([packs.from_planes(r, np.int32) for _, (_, _, r) in cells])
        _, inverse, counts = np.unique(anchors, return_inverse=True, return_counts=True)
        shared = (counts > 1) | (np.bincount(inverse, weights=several) > 0)
        large = np.bincount(inverse, weights=runs) * 2 * window > AUTOMATON_WORDS
        out, at = [], 0
        for _, (own, _, _) in cells:
            mine = inverse[at:at + len(own)]
            out.append((np.packbits(shared[mine]), np.packbits(large[mine]), own[shared[mine]]))
            at += len(own)
        return out

    return own


class _Runs:
    """The runs of a chunk's documents whose anchors other documents have, the same each time they are taken.

    kept: the runs as the chunk's cell has them, so that no word is hashed again; without, they are found in the texts.
    """

    def __init__(self, texts: list[bytes], answers: list[dict], window: int, buckets: int, kept: tuple | None = None) -> None:
        self.texts, self.window, self.known = texts, window, WordHashes()
        counts, lengths, places, sizes = kept or _runs_of(texts, window, buckets)[0]
        shared, large = np.zeros((2, sizes.sum()), bool)
        anchors = np.zeros(len(shared), np.uint64)
        ends = np.cumsum(sizes)
        for answer in answers or []:
            b = answer["bucket"]
            mine = slice(ends[b] - sizes[b], ends[b])
            *bits, own = packs.unpack(answer["payload"])
            shared[mine], large[mine] = (np.unpackbits(x, count=sizes[b]).astype(bool) for x in bits)
            anchors[mine][shared[mine]] = own
        length, place = packs.from_planes(lengths, np.int32).astype(np.int64), packs.from_planes(places, np.int32)
        last, before = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(length)]
        live = np.flatnonzero(shared[place])
        # the live runs of document i are at[i] to at[i + 1]
        self.at = np.searchsorted(live, last)
        self.start = before[live] - before[last[np.searchsorted(last, live, "right") - 1]]
        self.length, self.anchors, self.large = length[live], anchors[place[live]], large[place[live]]

    def of(self, i: int, words: list[bytes] | None = None) -> Iterator[tuple[int, int, int, bytes]]:
        """(key of the shard, first window, windows, words) of each run of document i; windows of large anchors are runs of their own."""
        mine = slice(self.at[i], self.at[i + 1])
        if mine.start == mine.stop:
            return
        words = self.texts[i].split() if words is None else words
        large = self.large[mine]
        keys = window_hashes(word_hashes(words, self.known), self.window) if large.any() else None
        for s, n, a, apart in zip(*[x[mine].tolist() for x in (self.start, self.length, self.anchors, self.large)]):
            if apart:
                for at in range(s, s + n):
                    yield int(keys[at]), at, 1, b" ".join(words[at:at + self.window])
            else:
                yield a, s, n, b" ".join(words[s:s + n + self.window - 1])


def _send_runs(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, texts, kept = packs.unpack(row["payload"])
                runs = _Runs(texts, row["answers0"], window, buckets, kept)
                sent: dict[int, dict[bytes, list[int]]] = {}
                for i, doc in enumerate(_numbers(ids)):
                    for anchor, _, _, text in runs.of(i):
                        held = sent.setdefault(anchor % buckets, {}).setdefault(text, [anchor // buckets % 2**31, doc])
                        held[1] = min(held[1], doc)
                rows = [(row["chunk"], b, packs.pack((b"\n".join(own), np.array(list(own.values()), np.int64)))) for b, own in sent.items()]
                if rows:
                    yield packs.cells(rows)

    return run


def _first_documents(window: int):
    def own(cells: list[tuple[str, tuple]]) -> list[object]:
        first: dict[bytes, list[int]] = {}
        lists = []
        for _, (joined, facts) in cells:
            texts = joined.split(b"\n")
            lists.append(texts)
            for text, (salt, doc) in zip(texts, facts.tolist()):
                held = first.setdefault(text, [salt, doc])
                held[1] = min(held[1], doc)
        shards = sum(t.count(b" ") + 1 for t in first) // AUTOMATON_WORDS + 1
        parts: list[list[bytes]] = [[] for _ in range(shards)]
        for text, (salt, _) in first.items():
            parts[salt % shards].append(text)
        found: dict[bytes, np.ndarray] = {}
        for part in parts:
            number: dict[bytes, int] = {}
            coded = [[number.setdefault(w, len(number)) for w in text.split(b" ")] for text in part]
            automaton = SuffixAutomaton()
            for text, words in zip(part, coded):
                automaton.add(words, first[text][1])
            automaton.close()
            for text, words in zip(part, coded):
                found[text] = np.array(automaton.first_documents(words, window), np.int64)
        return [packs.planes(np.concatenate([found[t] for t in texts])) for texts in lists]

    return own


def _cut(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, texts, kept = packs.unpack(row["payload"])
                runs = _Runs(texts, row["answers0"], window, buckets, kept)
                first = {a["bucket"]: packs.from_planes(packs.unpack(a["payload"]), np.int64) for a in row["answers1"] or []}
                places: dict[int, dict[bytes, int]] = {}
                ends: dict[int, int] = {}
                out = []
                for i, doc in enumerate(_numbers(ids)):
                    words = texts[i].split()
                    n = len(words)
                    flags = np.zeros(max(n - window + 1, 0), bool)
                    for anchor, start, count, text in runs.of(i, words):
                        bucket = anchor % buckets
                        at = ends.setdefault(bucket, 0)
                        place = places.setdefault(bucket, {}).setdefault(text, at)
                        if place == at:
                            ends[bucket] = at + count
                        flags[start:start + count] = first[bucket][place:place + count] < doc
                    if flags.any():
                        depth = np.zeros(n + 1, np.int64)
                        hits = np.flatnonzero(flags)
                        depth[hits] += 1
                        depth[hits + window] -= 1
                        words = [words[k] for k in np.flatnonzero(np.cumsum(depth)[:n] == 0).tolist()]
                    out.append((ids[i], n, n - len(words), b" ".join(words)))
                    if len(out) == 1000 or i == len(ids) - 1:
                        columns = list(zip(*out))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                            names=["doc_id", "n_words", "n_removed", "kept"])
                        out = []

    return run


def remove_repeats(docs: DataFrame, window: int = 13, buckets: int | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by blanks, UTF-8) for each row."""
    buckets = buckets or partitions(docs.sparkSession)
    sent = saved(raw_texts(docs).mapInArrow(packs.from_chunks(_send_anchors(window, buckets), chunk_bytes), packs.SCHEMA), "runs-anchors")
    shared = saved(packs.by_owner(sent.filter(sent["bucket"] != packs.CHUNK), _shared_anchors(window)), "runs-shared")
    runs = packs.with_answers(sent, shared).mapInArrow(_send_runs(window, buckets), packs.SCHEMA)
    first = packs.by_owner(runs, _first_documents(window))
    return packs.with_answers(sent, shared, first).mapInArrow(
        _cut(window, buckets), "doc_id long, n_words long, n_removed long, kept binary")
