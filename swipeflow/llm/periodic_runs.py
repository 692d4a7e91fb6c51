"""Periodic runs of words, found through an enhanced suffix array of each document.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
``max(MIN_LENGTH, MIN_EXPONENT * q)`` words long, that no neighbouring word extends keeping period q.
Collapsing keeps the first q words of every run and drops the rest of it.

Per document (words mapped to integers):

1. the suffix array by prefix doubling (numpy sorts), the rank arrays of every doubling step, and from
   them the LCP array (binary lifting over the ranks, vectorised);
2. the LCP intervals bottom-up with a stack, children included; for an interval of depth D, only the
   suffixes of its smaller children (all but the largest child) are tested: a suffix i is the first half
   of a branching square of period D when suffix i + D lies in the same interval but in another child, and
   the second half of one when suffix i - D does (ISA membership);
3. a branching square whose root of D words is primitive is rotated to the left while the word before it
   equals the word D places later; the rotations of one square merge into the run of period D that ends
   where the square ends (a branching square cannot move right). No tree nodes are built.

A run of length >= 24 with period q repeats a stretch of at least 16 words (its length minus q); a
document in which no 16-word stretch occurs twice therefore has no run, and is answered without the
suffix array (an exact test by hashes of the 16-word windows; a collision only sends a document through
the full method).

Edge cases: null texts have no words; a null doc_id is carried; repeated rows give one result each; an
empty table gives an empty result; very long texts are taken whole (the suffix array of a document is
held by the task that owns it, linear in its words); ties are not an issue here (every run is reported).
Other input columns are left behind, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeflow.llm import packs

MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Every run repeats a stretch of this many words: min over q of max(MIN_LENGTH - q, (MIN_EXPONENT - 1) * q).
REPEAT = min(max(MIN_LENGTH - q, (MIN_EXPONENT - 1) * q) for q in range(1, MIN_LENGTH + 1))
SPACE = r"[\x20\x09-\x0D]+"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: Column) -> Column:
    """Words of a text column (null: none), unchanged."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of an integer sequence and the ranks of its prefixes of length 1, 2, 4, ..."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels = [rank]
    step = 1
    while True:
        second = np.full(n, -1, dtype=np.int64)
        second[:n - step] = rank[step:] if step < n else second[:0]
        order = np.lexsort((second, rank))
        changed = np.ones(n, dtype=np.int64)
        changed[1:] = (rank[order][1:] != rank[order][:-1]) | (second[order][1:] != second[order][:-1])
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(changed) - 1
        rank = new
        levels.append(rank)
        if rank.max(initial=-1) == n - 1:
            return order, levels
        step *= 2


def lcp_array(ids: np.ndarray, sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """lcp[p] = longest common prefix of suffixes sa[p - 1] and sa[p] (lcp[0] = 0)."""
    n = len(ids)
    a, b = sa[:-1].copy(), sa[1:].copy()
    common = np.zeros(n - 1 if n else 0, dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        length = 1 << level
        ok = (a + common + length <= n) & (b + common + length <= n)
        ia, ib = np.minimum(a + common, n - 1), np.minimum(b + common, n - 1)
        ok &= levels[level][ia] == levels[level][ib]
        common += np.where(ok, length, 0)
    return np.concatenate([[0], common]).astype(np.int64)


def _repeats(ids: np.ndarray, width: int) -> bool:
    """Whether some stretch of width ids may occur twice (hash equality; exact when False)."""
    n = len(ids)
    if n < width + 1:
        return False
    values = ids.astype(np.uint64) + np.uint64(1)
    windows = np.zeros(n - width + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            windows = windows * _BASE + values[k:n - width + 1 + k]
    return len(np.unique(windows)) < len(windows)


def _primes(m: int) -> list[int]:
    found, factor = [], 2
    while factor * factor <= m:
        if m % factor == 0:
            found.append(factor)
            while m % factor == 0:
                m //= factor
        factor += 1
    return found + ([m] if m > 1 else [])


def _primitive(ids: np.ndarray, i: int, period: int) -> bool:
    """Whether the period words from i are no power of a shorter word."""
    root = ids[i:i + period]
    return not any(np.array_equal(root[period // r:], root[:-(period // r)]) for r in _primes(period))


def _left_end(ids: np.ndarray, i: int, period: int) -> int:
    """First position of the stretch with period period that ends at i + 2 * period - 1 and holds position i."""
    start, step = i, 64
    while start > 0:
        low = max(0, start - step)
        same = ids[low:start] == ids[low + period:start + period]
        if not same.all():
            return low + int(np.flatnonzero(~same)[-1]) + 1
        start, step = low, step * 2
    return 0


def branching_squares(sa: np.ndarray, lcp: np.ndarray) -> set[tuple[int, int]]:
    """(start, period) of every branching square: both halves equal, the next word breaks the period."""
    n = len(sa)
    isa = np.empty(n, dtype=np.int64)
    isa[sa] = np.arange(n)
    sa_list, isa_list = sa.tolist(), isa.tolist()
    heights = lcp.tolist() + [0]
    found: set[tuple[int, int]] = set()
    stack: list[list] = [[0, 0, []]]  # depth, left bound, child intervals (lb, rb)

    def visit(depth: int, lb: int, rb: int, children: list[tuple[int, int]]) -> None:
        if depth == 0:
            return
        parts, p = [], lb
        for c_lb, c_rb in children:
            parts.extend((q, q) for q in range(p, c_lb))
            parts.append((c_lb, c_rb))
            p = c_rb + 1
        parts.extend((q, q) for q in range(p, rb + 1))
        largest = max(range(len(parts)), key=lambda k: parts[k][1] - parts[k][0])
        for k, (c_lb, c_rb) in enumerate(parts):
            if k == largest:
                continue
            for p in range(c_lb, c_rb + 1):
                i = sa_list[p]
                for j, first in ((i + depth, i), (i - depth, i - depth)):
                    if 0 <= j < n:
                        r = isa_list[j]
                        if lb <= r <= rb and not c_lb <= r <= c_rb:
                            found.add((first, depth))

    for idx in range(1, n + 1):
        height = heights[idx]
        lb = idx - 1
        last = None
        while height < stack[-1][0]:
            depth, left, children = stack.pop()
            visit(depth, left, idx - 1, children)
            last = (left, idx - 1)
            lb = left
            if height <= stack[-1][0]:
                stack[-1][2].append(last)
                last = None
        if height > stack[-1][0]:
            stack.append([height, lb, [last] if last else []])
    return found


def runs_of(tokens: list[str] | np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n = len(tokens)
    if n < MIN_LENGTH:
        return []
    ids = pd.factorize(np.asarray(tokens, dtype=object))[0].astype(np.int64)
    if not _repeats(ids, REPEAT):
        return []
    sa, levels = suffix_array(ids)
    lcp = lcp_array(ids, sa, levels)
    runs = set()
    for i, period in branching_squares(sa, lcp):
        if not _primitive(ids, i, period):
            continue
        start = _left_end(ids, i, period)
        length = i + 2 * period - start
        if length >= max(MIN_LENGTH, MIN_EXPONENT * period):
            runs.add((start, length, period))
    return sorted(runs, key=lambda run: (run[0], run[2]))


def collapsed(tokens: list[str] | np.ndarray, runs: list[tuple[int, int, int]]) -> str:
    """The words left when every run keeps only its first period words, joined by one space."""
    if not runs:
        return " ".join(tokens)
    keep = np.ones(len(tokens), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return " ".join(str(w) for w, k in zip(tokens, keep) if k)


def _found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        runs, kept = [], []
        for tokens in batch["words"]:
            tokens = [] if tokens is None else tokens
            found = runs_of(tokens)
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            kept.append(collapsed(tokens, found))
        yield pd.DataFrame({"row": batch["row"], "doc_id": batch["doc_id"], "n_words": batch["words"].map(lambda t: 0 if t is None else len(t)),
                            "runs": runs, "collapsed": kept})
    packs.release()


SCHEMA = "row long, doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def detected(sequences: DataFrame) -> DataFrame:
    """For rows (row, doc_id, words array): n_words, runs (start, length, period by start, then period), collapsed."""
    return sequences.select("row", "doc_id", "words").mapInPandas(_found, SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """row, doc_id, words of every row, with a periodic tail planted in one document of about ten.

    h = crc32 of the decimal doc_id, g = h div 10; when h mod 10 = 0 and there are n > 0 words, word
    i >= a = g mod n becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Null doc_id: unchanged.
    """
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       words(docs["text"]).alias("words"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size("words")
    a = F.pmod(g, F.greatest(n, F.lit(1)))
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    tail = F.transform("words", lambda w, i: F.when(i >= a, F.element_at("words", (a + F.pmod(i - a, p) + 1).cast("int"))).otherwise(w))
    return base.withColumn("words", F.when(F.pmod(h, F.lit(10)) == 0, F.when(n > 0, tail).otherwise(F.col("words")))
                           .otherwise(F.col("words")))
