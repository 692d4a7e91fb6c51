"""Toxicity: a weighted lexicon matched by Aho-Corasick.

Texts are folded first: compatibility forms, case, invisible characters, look-alike letters of other alphabets,
and digits or signs that stand for letters inside a word. What is not a letter or digit becomes a blank, so a
pattern " term " is a whole word and " term" the beginning of one.

The lexicon is learnt from labelled documents: words and word beginnings whose document frequency among toxic
labels stands out against the others (log odds with smoothing). It is fitted on at most SAMPLE labelled rows
with the smallest CRC-32 of their doc_id; all texts are then scored whole. A text's strength is the sum of
the weights it matches, each as often as its matches divided by the root of the text's length beyond a free
length, REPEATS at most: a text that goes on in the same words does not lose strength. Matches inside an
exception phrase do not count. A logistic curve over the strength, fitted on
the same rows, gives the score.

Null text is empty and scores as a text without a match. Null labels are left out, rows without doc_id are
never trained on, and a doc_id with several labels counts as toxic if one says so. Without a toxic label the
lexicon is empty and every score is the share of toxic labels (0 if there is none). Other columns are ignored.
"""

from __future__ import annotations

import re
import string
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.tables import texts

#: Labelled rows that the lexicon and the curve are fitted on, at most.
SAMPLE = 20_000
#: Patterns of the lexicon at most, those with the largest weight times support first.
LEXICON = 20_000
#: Toxic documents that must have a pattern; letters of a word beginning.
SUPPORT, STEM = 4, range(4, 9)
#: How much likelier a pattern must be under a toxic label, as log odds.
LEAST_WEIGHT = 3.5
REPEATS = 3
#: Words from which length counts.
FREE_WORDS = 200

#: Look-alikes of Latin letters, and signs read as letters inside words.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
}
IN_WORDS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "$": "s", "@": "a", "|": "i", "l": "i"}
#: Phrases in which a word of abuse is none.
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bag", "trash bags", "trash collection", "trash pickup",
    "circus clown", "clown fish", "idiot proof", "scum line", "pond scum", "stupid question",
)

_INVISIBLE = dict.fromkeys([0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_TRANSLATE = str.maketrans(LOOKALIKES) | _INVISIBLE
_SIGNS = str.maketrans(IN_WORDS)
_ODD_LETTER = re.compile("[" + "".join(LOOKALIKES) + "".join(map(chr, _INVISIBLE)) + "]")
_SIGN = re.compile("[0-9$@|]")
_TOKEN = re.compile(r"[\w$@|]+")
_BREAKS = string.punctuation + "\t\n\r\x0b\x0c"
_OTHER_BREAK = re.compile(r"[^\w ]")
_NO_WORD = re.compile(r"[\W_]+")


def _read_signs(match: re.Match) -> str:
    token = match[0]
    return token.translate(_SIGNS) if _SIGN.search(token) and any(c.isalpha() for c in token) else token


def fold(text: str) -> str:
    """Blank-separated folded words, with a blank at either end."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    # each step only where there is something for it to do: most texts need none
    if not text.isascii() and _ODD_LETTER.search(text):
        text = text.translate(_TRANSLATE)
    if _SIGN.search(text):
        text = _TOKEN.sub(_read_signs, text)
    for mark in _BREAKS:
        text = text.replace(mark, " ")
    if _OTHER_BREAK.search(text):
        text = _NO_WORD.sub(" ", text)
    while "  " in text:
        text = text.replace("  ", " ")
    return f" {text.strip()} ".replace("l", "i")


def patterns(folded: str) -> set[str]:
    """What a text offers the lexicon: its words and their beginnings."""
    found = set()
    for word in set(folded.split()):
        if len(word) > 2:
            found.add(f" {word} ")
            found.update(f" {word[:n]}" for n in STEM if n < len(word))
    return found


@dataclass(frozen=True)
class Lexicon:
    """Pattern weights and the curve from strength to score."""

    weights: dict[str, float]
    slope: float
    offset: float
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            found.add_word(pattern, (len(pattern), weight, pattern))
        for phrase in self.exceptions:
            phrase = fold(phrase)
            found.add_word(phrase, (len(phrase), None, phrase))
        found.make_automaton()
        return found

    def strength(self, automaton, text: str) -> float:
        folded = fold(text)
        hits = list(automaton.iter(folded))
        if not hits:
            return 0.0
        clear = [(end - n + 1, end) for end, (n, weight, _) in hits if weight is None]
        counts: Counter[str] = Counter()
        for end, (n, weight, pattern) in hits:
            if weight is None or any(a <= end - n + 1 and end <= b for a, b in clear):
                continue
            counts[pattern] += 1
        root = max(1.0, folded.count(" ") / FREE_WORDS) ** 0.5
        # the limit holds after the division, so it grows with the length as the divisor does
        return sum(self.weights[pattern] * min(n / root, REPEATS) for pattern, n in counts.items())

    def score(self, strength: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(strength) + self.offset, -30, 30)))


def _count_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of this task's rows by label."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            for pattern in patterns(fold(text)):
                counts.setdefault(pattern, [0, 0])[toxic] += 1
    if counts:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array([c for c, _ in counts.values()], pa.int64()),
             pa.array([t for _, t in counts.values()], pa.int64())], names=["pattern", "clean", "toxic"])


def _curve(strength: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """A logistic curve over log(1 + strength) by Newton steps, with a light pull to zero slope."""
    x = np.column_stack([np.log1p(strength), np.ones(len(strength))])
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag([0.02, 1e-6]), x.T @ (toxic - p) - np.array([0.02, 1e-6]) * at)
        at = at + step
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Learns from the labelled rows of docs whose doc_id is not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("labelled"), F.col("toxic").cast("int").alias("toxic")).filter(
        "labelled is not null and toxic in (0, 1)").groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    mark = F.crc32(F.col("labelled").cast("string").cast("binary"))
    chosen = known.filter(mark % 5 != 0).orderBy(mark, "labelled").limit(sample)
    # `sample` rows of 12 bytes bound what is sent to every task
    rows = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled")).select("text", "toxic").repartition(24).persist()
    try:
        sums = rows.groupBy("toxic").count().collect()
        n = {r["toxic"]: r["count"] for r in sums}
        clean, toxic = n.get(0, 0), n.get(1, 0)
        if not toxic:
            return Lexicon({}, 0.0, -30.0, exceptions)
        odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
        found = rows.mapInArrow(_count_patterns, "pattern string, clean long, toxic long").groupBy("pattern").agg(
            F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(F.col("toxic") >= SUPPORT).withColumn(
            "weight", odds).filter(F.col("weight") >= LEAST_WEIGHT)
        best = found.orderBy((F.col("weight") * F.col("toxic")).desc(), "pattern").limit(LEXICON).collect()
        lexicon = Lexicon({r["pattern"]: r["weight"] for r in best}, 0.0, 0.0, exceptions)
        pairs = rows.mapInArrow(_strengths(lexicon, "toxic"), "toxic int, strength double").collect()
        return Lexicon(lexicon.weights, *_curve(np.array([r["strength"] for r in pairs]), np.array([r["toxic"] for r in pairs])), exceptions)
    finally:
        rows.unpersist()


def _strengths(lexicon: Lexicon, carried: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [lexicon.strength(automaton, t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column(carried), pa.array(found, pa.float64())], names=[carried, "strength"])

    return run


def _scores(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = sent.value
        automaton = lexicon.automaton()
        for batch in batches:
            found = np.array([lexicon.strength(automaton, t.as_py()) for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lexicon.score(found))], names=["doc_id", "score"])

    return run


def scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score for each row of docs. The lexicon sent to every task has at most LEXICON patterns."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    return texts(docs).mapInArrow(_scores(sent), "doc_id long, score double")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs; held-out rows are not learnt from."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scores(docs, fit(docs, labels)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def _kept(sent, columns: list[str], at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = sent.value
        automaton = lexicon.automaton()
        for batch in batches:
            found = np.array([lexicon.strength(automaton, t.as_py() or "") for t in batch.column(at)])
            yield batch.filter(pa.array(lexicon.score(found) < 0.5))

    return run


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that score 0.5 or more."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return docs.mapInArrow(_kept(sent, docs.columns, docs.columns.index("text")), docs.schema)
