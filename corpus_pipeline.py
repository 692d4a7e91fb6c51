"""From documents to token ids: drop toxic ones, cut repeated lines, keep one of each near-duplicate group, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from swipeflow.llm import bpe, line_dedup, mixing, near_dedup, toxicity
from swipeflow.llm.queries import VOCABULARY
from swipeflow.llm.tables import saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a lexicon learnt from the labels of those that came in."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; a document that only consisted of copies goes."""
    return line_dedup.deduplicated(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group with five-word shingles at a similarity of 0.8 or more."""
    return near_dedup.deduplicated(docs, shingle=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources reads them, up to three times."""
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the text they decode to."""
    return bpe.encode(docs, VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("near_dedup", keep_one_of_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]
#: Likelihoods, a learnt lexicon and BPE have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
