"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from swipeflow.llm import (
    bpe, exact_dedup, fingerprints, license_scan, line_dedup, mixing, near_dedup, pii, substring_dedup, toxicity,
)
from swipeflow.llm.queries import VOCABULARY

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
NUMBERS = "7" * 30_000 + " " + "1 " * 5_000 + "." * 3_000 + "@" * 3_000 + "a" * 30_000
ROWS = [
    (1, None, "en", None), (2, "", "en", "b"), (3, " \n\t ", "en", "a"), (4, "one", None, "a"), (5, "one", None, "a"),
    (5, "one", None, "a"), (5, "quite another text under the same id, with enough words for a shingle or two", "x", "c"),
    (None, "no id at all but words enough to make a shingle", "en", "a"), (None, None, None, None), (None, "one", "en", "a"),
    (6, LONG, "en", "a"), (7, LONG, "en", "b"), (8, NUMBERS, "en", "b"), (-9, "ONE", "en", "ä"),
    (10, "héllo wörld \U0001F600 中文 idiot", "zh", "\U0001F600"),
]
CLASHES = ("component node key bucket chunk payload row size number start sketch words at mark doc kept labelled toxic score "
           "target taken block of mixed_id mixed_row gone raw found spans sort_id n_shingles").split()


@pytest.fixture(scope="module")
def edges(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, None, 1), (4, 1, None), (5, 0, 0), (None, 1, 1), (10, 0, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "license_scan": lambda d, _: license_scan.scan(d),
    "exact_dedup": lambda d, _: exact_dedup.duplicates(d),
    "mixing": lambda d, _: mixing.mixed(d),
    "toxicity": lambda d, labels: toxicity.scored(d, labels),
    "pii": lambda d, _: pii.found(d),
    "substring_dedup": lambda d, _: substring_dedup.remove_repeats(d),
    "line_dedup": lambda d, _: line_dedup.without_repeats(d),
    "fingerprints": lambda d, _: fingerprints.edited(d),
    "near_dedup": lambda d, _: near_dedup.groups(d),
    "bpe": lambda d, _: bpe.encode(d, VOCABULARY),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(edges, labels, name):
    rows = OPERATORS[name](edges, labels).collect()
    count = lambda ids: {i: ids.count(i) for i in ids}
    assert count([r["doc_id"] for r in rows]) == count([r[0] for r in ROWS])


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(edges, labels, name):
    assert OPERATORS[name](edges.filter("false"), labels.filter("false")).count() == 0


def test_defined_results(edges, labels):
    exact = {(r.doc_id, r.group_size): r for r in exact_dedup.duplicates(edges).collect()}
    assert exact[4, 5].keep_id == 5 and not exact[4, 5].kept and exact[5, 5].kept
    assert exact[1, 3].keep_id == 2 and not exact[None, 3].kept
    near = {(r.doc_id, r.n_shingles): r for r in near_dedup.groups(edges).collect()}
    assert near[1, 0].component_id == 1 and near[2, 0].component_id == 2
    assert near[4, 1].component_id == -9 and near[5, max(n for d, n in near if d == 5)].component_id == -9 and near[7, near[6, max(n for d, n in near if d == 6)].n_shingles].component_id == 6
    cut = {r.doc_id: r for r in substring_dedup.remove_repeats(edges).collect() if r.doc_id}
    assert cut[7].n_removed == 60_000 and cut[6].n_removed == 0 and cut[1].n_words == 0
    mixed = mixing.mixed(edges).collect()
    assert all(r.taken <= 3 * r.size for r in mixed)
    lines = {r.doc_id: r for r in line_dedup.without_repeats(edges).collect() if r.doc_id}
    assert lines[7].n_removed == 1 and lines[7].kept == "" and lines[6].n_removed == 0 and lines[3].n_lines == 0
    nexts = {r.doc_id: r for r in fingerprints.edited(edges).collect()}
    assert nexts[3].fingerprint == "" and nexts[6].fingerprint == nexts[7].fingerprint and nexts[7].near_next == 1.0


@pytest.mark.parametrize("step", range(4))
def test_stages_keep_columns(spark, edges, labels, step, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    name, stage = corpus_pipeline.STAGES[step]
    for docs in (edges, edges.filter("false")):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() <= 3 * len(ROWS)


def test_last_stage(spark, edges, tmp_path):
    assert corpus_pipeline.STAGES[4][1](spark, edges, str(tmp_path)).count() == len(ROWS)
