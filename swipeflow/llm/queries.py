"""The operators applied to the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeflow.llm import (
    bpe, exact_dedup, fingerprints, license_scan, line_dedup, mixing, near_dedup, periodic_runs, pii, simhash, substring_dedup,
    toxicity, whitening,
)
from swipeflow.llm.tables import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"), shingle=4)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), VOCABULARY)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_pii": op5_pii,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_fingerprints": op8_fingerprints,
    "op9_near_dedup": op9_near_dedup,
    "op10_bpe": op10_bpe,
}
ORACLES: dict[str, str] = {
    "op1_license_scan": license_scan.oracle(),
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
}


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id", "n_shingles")


def _before(x, y):
    """Run order of the best-run report: greater length/period (exact), then smaller start, then smaller period."""
    left, right = x["length"] * y["period"], y["length"] * x["period"]
    return (F.when(left > right, -1).when(left < right, 1).when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
            .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detected(periodic_runs.planted(table(spark, sf_dir, "documents")))
    best = F.get(F.array_sort("runs", _before), 0)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES |= {
    "op11_whitening": op11_whitening,
    "op12_simhash": op12_simhash,
    "op13_periodic_runs": op13_periodic_runs,
}
