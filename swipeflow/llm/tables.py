"""Reading the corpus and keeping intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeflow.session import scratch_path

#: Words of every operator here: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text (null becomes empty); any other column is left behind, whatever its name."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))


def raw_texts(docs: DataFrame) -> DataFrame:
    """As texts(), with the text as UTF-8 bytes for Arrow tasks."""
    return texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"))


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """How many ranges of keys owner tasks share: what the session shuffles to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
