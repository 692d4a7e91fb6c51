"""CSV, parquet and JSON sources and sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def read_events_csv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False) -> DataFrame:
    """An event export with its types restored; no schema inference pass.

    Files of write_csv hold a row on each line, so Spark splits large ones. ``multi_line`` reads foreign
    files that have line ends inside quotes, each whole file in one task.
    """
    rows = (
        spark.read.schema(schema).option("header", True).option("multiLine", multi_line).option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)
    )
    return rows if multi_line else _texts(rows, _plain)


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    names = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[change(F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns])


def _one_line(text: Column) -> Column:
    """Line ends as backslash letters, and backslashes doubled."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _plain(text: Column) -> Column:
    """The text that _one_line was given: pieces between doubled backslashes hold single ones of line ends only."""
    pieces = F.transform(F.split(text, r"\\\\"), lambda p: F.replace(
        F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(pieces, "\\")).otherwise(text)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A row on each line; line ends inside values are written as \\n and \\r."""
    (
        _texts(df, _one_line).write.mode(mode).option("header", True).option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)
    )


def export(tables: Mapping[str, DataFrame], path: str, fmt: str = "csv") -> None:
    """Each named table to a folder of its own under ``path``."""
    for name, df in tables.items():
        target = f"{path.rstrip('/')}/{name}"
        if fmt == "csv":
            write_csv(df, target)
        elif fmt == "parquet":
            df.write.mode("errorifexists").parquet(target)
        else:
            raise ValueError("fmt must be csv or parquet")


def write_events(events: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Event table as parquet by source and month, so that time-range scans read only their months.

    Rebalanced by size: a source-month of many gigabytes is written by many tasks, a small one by one.
    """
    (
        events.withColumn("month", F.date_format("event_dt", "yyyy-MM"))
        .hint("rebalance", "source_id", "month")
        .write.mode(mode).partitionBy("source_id", "month").parquet(path)
    )


def read_json_pages(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Records (as VARIANT ``record``) of landed ``{"data": [...]}`` pages, one page per line."""
    pages = spark.read.text(path).select(F.try_parse_json("value").alias("page"))
    return records_of_pages(pages, limit)


def records_of_pages(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """Records of parsed pages; ``limit`` caps how many are taken."""
    rows = pages.select(
        *[c for c in pages.columns if c != "page"],
        F.posexplode(F.try_variant_get("page", "$.data", "array<variant>")).alias("item", "record"),
    )
    return rows if limit is None else rows.limit(limit)


def write_schema_text(profile: DataFrame, path: str, nested: DataFrame | None = None) -> None:
    """One line per field, ``field: schema``, then one per nested key, ``field.key: schema``, if given.

    A profile has one row per field, so one file is enough.
    """
    lines = profile.select(F.lit(0).alias("part"), F.concat_ws(": ", "field", "schema").alias("value"))
    if nested is not None:
        keyed = F.concat(F.concat_ws(".", "field", "key"), F.lit(": "), F.col("schema"))
        lines = lines.union(nested.select(F.lit(1), keyed))
    lines.orderBy("part", "value").coalesce(1).select("value").write.mode("errorifexists").text(path)
