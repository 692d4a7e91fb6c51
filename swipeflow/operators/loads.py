"""Insert-ignore, upsert, incremental loads and the load plan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from swipeflow.operators.star import max_event_time

EVENT_KEY = ("source_id", "event_guid")


def first_per_key(batch: DataFrame, key: Sequence[str], order: Sequence[str] = (), last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``, then by the remaining columns.

    A map-side combined minimum or maximum, so many copies of one key shrink before the shuffle.
    """
    lead = [c for c in order if c not in key]
    rest = [c for c in batch.columns if c not in key and c not in lead]
    row = F.struct(*lead, *rest)
    picked = batch.groupBy(*key).agg((F.max(row) if last else F.min(row)).alias("_row"))
    return picked.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in batch.columns])


def append_if_absent(target: DataFrame, batch: DataFrame, key: Sequence[str] = EVENT_KEY,
                     order: Sequence[str] = (), fixed_time: str | None = None) -> DataFrame:
    """Batch rows whose key the target lacks, one per key (insert, on conflict do nothing).

    The target is only probed for the batch's keys: a batch Spark measures
    small is broadcast and the large target is not shuffled. A caller who knows that
    a key never comes back with another time names that column in ``fixed_time``;
    of the target only the batch's time range (and its months) is then read.
    """
    rows = first_per_key(batch, key, order)
    if fixed_time is not None:
        ends = batch.agg(F.min(fixed_time).alias("low"), F.max(fixed_time).alias("high"))
        low, high = ends.select("low").scalar(), ends.select("high").scalar()
        target = _since(target, low, fixed_time).filter(F.col(fixed_time) <= high)
    present = target.select(*key).join(rows.select(*key), list(key), "left_semi")
    return rows.join(present, list(key), "left_anti")


def _since(events: DataFrame, start: Column, time: str = "event_dt") -> DataFrame:
    """Rows from ``start`` on; in a table partitioned by month, from its month on."""
    out = events.filter(F.col(time) >= start)
    return out.filter(F.col("month") >= F.date_format(start, "yyyy-MM")) if "month" in events.columns else out


def insert_ignore(spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str] = EVENT_KEY,
                  order: Sequence[str] = ()) -> int:
    """Appends the new rows to a parquet table and returns how many were written."""
    new_rows = append_if_absent(spark.read.parquet(path), batch, key, order)
    seen = Observation()
    new_rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str], preserve: Sequence[str] = (),
           order: Sequence[str] = ()) -> DataFrame:
    """Target with batch rows replacing those of the same key; the last batch row by ``order`` wins.

    ``preserve`` columns of existing rows are not overwritten. The caller writes
    the result to a new location.
    """
    rows = first_per_key(batch, key, order, last=True)
    old = target.select(*key, F.struct(*[c for c in target.columns if c not in key]).alias("_old"))
    new = rows.select(
        *key,
        F.struct(*[(F.col(c) if c in rows.columns else F.lit(None).cast(target.schema[c].dataType)).alias(c)
                   for c in target.columns if c not in key]).alias("_new"),
    )
    merged = old.join(new, list(key), "full_outer")

    def value(c: str) -> Column:
        if c in key:
            return F.col(c)
        fresh = F.col("_new").isNotNull()
        if c in preserve:
            fresh = fresh & F.col("_old").isNull()
        return F.when(fresh, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)

    return merged.select(*[value(c) for c in target.columns])


def append_export(df: DataFrame, path: str, existing: DataFrame | None = None,
                  dedup_key: Sequence[str] | None = EVENT_KEY) -> None:
    """Appends rows to a CSV export; by default only those whose key it does not hold yet."""
    from swipeflow.sources.files import write_csv

    if existing is not None and dedup_key:
        df = append_if_absent(existing, df, dedup_key)
    elif dedup_key:
        df = first_per_key(df, dedup_key)
    write_csv(df, path, mode="append")


def incremental_load(target: DataFrame, source: DataFrame, lookback_hours: int = 25,
                     key: Sequence[str] = EVENT_KEY, sources: Sequence[str] | None = None,
                     fixed_time: str | None = None) -> DataFrame:
    """New rows of every source since its high-water mark less the lookback; sources without history are skipped.

    ``sources`` lists the configured sources; the marks then hold at most that
    many rows, and are broadcast on that ground. The oldest mark bounds the scan of ``source``.
    """
    if sources is not None:
        target, source = (df.filter(F.col("source_id").isin(*sources)) for df in (target, source))
    marks = max_event_time(target)
    oldest = marks.select(F.min("max_event_dt")).scalar() - F.expr(f"INTERVAL {lookback_hours} HOURS")
    if sources is not None:
        marks = F.broadcast(marks)
    recent = _since(source, oldest).join(marks, "source_id", "inner").filter(
        F.col("event_dt") >= F.col("max_event_dt") - F.expr(f"INTERVAL {lookback_hours} HOURS")
    ).drop("max_event_dt")
    return append_if_absent(target, recent.select(*source.columns), key, fixed_time=fixed_time)


def lookback_load(target: DataFrame, source: DataFrame, days: int = 2,
                  as_of: dt.datetime | Column | None = None, key: Sequence[str] = EVENT_KEY,
                  fixed_time: str | None = None) -> DataFrame:
    """New rows since midnight UTC ``days`` before ``as_of`` (default: the newest source row)."""
    end = source.select(F.max("event_dt")).scalar() if as_of is None else (
        as_of if isinstance(as_of, Column) else F.lit(as_of))
    start = F.date_trunc("day", end - F.expr(f"INTERVAL {days} DAYS"))
    recent = _since(source, start).filter(F.col("event_dt") <= end)
    return append_if_absent(target, recent, key, fixed_time=fixed_time)


def day_series(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    bounds = spark.createDataFrame([(first, last)], "first date, last date")
    return bounds.select(F.explode(F.sequence("first", "last")).alias("day"))


def periods_between(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Month periods of each bounds row: from the start's month on, the last one clipped to the end."""
    month = F.expr("INTERVAL 1 MONTH")
    first = F.date_trunc("month", F.col(start))
    return (
        bounds.filter(first < F.col(end))
        .withColumn("period_start", F.explode(F.sequence(first, F.col(end), month)))
        .filter(F.col("period_start") < F.col(end))
        .withColumn("period_end", F.least(F.col("period_start") + month, F.col(end)))
        .drop(start, end)
    )


def month_periods(spark: SparkSession, start: dt.datetime, end: dt.datetime) -> DataFrame:
    return periods_between(spark.createDataFrame([(start, end)], "start timestamp, end timestamp"))


def plan_backfill(ledger: DataFrame, periods: DataFrame) -> DataFrame:
    """Periods still to load: those missing from the ledger (pending) and those not done, in order."""
    missing = periods.join(ledger, ["source_id", "period_start"], "left_anti").withColumn("status", F.lit("pending"))
    open_rows = ledger.filter(F.col("status") != "done")
    cols = ["source_id", "period_start", "period_end", "status"]
    return missing.select(*cols).unionByName(open_rows.select(*cols)).orderBy("source_id", "period_start")
