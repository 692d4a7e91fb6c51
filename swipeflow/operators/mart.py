"""Daily presence mart and the queries on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.functions import values
from swipeflow.operators import events as ev
from swipeflow.operators import sessions as ss
from swipeflow.rules import (
    HIGH, LABEL_HIDDEN_EXIT, LABEL_OPEN_END, LABEL_OPEN_START, LOW, US_PER_HOUR, Rules,
)

COLUMNS = [
    "site_id", "person_id", "full_name", "tab_number", "department_name", "report_date", "zone_type",
    "total_minutes", "total_hours", "first_entry", "last_exit", "sessions_count", "has_open_end",
    "has_open_start", "comment", "confidence",
]


def attach_person(mart: DataFrame, persons: DataFrame) -> DataFrame:
    """Name, number and department of each mart row's person."""
    attributes = persons.select(
        "site_id", "person_id", "tab_number", "department_name",
        values.full_name(F.col("last_name"), F.col("first_name"), F.col("middle_name")).alias("full_name"),
    )
    return mart.join(attributes, ["site_id", "person_id"], "left").withColumn(
        "full_name", F.coalesce("full_name", F.lit("  "))
    )


def presence_mart(events: DataFrame, persons: DataFrame, rules: Rules) -> DataFrame:
    """Minutes and hours per person, day and zone with flags, comment and confidence.

    The sessions arrive partitioned by person, which also serves the grouping
    and the person join: neither shuffles the event side again.
    """
    spans = ss.session_spans(events, rules)
    if rules.slice_days:
        parts = ss.slice_by_day(spans, rules).withColumnsRenamed(
            {"slice_entry_us": "entry_us", "slice_exit_us": "exit_us"}
        )
    else:
        parts = spans.withColumnRenamed("session_date", "report_date")
        if rules.period:
            parts = ev.date_window(parts, "report_date", *rules.period)

    length = F.col("exit_us") - F.col("entry_us")
    if rules.slice_days:
        minutes = ss.minutes_of_us(F.sum(length))
        hours = ss.half_up(F.sum(length), US_PER_HOUR, 2) / F.lit(100.0)
    else:
        # These rules add up already rounded minutes.
        tenths = F.sum(ss.tenth_minutes(length))
        minutes = tenths / F.lit(10.0)
        hours = ss.half_up(tenths, 600, 2) / F.lit(100.0)

    def any_label(label: str):
        return F.bool_or(F.col("comment") == label)

    # The labels form a closed set, so their sorted distinct list follows from three flags.
    grouped = parts.groupBy(*ss.KEY, "report_date").agg(
        minutes.alias("total_minutes"),
        hours.alias("total_hours"),
        F.timestamp_micros(F.min("entry_us")).alias("first_entry"),
        F.timestamp_micros(F.max("exit_us")).alias("last_exit"),
        F.count(F.lit(1)).alias("sessions_count"),
        any_label(LABEL_OPEN_END).alias("has_open_end"),
        any_label(LABEL_OPEN_START).alias("has_open_start"),
        any_label(LABEL_HIDDEN_EXIT).alias("_hidden"),
        F.bool_or(F.col("confidence") == LOW).alias("_low"),
    )
    comment = F.concat_ws(
        "; ",
        F.when(F.col("has_open_end"), F.lit(LABEL_OPEN_END)),
        F.when(F.col("has_open_start"), F.lit(LABEL_OPEN_START)),
        F.when(F.col("_hidden"), F.lit(LABEL_HIDDEN_EXIT)),
    )
    day_rows = grouped.withColumns({
        "comment": F.nullif(comment, F.lit("")),
        "confidence": F.when(F.col("_low"), F.lit(LOW)).otherwise(F.lit(HIGH)),
    })
    return attach_person(day_rows, persons).select(*COLUMNS)


def ordered(mart: DataFrame) -> DataFrame:
    """Output order; the pipeline itself never sorts globally."""
    return mart.orderBy("site_id", "report_date", "full_name", "zone_type", "person_id")


def mart_for_site(mart: DataFrame, site: str) -> DataFrame:
    return mart.filter(F.col("site_id") == site).orderBy("report_date", "full_name", "zone_type", "person_id")


def anomalous_rows(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("comment").isNotNull()).orderBy("report_date", "full_name", "zone_type", "person_id")


def monthly_hours(mart: DataFrame) -> DataFrame:
    """Hours per person and zone over the report period."""
    return mart.groupBy("person_id", "full_name", "zone_type").agg(
        F.sum(F.col("total_hours").cast("decimal(18,2)")).cast("double").alias("hours")
    )


def daily_headcount(mart: DataFrame) -> DataFrame:
    """Persons per day and zone."""
    return mart.groupBy("report_date", "zone_type").agg(F.count_distinct("person_id").alias("persons"))


def daily_person_sketches(mart: DataFrame, lg_k: int = 12) -> DataFrame:
    """report_date, zone_type, persons (exact) and an HLL sketch of the persons: the stored, mergeable state.

    A day's sketch merges with any other day's, so distinct persons of any period come from the daily rows
    (relative standard error about 1.04 / sqrt(2 ** lg_k), 1.6 % at lg_k = 12).
    """
    rows = mart.filter(F.col("person_id").isNotNull())
    return rows.groupBy("report_date", "zone_type").agg(
        F.count_distinct("person_id").alias("persons"), F.hll_sketch_agg("person_id", lg_k).alias("sketch"))


def persons_by_month(mart: DataFrame, sketches: DataFrame | None = None) -> DataFrame:
    """month (first day), zone_type, persons (exact distinct persons) and persons_estimate (merged daily sketches)."""
    month = F.trunc("report_date", "month").alias("month")
    exact = mart.filter(F.col("person_id").isNotNull()).groupBy(month, "zone_type").agg(F.count_distinct("person_id").alias("persons"))
    sketches = daily_person_sketches(mart) if sketches is None else sketches
    merged = sketches.groupBy(month, "zone_type").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("persons_estimate"))
    same = exact["month"].eqNullSafe(merged["month"]) & exact["zone_type"].eqNullSafe(merged["zone_type"])
    return exact.join(merged, same).select(exact["month"], exact["zone_type"], "persons", "persons_estimate")


def write_mart(mart: DataFrame, path: str) -> None:
    """Parquet, one folder per report date, so that later reads prune by day."""
    mart.hint("rebalance", "report_date").write.mode("errorifexists").partitionBy("report_date").parquet(path)
