"""Attendance, department, point and hour-of-week reports over the export frame.

Each report collapses raw events with a map-side combined aggregation first;
distinct counts and per-person picks run on the collapsed rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeflow.functions.times import weekday_label


def _in() -> Column:
    return F.col("is_entry")


def _out() -> Column:
    return ~F.col("is_entry")


def events_summary(events: DataFrame) -> DataFrame:
    """One row: events, entries, exits, distinct persons, days and points, first and last date."""
    collapsed = events.groupBy("person_id", "date", "territory_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(_in()).alias("n_in"), F.count_if(_out()).alias("n_out")
    )
    return collapsed.agg(
        F.sum("n").alias("total_events"),
        F.sum("n_in").alias("entries"),
        F.sum("n_out").alias("exits"),
        F.count_distinct("person_id").alias("unique_persons"),
        F.count_distinct("date").alias("days"),
        F.count_distinct("territory_name").alias("points"),
        F.min("date").alias("date_from"),
        F.max("date").alias("date_to"),
    )


def _person_days(events: DataFrame) -> DataFrame:
    """One row per person and day: first entry, last exit, counts, and the name and department
    of the first event (``seen``) and of the first entry (``entered``).

    The first grouping also holds the shown name, so that its buffers are plain
    values and it runs as a hash aggregation; the second picks among few names.
    """
    named = events.groupBy("date", "person_id", "person_fullname", "department").agg(
        F.min(F.when(_in(), F.col("event_datetime_local"))).alias("first_entry"),
        F.max(F.when(_out(), F.col("event_datetime_local"))).alias("last_exit"),
        F.min("event_datetime").alias("first_event"),
        F.count_if(_in()).alias("n_in"),
        F.count_if(_out()).alias("n_out"),
    )
    far = F.lit("9999-12-31").cast("timestamp")
    first_seen = F.struct(F.coalesce("first_event", far).alias("ts"), "person_fullname", "department")
    first_in = F.struct(F.coalesce("first_entry", far).alias("ts"), "person_fullname", "department")
    return named.groupBy("date", "person_id").agg(
        F.min("first_entry").alias("first_entry"),
        F.max("last_exit").alias("last_exit"),
        F.sum("n_in").alias("n_in"),
        F.sum("n_out").alias("n_out"),
        F.min(first_seen).alias("seen"),
        F.min(F.when(F.col("n_in") > 0, first_in)).alias("entered"),
    )


def daily_attendance(events: DataFrame) -> DataFrame:
    """First entry and last exit per person and day, with the person's first-seen name and department.

    Hours are NULL when one side is missing and may be negative.
    """
    days = _person_days(events.filter(F.col("person_id").isNotNull()))
    # A person has one row per day here, so the window is bounded by the length of the history.
    meta = F.min("seen").over(Window.partitionBy("person_id"))
    seconds = (F.unix_micros("last_exit") - F.unix_micros("first_entry")) / F.lit(3.6e9)
    return (
        days.withColumn("meta", meta)
        .filter(F.col("date").isNotNull() & ((F.col("n_in") > 0) | (F.col("n_out") > 0)))
        .select(
            "date", "person_id", "first_entry", "last_exit", "meta.person_fullname", "meta.department",
            F.round(seconds, 2).alias("time_on_site_h"),
        )
    )


def daily_unique(attendance: DataFrame) -> DataFrame:
    return attendance.groupBy("date").agg(F.count_distinct("person_id").alias("unique_visitors"))


def entries_without_exit(events: DataFrame) -> DataFrame:
    """Person-days with an entry and no exit; a NULL person counts as one person.

    Entries and exits of a person-day meet in one grouping, so no join is needed.
    """
    return (
        _person_days(events)
        .filter((F.col("n_in") > 0) & (F.col("n_out") == 0))
        .select("date", "person_id", "entered.person_fullname", "entered.department")
        .orderBy("date", F.col("department").asc_nulls_last(), "person_id")
    )


def by_department(events: DataFrame) -> DataFrame:
    """Entries, distinct persons and days per department; events without department are left out."""
    collapsed = (
        events.filter(_in() & F.col("department").isNotNull())
        .groupBy("department", "person_id", "date")
        .agg(F.count("event_datetime_local").alias("n"))
    )
    return collapsed.groupBy("department").agg(
        F.sum("n").alias("total_entries"),
        F.count_distinct("person_id").alias("unique_persons"),
        F.count_distinct("date").alias("unique_days"),
    ).orderBy(F.desc("total_entries"), "department")


def by_territory(events: DataFrame) -> DataFrame:
    """Entries, exits and their total per point; events without point or direction are left out."""
    return (
        events.filter(F.col("territory_name").isNotNull() & F.col("is_entry").isNotNull())
        .groupBy("territory_name")
        .agg(F.count_if(_in()).alias("entries"), F.count_if(_out()).alias("exits"))
        .withColumn("total", F.col("entries") + F.col("exits"))
        .orderBy(F.desc("total"), "territory_name")
    )


def hourly_heatmap(events: DataFrame, wide: bool = False) -> DataFrame:
    """Entries per weekday and hour, long or as a weekday by 24 hours matrix filled with 0."""
    entries = events.filter(_in() & F.col("event_datetime_local").isNotNull())
    if not wide:
        cells = entries.groupBy("weekday_num", "hour").agg(F.count(F.lit(1)).alias("count"))
        return cells.withColumn("weekday", weekday_label(F.col("weekday_num"), unknown="?"))
    hours = [F.count_if(F.col("hour") == h).alias(f"h{h}") for h in range(24)]
    return entries.groupBy("weekday").agg(*hours)


def collection_summary(events: DataFrame, persons: DataFrame, site: str | None = None) -> DataFrame:
    """Per site, zone and direction: events, first and last time; plus the site's person counts."""
    if site is not None:
        events = events.filter(F.col("site_id") == site)
        persons = persons.filter(F.col("site_id") == site)
    collapsed = events.groupBy("site_id", "zone_type", "direction", "person_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_dt_msk").alias("dt_min"), F.max("event_dt_msk").alias("dt_max")
    )
    # Each person is counted at one of its few rows, so the distinct count needs no second pass.
    rows_of_person = Window.partitionBy("site_id", "person_id").orderBy("zone_type", "direction")
    counted = F.col("person_id").isNotNull() & (F.col("rn") == 1)
    zones = (
        collapsed.withColumn("rn", F.row_number().over(rows_of_person))
        .groupBy("site_id", "zone_type", "direction")
        .agg(
            F.sum("n").alias("cnt"), F.min("dt_min").alias("dt_min"), F.max("dt_max").alias("dt_max"),
            F.count_if(counted).alias("persons"),
        )
        .withColumn("persons_with_events", F.sum("persons").over(Window.partitionBy("site_id"))).drop("persons")
    )
    known = persons.groupBy("site_id").agg(F.count(F.lit(1)).alias("persons_count"))
    return (
        zones.join(known, "site_id", "left")
        .withColumn("persons_count", F.coalesce("persons_count", F.lit(0)))
        .orderBy("site_id", "zone_type", "direction")
    )
