"""Interactive look-ups: who is on site, last events, histories, person search."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeflow.functions import times, values


def latest_time(events: DataFrame) -> Column:
    """Newest event time as a scalar subquery (the default for ``as_of``)."""
    return events.select(F.max("event_dt")).scalar()


def _since(events: DataFrame, as_of: dt.datetime | Column | None, hours: int) -> DataFrame:
    end = latest_time(events) if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    return events.filter(F.col("event_dt").between(end - F.expr(f"INTERVAL {hours} HOURS"), end))


def latest_per_person(events: DataFrame) -> DataFrame:
    """Newest event of each person; of simultaneous ones the smallest id.

    A map-side combined minimum, so a person's events never meet in one task.
    """
    rest = [c for c in events.columns if c not in ("person_id", "event_dt", "event_guid")]
    row = F.struct((-F.unix_micros("event_dt")).alias("_age"), "event_guid", "event_dt", *rest)
    picked = (
        events.filter(F.col("person_id").isNotNull() & F.col("event_dt").isNotNull())
        .groupBy("person_id").agg(F.min(row).alias("r"))
    )
    return picked.select(*[F.col(c) if c == "person_id" else F.col(f"r.{c}").alias(c) for c in events.columns])


def last_known_status(events: DataFrame, as_of: dt.datetime | Column | None = None, hours: int = 12) -> DataFrame:
    """on_site / left per person by the newest event of the window; other codes give neither."""
    status = F.when(values.is_entry(F.col("transaction_type_id")), F.lit("on_site")).otherwise(F.lit("left"))
    return (
        latest_per_person(_since(events, as_of, hours))
        .filter(values.is_entry(F.col("transaction_type_id")).isNotNull())
        .withColumn("status", status)
    )


def on_site_now(events: DataFrame, as_of: dt.datetime | Column | None = None, hours: int = 12) -> DataFrame:
    """Persons whose newest event in the window is an entry, newest first."""
    return (
        last_known_status(events, as_of, hours).filter(F.col("status") == "on_site").drop("status")
        .orderBy(F.desc("event_dt"), "event_guid")
    )


def last_n_events(events: DataFrame, n: int = 20) -> DataFrame:
    return events.orderBy(F.desc("event_dt"), F.desc("event_guid")).limit(n)


def events_for_person(events: DataFrame, person_id: str | Column, as_of: dt.datetime | Column | None = None,
                      hours: int = 72, cap: int | None = None) -> DataFrame:
    """One person's events of the last hours, oldest first; the first ``cap`` if one is given."""
    out = (
        _since(events, as_of, hours).filter(F.col("person_id") == person_id)
        .orderBy("event_dt", "event_guid")
    )
    return out if cap is None else out.limit(cap)


def events_for_point(events: DataFrame, territory_id: str | Column, as_of: dt.datetime | Column | None = None,
                     hours: int = 24, cap: int | None = None) -> DataFrame:
    """One point's events of the last hours, oldest first; the card code stands in for an empty name."""
    out = (
        _since(events, as_of, hours).filter(F.col("territory_id") == territory_id)
        .withColumn("shown_name", values.name_or_card(F.col("person_fullname"), F.col("card_code")))
        .orderBy("event_dt", "event_guid")
    )
    return out if cap is None else out.limit(cap)


def find_people(persons: DataFrame, last: str | None = None, first: str | None = None,
                middle: str | None = None) -> DataFrame:
    """Persons whose given name parts equal those asked for; a blank part matches any."""
    out = persons
    for col, wanted in (("last_name", last), ("first_name", first), ("middle_name", middle)):
        if wanted:
            out = out.filter(F.col(col) == wanted)
    return out.withColumn(
        "shown_name", values.short_name(F.col("last_name"), F.col("first_name"), F.col("middle_name"))
    )


def listing(events: DataFrame) -> DataFrame:
    """Display form of an event list: cut time text, name or card, dashes for what is missing."""
    return events.select(
        times.display_time(F.date_format("event_dt", "yyyy-MM-dd'T'HH:mm:ss")).alias("time"),
        F.coalesce(F.nullif(F.col("territory_name"), F.lit("")), F.lit("—")).alias("point"),
        values.name_or_card(F.col("person_fullname"), F.col("card_code")).alias("person"),
    )
