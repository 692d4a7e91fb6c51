"""Event cleaning, zone assignment, scans and enrichment."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeflow import schemas
from swipeflow.functions import times, values
from swipeflow.rules import ENTRY_CODES, EXIT_CODES
from swipeflow.session import config_table


def zone_table(spark: SparkSession, sites: Mapping[str, Mapping]) -> DataFrame:
    """Flatten a site configuration to (site, point name, zone, point type) rows.

    ``sites``: site -> {"zones": {zone: [names]}, "access_point_types": {name: type}}.
    A name listed under two zones of a site keeps the last one.
    """
    rows = []
    for site, cfg in sites.items():
        zone_of = {name: zone for zone, names in cfg["zones"].items() for name in names}
        kinds = cfg.get("access_point_types", {})
        rows += [(site, name, zone, kinds.get(name)) for name, zone in zone_of.items()]
    return config_table(spark, rows, schemas.ZONE_MAP)


def classify_direction(df: DataFrame, code: str = "transaction_type_id", other: str | None = "other",
                       out: str = "direction") -> DataFrame:
    return df.withColumn(out, values.direction(F.col(code), other))


def assign_zone(events: DataFrame, zones: DataFrame) -> DataFrame:
    """Keep events of mapped points and add zone_type and access_point_type (default door).

    The zone table is configuration, so its known size makes Spark broadcast it.
    """
    return events.join(zones, ["site_id", "territory_name"], "inner").withColumn(
        "access_point_type", F.coalesce("access_point_type", F.lit("door"))
    )


def keep_valid_events(events: DataFrame, zones: DataFrame) -> DataFrame:
    """Events with a time, an id, a known direction and a mapped point, in the event-table layout.

    The conditions are plain column filters ahead of the zone join, so they reach the scan.
    """
    valid = events.filter(
        F.col("event_dt").isNotNull() & (F.col("event_guid") != "")
        & F.col("transaction_type_id").isin(*ENTRY_CODES, *EXIT_CODES)
    )
    return (
        assign_zone(valid, zones)
        .withColumns({
            "direction": values.direction(F.col("transaction_type_id"), None),
            "event_dt_msk": F.col("event_dt"),
        })
        .select("site_id", "event_guid", "event_dt", "event_dt_msk", "transaction_type_id", "direction",
                "person_id", "territory_id", "territory_name", "zone_type", "access_point_type", "card_code")
    )


def count_skipped(events: DataFrame, zones: DataFrame) -> DataFrame:
    """Per site: events kept, and events skipped by the first reason that applies."""
    reason = (
        F.when(F.col("event_dt").isNull() | F.col("event_guid").isNull() | (F.col("event_guid") == ""),
               F.lit("no_time_or_id"))
        .when(values.direction(F.col("transaction_type_id"), None).isNull(), F.lit("unknown_code"))
        .when(F.col("zone_type").isNull(), F.lit("unmapped_point"))
    )
    return (
        events.join(zones, ["site_id", "territory_name"], "left").withColumn("reason", reason)
        .groupBy("site_id")
        .agg(
            F.count_if(F.col("reason").isNull()).alias("kept"),
            *[F.count_if(F.col("reason") == r).alias(r)
              for r in ("no_time_or_id", "unknown_code", "unmapped_point")],
        )
    )


def identified_only(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["person_id", "zone_type"])


def date_window(df: DataFrame, col: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows whose ``col`` lies in the report period, both ends included."""
    return df.filter(F.col(col).between(F.lit(first), F.lit(last)))


def reorder_columns(df: DataFrame, priority: Iterable[str] = schemas.EXPORT_PRIORITY) -> DataFrame:
    """Priority columns first (absent ones skipped), the rest after in their order."""
    lead = [c for c in priority if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def select_fields(events: DataFrame, names: Iterable[str]) -> DataFrame:
    """Catalogue fields in the requested order; names outside the catalogue are warned about and skipped.

    Unlike a remote source, a table can lack a catalogue field; that column is NULL.
    """
    chosen = []
    for name in names:
        if name not in schemas.EVENT_FIELDS:
            warnings.warn(f"unknown event field: {name}", stacklevel=2)
        elif name not in chosen:
            chosen.append(name)
    return events.select(*[
        F.col(n) if n in events.columns else F.lit(None).cast("string").alias(n) for n in chosen
    ])


def scan_history(events: DataFrame, date_from: dt.datetime, date_to: dt.datetime,
                 types: Iterable[int] | None = None, territories: Iterable[str] | None = None,
                 orgs: Iterable[str] | None = None, persons: Iterable[str] | None = None,
                 limit: int | None = None, people: DataFrame | None = None) -> DataFrame:
    """Events of a time range (both ends included) with optional code, point, unit and person sets.

    Units are looked up in ``people`` (person_id, org_id and, where sources are apart, source_id or site_id),
    as events name a person only.

    All predicates are plain column filters, so they reach the file scan; a
    table partitioned by month is pruned to the months of the range.
    """
    out = events.filter(F.col("event_dt").between(F.lit(date_from), F.lit(date_to)))
    if "month" in events.columns:
        first, last = (F.date_format(F.lit(at), "yyyy-MM") for at in (date_from, date_to))
        out = out.filter(F.col("month").between(first, last))
    for col, wanted in (("transaction_type_id", types), ("territory_id", territories), ("person_id", persons)):
        if wanted is not None:
            out = out.filter(F.col(col).isin(*wanted))
    if orgs is not None:
        if people is None:
            raise ValueError("a filter by unit needs the people table")
        keys = [c for c in ("source_id", "site_id") if c in events.columns and c in people.columns] + ["person_id"]
        out = out.join(people.filter(F.col("org_id").isin(*orgs)).select(*keys), keys, "left_semi")
    if limit is not None:
        out = out.orderBy("event_dt", "event_guid").limit(limit)
    return out


def join_dim(fact: DataFrame, dim: DataFrame, keys: list[str], spread: str | None = None) -> DataFrame:
    """Left join to a dimension that is unique on ``keys``.

    Rows whose last key is NULL match nothing, yet would all meet in one task;
    with ``spread`` (a high-cardinality column) each such row gets its own
    never-matching key. A hot non-NULL key stays one row on the dimension side,
    so AQE splits its fact partition, or broadcasts a dimension it measured small.
    """
    if spread is None:
        return fact.join(dim, keys, "left")
    key = keys[-1]
    join_key = F.coalesce(F.col(key), F.concat(F.lit("null:"), F.xxhash64(spread).cast("string")))
    right = dim.withColumnRenamed(key, "_key")
    joined = fact.withColumn("_key", join_key).join(right, [*keys[:-1], "_key"], "left")
    return joined.drop("_key")


def enrich_with_person(events: DataFrame, persons: DataFrame) -> DataFrame:
    """Events with the person's names, number and department."""
    attributes = persons.select(
        "site_id", "person_id", "last_name", "first_name", "middle_name", "tab_number", "department_name"
    )
    return join_dim(events, attributes, ["site_id", "person_id"], spread="event_guid").withColumn(
        "full_name", values.full_name(F.col("last_name"), F.col("first_name"), F.col("middle_name"))
    )


def prepare_export(raw: DataFrame, tz_hours: int = 3) -> DataFrame:
    """Typed export frame from the all-text event rows."""
    typed = raw.withColumns({
        "event_datetime": times.parse_any_utc(F.col("event_datetime")),
        "transaction_code": values.to_int(F.col("transaction_code")),
    })
    return add_time_parts(typed, tz_hours)


def add_time_parts(df: DataFrame, tz_hours: int = 3) -> DataFrame:
    """Local time, date, hour, weekday, tri-state direction and cleaned text, export column order."""
    local = times.local_time(F.col("event_datetime"), tz_hours)
    texts = [c for c in ("person_fullname", "person_lastname", "person_firstname", "department",
                         "territory_name", "zone_name", "tab_number", "card_code", "transaction_name")
             if c in df.columns]
    out = df.withColumns({
        "event_datetime_local": local,
        "date": F.to_date(local),
        "hour": F.hour(local),
        "weekday_num": F.weekday(local),
        "weekday": times.weekday_label(F.weekday(local)),
        "is_entry": values.is_entry(F.col("transaction_code")),
        **{c: values.clean_text(F.col(c)) for c in texts},
    })
    return reorder_columns(out)
