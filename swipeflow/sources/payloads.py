"""Decoding of landed XML payloads into tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeflow.functions import times, values
from swipeflow.schemas import PILOT_FIELDS, STAR_FIELDS

# An element holds either text or a list of ids; this schema keeps positions of empty elements.
_VALUES = "Values struct<anyType:array<struct<_VALUE:string,guid:array<string>>>>"
_MEMBER = (
    "ID string, NAME string, DESC string, PARENT_ID string, ORG_ID string, TAB_NUM string, "
    "LAST_NAME string, FIRST_NAME string, MIDDLE_NAME string"
)
_TERRITORY = (
    "ID string, TYPE string, NAME string, DESC string, PARENT_ID string, COMPONENT_ID string, FEATURE_MASK string"
)
_TRANSACTION = "ID string, NAME string, CLASS_MASK string"


def read_event_files(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed event files as rows with the positional values.

    Files with one EventObject on each line (``multi_line=False``) are split by Spark; one with line ends
    inside its elements is read whole.
    """
    raw = spark.read.format("xml").option("rowTag", "EventObject").option("multiLine", multi_line).schema(_VALUES).load(path)
    return raw.select(F.col("Values.anyType").alias("items"))


def parse_event_payload(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds the positional values of one EventObject per row as ``items``."""
    return _parsed_once(raw, payload, _VALUES).withColumn("items", F.col("_parsed.Values.anyType")).drop("_parsed")


def _parsed_once(raw: DataFrame, payload: str, schema: str) -> DataFrame:
    """Adds ``_parsed`` through a generator, so that conditions on it are not pushed down as parses of their own."""
    return raw.withColumn("_parsed", F.explode(F.array(F.from_xml(payload, schema))))


def _item(position: int) -> Column:
    element = F.try_element_at("items", F.lit(position + 1))
    text = F.nullif(values.trimmed(element["_VALUE"]), F.lit(""))
    return F.coalesce(text, values.trimmed(F.try_element_at(element["guid"], F.lit(1))))


def decode_events(parsed: DataFrame, fields: Sequence[str], drop_missing: bool = False) -> DataFrame:
    """Positional values to named text columns.

    Missing positions are NULL, surplus ones are cut, of an id list the first
    id is taken. Without a value node a row is all NULL, or dropped.
    """
    rows = parsed.filter(F.col("items").isNotNull()) if drop_missing else parsed
    keep = [c for c in parsed.columns if c not in ("items", "payload")]
    return rows.select(*keep, *[_item(i).alias(name) for i, name in enumerate(fields)])


def decode_pilot_events(parsed: DataFrame, tz_hours: int = 3) -> DataFrame:
    """Typed events of the pilot layout; carries the other columns (such as site_id) along."""
    named = decode_events(parsed, PILOT_FIELDS)
    carried = [c for c in named.columns if c not in PILOT_FIELDS]
    return named.select(
        *carried,
        "event_guid",
        times.parse_device_time(F.col("event_dt"), tz_hours).alias("event_dt"),
        values.to_int(F.col("transaction_type_id")).alias("transaction_type_id"),
        values.to_uuid(F.col("person_id")).alias("person_id"),
        values.to_uuid(F.col("territory_ids")).alias("territory_id"),
        "territory_name",
        "card_code",
    )


def decode_star_events(parsed: DataFrame) -> DataFrame:
    """Typed events of the two-source layout: rows without id or readable time are left out (see count_star_events)."""
    named = decode_events(parsed, STAR_FIELDS, drop_missing=True)
    typed = named.withColumns({
        "event_dt": times.parse_iso_utc(F.col("event_dt")),
        "transaction_type_id": values.to_int(F.col("transaction_type_id")),
        "person_id": values.to_uuid(F.col("person_id"), zero_is_null=False),
        "territory_ids": values.first_territory_id(F.col("territory_ids")),
    }).withColumnRenamed("territory_ids", "territory_id")
    return typed.filter(F.col("event_guid").isNotNull() & F.col("event_dt").isNotNull())


def count_star_events(parsed: DataFrame, by: str = "source_id") -> DataFrame:
    """Per source: payloads that decode_star_events keeps, and those it drops by the first reason that applies."""
    reason = (
        F.when(F.col("items").isNull(), F.lit("no_values"))
        .when(_item(0).isNull(), F.lit("no_id"))
        .when(times.parse_iso_utc(_item(1)).isNull(), F.lit("no_time"))
    )
    return parsed.groupBy(by).agg(
        F.count_if(reason.isNull()).alias("kept"),
        *[F.count_if(reason == r).alias(r) for r in ("no_values", "no_id", "no_time")])


def _members(raw: DataFrame, schema: str, payload: str) -> DataFrame:
    keep = [F.col(c) for c in raw.columns if c != payload]
    names = [part.split()[0] for part in schema.split(", ")]
    return _parsed_once(raw, payload, schema).select(
        *keep, *[F.nullif(values.trimmed(F.col(f"_parsed.{n}")), F.lit("")).alias(n) for n in names])


def decode_persons(raw: DataFrame, rule: str = "org_id", payload: str = "payload",
                   synced_at: Column | None = None) -> DataFrame:
    """Persons with their department name, from one mixed list of org units and persons.

    ``rule`` tells persons from units: "org_id" (a valid unit id is present)
    or "tab_num" (a number is present). ``raw`` holds source_id and pos, the
    document position; of units with one id the last one names it. With ``synced_at`` (such as
    ``current_timestamp()``) the rows carry when they were taken.
    """
    members = _members(raw, _MEMBER, payload)
    if rule == "org_id":
        person, unit = values.to_uuid(F.col("ORG_ID")).isNotNull(), F.col("ORG_ID").isNull()
    elif rule == "tab_num":
        person, unit = F.col("TAB_NUM").isNotNull(), F.col("TAB_NUM").isNull()
    else:
        raise ValueError("rule must be org_id or tab_num")
    zero = rule == "org_id"
    units = (
        members.filter(unit)
        .select("source_id", values.to_uuid(F.col("ID"), zero).alias("org_id"), F.struct("pos", "NAME").alias("named"))
        .filter(F.col("org_id").isNotNull())
        .groupBy("source_id", "org_id").agg(F.max("named")["NAME"].alias("department_name"))
    )
    persons = members.filter(person).select(
        "source_id",
        values.to_uuid(F.col("ID"), zero).alias("person_id"),
        F.col("LAST_NAME").alias("last_name"),
        F.col("FIRST_NAME").alias("first_name"),
        F.col("MIDDLE_NAME").alias("middle_name"),
        F.col("TAB_NUM").alias("tab_number"),
        values.to_uuid(F.col("ORG_ID"), zero).alias("org_id"),
    )
    if rule == "org_id":
        persons = persons.filter(F.col("person_id").isNotNull())
    named = department_lookup(persons, units)
    return named if synced_at is None else named.withColumn("synced_at", synced_at)


def department_lookup(persons: DataFrame, units: DataFrame) -> DataFrame:
    """Department name by unit id; ``units`` is unique on (source_id, org_id)."""
    return persons.join(units, ["source_id", "org_id"], "left")


def decode_org_units(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Units of a mixed list of org units and persons; persons are the members with a unit of their own."""
    return _members(raw, _MEMBER, payload).filter(F.col("ORG_ID").isNull()).select(
        "source_id",
        values.to_uuid(F.col("ID"), False).alias("id"),
        F.col("NAME").alias("name"),
        F.col("DESC").alias("descr"),
        values.to_uuid(F.col("PARENT_ID"), False).alias("parent_id"),
    )


def decode_territories(raw: DataFrame, payload: str = "payload") -> DataFrame:
    return _members(raw, _TERRITORY, payload).select(
        "source_id",
        values.to_uuid(F.col("ID"), False).alias("id"),
        values.to_int(F.col("TYPE")).alias("type"),
        F.col("NAME").alias("name"),
        F.col("DESC").alias("descr"),
        values.to_uuid(F.col("PARENT_ID"), False).alias("parent_id"),
        F.col("COMPONENT_ID").alias("component_id"),
        F.col("FEATURE_MASK").alias("feature_mask"),
    )


def decode_transaction_types(raw: DataFrame, payload: str = "payload") -> DataFrame:
    return _members(raw, _TRANSACTION, payload).select(
        values.to_int(F.col("ID")).alias("id"),
        F.col("NAME").alias("name"),
        values.to_int(F.col("CLASS_MASK"), "bigint").alias("class_mask"),
    )
