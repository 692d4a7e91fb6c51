"""Every operator as a query over the given tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeflow.functions import times, values
from swipeflow.operators import events as ev
from swipeflow.operators import attendance, benchmark, hiring, ledger, loads, lookups, mart, profile, quality, reports, sessions, star, territory
from swipeflow.plans import fixtures as fx
from swipeflow.rules import ENTRY_CODES, EXIT_CODES
from swipeflow.session import scratch_path
from swipeflow.sources import files, payloads
from swipeflow.streaming import loader

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return add


def _zoned(spark: SparkSession, sf: str) -> DataFrame:
    return ev.keep_valid_events(fx.pilot_events(spark, sf), fx.zones(spark))


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return mart.presence_mart(_zoned(spark, sf), fx.persons(spark, sf), fx.CURRENT)


def _export(spark: SparkSession, sf: str) -> DataFrame:
    return ev.prepare_export(fx.export_rows(spark, sf))


# ---- presence ---------------------------------------------------------------

@query("presence_mart")
def presence_mart(spark, sf):
    return _mart(spark, sf)


@query("presence_mart_v1")
def presence_mart_v1(spark, sf):
    return mart.presence_mart(_zoned(spark, sf), fx.persons(spark, sf), fx.UNBOUNDED)


@query("presence_mart_same_day")
def presence_mart_same_day(spark, sf):
    return mart.presence_mart(_zoned(spark, sf), fx.persons(spark, sf), fx.SAME_DAY)


@query("sessions_v2")
def sessions_v2(spark, sf):
    return sessions.build_sessions(_zoned(spark, sf), fx.CURRENT)


@query("sessions_v1")
def sessions_v1(spark, sf):
    return sessions.build_sessions(_zoned(spark, sf), fx.UNBOUNDED)


@query("orphan_exits")
def orphan_exits(spark, sf):
    return sessions.as_timestamps(sessions.orphan_exits(_zoned(spark, sf), fx.CURRENT))


@query("orphan_exits_v1")
def orphan_exits_v1(spark, sf):
    return sessions.as_timestamps(sessions.orphan_exits(_zoned(spark, sf), fx.UNBOUNDED))


@query("sessions_sliced")
def sessions_sliced(spark, sf):
    spans = sessions.session_spans(_zoned(spark, sf), fx.CURRENT)
    return sessions.slice_by_day(spans, fx.CURRENT).select(
        *sessions.KEY, "report_date",
        F.timestamp_micros("slice_entry_us").alias("slice_entry"),
        F.timestamp_micros("slice_exit_us").alias("slice_exit"), "comment", "confidence")


@query("dedup_swipes")
def dedup_swipes(spark, sf):
    return sessions.drop_repeat_swipes(_zoned(spark, sf), fx.CURRENT)


@query("mart_anomalies")
def mart_anomalies(spark, sf):
    return mart.anomalous_rows(_mart(spark, sf))


@query("absence_runs")
def absence_runs(spark, sf):
    present = _mart(spark, sf).select("site_id", "person_id", "report_date")
    return attendance.absence_runs(present, fx.persons(spark, sf), *fx.PERIOD, days=fx.ABSENCE_DAYS)


@query("schedule_deviation")
def schedule_deviation(spark, sf):
    spans = sessions.session_spans(_zoned(spark, sf), fx.CURRENT).filter(F.col("zone_type") == "territory")
    shifts = attendance.planned_shifts(fx.shift_roster(spark, sf), fx.shift_patterns(spark), *fx.PERIOD, fx.CURRENT.tz_hours)
    return attendance.schedule_deviation(spans, shifts)


@query("hiring_funnel")
def hiring_funnel(spark, sf):
    return hiring.funnel(fx.stage_moves(spark, sf), fx.vacancies(spark, sf))


@query("interview_drop_off")
def interview_drop_off(spark, sf):
    return hiring.drop_off(fx.stage_moves(spark, sf), fx.vacancies(spark, sf), fx.quality_as_of(spark, sf))


@query("time_to_offer")
def time_to_offer(spark, sf):
    return hiring.time_to_offer(hiring.offer_times(fx.stage_moves(spark, sf), fx.vacancies(spark, sf))).drop(
        "sketch_median_days", "sketch_p90_days")


@query("presence_benchmark")
def presence_benchmark(spark, sf):
    return benchmark.presence_benchmark(_mart(spark, sf))


@query("persons_by_month")
def persons_by_month(spark, sf):
    return mart.persons_by_month(_mart(spark, sf)).drop("persons_estimate")


@query("ledger_attention")
def ledger_attention(spark, sf):
    return ledger.attention(fx.ledger_log(spark, sf), ledger.digests(fx.order_periods(spark, sf), "key", "value"))


@query("mart_site")
def mart_site(spark, sf):
    return mart.mart_for_site(_mart(spark, sf), "site_a")


@query("hours_by_person_zone")
def hours_by_person_zone(spark, sf):
    return mart.monthly_hours(_mart(spark, sf))


@query("persons_per_day_zone")
def persons_per_day_zone(spark, sf):
    return mart.daily_headcount(_mart(spark, sf))


# ---- events -----------------------------------------------------------------

@query("direction")
def direction(spark, sf):
    rows = ev.classify_direction(fx.all_events(spark, sf))
    return rows.select("event_guid", "transaction_type_id", "direction",
                       values.is_entry(F.col("transaction_type_id")).alias("is_entry"))


@query("valid_events")
def valid_events(spark, sf):
    return _zoned(spark, sf)


@query("skipped_events")
def skipped_events(spark, sf):
    return ev.count_skipped(fx.pilot_events(spark, sf), fx.zones(spark))


@query("zone_assignment")
def zone_assignment(spark, sf):
    return ev.assign_zone(fx.pilot_events(spark, sf), fx.zones(spark)).select(
        "event_guid", "site_id", "territory_name", "zone_type", "access_point_type")


@query("events_enriched")
def events_enriched(spark, sf):
    return ev.enrich_with_person(_zoned(spark, sf), fx.persons(spark, sf))


@query("select_fields")
def select_fields(spark, sf):
    return ev.select_fields(
        fx.export_rows(spark, sf),
        ["person_fullname", "event_datetime", "territory_name", "card_code", "tab_number"])


@query("scan_history")
def scan_history(spark, sf):
    return ev.scan_history(
        fx.star_rows(spark, sf), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 25, 23, 59, 59),
        types=ENTRY_CODES + EXIT_CODES)


@query("scan_history_sets")
def scan_history_sets(spark, sf):
    people = fx.persons(spark, sf)
    persons = [r.person_id for r in people.filter("person_id <= '00000000-0000-4000-9000-000000000099'").select(
        "person_id").distinct().orderBy("person_id").collect()]
    return ev.scan_history(
        fx.star_rows(spark, sf), dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), types=ENTRY_CODES,
        territories=[f"00000000-0000-4000-a300-{i:012d}" for i in range(6)],
        orgs=[f"00000000-0000-4000-a200-{i:012d}" for i in range(12)], persons=persons, people=people)


@query("prepare_export")
def prepare_export(spark, sf):
    return _export(spark, sf)


# ---- scalars ----------------------------------------------------------------

@query("parse_event_time")
def parse_event_time(spark, sf):
    at = F.col("event_dt")
    local = times.local_time(at)
    text = (
        F.when(F.col("transaction_type_id") == 590144, F.date_format(local, "d.MM.yyyy H:mm:ss"))
        .when(F.col("transaction_type_id") == 590145, F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("transaction_type_id") == 590152, F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("transaction_type_id") == 590153, F.concat(F.lit("около "), F.date_format(local, "HH:mm"))))
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return fx.all_events(spark, sf).select(
        "event_guid",
        times.parse_device_time(text).alias("device_time"),
        times.parse_iso_utc(F.when(F.col("person_id").isNotNull(), iso).otherwise(text)).alias("iso_time"),
        times.parse_any_utc(iso).alias("any_time"))


@query("op_day")
def op_day(spark, sf):
    return fx.all_events(spark, sf).select(
        "event_guid", times.op_date(F.col("event_dt")).alias("op_date"),
        times.op_date(F.col("event_dt"), start_hour=0).alias("calendar_date"))


@query("time_parts")
def time_parts(spark, sf):
    local = times.local_time(F.col("event_dt"))
    return fx.all_events(spark, sf).select(
        "event_guid", local.alias("local_time"),
        times.local_time(F.col("event_dt"), "Europe/Moscow").alias("zone_time"),
        F.to_date(local).alias("date"), F.hour(local).alias("hour"),
        F.weekday(local).alias("weekday_num"), times.weekday_label(F.weekday(local)).alias("weekday"))


@query("clean_ids")
def clean_ids(spark, sf):
    k = F.substring("territory_id", -1, 1)
    text = (
        F.when(k == "0", F.lit(values.ZERO_ID)).when(k == "1", F.concat(F.lit("  "), F.col("person_id"), F.lit(" ")))
        .when(k == "2", F.replace(F.col("event_guid"), F.lit("-"), F.lit("_"))).when(k == "3", F.col("card_code"))
        .otherwise(F.col("event_guid")))
    return fx.all_events(spark, sf).select(
        "event_guid", values.to_uuid(text).alias("pilot_id"),
        values.to_uuid(text, zero_is_null=False).alias("star_id"),
        values.to_int(F.when(k == "4", F.col("event_guid")).otherwise(F.col("card_code"))).alias("number"))


@query("first_territory")
def first_territory(spark, sf):
    k = F.substring("territory_id", -1, 1)
    a, b = F.col("territory_id"), F.col("event_guid")
    text = (
        F.when(k == "0", F.concat(a, F.lit(","), b)).when(k == "1", F.concat(a, F.lit(" "), b))
        .when(k == "2", F.concat(a, F.lit(";"), b)).when(k == "3", F.concat(F.lit(", ,"), a, F.lit("; x"), F.lit(",y")))
        .when(k == "4", F.lit(";")).when(k == "5", F.concat(a, F.lit(", "), b)).otherwise(a))
    return fx.all_events(spark, sf).select("event_guid", values.first_territory_id(text).alias("territory_id"))


@query("clean_text")
def clean_text(spark, sf):
    text = F.concat(F.lit("  "), F.col("department"), F.lit(" "))
    return fx.export_rows(spark, sf).select(
        "event_datetime", "card_code", values.clean_text(text).alias("department"),
        values.clean_text(F.col("zone_name")).alias("zone_name"))


@query("feature_mask")
def feature_mask(spark, sf):
    return territory.describe_territories(fx.territories(spark, sf)).select(
        "source_id", "id", "type_name", "feature_mask", "features")


# ---- reports ----------------------------------------------------------------

@query("events_summary")
def events_summary(spark, sf):
    return reports.events_summary(_export(spark, sf))


@query("daily_attendance")
def daily_attendance(spark, sf):
    return reports.daily_attendance(_export(spark, sf))


@query("daily_unique")
def daily_unique(spark, sf):
    return reports.daily_unique(reports.daily_attendance(_export(spark, sf)))


@query("no_exit")
def no_exit(spark, sf):
    return reports.entries_without_exit(_export(spark, sf))


@query("by_department")
def by_department(spark, sf):
    return reports.by_department(_export(spark, sf))


@query("by_territory")
def by_territory(spark, sf):
    return reports.by_territory(_export(spark, sf))


@query("hourly_heatmap")
def hourly_heatmap(spark, sf):
    return reports.hourly_heatmap(_export(spark, sf))


@query("heatmap_wide")
def heatmap_wide(spark, sf):
    return reports.hourly_heatmap(_export(spark, sf), wide=True)


@query("collection_summary")
def collection_summary(spark, sf):
    return reports.collection_summary(_zoned(spark, sf), fx.persons(spark, sf))


# ---- star -------------------------------------------------------------------

@query("star_events")
def star_events(spark, sf):
    people = star.apply_identities(fx.persons(spark, sf), *fx.SOURCES, dry_run=False)
    return star.star_events(fx.star_rows(spark, sf), fx.sources(spark), fx.types(spark), people,
                            fx.org_units(spark, sf), fx.territories(spark, sf))


@query("load_status")
def load_status(spark, sf):
    return star.load_status(fx.star_rows(spark, sf), fx.sources(spark), fx.persons(spark, sf),
                            fx.org_units(spark, sf), fx.territories(spark, sf), fx.types(spark),
                            fx.ledger(spark, sf))


@query("identity_matches")
def identity_matches(spark, sf):
    return star.match_identities(fx.persons(spark, sf), *fx.SOURCES)


@query("identity_numbers")
def identity_numbers(spark, sf):
    return star.match_numbers(fx.persons(spark, sf), *fx.SOURCES)


@query("identity_matches_top")
def identity_matches_top(spark, sf):
    return star.top_matches(fx.persons(spark, sf), *fx.SOURCES)


@query("identity_applied")
def identity_applied(spark, sf):
    return star.apply_identities(fx.persons(spark, sf), *fx.SOURCES, dry_run=False)


@query("common_tabs")
def common_tabs(spark, sf):
    return star.count_common_tabs(fx.persons(spark, sf), *fx.SOURCES)


@query("territory_paths")
def territory_paths(spark, sf):
    return territory.territory_paths(fx.territories(spark, sf)).select("source_id", "id", "parent_name", "full_path")


@query("territory_full_paths")
def territory_full_paths(spark, sf):
    return territory.territory_paths(fx.territories(spark, sf), full=True).select("source_id", "id", "full_path")


@query("territory_types")
def territory_types(spark, sf):
    return territory.territory_types(fx.territories(spark, sf))


@query("doors")
def doors(spark, sf):
    return territory.doors_only(territory.territory_paths(fx.territories(spark, sf))).select(
        "source_id", "id", "name", "parent_name")


@query("person_cards")
def person_cards(spark, sf):
    people = fx.persons(spark, sf).select("person_id", "last_name", "department_name")
    return territory.attach_cards(people, fx.cards(spark, sf))


# ---- look-ups ---------------------------------------------------------------

def _busiest(events: DataFrame, col: str) -> DataFrame:
    return events.filter(F.col(col).isNotNull()).groupBy(col).count().orderBy(F.desc("count"), col).limit(1).select(col)


def _named(spark: SparkSession, sf: str) -> DataFrame:
    names = fx.persons(spark, sf).select(
        "site_id", "person_id",
        values.short_name(F.col("last_name"), F.col("first_name"), F.col("middle_name")).alias("person_fullname"))
    return ev.join_dim(fx.pilot_events(spark, sf), names, ["site_id", "person_id"], spread="event_guid")


_SHOWN = ["event_dt", "event_guid", "transaction_type_id", "person_id", "territory_name"]


@query("on_site_now")
def on_site_now(spark, sf):
    return lookups.on_site_now(fx.pilot_events(spark, sf)).select(*_SHOWN)


@query("last_known_status")
def last_known_status(spark, sf):
    return lookups.last_known_status(fx.pilot_events(spark, sf), hours=72).select(*_SHOWN, "status")


@query("last_n_events")
def last_n_events(spark, sf):
    return lookups.last_n_events(fx.pilot_events(spark, sf)).select(*_SHOWN)


@query("person_history")
def person_history(spark, sf):
    rows = fx.pilot_events(spark, sf)
    return lookups.events_for_person(rows, _busiest(rows, "person_id").scalar(), hours=24 * 30).select(*_SHOWN)


@query("point_history")
def point_history(spark, sf):
    busiest = _busiest(fx.pilot_events(spark, sf), "territory_id").scalar()
    return lookups.events_for_point(_named(spark, sf), busiest).select(
        "event_dt", "event_guid", "territory_id", "shown_name")


@query("event_listing")
def event_listing(spark, sf):
    return lookups.listing(_named(spark, sf))


@query("find_people")
def find_people(spark, sf):
    return lookups.find_people(fx.persons(spark, sf), first="BUILDING", middle="M3").select(
        "source_id", "person_id", "shown_name", "tab_number", "org_id")


# ---- loads ------------------------------------------------------------------

_SPLIT = dt.datetime(2024, 1, 20)


def _held(spark: SparkSession, sf: str) -> DataFrame:
    return fx.star_rows(spark, sf).filter(F.col("event_dt") < F.lit(_SPLIT))


@query("events_insert_ignore")
def events_insert_ignore(spark, sf):
    rows = fx.star_rows(spark, sf)
    return loads.append_if_absent(_held(spark, sf), rows.unionByName(rows))


@query("insert_ignore_count")
def insert_ignore_count(spark, sf):
    rows, path = fx.star_rows(spark, sf), scratch_path(spark, "insert")
    _held(spark, sf).write.parquet(path)
    n = loads.insert_ignore(spark, path, rows.unionByName(rows))
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), F.lit(n).cast("long").alias("n_inserted"))


@query("stream_load")
def stream_load(spark, sf):
    schema = fx.table(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = fx.shape_events(raw).drop("site_id", "territory_name")
    path = scratch_path(spark, "watermark")
    # one batch, so that no event is late
    loader.stream_load(rows.unionByName(rows)).writeStream.format("parquet").option("path", f"{path}/table").option(
        "checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/table")


@query("insert_ignore_by_time")
def insert_ignore_by_time(spark, sf):
    recent = fx.star_rows(spark, sf).filter(F.col("event_dt") >= F.lit(dt.datetime(2024, 1, 15)))
    return loads.append_if_absent(_held(spark, sf), recent, fixed_time="event_dt")


@query("persons_upsert")
def persons_upsert(spark, sf):
    people = fx.persons(spark, sf).drop("site_id", "department_name")
    rich = fx.table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0).select(
        fx.guid("9000", F.col("c_custkey")).alias("person_id"))
    held = people.join(rich, "person_id", "left_semi").withColumn("canonical_person_id", F.col("person_id"))
    batch = people.withColumn("version", F.lit(1)).unionByName(
        people.withColumns({"version": F.lit(2), "last_name": F.upper("last_name")}))
    return loads.upsert(held, batch, ["source_id", "person_id"], preserve=["canonical_person_id"], order=["version"])


@query("incremental_load")
def incremental_load(spark, sf):
    return loads.incremental_load(_held(spark, sf), fx.star_rows(spark, sf), sources=fx.SOURCES)


@query("lookback_load")
def lookback_load(spark, sf):
    held = fx.star_rows(spark, sf).filter(F.col("transaction_type_id") != 590144)
    return loads.lookback_load(held, fx.star_rows(spark, sf))


@query("month_periods")
def month_periods(spark, sf):
    return loads.periods_between(fx.history_bounds(spark, sf))


@query("backfill_plan")
def backfill_plan(spark, sf):
    return loads.plan_backfill(fx.ledger(spark, sf), loads.periods_between(fx.history_bounds(spark, sf)))


@query("csv_roundtrip")
def csv_roundtrip(spark, sf):
    rows = _export(spark, sf)
    path = scratch_path(spark, "export")
    files.export({"events": rows}, path)
    return files.read_events_csv(spark, f"{path}/events", rows.schema)


@query("append_dedup")
def append_dedup(spark, sf):
    rows = fx.star_rows(spark, sf)
    path = scratch_path(spark, "append")
    loads.append_export(_held(spark, sf), path)
    loads.append_export(rows, path, existing=files.read_events_csv(spark, path, rows.schema))
    return files.read_events_csv(spark, path, rows.schema)


@query("stream_insert_ignore")
def stream_insert_ignore(spark, sf):
    schema = fx.table(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = fx.shape_events(raw).drop("site_id", "territory_name")
    path = scratch_path(spark, "stream")
    loader.start_insert_ignore(rows.unionByName(rows), f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/table")


# ---- payloads ---------------------------------------------------------------

@query("decode_events_xml")
def decode_events_xml(spark, sf):
    return payloads.decode_pilot_events(payloads.parse_event_payload(fx.event_payloads(spark, sf)))


@query("decode_star_xml")
def decode_star_xml(spark, sf):
    return payloads.decode_star_events(payloads.parse_event_payload(fx.star_payloads(spark, sf)))


@query("decode_star_rough")
def decode_star_rough(spark, sf):
    rows = payloads.decode_star_events(payloads.parse_event_payload(fx.rough_payloads(spark, sf)))
    return rows.select("source_id", "event_guid", "event_dt")


@query("star_decode_counts")
def star_decode_counts(spark, sf):
    return payloads.count_star_events(payloads.parse_event_payload(fx.rough_payloads(spark, sf)))


@query("event_files")
def event_files(spark, sf):
    path = scratch_path(spark, "event-files")
    fx.star_payloads(spark, sf).select("payload").write.text(path)
    return payloads.decode_star_events(payloads.read_event_files(spark, path, multi_line=False))


@query("decode_persons")
def decode_persons(spark, sf):
    return payloads.decode_persons(fx.member_payloads(spark, sf), synced_at=F.lit(dt.datetime(2024, 2, 1)))


@query("decode_persons_by_number")
def decode_persons_by_number(spark, sf):
    return payloads.decode_persons(fx.member_payloads(spark, sf), rule="tab_num")


@query("decode_reference")
def decode_reference(spark, sf):
    return payloads.decode_territories(fx.territory_payloads(spark, sf)).drop("descr")


@query("decode_org_units")
def decode_org_units(spark, sf):
    return payloads.decode_org_units(fx.member_payloads(spark, sf))


@query("decode_transaction_types")
def decode_transaction_types(spark, sf):
    return payloads.decode_transaction_types(fx.type_payloads(spark, sf))


# ---- JSON -------------------------------------------------------------------

@query("json_records")
def json_records(spark, sf):
    text = F.concat(F.lit('{"data":['), F.col("text"), F.lit(","), F.col("text"), F.lit("]}"))
    pages = fx.json_texts(spark, sf).select("pos", F.try_parse_json(text).alias("page"))
    return files.records_of_pages(pages).select(
        "pos", "item",
        F.try_variant_get("record", "$.k", "int").alias("k"),
        F.try_variant_get("record", "$.type", "string").alias("type"),
        F.try_variant_get("record", "$.value", "double").alias("value"),
        F.try_variant_get("record", "$.meta.user", "bigint").alias("user_id"))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return fx.json_texts(spark, sf).select("pos", F.try_parse_json("text").alias("record"))


@query("json_pages_files")
def json_pages_files(spark, sf):
    path = scratch_path(spark, "pages")
    fx.json_texts(spark, sf).select(F.concat(F.lit('{"data":['), F.col("text"), F.lit("]}"))).write.text(path)
    return files.read_json_pages(spark, path).select(
        F.try_variant_get("record", "$.k", "int").alias("k"), F.try_variant_get("record", "$.meta.user", "bigint").alias("user_id"))


@query("json_nested")
def json_nested(spark, sf):
    return profile.json_nested(_records(spark, sf))


@query("json_profile_nested")
def json_profile_nested(spark, sf):
    rows = fx.nested_json_texts(spark, sf).select("pos", F.try_parse_json("text").alias("record"))
    return profile.json_field_profile(rows)


@query("json_profile")
def json_profile(spark, sf):
    return profile.json_field_profile(_records(spark, sf))


@query("json_schema")
def json_schema(spark, sf):
    return profile.json_schema(_records(spark, sf))


@query("schema_text")
def schema_text(spark, sf):
    """The JSON schema written as text lines to the shared folder and read back."""
    path = scratch_path(spark, "schema-text")
    files.write_schema_text(profile.json_schema(_records(spark, sf)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


# ---- data quality -----------------------------------------------------------

@query("dq_no_recruiter")
def dq_no_recruiter(spark, sf):
    return quality.no_recruiter(fx.vacancies(spark, sf))


@query("dq_idle_sub")
def dq_idle_sub(spark, sf):
    return quality.idle_subs(fx.subs(spark, sf), fx.quality_as_of(spark, sf))


@query("dq_orphan_sub")
def dq_orphan_sub(spark, sf):
    return quality.orphan_subs(fx.subs(spark, sf), fx.vacancies(spark, sf))


@query("dq_unpublished")
def dq_unpublished(spark, sf):
    return quality.unpublished_parents(fx.subs(spark, sf), fx.vacancies(spark, sf))


@query("dq_form_share")
def dq_form_share(spark, sf):
    return quality.form_share(fx.candidates(spark, sf))


@query("dq_no_consent")
def dq_no_consent(spark, sf):
    return quality.no_consent(fx.candidates(spark, sf))


@query("dq_accepted_open")
def dq_accepted_open(spark, sf):
    return quality.accepted_not_closed(fx.applications(spark, sf), fx.vacancies(spark, sf))


@query("dq_unassigned")
def dq_unassigned(spark, sf):
    return quality.unassigned_inactive(fx.applications(spark, sf), fx.vacancies(spark, sf))


@query("dq_stuck")
def dq_stuck(spark, sf):
    return quality.stuck_candidates(fx.applications(spark, sf), fx.subs(spark, sf), fx.quality_as_of(spark, sf))


@query("dq_dashboard")
def dq_dashboard(spark, sf):
    return quality.dashboard(fx.vacancies(spark, sf), fx.subs(spark, sf), fx.candidates(spark, sf),
                             fx.applications(spark, sf), fx.quality_as_of(spark, sf))


@query("dq_dashboard_filtered")
def dq_dashboard_filtered(spark, sf):
    return quality.dashboard(fx.vacancies(spark, sf), fx.subs(spark, sf), fx.candidates(spark, sf),
                             fx.applications(spark, sf), fx.quality_as_of(spark, sf),
                             statuses=("open", "pause"), period=(dt.date(1994, 1, 1), dt.date(1997, 12, 31)))
