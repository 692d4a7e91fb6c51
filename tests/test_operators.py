from __future__ import annotations

import datetime as dt
import re
import warnings

import pytest
from pyspark.sql import functions as F

from swipeflow import schemas
from swipeflow.operators import events as ev
from swipeflow.operators import loads, lookups, profile, quality, reports, star, territory
from swipeflow.session import clear_scratch, scratch_path
from swipeflow.sources import files, payloads
from swipeflow.streaming import loader

T0 = dt.datetime(2026, 3, 2, 8, 0)
G = "11111111-1111-1111-1111-1111111111{:02d}".format


def star_rows(spark, rows):
    return spark.createDataFrame(
        [(s, g, at, 590144, None, None, card) for s, g, at, card in rows], schemas.STAR_EVENTS)


# ---- payloads ----------------------------------------------------------------

def payload(*items):
    return "<EventObject><Values>" + "".join(items) + "</Values></EventObject>"


def test_decode_events_positions(spark):
    raw = spark.createDataFrame([
        (1, payload("<anyType>a</anyType>", "<anyType/>", "<anyType><guid> g1 </guid><guid>g2</guid></anyType>",
                    "<anyType>d</anyType>", "<anyType>cut</anyType>")),
        (2, payload('<anyType xsi:type="xsd:string" xmlns:xsi="u" xmlns:xsd="v">only</anyType>')),
        (3, "<EventObject></EventObject>"),
    ], "id int, payload string")
    parsed = payloads.parse_event_payload(raw)
    rows = payloads.decode_events(parsed, ["w", "x", "y", "z"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        (1, "a", None, "g1", "d"), (2, "only", None, None, None), (3, None, None, None, None)]
    assert payloads.decode_events(parsed, ["w"], drop_missing=True).count() == 2


def test_read_event_files(spark):
    path = scratch_path(spark, "xml")
    body = "<Result>" + payload("<anyType>a</anyType>", "<anyType>b</anyType>") * 3 + "</Result>"
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(path)
    rows = payloads.decode_events(payloads.read_event_files(spark, path), ["p", "q"]).collect()
    assert [tuple(r) for r in rows] == [("a", "b")] * 3


def test_decode_persons_rules(spark):
    unit, other = G(1), G(2)
    raw = spark.createDataFrame([
        ("s", 1, f"<OrgUnit><ID>{unit}</ID><NAME>old</NAME></OrgUnit>"),
        ("s", 2, f"<OrgUnit><ID>{unit}</ID><NAME>new</NAME></OrgUnit>"),
        ("s", 3, f"<Person><ID>{G(3)}</ID><LAST_NAME> A </LAST_NAME><ORG_ID>{unit}</ORG_ID></Person>"),
        ("s", 4, f"<Person><ID>{G(4)}</ID><TAB_NUM>7</TAB_NUM><ORG_ID>{other}</ORG_ID></Person>"),
        ("s", 5, f"<Person><ID>bad</ID><TAB_NUM>8</TAB_NUM><ORG_ID>{unit}</ORG_ID></Person>"),
    ], "source_id string, pos bigint, payload string")
    by_org = {r.person_id: (r.last_name, r.department_name) for r in payloads.decode_persons(raw).collect()}
    assert by_org == {G(3): ("A", "new"), G(4): (None, None)}
    by_tab = {r.tab_number: r.person_id for r in payloads.decode_persons(raw, "tab_num").collect()}
    assert by_tab == {"7": G(4), "8": None}
    with pytest.raises(ValueError):
        payloads.decode_persons(raw, "other")


# ---- events ------------------------------------------------------------------

def test_zone_table_last_zone_wins(spark):
    zones = ev.zone_table(spark, {"s": {"zones": {"a": ["x", "y"], "b": ["y"]}, "access_point_types": {"x": "turnstile"}}})
    assert sorted(tuple(r) for r in zones.collect()) == [("s", "x", "a", "turnstile"), ("s", "y", "b", None)]


def test_valid_events_and_skip_counts(spark):
    zones = ev.zone_table(spark, {"s": {"zones": {"a": ["x"]}}})
    rows = [("s", "g1", T0, 590144, "x"), ("s", "g2", None, 590144, "x"), ("s", "", T0, 590144, "x"),
            ("s", "g4", T0, 5, "x"), ("s", "g5", T0, 590145, "X"), ("s", None, T0, 590145, "x")]
    df = spark.createDataFrame(
        [(s, g, at, c, None, None, t, None) for s, g, at, c, t in rows],
        "site_id string, event_guid string, event_dt timestamp, transaction_type_id int, person_id string, "
        "territory_id string, territory_name string, card_code string")
    kept = ev.keep_valid_events(df, zones).collect()
    assert [(r.event_guid, r.direction, r.access_point_type) for r in kept] == [("g1", "entry", "door")]
    skipped = ev.count_skipped(df, zones).first()
    assert (skipped.kept, skipped.no_time_or_id, skipped.unknown_code, skipped.unmapped_point) == (1, 3, 1, 1)


def test_zone_join_is_broadcast_from_its_own_size(spark):
    zones = ev.zone_table(spark, {"s": {"zones": {"a": ["x"]}}})
    big = spark.range(10).selectExpr("concat('s', id) AS site_id", "concat('x', id) AS territory_name", "id")
    plan = ev.assign_zone(big, zones)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_select_fields_warns_on_unknown(spark):
    df = spark.createDataFrame([("n", "c")], "person_fullname string, card_code string")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        out = ev.select_fields(df, ["card_code", "nope", "person_fullname", "zone_name"])
    assert out.columns == ["card_code", "person_fullname", "zone_name"]
    assert len(seen) == 1
    assert len(schemas.EVENT_FIELDS) == 31


def test_reorder_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "x int, date int, hour int")
    assert ev.reorder_columns(df).columns == ["date", "hour", "x"]


def test_null_keys_are_spread_in_dimension_joins(spark):
    fact = spark.range(1000).selectExpr("'s' AS source_id", "IF(id < 900, NULL, 'p') AS person_id", "id AS event_guid")
    dim = spark.createDataFrame([("s", "p", "name")], "source_id string, person_id string, name string")
    out = ev.join_dim(fact, dim, ["source_id", "person_id"], spread="event_guid")
    assert out.columns == ["source_id", "person_id", "event_guid", "name"]
    assert out.count() == 1000
    assert out.filter("name IS NOT NULL").count() == 100
    assert out.filter("person_id IS NULL AND name IS NULL").count() == 900


def test_scan_history_prunes_months(spark):
    rows = [("msk", f"g{m}", dt.datetime(2026, m, 10), None) for m in range(1, 7)] * 2
    path = scratch_path(spark, "events")
    files.write_events(loads.first_per_key(star_rows(spark, rows), loads.EVENT_KEY), path)
    held = spark.read.parquet(path)
    got = ev.scan_history(held, dt.datetime(2026, 2, 10), dt.datetime(2026, 3, 9), types=[590144])
    assert [r.event_guid for r in got.collect()] == ["g2"]
    assert "PartitionFilters: [isnotnull(month" in got._jdf.queryExecution().toString()


def test_scan_history_sets_and_limit(spark):
    df = star_rows(spark, [("msk", f"g{i}", T0 + dt.timedelta(hours=i), None) for i in range(5)])
    out = ev.scan_history(df, T0, T0 + dt.timedelta(hours=4), types=[590144], limit=2)
    assert [r.event_guid for r in out.collect()] == ["g0", "g1"]
    assert ev.scan_history(df, T0, T0, persons=["p"]).count() == 0


# ---- reports -----------------------------------------------------------------

def export_frame(spark, rows):
    raw = spark.createDataFrame([dict(zip(schemas.EXPORT_FIELDS, r)) for r in rows],
                                ", ".join(f"{c} string" for c in schemas.EXPORT_FIELDS))
    return ev.prepare_export(raw)


def swipe(at, code, person, name="N", dept="D", point="P"):
    return (at, code, None, point, None, person, name, None, None, dept, None, None)


def test_daily_attendance_sides_and_first_name(spark):
    df = export_frame(spark, [
        swipe("2026-03-02T10:00:00Z", "590144", "a", name="first"),
        swipe("2026-03-02T04:00:00Z", "590145", "a", name="second"),
        swipe("2026-03-01T20:00:00Z", "599999", "a", name="zero"),
        swipe("2026-03-02T05:00:00Z", "590144", "b"),
        swipe("2026-03-02T05:00:00Z", "590144", None),
        swipe("junk", "590144", "b"),
    ])
    rows = {r.person_id: r for r in reports.daily_attendance(df).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].time_on_site_h == -6.0 and rows["a"].person_fullname == "zero"
    assert rows["b"].last_exit is None and rows["b"].time_on_site_h is None


def test_no_exit_matches_null_persons(spark):
    df = export_frame(spark, [
        swipe("2026-03-02T05:00:00Z", "590144", None), swipe("2026-03-02T06:00:00Z", "590145", None),
        swipe("2026-03-03T05:00:00Z", "590144", None), swipe("2026-03-03T05:00:00Z", "590144", "a", dept=None),
    ])
    got = [(str(r.date), r.person_id, r.department) for r in reports.entries_without_exit(df).collect()]
    assert got == [("2026-03-03", None, "D"), ("2026-03-03", "a", None)]


def test_territory_and_department_drop_nulls(spark):
    df = export_frame(spark, [
        swipe("2026-03-02T05:00:00Z", "590144", "a", dept="None", point="P"),
        swipe("2026-03-02T05:00:00Z", "599999", "a", point="only other"),
        swipe("2026-03-02T05:00:00Z", "590145", "a", point="P"),
    ])
    assert [tuple(r) for r in reports.by_territory(df).collect()] == [("P", 1, 1, 2)]
    assert reports.by_department(df).count() == 0


def test_heatmap_is_monday_first(spark):
    df = export_frame(spark, [swipe("2026-03-02T05:00:00Z", "590144", "a")])
    assert [tuple(r) for r in reports.hourly_heatmap(df).collect()] == [(0, 8, 1, "Пн")]
    wide = reports.hourly_heatmap(df, wide=True).first()
    assert wide.h8 == 1 and wide.h7 == 0


# ---- star --------------------------------------------------------------------

def people(spark, rows):
    return spark.createDataFrame(
        [(s, p, None, None, None, t, None, None, None) for s, p, t in rows], schemas.DIM_PERSONS)


def test_identities(spark):
    df = people(spark, [("a", "a2", "1"), ("a", "a1", "1"), ("b", "b1", "1"), ("b", "b2", "2"), ("a", "a3", ""),
                        ("b", "b3", ""), ("a", "a4", None), ("c", "c1", "1")])
    assert star.match_identities(df, "a", "b").count() == 2
    assert star.apply_identities(df, "a", "b").columns[0] == "tab_number"
    done = {r.person_id: r.canonical_person_id for r in star.apply_identities(df, "a", "b", dry_run=False).collect()}
    assert done == {"a1": "a1", "a2": "a2", "b1": "a1", "b2": None, "a3": None, "b3": None, "a4": None, "c1": None}
    assert star.count_common_tabs(df, "a", "b").first()[0] == 1


# ---- territory ---------------------------------------------------------------

def tree(spark, rows):
    return spark.createDataFrame(
        [("s", i, 1, n, None, p, None, None) for i, n, p in rows], schemas.DIM_TERRITORIES)


def test_paths_of_a_deep_tree(spark):
    rows = [(f"t{i}", f"n{i}", f"t{i - 1}" if i else None) for i in range(9)] + [("x", "lost", "gone")]
    full = {r.id: r.full_path for r in territory.territory_paths(tree(spark, rows), full=True).collect()}
    assert full["t8"] == " / ".join(f"n{i}" for i in range(9))
    assert full["t0"] == "n0" and full["x"] == "lost"
    one = {r.id: r.full_path for r in territory.territory_paths(tree(spark, rows)).collect()}
    assert one["t8"] == "n7 / n8" and one["t0"] == "n0"


def test_a_cycle_is_reported(spark):
    with pytest.raises(ValueError):
        territory.territory_paths(tree(spark, [("a", "a", "b"), ("b", "b", "a")]), full=True)


def test_cards(spark):
    cards = spark.createDataFrame(
        [("p", 2, "B", "true", None), ("p", 1, "A", "true", None), ("p", 3, "", "false", None), ("q", 1, None, "false", None)],
        schemas.CARDS)
    df = spark.createDataFrame([("p",), ("q",), ("r",)], "person_id string")
    got = sorted((r.person_id, r.primary_card, r.all_cards) for r in territory.attach_cards(df, cards).collect())
    assert got == [("p", "A", "A, B"), ("p", "B", "A, B"), ("q", None, ""), ("r", None, None)]


# ---- look-ups ----------------------------------------------------------------

def test_latest_event_decides_presence(spark):
    rows = [("p", "g2", T0, 590144), ("p", "g1", T0, 590145), ("q", "g3", T0, 590144), ("r", "g4", T0, 599999),
            (None, "g5", T0, 590144), ("s", "g6", T0 - dt.timedelta(hours=13), 590144)]
    df = spark.createDataFrame(rows, "person_id string, event_guid string, event_dt timestamp, transaction_type_id int")
    assert [r.person_id for r in lookups.on_site_now(df).collect()] == ["q"]
    status = {r.person_id: r.status for r in lookups.last_known_status(df, as_of=T0).collect()}
    assert status == {"p": "left", "q": "on_site"}


def test_histories_and_listing(spark):
    df = spark.createDataFrame(
        [("p", f"g{i}", T0 + dt.timedelta(minutes=i), 590144, "t", "", "77", None if i else "door") for i in range(5)],
        "person_id string, event_guid string, event_dt timestamp, transaction_type_id int, territory_id string, "
        "person_fullname string, card_code string, territory_name string")
    assert [r.event_guid for r in lookups.events_for_person(df, "p", cap=2).collect()] == ["g0", "g1"]
    assert lookups.events_for_point(df, "t").first().shown_name == "карта:77"
    assert [r.event_guid for r in lookups.last_n_events(df, 2).collect()] == ["g4", "g3"]
    shown = lookups.listing(df.orderBy("event_dt")).first()
    assert tuple(shown) == ("2026-03-02 08:00:00", "door", "карта:77")


# ---- loads -------------------------------------------------------------------

def test_insert_ignore_is_idempotent(spark):
    path = scratch_path(spark, "ledger")
    star_rows(spark, [("a", "g1", T0, "old")]).write.parquet(path)
    batch = star_rows(spark, [("a", "g1", T0, "new"), ("a", "g2", T0, "x"), ("a", "g2", T0, "x"), ("b", "g1", T0, "y")])
    assert loads.insert_ignore(spark, path, batch) == 2
    assert loads.insert_ignore(spark, path, batch) == 0
    rows = spark.read.parquet(path).collect()
    assert sorted((r.source_id, r.event_guid, r.card_code) for r in rows) == [
        ("a", "g1", "old"), ("a", "g2", "x"), ("b", "g1", "y")]


def test_upsert_preserves_columns(spark):
    target = spark.createDataFrame([("a", "1", "old", "canon"), ("a", "2", "keep", None)],
                                   "source_id string, person_id string, last_name string, canonical_person_id string")
    batch = spark.createDataFrame([("a", "1", "mid", 1), ("a", "1", None, 2), ("a", "3", "new", 1)],
                                  "source_id string, person_id string, last_name string, version int")
    out = loads.upsert(target, batch, ["source_id", "person_id"], preserve=["canonical_person_id"], order=["version"])
    assert sorted(tuple(r)[1:] for r in out.collect()) == [("1", None, "canon"), ("2", "keep", None), ("3", "new", None)]


def test_incremental_skips_unknown_sources(spark):
    h = dt.timedelta(hours=1)
    target = star_rows(spark, [("a", "g1", T0, None)])
    source = star_rows(spark, [("a", "g1", T0, None), ("a", "in", T0 - 25 * h, None), ("a", "out", T0 - 26 * h, None),
                               ("b", "g9", T0, None)])
    assert [r.event_guid for r in loads.incremental_load(target, source).collect()] == ["in"]
    assert [r.event_guid for r in loads.incremental_load(target, source, sources=["a", "b"]).collect()] == ["in"]


def test_lookback_starts_at_midnight(spark):
    source = star_rows(spark, [("a", "g1", dt.datetime(2026, 2, 28, 0, 0), None),
                               ("a", "g0", dt.datetime(2026, 2, 27, 23, 59, 59), None), ("a", "g2", T0, None)])
    got = loads.lookback_load(source.filter("event_guid = 'g2'"), source)
    assert [r.event_guid for r in got.collect()] == ["g1"]


def test_loads_read_the_months_they_need(spark):
    path = scratch_path(spark, "months")
    rows = [("msk", f"g{m}", dt.datetime(2026, m, 10), 590144, "p", "t", "c") for m in range(1, 7)]
    held = spark.createDataFrame(rows, schemas.STAR_EVENTS)
    files.write_events(held, path)
    table = spark.read.parquet(path)
    batch = spark.createDataFrame([("msk", "g5", dt.datetime(2026, 5, 10), 590144, "p", "t", "c"),
                                   ("msk", "new", dt.datetime(2026, 6, 11), 590144, "p", "t", "c")], schemas.STAR_EVENTS)
    out = loads.append_if_absent(table, batch, fixed_time="event_dt")
    assert [r.event_guid for r in out.collect()] == ["new"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "Subquery" in plan
    recent = loads.incremental_load(held.filter("event_guid < 'g4'"), table.drop("month"), lookback_hours=1, sources=["msk"])
    assert sorted(r.event_guid for r in recent.collect()) == ["g4", "g5", "g6"]


def test_xml_is_parsed_once(spark):
    """Conditions on decoded columns stay above the parse, also those of later steps."""
    from swipeflow.plans import fixtures as fx
    from swipeflow.plans.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    pilot = payloads.decode_pilot_events(payloads.parse_event_payload(fx.event_payloads(spark, sf)))
    for df, scans in ((ev.keep_valid_events(pilot, fx.zones(spark)), 1), (QUERIES["decode_star_xml"](spark, sf), 1),
                      (QUERIES["decode_persons"](spark, sf), 2)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("from_xml(") == scans


def test_scratch_is_cleared(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_csv_keeps_line_ends_quotes_and_backslashes(spark):
    texts = ["a\nb", "\r\n", 'say "x", y', "back\\slash \\n", "\\\\n\n\\", "", None, "\\r\r"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    path = scratch_path(spark, "lines")
    files.write_csv(df, path)
    got = {r.i: r.t for r in files.read_events_csv(spark, path, df.schema).collect()}
    assert [got[i] or None for i in range(len(texts))] == [t or None for t in texts]


def test_append_export_without_duplicates(spark):
    path = scratch_path(spark, "csv")
    first = star_rows(spark, [("a", "g1", T0, "x, \"y\"")])
    loads.append_export(first, path)
    again = star_rows(spark, [("a", "g1", T0, "z"), ("a", "g2", T0, None)])
    loads.append_export(again, path, existing=files.read_events_csv(spark, path, first.schema))
    rows = files.read_events_csv(spark, path, first.schema).orderBy("event_guid").collect()
    assert [(r.event_guid, r.event_dt, r.card_code) for r in rows] == [("g1", T0, 'x, "y"'), ("g2", T0, None)]
    loads.append_export(again, path, dedup_key=None)
    assert files.read_events_csv(spark, path, first.schema).count() == 4


def test_periods(spark):
    rows = loads.month_periods(spark, dt.datetime(2025, 11, 15), dt.datetime(2026, 2, 1)).collect()
    assert [(r.period_start.month, r.period_end.month, r.period_end.day) for r in rows] == [(11, 12, 1), (12, 1, 1), (1, 2, 1)]
    clipped = loads.month_periods(spark, dt.datetime(2026, 1, 5), dt.datetime(2026, 1, 9)).collect()
    assert [(r.period_start, r.period_end) for r in clipped] == [(dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 9))]
    assert loads.month_periods(spark, dt.datetime(2026, 2, 1), dt.datetime(2026, 2, 1)).count() == 0
    assert loads.day_series(spark, dt.date(2026, 2, 27), dt.date(2026, 3, 1)).count() == 3


def test_backfill_plan(spark):
    m = [dt.datetime(2026, i, 1) for i in range(1, 5)]
    ledger = spark.createDataFrame(
        [("a", m[0], m[1], "done", 1, None, None, None), ("a", m[1], m[2], "error", 0, None, None, "x")], schemas.LEDGER)
    periods = loads.month_periods(spark, m[0], m[3]).withColumn("source_id", F.lit("a"))
    got = [(r.period_start.month, r.status) for r in loads.plan_backfill(ledger, periods).collect()]
    assert got == [(2, "error"), (3, "pending")]


# ---- JSON --------------------------------------------------------------------

def records(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "pos bigint, t string").select(
        "pos", F.parse_json("t").alias("record"))


def test_profile(spark):
    texts = ['{"a": null, "b": [1], "z": null}', '{"a": 1, "b": [1]}', '{"a": 1, "c": "' + "x" * 200 + '"}',
             '{"a": 2}', '{"a": 3}', '{"a": 4}']
    rows = {r.field: r for r in profile.json_field_profile(records(spark, texts)).collect()}
    assert (rows["a"].type, rows["a"].fill_pct) == ("int", "83%")
    assert (rows["a"].example_1, rows["a"].example_2, rows["a"].example_3) == ("1", "2", "3")
    assert (rows["b"].type, rows["b"].example_1, rows["b"].example_2) == ("list[int]", "[1]", "—")
    assert rows["c"].example_1 == '"' + "x" * 119 + "…"
    assert (rows["z"].type, rows["z"].fill_pct, rows["z"].example_1) == ("null", "0%", "—")
    order = [r.field for r in profile.json_field_profile(records(spark, texts)).collect()]
    assert order == ["a", "c", "z", "b"]


def test_profile_builds_a_value_text_once(spark):
    """A record's value becomes text once a row, and lists are entered by constant paths."""
    deep = 15
    texts = ['{"a": ' + "[" * deep + "1.5" + "]" * deep + ', "b": [12345678901234567890], "c": null, "d": "null"}']
    df = profile.json_field_profile(records(spark, texts))
    rows = {r.field: (r.type, r.fill_pct) for r in df.collect()}
    assert rows == {"a": ("list[" * deep + "float" + "]" * deep, "100%"), "b": ("list[int]", "100%"), "c": ("null", "0%"), "d": ("str", "100%")}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    built = re.findall(r"StructsToJsonEvaluator\(.{1,80}?\.evaluate\((value#\d+)\)", plan)
    assert built and len(built) == len(set(built))


def test_schema_text(spark):
    df = records(spark, ['{"a": {"x": 1, "y": ["s"]}, "b": true}', '{"a": {"x": 1.5}, "b": null}'])
    got = {r.field: r.schema for r in profile.json_schema(df).collect()}
    assert got == {"a": "dict<x: float, y: list<str>>", "b": "bool"}
    assert [r.field for r in profile.json_schema(df, nested_only=True).collect()] == ["a"]
    path = scratch_path(spark, "schema")
    files.write_schema_text(profile.json_schema(df), path)
    assert [r.value for r in spark.read.text(path).collect()] == ["a: dict<x: float, y: list<str>>", "b: bool"]


def test_json_pages(spark):
    path = scratch_path(spark, "pages")
    spark.createDataFrame([('{"data":[{"a":1},{"a":2}]}',), ('{"data":[]}',), ("not json",)], "value string").write.text(path)
    assert files.read_json_pages(spark, path).count() == 2
    assert files.read_json_pages(spark, path, limit=1).count() == 1


# ---- quality -----------------------------------------------------------------

def test_dashboard_agrees_with_the_single_rules(spark):
    from swipeflow.plans import fixtures as fx

    sf = "/root/testdata/sf0.001"
    vac, sub, cand, app = (f(spark, sf) for f in (fx.vacancies, fx.subs, fx.candidates, fx.applications))
    today = dt.date(1998, 6, 1)
    table = {r.rule: r.value for r in quality.dashboard(vac, sub, cand, app, today).collect()}
    single = {
        "no_recruiter": quality.no_recruiter(vac), "idle_subs": quality.idle_subs(sub, today),
        "orphan_subs": quality.orphan_subs(sub, vac), "unpublished_parents": quality.unpublished_parents(sub, vac),
        "form_share": quality.form_share(cand), "no_consent": quality.no_consent(cand),
        "accepted_not_closed": quality.accepted_not_closed(app, vac),
        "unassigned_inactive": quality.unassigned_inactive(app, vac),
        "stuck_candidates": quality.stuck_candidates(app, sub, today),
    }
    assert table == {name: df.first().value for name, df in single.items()}
    one = quality.dashboard(vac, sub, cand, app, today, recruiter="rec-5").filter("rule = 'no_recruiter'").first()
    assert (one.value, one.severity) == (0.0, "ok")


def test_quality_thresholds_are_exact(spark):
    subs = spark.createDataFrame([("s1", 1, dt.datetime(2026, 3, 1), True), ("s2", 1, dt.datetime(2026, 2, 28), True)],
                                 "sub_id string, parent_id int, last_activity timestamp, published boolean")
    assert quality.idle_subs(subs, dt.date(2026, 3, 15)).first().value == 1.0
    apps = spark.createDataFrame([(1, 1, "in_progress", dt.datetime(2026, 3, 8)), (2, 1, "in_progress", dt.datetime(2026, 3, 7))],
                                 "candidate_id int, vacancy_id int, stage string, moved_at timestamp")
    assert quality.stuck_candidates(apps, subs, dt.date(2026, 3, 15)).first().value == 1.0


# ---- streaming ---------------------------------------------------------------

def test_stream_drops_copies(spark):
    base = scratch_path(spark, "in")
    rows = star_rows(spark, [("a", f"g{i}", T0, None) for i in range(50)])
    rows.unionByName(rows).write.parquet(base)
    stream = spark.readStream.schema(rows.schema).parquet(base)
    out = scratch_path(spark, "out")
    loader.stream_load(stream).writeStream.option("checkpointLocation", out + "/cp").trigger(availableNow=True).format(
        "parquet").start(out + "/t").awaitTermination()
    assert spark.read.parquet(out + "/t").count() == 50


def test_insert_ignore_stream_restarts(spark):
    base, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    rows = star_rows(spark, [("a", f"g{i}", T0, None) for i in range(50)])
    rows.write.parquet(base)
    for run in range(2):
        stream = spark.readStream.schema(rows.schema).parquet(base)
        loader.start_insert_ignore(stream, f"{out}/t", f"{out}/cp{run}").awaitTermination()
    assert spark.read.parquet(f"{out}/t").count() == 50
