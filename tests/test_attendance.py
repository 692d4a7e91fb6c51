"""Absence runs and schedule deviation on made rows, against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from swipeflow.operators import attendance

D = dt.date
KEYS = "site_id string, person_id string"


def _brute_runs(present: set[tuple[str, dt.date]], roster: set[str], start, end, days):
    out = []
    for person in sorted(roster | {p for p, _ in present}):
        run = []
        day = start
        while day <= end:
            if (person, day) not in present:
                run.append(day)
            if (person, day) in present or day == end:
                if len(run) >= days:
                    out.append((person, run[0], run[-1], len(run)))
                run = []
            day += dt.timedelta(days=1)
    return sorted(out)


@pytest.mark.parametrize("segment_days", [1, 5, 31, 400])
@pytest.mark.parametrize("days", [1, 3])
def test_absence_runs_against_brute_force(spark, segment_days, days):
    rng = random.Random(segment_days * 10 + days)
    start, end = D(2023, 12, 20), D(2024, 3, 10)
    span = (end - start).days + 1
    present = {(f"p{p}", start + dt.timedelta(days=rng.randrange(-5, span + 5))) for p in range(12) for _ in range(rng.randrange(0, 40))}
    roster = {f"p{p}" for p in range(15)}
    rows = [("s", p, d) for p, d in present] + [("s", None, start), ("s", "p0", start)]
    df = spark.createDataFrame(rows, "site_id string, person_id string, report_date date")
    roster_df = spark.createDataFrame([("s", p) for p in roster] + [("s", None)], KEYS)
    got = attendance.absence_runs(df, roster_df, start, end, days, segment_days).collect()
    present_in = {(p, d) for p, d in present if start <= d <= end} | {("p0", start)}
    want = _brute_runs(present_in, roster, start, end, days)
    assert sorted((r["person_id"], r["first_absent"], r["last_absent"], r["absent_days"]) for r in got) == want


def test_absence_run_across_month_end_and_never_seen(spark):
    present = spark.createDataFrame([("s", "a", D(2024, 1, 28)), ("s", "a", D(2024, 2, 3))], "site_id string, person_id string, report_date date")
    roster = spark.createDataFrame([("s", "a"), ("s", "b")], KEYS)
    got = sorted(tuple(r) for r in attendance.absence_runs(present, roster, D(2024, 1, 25), D(2024, 2, 5), 3, 7).collect())
    assert got == [("s", "a", D(2024, 1, 25), D(2024, 1, 27), 3), ("s", "a", D(2024, 1, 29), D(2024, 2, 2), 5),
                   ("s", "b", D(2024, 1, 25), D(2024, 2, 5), 12)]
    empty = present.limit(0)
    assert attendance.absence_runs(empty, roster.limit(0), D(2024, 1, 1), D(2024, 1, 1)).count() == 0


def test_absence_runs_read_the_presence_once(spark):
    """Every branch over the presence would repeat the whole mart and its memory in one task."""
    present = spark.range(90).selectExpr("'s' AS site_id", "concat('p', id % 7) AS person_id", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS report_date")
    roster = spark.createDataFrame([("s", f"p{i}") for i in range(9)] + [(None, "p1")], KEYS)
    runs = attendance.absence_runs(present.repartition("site_id", "person_id"), roster, D(2024, 1, 1), D(2024, 3, 30), 3, 70)
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 90") == 1
    rows = [tuple(r) for r in present.collect()]
    got = sorted((r["person_id"], r["first_absent"], r["last_absent"], r["absent_days"]) for r in runs.filter("site_id = 's'").collect())
    assert got == _brute_runs({(p, d) for _, p, d in rows}, {f"p{i}" for i in range(9)}, D(2024, 1, 1), D(2024, 3, 30), 3)
    assert [tuple(r) for r in runs.filter("site_id IS NULL").collect()] == [(None, "p1", D(2024, 1, 1), D(2024, 3, 30), 90)]


HOUR = 3_600_000_000


def _us(day: dt.date, hour: float) -> int:
    return int((dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp() + hour * 3600) * 1_000_000)


def test_schedule_deviation_night_split_and_none(spark):
    patterns = spark.createDataFrame([("night", 1, 22 * 60, 6 * 60), ("split", 1, 7 * 60, 11 * 60), ("split", 2, 15 * 60, 19 * 60)],
                                     "pattern string, shift_no int, start_minute int, end_minute int")
    roster = spark.createDataFrame([("s", "n", "night"), ("s", "t", "split"), ("s", "x", None)], KEYS + ", pattern string")
    day = D(2024, 1, 30)
    shifts = attendance.planned_shifts(roster, patterns, day, day, tz_hours=0)
    presence = spark.createDataFrame([
        ("s", "n", _us(day, 22.5), _us(day, 31.0)),     # 30 min late, 1 h over after 06:00
        ("s", "t", _us(day, 6.0), _us(day, 10.0)),      # 1 h early start, leaves 1 h early
        ("s", "t", _us(day, 15.0), _us(day, 19.0)),     # exact
        ("s", "x", _us(day, 9.0), _us(day, 17.0)),      # no shift planned
        ("s", None, _us(day, 9.0), _us(day, 17.0)),
    ], KEYS + ", entry_us long, exit_us long")
    got = {(r["person_id"], r["shift_no"]): r for r in attendance.schedule_deviation(presence, shifts).collect()}
    assert set(got) == {("n", 1), ("t", 1), ("t", 2)}
    night = got[("n", 1)]
    assert (night["planned_minutes"], night["present_minutes"], night["late_minutes"], night["early_leave_minutes"],
            night["overtime_minutes"]) == (480.0, 450.0, 30.0, 0.0, 60.0)
    first = got[("t", 1)]
    assert (first["present_minutes"], first["late_minutes"], first["early_leave_minutes"], first["overtime_minutes"]) == (180.0, 0.0, 60.0, 60.0)
    second = got[("t", 2)]
    assert (second["present_minutes"], second["late_minutes"], second["early_leave_minutes"], second["overtime_minutes"]) == (240.0, 0.0, 0.0, 0.0)


def test_schedule_deviation_without_presence(spark):
    patterns = spark.createDataFrame([("day", 1, 9 * 60, 18 * 60)], "pattern string, shift_no int, start_minute int, end_minute int")
    roster = spark.createDataFrame([("s", "d", "day")], KEYS + ", pattern string")
    shifts = attendance.planned_shifts(roster, patterns, D(2024, 1, 1), D(2024, 1, 2), tz_hours=3)
    none = spark.createDataFrame([], KEYS + ", entry_us long, exit_us long")
    rows = attendance.schedule_deviation(none, shifts).collect()
    assert len(rows) == 2
    assert all(r["present_minutes"] == 0.0 and r["late_minutes"] is None and r["overtime_minutes"] == 0.0 for r in rows)
