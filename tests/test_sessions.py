"""Hand-made swipe histories of one person in one zone, local time."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from swipeflow import schemas
from swipeflow.operators import mart, sessions
from swipeflow.rules import LABEL_HIDDEN_EXIT, LABEL_OPEN_END, LABEL_OPEN_START, Rules

D1 = dt.date(2026, 3, 2)
UTC = dt.timezone.utc


def local(day: int, clock: str) -> dt.datetime:
    """Local time (UTC+3) of a day offset as an aware instant."""
    h, m, *s = (int(x) for x in clock.split(":"))
    at = dt.datetime(2026, 3, 2, tzinfo=UTC) + dt.timedelta(days=day, hours=h - 3, minutes=m, seconds=s[0] if s else 0)
    return at


def events(spark, swipes, person="p", zone="territory"):
    rows = [
        ("site_a", f"g{i}", at, at, 590144 if way == "in" else 590145, "entry" if way == "in" else "exit",
         person, None, "x", zone, "door", None)
        for i, (way, at) in enumerate(swipes)
    ]
    return spark.createDataFrame(rows, schemas.ACCESS_EVENTS)


def clock(us: int) -> str:
    at = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us) + dt.timedelta(hours=3)
    return f"{(at.date() - D1).days} {at:%H:%M:%S}"


def spans(spark, swipes, rules=Rules()):
    rows = sessions.session_spans(events(spark, swipes), rules).orderBy("entry_us", "exit_us").collect()
    return [(clock(r.entry_us), clock(r.exit_us), r.comment, r.confidence) for r in rows]


def slices(spark, swipes, rules=Rules()):
    rows = sessions.slice_by_day(sessions.session_spans(events(spark, swipes), rules), rules)
    return [((r.report_date - D1).days, clock(r.slice_entry_us), clock(r.slice_exit_us))
            for r in rows.orderBy("report_date", "slice_entry_us").collect()]


def w(*items):
    return [(way, local(day, at)) for way, day, at in items]


CURRENT = [
    ("pair", w(("in", 0, "08:00"), ("out", 0, "17:00")), [("0 08:00:00", "0 17:00:00", None, "HIGH")]),
    ("chain", w(("in", 0, "08:00"), ("in", 0, "08:04"), ("in", 0, "08:08"), ("out", 0, "12:00")),
     [("0 08:00:00", "0 12:00:00", None, "HIGH")]),
    ("exact limit", w(("in", 0, "08:00"), ("in", 0, "08:05")),
     [("0 08:00:00", "0 08:04:59", LABEL_HIDDEN_EXIT, "LOW"), ("0 08:05:00", "1 00:05:00", LABEL_OPEN_END, "LOW")]),
    ("no exit", w(("in", 0, "08:00")), [("0 08:00:00", "1 00:00:00", LABEL_OPEN_END, "LOW")]),
    ("orphan", w(("out", 0, "07:00")), [("0 00:00:00", "0 07:00:00", LABEL_OPEN_START, "LOW")]),
    ("two orphans", w(("out", 0, "07:00"), ("out", 0, "13:00")),
     [("0 00:00:00", "0 07:00:00", LABEL_OPEN_START, "LOW"), ("0 00:00:00", "0 13:00:00", LABEL_OPEN_START, "LOW")]),
    ("second exit vanishes", w(("in", 0, "08:00"), ("out", 0, "12:00"), ("out", 0, "18:00")),
     [("0 08:00:00", "0 12:00:00", None, "HIGH")]),
    ("hidden exit", w(("in", 0, "08:00"), ("in", 0, "12:00"), ("out", 0, "18:00")),
     [("0 08:00:00", "0 11:59:59", LABEL_HIDDEN_EXIT, "LOW"), ("0 12:00:00", "0 18:00:00", None, "HIGH")]),
    ("exactly at the limit", w(("in", 0, "08:00"), ("out", 1, "00:00")), [("0 08:00:00", "1 00:00:00", None, "HIGH")]),
    ("just past the limit", w(("in", 0, "08:00"), ("out", 1, "00:00:01")),
     [("0 08:00:00", "1 00:00:00", LABEL_OPEN_END, "LOW"), ("1 00:00:00", "1 00:00:01", LABEL_OPEN_START, "LOW")]),
    ("tie", w(("in", 0, "08:00"), ("out", 0, "12:00"), ("in", 0, "12:00")),
     [("0 08:00:00", "0 12:00:00", None, "HIGH"), ("0 12:00:00", "1 04:00:00", LABEL_OPEN_END, "LOW")]),
    ("zero length", w(("out", 0, "00:00")), []),
]


@pytest.mark.parametrize("swipes,expected", [c[1:] for c in CURRENT], ids=[c[0] for c in CURRENT])
def test_current_rules(spark, swipes, expected):
    assert spans(spark, swipes) == expected


def test_night_shift_is_sliced(spark):
    assert slices(spark, w(("in", 0, "22:00"), ("out", 1, "06:00"))) == [
        (0, "0 22:00:00", "1 00:00:00"), (1, "1 00:00:00", "1 06:00:00")]


def test_timeout_at_midnight_gives_one_slice(spark):
    assert slices(spark, w(("in", 0, "08:00"))) == [(0, "0 08:00:00", "1 00:00:00")]


def test_timeout_after_midnight_gives_two_slices(spark):
    assert slices(spark, w(("in", 0, "20:00"))) == [(0, "0 20:00:00", "1 00:00:00"), (1, "1 00:00:00", "1 12:00:00")]


def test_slices_are_clipped_to_the_period(spark):
    rules = Rules(period=(D1, D1))
    assert slices(spark, w(("in", -1, "22:00"), ("out", 0, "06:00"), ("in", 0, "23:00"), ("out", 1, "02:00")), rules) == [
        (0, "0 00:00:00", "0 06:00:00"), (0, "0 23:00:00", "1 00:00:00")]
    assert slices(spark, w(("in", 5, "08:00"), ("out", 5, "09:00")), rules) == []


def test_unidentified_events_are_dropped(spark):
    swipes = w(("in", 0, "08:00"), ("out", 0, "09:00"))
    assert sessions.session_spans(events(spark, swipes, person=None), Rules()).count() == 0
    assert sessions.session_spans(events(spark, swipes, zone=None), Rules()).count() == 0


def test_unbounded_rules(spark):
    rules = Rules.unbounded()
    assert spans(spark, w(("in", 0, "08:00"), ("in", 0, "09:00"), ("out", 0, "10:00")), rules) == [
        ("0 08:00:00", "0 10:00:00", None, "HIGH"), ("0 09:00:00", "0 10:00:00", None, "HIGH")]
    assert spans(spark, w(("in", 0, "05:00")), rules) == [("0 05:00:00", "0 05:59:59", LABEL_OPEN_END, "LOW")]
    # The exit closes yesterday's entry, so it is no orphan although today has no entry.
    assert spans(spark, w(("in", -1, "20:00"), ("out", 0, "08:00")), rules) == [
        ("-1 20:00:00", "0 08:00:00", None, "HIGH")]
    assert spans(spark, w(("out", 0, "08:00"), ("out", 0, "08:00")), rules) == [
        ("0 06:00:00", "0 08:00:00", LABEL_OPEN_START, "LOW")] * 2
    # Many days between entry and exit: found across history segments.
    assert spans(spark, w(("in", 0, "08:00"), ("out", 9, "08:00"), ("out", 9, "08:30")), rules) == [
        ("0 08:00:00", "9 08:00:00", None, "HIGH"), ("9 06:00:00", "9 08:30:00", LABEL_OPEN_START, "LOW")]


def test_same_day_rules(spark):
    rules = Rules.same_day()
    assert spans(spark, w(("in", 0, "22:00"), ("out", 1, "06:00")), rules) == [
        ("0 22:00:00", "0 23:59:59", LABEL_OPEN_END, "LOW"), ("1 00:00:00", "1 06:00:00", LABEL_OPEN_START, "LOW")]


def test_dedup_keeps_event_columns(spark):
    df = events(spark, w(("in", 0, "08:00"), ("in", 0, "08:04"), ("in", 0, "08:08"), ("in", 0, "08:13"),
                         ("out", 0, "08:13"), ("out", 0, "08:14")))
    kept = sessions.drop_repeat_swipes(df, Rules())
    assert kept.columns == df.columns
    assert sorted(r.event_guid for r in kept.collect()) == ["g0", "g3", "g4"]


def test_mart_row(spark):
    persons = spark.createDataFrame(
        [("site_a", "p", "Ivanova", None, None, "7", "dept", None)], schemas.PERSONS)
    rows = mart.presence_mart(
        events(spark, w(("out", 0, "07:00"), ("out", 0, "13:00"))), persons, Rules()).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.total_minutes, row.total_hours, row.sessions_count) == (1200.0, 20.0, 2)
    assert row.full_name == "Ivanova  "
    assert (row.has_open_end, row.has_open_start) == (False, True)
    assert (row.comment, row.confidence) == (LABEL_OPEN_START, "LOW")
    clean = mart.presence_mart(
        events(spark, w(("in", 0, "08:00"), ("out", 0, "17:00"))), persons, Rules()).collect()[0]
    assert (clean.has_open_end, clean.has_open_start, clean.comment, clean.confidence) == (None, None, None, "HIGH")


def brute_force(rows, rules):
    """The current rules on a plain list of (direction, microseconds)."""
    kept, last = [], {}
    for way, us in sorted(rows, key=lambda r: (r[1], r[0] != "exit")):
        if way not in last or us - last[way] >= rules.dup_us:
            kept.append((way, us))
        last[way] = us
    out = []
    for way, us in kept:
        if way == "entry":
            outs = [t for d, t in kept if d == "exit" and us < t <= us + rules.max_us]
            ins = [t for d, t in kept if d == "entry" and us < t <= us + rules.max_us]
            if outs and (not ins or min(outs) <= min(ins)):
                end = min(outs)
            elif ins:
                end = min(ins) - 1_000_000
            else:
                end = us + rules.max_us
            out.append((us, end))
        elif not any(d == "entry" and us - rules.max_us <= t < us for d, t in kept):
            start = us - (us + rules.tz_us) % 86_400_000_000
            if us > start:
                out.append((start, us))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_random_histories_match_brute_force(spark, seed):
    import random

    rnd = random.Random(seed)
    base = 1_767_225_600_000_000
    step = 30_000_000
    rows = [(rnd.choice(["entry", "exit"]), base + rnd.randrange(0, 6 * 2880) * step) for _ in range(400)]
    frame = [("site_a", f"g{i}", way, "p", "territory", us) for i, (way, us) in enumerate(rows)]
    df = spark.createDataFrame(
        frame, "site_id string, event_guid string, direction string, person_id string, zone_type string, us long"
    ).withColumn("event_dt", F.timestamp_micros("us")).drop("us")
    rules = Rules()
    got = sorted((r.entry_us, r.exit_us) for r in sessions.session_spans(df, rules).collect())
    assert got == brute_force(rows, rules)
    # Property: sessions that start with an entry never overlap.
    pairs = sorted((r.entry_us, r.exit_us) for r in sessions.pair_sessions(df, rules).collect())
    assert all(a[1] <= b[0] for a, b in zip(pairs, pairs[1:]))
    # Property: the slices of a session add up to its length.
    total = sessions.session_spans(df, rules).agg(F.sum(F.col("exit_us") - F.col("entry_us"))).first()[0]
    cut = sessions.slice_by_day(sessions.session_spans(df, rules), rules)
    assert cut.agg(F.sum(F.col("slice_exit_us") - F.col("slice_entry_us"))).first()[0] == total


def test_hot_person_is_bounded(spark):
    """Half a million swipes of one person reach the pairing as at most two rows per five minutes."""
    n = 500_000
    df = spark.range(n).selectExpr(
        "'site_a' AS site_id", "'p' AS person_id", "'territory' AS zone_type",
        "CASE WHEN id % 2 = 0 THEN 'entry' ELSE 'exit' END AS direction",
        "timestamp_micros(1767225600000000 + id * 100000) AS event_dt")
    cells = sessions._distinct_swipes(df, Rules())
    minutes = n * 0.1 / 60
    assert cells.count() <= 2 * (minutes / 5 + 2)
    assert "partial_min" in cells._jdf.queryExecution().toString()
