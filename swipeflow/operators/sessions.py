"""Repeat-swipe removal, entry/exit pairing and day slicing.

Scale notes. A person and zone may hold a large share of all events, so no
step gathers a person's raw events in one task:

* With a duplicate limit, events are first aggregated to (person, zone,
  direction, cell), a cell being one duplicate limit long. Only a cell's first
  swipe can survive, so first and last time per cell say all that is needed.
  The aggregation runs map-side before the shuffle and bounds a person's rows
  by the length of the history, not by the number of swipes.
* Without a duplicate limit every entry is a session of its own, so a person's
  history is cut into time segments. Each segment is scanned alone; one summary
  row per segment carries the nearest swipes across segment borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeflow.functions import times
from swipeflow.operators.events import identified_only
from swipeflow.rules import (
    HIGH, LABEL_HIDDEN_EXIT, LABEL_OPEN_END, LABEL_OPEN_START, LOW, US_PER_DAY,
    US_PER_MINUTE, US_PER_SECOND, Rules,
)

KEY = ["site_id", "person_id", "zone_type"]
# Windows sort by a hash of the key first: most comparisons end at one long instead of three texts.
SORT_KEY = ["key_hash", *KEY]
SEGMENT_US = 5 * US_PER_MINUTE


def _entry() -> Column:
    return F.col("direction") == "entry"


def _exit() -> Column:
    return F.col("direction") == "exit"


def _swipes(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Identified entries and exits with their time in microseconds."""
    return events.filter(
        F.col("person_id").isNotNull() & F.col("zone_type").isNotNull()
        & F.col("direction").isin("entry", "exit") & F.col("event_dt").isNotNull()
    ).select(*KEY, "direction", F.unix_micros("event_dt").alias("us"), *(keep or []))


def _pos(us: Column) -> Column:
    """Order of swipes in time; an exit goes before an entry of the same instant."""
    return us * 2 + F.when(_exit(), 0).otherwise(1)


def _cell(rules: Rules) -> Column:
    return F.col("us") - F.pmod(F.col("us"), F.lit(rules.dup_us))


def _near(way: str, direction: str, value: str = "us", keys: list[str] = SORT_KEY) -> Column:
    """``value`` of the nearest swipe of one direction before (lag) or after (lead) each row."""
    return F.expr(
        f"{way}(CASE WHEN direction = '{direction}' THEN {value} END) IGNORE NULLS "
        f"OVER (PARTITION BY {', '.join(keys)} ORDER BY pos)"
    )


def _first_of_cell(cells: DataFrame, rules: Rules) -> DataFrame:
    """Of per-cell first/last swipes, the firsts that do not repeat an earlier swipe."""
    # One exchange on the person serves the windows, the mart and the person join.
    marked = (
        cells.repartition("site_id", "person_id")
        .withColumns({"key_hash": F.xxhash64(*KEY), "pos": _pos(F.col("us"))})
        .withColumns({
            "last_in": _near("lag", "entry", "last_us"),
            "last_out": _near("lag", "exit", "last_us"),
        })
    )
    previous = F.when(_entry(), F.col("last_in")).otherwise(F.col("last_out"))
    fresh = previous.isNull() | (F.col("us") - previous >= F.lit(rules.dup_us))
    return marked.filter(fresh).drop("last_in", "last_out", "last_us")


def drop_repeat_swipes(events: DataFrame, rules: Rules) -> DataFrame:
    """Events without those that follow a raw event of the same person, zone and direction too soon.

    The gap is measured to the previous raw event, so a chain of close swipes
    leaves only its first; a gap of exactly the limit stays.
    """
    if not rules.dup_minutes:
        return identified_only(events)
    payload = [c for c in events.columns if c not in (*KEY, "direction")]
    rest = [c for c in payload if c != "event_guid"]
    row = F.struct("us", "event_guid", *rest)
    cells = (
        _swipes(events, payload)
        .groupBy(*KEY, "direction", _cell(rules).alias("cell"))
        .agg(F.min(row).alias("row"), F.max("us").alias("last_us"))
        .withColumn("us", F.col("row.us"))
    )
    return _first_of_cell(cells, rules).select(
        *[F.col(c) if c in KEY or c == "direction" else F.col(f"row.{c}").alias(c) for c in events.columns]
    )


def _distinct_swipes(events: DataFrame, rules: Rules) -> DataFrame:
    """Deduplicated swipe times only: all columns are longs or keys, so hash aggregation applies."""
    cells = (
        _swipes(events)
        .groupBy(*KEY, "direction", _cell(rules).alias("cell"))
        .agg(F.min("us").alias("us"), F.max("us").alias("last_us"))
        .drop("cell")
    )
    return _first_of_cell(cells, rules)


def _neighbours_of_distinct(swipes: DataFrame) -> DataFrame:
    """Nearest swipes around each deduplicated swipe: one partition per person and zone, one sort."""
    return swipes.withColumns({
        "next_exit": _near("lead", "exit"),
        "next_entry": _near("lead", "entry"),
        "prev_entry": _near("lag", "entry"),
        "prev_exit": _near("lag", "exit"),
    })


def _neighbours(swipes: DataFrame) -> DataFrame:
    """Nearest swipes strictly before and after each swipe, history cut into segments."""
    part = [*SORT_KEY, "segment"]
    keyed = swipes.withColumns({
        "key_hash": F.xxhash64(*KEY),
        "pos": _pos(F.col("us")),
        "segment": F.col("us") - F.pmod(F.col("us"), F.lit(SEGMENT_US)),
    })
    rows = keyed.repartition(*part)
    earlier = Window.partitionBy(*part).orderBy("pos").rangeBetween(Window.unboundedPreceding, -1)
    near = rows.withColumns({
        "next_exit": _near("lead", "exit", keys=part),
        "prev_entry": F.max(F.when(_entry(), F.col("us"))).over(earlier),
        "prev_exit": F.max(F.when(_exit(), F.col("us"))).over(earlier),
    })
    # from the swipes before their exchange: segments are summed up map-side, and raw swipes move once
    summary = keyed.groupBy(*part).agg(
        F.min(F.when(_exit(), F.col("us"))).alias("first_exit"),
        F.max(F.when(_entry(), F.col("us"))).alias("last_entry"),
        F.max(F.when(_exit(), F.col("us"))).alias("last_exit"),
    )
    over = f"OVER (PARTITION BY {', '.join(SORT_KEY)} ORDER BY segment)"
    carry = summary.select(
        *part,
        F.expr(f"lead(first_exit) IGNORE NULLS {over}").alias("carry_next_exit"),
        F.expr(f"lag(last_entry) IGNORE NULLS {over}").alias("carry_prev_entry"),
        F.expr(f"lag(last_exit) IGNORE NULLS {over}").alias("carry_prev_exit"),
    )
    return near.join(carry, part, "left").select(
        *KEY, "direction", "us",
        F.coalesce("next_exit", "carry_next_exit").alias("next_exit"),
        F.lit(None).cast("long").alias("next_entry"),
        F.coalesce("prev_entry", "carry_prev_entry").alias("prev_entry"),
        F.coalesce("prev_exit", "carry_prev_exit").alias("prev_exit"),
    )


def _with_neighbours(events: DataFrame, rules: Rules) -> DataFrame:
    if rules.dup_minutes:
        return _neighbours_of_distinct(_distinct_swipes(events, rules))
    if rules.hidden_exit:
        raise ValueError("hidden exits need a duplicate limit")
    return _neighbours(_swipes(events))


def _is_orphan(rules: Rules) -> Column:
    """An exit that no entry explains."""
    none_before = F.col("prev_entry").isNull()
    if rules.orphan == "window":
        return _exit() & (none_before | (F.col("prev_entry") < F.col("us") - rules.max_us))
    day_start = times.day_floor_us(F.col("us"), rules.tz_hours, rules.day_start_hour)
    none_that_day = none_before | (F.col("prev_entry") < day_start)
    if rules.orphan == "day":
        return _exit() & none_that_day
    ends_a_session = F.col("prev_entry").isNotNull() & (
        F.col("prev_exit").isNull() | (F.col("prev_entry") >= F.col("prev_exit"))
    )
    return _exit() & none_that_day & ~ends_a_session


def _sessions(swipes: DataFrame, rules: Rules) -> DataFrame:
    """Session rows of entries and orphan exits, both from the one swipe row."""
    us = F.col("us")
    day_start = times.day_floor_us(us, rules.tz_hours, rules.day_start_hour)
    next_exit, next_entry = F.col("next_exit"), F.col("next_entry")
    if rules.pairing == "bounded":
        next_exit = F.when(next_exit <= us + rules.max_us, next_exit)
        next_entry = F.when(next_entry <= us + rules.max_us, next_entry)
    elif rules.pairing == "same_day":
        next_exit = F.when(next_exit < day_start + US_PER_DAY, next_exit)
    if not rules.hidden_exit:
        next_entry = F.lit(None).cast("long")
    fallback = us + rules.max_us if rules.close == "timeout" else day_start + (US_PER_DAY - US_PER_SECOND)

    real = _entry() & next_exit.isNotNull() & (next_entry.isNull() | (next_exit <= next_entry))
    hidden = _entry() & ~real & next_entry.isNotNull()
    return (
        swipes.filter(_entry() | _is_orphan(rules))
        .select(
            *KEY,
            times.day_of_us(us, rules.tz_hours, rules.day_start_hour).alias("session_date"),
            F.when(_exit(), day_start).otherwise(us).alias("entry_us"),
            F.when(_exit(), us).when(real, next_exit).when(hidden, next_entry - US_PER_SECOND)
            .otherwise(fallback).alias("exit_us"),
            F.when(_exit(), F.lit(LABEL_OPEN_START)).when(real, F.lit(None)).when(hidden, F.lit(LABEL_HIDDEN_EXIT))
            .otherwise(F.lit(LABEL_OPEN_END)).alias("comment"),
            F.when(real, F.lit(HIGH)).otherwise(F.lit(LOW)).alias("confidence"),
        )
    )


def positive_sessions(df: DataFrame, start: str = "entry_us", end: str = "exit_us") -> DataFrame:
    return df.filter(F.col(end) > F.col(start))


def pair_sessions(events: DataFrame, rules: Rules) -> DataFrame:
    """Sessions that start with an entry (times in microseconds)."""
    return _sessions(_with_neighbours(events, rules).filter(_entry()), rules)


def orphan_exits(events: DataFrame, rules: Rules) -> DataFrame:
    """Sessions of exits without an entry, opened at the start of the exit's day."""
    return _sessions(_with_neighbours(events, rules).filter(_exit()), rules)


def session_spans(events: DataFrame, rules: Rules) -> DataFrame:
    """All sessions of positive length, times in microseconds (entry_us, exit_us)."""
    return positive_sessions(_sessions(_with_neighbours(events, rules), rules))


def half_up(amount: Column, unit: int, digits: int) -> Column:
    """``amount / unit`` (whole numbers, not negative) rounded half up to whole 10**-digits steps.

    Stays in long arithmetic, so the half-way cases are exact.
    """
    step = unit // 10 ** digits
    return F.call_function("div", amount + F.lit(step // 2), F.lit(step))


def tenth_minutes(us: Column) -> Column:
    return half_up(us, US_PER_MINUTE, 1)


def minutes_of_us(us: Column) -> Column:
    return tenth_minutes(us) / F.lit(10.0)


def as_timestamps(spans: DataFrame) -> DataFrame:
    """Spans with timestamps and the rounded duration in place of microseconds."""
    return spans.select(
        *KEY, "session_date",
        F.timestamp_micros("entry_us").alias("entry_ts"),
        F.timestamp_micros("exit_us").alias("exit_ts"),
        minutes_of_us(F.col("exit_us") - F.col("entry_us")).alias("duration_minutes"),
        "comment", "confidence",
    )


def build_sessions(events: DataFrame, rules: Rules) -> DataFrame:
    """Presence sessions: site, person, zone, date, entry, exit, minutes, comment, confidence."""
    return as_timestamps(session_spans(events, rules))


def slice_by_day(spans: DataFrame, rules: Rules) -> DataFrame:
    """Each session's part in every day of the report period it touches.

    Days are generated per session and clipped to the period first, which
    replaces an overlap join between sessions and days.
    """
    first = times.day_of_us(F.col("entry_us"), rules.tz_hours, rules.day_start_hour)
    last = times.day_of_us(F.col("exit_us") - 1, rules.tz_hours, rules.day_start_hour)
    if rules.period:
        first = F.greatest(first, F.lit(rules.period[0]))
        last = F.least(last, F.lit(rules.period[1]))
    days = (
        spans.withColumns({"_first": first, "_last": last})
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn("report_date", F.explode(F.sequence("_first", "_last")))
    )
    start = times.day_start_us(F.col("report_date"), rules.tz_hours, rules.day_start_hour)
    return positive_sessions(
        days.select(
            *KEY, "report_date",
            F.greatest("entry_us", start).alias("slice_entry_us"),
            F.least("exit_us", start + US_PER_DAY).alias("slice_exit_us"),
            "comment", "confidence",
        ),
        "slice_entry_us", "slice_exit_us",
    )
