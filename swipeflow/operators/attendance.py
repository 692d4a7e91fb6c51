"""Absence runs and deviation from planned shifts.

Absence: the days of a period on which a person has no presence, as runs of consecutive calendar days
(gaps and islands). History is cut into date segments of ``SEGMENT_DAYS``; a person's present days of a
segment are one bit mask, merged on the map side already, so the presence is read once and a person and
segment is one row from then on. Gaps inside a segment come from its mask, the runs that cross segment borders
from the last day of the person's segment before. Persons of the roster never seen in the period are absent on all of its days.

Schedule deviation: planned shifts (over midnight, several a day) against presence intervals. Both are
cut into the UTC day buckets they touch and joined on (person, bucket) with an overlap test; a pair that
shares two buckets is counted only in the bucket that holds the later of the two starts. No theta join.

Edge cases: rows without a person are left out; a person in the presence but not in the roster is
still reported; a period of one day works; an empty presence makes every roster person one run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeflow.rules import US_PER_DAY

SEGMENT_DAYS = 31
#: Days of a segment at most: the bits of a long. The runs do not depend on how history is cut.
MASK_DAYS = 62
KEY = ["site_id", "person_id"]
US_PER_MINUTE = 60_000_000


def absence_runs(present: DataFrame, roster: DataFrame, start: dt.date, end: dt.date, days: int = 3,
                 segment_days: int = SEGMENT_DAYS) -> DataFrame:
    """site_id, person_id, first_absent, last_absent, absent_days for every run of at least days absent days.

    present: rows (site_id, person_id, report_date) with presence; roster: (site_id, person_id).
    """
    first_day, total = F.lit(start), (end - start).days + 1
    width = min(segment_days, MASK_DAYS)
    day = F.date_diff("report_date", first_day)
    segments = (present.filter(F.col("person_id").isNotNull() & F.col("report_date").between(start, end))
                .select(*KEY, F.floor(day / width).cast("int").alias("segment"), (day % width).alias("bit"))
                .groupBy(*KEY, "segment").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")))
    bits = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.call_function("shiftright", F.col("mask"), i).bitwiseAND(1) == 1)
    by_segment = Window.partitionBy(*KEY).orderBy("segment")
    marked = segments.withColumn("seen", F.transform(bits, lambda i: F.col("segment") * width + i)).withColumns({
        "before": F.lag(F.element_at("seen", -1)).over(by_segment), "after": F.lead("segment").over(by_segment)})
    # the days on which no absence can lie: the last one of the segment before, the own ones, the end of the period
    marks = marked.select(*KEY, F.concat(
        F.array(F.coalesce("before", F.lit(-1))), "seen", F.when(F.col("after").isNull(), F.array(F.lit(total))).otherwise(F.array())).alias("marks"))
    people = roster.filter(F.col("person_id").isNotNull()).select(*KEY).distinct()
    everyone = marks.join(people, KEY, "full").withColumn("marks", F.coalesce("marks", F.array(F.lit(-1), F.lit(total))))
    gaps = F.transform(F.slice("marks", 2, F.size("marks") - 1), lambda to, i: F.struct(
        F.get("marks", i).alias("from"), to.alias("to")))
    gap = everyone.select(*KEY, F.explode(F.filter(gaps, lambda g: g["to"] - g["from"] - 1 >= max(days, 1))).alias("gap"))
    return gap.select(*KEY, F.date_add(first_day, F.col("gap.from") + 1).alias("first_absent"), F.date_add(first_day, F.col("gap.to") - 1).alias("last_absent"),
                      (F.col("gap.to") - F.col("gap.from") - 1).cast("long").alias("absent_days"))


def _minutes(us: Column) -> Column:
    """Microseconds as minutes, rounded half up to a tenth."""
    return ((us + US_PER_MINUTE // 20) / (US_PER_MINUTE // 10)).cast("long") / F.lit(10.0)


def _buckets(start: Column, end: Column) -> Column:
    return F.sequence(F.floor(start / US_PER_DAY), F.floor((end - 1) / US_PER_DAY))


def planned_shifts(roster: DataFrame, patterns: DataFrame, start: dt.date, end: dt.date, tz_hours: int) -> DataFrame:
    """site_id, person_id, shift_date, shift_no, start_us, end_us for every day of the period and shift of a pattern.

    roster: (site_id, person_id, pattern); patterns: (pattern, shift_no, start_minute, end_minute) in local wall
    clock minutes; an end at or before the start ends on the next day.
    """
    days = roster.join(patterns, "pattern").withColumn("shift_date", F.explode(F.sequence(F.lit(start), F.lit(end))))
    day_us = F.unix_micros(F.col("shift_date").cast("timestamp")) - F.lit(tz_hours * 3_600_000_000)
    begin = day_us + F.col("start_minute").cast("long") * US_PER_MINUTE
    finish = day_us + F.col("end_minute").cast("long") * US_PER_MINUTE + F.when(F.col("end_minute") <= F.col("start_minute"), US_PER_DAY).otherwise(0)
    return days.select(*KEY, "shift_date", "shift_no", begin.alias("start_us"), finish.alias("end_us"))


def schedule_deviation(presence: DataFrame, shifts: DataFrame) -> DataFrame:
    """Per planned shift: planned, present, late, early-leave and overtime minutes.

    presence: (site_id, person_id, entry_us, exit_us) intervals; shifts: planned_shifts(). late and early
    leave are null for a shift without presence; overtime is presence just before and after the shift by
    the intervals that overlap it.
    """
    spans = (presence.filter(F.col("person_id").isNotNull() & (F.col("exit_us") > F.col("entry_us")))
             .select(*KEY, "entry_us", "exit_us").withColumn("bucket", F.explode(_buckets(F.col("entry_us"), F.col("exit_us")))))
    planned = shifts.withColumn("bucket", F.explode(_buckets(F.col("start_us"), F.col("end_us"))))
    later = F.greatest("entry_us", "start_us")
    pairs = (planned.join(spans, [*KEY, "bucket"])
             .filter((F.col("entry_us") < F.col("end_us")) & (F.col("exit_us") > F.col("start_us")))
             .filter(F.floor(later / US_PER_DAY) == F.col("bucket")))
    overlap = F.least("exit_us", "end_us") - later
    outside = F.greatest(F.col("start_us") - F.col("entry_us"), F.lit(0)) + F.greatest(F.col("exit_us") - F.col("end_us"), F.lit(0))
    shift_key = [*KEY, "shift_date", "shift_no"]
    met = pairs.groupBy(*shift_key).agg(
        F.sum(overlap).alias("present_us"), F.min("entry_us").alias("first_in"), F.max("exit_us").alias("last_out"),
        F.sum(outside).alias("overtime_us"))
    joined = shifts.join(met, shift_key, "left")
    return joined.select(
        *shift_key, _minutes(F.col("end_us") - F.col("start_us")).alias("planned_minutes"),
        _minutes(F.coalesce("present_us", F.lit(0))).alias("present_minutes"),
        F.when(F.col("first_in").isNotNull(), _minutes(F.greatest(F.col("first_in") - F.col("start_us"), F.lit(0)))).alias("late_minutes"),
        F.when(F.col("last_out").isNotNull(), _minutes(F.greatest(F.col("end_us") - F.col("last_out"), F.lit(0))))
        .alias("early_leave_minutes"),
        _minutes(F.coalesce("overtime_us", F.lit(0))).alias("overtime_minutes"))
