"""Hiring funnel, interview drop-off and time to offer, from the moves of applications between stages.

moves: (vacancy_id, candidate_id, stage, moved_at); an application is (vacancy_id, candidate_id).
vacancies: (vacancy_id, recruiter). Moves with an unknown or null stage, vacancy or candidate are left
out; a vacancy without recruiter counts under a null recruiter.

Funnel: each application folds its moves into a mergeable state, the furthest stage and the set of
stages visited (a bit mask), by max and bit_or, so the fold is partial on the map side and needs no
order: repeated, returning and out-of-order moves count once, and skipped stages count as reached
but not visited. States are counted per (vacancy, state) before they meet the vacancies, so a vacancy
with very many applications is a handful of rows at the join.

Drop-off: product-limit (Kaplan-Meier) estimate of staying without an offer after the first interview,
per recruiter; an application without offer is censored at the last day of the data. Event and
censoring counts are summed per (recruiter, day); the risk set of a day is what remains after the
cumulative sums of the days before it, a window over one recruiter's days (bounded by the horizon).

Time to offer: days from the first move to the first offer, per recruiter and quarter; a KLL sketch per
recruiter and day is the stored, mergeable state, merged per quarter for the median and the 90th
percentile, beside the exact percentiles of the same groups.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hiring stages in funnel order.
STAGES = ("applied", "screening", "interview", "offer", "hired")
APPLICATION = ["vacancy_id", "candidate_id"]
HORIZON_DAYS = 30
SKETCH_K = 200


def _stage_no(stage: Column, stages: Sequence[str]) -> Column:
    numbers = F.create_map(*[x for i, name in enumerate(stages, 1) for x in (F.lit(name), F.lit(i))])
    return numbers[stage]


def _numbered(moves: DataFrame, stages: Sequence[str]) -> DataFrame:
    return (moves.withColumn("stage_no", _stage_no(F.col("stage"), stages))
            .filter(F.col("stage_no").isNotNull() & F.col("vacancy_id").isNotNull() & F.col("candidate_id").isNotNull()))


def funnel(moves: DataFrame, vacancies: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """recruiter, stage, stage_no, reached, visited, skipped, conversion (reached over the previous stage's)."""
    states = _numbered(moves, stages).groupBy(*APPLICATION).agg(
        F.max("stage_no").alias("furthest"), F.bit_or(F.expr("shiftleft(1, stage_no)")).alias("mask"))
    per_vacancy = states.groupBy("vacancy_id", "furthest", "mask").agg(F.count("*").alias("n"))
    owners = vacancies.select("vacancy_id", "recruiter").dropDuplicates(["vacancy_id"])
    per_recruiter = (per_vacancy.join(owners, "vacancy_id", "left").groupBy("recruiter", "furthest", "mask")
                     .agg(F.sum("n").alias("n")))
    names = F.array(*[F.lit(s) for s in stages])
    by_stage = per_recruiter.select("recruiter", "furthest", "mask", "n",
                                    F.explode(F.sequence(F.lit(1), F.lit(len(stages)))).alias("stage_no"))
    counts = by_stage.groupBy("recruiter", "stage_no").agg(
        F.sum(F.when(F.col("furthest") >= F.col("stage_no"), F.col("n")).otherwise(0)).cast("long").alias("reached"),
        F.sum(F.when(F.expr("shiftright(mask, stage_no)").bitwiseAND(1) == 1, F.col("n")).otherwise(0)).cast("long").alias("visited"))
    before = F.lag("reached").over(Window.partitionBy("recruiter").orderBy("stage_no"))
    return counts.select(
        "recruiter", F.element_at(names, F.col("stage_no")).alias("stage"), "stage_no", "reached", "visited",
        (F.col("reached") - F.col("visited")).alias("skipped"),
        F.when(F.col("stage_no") == 1, F.lit(1.0)).when(before > 0, F.col("reached") / before).alias("conversion"))


def _firsts(moves: DataFrame, stages: Sequence[str]) -> DataFrame:
    """Per application: first move, first interview and first offer (or later stage) times."""
    numbered = _numbered(moves, stages).filter(F.col("moved_at").isNotNull())
    interview, offer = stages.index("interview") + 1, stages.index("offer") + 1
    return numbered.groupBy(*APPLICATION).agg(
        F.min("moved_at").alias("first_move"),
        F.min(F.when(F.col("stage_no") == interview, F.col("moved_at"))).alias("interview_at"),
        F.min(F.when(F.col("stage_no") >= offer, F.col("moved_at"))).alias("offer_at"))


def drop_off(moves: DataFrame, vacancies: DataFrame, as_of: dt.datetime | Column, horizon: int = HORIZON_DAYS,
             stages: Sequence[str] = STAGES) -> DataFrame:
    """recruiter, day, at_risk, offers, censored, survival for days 0..horizon with an event or a censoring.

    Time: whole days from the first interview to the first offer after it (event), else to as_of
    (censored); times beyond the horizon are censored at horizon + 1 and leave no row. survival is the
    product-limit estimate of no offer yet at the end of the day: 1 - survival at the horizon is the
    share that got an offer within it, survival the interview drop-off.
    """
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    firsts = _firsts(moves, stages).filter(F.col("interview_at").isNotNull())
    offered = F.col("offer_at").isNotNull() & (F.col("offer_at") >= F.col("interview_at"))
    until = F.when(offered, F.col("offer_at")).otherwise(end)
    days = F.floor((F.unix_micros(until.cast("timestamp")) - F.unix_micros(F.col("interview_at").cast("timestamp"))) / 86_400_000_000)
    timed = (firsts.join(vacancies.select("vacancy_id", "recruiter").dropDuplicates(["vacancy_id"]), "vacancy_id", "left")
             .select("recruiter", days.cast("long").alias("day"), offered.alias("event"))
             .filter(F.col("day") >= 0)
             .withColumn("event", F.col("event") & (F.col("day") <= horizon))
             .withColumn("day", F.least(F.col("day"), F.lit(horizon + 1))))
    per_day = timed.groupBy("recruiter", "day").agg(
        F.count("*").alias("leaving"), F.sum(F.col("event").cast("long")).alias("offers"))
    ordered = Window.partitionBy("recruiter").orderBy("day")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("leaving").over(Window.partitionBy("recruiter"))
    at_risk = total - F.coalesce(F.sum("leaving").over(earlier), F.lit(0))
    step = F.col("at_risk") - F.col("offers")
    curve = per_day.withColumn("at_risk", at_risk).withColumn("zero", F.max((step == 0).cast("int")).over(
        ordered.rowsBetween(Window.unboundedPreceding, 0)))
    logs = F.sum(F.when(step > 0, F.log(step / F.col("at_risk")))).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return curve.filter(F.col("day") <= horizon).select(
        "recruiter", "day", F.col("at_risk").cast("long").alias("at_risk"), F.col("offers").cast("long").alias("offers"),
        (F.col("leaving") - F.col("offers")).cast("long").alias("censored"),
        F.when(F.col("zero") == 1, F.lit(0.0)).otherwise(F.exp(F.coalesce(logs, F.lit(0.0)))).alias("survival"))


def offer_times(moves: DataFrame, vacancies: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """recruiter, offer_date, days (first move to first offer) for every application with an offer."""
    firsts = _firsts(moves, stages).filter(F.col("offer_at").isNotNull())
    days = F.date_diff(F.col("offer_at").cast("date"), F.col("first_move").cast("date")).cast("long")
    return (firsts.join(vacancies.select("vacancy_id", "recruiter").dropDuplicates(["vacancy_id"]), "vacancy_id", "left")
            .select("recruiter", F.col("offer_at").cast("date").alias("offer_date"), days.alias("days")))


def daily_sketches(times: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """The stored state: recruiter, offer_date, n, sketch (a KLL sketch of the days) per recruiter and day."""
    return times.groupBy("recruiter", "offer_date").agg(
        F.count("*").alias("n"), F.kll_sketch_agg_bigint("days", k).alias("sketch"))


def time_to_offer(times: DataFrame, sketches: DataFrame | None = None) -> DataFrame:
    """recruiter, quarter, offers, exact median and p90 (nearest rank), and the sketch's median and p90.

    Exact: the smallest value whose rank reaches the share (percentile_disc semantics), from the sorted
    values of a group; sketch: the daily sketches merged per quarter (rank error about 1.65 / k).
    """
    sketches = daily_sketches(times) if sketches is None else sketches
    quarter = lambda c: F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))
    exact = (times.withColumn("quarter", quarter(F.col("offer_date"))).groupBy("recruiter", "quarter")
             .agg(F.count("*").alias("offers"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY days)").cast("long").alias("median_days"),
                  F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY days)").cast("long").alias("p90_days")))
    merged = (sketches.withColumn("quarter", quarter(F.col("offer_date"))).groupBy("recruiter", "quarter")
              .agg(F.kll_merge_agg_bigint("sketch").alias("sketch")))
    approx = merged.select("recruiter", "quarter",
                           F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.5)).alias("sketch_median_days"),
                           F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.9)).alias("sketch_p90_days"))
    same = exact["recruiter"].eqNullSafe(approx["recruiter"]) & (exact["quarter"] == approx["quarter"])
    return exact.join(approx, same).select(exact["recruiter"], exact["quarter"], "offers", "median_days", "p90_days",
                                           "sketch_median_days", "sketch_p90_days")
