"""Vacancy and candidate data-quality rules.

Inputs: vacancies (vacancy_id, recruiter, status, opened_at), subs (sub_id,
parent_id, last_activity, published), candidates (candidate_id, form_filled,
consent), applications (candidate_id, vacancy_id, stage, moved_at). Statuses are
active, archive, closed, open, cancelled and pause; stages accepted, unassigned
and in_progress. Every rule is a one-row table with a ``value``.

Rules that join reduce the large side to one counted row per vacancy before the
join, so a vacancy with very many rows stays one row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_STATUSES = ("open", "active")
IDLE_SUB_DAYS = 14
STUCK_DAYS = 7


def _as_of(as_of: dt.date | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def _count(df: DataFrame, n: Column | None = None) -> DataFrame:
    total = F.count(F.lit(1)) if n is None else F.coalesce(F.sum(n), F.lit(0))
    return df.agg(total.cast("double").alias("value"))


def no_recruiter(vacancies: DataFrame) -> DataFrame:
    return _count(vacancies.filter(F.col("recruiter").isNull()))


def idle_subs(subs: DataFrame, as_of: dt.date | Column, days: int = IDLE_SUB_DAYS) -> DataFrame:
    return _count(subs.filter(F.date_diff(_as_of(as_of), F.col("last_activity")) > days))


def orphan_subs(subs: DataFrame, vacancies: DataFrame) -> DataFrame:
    """Subs without a parent: none given, or one that does not exist."""
    per_parent = subs.groupBy("parent_id").agg(F.count(F.lit(1)).alias("n"))
    return _count(per_parent.join(vacancies.select(F.col("vacancy_id").alias("parent_id")), "parent_id", "left_anti"),
                  F.col("n"))


def unpublished_parents(subs: DataFrame, vacancies: DataFrame) -> DataFrame:
    """Vacancies with at least one unpublished sub."""
    parents = subs.groupBy("parent_id").agg(F.bool_or(~F.col("published")).alias("unpublished")).filter("unpublished")
    return _count(parents.join(vacancies.select(F.col("vacancy_id").alias("parent_id")), "parent_id", "left_semi"))


def form_share(candidates: DataFrame) -> DataFrame:
    """Share of candidates with a filled evaluation form, percent."""
    return candidate_values(candidates).select(F.col("form_share").alias("value"))


def no_consent(candidates: DataFrame) -> DataFrame:
    return candidate_values(candidates).select(F.col("no_consent").cast("double").alias("value"))


def _staged(applications: DataFrame, stage: str) -> DataFrame:
    return applications.filter(F.col("stage") == stage).groupBy("vacancy_id").agg(F.count(F.lit(1)).alias("n"))


def accepted_not_closed(applications: DataFrame, vacancies: DataFrame) -> DataFrame:
    """Accepted applications on vacancies that are not closed."""
    live = vacancies.filter(F.col("status") != "closed").select("vacancy_id")
    return _count(_staged(applications, "accepted").join(live, "vacancy_id", "left_semi"), F.col("n"))


def unassigned_inactive(applications: DataFrame, vacancies: DataFrame) -> DataFrame:
    """Unassigned applications on vacancies that are neither open nor active."""
    idle = vacancies.filter(~F.col("status").isin(*OPEN_STATUSES)).select("vacancy_id")
    return _count(_staged(applications, "unassigned").join(idle, "vacancy_id", "left_semi"), F.col("n"))


def stuck_candidates(applications: DataFrame, subs: DataFrame, as_of: dt.date | Column,
                     days: int = STUCK_DAYS) -> DataFrame:
    """Candidate and parent-vacancy pairs whose last move is more than ``days`` ago."""
    still = (
        applications.groupBy("vacancy_id", "candidate_id").agg(F.max("moved_at").alias("moved_at"))
        .filter(F.date_diff(_as_of(as_of), F.col("moved_at")) > days)
        .groupBy("vacancy_id").agg(F.count(F.lit(1)).alias("n"))
    )
    parents = subs.filter(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("vacancy_id")).distinct()
    return _count(still.join(parents, "vacancy_id", "left_semi"), F.col("n"))


def severity(value: Column, cutoffs: tuple[float, float], low_is_bad: bool = False) -> Column:
    """ok / warn / bad by two cut-offs; with ``low_is_bad`` small values are the bad ones."""
    warn, bad = (F.lit(float(c)) for c in cutoffs)
    if low_is_bad:
        return F.when(value < bad, F.lit("bad")).when(value < warn, F.lit("warn")).otherwise(F.lit("ok"))
    return F.when(value > bad, F.lit("bad")).when(value > warn, F.lit("warn")).otherwise(F.lit("ok"))


# (warn above, bad above); for the form share (warn below, bad below).
DEFAULT_CUTOFFS: dict[str, tuple[float, float]] = {
    "no_recruiter": (0, 10), "idle_subs": (0, 20), "orphan_subs": (0, 20), "unpublished_parents": (0, 20),
    "form_share": (80, 50), "no_consent": (0, 10), "accepted_not_closed": (0, 10),
    "unassigned_inactive": (0, 100), "stuck_candidates": (0, 100),
}


SECTIONS = {
    "no_recruiter": "vacancy", "idle_subs": "vacancy", "orphan_subs": "vacancy", "unpublished_parents": "vacancy",
    "form_share": "candidate", "no_consent": "candidate", "accepted_not_closed": "application",
    "unassigned_inactive": "application", "stuck_candidates": "application",
}


def entity_values(vacancies: DataFrame, subs: DataFrame, applications: DataFrame,
                  as_of: dt.date | Column) -> DataFrame:
    """One row with every vacancy and application rule; each input is read once.

    Subs and applications shrink to one row per vacancy, meet the vacancies in
    full outer joins, and a single aggregation reads all rules off the result.
    """
    per_parent = subs.groupBy(F.col("parent_id").alias("vacancy_id")).agg(
        F.count(F.lit(1)).alias("n_subs"),
        F.count_if(F.date_diff(_as_of(as_of), F.col("last_activity")) > IDLE_SUB_DAYS).alias("n_idle"),
        F.bool_or(~F.col("published")).alias("unpublished"),
    )
    per_pair = applications.groupBy("vacancy_id", "candidate_id").agg(
        F.max("moved_at").alias("moved_at"),
        F.count_if(F.col("stage") == "accepted").alias("accepted"),
        F.count_if(F.col("stage") == "unassigned").alias("unassigned"),
    )
    per_vacancy = per_pair.groupBy("vacancy_id").agg(
        F.sum("accepted").alias("accepted"),
        F.sum("unassigned").alias("unassigned"),
        F.count_if(F.date_diff(_as_of(as_of), F.col("moved_at")) > STUCK_DAYS).alias("stuck"),
    )
    known = vacancies.select("vacancy_id", "recruiter", "status", F.lit(True).alias("known"))
    whole = known.join(per_parent, "vacancy_id", "full_outer").join(per_vacancy, "vacancy_id", "full_outer")

    def total(n: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(n))), F.lit(0))

    return whole.agg(
        F.count_if(F.col("known") & F.col("recruiter").isNull()).alias("no_recruiter"),
        total("n_idle", F.lit(True)).alias("idle_subs"),
        total("n_subs", F.col("known").isNull()).alias("orphan_subs"),
        F.count_if(F.col("known") & F.col("unpublished")).alias("unpublished_parents"),
        total("accepted", F.col("status") != "closed").alias("accepted_not_closed"),
        total("unassigned", ~F.col("status").isin(*OPEN_STATUSES)).alias("unassigned_inactive"),
        total("stuck", F.col("vacancy_id").isNotNull() & F.col("n_subs").isNotNull()).alias("stuck_candidates"),
    )


def candidate_values(candidates: DataFrame) -> DataFrame:
    """One row with every candidate rule."""
    share = F.lit(100.0) * F.count_if(F.col("form_filled")) / F.nullif(F.count(F.lit(1)), F.lit(0))
    return candidates.agg(F.round(share, 2).alias("form_share"), F.count_if(~F.col("consent")).alias("no_consent"))


def filter_scope(vacancies: DataFrame, subs: DataFrame, applications: DataFrame, recruiter: str | None = None,
                 statuses: Sequence[str] | None = None, period: tuple[dt.date, dt.date] | None = None,
                 ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vacancies of a recruiter, of some statuses or opened in a period, with their subs and applications."""
    chosen = vacancies
    if recruiter is not None:
        chosen = chosen.filter(F.col("recruiter") == recruiter)
    if statuses is not None:
        chosen = chosen.filter(F.col("status").isin(*statuses))
    if period is not None:
        chosen = chosen.filter(F.to_date("opened_at").between(F.lit(period[0]), F.lit(period[1])))
    if chosen is vacancies:
        return vacancies, subs, applications
    ids = chosen.select("vacancy_id")
    return (
        chosen,
        subs.join(ids.withColumnRenamed("vacancy_id", "parent_id"), "parent_id", "left_semi"),
        applications.join(ids, "vacancy_id", "left_semi"),
    )


def dashboard(vacancies: DataFrame, subs: DataFrame, candidates: DataFrame, applications: DataFrame,
              as_of: dt.date | Column, recruiter: str | None = None, statuses: Sequence[str] | None = None,
              period: tuple[dt.date, dt.date] | None = None,
              cutoffs: Mapping[str, tuple[float, float]] = DEFAULT_CUTOFFS) -> DataFrame:
    """All rules as one table: section, rule, value, severity.

    With a filter every rule covers the chosen vacancies only: their subs, applications and candidates. A sub
    without a vacancy belongs to no choice, so ``orphan_subs`` is then 0.
    """
    vac, sub, app = filter_scope(vacancies, subs, applications, recruiter, statuses, period)
    if vac is not vacancies:
        # with a filter, the candidates of the chosen vacancies
        candidates = candidates.join(app.select("candidate_id"), "candidate_id", "left_semi")
    people = candidate_values(candidates)
    values = entity_values(vac, sub, app, as_of).withColumns(
        {rule: people.select(rule).scalar() for rule in ("form_share", "no_consent")})
    rows = [
        F.struct(F.lit(section).alias("section"), F.lit(rule).alias("rule"), F.col(rule).cast("double").alias("value"),
                 severity(F.col(rule), cutoffs[rule], low_is_bad=rule == "form_share").alias("severity"))
        for rule, section in SECTIONS.items()
    ]
    return values.select(F.inline(F.array(*rows)))
