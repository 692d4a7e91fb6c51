"""Funnel, drop-off and time to offer on made moves, against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from swipeflow.operators import hiring

T = dt.datetime
MOVES = "vacancy_id long, candidate_id long, stage string, moved_at timestamp"


def test_funnel_counts_repeats_returns_and_skips_once(spark):
    moves = spark.createDataFrame([
        (1, 1, "applied", T(2024, 1, 1)), (1, 1, "interview", T(2024, 1, 5)), (1, 1, "screening", T(2024, 1, 3)),
        (1, 1, "screening", T(2024, 1, 9)),   # return after the interview, and a repeat
        (1, 2, "applied", T(2024, 1, 2)), (1, 2, "offer", T(2024, 1, 4)),     # skips screening and interview
        (2, 3, "applied", T(2024, 1, 2)), (2, 3, "withdrawn", T(2024, 1, 3)), (2, None, "applied", T(2024, 1, 3)),
        (3, 4, None, T(2024, 1, 1)),
    ], MOVES)
    vacancies = spark.createDataFrame([(1, "r1"), (2, None), (3, "r1")], "vacancy_id long, recruiter string")
    got = {(r["recruiter"], r["stage_no"]): r for r in hiring.funnel(moves, vacancies).collect()}
    assert [(got[("r1", k)]["reached"], got[("r1", k)]["visited"], got[("r1", k)]["skipped"]) for k in range(1, 6)] == [
        (2, 2, 0), (2, 1, 1), (2, 1, 1), (1, 1, 0), (0, 0, 0)]
    assert [got[("r1", k)]["conversion"] for k in range(1, 6)] == [1.0, 1.0, 1.0, 0.5, 0.0]
    assert [got[(None, k)]["reached"] for k in range(1, 6)] == [1, 0, 0, 0, 0]
    assert got[(None, 3)]["conversion"] is None
    assert hiring.funnel(moves.limit(0), vacancies).count() == 0


def _product_limit(times, horizon):
    """(day, at_risk, offers, censored, survival) by the textbook formula."""
    out, survival = [], 1.0
    for day in sorted({d for d, _ in times if d <= horizon}):
        at_risk = sum(1 for d, _ in times if d >= day)
        offers = sum(1 for d, e in times if d == day and e)
        survival *= 1 - offers / at_risk
        out.append((day, at_risk, offers, sum(1 for d, e in times if d == day and not e), survival))
    return out


def test_drop_off_equals_product_limit(spark):
    rng = random.Random(5)
    rows, times, as_of = [], [], T(2024, 6, 1)
    for c in range(300):
        interview = T(2024, 1, 1) + dt.timedelta(days=rng.randrange(0, 140), hours=rng.randrange(24))
        rows.append((7, c, "applied", interview - dt.timedelta(days=3)))
        rows.append((7, c, "interview", interview))
        if rng.random() < 0.6:
            offer = interview + dt.timedelta(days=rng.randrange(0, 45), hours=rng.randrange(24))
            rows.append((7, c, "offer", offer))
            days = (offer - interview).days
            times.append((min(days, 31), days <= 30))
        else:
            days = (as_of - interview).days
            times.append((min(days, 31), False))
        if c % 50 == 0:
            rows.append((7, c, "interview", interview + dt.timedelta(days=2)))   # a second interview changes nothing
    moves = spark.createDataFrame(rows, MOVES)
    vacancies = spark.createDataFrame([(7, "r")], "vacancy_id long, recruiter string")
    got = sorted((r["day"], r["at_risk"], r["offers"], r["censored"], r["survival"])
                 for r in hiring.drop_off(moves, vacancies, as_of).collect())
    want = _product_limit(times, 30)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], rel=1e-12)
    assert any(w[2] > 1 for w in want)  # ties on a day


def test_sketch_median_within_rank_error(spark):
    rng = random.Random(9)
    rows = [("r", dt.date(2024, 1 + m, 1 + d), rng.randrange(0, 200)) for m in range(6) for d in range(28) for _ in range(40)]
    times = spark.createDataFrame(rows, "recruiter string, offer_date date, days long")
    got = {r["quarter"]: r for r in hiring.time_to_offer(times).collect()}
    assert set(got) == {"2024-Q1", "2024-Q2"}
    for quarter, months in (("2024-Q1", (1, 2, 3)), ("2024-Q2", (4, 5, 6))):
        values = sorted(v for _, day, v in rows if day.month in months)
        n = len(values)
        assert got[quarter]["offers"] == n
        assert got[quarter]["median_days"] == values[(n + 1) // 2 - 1]
        rank = sum(1 for v in values if v <= got[quarter]["sketch_median_days"]) / n
        assert abs(rank - 0.5) <= 0.03
        rank90 = sum(1 for v in values if v <= got[quarter]["sketch_p90_days"]) / n
        assert abs(rank90 - 0.9) <= 0.03
