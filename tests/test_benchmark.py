"""Benchmark levels from one grouping-sets aggregation."""

from __future__ import annotations

import datetime as dt

import pytest

from swipeflow.operators import benchmark

D = dt.date


def test_levels_and_one_expand(spark):
    mart = spark.createDataFrame([
        ("a", "x", "p1", D(2024, 1, 1), 60.0), ("a", "x", "p1", D(2024, 1, 1), 30.5), ("a", "x", "p1", D(2024, 1, 2), 10.0),
        ("a", None, "p2", D(2024, 1, 1), 100.0), ("b", "x", "p3", D(2024, 1, 1), 20.0), ("b", "x", None, D(2024, 1, 1), 999.0),
    ], "site_id string, department_name string, person_id string, report_date date, total_minutes double")
    result = benchmark.presence_benchmark(mart)
    got = {r["person_id"]: r for r in result.collect()}
    assert set(got) == {"p1", "p2", "p3"}
    assert (got["p1"]["days"], got["p1"]["avg_minutes"], got["p1"]["department_avg_minutes"]) == (2, 50.25, 50.25)
    assert got["p2"]["department_avg_minutes"] == 100.0           # a null department is a department of its own
    assert got["p1"]["site_avg_minutes"] == pytest.approx((90.5 + 10.0 + 100.0) / 3)
    assert all(r["company_avg_minutes"] == pytest.approx((90.5 + 10.0 + 100.0 + 20.0) / 4) for r in got.values())
    final = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Expand") == 1 and "NestedLoop" not in final


def test_monthly_persons_from_daily_sketches(spark):
    import random

    from swipeflow.operators import mart as mart_ops
    rng = random.Random(4)
    rows = [(D(2024, 1 + m, 1 + d), "zone", f"p{rng.randrange(20_000)}") for m in range(2) for d in range(28) for _ in range(400)]
    rows += [(D(2024, 1, 1), "zone", None)]
    df = spark.createDataFrame(rows, "report_date date, zone_type string, person_id string")
    got = {r["month"]: r for r in mart_ops.persons_by_month(df).collect()}
    for month in (D(2024, 1, 1), D(2024, 2, 1)):
        exact = len({p for day, _, p in rows if p and day.month == month.month})
        assert got[month]["persons"] == exact
        assert abs(got[month]["persons_estimate"] - exact) <= 0.05 * exact
