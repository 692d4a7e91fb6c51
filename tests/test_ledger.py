"""Ledger transitions folded to the latest state, against the source's digests."""

from __future__ import annotations

import datetime as dt

from swipeflow.operators import ledger

T = dt.datetime
LOG = "source_id string, period_start timestamp, status string, at timestamp, rows long, key_sum long, value_sum long"
SRC = "source_id string, period_start timestamp, key long, value long"


def test_missing_failed_changed_and_open(spark):
    jan, feb, mar, apr, may = (T(2024, m, 1) for m in (1, 2, 3, 4, 5))
    log = spark.createDataFrame([
        ("s", jan, "done", T(2024, 2, 3), 2, 3, 30), ("s", jan, "running", T(2024, 2, 2), None, None, None),   # appended out of order
        ("s", feb, "done", T(2024, 3, 2), 1, 3, 30), ("s", feb, "error", T(2024, 3, 5), None, None, None),      # failed after a done
        ("s", mar, "done", T(2024, 4, 2), 1, 4, 40),                                                             # a row came later
        ("s", apr, "running", T(2024, 5, 2), None, None, None),
        ("s", may, "done", T(2024, 6, 2), 1, 9, 90), ("s", may, "running", T(2024, 6, 2), None, None, None),      # tie: greater status
        ("s", None, "done", T(2024, 6, 2), 1, 9, 90),
    ], LOG)
    source = spark.createDataFrame([
        ("s", jan, 1, 10), ("s", jan, 2, 20), ("s", feb, 3, 30), ("s", mar, 4, 40), ("s", mar, 5, 50), ("s", apr, 6, 60),
        ("s", T(2024, 6, 1), 7, 70), ("s", may, 9, 90),
    ], SRC)
    got = {r["period_start"]: (r["reason"], r["latest_status"], r["recorded_rows"], r["current_rows"])
           for r in ledger.attention(log, ledger.digests(source, "key", "value")).collect()}
    assert got == {
        feb: ("failed", "error", None, 1), mar: ("changed", "done", 1, 2), apr: ("open", "running", None, 1),
        T(2024, 6, 1): ("missing", None, None, 1), may: ("open", "running", None, 1),
    }
