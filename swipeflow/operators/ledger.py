"""Load-ledger transitions kept as data: an append-only log folded to each period's latest state.

log: (source_id, period_start, status, at, rows, key_sum, value_sum), one row per transition (running, done,
error); a done row records the content digest of the source period it loaded. The latest state of a period
is ``max_by`` over its transitions (a mergeable fold, partial on the map side; ties on ``at`` go to the
greater status text). Digests are additive (row count and sums), so the source side is one aggregation.

A period is reported as ``missing`` when the source has rows for it and the log none, ``failed`` when its
latest state is error, ``changed`` when it is done but the source digest differs from the recorded one, and
``open`` when it is still running or pending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["source_id", "period_start"]


def latest(log: DataFrame) -> DataFrame:
    """source_id, period_start and the latest transition's status, at, rows, key_sum, value_sum."""
    state = F.struct("at", "status", "rows", "key_sum", "value_sum")
    folded = log.filter(F.col("period_start").isNotNull()).groupBy(*KEY).agg(F.max_by(state, F.struct("at", "status")).alias("s"))
    return folded.select(*KEY, "s.status", "s.at", "s.rows", "s.key_sum", "s.value_sum")


def digests(source: DataFrame, key: str, value: str) -> DataFrame:
    """source_id, period_start, rows, key_sum, value_sum of the source rows (source_id, period_start, key, value)."""
    return source.groupBy(*KEY).agg(F.count("*").cast("long").alias("rows"), F.sum(key).cast("long").alias("key_sum"),
                                   F.sum(value).cast("long").alias("value_sum"))


def attention(log: DataFrame, current: DataFrame) -> DataFrame:
    """source_id, period_start, reason, latest_status, recorded_rows, current_rows for every period that needs a load."""
    state = latest(log)
    joined = current.alias("c").join(state.alias("l"), KEY, "full")
    differs = ~((F.col("l.rows") == F.col("c.rows")) & F.col("l.key_sum").eqNullSafe(F.col("c.key_sum"))
                & F.col("l.value_sum").eqNullSafe(F.col("c.value_sum")))
    reason = (F.when(F.col("l.status").isNull(), F.lit("missing"))
              .when(F.col("l.status") == "error", F.lit("failed"))
              .when((F.col("l.status") == "done") & F.coalesce(differs, F.lit(True)), F.lit("changed"))
              .when(F.col("l.status") != "done", F.lit("open")))
    return joined.select(*KEY, reason.alias("reason"), F.col("l.status").alias("latest_status"),
                         F.col("l.rows").alias("recorded_rows"), F.coalesce(F.col("c.rows"), F.lit(0)).cast("long").alias("current_rows")
                         ).filter(F.col("reason").isNotNull())
