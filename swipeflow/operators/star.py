"""Two-source star: event view, status and identity matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swipeflow.functions import times, values
from swipeflow.operators.events import join_dim


def star_events(events: DataFrame, sources: DataFrame, types: DataFrame, persons: DataFrame,
                units: DataFrame, territories: DataFrame, tz_hours: int = 3) -> DataFrame:
    """Event grain with source, type, person, department and point attributes.

    Units are joined to persons first (both dimensions), so the fact side is
    exchanged at most for persons and points, and not at all for those Spark
    measures small enough to broadcast.
    """
    people = persons.select(
        "source_id", "person_id", "canonical_person_id", "last_name", "first_name", "middle_name",
        "tab_number", "org_id",
    )
    people = people.join(
        units.select("source_id", F.col("id").alias("org_id"), F.col("name").alias("department")),
        ["source_id", "org_id"], "left",
    )
    points = territories.select(
        "source_id", F.col("id").alias("territory_id"), F.col("name").alias("territory_name"),
        F.col("type").alias("territory_type"),
    )
    kinds = types.select(F.col("id").alias("transaction_type_id"), F.col("name").alias("transaction_name"))
    joined = events.join(sources.select("source_id", "city"), "source_id", "left")
    joined = joined.join(kinds, "transaction_type_id", "left")
    joined = join_dim(joined, people, ["source_id", "person_id"], spread="event_guid")
    joined = join_dim(joined, points, ["source_id", "territory_id"], spread="event_guid")
    return joined.select(
        "source_id", "city", "event_guid", "event_dt",
        times.local_time(F.col("event_dt"), tz_hours).alias("event_dt_local"),
        "transaction_type_id", "transaction_name",
        values.direction(F.col("transaction_type_id")).alias("event_direction"),
        "person_id", "canonical_person_id",
        values.person_key(F.col("canonical_person_id"), F.col("person_id")).alias("person_key"),
        "last_name", "first_name", "middle_name", "tab_number", "org_id", "department",
        "territory_id", "territory_name", "territory_type", "card_code",
    )


def max_event_time(events: DataFrame) -> DataFrame:
    """High-water mark per source."""
    return events.groupBy("source_id").agg(F.max("event_dt").alias("max_event_dt"))


def load_status(events: DataFrame, sources: DataFrame, persons: DataFrame, units: DataFrame,
                territories: DataFrame, types: DataFrame, ledger: DataFrame) -> DataFrame:
    """Row counts per source and table, event time range, ledger by status, failed periods."""
    none_ts = F.lit(None).cast("timestamp")
    none_text = F.lit(None).cast("string")

    def rows(df: DataFrame, section: str, label=none_text, lo=none_ts, hi=none_ts, note=none_text,
             source="source_id", n="n") -> DataFrame:
        return df.select(
            F.lit(section).alias("section"), (F.col(source) if source else none_text).alias("source_id"),
            label.alias("label"), F.col(n).cast("bigint").alias("n"), lo.alias("dt_min"), hi.alias("dt_max"),
            note.alias("note"),
        )

    def per_source(df: DataFrame, section: str) -> DataFrame:
        return rows(df.groupBy("source_id").agg(F.count(F.lit(1)).alias("n")), section)

    # Aggregating before the join leaves one row per source on the event side.
    ranges = events.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_dt").alias("lo"), F.max("event_dt").alias("hi")
    ).join(sources.select("source_id", "city"), "source_id", "inner")
    statuses = ledger.groupBy("source_id", "status").agg(F.count(F.lit(1)).alias("n"))
    failed = ledger.filter(F.col("status") == "error").withColumn("n", F.lit(1))
    parts = [
        rows(ranges, "events", F.col("city"), F.col("lo"), F.col("hi")),
        per_source(persons, "persons"),
        per_source(units, "org_units"),
        per_source(territories, "territories"),
        rows(types.agg(F.count(F.lit(1)).alias("n")), "transaction_types", source=None),
        rows(statuses, "ledger", F.col("status")),
        rows(failed, "ledger_error", F.col("status"), F.col("period_start"), F.col("period_end"),
             F.col("error_msg")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _numbered(persons: DataFrame, source: str) -> DataFrame:
    return persons.filter(
        (F.col("source_id") == source) & F.col("tab_number").isNotNull() & (F.col("tab_number") != "")
    )


def match_identities(persons: DataFrame, src_a: str, src_b: str) -> DataFrame:
    """Persons of two sources with the same non-empty number.

    A number held by several persons of both sources gives every pairing, as
    the result asks for; ``apply_identities`` works without building them.
    """
    a = _numbered(persons, src_a).select(
        "tab_number", F.col("person_id").alias("pid_a"), "last_name", "first_name"
    )
    b = _numbered(persons, src_b).select("tab_number", F.col("person_id").alias("pid_b"))
    return a.join(b, "tab_number", "inner").select("tab_number", "pid_a", "pid_b", "last_name", "first_name")


def match_numbers(persons: DataFrame, src_a: str, src_b: str) -> DataFrame:
    """Per shared number: how many persons of each source hold it, and the smallest ids; no pairing is built."""
    def side(source: str, tag: str) -> DataFrame:
        return _numbered(persons, source).groupBy("tab_number").agg(
            F.count(F.lit(1)).alias(f"n_{tag}"), F.min("person_id").alias(f"first_{tag}"))

    return side(src_a, "a").join(side(src_b, "b"), "tab_number")


def top_matches(persons: DataFrame, src_a: str, src_b: str, n: int = 10) -> DataFrame:
    """The first ``n`` rows of match_identities by number and ids.

    They lie in the n smallest shared numbers and, of each, in the n smallest ids of either side, so at most
    n * n * n pairs are built and sorted.
    """
    numbers = match_numbers(persons, src_a, src_b).select("tab_number").orderBy("tab_number").limit(n)
    rank = F.row_number().over(Window.partitionBy("source_id", "tab_number").orderBy("person_id"))
    few = persons.join(numbers, "tab_number", "left_semi").filter(F.col("source_id").isin(src_a, src_b)).withColumn(
        "_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    return match_identities(few, src_a, src_b).orderBy("tab_number", "pid_a", "pid_b").limit(n)


def apply_identities(persons: DataFrame, src_a: str, src_b: str, dry_run: bool = True) -> DataFrame:
    """Persons with the first source's id as canonical id on both matched rows.

    With several candidates for a number the smallest id is taken. A number is
    reduced to one row per source before joining, so repeats never multiply.
    """
    if dry_run:
        return match_identities(persons, src_a, src_b)
    canon = (
        _numbered(persons, src_a).groupBy("tab_number").agg(F.min("person_id").alias("_canonical"))
    )
    other = _numbered(persons, src_b).select("tab_number").distinct()
    shared = canon.join(other, "tab_number", "left_semi")
    target = F.when(
        F.col("source_id").isin(src_a, src_b) & (F.col("tab_number") != ""), F.col("tab_number")
    )
    keyed = persons.withColumn("_tab", target).withColumn(
        "_row", F.concat_ws("/", "source_id", "person_id")
    )
    joined = join_dim(keyed, shared.withColumnRenamed("tab_number", "_tab"), ["_tab"], spread="_row")
    # A matched row of the first source keeps its own id; the other source takes the smallest one.
    chosen = F.when(
        F.col("_canonical").isNotNull() & (F.col("source_id") == src_a), F.col("person_id")
    ).otherwise(F.col("_canonical"))
    return joined.withColumn("canonical_person_id", F.coalesce(chosen, F.col("canonical_person_id"))).select(
        *persons.columns
    )


def count_common_tabs(persons: DataFrame, src_a: str, src_b: str) -> DataFrame:
    """How many distinct numbers both sources know."""
    a = _numbered(persons, src_a).select("tab_number").distinct()
    b = _numbered(persons, src_b).select("tab_number").distinct()
    return a.join(b, "tab_number", "left_semi").agg(F.count(F.lit(1)).alias("common_tabs"))
