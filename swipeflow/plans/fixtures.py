"""The domain tables, derived by Spark from the given parquet tables.

The same derivations are written in SQL in ``oracles.py``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swipeflow import schemas
from swipeflow.functions import times, values
from swipeflow.operators.events import join_dim, zone_table
from swipeflow.session import config_table
from swipeflow.rules import Rules
from swipeflow.session import config_table

PERIOD = (dt.date(2024, 1, 5), dt.date(2024, 1, 25))
CURRENT = Rules(period=PERIOD)
UNBOUNDED = Rules.unbounded(period=PERIOD)
SAME_DAY = Rules.same_day(period=PERIOD)

_KINDS = {
    "point-0": "turnstile", "point-1": "door", "point-2": "door", "point-4": "turnstile", "point-5": "door",
    "point-6": "door", "point-7": "door", "point-8": "turnstile", "point-10": "turnstile", "point-11": "door",
}
_ZONES = {
    "territory": [f"point-{i}" for i in range(0, 7)],
    "building": [f"point-{i}" for i in range(7, 10)],
    "production": ["point-10", "point-11"],
}
SITES = {site: {"zones": _ZONES, "access_point_types": _KINDS} for site in ("site_a", "site_b")}
SOURCES = ("msk", "spb")
CODES = {"click": 590144, "signup": 590152, "view": 590145, "purchase": 590153, "error": 599999}
# Transaction codes and their names.
TYPES = (
    (590144, "нормальный вход", 1), (590152, "фактический вход", 1), (590145, "нормальный выход", 2),
    (590153, "фактический выход", 2), (590146, "выход вне временного профиля", 2),
    (590244, "нормальный выход посетителя", 4), (590245, "фактический выход посетителя", 4),
)


SITE = "CASE WHEN {} % 2 = 0 THEN 'site_a' ELSE 'site_b' END AS site_id"
SOURCE = "CASE WHEN {} % 2 = 0 THEN 'msk' ELSE 'spb' END AS source_id"
GUID = "concat('00000000-0000-4000-{}-', lpad(CAST({} AS STRING), 12, '0'))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def guid(kind: str, number: Column) -> Column:
    return F.concat(F.lit(f"00000000-0000-4000-{kind}-"), F.lpad(number.cast("string"), 12, "0"))


def source(number: Column) -> Column:
    return F.when(number % 2 == 0, F.lit("msk")).otherwise(F.lit("spb"))


def zones(spark: SparkSession) -> DataFrame:
    return zone_table(spark, SITES)


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of both layouts: site and source, not yet zoned or classified."""
    return shape_events(table(spark, sf_dir, "events"))


def shape_events(raw: DataFrame) -> DataFrame:
    codes = " ".join(f"WHEN '{name}' THEN {code}" for name, code in CODES.items())
    return raw.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k").selectExpr(
        SITE.format("user_id"),
        SOURCE.format("user_id"),
        GUID.format("8000", "event_id") + " AS event_guid",
        "CAST(ts AS TIMESTAMP) AS event_dt",
        f"CASE event_type {codes} END AS transaction_type_id",
        f"CASE WHEN k <> 13 THEN {GUID.format('9000', 'user_id')} END AS person_id",
        GUID.format("a300", "k % 10") + " AS territory_id",
        "CASE WHEN k >= 97 THEN 'unmapped' ELSE concat('point-', k % 12) END AS territory_name",
        "lpad(CAST(user_id AS STRING), 8, '0') AS card_code",
    )


def pilot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_events(spark, sf_dir).drop("source_id")


def star_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_events(spark, sf_dir).select(*[c.split()[0] for c in schemas.STAR_EVENTS.split(", ")])


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons of both layouts."""
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS department_name")
    return table(spark, sf_dir, "customer").join(nations, "c_nationkey", "left").selectExpr(
        SITE.format("c_custkey"),
        SOURCE.format("c_custkey"),
        GUID.format("9000", "c_custkey") + " AS person_id",
        "c_name AS last_name",
        "c_mktsegment AS first_name",
        "CASE WHEN c_custkey % 4 <> 0 THEN concat('M', c_custkey % 7) END AS middle_name",
        "CASE WHEN c_custkey % 10 >= 8 THEN '' ELSE CAST(c_custkey DIV 2 AS STRING) END AS tab_number",
        GUID.format("a200", "c_nationkey") + " AS org_id",
        "department_name",
        "CAST(NULL AS STRING) AS canonical_person_id",
    )


def sources(spark: SparkSession) -> DataFrame:
    return config_table(spark, [("msk", "Москва", "host-1"), ("spb", "Петербург", "host-2")],
                        "source_id string, city string, host_addr string")


def types(spark: SparkSession) -> DataFrame:
    return config_table(spark, TYPES, schemas.DIM_TRANSACTION_TYPES)


def _both_sources(df: DataFrame) -> DataFrame:
    return df.withColumn("source_id", F.explode(F.array(*[F.lit(s) for s in SOURCES])))


def org_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    roots = table(spark, sf_dir, "region").select(
        guid("a100", F.col("r_regionkey")).alias("id"), F.col("r_name").alias("name"),
        none.alias("descr"), none.alias("parent_id"))
    units = table(spark, sf_dir, "nation").select(
        guid("a200", F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name"),
        F.concat(F.lit("unit "), F.col("n_nationkey").cast("string")).alias("descr"),
        guid("a100", F.col("n_regionkey")).alias("parent_id"))
    return _both_sources(roots.unionByName(units)).select(*[c.split()[0] for c in schemas.DIM_ORG_UNITS.split(", ")])


def _mask(key: Column) -> Column:
    return (
        F.when(key % 5 == 0, F.lit("1")).when(key % 5 == 1, F.lit("130"))
        .when(key % 5 == 2, F.lit("9223372036854775938")).when(key % 5 == 3, F.lit("")).otherwise(F.lit("x"))
    )


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")

    def rows(name: str, key: str, title: str, kind: int, own: str, parent: Column) -> DataFrame:
        k = F.col(key)
        return table(spark, sf_dir, name).select(
            guid(own, k).alias("id"), F.lit(kind).alias("type"), F.col(title).alias("name"),
            none.alias("descr"), parent.alias("parent_id"),
            F.concat(F.lit("c-"), k.cast("string")).alias("component_id"), _mask(k).alias("feature_mask"))

    tree = rows("region", "r_regionkey", "r_name", 0, "a100", none).unionByName(
        rows("nation", "n_nationkey", "n_name", 1, "a200", guid("a100", F.col("n_regionkey")))).unionByName(
        rows("supplier", "s_suppkey", "s_name", 3, "a300", guid("a200", F.col("s_nationkey"))))
    return _both_sources(tree).select(*[c.split()[0] for c in schemas.DIM_TERRITORIES.split(", ")])


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards from orders: every seventh code is empty, orders of status P are primary cards."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        guid("9000", F.col("o_custkey")).alias("person_id"), key.alias("pos"),
        F.when(key % 7 == 0, F.lit("")).otherwise(F.lpad(key.cast("string"), 8, "0")).alias("card_code"),
        F.when(F.col("o_orderstatus") == "P", F.lit("true")).otherwise(F.lit("false")).alias("is_primary"),
        F.col("o_orderpriority").alias("acc_group"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load ledger from the monthly orders; months whose number of orders divides by five are missing."""
    months = table(spark, sf_dir, "orders").groupBy(
        source(F.col("o_custkey")).alias("source_id"),
        F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).alias("period_start"),
    ).agg(F.count(F.lit(1)).alias("rows_loaded")).filter(F.col("rows_loaded") % 5 != 0)
    status = F.when(F.col("rows_loaded") % 4 == 0, F.lit("error")).when(
        F.col("rows_loaded") % 4 == 1, F.lit("pending")).otherwise(F.lit("done"))
    return months.select(
        "source_id", "period_start", (F.col("period_start") + F.expr("INTERVAL 1 MONTH")).alias("period_end"),
        status.alias("status"), "rows_loaded",
        F.when(status == "error", F.concat(F.lit("failed after "), F.col("rows_loaded").cast("string")))
        .alias("error_msg"))


def history_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last order time per source."""
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").groupBy(source(F.col("o_custkey")).alias("source_id")).agg(
        F.min(at).alias("start"), F.max(at).alias("end"))


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The all-text export frame, with the department of the person's row."""
    people = persons(spark, sf_dir).select(
        "site_id", "person_id",
        values.full_name(F.col("last_name"), F.col("first_name"), F.col("middle_name")).alias("person_fullname"),
        F.col("last_name").alias("person_lastname"), F.col("first_name").alias("person_firstname"),
        F.when(F.col("department_name") == "NATION_3", F.lit("None"))
        .otherwise(F.concat(F.lit(" "), F.col("department_name"))).alias("department"), "tab_number")
    joined = join_dim(all_events(spark, sf_dir), people, ["site_id", "person_id"], spread="event_guid")
    return joined.select(
        F.date_format("event_dt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_datetime"),
        F.col("transaction_type_id").cast("string").alias("transaction_code"),
        F.lit(None).cast("string").alias("transaction_name"),
        "territory_name",
        F.lit("nan").alias("zone_name"),
        "person_id", "person_fullname", "person_lastname", "person_firstname", "department", "tab_number",
        "card_code",
    )


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed XML of every event: positional values, an id list, empty elements for NULLs."""
    return payloads_of(all_events(spark, sf_dir))


def payloads_of(events: DataFrame) -> DataFrame:
    def item(value: Column) -> Column:
        return F.coalesce(F.concat(F.lit("<anyType>"), value, F.lit("</anyType>")), F.lit("<anyType/>"))

    local = F.date_format(times.local_time(F.col("event_dt")), "d.MM.yyyy H:mm:ss")
    ids = F.concat(F.lit("<guid>"), F.col("territory_id"), F.lit("</guid><guid>"), F.col("event_guid"),
                   F.lit("</guid>"))
    return events.select("site_id", F.concat(
        F.lit("<EventObject><Values>"),
        item(F.col("event_guid")), item(local), item(F.col("transaction_type_id").cast("string")),
        item(F.col("person_id")), item(ids), item(F.col("card_code")), item(F.col("territory_name")),
        F.lit("</Values></EventObject>")).alias("payload"))


def star_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed XML of the two-source layout: ISO times, ids as separated text."""
    def item(value: Column) -> Column:
        return F.coalesce(F.concat(F.lit("<anyType>"), value, F.lit("</anyType>")), F.lit("<anyType/>"))

    iso = F.date_format("event_dt", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return star_rows(spark, sf_dir).select("source_id", F.concat(
        F.lit("<EventObject><Values>"),
        item(F.col("event_guid")), item(iso), item(F.col("transaction_type_id").cast("string")),
        item(F.col("person_id")), item(F.concat_ws(",", "territory_id", "event_guid")), item(F.col("card_code")),
        F.lit("</Values></EventObject>")).alias("payload"))


def rough_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As star_payloads, with missing ids (k = 5), offsets, fine fractions, dates alone and unreadable times by k % 5."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = table(spark, sf_dir, "events").select(
        source(F.col("user_id")).alias("source_id"), guid("8000", F.col("event_id")).alias("guid"), F.col("ts"), k.alias("k"))
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(F.col("k") % 5 == 0, F.concat(second, F.lit("Z"))).when(F.col("k") % 5 == 1, F.concat(second, F.lit("+03:00")))
        .when(F.col("k") % 5 == 2, F.concat(second, F.lit(".1234567"))).when(F.col("k") % 5 == 3, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "d.M.yyyy")))
    return rows.select("source_id", F.concat(
        F.lit("<EventObject><Values>"), F.when(F.col("k") == 5, F.lit("<anyType/>")).otherwise(
            F.concat(F.lit("<anyType>\n  "), F.col("guid"), F.lit("\t</anyType>"))),
        F.lit("<anyType>"), text, F.lit("</anyType></Values></EventObject>")).alias("payload"))


def type_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed XML of the transaction codes that occur in the events, the mask being the event count."""
    counted = all_events(spark, sf_dir).groupBy("transaction_type_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.concat(
        F.lit("<TransactionType><ID> "), F.col("transaction_type_id").cast("string"), F.lit("</ID><NAME>code "),
        F.col("transaction_type_id").cast("string"), F.lit("</NAME><CLASS_MASK>"), F.col("n").cast("string"),
        F.lit("</CLASS_MASK></TransactionType>")).alias("payload"))


def member_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed XML of one mixed list: org units first, then persons."""
    def tag(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>")), F.lit(""))

    units = org_units(spark, sf_dir).select(
        "source_id", F.lit(0).cast("bigint").alias("pos"),
        F.concat(F.lit("<OrgUnit>"), tag("ID", F.col("id")), tag("NAME", F.col("name")), tag("DESC", F.col("descr")),
                 tag("PARENT_ID", F.col("parent_id")), F.lit("</OrgUnit>")).alias("payload"))
    people = persons(spark, sf_dir).select(
        "source_id", F.lit(1).cast("bigint").alias("pos"),
        F.concat(F.lit("<Person>"), tag("ID", F.col("person_id")), tag("LAST_NAME", F.col("last_name")),
                 tag("FIRST_NAME", F.col("first_name")), tag("MIDDLE_NAME", F.col("middle_name")),
                 tag("TAB_NUM", F.col("tab_number")), tag("ORG_ID", F.col("org_id")),
                 F.lit("</Person>")).alias("payload"))
    return units.unionByName(people)


def territory_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tag(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>")), F.lit(""))

    return territories(spark, sf_dir).select("source_id", F.concat(
        F.lit("<TerritoryWithComponent>"), tag("ID", F.col("id")), tag("TYPE", F.col("type").cast("string")),
        tag("NAME", F.col("name")), tag("PARENT_ID", F.col("parent_id")),
        tag("COMPONENT_ID", F.col("component_id")), tag("FEATURE_MASK", F.col("feature_mask")),
        F.lit("</TerritoryWithComponent>")).alias("payload"))


def json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record per event; value is null when k < 10."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("pos"),
        F.to_json(F.named_struct(
            F.lit("k"), k, F.lit("type"), F.col("event_type"),
            F.lit("value"), F.when(k >= 10, F.col("value")),
            F.lit("tags"), F.array("event_type"),
            F.lit("meta"), F.named_struct(F.lit("user"), F.col("user_id"))),
            {"ignoreNullFields": "false"}).alias("text"))


def nested_json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with lists one to six deep, empty lists, objects in lists, and integers beyond 64 bits."""
    user = F.col("user_id").cast("string")
    deep = [F.concat(F.lit(f'"n{d}":' + "[" * d), user, F.lit("]" * d + ",")) for d in range(1, 7)]
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), F.concat(
        F.lit("{"), *deep, F.lit('"none":[[]],"objects":[[{"user":'), user, F.lit('}]],"large":1000000000000'), F.lpad(user, 8, "0"),
        F.lit("}")).alias("text"))


def vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("vacancy_id"),
        F.when(cust % 97 != 0, F.concat(F.lit("rec-"), (cust % 97).cast("string"))).alias("recruiter"),
        F.when(F.col("o_orderstatus") == "O", F.lit("open")).when(F.col("o_orderstatus") == "F", F.lit("closed"))
        .otherwise(F.lit("pause")).alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("opened_at"))


def subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("sub_id"),
        F.when(F.col("l_partkey") % 50 != 0, F.col("l_orderkey")).alias("parent_id"),
        F.col("l_shipdate").cast("timestamp").alias("last_activity"),
        (F.col("l_linestatus") == "O").alias("published"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("candidate_id"), (F.col("s_suppkey") % 9 == 0).alias("form_filled"),
        (F.col("s_acctbal") >= 0).alias("consent"))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("candidate_id"), F.col("l_orderkey").alias("vacancy_id"),
        F.when(flag == "R", F.lit("accepted")).when(flag == "A", F.lit("unassigned"))
        .otherwise(F.lit("in_progress")).alias("stage"),
        F.col("l_shipdate").cast("timestamp").alias("moved_at"))


def quality_as_of(spark: SparkSession, sf_dir: str) -> Column:
    newest = table(spark, sf_dir, "lineitem").select(F.max("l_shipdate").cast("timestamp"))
    return newest.scalar()


# Planned shift patterns, local wall clock minutes (pattern, shift number, start, end);
# an end at or before the start ends on the next day.
SHIFT_PATTERNS = [
    ("day", 1, 540, 1080),
    ("night", 1, 1320, 360),
    ("split", 1, 420, 660),
    ("split", 2, 900, 1140),
]
ABSENCE_DAYS = 3


def shift_patterns(spark: SparkSession) -> DataFrame:
    return config_table(spark, SHIFT_PATTERNS, "pattern string, shift_no int, start_minute int, end_minute int")


def shift_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every person's pattern by rule: day, night, split or none (no planned shift)."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.expr(SITE.format("c_custkey")), guid("9000", key).alias("person_id"),
        F.when(key % 4 == 0, "day").when(key % 4 == 1, "night").when(key % 4 == 2, "split").alias("pattern"))


def stage_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves of applications (vacancy, candidate) between hiring stages, by rule: skips, repeats, returns,
    moves out of time order and an unknown stage ('withdrawn') occur."""
    from swipeflow.operators.hiring import STAGES
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    step = (line - 1 + F.when(part % 7 == 0, 2).otherwise(0)) % len(STAGES)
    stage = F.when(part % 11 == 0, F.lit("withdrawn")).otherwise(F.element_at(F.array(*[F.lit(s) for s in STAGES]), (step + 1).cast("int")))
    moved = F.timestamp_seconds(F.unix_timestamp(F.col("l_shipdate").cast("timestamp")) + (F.col("l_suppkey") % 24) * 3600)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("vacancy_id"), (part % 3).alias("candidate_id"), stage.alias("stage"), moved.alias("moved_at"))


def order_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a loaded source: source_id, period_start (month), key and value in cents."""
    return table(spark, sf_dir, "orders").select(
        source(F.col("o_custkey")).alias("source_id"),
        F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).alias("period_start"),
        F.col("o_orderkey").alias("key"), F.round(F.col("o_totalprice") * 100).cast("long").alias("value"))


def ledger_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transitions by rule: every period runs, then ends done or (orders % 4 = 0) error; periods whose count
    divides by five were never loaded; where it divides by three, orders with key % 13 = 0 came after the load."""
    rows = order_periods(spark, sf_dir)
    n = F.count("*").over(Window.partitionBy("source_id", "period_start"))
    loaded = rows.withColumn("n", n).filter(F.col("n") % 5 != 0).filter((F.col("n") % 3 != 0) | (F.col("key") % 13 != 0))
    seen = loaded.groupBy("source_id", "period_start", "n").agg(
        F.count("*").cast("long").alias("rows"), F.sum("key").cast("long").alias("key_sum"), F.sum("value").cast("long").alias("value_sum"))
    ended = F.when(F.col("n") % 4 == 0, F.lit("error")).otherwise(F.lit("done"))
    start = seen.select("source_id", "period_start", F.lit("running").alias("status"),
                        (F.col("period_start") + F.expr("INTERVAL 33 DAYS")).alias("at"),
                        *[F.lit(None).cast("long").alias(c) for c in ("rows", "key_sum", "value_sum")])
    end = seen.select("source_id", "period_start", ended.alias("status"), (F.col("period_start") + F.expr("INTERVAL 34 DAYS")).alias("at"),
                      *[F.when(ended == "done", F.col(c)).alias(c) for c in ("rows", "key_sum", "value_sum")])
    return start.unionByName(end)
