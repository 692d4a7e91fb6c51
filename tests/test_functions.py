from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from swipeflow.functions import times, values, variants

G1 = "11111111-1111-1111-1111-111111111111"
G2 = "22222222-2222-2222-2222-222222222222"


def apply(spark, fn, inputs, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {ddl}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_parse_device_time(spark):
    got = apply(spark, times.parse_device_time, [
        "1.3.2026 6:01:39", "2026-03-01T06:01:39Z", " 2026-03-01T06:01:39 ", "30.02.2026 1:01:01", "junk", "", None])
    at = dt.datetime(2026, 3, 1, 3, 1, 39)
    assert got == [at, at, at, None, None, None, None]


def test_parse_iso_utc(spark):
    got = apply(spark, times.parse_iso_utc, ["2026-03-01T06:01:39Z", "2026-03-01T06:01:39.5", "2026", "1.3.2026", None])
    assert got == [dt.datetime(2026, 3, 1, 6, 1, 39), dt.datetime(2026, 3, 1, 6, 1, 39, 500000), None, None, None]


def test_op_date(spark):
    got = apply(spark, times.op_date, [dt.datetime(2026, 3, 2, 2, 59, 59), dt.datetime(2026, 3, 2, 3, 0)], "timestamp")
    assert got == [dt.date(2026, 3, 1), dt.date(2026, 3, 2)]


def test_day_arithmetic_before_and_after_1970(spark):
    day = 86_400_000_000
    floor = apply(spark, lambda c: times.day_floor_us(c, 3, 0), [0, -1, -3 * 3_600_000_000 - 1], "long")
    assert floor == [-3 * 3_600_000_000, -3 * 3_600_000_000, -3 * 3_600_000_000 - day]
    back = apply(spark, lambda c: times.day_start_us(times.day_of_us(c, 3, 6), 3, 6), [5 * day, 0], "long")
    assert back == [5 * day - 21 * 3_600_000_000 , -21 * 3_600_000_000]


def test_weekday_label(spark):
    assert apply(spark, times.weekday_label, [0, 6, 7, -1, None], "int") == ["Пн", "Вс", None, None, None]
    assert apply(spark, lambda c: times.weekday_label(c, "?"), [7], "int") == ["?"]


def test_to_uuid(spark):
    texts = [f" {G1} ", values.ZERO_ID, G1[:-1], G1.replace("-", "x"), "", None]
    assert apply(spark, values.to_uuid, texts) == [G1, None, None, None, None, None]
    assert apply(spark, lambda c: values.to_uuid(c, False), texts)[1] == values.ZERO_ID


def test_to_int(spark):
    assert apply(spark, values.to_int, [" 42 ", "4.2", "x", "", None]) == [42, None, None, None, None]


def test_first_territory(spark):
    got = apply(spark, values.first_territory_id, [
        f"{G1},{G2}", f"{G1} {G2}", f"{G1};{G2}", f" , {G2}", f"{G1}; {G2}", ";", G1, None])
    # With a blank present the blank splits first, which leaves the semicolon on the id.
    assert got == [G1, G1, G1, G2, None, None, G1, None]


def test_clean_text(spark):
    assert apply(spark, values.clean_text, [" a ", "None", "nan ", "", None]) == ["a", None, None, "", None]


def test_feature_mask(spark):
    got = apply(spark, values.decode_feature_mask, ["1", "130", "9223372036854775938", "256", "0", "", "x", None, "007"])
    assert got == ["Дверь", "2 считывателя, Турникет", "2 считывателя, Турникет, Нет лицензии", "256", "0", "", "x",
                   "", "Дверь, 2 считывателя, APB"]


def test_feature_mask_of_any_size(spark):
    texts = [str(2**64 + 1), "1" + "0" * 49, "-1", "+5", "-0", "+256", str(2**70 + 2), "-256", "\t3\n"]
    got = apply(spark, values.decode_feature_mask, texts)

    def expected(text):
        number = int(text)
        names = [name for bit, name in values.FEATURE_BITS.items() if number >> bit & 1]
        return ", ".join(names) or str(number)

    assert got == [expected(t) for t in texts]


def test_white_space_of_any_kind(spark):
    assert apply(spark, values.to_uuid, [f"\n\t{G1}\xa0\r\n"]) == [G1]
    assert apply(spark, values.to_int, ["\t42\n", "\u20037"]) == [42, 7]
    assert apply(spark, values.clean_text, ["\r\n a b\t"]) == ["a b"]
    assert apply(spark, times.parse_device_time, ["\n1.3.2026 6:01:39\t"]) == [dt.datetime(2026, 3, 1, 3, 1, 39)]


def test_iso_times_with_offsets_and_fine_fractions(spark):
    at = dt.datetime(2026, 3, 1, 6, 1, 39)
    got = apply(spark, times.parse_iso_utc, [
        "2026-03-01T06:01:39+03:00", "2026-03-01T06:01:39.1234567", "2026-03-01T06:01:39.123456789Z", "2026-03-01 06:01-0500",
        "2026-03-01", "2026-03-0199", "2026-03-01T06:01:39.12x"])
    assert got == [at, at.replace(microsecond=123456), at.replace(microsecond=123456), at.replace(second=0),
                   dt.datetime(2026, 3, 1), None, None]


def test_territory_type(spark):
    assert apply(spark, values.territory_type_name, [0, 2, 9, None], "int") == ["Папка", "Участок", "9", None]


def test_direction(spark):
    codes = [590144, 590152, 590145, 590153, 590146, 590244, 590245, 1, None]
    assert apply(spark, values.direction, codes, "int") == ["entry"] * 2 + ["exit"] * 5 + ["other"] * 2
    assert apply(spark, values.is_entry, codes, "int") == [True] * 2 + [False] * 5 + [None] * 2


def test_names(spark):
    df = spark.createDataFrame([("A", None, "C", "77"), (None, None, None, "77")], "l string, f string, m string, c string")
    rows = df.select(
        values.full_name(F.col("l"), F.col("f"), F.col("m")).alias("full"),
        values.short_name(F.col("l"), F.col("f"), F.col("m")).alias("short"),
        values.name_or_card(F.col("l"), F.col("c")).alias("shown")).collect()
    assert [tuple(r) for r in rows] == [("A  C", "A C", "A"), ("  ", "", "карта:77")]


def test_display_time(spark):
    assert apply(spark, times.display_time, ["2026-03-01T06:01:39.123Z", "", None]) == ["2026-03-01 06:01:39", "—", "—"]


@pytest.mark.parametrize("text,label", [
    ("null", "null"), ("true", "bool"), ("1", "int"), ("1.5", "float"), ('"a"', "str"), ("[]", "list[]"),
    ("[1, 2]", "list[int]"), ("[[true]]", "list[list[bool]]"), ('{"b": 1, "a": 2}', "dict{a, b}"),
    ('[{"k": null}]', "list[dict{k}]"), ("[null]", "list[null]"), ("[[[1]]]", "list[list[list[int]]]"),
    ("[[[[[[1.5]]]]]]", "list[" * 6 + "float" + "]" * 6), ("[[[]]]", "list[list[list[]]]"), ("[[], 1]", "list[list[]]"),
    ('[[[{"a": [1]}]]]', "list[list[list[dict{a}]]]"), ("12345678901234567890", "int"), ("[-12345678901234567890]", "list[int]"),
    ('"[["', "str"), ("1e30", "float"), ("{}", "dict{}"),
])
def test_json_type_label(spark, text, label):
    got = apply(spark, lambda c: variants.json_type_label(F.parse_json(c)), [text])
    assert got == [label]
