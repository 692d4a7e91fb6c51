"""Identifiers, codes and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swipeflow.rules import ENTRY_CODES, EXIT_CODES

# Fixed value: what counts as white space around a value.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the id that stands for "none".
ZERO_ID = "00000000-0000-0000-0000-000000000000"

# Territory types.
TERRITORY_TYPES = {"0": "Папка", "1": "Дверь", "2": "Участок", "3": "Другое"}

# Feature-mask bits.
FEATURE_BITS = {
    0: "Дверь",
    1: "2 считывателя",
    2: "APB",
    3: "Сложные расписания",
    4: "Настольный считыватель",
    5: "Охранная зона",
    6: "Источник видео",
    7: "Турникет",
    9: "Расписания не поддерж.",
    10: "Программный контроллер",
    12: "Без ограничений лицензии",
    13: "Лифтовой контроллер",
    62: "Отключён оператором",
    63: "Нет лицензии",
}


def trimmed(text: Column) -> Column:
    """Text without white space of any kind at either end."""
    return F.trim(text, F.lit(WHITE_SPACE))


def direction(code: Column, other: str | None = "other") -> Column:
    """entry / exit / ``other`` of a transaction code."""
    return (
        F.when(code.isin(*ENTRY_CODES), F.lit("entry"))
        .when(code.isin(*EXIT_CODES), F.lit("exit"))
        .otherwise(F.lit(other))
    )


def is_entry(code: Column) -> Column:
    """True for entry codes, False for exit codes, else NULL."""
    return F.when(code.isin(*ENTRY_CODES), F.lit(True)).when(code.isin(*EXIT_CODES), F.lit(False))


def to_uuid(text: Column, zero_is_null: bool = True) -> Column:
    """Trimmed id when it has 36 characters and 4 hyphens, else NULL."""
    value = trimmed(text)
    valid = (F.length(value) == 36) & (F.length(value) - F.length(F.replace(value, F.lit("-"))) == 4)
    if zero_is_null:
        valid = valid & (value != F.lit(ZERO_ID))
    return F.when(valid, value)


def to_int(text: Column, kind: str = "int") -> Column:
    """Whole number, or NULL when the text is none."""
    return trimmed(text).try_cast(kind)


def first_territory_id(text: Column) -> Column:
    """First id of a list whose separator is the first kind present of comma, blank, semicolon."""
    raw = trimmed(text)

    def head(sep: str) -> Column:
        parts = F.transform(F.split(raw, sep), lambda p: trimmed(p))
        return F.try_element_at(F.filter(parts, lambda p: p != ""), F.lit(1))

    first = (
        F.when(F.contains(raw, F.lit(",")), head(","))
        .when(F.contains(raw, F.lit(" ")), head(" "))
        .when(F.contains(raw, F.lit(";")), head(";"))
        .otherwise(raw)
    )
    return to_uuid(first, zero_is_null=False)


def clean_text(text: Column) -> Column:
    """Trimmed text; the literals None and nan become NULL."""
    value = trimmed(text)
    return F.when(~value.isin("None", "nan"), value)


def full_name(last: Column, first: Column, middle: Column) -> Column:
    """Three name parts and two blanks; missing parts keep their blanks."""
    blank = F.lit("")
    return F.concat(
        F.coalesce(last, blank), F.lit(" "), F.coalesce(first, blank), F.lit(" "), F.coalesce(middle, blank)
    )


def short_name(last: Column, first: Column, middle: Column) -> Column:
    """The name parts that are not empty, joined by single blanks."""
    parts = [F.nullif(p, F.lit("")) for p in (last, first, middle)]
    return F.concat_ws(" ", *parts)


def name_or_card(name: Column, card: Column) -> Column:
    """Name, or the card code when there is no name."""
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(F.lit("карта:"), F.coalesce(card, F.lit(""))))


def person_key(canonical: Column, person: Column) -> Column:
    return F.coalesce(canonical, person)


def territory_type_name(code: Column) -> Column:
    """Label of a territory type code; unknown codes stay as they are."""
    text = code.cast("string")
    label = F.lit(None).cast("string")
    for key, name in TERRITORY_TYPES.items():
        label = F.when(text == key, F.lit(name)).otherwise(label)
    return F.coalesce(label, text)


def decode_feature_mask(mask: Column) -> Column:
    """Names of the known bits of a mask in decimal text of any length; a negative one has its two's complement.

    No known bit: the number itself; empty: ''; not a number: unchanged.
    """
    number = trimmed(mask)
    negative = number.startswith("-")
    digits = F.regexp_replace(number, "^[+-]", "")
    size = F.lit(str(2**64)).cast("decimal(38,0)")
    low = F.aggregate(
        F.split(digits, ""), F.lit(0).cast("decimal(38,0)"),
        lambda total, d: F.pmod(total * 10 + F.coalesce(d.try_cast("int"), F.lit(0)), size).cast("decimal(38,0)"))
    low = F.when(negative, F.pmod(size - low, size)).otherwise(low)
    bits = F.lpad(F.conv(low.cast("decimal(20,0)").cast("string"), 10, 2), 64, "0")
    names = F.concat_ws(
        ", ",
        *[F.when(F.substring(bits, 64 - bit, 1) == "1", F.lit(name)) for bit, name in FEATURE_BITS.items()],
    )
    bare = F.regexp_replace(digits, "^0+(?=[0-9])", "")
    plain = F.when(negative & (bare != "0"), F.concat(F.lit("-"), bare)).otherwise(bare)
    return (
        F.when(mask.isNull() | (mask == ""), F.lit(""))
        .when(~number.rlike(r"^[+-]?\d+$"), mask)
        .otherwise(F.coalesce(F.nullif(names, F.lit("")), plain))
    )
