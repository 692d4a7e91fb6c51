"""Time parsing, local time and day arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swipeflow.functions.values import trimmed
from swipeflow.rules import US_PER_DAY, US_PER_HOUR, WEEKDAYS

# The text formats the access controllers send.
DEVICE_FORMATS = ("d.M.yyyy H:m:s", "yyyy-M-d'T'H:m:s'Z'", "yyyy-M-d'T'H:m:s")

# Wall time up to microseconds; finer digits, a Z or an offset may follow.
_ISO_TEXT = (
    r"^(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?)"
    r"(?:(?<=\.\d{6})\d+)?(?:Z+|[+-]\d{2}:?\d{2})?$"
)


def parse_device_time(text: Column, tz_hours: int = 3) -> Column:
    """Controller text as an instant. Every format, also the one ending in Z, is local time."""
    bare = trimmed(text)
    wall = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in DEVICE_FORMATS])
    return wall - F.expr(f"INTERVAL {tz_hours} HOURS")


def parse_iso_utc(text: Column) -> Column:
    """The wall time of ISO text as UTC, a Z or an offset ignored; anything else is NULL."""
    return F.nullif(F.regexp_extract(trimmed(text), _ISO_TEXT, 1), F.lit("")).try_cast("timestamp")


def parse_any_utc(text: Column) -> Column:
    """Any text Spark reads as a time, as UTC; anything else is NULL."""
    return trimmed(text).try_cast("timestamp")


def local_time(ts: Column, tz: int | str = 3) -> Column:
    """Wall-clock time: a fixed offset in hours, or a named zone."""
    if isinstance(tz, str):
        return F.from_utc_timestamp(ts, tz)
    return ts + F.expr(f"INTERVAL {tz} HOURS")


def op_date(ts: Column, tz_hours: int = 3, start_hour: int = 6) -> Column:
    """Operational day: local hours before ``start_hour`` belong to the day before."""
    return F.to_date(local_time(ts, tz_hours) - F.expr(f"INTERVAL {start_hour} HOURS"))


def day_floor_us(us: Column, tz_hours: int, start_hour: int) -> Column:
    """First microsecond (as an instant) of the local day that holds ``us``."""
    shift = (tz_hours - start_hour) * US_PER_HOUR
    return us - F.pmod(us + F.lit(shift), F.lit(US_PER_DAY))


def day_of_us(us: Column, tz_hours: int, start_hour: int) -> Column:
    """Date of the local day that holds ``us``."""
    shift = (tz_hours - start_hour) * US_PER_HOUR
    return F.to_date(F.timestamp_micros(us + F.lit(shift)))


def day_start_us(day: Column, tz_hours: int, start_hour: int) -> Column:
    """Instant in microseconds at which a local day begins."""
    shift = (start_hour - tz_hours) * US_PER_HOUR
    return F.unix_date(day).cast("long") * F.lit(US_PER_DAY) + F.lit(shift)


def weekday_label(number: Column, unknown: str | None = None) -> Column:
    """Label of a weekday number (0 = Monday)."""
    label = F.try_element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), number + F.lit(1))
    label = F.when(number.between(0, 6), label)
    return label if unknown is None else F.coalesce(label, F.lit(unknown))


def display_time(text: Column) -> Column:
    """Time text for a listing: 19 characters, blank for T, a dash when empty."""
    return F.coalesce(F.nullif(F.translate(F.substring(text, 1, 19), "T", " "), F.lit("")), F.lit("—"))
