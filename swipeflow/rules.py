"""Rule parameters and fixed domain values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Transaction codes.
ENTRY_CODES = (590144, 590152)
EXIT_CODES = (590145, 590153, 590146, 590244, 590245)

# Session comments and confidence levels.
LABEL_OPEN_END = "проставлено до конца дня"
LABEL_OPEN_START = "проставлено от начала дня"
LABEL_HIDDEN_EXIT = "скрытый выход"
HIGH = "HIGH"
LOW = "LOW"

# Weekday labels, Monday first.
WEEKDAYS = ("Пн", "Вт", "Ср", "Чт", "Пт", "Сб", "Вс")

US_PER_SECOND = 1_000_000
US_PER_MINUTE = 60 * US_PER_SECOND
US_PER_HOUR = 60 * US_PER_MINUTE
US_PER_DAY = 24 * US_PER_HOUR


@dataclass(frozen=True)
class Rules:
    """One parameter set for the whole presence pipeline.

    The defaults are the current rules; ``Rules.unbounded()`` is the older rule
    set and ``Rules.same_day()`` the rules of the prose method summary.

    pairing   how far an entry looks for its exit: "bounded" (within
              ``max_hours``), "unbounded" or "same_day"
    close     how an entry without exit ends: "timeout" (after ``max_hours``)
              or "day_end" (last second of its day)
    orphan    when an exit has no entry: "window" (none in the ``max_hours``
              before it), "day" (none earlier that day) or "unpaired_day"
              (none earlier that day, and no earlier entry ends with it)
    hidden_exit  a second entry before any exit closes the first one
    slice_days   cut sessions at day borders and count each day's part
    """

    day_start_hour: int = 0
    dup_minutes: int | None = 5
    max_hours: int = 16
    tz_hours: int = 3
    pairing: str = "bounded"
    close: str = "timeout"
    orphan: str = "window"
    hidden_exit: bool = True
    slice_days: bool = True
    period: tuple[dt.date, dt.date] | None = None

    def __post_init__(self) -> None:
        for name, allowed in (
            ("pairing", ("bounded", "unbounded", "same_day")),
            ("close", ("timeout", "day_end")),
            ("orphan", ("window", "day", "unpaired_day")),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")

    @classmethod
    def unbounded(cls, **changes) -> Rules:
        base = dict(
            day_start_hour=6, dup_minutes=None, pairing="unbounded", close="day_end",
            orphan="unpaired_day", hidden_exit=False, slice_days=False,
        )
        return cls(**(base | changes))

    @classmethod
    def same_day(cls, **changes) -> Rules:
        base = dict(
            dup_minutes=None, pairing="same_day", close="day_end",
            orphan="day", hidden_exit=False, slice_days=False,
        )
        return cls(**(base | changes))

    @property
    def dup_us(self) -> int:
        return (self.dup_minutes or 0) * US_PER_MINUTE

    @property
    def max_us(self) -> int:
        return self.max_hours * US_PER_HOUR

    @property
    def tz_us(self) -> int:
        return self.tz_hours * US_PER_HOUR
