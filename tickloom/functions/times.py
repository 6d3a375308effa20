"""Time, session-label and trading-day expressions.

Tick times are ``timestamp_ntz``; with the session zone at UTC the casts below
only reinterpret the microsecond count.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

# A session label from the hour of the time less 3 h 20 min.
SHIFT = 200 * MINUTE
HOURS = {"fam": (4, 6), "bam": (7, 8), "pm": (9, 14), "night": (15, 24)}

# A session label from the clock, both ends included; the night
# runs over midnight.
CLOCK = {
    "fam": ("09:00", "10:15"),
    "bam": ("10:30", "11:30"),
    "pm": ("13:00", "15:01"),
    "night": ("21:00", "03:00"),
}

# Tradable spans of the time less 3 h, both ends excluded.
TRADABLE = (("06:03:00", "08:28:00"), ("10:33:00", "11:58:00"), ("18:03:00", "23:28:00"))

UNKNOWN = "unknow"
DAY_SESSIONS = ("fam", "bam", "pm")


def micros(t: Column) -> Column:
    return F.unix_micros(t.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def bin_start(us: Column, width: int) -> Column:
    """First microsecond of the left-closed bin that holds ``us``."""
    return us - F.pmod(us, F.lit(width))


def shifted(t: Column, us: int) -> Column:
    return from_micros(micros(t) + F.lit(us))


def _clock_units(text: str, unit: int) -> int:
    parts = [int(p) for p in text.split(":")] + [0, 0]
    return ((parts[0] * 60 + parts[1]) * 60 + parts[2]) * SECOND // unit


def _labelled(rules: dict[str, Column]) -> Column:
    label = F.lit(UNKNOWN)
    for name, rule in rules.items():
        label = F.when(rule, F.lit(name)).otherwise(label)
    return label


def session_by_hour(t: Column) -> Column:
    hour = F.hour(shifted(t, -SHIFT))
    return _labelled({name: hour.between(lo, hi) for name, (lo, hi) in HOURS.items()})


def session_by_clock(t: Column) -> Column:
    at = F.pmod(micros(t), F.lit(DAY))
    rules = {}
    for name, (start, end) in CLOCK.items():
        lo, hi = _clock_units(start, 1), _clock_units(end, 1)
        rules[name] = at.between(lo, hi) if lo <= hi else (at >= lo) | (at <= hi)
    return _labelled(rules)


def tradable(t: Column) -> Column:
    """True strictly inside a tradable span; parts of a second are cut off."""
    second = F.floor(F.pmod(micros(t) - F.lit(3 * HOUR), F.lit(DAY)) / F.lit(SECOND))
    hit = F.lit(False)
    for start, end in TRADABLE:
        hit = hit | (
            (second > _clock_units(start, SECOND)) & (second < _clock_units(end, SECOND))
        )
    return hit


def split_day(t: Column) -> Column:
    """Trading day of a session slice: a night belongs to the day it starts on."""
    return F.date_format(shifted(t, -SHIFT), "yyyyMMdd")


def bar_time(t: Column) -> Column:
    """Time a bar is cut by: a night belongs to the day that follows."""
    return shifted(t, 6 * HOUR)


def calendar_day(t: Column) -> Column:
    return F.date_format(t, "yyyyMMdd")


def sub_second(t: Column) -> Column:
    return F.pmod(micros(t), F.lit(SECOND))


def half_second(t: Column) -> Column:
    """Any part of a second becomes half a second. Files that hold only whole
    and half seconds come out unchanged, so no test per file is needed."""
    us = micros(t)
    part = F.pmod(us, F.lit(SECOND))
    return from_micros(us - part + F.when(part != 0, SECOND // 2).otherwise(0))


def span_seconds(start: Column, end: Column) -> Column:
    return F.floor((micros(end) - micros(start)) / F.lit(SECOND)).cast("long")
