"""Encoded times and packed values to Spark values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
SECONDS = {"seconds": 1, "minutes": 60, "hours": 3600, "days": 86400}
STANDARD = ("standard", "gregorian", "proleptic_gregorian")
NOLEAP = ("noleap", "365_day")
ALL_LEAP = ("all_leap", "366_day")
DAYS_360 = ("360_day",)

_UNITS = re.compile(r"^\s*(\w+?)s?\s+since\s+(\d+)-(\d+)-(\d+)(?:[ T](\d+):(\d+)(?::(\d+))?)?")


def parse_units(units: str) -> tuple[int, tuple[int, int, int], int]:
    """'hours since 1900-01-01 06:00' -> seconds per unit, base date, base second of day."""
    found = _UNITS.match(units)
    if not found or f"{found.group(1)}s" not in SECONDS:
        raise ValueError(f"time units not understood: {units!r}")
    year, month, day = (int(found.group(i)) for i in (2, 3, 4))
    hour, minute, second = (int(found.group(i) or 0) for i in (5, 6, 7))
    return SECONDS[f"{found.group(1)}s"], (year, month, day), hour * 3600 + minute * 60 + second


def _days_and_seconds(offset: Column, per_unit: int, base_second: int) -> tuple[Column, Column]:
    seconds = F.floor(offset.cast("double") * F.lit(float(per_unit)) + F.lit(base_second + 0.5))
    day = F.floor(seconds / F.lit(86400.0))
    return day, seconds - day * F.lit(86400).cast("long")


def decode_time_parts(offset: Column, units: str, calendar: str = "standard") -> dict[str, Column]:
    """Date parts (year, month, day, second of day) of an encoded time.

    The parts work for every calendar; a noleap day always exists as parts.
    """
    per_unit, base, base_second = parse_units(units)
    day, second = _days_and_seconds(offset, per_unit, base_second)
    start = F.make_date(F.lit(base[0]), F.lit(base[1]), F.lit(base[2]))
    if calendar in STANDARD:
        date = F.date_add(start, day.cast("int"))
        year = F.year(date)
    elif calendar in NOLEAP:
        # every noleap year looks like 2001, so days are counted in that template year
        template = F.make_date(F.lit(2001), F.lit(1), F.lit(1))
        base_day = F.dayofyear(F.make_date(F.lit(2001), F.lit(base[1]), F.lit(base[2]))) - F.lit(1)
        total = day + base_day
        years = F.floor(total / F.lit(365.0))
        date = F.date_add(template, (total - years * F.lit(365).cast("long")).cast("int"))
        year = (F.lit(base[0]) + years).cast("int")
    elif calendar in ALL_LEAP:
        # every year looks like 2000
        template = F.make_date(F.lit(2000), F.lit(1), F.lit(1))
        base_day = F.dayofyear(F.make_date(F.lit(2000), F.lit(base[1]), F.lit(base[2]))) - F.lit(1)
        total = day + base_day
        years = F.floor(total / F.lit(366.0))
        date = F.date_add(template, (total - years * F.lit(366).cast("long")).cast("int"))
        year = (F.lit(base[0]) + years).cast("int")
    elif calendar in DAYS_360:
        total = day + F.lit((base[1] - 1) * 30 + base[2] - 1)
        years = F.floor(total / F.lit(360.0))
        rest = total - years * F.lit(360).cast("long")
        return {
            "year": (F.lit(base[0]) + years).cast("int"),
            "month": (F.floor(rest / F.lit(30.0)) + 1).cast("int"),
            "day": (rest % F.lit(30) + 1).cast("int"),
            "second_of_day": second.cast("int"),
        }
    else:
        raise ValueError(f"calendar not supported: {calendar}")
    return {
        "year": year.cast("int"),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "second_of_day": second.cast("int"),
    }


def decode_time(offset: Column, units: str, calendar: str = "standard") -> Column:
    """Encoded time to timestamp without zone; NULL for a day that the standard calendar lacks (30
    February, 29 February of most years). Every noleap day is also a standard day."""
    parts = decode_time_parts(offset, units, calendar)
    second = parts["second_of_day"]
    return F.try_make_timestamp_ntz(
        parts["year"], parts["month"], parts["day"],
        F.floor(second / F.lit(3600.0)).cast("int"),
        (F.floor(second / F.lit(60.0)) % F.lit(60)).cast("int"),
        second % F.lit(60),
    )


def decode_packed(
    packed: Column, scale: float = 1.0, offset: float = 0.0, fill: float | None = None
) -> Column:
    """Packed number to value; the fill number becomes NULL."""
    value = packed.cast("double") * F.lit(float(scale)) + F.lit(float(offset))
    return value if fill is None else F.when(packed != F.lit(fill), value)
