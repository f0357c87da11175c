"""Calendar and clock expressions on naive UTC (``timestamp_ntz``) columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
LOCAL_ZONE = "Europe/Ljubljana"
HOURS_PER_DAY = 24
DAYS_PER_MONTH = 30
STEP_MINUTES = 15
FORMATS = {
    "minute_key": "yyyy-MM-dd;HH:mm:ss",
    "second": "yyyy-MM-dd HH:mm:ss",
    "slot_number": "HHmmss",
    "slot": "HH:mm:ss",
}


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL {n} MINUTES")


def bin_start(ts: Column | str, width: int = STEP_MINUTES) -> Column:
    """Start of the left-closed, left-labelled bin; keeps the timestamp type."""
    return F.window(ts, f"{width} minutes").getField("start")


def parse_utc(text: Column, fmt: str | None = None) -> Column:
    """Parse to naive UTC; what cannot be parsed is null."""
    parsed = F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)
    return parsed.cast("timestamp_ntz")


def strip_zone(ts: Column) -> Column:
    """Drop the zone of a zoned instant, keeping its UTC clock."""
    return F.to_utc_timestamp(ts, F.current_timezone()).cast("timestamp_ntz")


def to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC clock to local clock. Two instants of the autumn hour share a local value: never use it as a key."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


_UNITS = ("DAY", "HOUR", "MINUTE", "SECOND")


def truncate(ts: Column, unit: str) -> Column:
    """Down to the unit, on the naive clock: no zone takes part, so no hour is skipped or repeated."""
    kept = _UNITS.index(unit)
    ts = ts.cast("timestamp_ntz")
    clock = [part(ts) if i < kept else F.lit(0) for i, part in enumerate((F.hour, F.minute, F.second))]
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.day(ts), *clock)


def weekday_from_0(ts: Column) -> Column:
    """0 = Monday."""
    return F.weekday(ts)


def weekday_from_1(ts: Column) -> Column:
    """1 = Monday."""
    return F.weekday(ts) + 1


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "Year": F.year(ts),
        "Month": F.month(ts),
        "Day": F.day(ts),
        "Day_of_year": F.dayofyear(ts),
        "Hour": F.hour(ts),
        "Minute": F.minute(ts),
        "Date": F.to_date(ts),
        "DayOfWeek": weekday_from_0(ts),
        "DayOfWeek1": weekday_from_1(ts),
    }


def season(month: Column) -> Column:
    """1 for December to February, then 2, 3, 4 by quarter."""
    return (F.floor(month % 12 / 3) + 1).cast("int")


def weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle."""
    angle = F.lit(2 * math.pi) * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def cyclical_hour(ts: Column) -> tuple[Column, Column]:
    return cycle(F.hour(ts), HOURS_PER_DAY)


def cyclical_day_of_month(ts: Column) -> tuple[Column, Column]:
    return cycle(F.day(ts), DAYS_PER_MONTH)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def daylight_hours(sunrise: Column, sunset: Column) -> Column:
    return seconds_between(sunrise, sunset) / F.lit(3600.0)


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def at_time_of_day(date_of: Column, clock_of: Column) -> Column:
    """The day of one instant at the whole-second clock time of another."""
    seconds = second_of_day(clock_of)
    return truncate(date_of, "DAY") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def slot(ts: Column) -> Column:
    """Clock label, the same on every day."""
    return F.format_string("%02d:%02d:%02d", F.hour(ts), F.minute(ts), F.second(ts))


def time_of_day_number(ts: Column) -> Column:
    """The digits HHMMSS read as one number."""
    return F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)


def grid(start: Column, end: Column, width: int = STEP_MINUTES) -> Column:
    """Array of equally spaced instants, both ends included."""
    return F.sequence(start, end, minutes(width))


def grid_after(start: Column, periods: int, width: int = STEP_MINUTES) -> Column:
    """The next ``periods`` instants after ``start``."""
    return F.sequence(start + minutes(width), start + minutes(width * periods), minutes(width))
