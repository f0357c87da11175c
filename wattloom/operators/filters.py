"""Row filters and guards."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.functions import values as val
from wattloom.session import stored

# Fixed values.
POWER_LOW = 3000
POWER_HIGH = 150000
MIN_HISTORY = {"daily_load": 288, "slot_model": 10, "day_profile": 96, "next_day": 4}


def at(df: DataFrame, column: str, instant: datetime | str) -> Column:
    """A literal of the column's own type, so that the comparison reaches the scan."""
    return F.lit(instant).cast(df.schema[column].dataType)


def half_open_range(df: DataFrame, ts: str, start: datetime | str, end: datetime | str) -> DataFrame:
    """After the start, up to and including the end."""
    return df.where((F.col(ts) > at(df, ts, start)) & (F.col(ts) <= at(df, ts, end)))


def power_band(df: DataFrame, power: str, low: float = POWER_LOW, high: float = POWER_HIGH) -> DataFrame:
    """Low bound kept, high bound and nulls dropped."""
    return df.where((F.col(power) >= low) & (F.col(power) < high))


def after_cutoff(df: DataFrame, ts: str, cutoff: datetime | str, columns: Sequence[str]) -> DataFrame:
    return df.where(F.col(ts) > at(df, ts, cutoff)).select(*columns)


def spike_to_null(df: DataFrame, value: str, limit: float = val.SPIKE_LIMIT) -> DataFrame:
    """Values above the limit become null; the row stays."""
    return df.withColumn(value, val.spike_to_null(F.col(value), limit))


def drop_bad_timestamps(df: DataFrame, text: str, ts: str, fmt: str | None = None) -> DataFrame:
    """Parse a text column and drop rows that do not parse."""
    return df.withColumn(ts, cal.parse_utc(F.col(text), fmt)).dropna(subset=[ts])


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def before_first(df: DataFrame, ts: str, keys: list[str], later: DataFrame, later_ts: str) -> DataFrame:
    """History strictly before the first instant of another frame, per key. Keys absent there are dropped."""
    starts = stored(later.groupBy(*keys).agg(F.min(later_ts).alias("_start")), "starts")
    return df.join(starts, keys).where(F.col(ts) < F.col("_start")).drop("_start")


def days_before(now: datetime | str, days: int = 7, zone: str = cal.LOCAL_ZONE) -> Column:
    """The UTC instant of the local midnight ``days`` days before the one that began the current local day."""
    local_now = cal.to_local(F.lit(now).cast("timestamp_ntz"), zone)
    midnight = cal.truncate(local_now, "DAY") - F.expr(f"INTERVAL {days} DAYS")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), midnight)


def recent_days(df: DataFrame, ts: str, now: datetime | str, days: int = 7, zone: str = cal.LOCAL_ZONE) -> DataFrame:
    return df.where(F.col(ts) >= days_before(now, days, zone).cast(df.schema[ts].dataType))


def time_slot(df: DataFrame, ts: str, slots: Sequence[str]) -> DataFrame:
    """Rows whose clock label is one of ``slots``."""
    return df.where(cal.slot(F.col(ts)).isin(list(slots)))


def asof_last_row(df: DataFrame, keys: list[str], ts: str, now: datetime | str) -> DataFrame:
    """The latest row of every key not after ``now``.

    All columns come from one row. Of several rows at that instant the one with the greatest values counts, column by
    column in their order. The aggregate is combined before the shuffle.
    """
    rest = [c for c in df.columns if c not in (*keys, ts)]
    last = df.where(F.col(ts) <= at(df, ts, now)).groupBy(*keys).agg(F.max(F.struct(ts, *rest)).alias("_row"))
    return last.select(*keys, "_row.*").select(*df.columns)


def min_history_guard(df: DataFrame, keys: list[str], needed: int, value: str | None = None) -> DataFrame:
    """One row per key with its usable rows and whether they suffice; nothing is raised.

    With ``value``, rows where it is null, NaN or infinite do not count.
    """
    usable = F.count(F.lit(1)) if value is None else F.count_if(F.abs(F.col(value).cast("double")) < float("inf"))
    return df.groupBy(*keys).agg(usable.alias("rows")).withColumn("enough", F.col("rows") >= needed)


def with_min_history(df: DataFrame, keys: list[str], needed: int) -> DataFrame:
    """Only keys with enough rows. For series, whose keys are bounded by the time grid."""
    count = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("_rows", count).where(F.col("_rows") >= needed).drop("_rows")
