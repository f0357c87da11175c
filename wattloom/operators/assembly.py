"""From model output to the published forecast rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.functions import values as val

# Fixed values.
DAY_STEPS = 96
HELD_STEPS = 4
HOUR_STEPS = 4


def future_grid(series: DataFrame, keys: list[str], ts: str, steps: int = DAY_STEPS) -> DataFrame:
    """The next ``steps`` bins after the last one of each key, numbered from 1: ``(keys, h, Timestamp)``."""
    last = series.groupBy(*keys).agg(F.max(ts).alias("_last"))
    stamps = F.posexplode(cal.grid_after(F.col("_last"), steps)).alias("_p", "Timestamp")
    return last.select(*keys, stamps).select(*keys, (F.col("_p") + 1).alias("h"), "Timestamp")


def on_future_grid(grid: DataFrame, predictions: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Attach predictions keyed by step number."""
    return grid.join(predictions.select(*keys, "h", value), [*keys, "h"])


def hold_last(forecast: DataFrame, keys: list[str], ts: str, value: str, steps: int = HELD_STEPS) -> DataFrame:
    """The forecast plus ``steps`` more bins that repeat its last value."""
    last = forecast.groupBy(*keys).agg(F.max(ts).alias("_last"), F.max_by(value, ts).alias(value))
    held = last.select(*keys, F.explode(cal.grid_after(F.col("_last"), steps)).alias(ts), value)
    return forecast.select(*keys, ts, value).unionByName(held)


def hourly_rows(predictions: DataFrame, now: Column, values: str = "predictions") -> DataFrame:
    """Rows of the one-hour forecast table from an array of predictions per site."""
    return predictions.select("ClientId", F.posexplode(values).alias("_p", "LoadPower"), now.alias("_now")).select(
        "ClientId",
        (F.col("_now") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("_p") + 1) * cal.STEP_MINUTES)).alias("Time"),
        val.to_whole(F.col("LoadPower")).alias("LoadPower"),
    )


def default_zero_slots(predictions: DataFrame, sites: DataFrame, keys: list[str], slots: list[str], value: str) -> DataFrame:
    """One row per site and slot, 0 where there is no prediction."""
    spine = sites.select(*keys).distinct().withColumn("slot", F.explode(F.array(*map(F.lit, slots))))
    return spine.join(predictions.select(*keys, "slot", value), [*keys, "slot"], "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(0.0))
    )


def shape_load_output(forecast: DataFrame, ts: str = "Timestamp", value: str = "LoadEnergyForecast_15") -> DataFrame:
    """Columns of the load forecast table; the hybrid value is 0 and the clock local.

    The UTC instant stays beside the local clock, which is ambiguous for one hour of the year.
    """
    return forecast.select(
        "ClientId",
        cal.to_local(F.col(ts)).alias("Time"),
        F.col(ts).alias("TimeUtc"),
        val.to_whole(F.col(value)).alias("LSTMLoadPower"),
        F.lit(0).cast("long").alias("HybridLoadPower"),
    )


def serving_rows(scored: DataFrame, flag: str = "is_serving") -> DataFrame:
    """Drop the context rows that only fed the lags."""
    return scored.where(F.col(flag)).drop(flag)
