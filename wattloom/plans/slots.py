"""One model per site and time of day: 96 quarter hours of a day and the first four of the next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.operators import aggregates as agg
from wattloom.operators import assembly, filters, linear, ordered
from wattloom.session import stored

# Fixed values.
LAGS = 10
NEXT_DAY_SLOTS = ["00:15:00", "00:30:00", "00:45:00", "01:00:00"]
TARGET = "ConsumerPower1"
KEY = ["ClientId"]
SLOT_KEY = ["ClientId", "slot"]


def load_series(energy: DataFrame) -> DataFrame:
    """Mean load power within the power band, per bin that has readings."""
    return agg.binned(
        filters.power_band(energy, "PowerFromLoad"), KEY, "TimeStampMeasured", {TARGET: F.avg("PowerFromLoad")}
    )


def supervised(series: DataFrame) -> tuple[DataFrame, list[str]]:
    """Lags within the slot, that is the same time on earlier days, and calendar columns."""
    bin_ = F.col("bin")
    slotted = series.withColumns(
        {
            "slot": cal.slot(bin_),
            "Month": F.month(bin_),
            "DayOfWeek": cal.weekday_from_1(bin_),
            "IsWeekend": cal.weekend(bin_),
            "Season": cal.season(F.month(bin_)),
        }
    )
    inputs = [*[f"lag_{k}" for k in range(1, LAGS + 1)], "Month", "DayOfWeek", "IsWeekend", "Season"]
    return ordered.lag_features(slotted, SLOT_KEY, ["bin"], TARGET, LAGS), inputs


def forecast(series: DataFrame) -> DataFrame:
    """``(ClientId, Time, Predicted)``, 100 rows per site; 0 where a slot has too little history.

    Every slot reads its own model by label.
    """
    series = stored(series, "slot-series")
    table, inputs = supervised(series)
    models = linear.fit_ridge(table, SLOT_KEY, inputs, [TARGET], ridge=10.0, min_rows=filters.MIN_HISTORY["slot_model"])
    day = series.groupBy(*KEY).agg((F.to_date(F.max("bin")) + 1).alias("Date"))
    # the newest value becomes lag 1 of the day to come, and every lag moves up one
    newest = ordered.sequence_tail(table, SLOT_KEY, [F.desc("bin")], 1).join(day, KEY)
    start = F.col("Date").cast("timestamp_ntz")
    upcoming = newest.select(
        *SLOT_KEY,
        F.col(TARGET).alias("lag_1"),
        *[F.col(f"lag_{k}").alias(f"lag_{k + 1}") for k in range(1, LAGS)],
        F.month(start).alias("Month"),
        cal.weekday_from_1(start).alias("DayOfWeek"),
        cal.weekend(start).alias("IsWeekend"),
        cal.season(F.month(start)).alias("Season"),
    )
    scored = linear.predict(upcoming, models, SLOT_KEY, inputs).select(
        *SLOT_KEY, F.element_at("predictions", 1).alias("Predicted")
    )
    complete = assembly.default_zero_slots(scored, day, KEY, agg.day_slots(), "Predicted").join(day, KEY)
    repeated = F.when(F.col("slot").isin(NEXT_DAY_SLOTS), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    at = F.concat_ws(" ", F.date_add("Date", F.col("_day")).cast("string"), "slot")
    return complete.withColumn("_day", F.explode(repeated)).select(*KEY, at.cast("timestamp_ntz").alias("Time"), "Predicted")
