"""Hourly load: the next four quarter hours of load power."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.operators import aggregates as agg
from wattloom.operators import boosting, filters, joins, linear, ordered, transforms
from wattloom.session import stored

# Fixed values.
LAGS = 24
HORIZON = 4
TREES = 500
LEARNING_RATE = 0.05
DEPTH = 6
TARGET = "ConsumerPower1"
WEATHER = ["Temperature", "Humidity"]
KEY = ["ClientId"]


def merged_series(energy: DataFrame, measurements: DataFrame, weather: list[str] = WEATHER) -> DataFrame:
    """Mean load power within the power band and mean weather per bin, over their common span."""
    load = agg.binned(
        filters.power_band(energy, "PowerFromLoad"), KEY, "TimeStampMeasured", {TARGET: F.avg("PowerFromLoad")}
    )
    sky = agg.binned(measurements, KEY, "Time", {c: F.avg(c) for c in weather})
    return joins.align_series(load, sky, KEY).where("in_left AND in_right").drop("in_left", "in_right")


def feature_names(weather: list[str] = WEATHER) -> list[str]:
    calendar = ["hour_cos", "Month", "is_weekend", "Season"]
    lags = [f"lag_{k}" for k in range(1, LAGS + 1)]
    return [*weather, *calendar, *lags, *[f"DayOfWeek_{k}" for k in range(2, 8)], "Temperature_Hour"]


def prepare(merged: DataFrame) -> DataFrame:
    """Calendar, lag, weekday and interaction columns. Incomplete rows are dropped last."""
    bin_ = F.col("bin")
    marked = merged.withColumns(
        {
            "hour_cos": cal.cyclical_hour(bin_)[1],
            "Month": F.month(bin_),
            "is_weekend": cal.weekend(bin_),
            "Season": cal.season(F.month(bin_)),
            "Temperature_Hour": F.col("Temperature") * F.hour(bin_),
        }
    )
    return ordered.lag_features(transforms.one_hot_weekday(marked, "bin", from_one=True), KEY, ["bin"], TARGET, LAGS)


def features(energy: DataFrame, measurements: DataFrame) -> DataFrame:
    return filters.drop_any_null(prepare(merged_series(energy, measurements)))


def supervised(energy: DataFrame, measurements: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Complete feature rows with ``y_1 .. y_H``.

    Targets are taken on the gap-free grid before incomplete rows go, so step h is always h quarter hours
    later; where that bin has no load it is null.
    """
    table = prepare(merged_series(energy, measurements))
    steps = {f"y_{h}": (TARGET, -h) for h in range(1, horizon + 1)}
    ahead = ordered.neighbour_columns(table, KEY, ["bin"], steps, None)
    return ahead.na.drop("any", subset=[TARGET, *feature_names()])


def long_form(table: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """One row per origin and known step ``h`` with its label."""
    names = [f"y_{h}" for h in range(1, horizon + 1)]
    rest = [c for c in table.columns if c not in names]
    steps = table.select(*rest, F.posexplode(F.array(*names)).alias("_i", "label"))
    return steps.where(F.col("label").isNotNull()).withColumn("h", F.col("_i") + 1).drop("_i")


def model_inputs() -> list[str]:
    return [TARGET, *feature_names()]


def fit(
    table: DataFrame, trees: int = TREES, depth: int = DEPTH, rate: float = LEARNING_RATE, known: DataFrame | None = None
) -> DataFrame:
    """Boosted trees, an ensemble for every site and step; sites in ``known`` keep their stored ones.

    ``table`` has ``y_1 .. y_H``. Trees do not depend on the scale of a feature, so features are not scaled.
    """
    return boosting.fit_or_reuse(
        long_form(table), [*KEY, "h"], known, inputs=model_inputs(), label="label", order=["bin"], trees=trees, rate=rate, depth=depth
    )


def score(table: DataFrame, trees: DataFrame, now: str, horizon: int = HORIZON) -> DataFrame:
    """Steps 1..H after each site's last complete row not later than ``now``, for sites with an ensemble."""
    last = filters.asof_last_row(table, KEY, "bin", now).withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    scored = boosting.predict(last, trees, [*KEY, "h"], model_inputs())
    ahead = F.make_dt_interval(F.lit(0), F.lit(0), F.col("h") * cal.STEP_MINUTES)
    return scored.select(*KEY, "h", (F.lit(now).cast("timestamp_ntz") + ahead).alias("Time"), F.col("prediction").alias("LoadPower"))


def forecast(
    energy: DataFrame, measurements: DataFrame, now: str, trees: int = TREES, depth: int = DEPTH, known: DataFrame | None = None
) -> DataFrame:
    """The whole hourly job: fit on everything known at ``now``, then score. ``known``: stored ensembles not to be fitted again."""
    until = energy.where(F.col("TimeStampMeasured") <= filters.at(energy, "TimeStampMeasured", now))
    table = stored(supervised(until, measurements), "hourly-load-features")
    return score(table, stored(fit(table, trees, depth, known=known), "hourly-load-trees"), now)


def reading_sequences(
    energy: DataFrame, ts: str | None, lags: int = LAGS, horizon: int = HORIZON, tie: tuple[str, ...] = ()
) -> tuple[DataFrame, list[str], list[str]]:
    """Supervised rows straight from readings: the last ``lags`` readings, clock features, the next four."""
    at = F.col("TimeStampMeasured")
    marked = energy.select(
        *KEY, "TimeStampMeasured", *tie, F.col("PowerFromLoad").cast("double").alias("PowerFromLoad")
    ).withColumns(
        {
            "TimeOfDay": cal.time_of_day_number(at),
            "Month": F.month(at),
            "DayOfWeek": cal.weekday_from_1(at),
            "IsWeekend": cal.weekend(at),
            "Season": cal.season(F.month(at)),
        }
    )
    # the current reading is lag 0: 24 readings in all
    steps = {f"lag_{k}": ("PowerFromLoad", k) for k in range(1, lags)}
    steps |= {f"y_{h}": ("PowerFromLoad", -h) for h in range(1, horizon + 1)}
    table = ordered.neighbour_columns(marked, KEY, ["TimeStampMeasured", *tie], steps, ts)
    inputs = ["PowerFromLoad", *[f"lag_{k}" for k in range(1, lags)], "TimeOfDay", "Month", "DayOfWeek", "IsWeekend", "Season"]
    return table, inputs, [f"y_{h}" for h in range(1, horizon + 1)]


def forecast_from_readings(energy: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """The next four readings of every site from its last 24, without resampling.

    The fit reduces the lagged readings where they are; only coefficients and the last readings of a site
    are kept.
    """
    table, inputs, targets = reading_sequences(energy, "TimeStampMeasured", tie=tie)
    models = linear.fit_ridge(table, KEY, inputs, targets, min_rows=filters.MIN_HISTORY["slot_model"])
    newest_first = [F.desc("TimeStampMeasured"), *map(F.desc, tie)]
    tail = ordered.sequence_tail(energy.select(*KEY, "TimeStampMeasured", *tie, "PowerFromLoad"), KEY, newest_first, LAGS)
    last = ordered.sequence_tail(reading_sequences(tail, None, tie=tie)[0], KEY, newest_first, 1)
    scored = linear.predict(last, stored(models, "reading-models"), KEY, inputs).where(F.col("predictions").isNotNull())
    return scored.select(*KEY, F.posexplode("predictions").alias("_i", "LoadPower")).select(
        *KEY, (F.col("_i") + 1).alias("h"), "LoadPower"
    )
