"""Daily solar power: one value per quarter hour across the weather forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.functions import values as val
from wattloom.operators import aggregates as agg
from wattloom.operators import assembly, boosting, columns, filters, joins, metrics, ordered, sets, transforms
from wattloom.session import stored

# Fixed values.
WEATHER = ["Temperature", "Clouds", "Visibility", "Humidity", "Pressure", "WindSpeed"]
CALENDAR = ["hour_sin", "hour_cos", "sin_day_of_month", "cos_day_of_month", "daylight_duration"]
ENCODED = ["Weather_encoded", "WeatherDescription_encoded"]
TARGET = "SolarPower"
TRAIN_FRACTION = 0.85
CONTEXT_ROWS = 1152
SEQUENCE = 24
TREES = 200
DEPTH = 5
LEARNING_RATE = 0.1
# Weather and its lags have few different values.
BINS = 64

# Rows before a serving row whose weather is looked at: the full window.
CONTEXT_LAGS = range(1, SEQUENCE + 1)
KEY = ["ClientId"]


def training_series(
    measurements: DataFrame, history: DataFrame, energy: DataFrame, include_cut_over: bool = False
) -> DataFrame:
    """Weather with solar power per bin: recorded history, then metered power after its end.

    Readings that share a minute pair up with all powers of that minute. The bin's means and modes over
    those pairs are taken by weight.
    """
    since = stored(joins.cut_over(measurements, history), "cut-over")
    recorded = joins.weigh_pv_history(measurements, history)
    metered = joins.weigh_pv_recent(measurements, energy, since, include_cut_over=include_cut_over)
    both = sets.union_all(recorded, metered).drop("PowerPV")
    mixed = agg.resample_mixed(both, KEY, "Time", weight="pairs", weights={TARGET: "known"})
    return mixed.withColumns(
        {
            "SunriseDT": cal.truncate(F.col("SunriseDT"), "MINUTE"),
            "SunsetDT": cal.truncate(F.col("SunsetDT"), "MINUTE"),
            "Temperature": val.kelvin_to_celsius(F.col("Temperature")),
        }
    )


def _calendar(df: DataFrame, ts: str) -> DataFrame:
    """Local-clock columns; the row key stays the UTC instant."""
    local = cal.to_local(F.col(ts))
    hour_sin, hour_cos = cal.cyclical_hour(local)
    day_sin, day_cos = cal.cyclical_day_of_month(local)
    return df.withColumns(
        {
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "sin_day_of_month": day_sin,
            "cos_day_of_month": day_cos,
            "daylight_duration": cal.daylight_hours(F.col("SunriseDT"), F.col("SunsetDT")),
        }
    )


def fit_encoders(train: DataFrame) -> dict[str, DataFrame]:
    """Category codes shared by all sites."""
    return {c: transforms.fit_labels(train, [], c) for c in ("Weather", "WeatherDescription")}


def features(series: DataFrame, encoders: dict[str, DataFrame], weather: list[str] = WEATHER) -> DataFrame:
    """The published feature table, from complete rows of the series."""
    table = _calendar(series, "bin")
    for column, labels in encoders.items():
        table = transforms.label_encode(table, labels, [], column)
    return table.select(*KEY, "bin", *weather, *CALENDAR, *ENCODED, TARGET, "SunriseDT", "SunsetDT")


def serving(
    forecast: DataFrame, train: DataFrame, encoders: dict[str, DataFrame], weather: list[str] = WEATHER
) -> DataFrame:
    """The weather forecast with the same features, put on the 15-minute grid.

    All features are computed on the forecast's own rows and then carried forward to the grid.
    """
    sun = agg.last_values(train, KEY, "bin", ["SunriseDT", "SunsetDT"])
    rows = forecast.join(sun, KEY).withColumns(
        {c: cal.at_time_of_day(F.col("Time"), F.col(c)) for c in ("SunriseDT", "SunsetDT")}
    )
    rows = _calendar(rows, "Time")
    for column, labels in encoders.items():
        rows = transforms.safe_label_encode(rows, labels, [], column)
    wanted = [*weather, *CALENDAR, *ENCODED, "SunriseDT", "SunsetDT"]
    aligned = columns.select_rename(rows, {"ClientId": "ClientId", "Time": "bin", **{c: c for c in wanted if c in rows.columns}})
    grid = joins.join_spine_left(columns.align_columns(aligned, [*KEY, "bin", *wanted]), KEY, "bin")
    return ordered.fill_forward(grid, KEY, ["bin"], wanted, None)


def with_context(table: DataFrame, weather: list[str] = WEATHER) -> tuple[DataFrame, list[str]]:
    """Add earlier weather; returns the model's input columns too."""
    lags = {f"{c}_lag_{k}": (c, k) for c in weather for k in CONTEXT_LAGS}
    return ordered.neighbour_columns(table, KEY, ["bin"], lags, None), [*weather, *CALENDAR, *ENCODED, *lags]


def fit(table: DataFrame, inputs: list[str], trees: int, depth: int, known: DataFrame | None = None) -> DataFrame:
    """Boosted trees, an ensemble per site; sites in ``known`` keep their stored ones."""
    return boosting.fit_or_reuse(
        table, KEY, known, inputs=inputs, label=TARGET, order=["bin"], trees=trees, rate=LEARNING_RATE, depth=depth, bins=BINS
    )


def train(
    table: DataFrame, weather: list[str], trees: int, depth: int, known: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Ensembles from the first part of every site, and errors in kWh on the rest."""
    rows, inputs = with_context(table, weather)
    split = stored(
        ordered.chronological_split(rows.na.drop("any", subset=inputs), KEY, ["bin"], None, fraction=TRAIN_FRACTION),
        "solar-features",
    )
    models = stored(fit(split.where("is_train"), inputs, trees, depth, known), "solar-trees")
    tested = boosting.predict(split.where("NOT is_train"), models, KEY, inputs).withColumns(
        {"y": val.watt_to_kwh(F.col(TARGET)), "p": val.watt_to_kwh(F.col("prediction"))}
    )
    return models, metrics.evaluate(tested, KEY, "y", "p", ["MSE", "MAE", "RMSE", "R2"])


def score(models: DataFrame, table: DataFrame, served: DataFrame, issued: str, weather: list[str] = WEATHER) -> DataFrame:
    """Forecast every grid row of the serving set; training rows only give its first rows a past."""
    tail = ordered.sequence_tail(table.drop(TARGET), KEY, [F.desc("bin")], CONTEXT_ROWS).withColumn("is_serving", F.lit(False))
    both = sets.union_all(tail, served.withColumn("is_serving", F.lit(True)))
    rows, inputs = with_context(both, weather)
    scored = boosting.predict(assembly.serving_rows(rows).na.drop("any", subset=inputs), models, KEY, inputs)
    power = val.night_to_zero(F.col("prediction"), F.col("bin"), F.col("SunriseDT"), F.col("SunsetDT"))
    return scored.select(
        *KEY,
        F.col("bin").alias("Time"),
        power.alias("SolarPower_pred"),
        F.lit(issued).cast("timestamp_ntz").alias("Time_predicted"),
        "SunriseDT",
        "SunsetDT",
    )


def forecast(
    measurements: DataFrame,
    history: DataFrame,
    energy: DataFrame,
    weather_forecast: DataFrame,
    issued: str,
    weather: list[str] = WEATHER,
    trees: int = TREES,
    depth: int = DEPTH,
    known: DataFrame | None = None,
) -> DataFrame:
    """The whole daily solar job. ``known``: stored ensembles of sites that are not fitted again."""
    complete = filters.drop_any_null(training_series(measurements, history, energy))
    series = stored(complete, "solar-series")
    encoders = {c: stored(labels, "solar-labels") for c, labels in fit_encoders(series).items()}
    table = stored(features(series, encoders, weather), "solar-table")
    models, _ = train(table, weather, trees, depth, known)
    served = serving(weather_forecast, table, encoders, weather)
    return score(models, table, served, issued, weather)
