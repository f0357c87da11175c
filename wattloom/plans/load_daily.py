"""Daily load: 96 quarter hours ahead plus 4 held ones, for every site in one job."""

from __future__ import annotations

import time
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.functions import values as val
from wattloom.operators import aggregates as agg
from wattloom.operators import assembly, columns, filters, joins, linear, metrics, ordered, transforms, windows
from wattloom.plans import gate
from wattloom.session import stored

# Fixed values.
CUTOFF = "2025-09-01 00:00:00"
LAGS = 15
HORIZON = 96
TRAIN_FRACTION = 0.8
TARGET = "LoadEnergyCalculated_15"
FORECAST = "LoadEnergyForecast_15"
FEATURES = [
    "Temperature", "Humidity", "Month", "Day", "Hour",
    "hour_sin", "hour_cos", "sin_day_of_month", "cos_day_of_month",
    *[f"lag_{k}" for k in range(1, LAGS + 1)],
    "Temperature_Hour",
    *[f"DayOfWeek_{k}" for k in range(1, 7)],
]

# The same quarter hour one, two and three days before: what a longer input window would show.
DAY_LAGS = (96, 192, 288)
# Rows of the whole input window. Its lags reach back further, to older values of the target alone.
WINDOW = 288
WINDOW_INPUTS = {TARGET: WINDOW + LAGS, **{f: WINDOW for f in FEATURES if not f.startswith("lag_")}}
# There may be more inputs than rows: the penalty of one for each of them.
WINDOW_RIDGE = float(sum(WINDOW_INPUTS.values()))
KEY = ["ClientId"]


def bin_states(
    energy: DataFrame,
    cutoff: str = CUTOFF,
    limit: float = val.SPIKE_LIMIT,
    value: str = "LoadEnergyCalculated",
    ts: str = "TimeStampMeasured",
    tie: tuple[str, ...] = (),
    width: int = cal.STEP_MINUTES,
) -> DataFrame:
    """What a bin's readings say about its sum: ``(ClientId, bin, total, open, final)``.

    Spikes take the last good reading. Inside a bin that needs the order of its own rows only: ``total`` is
    the sum of good and filled readings, ``open`` counts the spikes before the first good one, which wait
    for an earlier bin, and ``final`` is the last good reading. Readings are ordered and reduced by site and
    second, and the seconds of a bin, 900 at most, merge into its state. So no task holds more readings than a second has
    instants, however they crowd; a bin's state depends on no other bin; and readings bucketed by site and
    ``day`` are not shuffled at all.
    """
    place = [*KEY, *[c for c in ("day",) if c in energy.columns]]
    wanted = [*place, ts, value, *tie]
    raw = filters.after_cutoff(energy, ts, cutoff, wanted)
    marks = {"bin": cal.bin_start(ts, width), "part": cal.truncate(F.col(ts), "SECOND"), "v": val.spike_to_null(F.col(value), limit)}
    good = raw.select(*wanted).withColumns(marks)
    parts = [*place, "bin", "part"]
    inside = Window.partitionBy(*parts).orderBy(ts, *tie).rowsBetween(Window.unboundedPreceding, 0)
    states = (
        good.withColumn("filled", F.last("v", ignorenulls=True).over(inside))
        .groupBy(*parts)
        .agg(
            F.sum("filled").alias("total"),
            F.count_if(F.col("filled").isNull()).alias("open"),
            F.max_by("filled", F.struct(ts, *tie) if tie else F.col(ts)).alias("final"),
        )
    )
    return _merged(states, place).select(*KEY, "bin", "total", "open", "final")


def _merged(states: DataFrame, place: list[str]) -> DataFrame:
    """The states of a bin's consecutive parts as one state."""
    before = Window.partitionBy(*place, "bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = states.withColumn("carried", F.last("final", ignorenulls=True).over(before))
    return carried.groupBy(*place, "bin").agg(
        F.sum(F.coalesce("total", F.lit(0.0)) + F.coalesce(F.col("open") * F.col("carried"), F.lit(0.0))).alias("total"),
        F.sum(F.when(F.col("carried").isNull(), F.col("open")).otherwise(0)).alias("open"),
        F.max_by("final", F.when(F.col("final").isNotNull(), F.col("part"))).alias("final"),
    )


def _summed(states: DataFrame) -> DataFrame:
    before = Window.partitionBy(*KEY).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last("final", ignorenulls=True).over(before)
    total = F.coalesce("total", F.lit(0.0)) + F.coalesce(F.col("open") * carried, F.lit(0.0))
    return states.withColumn(TARGET, total).drop("total", "open", "final")


def bin_sums(states: DataFrame) -> DataFrame:
    """Sum per bin, ``(ClientId, bin, TARGET)``: open spikes get the last good reading of an earlier bin."""
    return _summed(states).select(*KEY, "bin", TARGET)


def energy_bins(energy: DataFrame, cutoff: str = CUTOFF, limit: float = val.SPIKE_LIMIT, **names) -> DataFrame:
    return bin_sums(bin_states(energy, cutoff, limit, **names))


def _clean_sums(series: DataFrame, limit: float) -> DataFrame:
    """Empty bins are 0; sums above the limit take the bin before."""
    summed = series.withColumn(TARGET, val.spike_to_null(F.coalesce(TARGET, F.lit(0.0)), limit))
    return ordered.fill_forward(summed, KEY, ["bin"], [TARGET], None)


def series_from_bins(bins: DataFrame, limit: float = val.SPIKE_LIMIT, width: int = cal.STEP_MINUTES) -> DataFrame:
    return _clean_sums(agg.densify(bins, KEY, width=width), limit)


def energy_series(
    energy: DataFrame, cutoff: str = CUTOFF, limit: float = val.SPIKE_LIMIT, width: int = cal.STEP_MINUTES, **names
) -> DataFrame:
    """The clean gap-free energy series, in bins of 15 minutes unless told otherwise."""
    return series_from_bins(energy_bins(energy, cutoff, limit, width=width, **names), limit, width)


def weather_bins(measurements: DataFrame) -> DataFrame:
    means = {"Temperature": F.avg("Temperature"), "Humidity": F.avg("Humidity")}
    return agg.binned(measurements, KEY, "Time", means)


def weather_series(measurements: DataFrame) -> DataFrame:
    return agg.densify(weather_bins(measurements), KEY)


def joined_series(
    energy: DataFrame,
    measurements: DataFrame,
    cutoff: str = CUTOFF,
    limit: float = val.SPIKE_LIMIT,
    **names,
) -> DataFrame:
    """Energy and weather over their common span, nulls where the weather has gaps.

    ``index`` is the place of a bin in the site's energy series. Bin states are joined before values are carried across bins, so both sides are still partitioned by
    site and bin, and one shuffle by site serves the carrying, the gaps, the fill and the lags.
    """
    aligned = joins.align_series(bin_states(energy, cutoff, limit, **names), weather_bins(measurements), KEY)
    clean = _clean_sums(_summed(aligned).where("in_left"), limit)
    numbered = ordered.row_ordinal(clean, KEY, ["bin"], None)
    return numbered.where("in_right").select(*KEY, "bin", "index", TARGET, "Temperature", "Humidity")


def with_features(joined: DataFrame) -> DataFrame:
    """Calendar, lags, interaction and weekday columns; rows are still complete."""
    lagged = ordered.lag_features(transforms.calendar_features(joined, "bin"), KEY, ["bin"], TARGET, LAGS)
    return transforms.one_hot_weekday(
        lagged.withColumn("Temperature_Hour", F.col("Temperature") * F.col("Hour")), "bin"
    ).drop("DayOfWeek")


def features(energy: DataFrame, measurements: DataFrame, **settings) -> DataFrame:
    """The published feature table; rows with any null are dropped after the lags were taken."""
    table = filters.drop_any_null(with_features(joined_series(energy, measurements, **settings)))
    return table.select(*KEY, F.col("bin").alias("Timestamp"), TARGET, "index", *FEATURES)


def inputs() -> list[str]:
    return [TARGET, *FEATURES, *[f"lag_{k}" for k in DAY_LAGS]]


def supervised(energy: DataFrame, measurements: DataFrame, **settings) -> DataFrame:
    """Every bin of the joined span with the model's inputs, and whether all of them are known.

    Incomplete rows stay: they are no origins, but they are targets and lags of others, and without them
    the h-th next row would not be h quarter hours later.
    """
    table = with_features(joined_series(energy, measurements, **settings))
    table = ordered.neighbour_columns(table, KEY, ["bin"], {f"lag_{k}": (TARGET, k) for k in DAY_LAGS}, None)
    known = reduce(and_, [F.col(c).isNotNull() for c in inputs()])
    return columns.cast_numeric(table, inputs()).select(*KEY, "bin", *inputs(), known.alias("usable"))


def split(table: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """Add ``is_train``: up to the bin where the first part of the usable rows of a site ends."""
    place = F.count_if("usable").over(Window.partitionBy(*KEY).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    total = F.count_if("usable").over(Window.partitionBy(*KEY))
    return table.withColumn("is_train", place <= F.floor(total * F.lit(fraction)))


def train(parts: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """One model per site with enough history, for all steps at once; targets stay within the training part."""
    partials = linear.moments_ahead(parts, KEY, "bin", inputs(), TARGET, horizon, "is_train")
    size, needed = len(inputs()), filters.MIN_HISTORY["daily_load"]
    return linear.solve_ridge(partials, KEY, size, horizon, [(size, 1.0)], needed).drop("n_features", "ridge")


def held_out(parts: DataFrame, models: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """``(ClientId, bin, h, y, p)`` for the held-out origins that have all their targets."""
    ahead = ordered.target_vector(parts, KEY, "bin", TARGET, horizon).where("usable AND NOT is_train")
    scored = linear.predict(ahead, models, KEY, inputs()).where(F.col("predictions").isNotNull())
    pairs = F.zip_with("target", "predictions", lambda y, p: F.struct(y.alias("y"), p.alias("p")))
    return scored.select(*KEY, "bin", F.posexplode(pairs).alias("_i", "_pair")).select(
        *KEY, "bin", (F.col("_i") + 1).alias("h"), F.col("_pair.y"), F.col("_pair.p")
    )


def evaluate(parts: DataFrame, models: DataFrame, keys: list[str] = KEY) -> DataFrame:
    return metrics.evaluate(held_out(parts, models), keys, "y", "p")


def run_metrics(parts: DataFrame, models: DataFrame, trained_at: str, seconds: float | None = None) -> DataFrame:
    """The run history entry of every site that has a model and held-out rows."""
    errors = metrics.evaluate(held_out(parts, models), KEY, "y", "p", list(metrics.RUN_ERRORS))
    counts = parts.where("usable").groupBy(*KEY).agg(
        F.count(F.lit(1)).cast("int").alias("n_rows_total"),
        F.count_if("is_train").cast("int").alias("n_train_rows"),
        F.count_if(~F.col("is_train")).cast("int").alias("n_test_rows"),
    )
    return errors.join(counts, KEY).withColumns(
        {
            "TrainEnd": F.lit(trained_at),
            "seq_len": F.lit(max(DAY_LAGS)),
            "prediction_steps": F.lit(HORIZON),
            "n_features": F.lit(len(inputs())),
            "training_time_seconds": F.lit(seconds).cast("double"),
        }
    )


def retrain(
    parts: DataFrame, history: DataFrame, in_use: DataFrame | None, trained_at: str
) -> tuple[DataFrame, DataFrame]:
    """Fit, judge and promote site by site: the run history's new rows, and the models to use from now on.

    A site keeps its old model unless the new one passes the gate against the run in use.
    """
    started = time.monotonic()
    models = stored(train(parts), "daily-load-models")
    runs = run_metrics(parts, models, trained_at, time.monotonic() - started)
    champions = gate.latest_in_use(history.withColumn("TrainEnd", F.try_to_timestamp("TrainEnd")))
    decided = stored(gate.champion_gate(runs, champions).drop("old_wmape", "old_rmse"), "daily-load-runs")
    accepted = models.join(decided.where("accepted"), KEY, "left_semi")
    active = accepted if in_use is None else accepted.unionByName(in_use.join(accepted, KEY, "left_anti"))
    return decided.withColumnRenamed("accepted", "was_in_use"), active


def forecast_from(table: DataFrame, models: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """96 steps after each site's last usable row, then the last value held for 4 more."""
    origins = table.where("usable").select(*KEY, "bin", *inputs())
    last = ordered.sequence_tail(origins, KEY, [F.desc("bin")], 1)
    scored = linear.predict(last, models, KEY, inputs()).where(F.col("predictions").isNotNull())
    steps = scored.select(*KEY, F.posexplode("predictions").alias("_i", FORECAST)).select(
        *KEY, (F.col("_i") + 1).alias("h"), FORECAST
    )
    grid = assembly.future_grid(scored, KEY, "bin", horizon)
    forecast = assembly.on_future_grid(grid, steps, KEY, FORECAST)
    return assembly.hold_last(forecast, KEY, "Timestamp", FORECAST)


def forecast(energy: DataFrame, measurements: DataFrame, **settings) -> DataFrame:
    """The whole daily job. Fit and scoring read one stored feature table."""
    table = stored(split(supervised(energy, measurements, **settings)), "daily-load-features")
    models = stored(train(table), "daily-load-models")
    return forecast_from(table, models)


def window_table(energy: DataFrame, measurements: DataFrame, **settings) -> DataFrame:
    """Every bin of the joined span with the columns that input windows are made of, split into training and test rows.

    A window of 288 rows would be lost with any bin that has no weather, so the last known one is carried over gaps.
    """
    filled = ordered.fill_forward(joined_series(energy, measurements, **settings), KEY, ["bin"], ["Temperature", "Humidity"], None)
    calendar = transforms.calendar_features(filled, "bin").withColumn("Temperature_Hour", F.col("Temperature") * F.col("Hour"))
    table = columns.cast_numeric(transforms.one_hot_weekday(calendar, "bin"), list(WINDOW_INPUTS))
    known = reduce(and_, [F.col(c).isNotNull() for c in WINDOW_INPUTS])
    return split(table.select(*KEY, "bin", *WINDOW_INPUTS, known.alias("usable")))


def train_windows(table: DataFrame, horizon: int = HORIZON, ridge: float = WINDOW_RIDGE) -> DataFrame:
    """One model per site and step, from all 288 rows of 32 features; sites with too little history have none."""
    return windows.fit(table, KEY, "bin", WINDOW_INPUTS, TARGET, horizon, "is_train", ridge, filters.MIN_HISTORY["daily_load"])


def held_out_windows(table: DataFrame, models: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """``(ClientId, bin, h, y, p)`` for the held-out origins that have all their targets."""
    marked = ordered.neighbour_columns(table, KEY, ["bin"], {"_last": (TARGET, -horizon)}, None)
    marked = marked.withColumn("is_origin", ~F.col("is_train") & F.col("usable") & F.col("_last").isNotNull())
    return windows.ahead(marked, models, KEY, "bin", WINDOW_INPUTS, TARGET, horizon, "is_origin")


def forecast_windows(table: DataFrame, models: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """96 steps after each site's last whole window, then the last value held for 4 more."""
    steps = stored(windows.ahead(table, models, KEY, "bin", WINDOW_INPUTS, TARGET, horizon), "daily-load-steps")
    grid = assembly.future_grid(steps, KEY, "bin", horizon)
    return assembly.hold_last(assembly.on_future_grid(grid, steps.withColumnRenamed("p", FORECAST), KEY, FORECAST), KEY, "Timestamp", FORECAST)


def forecast_from_windows(energy: DataFrame, measurements: DataFrame, **settings) -> DataFrame:
    """The whole daily job from whole input windows."""
    table = stored(window_table(energy, measurements, **settings), "daily-load-windows")
    return forecast_windows(table, stored(train_windows(table), "daily-load-window-models"))
