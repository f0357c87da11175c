"""Joins. All are equi-joins on the site and a time key.

No side is forced to be broadcast: the planner broadcasts what its statistics show to be small, and at run
time what turned out to be small, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.functions import values as val
from wattloom.operators import aggregates as agg

HEAD = 4
DAY_ROWS = 96


def join_on_bin(left: DataFrame, right: DataFrame, key: str = "ClientId", bin_col: str = "bin") -> DataFrame:
    """Inner join of two series on site and bin."""
    return left.join(right, [key, bin_col], "inner")


def _by_minute(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, cal.truncate(F.col(ts), "MINUTE"))


def join_pv_history(measurements: DataFrame, history: DataFrame, key: str = "ClientId") -> DataFrame:
    """Readings with recorded solar power of the same minute; repeats on either side multiply."""
    return _by_minute(measurements, "Time").join(_by_minute(history, "Time"), [key, "Time"], "inner")


def cut_over(measurements: DataFrame, history: DataFrame, key: str = "ClientId") -> DataFrame:
    """Per site the last minute that both readings and recorded solar power have."""
    # distinct first: repeats of a minute are merged before the shuffle that the join needs anyway
    minutes, recorded = (_by_minute(df, "Time").select(key, "Time").distinct() for df in (measurements, history))
    both = minutes.join(recorded, [key, "Time"], "left_semi")
    return both.groupBy(key).agg(F.max("Time").alias("cut_over"))


def _recent(measurements: DataFrame, since: DataFrame, key: str, include_cut_over: bool) -> DataFrame:
    later = F.col("Time") >= F.col("cut_over") if include_cut_over else F.col("Time") > F.col("cut_over")
    # a site without a cut-over has no history to repeat: all its readings are recent
    whole = _by_minute(measurements, "Time").join(since, key, "left")
    return whole.where(F.col("cut_over").isNull() | later).drop("cut_over")


def _metered(energy: DataFrame, key: str) -> DataFrame:
    by_minute = _by_minute(energy.select(key, F.col("TimeStampMeasured").alias("Time"), "PowerToPv"), "Time")
    return by_minute.select(key, "Time", val.watt_to_kilowatt(F.col("PowerToPv")).alias("SolarPower"))


def join_pv_recent(
    measurements: DataFrame,
    energy: DataFrame,
    since: DataFrame,
    key: str = "ClientId",
    include_cut_over: bool = False,
) -> DataFrame:
    """Readings after the cut-over with metered solar power (kW), or the plant's own value where none is.

    ``include_cut_over`` keeps the cut-over minute itself, which the history branch holds too.
    """
    recent = _recent(measurements, since, key, include_cut_over)
    both = recent.join(_metered(energy, key), [key, "Time"], "left")
    return both.withColumn("SolarPower", F.coalesce("SolarPower", "PowerPV"))


def _per_minute(powers: DataFrame, key: str) -> DataFrame:
    return powers.groupBy(key, "Time").agg(
        F.sum("SolarPower").alias("_sum"), F.count("SolarPower").alias("_known"), F.count(F.lit(1)).alias("_all")
    )


def weigh_pv_history(measurements: DataFrame, history: DataFrame, key: str = "ClientId") -> DataFrame:
    """The pairs of :func:`join_pv_history` summed up per reading, one row each.

    ``SolarPower`` is the mean over a reading's pairs, ``pairs`` their number and ``known`` how many have a
    value. Means and modes by these weights are those of the pairs, which are never made.
    """
    matched = _by_minute(measurements, "Time").join(_per_minute(_by_minute(history, "Time"), key), [key, "Time"])
    return _weighted(matched, F.col("_sum"), F.col("_known"), F.col("_all"))


def weigh_pv_recent(
    measurements: DataFrame, energy: DataFrame, since: DataFrame, key: str = "ClientId", include_cut_over: bool = False
) -> DataFrame:
    """The pairs of :func:`join_pv_recent` summed up per reading; see :func:`weigh_pv_history`."""
    recent = _recent(measurements, since, key, include_cut_over)
    matched = recent.join(_per_minute(_metered(energy, key), key), [key, "Time"], "left")
    pairs = F.coalesce("_all", F.lit(1))
    metered = F.coalesce("_known", F.lit(0))
    # pairs without a metered value take the plant's own, if there is one
    own = F.when(F.col("PowerPV").isNotNull(), pairs - metered).otherwise(0)
    total = F.coalesce("_sum", F.lit(0.0)) + own * F.coalesce("PowerPV", F.lit(0.0))
    return _weighted(matched, total, metered + own, pairs)


def _weighted(matched: DataFrame, total: Column, known: Column, pairs: Column) -> DataFrame:
    return matched.withColumns(
        {"SolarPower": total / F.nullif(known, F.lit(0)), "known": known, "pairs": pairs}
    ).drop("_sum", "_known", "_all")


def join_client_energy(clients: DataFrame, energy: DataFrame) -> DataFrame:
    """Site columns once per reading of the site."""
    readings = energy.select(F.col("ClientId").alias("Id"))
    return readings.join(clients, "Id").select(*clients.columns)


def join_spine_left(df: DataFrame, keys: list[str], ts: str, width: int = cal.STEP_MINUTES) -> DataFrame:
    """Put a series on the complete grid from the first to the last instant of a key.

    Rows off the grid are lost; absent grid points get nulls. One row per key and instant is expected.
    """
    whole = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bounded = df.withColumns({"_first": F.min(ts).over(whole), "_last": F.max(ts).over(whole)})
    offset = _micros(ts) - _micros("_first")
    on_grid = bounded.where(offset % F.lit(width * 60 * 1_000_000) == 0).drop("_first")
    return agg.densify(on_grid, keys, ts, width, last="_last")


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def anti_unseen(serving: DataFrame, known: DataFrame, columns: list[str]) -> DataFrame:
    """Categories that are served but were never fitted."""
    return serving.select(*columns).distinct().join(known.select(*columns), columns, "left_anti")


def day_arrays(series: DataFrame, keys: list[str], ts: str, value: str, length: int = DAY_ROWS) -> DataFrame:
    """The readings of each day in order, as an array: at most ``length`` of them."""
    w = Window.partitionBy(*keys, F.to_date(ts)).orderBy(ts)
    ranked = series.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= length)
    rows = F.sort_array(F.collect_list(F.struct("_n", F.col(value).alias("v"))))
    return ranked.groupBy(*keys, F.to_date(ts).alias("Date")).agg(rows.getField("v").alias("values"))


def join_next_day_head(days: DataFrame, keys: list[str], head: int = HEAD, full: int = DAY_ROWS) -> DataFrame:
    """Full days followed by the first readings of the next present day.

    Where that day is absent or too short the last value of the day is repeated.
    """
    following = F.lead("values").over(Window.partitionBy(*keys).orderBy("Date"))
    held = F.array_repeat(F.element_at(F.slice("values", 1, full), -1), head)
    tail = F.when(F.size(following) >= head, F.slice(following, 1, head)).otherwise(held)
    return (
        days.withColumn("_tail", tail)
        .where(F.size("values") >= full)
        .select(*keys, "Date", F.concat(F.slice("values", 1, full), F.col("_tail")).alias("profile"))
    )


def join_model_params(df: DataFrame, params: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the fitted state of a row's site (and slot)."""
    return df.join(params, keys)


def align_series(left: DataFrame, right: DataFrame, keys: list[str], bin_col: str = "bin") -> DataFrame:
    """Two binned frames (one row per key and bin) on one gap-free grid.

    ``in_left`` and ``in_right`` tell whether a bin lies between the first and last bin of that side; where
    both hold is what an inner join of the two gap-free series would give. The sides arrive partitioned by
    key and bin from their aggregation, so joining them before the gaps are filled needs no shuffle, and a
    single shuffle by key serves all windows that follow.
    """
    both = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), [*keys, bin_col], "full_outer")
    dense = agg.densify(both, keys, bin_col)
    # ordered like the windows before and after it, so that the rows are sorted once
    whole = Window.partitionBy(*keys).orderBy(bin_col).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )

    def inside(flag: str):
        seen = F.when(F.col(flag), F.col(bin_col))
        return F.coalesce(F.col(bin_col).between(F.min(seen).over(whole), F.max(seen).over(whole)), F.lit(False))

    return dense.withColumns({"in_left": inside("_l"), "in_right": inside("_r")}).drop("_l", "_r")
