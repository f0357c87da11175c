"""Feature transforms: fitted state is a small table keyed by site, applied by a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.session import stored

# Fixed value: Monday has no column of its own.
WEEKDAY_COLUMNS = range(1, 7)


def fit_minmax(df: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    bounds = [f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.min, "min"), (F.max, "max"))]
    return df.groupBy(*keys).agg(*bounds)


def _scaled(c: str) -> Column:
    low, span = F.col(f"{c}_min"), F.col(f"{c}_max") - F.col(f"{c}_min")
    return F.when(span == 0, F.col(c) - low).otherwise((F.col(c) - low) / span)


def minmax_scale(df: DataFrame, params: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    """To 0..1 of the fitted range, not clipped; the fitted value of a constant column gives 0."""
    return df.join(params, keys).withColumns({c: _scaled(c) for c in columns}).select(*df.columns)


def minmax_inverse(
    df: DataFrame, params: DataFrame, keys: list[str], column: str, fitted_as: str | None = None
) -> DataFrame:
    """Back to the units of the fitted column."""
    name = fitted_as or column
    low, high = F.col(f"{name}_min"), F.col(f"{name}_max")
    span = F.when(high == low, F.lit(1.0)).otherwise(high - low)
    return df.join(params, keys).withColumn(column, F.col(column) * span + low).select(*df.columns)


def fit_standard(df: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation."""
    moments = [f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    return df.groupBy(*keys).agg(*moments)


def _standardised(c: str) -> Column:
    centred, spread = F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_std")
    return F.when(spread == 0, centred).otherwise(centred / spread)


def standard_scale(df: DataFrame, params: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    return df.join(params, keys).withColumns({c: _standardised(c) for c in columns}).select(*df.columns)


def standard_inverse(df: DataFrame, params: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    def back(c: str) -> Column:
        spread = F.when(F.col(f"{c}_std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}_std"))
        return F.col(c) * spread + F.col(f"{c}_mean")

    return df.join(params, keys).withColumns({c: back(c) for c in columns}).select(*df.columns)


def one_hot_weekday(df: DataFrame, ts: str, from_one: bool = False) -> DataFrame:
    """Six fixed 0/1 columns, whatever days occur; Monday is all zeros."""
    shift = 1 if from_one else 0
    day = F.weekday(ts)
    return df.withColumns({f"DayOfWeek_{k + shift}": (day == k).cast("int") for k in WEEKDAY_COLUMNS})


def fit_labels(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Codes 0..n-1 of the sorted distinct values, ``(keys, column, code)``.

    Values are dealt to tasks by ranges, numbered there, and moved by the counts of the ranges before: no task holds a
    whole dictionary. The dealt values are stored, so that counts and numbers speak of the same ranges.
    """
    values = df.where(F.col(column).isNotNull()).select(*keys, column).distinct()
    dealt = stored(values.repartitionByRange(*keys, column).withColumn("_range", F.spark_partition_id()), "label-values")
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    bases = sizes.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(column)) - 1
    numbered = dealt.withColumn("_place", place).join(bases, [*keys, "_range"])
    return numbered.select(*keys, column, (F.col("_base") + F.col("_place")).cast("int").alias("code"))


def label_encode(df: DataFrame, labels: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Add ``<column>_encoded``; values without a code are null."""
    return df.join(labels.withColumnRenamed("code", f"{column}_encoded"), [*keys, column], "left")


def safe_label_encode(df: DataFrame, labels: DataFrame, keys: list[str], column: str) -> DataFrame:
    """As :func:`label_encode`, with the code of the first class for unseen values."""
    return label_encode(df, labels, keys, column).withColumn(
        f"{column}_encoded", F.coalesce(f"{column}_encoded", F.lit(0))
    )


def fit_or_reuse(df: DataFrame, keys: list[str], columns: Sequence[str], known: DataFrame) -> DataFrame:
    """Stored min-max state where a site has one, fitted state for the others only.

    Rows are reduced to one per site where they are; only these meet the stored state.
    """
    missing = fit_minmax(df, keys, columns).join(known.select(*keys), keys, "left_anti")
    return known.unionByName(missing)


def calendar_features(df: DataFrame, ts: str) -> DataFrame:
    """The calendar block of the daily load features."""
    hour_sin, hour_cos = cal.cyclical_hour(F.col(ts))
    day_sin, day_cos = cal.cyclical_day_of_month(F.col(ts))
    parts = cal.calendar_parts(F.col(ts))
    return df.withColumns(
        {
            **{name: parts[name] for name in ("Month", "Day", "Hour", "DayOfWeek")},
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "sin_day_of_month": day_sin,
            "cos_day_of_month": day_cos,
        }
    )
