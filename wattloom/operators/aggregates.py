"""Resampling, summaries and other aggregates. All are combined on the map side before any shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions import calendar as cal
from wattloom.operators import columns as cols
from wattloom.session import stored

# Fixed value: what the mode of nothing is called.
NO_MODE = "Unknown"
# Half the width of the bracket around a wanted quantile, well above the sketch's error.
BRACKET = 0.002
SKETCH_ACCURACY = 10_000


def densify(
    binned: DataFrame, keys: list[str], bin_col: str = "bin", width: int = cal.STEP_MINUTES, last: str | None = None
) -> DataFrame:
    """Add the absent bins between a key's first and last one, with nulls.

    Every row fills the gap up to its successor, so neither a second scan for the bounds nor a join with
    a generated grid is needed. Input: one row per key and bin. The grid goes on to the instant in the column
    ``last`` if one is named, which is dropped.
    """
    successor = F.lead(bin_col).over(Window.partitionBy(*keys).orderBy(bin_col))
    end = F.coalesce(F.col("_next") - cal.minutes(width), F.col(last or bin_col))
    kept = [c for c in binned.columns if c != last]
    rest = [c for c in kept if c not in (*keys, bin_col)]
    steps = F.posexplode(cal.grid(F.col(bin_col), end, width)).alias("_gap", bin_col)
    return (
        binned.withColumn("_next", successor)
        .select(*keys, *rest, steps)
        .select(*[F.when(F.col("_gap") == 0, F.col(c)).alias(c) if c in rest else F.col(c) for c in kept])
    )


def binned(
    df: DataFrame, keys: list[str], ts: str, aggregates: Mapping[str, Column], width: int = cal.STEP_MINUTES
) -> DataFrame:
    return (
        df.withColumn("bin", cal.bin_start(ts, width))
        .groupBy(*keys, "bin")
        .agg(*[c.alias(name) for name, c in aggregates.items()])
    )


def resample_mean(
    df: DataFrame, keys: list[str], ts: str, columns: Sequence[str], width: int = cal.STEP_MINUTES
) -> DataFrame:
    """Mean per bin on the gap-free grid; bins without readings are null."""
    return densify(binned(df, keys, ts, {c: F.avg(c) for c in columns}, width), keys, "bin", width)


def resample_sum(
    df: DataFrame, keys: list[str], ts: str, columns: Sequence[str], width: int = cal.STEP_MINUTES
) -> DataFrame:
    """Sum per bin on the gap-free grid; bins without readings, or with nulls only, are 0."""
    grid = densify(binned(df, keys, ts, {c: F.sum(c) for c in columns}, width), keys, "bin", width)
    return grid.na.fill(0, list(columns))


def modes(df: DataFrame, keys: list[str], columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Most frequent value of each column per key; among equally frequent ones the largest.

    Values are counted first, so a frequent value costs one row per map task, and only the counts are
    ranked. All-null text columns give ``Unknown``, other types null. A row counts ``weight`` times.
    """
    types = {c: df.schema[c].dataType for c in columns}
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    times = F.lit(1) if weight is None else F.col(weight)
    counted = (
        df.select(*keys, times.alias("w"), F.explode(pairs).alias("p"))
        .groupBy(*keys, F.col("p.c").alias("c"), F.col("p.v").alias("v"))
        .agg(F.sum("w").alias("n"))
    )

    return counted.groupBy(*keys).agg(*[_best(c, types[c]).alias(c) for c in columns])


def _best(column: str, kind: T.DataType) -> Column:
    """The value of a column that has the greatest count ``n`` among rows ``(c, v, n)``."""
    typed = F.col("v").cast(kind)
    seen = (F.col("c") == column) & F.col("v").isNotNull()
    winner = F.max(F.when(seen, F.struct(F.col("n"), typed.alias("v")))).getField("v")
    return F.coalesce(winner, F.lit(NO_MODE)) if isinstance(kind, T.StringType) else winner


def resample_mode(
    df: DataFrame, keys: list[str], ts: str, columns: Sequence[str], width: int = cal.STEP_MINUTES
) -> DataFrame:
    return modes(df.withColumn("bin", cal.bin_start(ts, width)), [*keys, "bin"], columns)


def resample_mixed(
    df: DataFrame,
    keys: list[str],
    ts: str,
    width: int = cal.STEP_MINUTES,
    weight: str | None = None,
    weights: Mapping[str, str] | None = None,
) -> DataFrame:
    """Mean of numeric and mode of all other columns per bin, on the gap-free grid.

    A row counts ``weight`` times; ``weights`` names another weight for single columns. Sums of numbers and counts of
    values come from one pass, by bin, column and value, so the rows and what they are made from are evaluated once.
    """
    own = dict(weights or {})
    helpers = {weight, *own.values()}
    numeric = [c for c in cols.numeric_columns(df) if c not in keys and c not in helpers]
    other = [c for c in cols.other_columns(df) if c not in (*keys, ts)]
    types = {c: df.schema[c].dataType for c in other}

    def times(column: str) -> Column:
        name = own.get(column, weight)
        return (F.lit(1) if name is None else F.col(name)).cast("double")

    none = F.lit(None)
    values = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"), times(c).alias("w"), none.cast("double").alias("x")) for c in other]
    known = {c: F.when(F.col(c).isNotNull(), times(c)) for c in numeric}
    sums = [F.struct(F.lit(c).alias("c"), none.cast("string").alias("v"), known[c].alias("w"), (F.col(c) * known[c]).alias("x")) for c in numeric]
    counted = (
        df.select(*keys, cal.bin_start(ts, width).alias("bin"), F.explode(F.array(*values, *sums)).alias("p"))
        .groupBy(*keys, "bin", F.col("p.c").alias("c"), F.col("p.v").alias("v"))
        .agg(F.sum("p.w").alias("n"), F.sum("p.x").alias("x"))
    )
    means = [F.max(F.when(F.col("c") == c, F.col("x") / F.nullif(F.col("n"), F.lit(0.0)))).alias(c) for c in numeric]
    both = counted.groupBy(*keys, "bin").agg(*means, *[_best(c, types[c]).alias(c) for c in other])
    text = [c for c in other if isinstance(types[c], T.StringType)]
    return densify(both, keys, "bin", width).na.fill(NO_MODE, text)


def pivot_day_by_slot(
    df: DataFrame, keys: list[str], ts: str, value: str, slots: Sequence[str]
) -> DataFrame:
    """One row per key and day, one column per slot; the mean where readings repeat."""
    slotted = df.withColumns({"Date": F.to_date(ts), "slot": cal.slot(F.col(ts))})
    return slotted.groupBy(*keys, "Date").pivot("slot", list(slots)).agg(F.avg(value))


def day_slots(width: int = cal.STEP_MINUTES) -> list[str]:
    return [f"{m // 60:02d}:{m % 60:02d}:00" for m in range(0, 24 * 60, width)]


def distinct_days(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    return df.select(*keys, F.to_date(ts).alias("Date")).distinct()


def null_report(df: DataFrame) -> DataFrame:
    """Null count of every column, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])
    return counts.select(F.inline(pairs))


def cluster_histogram(df: DataFrame, keys: list[str], cluster: str = "cluster") -> DataFrame:
    return df.groupBy(*keys, cluster).agg(F.count(F.lit(1)).alias("members"))


def _sketch(df: DataFrame, keys: list[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """Per key the moments of a column and approximate brackets around the wanted quantiles."""
    around = [min(max(p + side * BRACKET, 0.0), 1.0) for p in probabilities for side in (-1, 1)]
    return df.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.percentile_approx(value, around, SKETCH_ACCURACY).alias("_splits"),
    )


def _exact(df: DataFrame, keys: list[str], value: str, probabilities: Sequence[float], sketch: DataFrame) -> DataFrame:
    """``(keys, probability, quantile)`` from the rows inside the brackets."""
    v = F.col("v")
    bucket = reduce(add, [(v >= F.get("_splits", F.lit(i))).cast("int") for i in range(2 * len(probabilities))])
    bucketed = (
        df.where(F.col(value).isNotNull())
        .select(*keys, F.col(value).alias("v"))
        .join(sketch.select(*keys, "_splits", F.col("count").alias("_total")), keys)
        .select(*keys, "v", "_total", bucket.alias("_bucket"))
    )
    below = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    rank = [(F.lit(p) * (F.col("_total") - 1)).alias("rank") for p in probabilities]
    ranks = F.array(*[F.struct(F.lit(p).alias("probability"), r) for p, r in zip(probabilities, rank, strict=True)])
    low, high = F.floor("rank"), F.ceil("rank")
    # per wanted rank the one or two buckets that hold it
    wanted = stored(
        bucketed.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_size"), F.max("_total").alias("_total"))
        .withColumn("_base", F.coalesce(F.sum("_size").over(below), F.lit(0)))
        .select(*keys, "_bucket", "_base", "_size", F.inline(ranks))
        .where((F.col("_base") <= high) & (low < F.col("_base") + F.col("_size"))),
        "wanted-ranks",
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        bucketed.join(wanted.select(*keys, "_bucket").distinct(), [*keys, "_bucket"], "left_semi")
        .groupBy(*keys, "_bucket", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_from", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    )
    start = F.col("_base") + F.col("_from")

    def at(position: Column) -> Column:
        return F.max(F.when((start <= position) & (position < start + F.col("n")), v))

    picked = (
        counted.join(wanted, [*keys, "_bucket"])
        .groupBy(*keys, "probability")
        .agg(at(low).alias("_low"), at(high).alias("_high"), F.max(F.col("rank") - low).alias("_part"))
    )
    quantile = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")
    return picked.select(*keys, "probability", quantile.alias("quantile"))


def quantiles(df: DataFrame, keys: list[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, ``(keys, probability, quantile)``.

    The built-in exact percentile holds all values of a key in one task. Here a first pass brackets every
    wanted quantile by a small sketch, a second counts the rows between the brackets, and a third orders
    the few values inside the ones that hold a wanted rank, equal values counted once. Whatever the
    sketch's error, the ranks are counted, so the result is exact.
    """
    return _exact(df, keys, value, probabilities, stored(_sketch(df, keys, value, probabilities), "value-sketch"))


def summary_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Count, mean, sample standard deviation, min, quartiles and max per key."""
    quartile = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    sketch = stored(_sketch(df, keys, value, list(quartile)), "value-sketch")
    picked = _exact(df, keys, value, list(quartile), sketch)
    wide = picked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(n) for p, n in quartile.items()]
    )
    return sketch.join(wide, keys, "left").select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def max_time(df: DataFrame, keys: list[str], ts: str, name: str = "max_time") -> DataFrame:
    return df.groupBy(*keys).agg(F.max(ts).alias(name))


def last_values(df: DataFrame, keys: list[str], ts: str, columns: Sequence[str]) -> DataFrame:
    """The columns of one row of each key, that at the latest instant; of several at that instant the one with the largest values."""
    row = F.struct(ts, *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = df.groupBy(*keys).agg(F.max(F.when(F.col(ts).isNotNull(), row)).alias("_last"))
    return rows.select(*keys, *[F.col(f"_last._{i}").alias(c) for i, c in enumerate(columns)])


def corr_with_target(df: DataFrame, keys: list[str], features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of every feature with the target, one row per key and feature."""
    wide = df.groupBy(*keys).agg(*[F.corr(f, target).alias(f) for f in features])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("corr")) for f in features])
    return wide.select(*keys, F.inline(pairs))
