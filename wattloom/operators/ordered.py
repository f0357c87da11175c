"""Operators that depend on row order.

Two sizes of input are told apart:

* **Raw readings** have no bound per site; one site may own a third of them, and they may crowd into any second. These
  operators never gather a site: rows are dealt once to ranges of site and order, sorted there and stored with a running number.
  What crosses a range's border (a count, a last value) is one row per site and range, carried over the ranges before and joined back.
  Where a fixed number of neighbours is needed, rows are cut into equal blocks with copied edges. Pass the instant's column as ``ts``.
* **Series** on the 15-minute grid hold at most 35 040 rows per site and year whatever the reading rate,
  so a plain window by site is safe there. Pass ``ts=None`` for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.session import stored

BLOCK_ROWS = 100_000


def _dealt(df: DataFrame, keys: list[str], order: Sequence[str | Column]) -> DataFrame:
    """The rows with ``_row``, ascending in the order of keys and ``order``, and ``_part``, the range they are in."""
    by = [*keys, *order]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id())
    return stored(rows, "ordered").withColumn("_part", F.shiftright("_row", 33))


def _before(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def row_ordinal(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str | Column],
    ts: str | None,
    name: str = "index",
    total: str | None = None,
) -> DataFrame:
    """0-based position of every row within its key, and optionally the row count of the key.

    Rows are counted within their range, ranges within their key.
    """
    if ts is None:
        df = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
        return df.withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(*keys))) if total else df
    dealt = _dealt(df, keys, order)
    parts = dealt.groupBy(*keys, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = F.coalesce(F.sum("_n").over(_before(keys, "_part")), F.lit(0))
    totals = [F.sum("_n").over(Window.partitionBy(*keys)).alias(total)] if total else []
    bases = stored(parts.select(*keys, "_part", (earlier - F.col("_first")).alias("_base"), *totals), "ordered-bases")
    joined = dealt.join(bases, [*keys, "_part"]).withColumn(name, F.col("_base") + F.col("_row"))
    return joined.select(*[c for c in df.columns if c not in (name, total)], *([total] if total else []), name)


def fill_forward(
    df: DataFrame, keys: list[str], order: Sequence[str], columns: Sequence[str], ts: str | None
) -> DataFrame:
    """Last known value down the rows; nulls before the first known value stay."""
    so_far = (Window.unboundedPreceding, 0)
    if ts is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*so_far)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    dealt = _dealt(df, keys, order)
    parts = dealt.groupBy(*keys, "_part").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_row"))).alias(f"_last_{c}") for c in columns]
    )
    carried = [F.last(f"_last_{c}", ignorenulls=True).over(_before(keys, "_part")).alias(f"_carry_{c}") for c in columns]
    bases = stored(parts.select(*keys, "_part", *carried), "ordered-carries")
    own = Window.partitionBy(*keys, "_part").orderBy("_row").rowsBetween(*so_far)
    filled = dealt.join(bases, [*keys, "_part"]).withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(own), F.col(f"_carry_{c}")) for c in columns}
    )
    return filled.select(*df.columns)


def in_blocks(
    df: DataFrame, keys: list[str], position: str, before: int, after: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Cut each key into equal blocks of consecutive rows, with ``before`` and ``after`` rows copied in.

    Adds ``_block`` and ``_core``; a window over ``(keys, _block)`` sees every neighbour a core row may ask
    for. Keep only core rows afterwards.
    """
    pos = F.col(position)
    own = F.floor(pos / block_rows)
    first = F.greatest(F.floor((pos - after) / block_rows), F.lit(0))
    last = F.floor((pos + before) / block_rows)
    return df.withColumn("_own", own).withColumn("_block", F.explode(F.sequence(first, last))).withColumn(
        "_core", F.col("_block") == F.col("_own")
    ).drop("_own")


def neighbour_columns(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str | Column],
    columns: dict[str, tuple[str, int]],
    ts: str | None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Values of other rows by row distance: ``{name: (column, k)}``, k > 0 earlier, k < 0 later."""

    def shifted(window):
        return {n: F.lag(c, k).over(window) if k >= 0 else F.lead(c, -k).over(window) for n, (c, k) in columns.items()}

    if ts is None:
        return df.withColumns(shifted(Window.partitionBy(*keys).orderBy(*order)))
    before = max([k for _, k in columns.values()] + [0])
    after = max([-k for _, k in columns.values()] + [0])
    numbered = row_ordinal(df, keys, order, ts, "_pos")
    blocks = in_blocks(numbered, keys, "_pos", before, after, block_rows)
    w = Window.partitionBy(*keys, "_block").orderBy("_pos")
    return blocks.withColumns(shifted(w)).where("_core").drop("_pos", "_block", "_core")


def lag_features(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str | Column],
    value: str,
    max_lag: int,
    ts: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``lag_1 .. lag_N``: the values of the N rows before, by row and not by time."""
    wanted = {f"lag_{k}": (value, k) for k in range(1, max_lag + 1)}
    return neighbour_columns(df, keys, order, wanted, ts, block_rows)


def fill_across(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Fill forward, then backward, then with 0, along the slots of a day (a bounded group)."""
    w = Window.partitionBy(*keys).orderBy(order)
    earlier = w.rowsBetween(Window.unboundedPreceding, 0)
    later = w.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(
        value,
        F.coalesce(
            F.last(value, ignorenulls=True).over(earlier), F.first(value, ignorenulls=True).over(later), F.lit(0)
        ),
    )


def input_sequences(
    series: DataFrame,
    keys: list[str],
    order: str,
    features: Sequence[str],
    length: int,
    include_current: bool = False,
    name: str = "sequence",
) -> DataFrame:
    """Sliding windows of ``length`` rows on a series; rows without a full window are left out.

    Rows i-L..i-1, or i-L+1..i with ``include_current``.
    """
    last = 0 if include_current else -1
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(last - length + 1, last)
    item = F.struct(*features) if len(features) > 1 else F.col(features[0])
    # a list skips nulls, so null readings are wrapped to keep their place
    rows = F.collect_list(F.struct(item.alias("v"))).over(w)
    return _full(series.withColumn(name, rows), name, length)


def _full(df: DataFrame, name: str, length: int) -> DataFrame:
    return df.where(F.size(name) == length).withColumn(name, F.col(f"{name}.v"))


def target_vector(
    series: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    horizon: int,
    first: int = 1,
    name: str = "target",
) -> DataFrame:
    """The values of rows i+first .. i+first+horizon-1; rows without all of them are left out."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(first, first + horizon - 1)
    rows = F.collect_list(F.struct(F.col(value).alias("v"))).over(w)
    return _full(series.withColumn(name, rows), name, horizon)


def supervised_windows(
    series: DataFrame,
    keys: list[str],
    order: str,
    features: Sequence[str],
    value: str,
    length: int,
    horizon: int,
    spare: int = 1,
) -> DataFrame:
    """Inputs i-L..i-1 with targets i..i+H-1, where at least ``spare`` more rows follow the last target."""
    w = Window.partitionBy(*keys).orderBy(order)
    later = F.count(F.lit(1)).over(w.rowsBetween(0, horizon - 1 + spare))
    known = series.withColumn("_later", later)
    both = target_vector(input_sequences(known, keys, order, features, length), keys, order, value, horizon, 0)
    return both.where(F.col("_later") == horizon + spare).drop("_later")


def targets_by_time(
    series: DataFrame, keys: list[str], bin_col: str, value: str, horizon: int, step: int = cal.STEP_MINUTES
) -> DataFrame:
    """``y_1 .. y_H`` at ``bin + h * step``, null where that bin is absent: a gap is never jumped."""
    w = Window.partitionBy(*keys).orderBy(F.unix_seconds(F.col(bin_col).cast("timestamp")))
    at = {h: w.rangeBetween(60 * step * h, 60 * step * h) for h in range(1, horizon + 1)}
    return series.withColumns({f"y_{h}": F.max(value).over(frame) for h, frame in at.items()})


def sequence_tail(df: DataFrame, keys: list[str], order: Sequence[Column | str], length: int) -> DataFrame:
    """The last ``length`` rows of every key; ``order`` is descending.

    Up to 1000 rows are cut by each task before the shuffle; take longer tails of series only.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= length).drop("_rank")


def first_of_day(df: DataFrame, keys: list[str], ts: str, count: int, tie: Sequence[str] = ()) -> DataFrame:
    """The first ``count`` rows of every day."""
    w = Window.partitionBy(*keys, F.to_date(ts)).orderBy(ts, *tie)
    return df.withColumn("position", F.row_number().over(w)).where(F.col("position") <= count)


def chronological_split(
    df: DataFrame,
    keys: list[str],
    order: Sequence[str | Column],
    ts: str | None,
    fraction: float | None = None,
    test_rows: int | None = None,
) -> DataFrame:
    """Add ``is_train``: the first ``fraction`` of the rows of a key, or all but its last ``test_rows``."""
    if (fraction is None) == (test_rows is None):
        raise ValueError("give either fraction or test_rows")
    numbered = row_ordinal(df, keys, order, ts, "_pos", "_total")
    total = F.col("_total")
    size = F.floor(total * F.lit(fraction)) if fraction is not None else total - test_rows
    return numbered.withColumn("is_train", F.col("_pos") < size).drop("_pos", "_total")
