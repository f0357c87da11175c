"""The published tables after a run: what a new forecast does not replace, and the new forecast.

The functions named ``publish_`` bring a table below ``path`` that is partitioned by ``day`` (``sinks.land_days``) up to date: only days
whose rows change are read and written. The others give the whole table after the run.

Rows that a run replaces go for every site of the run, whether or not a forecast of the site follows: ``sites`` lists them
(``ClientId``); without it they are all sites that have old or new rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.operators import assembly, filters
from wattloom.session import stored
from wattloom.sources import sinks

KEY = ["ClientId"]


def daily_load(old: DataFrame, forecast: DataFrame) -> DataFrame:
    """A site's rows go from the first new instant on. The bound is taken in UTC, where it is unique."""
    new = assembly.shape_load_output(forecast)
    since = stored(new.groupBy(*KEY).agg(F.min("TimeUtc").alias("since")), "since")
    return sinks.replace_from(old, new, since, ts="TimeUtc")


def _sites(old: DataFrame, new: DataFrame, sites: DataFrame | None) -> DataFrame:
    return sites.select(*KEY).distinct() if sites is not None else old.select(*KEY).union(new.select(*KEY)).distinct()


def hourly_load(old: DataFrame, new: DataFrame, now: datetime | str, sites: DataFrame | None = None) -> DataFrame:
    """A site's rows go after the present instant, which itself stays."""
    since = stored(_sites(old, new, sites).withColumn("since", F.lit(now).cast("timestamp_ntz")), "since")
    return sinks.replace_from(old, new, since, strict=True)


def solar(old: DataFrame, forecast: DataFrame, now: datetime | str, sites: DataFrame | None = None) -> DataFrame:
    """A site's last seven days and all later rows go; the new rows of that span come."""
    new = filters.recent_days(sinks.pv_forecast_rows(forecast), "Time", now)
    since = stored(_sites(old, new, sites).withColumn("since", filters.days_before(now)), "since")
    return sinks.replace_from(old, new, since)


def _recent(spark: SparkSession, path: str, day: Column) -> DataFrame:
    """Rows of the published table from a day on."""
    return spark.read.parquet(path).where(F.col("day") >= day)


def publish_daily_load(forecast: DataFrame, path: str) -> None:
    """:func:`daily_load` in place."""
    new = stored(assembly.shape_load_output(forecast), "publish")
    since = stored(new.groupBy(*KEY).agg(F.min("TimeUtc").alias("since")), "since")
    sinks.replace_days(new, since, path, ts="TimeUtc")


def publish_hourly_load(new: DataFrame, path: str, now: datetime | str, sites: DataFrame | None = None) -> None:
    """:func:`hourly_load` in place."""
    new, present = stored(new, "publish"), F.lit(now).cast("timestamp_ntz")
    old = _recent(new.sparkSession, path, F.to_date(present))
    since = stored(_sites(old, new, sites).withColumn("since", present), "since")
    sinks.replace_days(new, since, path, strict=True)


def publish_solar(forecast: DataFrame, path: str, now: datetime | str, sites: DataFrame | None = None) -> None:
    """:func:`solar` in place."""
    new = stored(filters.recent_days(sinks.pv_forecast_rows(forecast), "Time", now), "publish")
    old = _recent(new.sparkSession, path, F.to_date(filters.days_before(now)))
    since = stored(_sites(old, new, sites).withColumn("since", filters.days_before(now)), "since")
    sinks.replace_days(new, since, path)
