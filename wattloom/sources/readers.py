"""Scans. Predicates and projections are plain column expressions on typed literals, so they reach the files
or the database."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattloom.functions import calendar as cal
from wattloom.functions import values as val
from wattloom.operators import filters
from wattloom.sources import schemas

# Fixed values.
PV_INPUTS_FROM = "2025-08-20 00:00:00"
PV_COLUMN = "c23525.pv_power"
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A database table, split on a time column into parallel range queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.options(**(options or {})).load()


def scan_range(
    table: DataFrame,
    ts: str,
    start: datetime | str,
    end: datetime | str,
    client: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows after ``start`` up to ``end``, of one site or of all.

    On a landed table, which is partitioned by ``day``, the range also prunes the partitions.
    """
    rows = filters.half_open_range(table, ts, start, end)
    if "day" in table.columns:
        low, high = (F.to_date(F.lit(bound).cast("timestamp_ntz")) for bound in (start, end))
        rows = rows.where(F.col("day").between(low, high))
    if client is not None:
        rows = rows.where(F.col("ClientId") == client)
    return rows.select(*columns) if columns else rows


def scan_energy_range(energy, client, start, end) -> DataFrame:
    """Load power of one site."""
    return scan_range(energy, "TimeStampMeasured", start, end, client, ["TimeStampMeasured", "PowerFromLoad"])


def scan_energy_range_all_cols(energy, client, start, end) -> DataFrame:
    return scan_range(energy, "TimeStampMeasured", start, end, client)


def scan_energy_range_all_clients(energy, start, end) -> DataFrame:
    return scan_range(energy, "TimeStampMeasured", start, end)


def scan_measurements_range(measurements, client, start, end) -> DataFrame:
    return scan_range(measurements, "Time", start, end, client)


def scan_pv_inputs(
    measurements: DataFrame, forecast: DataFrame, energy: DataFrame, since: str = PV_INPUTS_FROM
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All weather readings, and weather forecasts and metered solar power from a date on (date included)."""
    return (
        measurements,
        forecast.where(F.col("Time") >= filters.at(forecast, "Time", since)),
        energy.where(F.col("TimeStampMeasured") >= filters.at(energy, "TimeStampMeasured", since)).select(
            "ClientId", "TimeStampMeasured", "PowerToPv"
        ),
    )


def scan_json_readings(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Landed records with lower-camel names; names get a capital first letter.

    Whole-array files need ``multi_line`` and are one task each; one record per line can be split.
    """
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("timestampNTZFormat", JSON_TIME)
    return val.capitalise_columns(reader.json(path))


def scan_csv_pv(spark: SparkSession, path: str) -> DataFrame:
    """Solar history with the date and the time in separate text columns."""
    rows = spark.read.schema(schemas.PV_HISTORY_CSV).option("sep", ";").option("header", True).csv(path)
    stamp = F.concat_ws(";", "date", "time")
    return rows.select(
        cal.parse_utc(stamp, cal.FORMATS["minute_key"]).alias("Time"), F.col(f"`{PV_COLUMN}`").alias("SolarPower")
    )


def scan_csv_series(spark: SparkSession, path: str, schema: StructType, timestamp_format: str) -> DataFrame:
    """A series with a header line and day-first (or other) timestamps."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampNTZFormat", timestamp_format)
        .option("timestampFormat", timestamp_format)
        .csv(path)
    )


def scan_trial_scores(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Scored trials of tuner state files."""
    trials = spark.read.schema(schemas.TRIALS).option("multiLine", multi_line).json(path)
    return trials.select(F.explode("trials").alias("trial", "state")).select("trial", "state.score").where(
        F.col("score").isNotNull()
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run table."""
    return spark.read.schema(schemas.RUNS).parquet(path)


def read_run_history(spark: SparkSession, path: str) -> DataFrame:
    """Old run files, each a JSON list or a single object; what is not JSON counts as empty."""
    return spark.read.schema(schemas.RUNS).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
