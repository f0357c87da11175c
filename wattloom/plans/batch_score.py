"""Score all sites with a saved model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattloom.operators import columns
from wattloom.plans import load_daily
from wattloom.sources import readers

# The columns of landed records.
ENERGY_RECORD = "clientId int, timeStampMeasured timestamp_ntz, loadEnergyCalculated double"
WEATHER_RECORD = "clientId int, time timestamp_ntz, temperature double, humidity double"


def save(models: DataFrame, path: str) -> None:
    """Coefficients per site; a version has its own folder."""
    models.write.mode("errorifexists").parquet(path)


def score(spark: SparkSession, path: str, table: DataFrame) -> DataFrame:
    """Align the columns to the model's inputs, then 96 + 4 steps for every site that has a model."""
    models = spark.read.parquet(path)
    aligned = columns.align_columns(table, ["ClientId", "bin", *load_daily.inputs(), "usable"])
    return load_daily.forecast_from(aligned, models)


def score_records(
    spark: SparkSession, path: str, energy_path: str, weather_path: str, multi_line: bool = False, **settings
) -> DataFrame:
    """From landed JSON records of energy and weather to the forecast of every site that has a model."""
    energy = readers.scan_json_readings(spark, energy_path, ENERGY_RECORD, multi_line)
    weather = readers.scan_json_readings(spark, weather_path, WEATHER_RECORD, multi_line)
    return score(spark, path, load_daily.supervised(energy, weather, **settings))
