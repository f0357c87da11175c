"""The pipelines' input tables, derived from the driver's tables, for Spark and as SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import pin_utc

# Seasonal constants scaled to January 2024.
CUTOFF = "2024-01-08 00:00:00"
PV_FROM = "2024-01-16 00:00:00"
RANGE_START = "2024-01-10 06:00:00"
RANGE_END = "2024-01-20 18:00:00"
NOW = "2024-01-25 12:45:00"
CLIENT = 3

FOLD_DAYS = 5


def _folded_sql(ts: str) -> str:
    days = f"date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', {ts}))"
    return f"{ts} - to_days(CAST({days} - {days} % {FOLD_DAYS} AS INT))"


VIEWS = {
    "energy": """
        SELECT CAST(user_id % 5 AS INT) AS ClientId, ts AS TimeStampMeasured, value * 200.0 AS LoadEnergyCalculated,
               CAST(floor(value * 1000) AS BIGINT) AS PowerFromLoad, CAST(floor(value * 500) AS BIGINT) AS PowerToPv,
               event_id
        FROM events""",
    "measurements": """
        SELECT ClientId, Time, 273.15 + k / 4.0 AS Temperature, k AS Humidity, k % 10 AS Clouds,
               1000 + k % 30 AS Pressure, 2000 + k * 8 AS Visibility, value / 50.0 AS WindSpeed, value * 10.0 AS PowerPV, event_type AS Weather,
               concat(event_type, '_', CAST(k % 4 AS VARCHAR)) AS WeatherDescription,
               date_trunc('day', Time) + INTERVAL 6 HOUR AS SunriseDT,
               date_trunc('day', Time) + INTERVAL 18 HOUR AS SunsetDT, event_id
        FROM (SELECT CAST(user_id % 5 AS INT) AS ClientId, ts AS Time,
                     CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, value, event_type, event_id
              FROM events WHERE event_type IN ('view', 'click', 'error')) m""",
    "weather_forecast": """
        SELECT ClientId, Time, Temperature, Humidity, Humidity % 10 AS Clouds, 1000 + Humidity % 30 AS Pressure,
               2000 + Humidity * 8 AS Visibility, Temperature / 5.0 AS WindSpeed, Weather, WeatherDescription FROM (
          SELECT CAST(user_id % 5 AS INT) AS ClientId, date_trunc('hour', ts) AS Time, value / 10.0 AS Temperature,
                 CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS Humidity, event_type AS Weather,
                 concat(event_type, '_', CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 5 AS VARCHAR))
                   AS WeatherDescription,
                 row_number() OVER (PARTITION BY user_id % 5, date_trunc('hour', ts) ORDER BY ts, event_id) AS rn
          FROM events) q
        WHERE rn = 1""",
    "pv_history": """
        SELECT CAST(user_id % 5 AS INT) AS ClientId, date_trunc('minute', ts) AS Time, value AS SolarPower
        FROM events WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-16 00:00:00'""",
    "clients": """
        SELECT n_nationkey AS Id, n_name AS Code, CAST(n_regionkey * 10.0 AS DOUBLE) AS PlantPvPower
        FROM nation WHERE n_nationkey < 5""",
    "runs": """
        SELECT CAST(o_custkey % 5 AS INT) AS ClientId, o_orderdate AS TrainEnd, o_orderkey AS run_id,
               o_totalprice / 10000.0 AS WMAPE_percent, o_totalprice / 100.0 AS RMSE, o_orderstatus = 'F' AS was_in_use
        FROM orders""",
    # every site's days laid over five days: dense enough for the features that need 24 full bins in a row
    "dense_energy": f"""
        SELECT * REPLACE ({_folded_sql('TimeStampMeasured')} AS TimeStampMeasured) FROM energy""",
    "dense_measurements": f"SELECT * REPLACE ({_folded_sql('Time')} AS Time) FROM measurements",
    "model_files": """
        SELECT concat('model_', CAST(p_partkey % 5 AS VARCHAR), '_v', CAST(p_size AS VARCHAR), '.keras') AS file_name
        FROM part""",
}


def _folded(df: DataFrame, ts: str) -> DataFrame:
    days = F.datediff(F.to_date(ts), F.lit("2024-01-01").cast("date"))
    return df.withColumn(ts, F.col(ts) - F.make_dt_interval(days - days % FOLD_DAYS))


class Tables:
    """Lazy Spark forms of the views; naive UTC timestamps as stored, so that filters reach the scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = pin_utc(spark)
        self.dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def _events(self) -> DataFrame:
        number = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
        return self.raw("events").withColumns({"ClientId": (F.col("user_id") % 5).cast("int"), "k": number})

    @cached_property
    def energy(self) -> DataFrame:
        value = F.col("value")
        return self._events.select(
            "ClientId",
            F.col("ts").alias("TimeStampMeasured"),
            (value * 200.0).alias("LoadEnergyCalculated"),
            F.floor(value * 1000).cast("long").alias("PowerFromLoad"),
            F.floor(value * 500).cast("long").alias("PowerToPv"),
            "event_id",
        )

    @cached_property
    def measurements(self) -> DataFrame:
        day, k = F.date_trunc("DAY", "ts").cast("timestamp_ntz"), F.col("k")
        return self._events.where(F.col("event_type").isin("view", "click", "error")).select(
            "ClientId",
            F.col("ts").alias("Time"),
            (F.lit(273.15) + k / 4.0).alias("Temperature"),
            k.alias("Humidity"),
            (k % 10).alias("Clouds"),
            (1000 + k % 30).alias("Pressure"),
            (2000 + k * 8).alias("Visibility"),
            (F.col("value") / 50.0).alias("WindSpeed"),
            (F.col("value") * 10.0).alias("PowerPV"),
            F.col("event_type").alias("Weather"),
            F.concat("event_type", F.lit("_"), (k % 4).cast("string")).alias("WeatherDescription"),
            (day + F.expr("INTERVAL 6 HOURS")).alias("SunriseDT"),
            (day + F.expr("INTERVAL 18 HOURS")).alias("SunsetDT"),
            "event_id",
        )

    @cached_property
    def dense_energy(self) -> DataFrame:
        return _folded(self.energy, "TimeStampMeasured")

    @cached_property
    def dense_measurements(self) -> DataFrame:
        return _folded(self.measurements, "Time")

    @cached_property
    def weather_forecast(self) -> DataFrame:
        hour = F.date_trunc("HOUR", "ts").cast("timestamp_ntz")
        firsts = F.struct("ts", "event_id", "value", "k", "event_type")
        first = self._events.groupBy("ClientId", hour.alias("Time")).agg(F.min(firsts).alias("f"))
        return first.select(
            "ClientId",
            "Time",
            (F.col("f.value") / 10.0).alias("Temperature"),
            F.col("f.k").alias("Humidity"),
            (F.col("f.k") % 10).alias("Clouds"),
            (1000 + F.col("f.k") % 30).alias("Pressure"),
            (2000 + F.col("f.k") * 8).alias("Visibility"),
            (F.col("f.value") / 10.0 / 5.0).alias("WindSpeed"),
            F.col("f.event_type").alias("Weather"),
            F.concat("f.event_type", F.lit("_"), (F.col("f.k") % 5).cast("string")).alias("WeatherDescription"),
        )

    @cached_property
    def pv_history(self) -> DataFrame:
        until = F.lit(PV_FROM).cast("timestamp_ntz")
        return self._events.where((F.col("event_type") == "purchase") & (F.col("ts") < until)).select(
            "ClientId", F.date_trunc("MINUTE", "ts").cast("timestamp_ntz").alias("Time"), F.col("value").alias("SolarPower")
        )

    @cached_property
    def clients(self) -> DataFrame:
        return self.raw("nation").where("n_nationkey < 5").select(
            F.col("n_nationkey").alias("Id"),
            F.col("n_name").alias("Code"),
            (F.col("n_regionkey") * F.lit(10.0)).alias("PlantPvPower"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        return self.raw("orders").select(
            (F.col("o_custkey") % 5).cast("int").alias("ClientId"),
            F.col("o_orderdate").alias("TrainEnd"),
            F.col("o_orderkey").alias("run_id"),
            (F.col("o_totalprice") / 10000.0).alias("WMAPE_percent"),
            (F.col("o_totalprice") / 100.0).alias("RMSE"),
            (F.col("o_orderstatus") == "F").alias("was_in_use"),
        )

    @cached_property
    def model_files(self) -> DataFrame:
        name = F.concat(
            F.lit("model_"), (F.col("p_partkey") % 5).cast("string"), F.lit("_v"), F.col("p_size").cast("string"), F.lit(".keras")
        )
        return self.raw("part").select(name.alias("file_name"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Named SQL fragments that the oracles share: name -> query text.
FRAGMENTS: dict[str, str] = dict(VIEWS)


def sql(body: str) -> str:
    """A query text with the views and fragments it mentions, directly or not, in front of it."""
    needed: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name, definition in FRAGMENTS.items():
            if name not in (own, *needed) and re.search(rf"\b{name}\b", text):
                visit(definition, name)
                if name not in needed:
                    needed.append(name)

    visit(body)
    # a fragment that names itself is a recursive one
    recursive = any(re.search(rf"\b{n}\b", FRAGMENTS[n]) for n in needed)
    parts = [f"{name} AS ({FRAGMENTS[name]})" for name in needed]
    body = body.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(start):
            return ("WITH RECURSIVE " if recursive else start) + ",\n".join([*parts, body[len(start) :]])
    return (f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)}\n" if parts else "") + body


def check(oracle: str | None = None):
    """Register a query under its function name, with its oracle."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = sql(oracle)
        return build

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, for comparison with an engine that adds in another order."""
    return df.select(
        *[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    )
