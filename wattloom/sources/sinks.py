"""Writers. A result goes into a fresh folder or is appended; nothing is deleted before its successor exists."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions import values as val
from wattloom.operators import columns, sets
from wattloom.session import stored
from wattloom.sources import schemas

# Fixed value.
JDBC_BATCH = 100
# A day of all sites is spread over so many files at most.
FILES_OF_A_DAY = 2


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, options: dict[str, str] | None = None) -> None:
    """Batched inserts."""
    (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", JDBC_BATCH)
        .options(**(options or {}))
        .mode("append")
        .save()
    )


def load_forecast_rows(forecast: DataFrame) -> DataFrame:
    """Model columns to the columns of the load forecast table."""
    return forecast.select(
        F.col("Time").cast("timestamp_ntz").alias("Time"),
        "ClientId",
        val.to_whole(F.col("lstm_predictions")).alias("LSTMLoadPower"),
        val.to_whole(F.col("hybrid_predictions")).alias("HybridLoadPower"),
    )


def pv_forecast_rows(forecast: DataFrame, value: str = "SolarPower_pred") -> DataFrame:
    return forecast.select("Time", "ClientId", val.to_whole(F.col(value)).alias("PVProductionPower"))


def replace_from(
    old: DataFrame, new: DataFrame, since: DataFrame, ts: str = "Time", key: str = "ClientId", strict: bool = False
) -> DataFrame:
    """The old rows that a new forecast does not replace, and the new ones.

    ``since`` gives each site's first replaced instant (``key, since``). That instant itself goes too,
    unless ``strict``. Sites without an entry keep everything.
    """
    replaced = F.col(ts) > F.col("since") if strict else F.col(ts) >= F.col("since")
    kept = old.join(since, key, "left").where(F.col("since").isNull() | ~replaced).select(*old.columns)
    return sets.union_all(kept, new)


def write_version(df: DataFrame, root: str, version: str) -> str:
    """Write a table version into its own folder; readers switch to it once this returns."""
    path = f"{root}/{version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def land_days(rows: DataFrame, path: str, ts: str = "Time") -> None:
    """A table that :func:`replace_days` keeps up to date: partitioned by ``day``, one file a day and task."""
    by_day = rows.withColumn("day", F.to_date(ts))
    by_day.repartition("day", F.pmod(F.xxhash64(*rows.columns), F.lit(FILES_OF_A_DAY))).write.partitionBy("day").parquet(path)


def replace_days(new: DataFrame, since: DataFrame, path: str, ts: str = "Time", key: str = "ClientId", strict: bool = False) -> None:
    """:func:`replace_from` in a table below ``path`` that is partitioned by ``day``: only days whose rows change are rewritten.

    Days before the first replaced instant are neither read nor written. The rows of a changed day are stored before its folder is
    overwritten, so a run that fails in between can be repeated; a day that loses all its rows loses its folder.
    """
    spark = new.sparkSession
    first = since.agg(F.min(F.to_date("since"))).first()[0]
    fresh = new.withColumn("day", F.to_date(ts))
    low = fresh.agg(F.min("day")).first()[0]
    first = min((d for d in (first, low) if d is not None), default=None)
    if first is None:
        return
    old = spark.read.schema(fresh.schema).parquet(path).where(F.col("day") >= F.lit(first)) if _exists(spark, path) else fresh.limit(0)
    replaced = F.col(ts) > F.col("since") if strict else F.col(ts) >= F.col("since")
    gone = old.join(since, key).where(replaced).select("day")
    days = [r["day"] for r in gone.union(fresh.select("day")).distinct().collect()]  # a row for each changed day
    changed = replace_from(old.where(F.col("day").isin(days)), fresh, since, ts, key, strict)
    rows = stored(changed, "changed-days")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    left = {r["day"] for r in rows.select("day").distinct().collect()}
    for day in set(days) - left:
        place, system = folder(spark, f"{path}/day={day}")
        system.delete(place, True)


def claim_version(spark: SparkSession, root: str, latest: int, name: str = "v") -> int:
    """The next free version above ``latest``, claimed for this run: two runs never get the same one.

    A claim is an empty file below ``root`` that is created only if it is absent, which file systems decide atomically; who
    comes second tries the next number.
    """
    version = latest + 1
    while not _create_absent(spark, f"{root}/_claims/{name}{version}"):
        version += 1
    return version


def _create_absent(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there."""
    place, system = folder(spark, path)
    system.mkdirs(place.getParent())
    jvm = spark.sparkContext._jvm
    if system.getScheme() == "file":  # whose create() looks first and creates then
        return jvm.java.io.File(place.toUri().getPath()).createNewFile()
    try:
        system.create(place, False).close()
        return True
    except Py4JJavaError as error:
        if system.exists(place):
            return False
        raise error


def folder(spark: SparkSession, path: str):
    """A path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    place, system = folder(spark, path)
    return system.exists(place)


def land_readings(df: DataFrame, path: str, ts: str, files: int = 32) -> None:
    """Partition by day, split and sort by site and time.

    Splitting by ranges of (day, site, time) gives files of equal size even if one site dominates, and lets
    row-group statistics prune by site.
    """
    by_day = df.withColumn("day", F.to_date(ts))
    (
        by_day.repartitionByRange(files, "day", "ClientId", ts)
        .sortWithinPartitions("day", "ClientId", ts)
        .write.mode("append")
        .partitionBy("day")
        .parquet(path)
    )


def land_bucketed(df: DataFrame, table: str, path: str, ts: str, buckets: int) -> None:
    """A catalog table whose files are already split by site and day.

    Operators that order readings inside a site and a day (or a part of it) then read without a shuffle. A
    site that owns most rows is spread over its days.
    """
    (
        df.withColumn("day", F.to_date(ts))
        .repartition(buckets, "ClientId", "day")
        .write.mode("append")
        .option("path", path)
        .bucketBy(buckets, "ClientId", "day")
        .sortBy("ClientId", "day", ts)
        .saveAsTable(table)
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_once(df: DataFrame, path: str) -> None:
    """Only if nothing is there yet."""
    df.write.mode("ignore").parquet(path)


def append_run_metrics(runs: DataFrame, path: str, latest_csv: str | None = None) -> None:
    """More entries in the run table; the newest ones also alone, as CSV."""
    append(columns.cast_to(runs, schemas.RUNS), path)
    if latest_csv:
        write_csv(runs, latest_csv, "overwrite")


def read_back(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)
