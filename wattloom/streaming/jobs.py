"""Structured Streaming jobs. They stop when all available input is done, so a scheduler can start them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wattloom.functions import calendar as cal
from wattloom.plans import load_daily
from wattloom.sources import sinks

# Fixed values.
LATENESS = "10 minutes"

FILES_PER_DAY = 4
# Compacted states of a published table; a hidden folder to plain readers of the batches.
STATES = "_states"


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def resampled(readings: DataFrame, ts: str, value: str, width: int = cal.STEP_MINUTES, late: str = LATENESS) -> DataFrame:
    """Sum, mean and count per site and bin; a bin is emitted once the watermark has passed its end.

    Readings later than that are dropped; :func:`incremental_bins` takes them in.
    """
    timed = readings.withColumn(ts, F.col(ts).cast("timestamp"))
    window = F.window(ts, f"{width} minutes")
    return (
        timed.withWatermark(ts, late)
        .groupBy("ClientId", window)
        .agg(F.sum(value).alias("total"), F.avg(value).alias("mean"), F.count(value).alias("readings"))
        .select("ClientId", F.col("window.start").cast("timestamp_ntz").alias("bin"), "total", "mean", "readings")
    )


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def publish_batches(forecasts: DataFrame, path: str, checkpoint: str) -> None:
    """Write every micro-batch of forecasts into its own folder; a repeated batch overwrites itself.

    Batches are numbered by the checkpoint: a stream that starts over without it, after a compaction, needs another path.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        forecasts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _numbered(spark: SparkSession, path: str, name: str, complete: bool) -> list[int]:
    """Numbers n of the folders ``<name>=<n>`` below ``path``, ascending; if asked, of those whose write has ended."""
    place, system = sinks.folder(spark, path)
    if not system.exists(place):
        return []
    found = []
    for status in system.listStatus(place):
        folder = status.getPath()
        ended = not complete or system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS"))
        if folder.getName().startswith(f"{name}=") and ended:
            found.append(int(folder.getName().split("=")[1]))
    return sorted(found)


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What :func:`publish_batches` wrote, with ``batch_id``: the newest compacted state, and the batches after it.

    ``schema`` is that of a batch. Good at any moment of a compaction: a state counts once it is complete, and the batches it
    stands for stay until the next one.
    """
    states = _numbered(spark, f"{path}/{STATES}", "upto", True)
    newer = [b for b in _numbered(spark, path, "batch_id", True) if not states or b > states[-1]]
    whole = StructType([*schema.fields, StructField("batch_id", LongType())])
    parts = [spark.read.schema(whole).parquet(f"{path}/{STATES}/upto={states[-1]}")] if states else []
    # one scan of all newer batches; their number goes back to few with each compaction
    if newer:
        parts.append(spark.read.schema(whole).option("basePath", path).parquet(*[f"{path}/batch_id={b}" for b in newer]))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], whole)


def compact_batches(spark: SparkSession, path: str, schema: StructType) -> int | None:
    """Write what is live of all batches so far as one state, and remove what the state before it stood for.

    The state is named by its last batch, so a repeated run writes the same folder again. Returns that batch, or None without new batches.
    Only one compaction of a table may run at a time.
    """
    states, batches = _numbered(spark, f"{path}/{STATES}", "upto", True), _numbered(spark, path, "batch_id", True)
    if not batches or states and batches[-1] <= states[-1]:
        return None
    current_forecast(read_batches(spark, path, schema)).write.mode("overwrite").parquet(f"{path}/{STATES}/upto={batches[-1]}")
    if states:
        gone = [f"{path}/batch_id={b}" for b in batches if b <= states[-1]] + [f"{path}/{STATES}/upto={s}" for s in states[:-1]]
        for old in gone:
            place, system = sinks.folder(spark, old)
            system.delete(place, True)
    return batches[-1]


def current_forecast(batches: DataFrame, ts: str = "Time", key: str = "ClientId") -> DataFrame:
    """What remains after each batch replaced its sites' rows from its first instant on.

    A row is live while no later batch of its site starts at or before it. Only the starts, one per site and
    batch, pass through a window.
    """
    starts = batches.groupBy(key, "batch_id").agg(F.min(ts).alias("_start"))
    later = Window.partitionBy(key).orderBy("batch_id").rowsBetween(1, Window.unboundedFollowing)
    ends = starts.select(key, "batch_id", F.min("_start").over(later).alias("_end"))
    live = F.col("_end").isNull() | (F.col(ts) < F.col("_end"))
    return batches.join(ends, [key, "batch_id"]).where(live).drop("_end")


def _overwrite_partitions(df: DataFrame, by: list[str], path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def incremental_bins(
    readings: DataFrame,
    landed: str,
    bins: str,
    checkpoint: str,
    cutoff: str,
    files_per_day: int = FILES_PER_DAY,
    **names,
) -> None:
    """Keep the table of bin states up to date as readings arrive.

    A bin's state depends on its own readings only, so each micro-batch lands its rows by day and
    recomputes the days it touched, late rows included. What needs the order of bins (carried values, gaps,
    lags) is left to the batch job, which reads this small table instead of the readings. A repeated batch
    rewrites the same partitions.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        by_day = batch.withColumns({"day": F.to_date("TimeStampMeasured"), "batch_id": F.lit(batch_id)}).persist()
        try:
            _overwrite_partitions(by_day, ["day", "batch_id"], landed)
            # the days it touched, and no others: a late row does not reach over the days since
            days = [r["day"] for r in by_day.select("day").where("day IS NOT NULL").distinct().collect()]
        finally:
            by_day.unpersist()
        if not days:
            return
        history = spark.read.parquet(landed).where(F.col("day").isin(days))
        states = load_daily.bin_states(history, cutoff, **names).withColumn("day", F.to_date("bin"))
        spread = states.repartition("day", F.pmod(F.hash("ClientId"), F.lit(files_per_day)))
        _overwrite_partitions(spread, ["day"], bins)

    query = (
        readings.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def series_from_states(states: DataFrame) -> DataFrame:
    return load_daily.series_from_bins(load_daily.bin_sums(states.drop("day")))
