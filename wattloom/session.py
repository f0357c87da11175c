"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wattloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Series are keyed by naive UTC instants, so the session zone must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    It is named in ``spark.checkpoint.dir``. Only a session whose executors are threads of the driver (``local``,
    ``local[n]``), as in tests, gets a folder of its own without that setting: a machine-local path would be lost with
    its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="wattloom-")
        context.setCheckpointDir(root)
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's part of the shared work folder, which can go when the run is over."""
    return f"{work_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Remove this application's copies from the work folder; call it when no result that reads them is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{work_root(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Unlike a checkpoint the columnar copy keeps column pruning and filter pushdown for its readers, and its
    size is known to the planner: state of one row per site (bounds, scalers, cut-overs, models) is stored
    before it meets the readings, so that it is broadcast if and only if it is small. The readings are then
    not shuffled by site, where one site may own a third of them; beyond the threshold the join shuffles
    and splits skewed partitions.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
