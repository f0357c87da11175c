"""Model runs: the version in use, the newest version, and whether a new run replaces it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions import values as val

# Fixed values.
WMAPE_FACTOR = 0.99
RMSE_FACTOR = 1.01
KEY = ["ClientId"]


def latest_in_use(runs: DataFrame, tie: str | None = None) -> DataFrame:
    """The newest run in use per site; runs without a readable date come last."""
    order = [F.desc_nulls_last("TrainEnd"), *([F.desc(tie)] if tie else [])]
    w = Window.partitionBy(*KEY).orderBy(*order)
    return runs.where("was_in_use").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def champion_gate(challengers: DataFrame, champions: DataFrame) -> DataFrame:
    """Decide ``accepted``: nothing in use yet, or clearly better WMAPE at a hardly worse RMSE."""
    old = champions.select(*KEY, F.col("WMAPE_percent").alias("old_wmape"), F.col("RMSE").alias("old_rmse"))
    better = (F.col("WMAPE_percent") < WMAPE_FACTOR * F.col("old_wmape")) & (
        F.col("RMSE") <= RMSE_FACTOR * F.col("old_rmse")
    )
    unrivalled = F.col("old_wmape").isNull() & F.col("old_rmse").isNull()
    return challengers.join(old, KEY, "left").withColumn("accepted", unrivalled | F.coalesce(better, F.lit(False)))


def latest_version(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Greatest integer version of each site's model files and the next free one; other names are ignored."""
    parsed = files.select(val.client_of(F.col(name)).alias("ClientId"), val.version_of(F.col(name)).alias("version"))
    known = parsed.where(F.col("ClientId").isNotNull() & F.col("version").isNotNull())
    newest = F.max("version")
    return known.groupBy(*KEY).agg(newest.alias("latest_version"), (newest + 1).alias("next_version"))


def latest_dated(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Greatest date in model file names, per text before the date."""
    dated = files.withColumn("model_date", val.date_of(F.col(name))).where(F.col("model_date").isNotNull())
    family = F.regexp_extract(name, r"^(.*)_\d{4}-\d{2}-\d{2}", 1)
    return dated.groupBy(family.alias("family")).agg(F.max("model_date").alias("model_date"))
