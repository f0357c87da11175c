"""Day profiles: clusters of 100-slot days, and forecasts averaged with the shape of their cluster."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.functions import values as val
from wattloom.operators import aggregates as agg
from wattloom.operators import clustering, filters, joins, ordered, transforms
from wattloom.session import stored

# Fixed values.
CLUSTERS = 10
SEED = 42
SLOTS = 100
MIN_DAYS = 10
KEY = ["ClientId"]


def filled_days(series: DataFrame, value: str) -> DataFrame:
    """Absent values take the same slot of the day before, else of the day after, else 0."""
    slotted = agg.densify(series.select(*KEY, "bin", value), KEY).withColumn("slot", cal.slot(F.col("bin")))
    return ordered.fill_across(slotted, [*KEY, "slot"], "bin", value)


def profiles(series: DataFrame, value: str) -> DataFrame:
    """``(ClientId, Date, profile)``: 96 values of a full day and 4 of the next present one."""
    return joins.join_next_day_head(joins.day_arrays(series, KEY, "bin", value), KEY)


def fit_scaler(days: DataFrame) -> DataFrame:
    """Mean and deviation of every slot of a site, as arrays: ``(ClientId, means, stds)``."""
    long = days.select(*KEY, F.posexplode("profile").alias("slot", "value"))
    params = transforms.fit_standard(long, [*KEY, "slot"], ["value"])
    packed = F.sort_array(F.collect_list(F.struct("slot", "value_mean", "value_std")))
    return params.groupBy(*KEY).agg(packed.alias("p")).select(
        *KEY, F.col("p.value_mean").alias("means"), F.col("p.value_std").alias("stds")
    )


def _scaled(profile: Column) -> Column:
    centred = F.zip_with(profile, "means", lambda x, m: x - m)
    return F.zip_with(centred, "stds", lambda x, s: F.when(s == 0, x).otherwise(x / s))


def _unscaled(profile: Column) -> Column:
    spread = F.zip_with(profile, "stds", lambda x, s: F.when(s == 0, x).otherwise(x * s))
    return F.zip_with(spread, "means", lambda x, m: x + m)


def scaled(days: DataFrame, scaler: DataFrame) -> DataFrame:
    return days.join(scaler, KEY).withColumn("features", array_to_vector(_scaled(F.col("profile"))))


def cluster(days: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> tuple[DataFrame, DataFrame, KMeansModel]:
    """Days with their ``cluster``, the scaler table and the model.

    Each site is scaled by its own slots, so shapes of large and small sites can share a cluster. Sites
    with fewer than ten full days are left out.
    """
    enough = filters.with_min_history(days, KEY, MIN_DAYS)
    scaler = stored(fit_scaler(enough), "profile-scaler")
    points = stored(scaled(enough, scaler), "profile-points")
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(points)
    return model.transform(points).select(*KEY, "Date", "profile", "cluster"), scaler, model


def cluster_by_site(days: DataFrame, k: int = CLUSTERS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Days with their ``cluster``, the scaler table and the centroids ``(ClientId, cluster, centroid)``: k-means of each site.

    Sites with fewer than ten full days are left out.
    """
    enough = filters.with_min_history(days, KEY, MIN_DAYS)
    scaler = stored(fit_scaler(enough), "profile-scaler")
    points = stored(enough.join(scaler, KEY).withColumn("features", _scaled(F.col("profile"))).select(*KEY, "Date", "profile", "features"), "profile-points")
    centres = stored(clustering.fit(points, KEY[0], "Date", "features", k), "profile-centres")
    return clustering.assign(points, centres, KEY[0], "features").select(*KEY, "Date", "profile", "cluster"), scaler, centres


def centroids(model: KMeansModel, like: DataFrame) -> DataFrame:
    """``(cluster, centroid)``; one row per cluster."""
    rows = [(i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())]
    return like.sparkSession.createDataFrame(rows, "cluster int, centroid array<double>")


def blend(assigned: DataFrame, centres: DataFrame) -> DataFrame:
    """``(ClientId, Time, lstm_predictions, hybrid_predictions)``: the mean of forecast and centroid per slot.

    Input: forecast days with ``profile``, ``cluster`` and the site's ``means`` and ``stds``. Centres are those of each site, or
    shared ones without ``ClientId``.
    """
    if "ClientId" in centres.columns:
        joined = assigned.join(centres, [*KEY, "cluster"])
    else:
        # one row per cluster: its number is fixed when the model is fitted
        joined = assigned.join(F.broadcast(centres), "cluster")
    hybrid = val.mean_of_arrays(F.col("profile"), _unscaled(F.col("centroid")))
    pairs = F.zip_with("profile", hybrid, lambda p, b: F.struct(p.alias("p"), b.alias("b")))
    start = F.col("Date").cast("timestamp_ntz")
    return joined.select(*KEY, start.alias("_start"), F.posexplode(pairs).alias("_i", "_v")).select(
        *KEY,
        (F.col("_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("_i") * cal.STEP_MINUTES)).alias("Time"),
        F.col("_v.p").alias("lstm_predictions"),
        F.col("_v.b").alias("hybrid_predictions"),
    )


def hybrid_forecast(forecast: DataFrame, scaler: DataFrame, model: KMeansModel | DataFrame, value: str = "Predicted") -> DataFrame:
    """Assign each forecast day to a cluster and average it with the centroid in the site's units.

    ``model``: each site's centroids, or a model shared by all sites.
    """
    days = profiles(forecast.withColumnRenamed("Time", "bin"), value)
    if isinstance(model, DataFrame):
        points = days.join(scaler, KEY).withColumn("features", _scaled(F.col("profile")))
        return blend(clustering.assign(points, model, KEY[0], "features"), model)
    assigned = model.transform(scaled(days, scaler))
    return blend(assigned, centroids(model, forecast))


def hourly(hybrid: DataFrame) -> DataFrame:
    return agg.resample_mean(hybrid, KEY, "Time", ["lstm_predictions", "hybrid_predictions"], 60)
