"""Sinks, forecast assembly, streams and the forecasting jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks.series import KEY, TIME, VALUE, energy_series
from checks.tables import CUTOFF, FRAGMENTS, NOW, PV_FROM, Tables, check, rounded
from wattloom.functions import calendar as cal
from wattloom.operators import aggregates as agg
from wattloom.operators import assembly, boosting, columns, filters, metrics, ordered, sets, windows
from wattloom.plans import batch_score as saved_models
from wattloom.plans import load_daily, load_hourly, profiles, publish, slots, solar_daily, sweep
from wattloom.session import stored, work_path
from wattloom.sources import readers, schemas, sinks
from wattloom.streaming import jobs

TARGET = load_daily.TARGET



def season_sql(month: str) -> str:
    return f"(CASE WHEN {month} IN (12, 1, 2) THEN 1 WHEN {month} IN (3, 4, 5) THEN 2 WHEN {month} IN (6, 7, 8) THEN 3 ELSE 4 END)"


def ridge_sql(name: str, pairs: str, keys: list[str], features: int, targets: int, ridge: float, min_rows: int) -> None:
    """Fragments that solve ridge regressions: ``pairs`` has the keys, x and y as lists; ``<name>_weights`` the keys, b and w per target.

    Moments of all columns, then elimination of the standardised features, one per step.
    """
    k, size = ", ".join(keys), features + targets
    on = " AND ".join(f"a.{c} = b.{c}" for c in keys)
    FRAGMENTS[f"{name}_means"] = f"""
        SELECT {k}, count(*) AS n, [{", ".join(f"avg(z[{i}])" for i in range(1, size + 1))}] AS m
        FROM (SELECT {k}, list_concat(x, y) AS z FROM {pairs}) q GROUP BY {k} HAVING count(*) >= {min_rows}"""
    FRAGMENTS[f"{name}_moments"] = f"""
        SELECT {", ".join("a." + c for c in keys)}, i, list(avg_ij - m[i] * m[j] ORDER BY j) AS row, any_value(m) AS m, any_value(n) AS n FROM (
          SELECT {k}, CAST(i AS INT) AS i, CAST(j AS INT) AS j, avg(z[i] * z[j]) AS avg_ij
          FROM (SELECT {k}, list_concat(x, y) AS z FROM {pairs}) q, generate_series(1, {features}) gi(i), generate_series(1, {size}) gj(j)
          GROUP BY {k}, i, j) a JOIN {name}_means b ON {on} GROUP BY {", ".join("a." + c for c in keys)}, i"""
    FRAGMENTS[f"{name}_spread"] = f"""
        SELECT {k}, any_value(m) AS m, any_value(n) AS n, list(row ORDER BY i) AS c,
               list((CASE WHEN sqrt(greatest(row[i], 0)) > 1e-9 * greatest(1.0, abs(m[i])) THEN sqrt(row[i]) ELSE 'inf'::DOUBLE END) ORDER BY i) AS sd
        FROM {name}_moments GROUP BY {k}"""
    FRAGMENTS[f"{name}_steps"] = f"""
        SELECT {k}, 0 AS step, m, sd, list_transform(c, lambda r, i: list_transform(r, lambda v, j: CASE WHEN j <= {features}
                 THEN v / (sd[i] * sd[j]) + CASE WHEN i = j THEN {ridge} / n ELSE 0 END ELSE v / sd[i] END)) AS a FROM {name}_spread
        UNION ALL
        SELECT {k}, step + 1, m, sd, list_transform(a, lambda r, i: CASE WHEN i = step + 1 THEN list_transform(r, lambda v: v / r[step + 1])
                 ELSE list_transform(r, lambda v, j: v - r[step + 1] * a[step + 1][j] / a[step + 1][step + 1]) END)
        FROM {name}_steps WHERE step < {features}"""
    FRAGMENTS[f"{name}_weights"] = f"""
        SELECT {k}, list_transform(w, lambda u, t: m[{features} + t] - list_sum(list_transform(u, lambda v, i: v * m[i]))) AS b, w FROM (
          SELECT {k}, m, list_transform(range(1, {targets + 1}), lambda t: list_transform(a, lambda r, i: r[{features} + t] / sd[i])) AS w
          FROM {name}_steps WHERE step = {features}) q"""


# ---- sinks

FRAGMENTS["latest_power"] = f"""
    SELECT ClientId, arg_max(PowerFromLoad, {TIME}) AS power FROM energy WHERE {TIME} <= TIMESTAMP '{NOW}' GROUP BY 1"""

HOUR_SQL = f"""
    SELECT ClientId, TIMESTAMP '{NOW}' + to_minutes(15 * CAST(i AS INT)) AS Time,
           CAST(round(power * (0.5 + i / 4.0)) AS BIGINT) AS LoadPower FROM latest_power, generate_series(1, 4) g(i)"""


def _hour_rows(t: Tables):
    last = filters.asof_last_row(t.energy.select("ClientId", TIME, "PowerFromLoad"), KEY, TIME, NOW)
    steps = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.col("PowerFromLoad") * (0.5 + i / 4.0))
    return assembly.hourly_rows(last.withColumn("predictions", steps), F.lit(NOW).cast("timestamp_ntz"))


@check(HOUR_SQL)
def future_grid_1h(t: Tables):
    return _hour_rows(t)


@check(f"{HOUR_SQL} UNION ALL {HOUR_SQL}")
def append_forecast_1h(t: Tables):
    """Appended twice."""
    path, rows = work_path(t.spark, "load-1h"), _hour_rows(t)
    sinks.append(rows, path)
    sinks.append(rows, path)
    return sinks.read_back(t.spark, path, rows)


@check(f"""
    SELECT {TIME} AS Time, ClientId, CAST(round({VALUE}) AS BIGINT) AS LSTMLoadPower,
           CAST(round({VALUE} / 3) AS BIGINT) AS HybridLoadPower FROM energy""")
def append_load_forecast(t: Tables):
    forecast = t.energy.select(
        "ClientId", F.col(TIME).alias("Time"), F.col(VALUE).alias("lstm_predictions"), (F.col(VALUE) / 3).alias("hybrid_predictions")
    )
    path, rows = work_path(t.spark, "load"), sinks.load_forecast_rows(forecast)
    sinks.append(rows, path)
    return sinks.read_back(t.spark, path, rows)


@check("SELECT Time, ClientId, CAST(round(PowerPV) AS BIGINT) AS PVProductionPower FROM measurements")
def append_pv_forecast(t: Tables):
    rows = sinks.pv_forecast_rows(t.measurements.withColumnRenamed("PowerPV", "SolarPower_pred"))
    path = work_path(t.spark, "pv")
    sinks.append(rows, path)
    return sinks.read_back(t.spark, path, rows)


FRAGMENTS["replaced"] = f"""
    SELECT ClientId, min({TIME}) AS since FROM energy WHERE {TIME} >= TIMESTAMP '{PV_FROM}' AND ClientId < 4 GROUP BY 1"""


def _replace_sql(flag: str, kept: str) -> str:
    return f"""
        SELECT {flag} AS strict, e.ClientId, e.{TIME} AS Time, e.PowerFromLoad AS LoadPower FROM energy e
        LEFT JOIN replaced r ON e.ClientId = r.ClientId WHERE r.since IS NULL OR e.{TIME} {kept} r.since
        UNION ALL SELECT {flag}, e.ClientId, e.{TIME}, e.PowerToPv FROM energy e JOIN replaced r ON e.ClientId = r.ClientId
        WHERE e.{TIME} >= r.since"""


@check(f"{_replace_sql('false', '<')} UNION ALL {_replace_sql('true', '<=')}")
def replace_forecast_from(t: Tables):
    """Four of five sites are replaced; with the bound removed and with the bound kept."""
    old = t.energy.select("ClientId", F.col(TIME).alias("Time"), F.col("PowerFromLoad").alias("LoadPower"))
    start = filters.at(old, "Time", PV_FROM)
    since = old.where((F.col("Time") >= start) & (F.col("ClientId") < 4)).groupBy("ClientId").agg(F.min("Time").alias("since"))
    since = stored(since, "since")
    new = t.energy.select("ClientId", F.col(TIME).alias("Time"), F.col("PowerToPv").alias("LoadPower"))
    fresh = new.join(since, "ClientId").where(F.col("Time") >= F.col("since")).drop("since")
    root = work_path(t.spark, "replaced")
    parts = []
    for strict in (False, True):
        path = f"{root}/{int(strict)}"
        sinks.land_days(old, path)
        sinks.replace_days(fresh, since, path, strict=strict)
        parts.append(t.spark.read.parquet(path).drop("day").withColumn("strict", F.lit(strict)))
    return sets.union_all(*parts)


@check(f"SELECT ClientId, event_id, {VALUE}, PowerFromLoad FROM energy")
def write_csv_snapshot(t: Tables):
    path, rows = work_path(t.spark, "snapshot"), t.energy.select("ClientId", "event_id", VALUE, "PowerFromLoad")
    sinks.write_csv(rows, path)
    return t.spark.read.schema(rows.schema).option("header", True).csv(path)


@check("SELECT event_id, value FROM events")
def write_once(t: Tables):
    """The second write finds the first and leaves it."""
    path, rows = work_path(t.spark, "once"), t.raw("events").select("event_id", "value")
    sinks.write_once(rows, path)
    sinks.write_once(rows.withColumn("value", F.col("value") * 0), path)
    return sinks.read_back(t.spark, path, rows)


@check("SELECT * FROM clients UNION ALL SELECT max(Id) + 1, 'new', 12.5 FROM clients")
def append_client(t: Tables):
    path = work_path(t.spark, "clients")
    sinks.append(t.clients, path)
    new = t.clients.agg((F.max("Id") + 1).alias("Id"), F.lit("new").alias("Code"), F.lit(12.5).alias("PlantPvPower"))
    sinks.append(new, path)
    return sinks.read_back(t.spark, path, t.clients)


@check("""
    SELECT ClientId, strftime(TrainEnd, '%Y-%m-%d') AS TrainEnd, WMAPE_percent, RMSE, was_in_use FROM runs
    UNION ALL SELECT ClientId, 'latest', max(WMAPE_percent), max(RMSE), false FROM runs GROUP BY 1""")
def append_run_metrics(t: Tables):
    path = work_path(t.spark, "runs")
    names = ["ClientId", "TrainEnd", "WMAPE_percent", "RMSE", "was_in_use"]
    history = t.runs.withColumn("TrainEnd", F.date_format("TrainEnd", "yyyy-MM-dd")).select(names)
    latest = t.runs.groupBy("ClientId").agg(
        F.lit("latest").alias("TrainEnd"),
        F.max("WMAPE_percent").alias("WMAPE_percent"),
        F.max("RMSE").alias("RMSE"),
        F.lit(False).alias("was_in_use"),
    )
    sinks.append_run_metrics(history, path)
    sinks.append_run_metrics(latest.select(names), path)
    return readers.read_runs(t.spark, path).select(names)


# ---- assembly

FRAGMENTS["last_day"] = f"""
    SELECT ClientId, 97 - rn AS h, {TARGET} AS p FROM (
      SELECT *, row_number() OVER (PARTITION BY ClientId ORDER BY bin DESC) AS rn FROM load_15m) q WHERE rn <= 96"""
FRAGMENTS["day_ahead"] = f"""
    SELECT d.ClientId, d.h, l.final + to_minutes(15 * CAST(d.h AS INT)) AS Timestamp, d.p AS LoadEnergyForecast_15
    FROM last_day d JOIN (SELECT ClientId, max(bin) AS final FROM load_15m GROUP BY 1) l ON d.ClientId = l.ClientId"""
FRAGMENTS["day_ahead_held"] = """
    SELECT ClientId, Timestamp, LoadEnergyForecast_15 FROM day_ahead
    UNION ALL SELECT ClientId, Timestamp + to_minutes(15 * CAST(i AS INT)), LoadEnergyForecast_15
    FROM day_ahead, generate_series(1, 4) g(i) WHERE h = 96"""


def _day_ahead(t: Tables):
    """The last day repeated, as a forecast whose values are known."""
    series = stored(energy_series(t), "series")
    tail = ordered.sequence_tail(series, KEY, [F.desc("bin")], 96)
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy("bin"))
    steps = tail.select("ClientId", place.alias("h"), F.col(TARGET).alias(load_daily.FORECAST))
    return assembly.on_future_grid(assembly.future_grid(series, KEY, "bin"), steps, KEY, load_daily.FORECAST)


@check("SELECT ClientId, h, Timestamp, round(LoadEnergyForecast_15, 6) AS LoadEnergyForecast_15 FROM day_ahead")
def future_grid_96(t: Tables):
    return rounded(_day_ahead(t))


@check("SELECT ClientId, Timestamp, round(LoadEnergyForecast_15, 6) AS LoadEnergyForecast_15 FROM day_ahead_held")
def hold_last_4(t: Tables):
    return rounded(assembly.hold_last(_day_ahead(t), KEY, "Timestamp", load_daily.FORECAST))


@check("""
    SELECT ClientId, timezone('Europe/Ljubljana', timezone('UTC', Timestamp)) AS Time, Timestamp AS TimeUtc,
           CAST(round(LoadEnergyForecast_15) AS BIGINT) AS LSTMLoadPower, 0 AS HybridLoadPower FROM day_ahead_held""")
def shape_load_output(t: Tables):
    return assembly.shape_load_output(assembly.hold_last(_day_ahead(t), KEY, "Timestamp", load_daily.FORECAST))


def _published(t: Tables, old: DataFrame, ts: str, run: Callable[[str], None]) -> DataFrame:
    """The published table after a run that brings it up to date in place."""
    path = work_path(t.spark, "published")
    sinks.land_days(old, path, ts)
    run(path)
    return t.spark.read.parquet(path).drop("day")


@check(f"""
    WITH fresh AS (SELECT ClientId, Timestamp, LoadEnergyForecast_15 AS p FROM day_ahead_held),
    since AS (SELECT ClientId, min(Timestamp) AS since FROM fresh GROUP BY 1),
    old AS (SELECT ClientId, {TIME} + INTERVAL 5 DAY AS at, PowerFromLoad AS v FROM energy)
    SELECT o.ClientId, o.at AS TimeUtc, timezone('Europe/Ljubljana', timezone('UTC', o.at)) AS Time, o.v AS LSTMLoadPower
    FROM old o JOIN since s ON o.ClientId = s.ClientId WHERE o.at < s.since
    UNION ALL SELECT ClientId, Timestamp, timezone('Europe/Ljubljana', timezone('UTC', Timestamp)), CAST(round(p) AS BIGINT)
    FROM fresh""")
def publish_daily_load(t: Tables):
    """Old rows reach five days beyond the readings; those the new forecast covers go."""
    ahead = assembly.hold_last(_day_ahead(t), KEY, "Timestamp", load_daily.FORECAST)
    old = t.energy.select("ClientId", (F.col(TIME) + F.expr("INTERVAL 5 DAYS")).alias("TimeUtc"), F.col("PowerFromLoad").alias("LSTMLoadPower"))
    old = old.withColumns({"Time": cal.to_local(F.col("TimeUtc")), "HybridLoadPower": F.lit(0).cast("long")})
    rows = _published(t, old, "TimeUtc", lambda path: publish.publish_daily_load(ahead, path))
    return rows.select("ClientId", "TimeUtc", "Time", "LSTMLoadPower")


@check(f"""
    SELECT ClientId, {TIME} AS Time, PowerFromLoad AS LoadPower FROM energy WHERE {TIME} <= TIMESTAMP '{NOW}'
    UNION ALL {HOUR_SQL}""")
def publish_hourly_load(t: Tables):
    old = t.energy.select("ClientId", F.col(TIME).alias("Time"), F.col("PowerFromLoad").alias("LoadPower"))
    return _published(t, old, "Time", lambda path: publish.publish_hourly_load(_hour_rows(t), path, NOW))


WEEK_START = f"""timezone('UTC', timezone('Europe/Ljubljana',
      date_trunc('day', timezone('Europe/Ljubljana', timezone('UTC', TIMESTAMP '{NOW}'))) - INTERVAL 7 DAY))"""


@check(f"""
    SELECT ClientId, {TIME} AS Time, PowerToPv AS PVProductionPower FROM energy WHERE {TIME} < {WEEK_START}
    UNION ALL SELECT ClientId, Time, CAST(round(PowerPV) AS BIGINT) FROM measurements WHERE Time >= {WEEK_START}""")
def publish_solar(t: Tables):
    old = t.energy.select("ClientId", F.col(TIME).alias("Time"), F.col("PowerToPv").alias("PVProductionPower"))
    forecast = t.measurements.select("ClientId", "Time", F.col("PowerPV").alias("SolarPower_pred"))
    return _published(t, old, "Time", lambda path: publish.publish_solar(forecast, path, NOW))


@check("""
    WITH spine AS (SELECT Id AS ClientId, strftime(TIMESTAMP '2024-01-01' + to_minutes(15 * CAST(i AS INT)), '%H:%M:%S') AS slot
                   FROM clients, generate_series(0, 95) g(i)),
    seen AS (SELECT ClientId, strftime(bin, '%H:%M:%S') AS slot, avg(ConsumerPower1) AS p FROM power_means
             GROUP BY 1, 2 HAVING count(*) >= 14)
    SELECT s.ClientId, s.slot, round(coalesce(p, 0), 6) AS Predicted FROM spine s
    LEFT JOIN seen ON s.ClientId = seen.ClientId AND s.slot = seen.slot""")
def default_zero_slots(t: Tables):
    """Means of slots with at least 14 days; the others have no prediction."""
    slotted = slots.load_series(t.energy).withColumn("slot", cal.slot(F.col("bin")))
    seen = slotted.groupBy("ClientId", "slot").agg(F.avg(slots.TARGET).alias("Predicted"), F.count(F.lit(1)).alias("n"))
    sites = t.clients.select(F.col("Id").alias("ClientId"))
    return rounded(assembly.default_zero_slots(seen.where("n >= 14"), sites, KEY, agg.day_slots(), "Predicted"))


@check(f"""
    WITH tail AS (
      SELECT ClientId, bin AS Time, Temperature, false AS is_serving FROM (
        SELECT *, row_number() OVER (PARTITION BY ClientId ORDER BY bin DESC) AS rn FROM sky_15m
        WHERE bin < TIMESTAMP '{PV_FROM}') q WHERE rn <= 1152),
    served AS (SELECT ClientId, Time, Temperature, true FROM weather_forecast WHERE Time >= TIMESTAMP '{PV_FROM}'),
    lagged AS (SELECT *, lag(Temperature, 24) OVER (PARTITION BY ClientId ORDER BY Time) AS lag_24
               FROM (SELECT * FROM tail UNION ALL SELECT * FROM served) u)
    SELECT ClientId, Time, round(Temperature, 6) AS Temperature, round(lag_24, 6) AS lag_24 FROM lagged WHERE is_serving""")
def align_serving_tail(t: Tables):
    """The last 1152 bins before the served rows give these their lags and are dropped again."""
    history = load_daily.weather_series(t.measurements).withColumnRenamed("bin", "Time")
    before = history.where(F.col("Time") < filters.at(history, "Time", PV_FROM))
    tail = ordered.sequence_tail(before, KEY, [F.desc("Time")], solar_daily.CONTEXT_ROWS)
    served = t.weather_forecast.where(F.col("Time") >= filters.at(t.weather_forecast, "Time", PV_FROM))
    names = ["ClientId", "Time", "Temperature"]
    both = sets.union_all(
        tail.select(names).withColumn("is_serving", F.lit(False)), served.select(names).withColumn("is_serving", F.lit(True))
    )
    lagged = ordered.neighbour_columns(both, KEY, ["Time"], {"lag_24": ("Temperature", 24)}, None)
    return rounded(assembly.serving_rows(lagged))


# ---- streams


@check(f"""
    SELECT ClientId, time_bucket(INTERVAL 15 MINUTE, {TIME}) AS bin, round(sum({VALUE}), 6) AS total,
           round(avg({VALUE}), 6) AS mean, count({VALUE}) AS readings
    FROM energy GROUP BY 1, 2
    HAVING time_bucket(INTERVAL 15 MINUTE, {TIME}) + INTERVAL 15 MINUTE
           <= date_trunc('milliseconds', (SELECT max({TIME}) FROM energy)) - INTERVAL 10 MINUTE""")
def stream_resample_15m(t: Tables):
    """Every bin whose end the watermark has passed when the input is used up."""
    landed = work_path(t.spark, "landed")
    t.energy.select("ClientId", TIME, VALUE).write.parquet(landed)
    schema = t.energy.select("ClientId", TIME, VALUE).schema
    stream = jobs.resampled(jobs.read_stream(t.spark, landed, schema), TIME, VALUE)
    out = work_path(t.spark, "stream-bins")
    jobs.run_to_parquet(stream, out, work_path(t.spark, "stream-checkpoint"))
    return rounded(t.spark.read.schema(stream.schema).parquet(out))


STARTS = ["2024-01-01 00:00:00", "2024-01-11 00:00:00", "2024-01-21 00:00:00"]

ISSUED = " UNION ALL ".join(
    f"SELECT {i} AS batch_id, ClientId, {TIME} AS Time, PowerFromLoad * {i + 1} AS LoadPower FROM energy "
    f"WHERE {TIME} >= TIMESTAMP '{start}' AND {TIME} < TIMESTAMP '{start}' + INTERVAL 15 DAY"
    for i, start in enumerate(STARTS)
)


@check(f"""
    WITH issued AS ({ISSUED}), starts AS (SELECT ClientId, batch_id, min(Time) AS start FROM issued GROUP BY 1, 2)
    SELECT batch_id, ClientId, Time, LoadPower FROM issued i
    WHERE NOT EXISTS (SELECT 1 FROM starts s WHERE s.ClientId = i.ClientId AND s.batch_id > i.batch_id AND s.start <= i.Time)""")
def stream_replace_forecast(t: Tables):
    """Three forecasts of 15 days, ten days apart, arrive one after the other; what they replace is compacted in between."""
    landed, out, checkpoint = (work_path(t.spark, n) for n in ("issued", "batches", "batches-checkpoint"))
    for i, start in enumerate(STARTS):
        at = F.lit(start).cast("timestamp_ntz")
        rows = t.energy.where((F.col(TIME) >= at) & (F.col(TIME) < at + F.expr("INTERVAL 15 DAYS"))).select(
            "ClientId", F.col(TIME).alias("Time"), (F.col("PowerFromLoad") * (i + 1)).alias("LoadPower")
        )
        rows.write.mode("append").parquet(landed)
        jobs.publish_batches(jobs.read_stream(t.spark, landed, rows.schema), out, checkpoint)
        if i < 2:
            jobs.compact_batches(t.spark, out, rows.schema)
    return jobs.current_forecast(jobs.read_batches(t.spark, out, rows.schema)).select("batch_id", "ClientId", "Time", "LoadPower")


@check(f"SELECT ClientId, bin, round({TARGET}, 6) AS {TARGET} FROM load_15m")
def scheduled_incremental_features(t: Tables):
    """The clean series from bins kept up to date over three arrivals, the last one with late rows."""
    landed, by_day, bins, checkpoint = (work_path(t.spark, n) for n in ("arrivals", "by-day", "bins", "bins-checkpoint"))
    columns = ["ClientId", TIME, "event_id", VALUE]
    middle = F.lit(STARTS[1]).cast("timestamp_ntz")
    late = F.col("event_id") % 10 == 0
    for part in ((F.col(TIME) < middle) & ~late, (F.col(TIME) >= middle) & ~late, late):
        t.energy.where(part).select(columns).write.mode("append").parquet(landed)
        readings = jobs.read_stream(t.spark, landed, t.energy.select(columns).schema)
        jobs.incremental_bins(readings, by_day, bins, checkpoint, CUTOFF, tie=("event_id",))
    return rounded(jobs.series_from_states(t.spark.read.parquet(bins)))


# ---- forecasting jobs


FRAGMENTS["grown_trees"] = """
    SELECT CAST(p_partkey % 5 AS INT) AS ClientId, CAST(p_partkey // 5 AS INT) AS tree, k AS node,
           CASE k WHEN 1 THEN p_size % 3 WHEN 3 THEN (p_size + 1) % 3 END AS feature,
           CASE k WHEN 1 THEN p_size * 1.5 WHEN 3 THEN p_retailprice / 40.0 END AS cut, 2 * k AS lft, 2 * k + 1 AS rgt,
           CASE WHEN k IN (2, 6, 7) THEN (p_retailprice - 1000.0) * k / 100.0 END AS val
    FROM part, (VALUES (1), (2), (3), (6), (7)) nodes(k)"""


@check("""
    WITH RECURSIVE walk AS (
      SELECT ClientId, Time, Temperature, Humidity, WindSpeed, tree, 1 AS node FROM weather_forecast JOIN (SELECT DISTINCT ClientId, tree FROM grown_trees) t USING (ClientId)
      UNION ALL
      SELECT w.ClientId, Time, Temperature, Humidity, WindSpeed, w.tree,
             CASE WHEN CASE feature WHEN 0 THEN Temperature WHEN 1 THEN Humidity ELSE WindSpeed END < cut THEN lft ELSE rgt END
      FROM walk w JOIN grown_trees g ON g.ClientId = w.ClientId AND g.tree = w.tree AND g.node = w.node WHERE feature IS NOT NULL)
    SELECT w.ClientId, Time, round(sum(val), 4) AS prediction FROM walk w
    JOIN grown_trees g ON g.ClientId = w.ClientId AND g.tree = w.tree AND g.node = w.node WHERE feature IS NULL GROUP BY w.ClientId, Time""")
def score_saved_trees(t: Tables):
    """Ensembles that were written as a version and read back, walked for all sites' weather in one pass; two cuts a tree."""
    k, size, price = F.col("node"), F.col("p_size"), F.col("p_retailprice")
    nodes = t.raw("part").withColumn("node", F.explode(F.array(*map(F.lit, (1, 2, 3, 6, 7))))).select(
        (F.col("p_partkey") % 5).cast("int").alias("ClientId"),
        F.floor(F.col("p_partkey") / 5).cast("int").alias("tree"),
        "node",
        F.when(k == 1, size % 3).when(k == 3, (size + 1) % 3).cast("int").alias("feature"),
        F.when(k == 1, size * 1.5).when(k == 3, price / 40.0).cast("double").alias("cut"),
        F.when(k.isin(1, 3), 2 * k).alias("left"),
        F.when(k.isin(1, 3), 2 * k + 1).alias("right"),
        F.when(k.isin(2, 6, 7), (price - 1000.0) * k / 100.0).cast("double").alias("value"),
    )
    trees = t.spark.read.parquet(sinks.write_version(nodes, work_path(t.spark, "trees"), "v1"))
    scored = boosting.predict(t.weather_forecast, trees, KEY, ["Temperature", "Humidity", "WindSpeed"])
    return rounded(scored.select("ClientId", "Time", "prediction"), 4)


@check()
def forecast_hourly_direct(t: Tables):
    return load_hourly.forecast(t.dense_energy, t.dense_measurements, NOW)


_READING_LAGS = ", ".join(f"lag(p, {k}) OVER w AS lag_{k}" for k in range(1, 24))
FRAGMENTS["reading_rows"] = f"""
    SELECT ClientId, {TIME}, event_id, p, {_READING_LAGS}, {", ".join(f"lead(p, {h}) OVER w AS y_{h}" for h in range(1, 5))}
    FROM (SELECT ClientId, event_id, {TIME}, CAST(PowerFromLoad AS DOUBLE) AS p FROM energy) e
    WINDOW w AS (PARTITION BY ClientId ORDER BY {TIME}, event_id)"""
FRAGMENTS["reading_inputs"] = f"""
    SELECT ClientId, {TIME}, event_id, [p, {", ".join(f"lag_{k}" for k in range(1, 24))},
           (hour({TIME}) * 10000 + minute({TIME}) * 100 + floor(second({TIME})))::DOUBLE, month({TIME})::DOUBLE, isodow({TIME})::DOUBLE,
           (CASE WHEN isodow({TIME}) >= 6 THEN 1 ELSE 0 END)::DOUBLE, {season_sql(f"month({TIME})")}::DOUBLE] AS x, [y_1, y_2, y_3, y_4] AS y
    FROM reading_rows WHERE lag_23 IS NOT NULL"""
FRAGMENTS["reading_pairs"] = "SELECT ClientId, x, y FROM reading_inputs WHERE y[4] IS NOT NULL"
ridge_sql("reading", "reading_pairs", ["ClientId"], 29, 4, 1.0, filters.MIN_HISTORY["slot_model"])


@check(f"""
    SELECT l.ClientId, CAST(h AS INT) AS h, round(b[h] + list_sum(list_transform(list_zip(w[h], x), lambda z: z[1] * z[2])), 2) AS LoadPower
    FROM (SELECT * FROM reading_inputs QUALIFY row_number() OVER (PARTITION BY ClientId ORDER BY {TIME} DESC, event_id DESC) = 1) l
    JOIN reading_weights m ON m.ClientId = l.ClientId, generate_series(1, 4) g(h)""")
def forecast_hourly_sequence(t: Tables):
    return rounded(load_hourly.forecast_from_readings(t.energy, tie=("event_id",)), 2)


def _filled(t: Tables):
    """Every site's gap-free series: a slot has a value on each day."""
    return profiles.filled_days(slots.load_series(t.energy), slots.TARGET).select("ClientId", "bin", slots.TARGET)


FRAGMENTS["slot_rows"] = f"""
    SELECT * FROM (
      SELECT ClientId, strftime(bin, '%H:%M:%S') AS slot, bin, {", ".join(f"lag(v, {k}) OVER w AS lag_{k}" for k in range(1, 11))}, v
      FROM profile_values WINDOW w AS (PARTITION BY ClientId, strftime(bin, '%H:%M:%S') ORDER BY bin)) q"""
FRAGMENTS["slot_pairs"] = f"""
    SELECT ClientId, slot, bin, [{", ".join(f"lag_{k}" for k in range(1, 11))}, month(bin)::DOUBLE, isodow(bin)::DOUBLE,
           (CASE WHEN isodow(bin) >= 6 THEN 1 ELSE 0 END)::DOUBLE, {season_sql("month(bin)")}::DOUBLE] AS x, [v] AS y
    FROM slot_rows WHERE lag_10 IS NOT NULL"""
ridge_sql("slot", "slot_pairs", ["ClientId", "slot"], 14, 1, 10.0, filters.MIN_HISTORY["slot_model"])
FRAGMENTS["slot_days"] = "SELECT ClientId, CAST(max(bin) AS DATE) + 1 AS d FROM profile_values GROUP BY 1"
FRAGMENTS["slot_ahead"] = f"""
    SELECT c.ClientId, s.slot, d.d, coalesce(round(p.v, 9), 0) AS v FROM (SELECT DISTINCT ClientId FROM profile_values) c
    JOIN slot_days d ON d.ClientId = c.ClientId
    CROSS JOIN (SELECT strftime(TIMESTAMP '2024-01-01' + to_minutes(15 * CAST(i AS INT)), '%H:%M:%S') AS slot FROM generate_series(0, 95) g(i)) s
    LEFT JOIN (
      SELECT r.ClientId, r.slot, m.b[1] + list_sum(list_transform(list_zip(m.w[1], [r.v, {", ".join(f"r.lag_{k}" for k in range(1, 10))}, month(d.d)::DOUBLE,
        isodow(d.d)::DOUBLE, (CASE WHEN isodow(d.d) >= 6 THEN 1 ELSE 0 END)::DOUBLE, {season_sql("month(d.d)")}::DOUBLE]), lambda z: z[1] * z[2])) AS v
      FROM (SELECT * FROM slot_rows QUALIFY row_number() OVER (PARTITION BY ClientId, slot ORDER BY bin DESC) = 1) r
      JOIN slot_days d ON d.ClientId = r.ClientId JOIN slot_weights m ON m.ClientId = r.ClientId AND m.slot = r.slot
    ) p ON p.ClientId = c.ClientId AND p.slot = s.slot"""
FRAGMENTS["slot_forecast"] = """
    SELECT ClientId, CAST(CAST(d AS VARCHAR) || ' ' || slot AS TIMESTAMP) AS Time, v FROM slot_ahead
    UNION ALL
    SELECT ClientId, CAST(CAST(d + 1 AS VARCHAR) || ' ' || slot AS TIMESTAMP), v FROM slot_ahead WHERE slot IN ('00:15:00', '00:30:00', '00:45:00', '01:00:00')"""


@check("SELECT ClientId, Time, round(v, 3) AS Predicted FROM slot_forecast")
def forecast_by_slot(t: Tables):
    return rounded(slots.forecast(_filled(t)), 3)


# every site's clusters by the same draws and rounds as the operator's
FRAGMENTS["profile_scale"] = """
    SELECT ClientId, list(m ORDER BY slot) AS ms, list(s ORDER BY slot) AS ss FROM (
      SELECT ClientId, slot, avg(v) AS m, stddev_pop(v) AS s FROM profile_slots GROUP BY 1, 2) q
    WHERE ClientId IN (SELECT ClientId FROM profile_slots GROUP BY 1 HAVING count(DISTINCT Date) >= 10) GROUP BY 1"""
FRAGMENTS["profile_points"] = """
    SELECT p.ClientId, Date, list((CASE WHEN ss[slot + 1] = 0 THEN v - ms[slot + 1] ELSE (v - ms[slot + 1]) / ss[slot + 1] END) ORDER BY slot) AS f
    FROM profile_slots p JOIN profile_scale s ON s.ClientId = p.ClientId GROUP BY 1, 2"""
FRAGMENTS["profile_starts"] = """
    SELECT ClientId, Date, f, 0 AS j, CAST(1.0 AS DOUBLE) AS d2, CAST(NULL AS DOUBLE[]) AS c FROM profile_points
    UNION ALL
    SELECT ClientId, Date, f, j + 1, CASE WHEN j = 0 THEN list_distance(f, nxt) ** 2 ELSE least(d2, list_distance(f, nxt) ** 2) END, nxt
    FROM (SELECT *, arg_max(f, score) OVER (PARTITION BY ClientId) AS nxt FROM (
      SELECT *, CASE WHEN d2 > 0 THEN ln((('0x' || substr(md5(concat(ClientId, ':', Date, ':', j)), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296) / d2 END AS score
      FROM profile_starts WHERE j < 10) a) b"""
FRAGMENTS["profile_rounds"] = """
    SELECT 0 AS i, ClientId, j - 1 AS cluster, any_value(c) AS c FROM profile_starts WHERE j > 0 AND c IS NOT NULL GROUP BY ClientId, j
    UNION ALL
    SELECT i + 1, ClientId, cluster, CASE WHEN len(own) > 0 THEN list_transform(range(1, 101), lambda k: list_avg(list_transform(own, lambda m: m[k]))) ELSE c END
    FROM (SELECT i, ClientId, cluster, any_value(c) AS c, coalesce(list(f ORDER BY Date) FILTER (nearest = 1), []) AS own FROM (
      SELECT r.*, p.Date, p.f, row_number() OVER (PARTITION BY p.ClientId, p.Date ORDER BY list_distance(p.f, r.c), r.cluster) AS nearest
      FROM profile_rounds r JOIN profile_points p ON p.ClientId = r.ClientId WHERE i < 20) a GROUP BY i, ClientId, cluster) b"""
FRAGMENTS["profile_centres"] = "SELECT ClientId, cluster, c FROM profile_rounds WHERE i = 20"
FRAGMENTS["hybrid_rows"] = """
    SELECT d.ClientId, CAST(d.d AS TIMESTAMP) + to_minutes(15 * CAST(k - 1 AS INT)) AS Time, vs[k] AS p,
           (vs[k] + c[k] * CASE WHEN ss[k] = 0 THEN 1 ELSE ss[k] END + ms[k]) / 2 AS b
    FROM (
      SELECT a.ClientId, a.d, vs, ms, ss, c FROM (
        SELECT ClientId, d, list_concat(list(v ORDER BY slot), list(v ORDER BY slot)[2:5]) AS vs FROM slot_ahead GROUP BY 1, 2) a
      JOIN profile_scale s ON s.ClientId = a.ClientId JOIN profile_centres z ON z.ClientId = a.ClientId
      QUALIFY row_number() OVER (PARTITION BY a.ClientId ORDER BY list_distance(list_transform(range(1, 101),
        lambda k: CASE WHEN ss[k] = 0 THEN vs[k] - ms[k] ELSE (vs[k] - ms[k]) / ss[k] END), c), cluster) = 1) d, generate_series(1, 100) g(k)"""


@check("""
    SELECT ClientId, Date, cluster FROM (
      SELECT p.ClientId, Date, CAST(cluster AS INT) AS cluster, row_number() OVER (PARTITION BY p.ClientId, Date ORDER BY list_distance(f, c), cluster) AS n
      FROM profile_points p JOIN profile_centres z ON z.ClientId = p.ClientId) q WHERE n = 1""")
def cluster_day_profiles(t: Tables):
    filled = profiles.filled_days(slots.load_series(t.energy), slots.TARGET)
    days, _, _ = profiles.cluster_by_site(profiles.profiles(filled, slots.TARGET))
    return days.select("ClientId", F.col("Date").cast("string").alias("Date"), "cluster")


@check("""
    SELECT ClientId, Time, round(p, 2) AS lstm_predictions, round(b, 2) AS hybrid_predictions FROM hybrid_rows""")
def hybrid_forecast(t: Tables):
    series = stored(_filled(t), "filled-series")
    ahead = stored(slots.forecast(series), "slot-forecast")
    days = profiles.profiles(series, slots.TARGET)
    _, scaler, centres = profiles.cluster_by_site(days)
    return rounded(profiles.hybrid_forecast(ahead, scaler, centres), 2)


@check("""
    SELECT ClientId, date_trunc('hour', Time) AS bin, round(avg(p), 2) AS lstm_predictions, round(avg(b), 2) AS hybrid_predictions
    FROM hybrid_rows GROUP BY 1, 2""")
def hybrid_forecast_hourly(t: Tables):
    series = stored(_filled(t), "filled-series")
    ahead = stored(slots.forecast(series), "slot-forecast")
    days = profiles.profiles(series, slots.TARGET)
    _, scaler, centres = profiles.cluster_by_site(days)
    return rounded(profiles.hourly(profiles.hybrid_forecast(ahead, scaler, centres)), 2)


_DAY_X = [
    "v", "Temperature", "Humidity", "month(bin)", "day(bin)", "hour(bin)", "sin(2 * pi() * hour(bin) / 24)", "cos(2 * pi() * hour(bin) / 24)",
    "sin(2 * pi() * day(bin) / 30)", "cos(2 * pi() * day(bin) / 30)", *[f"lag(v, {k}) OVER w" for k in range(1, 16)], "Temperature * hour(bin)",
    *[f"CASE WHEN isodow(bin) - 1 = {k} THEN 1 ELSE 0 END" for k in range(1, 7)], *[f"lag(v, {k}) OVER w" for k in (96, 192, 288)],
]
FRAGMENTS["day_inputs"] = f"""
    SELECT ClientId, bin, [{", ".join(f"({x})::DOUBLE" for x in _DAY_X)}] AS x, list(v) OVER (PARTITION BY ClientId ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND 96 FOLLOWING) AS y
    FROM (SELECT ClientId, bin, LoadEnergyCalculated_15 AS v, Temperature, Humidity FROM joined_15m) q WINDOW w AS (PARTITION BY ClientId ORDER BY bin)"""
FRAGMENTS["day_usable"] = "SELECT *, len(list_filter(x, lambda v: v IS NOT NULL)) = 35 AS usable FROM day_inputs"
FRAGMENTS["day_parts"] = """
    SELECT *, lead(is_train, 96) OVER (PARTITION BY ClientId ORDER BY bin) AS ends_in_train FROM (
      SELECT *, count(*) FILTER (usable) OVER (PARTITION BY ClientId ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               <= floor(0.8::DOUBLE * count(*) FILTER (usable) OVER (PARTITION BY ClientId)) AS is_train FROM day_usable) q"""
FRAGMENTS["day_pairs"] = "SELECT ClientId, x, y FROM day_parts WHERE usable AND ends_in_train AND len(list_filter(y, lambda v: v IS NOT NULL)) = 96"
ridge_sql("day", "day_pairs", ["ClientId"], 35, 96, 1.0, filters.MIN_HISTORY["daily_load"])
FRAGMENTS["day_steps_ahead"] = """
    SELECT l.ClientId, bin + to_minutes(15 * CAST(h AS INT)) AS Timestamp,
           round(b[least(h, 96)] + list_sum(list_transform(list_zip(w[least(h, 96)], x), lambda z: z[1] * z[2])), 2) AS LoadEnergyForecast_15
    FROM (SELECT * FROM day_usable WHERE usable QUALIFY row_number() OVER (PARTITION BY ClientId ORDER BY bin DESC) = 1) l
    JOIN day_weights m ON m.ClientId = l.ClientId, generate_series(1, 100) g(h)"""
FRAGMENTS["day_scores"] = """
    SELECT d.ClientId, y[h] AS y, b[h] + list_sum(list_transform(list_zip(w[h], x), lambda z: z[1] * z[2])) AS p
    FROM day_parts d JOIN day_weights m ON m.ClientId = d.ClientId, generate_series(1, 96) g(h)
    WHERE usable AND NOT is_train AND len(y) = 96 AND y[h] IS NOT NULL"""
_RUN_SQL = """avg(abs(y - p)) AS MAE, sqrt(avg((y - p) * (y - p))) AS RMSE, avg(100 * abs(y - p) / (abs(y) + abs(p) + 1e-8)) AS SMAPE_percent,
           100 * sum(abs(y - p)) / (sum(abs(y)) + 1e-8) AS WMAPE_percent"""
FRAGMENTS["day_errors"] = f"""
    SELECT ClientId, {_RUN_SQL}, avg((y - p) * (y - p)) AS MSE, 1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(y), 0) AS R2,
           avg(CASE WHEN abs(y - p) <= 1 THEN (y - p) * (y - p) / 2 ELSE abs(y - p) - 0.5 END) AS Huber FROM day_scores GROUP BY 1"""


@check("SELECT * FROM day_steps_ahead")
def forecast_daily_load(t: Tables):
    return rounded(load_daily.forecast(t.energy, t.measurements, cutoff=CUTOFF, tie=("event_id",)), 2)


def _daily_table(t: Tables):
    table = load_daily.supervised(t.energy, t.measurements, cutoff=CUTOFF, tie=("event_id",))
    return stored(load_daily.split(table), "daily-load-features")


@check(f"SELECT ClientId, {', '.join(f'round({c}, 2) AS {c}' for c in metrics.ALL)} FROM day_errors")
def evaluate_daily_load(t: Tables):
    table = _daily_table(t)
    return rounded(load_daily.evaluate(table, stored(load_daily.train(table), "daily-load-models")), 2)


@check(f"""
    SELECT e.ClientId, TrainEnd, {', '.join(f'round({c}, 4) AS {c}' for c in metrics.RUN_ERRORS)}, n_rows_total, n_train_rows, n_test_rows, was_in_use
    FROM day_errors e JOIN (
      SELECT ClientId, CAST(count(*) AS INT) AS n_rows_total, CAST(count(*) FILTER (is_train) AS INT) AS n_train_rows,
             CAST(count(*) FILTER (NOT is_train) AS INT) AS n_test_rows FROM day_parts WHERE usable GROUP BY 1) c ON c.ClientId = e.ClientId
    CROSS JOIN (VALUES ('2024-01-31T00:01:00', true), ('2024-02-01T00:01:00', false)) r(TrainEnd, was_in_use)""")
def retrain_daily_load(t: Tables):
    """Two runs: the first has no rival, the second is no better than the first."""
    table, history = _daily_table(t), work_path(t.spark, "run-history")
    names = ["ClientId", "TrainEnd", *metrics.RUN_ERRORS, "n_rows_total", "n_train_rows", "n_test_rows", "was_in_use"]
    runs, active = load_daily.retrain(table, t.spark.createDataFrame([], schemas.RUNS), None, "2024-01-31T00:01:00")
    sinks.append_run_metrics(runs, history)
    active = stored(active, "active-models")
    runs, _ = load_daily.retrain(table, readers.read_runs(t.spark, history), active, "2024-02-01T00:01:00")
    sinks.append_run_metrics(runs, history)
    return rounded(readers.read_runs(t.spark, history).select(names), 4)


FRAGMENTS["window_rows"] = """
    SELECT ClientId, bin, is_train, usable, list_concat(x[1:1], x[11:17], [x[7], s_1, s_2]) AS x, y[1:4] AS y,
           lead(is_train, 4) OVER (PARTITION BY ClientId ORDER BY bin) AS ends
    FROM (SELECT *, lag(x[7]) OVER (PARTITION BY ClientId ORDER BY bin) AS s_1, lag(x[7], 2) OVER (PARTITION BY ClientId ORDER BY bin) AS s_2
          FROM day_parts) q"""
FRAGMENTS["window_pairs"] = """
    SELECT ClientId, x, y FROM window_rows WHERE ends AND len(list_filter(x, lambda v: v IS NOT NULL)) = 11 AND len(list_filter(y, lambda v: v IS NOT NULL)) = 4"""
ridge_sql("window", "window_pairs", ["ClientId"], 11, 4, 1.0, 2)


@check("""
    SELECT r.ClientId, bin, CAST(h AS INT) AS h, round(y[h], 2) AS y, round(b[h] + list_sum(list_transform(list_zip(w[h], x), lambda z: z[1] * z[2])), 2) AS p
    FROM window_rows r JOIN window_weights m ON m.ClientId = r.ClientId, generate_series(1, 4) g(h)
    WHERE NOT is_train AND len(list_filter(x, lambda v: v IS NOT NULL)) = 11""")
def forecast_from_short_windows(t: Tables):
    """The regression on windows at a size that SQL can solve: eight sums and three clock values, four steps."""
    table = _daily_table(t).withColumn("is_origin", ~F.col("is_train"))
    inputs = {TARGET: 8, "hour_sin": 3}
    models = stored(windows.fit(table, KEY, "bin", inputs, TARGET, 4, "is_train", tolerance=1e-13), "window-models")
    return rounded(windows.ahead(table, models, KEY, "bin", inputs, TARGET, 4, "is_origin"), 2)


@check()
def forecast_daily_load_windows(t: Tables):
    """From all 288 rows of 32 features to 96 steps; tests compare it with a dense solution."""
    return load_daily.forecast_from_windows(t.energy, t.measurements, cutoff=CUTOFF, tie=("event_id",))


@check()
def evaluate_daily_load_windows(t: Tables):
    table = stored(load_daily.window_table(t.energy, t.measurements, cutoff=CUTOFF, tie=("event_id",)), "daily-load-windows")
    models = stored(load_daily.train_windows(table), "daily-load-window-models")
    return metrics.evaluate(load_daily.held_out_windows(table, models), KEY, "y", "p")


@check()
def forecast_daily_pv(t: Tables):
    served = t.weather_forecast.where(F.col("Time") >= filters.at(t.weather_forecast, "Time", NOW))
    return solar_daily.forecast(t.measurements.drop("event_id"), t.pv_history, t.energy, served, NOW)


@check()
def hyperparameter_sweep(t: Tables):
    """Hyperband in five-minute bins: thirty days of quarter hours have no 3840 rows to judge on besides those to learn from."""
    series = load_daily.energy_series(t.energy, CUTOFF, tie=("event_id",), width=5)
    return sweep.hyperband(series, TARGET)


FRAGMENTS["rung_losses"] = """
    SELECT CAST(o_custkey % 17 AS INT) AS trial, CAST(o_orderkey % 3 AS INT) AS rung, round(avg(o_totalprice), 4) AS loss FROM orders GROUP BY 1, 2"""
FRAGMENTS["rung_0"] = """
    SELECT *, row_number() OVER (PARTITION BY bracket ORDER BY loss, trial) AS place FROM (
      SELECT *, CASE WHEN trial < 9 THEN 2 WHEN trial < 14 THEN 1 ELSE 0 END AS bracket FROM rung_losses WHERE rung = 0) q"""
FRAGMENTS["rung_1"] = """
    SELECT l.*, r.bracket, row_number() OVER (PARTITION BY r.bracket ORDER BY l.loss, l.trial) AS place FROM rung_losses l
    JOIN rung_0 r ON r.trial = l.trial AND r.place <= CASE r.bracket WHEN 2 THEN 3 WHEN 1 THEN 1 ELSE 0 END WHERE l.rung = 1"""


@check("""
    SELECT trial, bracket, rung, CASE bracket WHEN 2 THEN 15 / 9.0 WHEN 1 THEN 5.0 ELSE 15.0 END::DOUBLE AS budget, loss,
           place <= CASE bracket WHEN 2 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS survived FROM rung_0
    UNION ALL
    SELECT trial, bracket, rung, CASE bracket WHEN 2 THEN 5.0 ELSE 15.0 END::DOUBLE, loss, place <= CASE bracket WHEN 2 THEN 1 ELSE 0 END FROM rung_1
    UNION ALL
    SELECT l.trial, r.bracket, l.rung, 15.0::DOUBLE, l.loss, false FROM rung_losses l JOIN rung_1 r ON r.trial = l.trial AND r.bracket = 2 AND r.place = 1 WHERE l.rung = 2""")
def sweep_survivors(t: Tables):
    """The brackets over losses that orders give to each trial and rung."""
    kind = [(F.col("o_custkey") % 17).cast("int").alias("trial"), (F.col("o_orderkey") % 3).cast("int").alias("rung")]
    losses = stored(t.raw("orders").groupBy(*kind).agg(F.round(F.avg("o_totalprice"), 4).alias("loss")), "rung-losses")
    plan = sweep.rungs()
    found = sweep.halving(t.spark, sweep.draws(plan), lambda _, rung: losses.where(F.col("rung") == rung).drop("rung"), plan, "loss")
    return found.select("trial", "bracket", "rung", "budget", "loss", "survived")


@check("SELECT * FROM day_steps_ahead")
def batch_score(t: Tables):
    table, path = _daily_table(t), work_path(t.spark, "models")
    saved_models.save(load_daily.train(table), path)
    return rounded(saved_models.score(t.spark, path, table), 2)


@check("SELECT * FROM day_steps_ahead")
def batch_score_records(t: Tables):
    """The same forecast, from energy and weather that arrive as JSON records."""
    models, energy, sky = (work_path(t.spark, n) for n in ("models", "energy-json", "weather-json"))
    saved_models.save(load_daily.train(_daily_table(t)), models)
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    lower = {"ClientId": "clientId", TIME: "timeStampMeasured", VALUE: "loadEnergyCalculated"}
    columns.select_rename(t.energy, lower).write.option("timestampNTZFormat", micros).json(energy)
    lower = {"ClientId": "clientId", "Time": "time", "Temperature": "temperature", "Humidity": "humidity"}
    columns.select_rename(t.measurements, lower).write.option("timestampNTZFormat", micros).json(sky)
    return rounded(saved_models.score_records(t.spark, models, energy, sky, cutoff=CUTOFF), 2)
