"""Scans, filters, projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.tables import CLIENT, CUTOFF, NOW, PV_FROM, RANGE_END, RANGE_START, Tables, check, rounded
from wattloom.functions import calendar as cal
from wattloom.functions import values as val
from wattloom.operators import aggregates as agg
from wattloom.operators import columns, filters
from wattloom.session import work_path
from wattloom.sources import readers


def between(ts: str) -> str:
    return f"{ts} > TIMESTAMP '{RANGE_START}' AND {ts} <= TIMESTAMP '{RANGE_END}'"


# ---- scans


@check(f"SELECT TimeStampMeasured, PowerFromLoad FROM energy WHERE ClientId = {CLIENT} AND {between('TimeStampMeasured')}")
def scan_energy_range(t: Tables):
    return readers.scan_energy_range(t.energy, CLIENT, RANGE_START, RANGE_END)


@check(f"SELECT * FROM energy WHERE ClientId = {CLIENT} AND {between('TimeStampMeasured')}")
def scan_energy_range_all_cols(t: Tables):
    return readers.scan_energy_range_all_cols(t.energy, CLIENT, RANGE_START, RANGE_END)


@check(f"SELECT * FROM measurements WHERE ClientId = {CLIENT} AND {between('Time')}")
def scan_measurements_range(t: Tables):
    return readers.scan_measurements_range(t.measurements, CLIENT, RANGE_START, RANGE_END)


@check("SELECT * FROM clients")
def scan_clients(t: Tables):
    return t.clients


@check("SELECT * FROM energy")
def scan_energy_full(t: Tables):
    return t.energy


@check(f"SELECT * FROM energy WHERE {between('TimeStampMeasured')}")
def scan_energy_range_all_clients(t: Tables):
    return readers.scan_energy_range_all_clients(t.energy, RANGE_START, RANGE_END)


@check(f"""
    SELECT 'measurements' AS source, ClientId, Time, Temperature AS value FROM measurements
    UNION ALL SELECT 'forecast', ClientId, Time, Temperature FROM weather_forecast WHERE Time >= TIMESTAMP '{PV_FROM}'
    UNION ALL SELECT 'energy', ClientId, TimeStampMeasured, CAST(PowerToPv AS DOUBLE) FROM energy
    WHERE TimeStampMeasured >= TIMESTAMP '{PV_FROM}'""")
def scan_pv_inputs(t: Tables):
    frames = readers.scan_pv_inputs(t.measurements, t.weather_forecast, t.energy, PV_FROM)
    shapes = [("measurements", "Time", "Temperature"), ("forecast", "Time", "Temperature"), ("energy", "TimeStampMeasured", "PowerToPv")]
    parts = [
        f.select(F.lit(n).alias("source"), "ClientId", F.col(ts).alias("Time"), F.col(v).cast("double").alias("value"))
        for f, (n, ts, v) in zip(frames, shapes, strict=True)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check("SELECT ClientId, TimeStampMeasured, LoadEnergyCalculated FROM energy")
def scan_json_readings(t: Tables):
    path = work_path(t.spark, "readings-json")
    names = {"ClientId": "clientId", "TimeStampMeasured": "timeStampMeasured", "LoadEnergyCalculated": "loadEnergyCalculated"}
    landed = columns.select_rename(t.energy, names)
    landed.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return readers.scan_json_readings(t.spark, path, landed.schema)


@check("SELECT date_trunc('second', ts) AS Time, value AS SolarPower FROM events")
def scan_csv_pv(t: Tables):
    path = work_path(t.spark, "pv-csv")
    events = t.raw("events")
    landed = events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
        F.col("value").alias(readers.PV_COLUMN),
    )
    landed.write.option("sep", ";").option("header", True).csv(path)
    return readers.scan_csv_pv(t.spark, path)


@check("SELECT date_trunc('minute', TimeStampMeasured) AS Time, PowerFromLoad AS ConsumerPower1 FROM energy")
def scan_csv_series(t: Tables):
    path = work_path(t.spark, "series-csv")
    t.energy.select(
        F.date_format("TimeStampMeasured", "dd/MM/yyyy HH:mm").alias("Time"), F.col("PowerFromLoad").alias("ConsumerPower1")
    ).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("Time", T.TimestampNTZType()), T.StructField("ConsumerPower1", T.LongType())])
    return readers.scan_csv_series(t.spark, path, schema, "dd/MM/yyyy HH:mm")


@check("""
    SELECT CAST(p_partkey AS VARCHAR) AS trial, p_retailprice AS score FROM part WHERE p_size > 5""")
def scan_trial_scores(t: Tables):
    """Tuner state files of at most 100 trials each, some without a score."""
    path = work_path(t.spark, "trials")
    score = F.when(F.col("p_size") > 5, F.col("p_retailprice"))
    entry = F.struct(F.col("p_partkey").cast("string"), F.struct(score.alias("score")))
    files = t.raw("part").groupBy(F.floor(F.col("p_partkey") / 100).alias("file")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("trials")
    )
    files.select("trials").write.json(path)
    # one state per line here; a tuner writes one per file
    return readers.scan_trial_scores(t.spark, path, multi_line=False)


# ---- filters


@check(f"SELECT ClientId, TimeStampMeasured, LoadEnergyCalculated FROM energy WHERE {between('TimeStampMeasured')}")
def filter_half_open_range(t: Tables):
    rows = filters.half_open_range(t.energy, "TimeStampMeasured", RANGE_START, RANGE_END)
    return rows.select("ClientId", "TimeStampMeasured", "LoadEnergyCalculated")


@check("SELECT ClientId, TimeStampMeasured, PowerFromLoad FROM energy WHERE PowerFromLoad >= 3000 AND PowerFromLoad < 150000")
def filter_power_band(t: Tables):
    return filters.power_band(t.energy, "PowerFromLoad").select("ClientId", "TimeStampMeasured", "PowerFromLoad")


@check(f"SELECT TimeStampMeasured, LoadEnergyCalculated FROM energy WHERE TimeStampMeasured > TIMESTAMP '{CUTOFF}'")
def filter_cutoff(t: Tables):
    return filters.after_cutoff(t.energy, "TimeStampMeasured", CUTOFF, ["TimeStampMeasured", "LoadEnergyCalculated"])


@check("""
    SELECT ClientId, event_id, CASE WHEN LoadEnergyCalculated <= 40000 THEN LoadEnergyCalculated END
      AS LoadEnergyCalculated FROM energy""")
def spike_to_null(t: Tables):
    return filters.spike_to_null(t.energy, "LoadEnergyCalculated").select("ClientId", "event_id", "LoadEnergyCalculated")


MARKED = """SELECT event_id, CASE WHEN event_type = 'error' THEN 'broken ' ELSE '' END
              || strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM events"""


def _texts(t: Tables):
    prefix = F.when(F.col("event_type") == "error", F.lit("broken ")).otherwise(F.lit(""))
    return t.raw("events").select("event_id", F.concat(prefix, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("text"))


@check(f"""
    SELECT event_id, try_cast(text AS TIMESTAMP) AS parsed FROM ({MARKED}) m
    WHERE try_cast(text AS TIMESTAMP) IS NOT NULL""")
def drop_bad_timestamps(t: Tables):
    return filters.drop_bad_timestamps(_texts(t), "text", "parsed").drop("text")


@check("""
    SELECT * FROM (SELECT ClientId, event_id, CASE WHEN LoadEnergyCalculated <= 40000 THEN LoadEnergyCalculated END AS e,
                          CASE WHEN PowerFromLoad >= 3000 THEN PowerFromLoad END AS p FROM energy) q
    WHERE e IS NOT NULL AND p IS NOT NULL""")
def drop_any_null(t: Tables):
    gappy = t.energy.select(
        "ClientId",
        "event_id",
        val.spike_to_null(F.col("LoadEnergyCalculated")).alias("e"),
        F.when(F.col("PowerFromLoad") >= 3000, F.col("PowerFromLoad")).alias("p"),
    )
    return filters.drop_any_null(gappy)


@check(f"""
    SELECT e.ClientId, e.event_id, e.TimeStampMeasured FROM energy e
    JOIN (SELECT ClientId, min(Time) AS start FROM weather_forecast WHERE Time >= TIMESTAMP '{PV_FROM}' GROUP BY 1) s
      ON e.ClientId = s.ClientId WHERE e.TimeStampMeasured < s.start""")
def filter_train_before(t: Tables):
    served = t.weather_forecast.where(F.col("Time") >= filters.at(t.weather_forecast, "Time", PV_FROM))
    history = t.energy.select("ClientId", "event_id", "TimeStampMeasured")
    return filters.before_first(history, "TimeStampMeasured", ["ClientId"], served, "Time")


@check(f"""
    SELECT ClientId, Time, Temperature FROM weather_forecast
    WHERE Time >= timezone('UTC', timezone('Europe/Ljubljana',
      date_trunc('day', timezone('Europe/Ljubljana', timezone('UTC', TIMESTAMP '{NOW}'))) - INTERVAL 7 DAY))""")
def filter_recent_forecast(t: Tables):
    return filters.recent_days(t.weather_forecast, "Time", NOW).select("ClientId", "Time", "Temperature")


@check("""
    SELECT ClientId, bin, LoadEnergyCalculated FROM (
      SELECT ClientId, time_bucket(INTERVAL 15 MINUTE, TimeStampMeasured) AS bin, LoadEnergyCalculated FROM energy) q
    WHERE strftime(bin, '%H:%M:%S') IN ('00:15:00', '00:30:00', '00:45:00', '01:00:00')""")
def filter_time_slot(t: Tables):
    bins = t.energy.select("ClientId", cal.bin_start("TimeStampMeasured").alias("bin"), "LoadEnergyCalculated")
    return filters.time_slot(bins, "bin", ["00:15:00", "00:30:00", "00:45:00", "01:00:00"])


@check(f"""
    SELECT ClientId, TimeStampMeasured, LoadEnergyCalculated, PowerFromLoad, PowerToPv, event_id FROM (
      SELECT *, row_number() OVER (PARTITION BY ClientId ORDER BY TimeStampMeasured DESC) AS rn
      FROM energy WHERE TimeStampMeasured <= TIMESTAMP '{NOW}') q WHERE rn = 1""")
def asof_last_row(t: Tables):
    return filters.asof_last_row(t.energy, ["ClientId"], "TimeStampMeasured", NOW)


@check("""
    SELECT ClientId, strftime(TimeStampMeasured, '%Y-%m-%d') AS day, count(*) AS rows, count(*) >= 96 AS enough
    FROM energy GROUP BY 1, 2""")
def min_history_guard(t: Tables):
    days = t.energy.withColumn("day", F.date_format("TimeStampMeasured", "yyyy-MM-dd"))
    return filters.min_history_guard(days, ["ClientId", "day"], filters.MIN_HISTORY["day_profile"])


# ---- projections


@check("SELECT ClientId, TimeStampMeasured AS Timestamp, PowerFromLoad AS ConsumerPower1 FROM energy")
def select_rename(t: Tables):
    names = {"ClientId": "ClientId", "TimeStampMeasured": "Timestamp", "PowerFromLoad": "ConsumerPower1"}
    return columns.select_rename(t.energy, names)


@check(f"SELECT event_id, 0 AS hybrid_predictions, TIMESTAMP '{NOW}' AS Time_predicted FROM energy")
def const_column(t: Tables):
    stamped = columns.const_column(t.energy.select("event_id"), {"hybrid_predictions": 0, "Time_predicted": NOW})
    return stamped.withColumn("Time_predicted", F.col("Time_predicted").cast("timestamp_ntz"))


@check("SELECT PowerToPv, event_id, 0 AS Rain, ClientId FROM energy")
def align_columns(t: Tables):
    return columns.align_columns(t.energy, ["PowerToPv", "event_id", "Rain", "ClientId"])


@check("SELECT ClientId, TimeStampMeasured, LoadEnergyCalculated, event_id FROM energy")
def drop_columns(t: Tables):
    return columns.drop_columns(t.energy, ["PowerFromLoad", "PowerToPv", "Unnamed: 0"])


@check("SELECT event_id, CAST(PowerFromLoad AS DOUBLE) AS PowerFromLoad, CAST(PowerToPv AS DOUBLE) AS PowerToPv FROM energy")
def cast_numeric(t: Tables):
    power = t.energy.select("event_id", "PowerFromLoad", "PowerToPv")
    return columns.cast_numeric(power, ["PowerFromLoad", "PowerToPv"])


@check("SELECT ClientId, Temperature, Humidity, Clouds, Pressure, Visibility, WindSpeed, PowerPV, event_id FROM measurements")
def select_by_type(t: Tables):
    return columns.select_by_type(t.measurements)


# ---- scalar functions


@check(f"SELECT event_id, try_cast(text AS TIMESTAMP) AS parsed FROM ({MARKED}) m")
def parse_timestamp_utc(t: Tables):
    return _texts(t).select("event_id", cal.parse_utc(F.col("text")).alias("parsed"))


@check("SELECT event_id, timezone('Europe/Ljubljana', timezone('UTC', ts)) AS local FROM events")
def to_local_time(t: Tables):
    return t.raw("events").select("event_id", cal.to_local(F.col("ts")).alias("local"))


@check("SELECT event_id, ts AS naive FROM events")
def strip_timezone(t: Tables):
    zoned = t.raw("events").select("event_id", F.col("ts").cast("timestamp").alias("zoned"))
    return zoned.select("event_id", cal.strip_zone(F.col("zoned")).alias("naive"))


@check("SELECT event_id, date_trunc('minute', ts) AS minute, date_trunc('day', ts) AS midnight FROM events")
def truncate_minute(t: Tables):
    ts = F.col("ts")
    return t.raw("events").select("event_id", cal.truncate(ts, "MINUTE").alias("minute"), cal.truncate(ts, "DAY").alias("midnight"))


@check("""
    SELECT event_id, strftime(ts, '%Y-%m-%d;%H:%M:%S') AS minute_key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second,
           strftime(ts, '%H%M%S') AS slot_number, strftime(ts, '%H:%M:%S') AS slot FROM events""")
def format_timestamp(t: Tables):
    return t.raw("events").select("event_id", *[F.date_format("ts", f).alias(n) for n, f in cal.FORMATS.items()])


@check("""
    SELECT event_id, year(ts) AS Year, month(ts) AS Month, day(ts) AS Day, dayofyear(ts) AS Day_of_year, hour(ts) AS Hour,
           minute(ts) AS Minute, strftime(ts, '%Y-%m-%d') AS Date, isodow(ts) - 1 AS DayOfWeek, isodow(ts) AS DayOfWeek1
    FROM events""")
def calendar_parts(t: Tables):
    parts = cal.calendar_parts(F.col("ts"))
    parts["Date"] = parts["Date"].cast("string")
    return t.raw("events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@check("""
    SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 1 WHEN month(o_orderdate) IN (3, 4, 5) THEN 2
             WHEN month(o_orderdate) IN (6, 7, 8) THEN 3 ELSE 4 END AS Season FROM orders""")
def season(t: Tables):
    return t.raw("orders").select("o_orderkey", cal.season(F.month("o_orderdate")).alias("Season"))


@check("SELECT event_id, CASE WHEN isodow(ts) > 5 THEN 1 ELSE 0 END AS IsWeekend FROM events")
def weekend_flag(t: Tables):
    return t.raw("events").select("event_id", cal.weekend(F.col("ts")).alias("IsWeekend"))


@check("""
    SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_sin,
           round(cos(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_cos FROM events""")
def cyclical_hour(t: Tables):
    s, c = cal.cyclical_hour(F.col("ts"))
    return rounded(t.raw("events").select("event_id", s.alias("hour_sin"), c.alias("hour_cos")))


@check("""
    SELECT event_id, round(sin(2 * pi() * day(ts) / 30), 6) + 0.0 AS sin_day_of_month,
           round(cos(2 * pi() * day(ts) / 30), 6) + 0.0 AS cos_day_of_month FROM events""")
def cyclical_day_of_month(t: Tables):
    s, c = cal.cyclical_day_of_month(F.col("ts"))
    return rounded(t.raw("events").select("event_id", s.alias("sin_day_of_month"), c.alias("cos_day_of_month")))


@check("SELECT event_id, round(Temperature * hour(Time), 6) AS Temperature_Hour FROM measurements")
def interaction_temp_hour(t: Tables):
    product = F.col("Temperature") * F.hour("Time")
    return rounded(t.measurements.select("event_id", product.alias("Temperature_Hour")))


@check("""
    SELECT event_id, round(epoch(SunsetDT - (SunriseDT + INTERVAL (event_id % 600) SECOND)) / 3600.0, 6) AS daylight_duration
    FROM measurements""")
def daylight_hours(t: Tables):
    later = F.col("SunriseDT") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 600).cast("decimal(18,6)"))
    return rounded(t.measurements.select("event_id", cal.daylight_hours(later, F.col("SunsetDT")).alias("daylight_duration")))


@check("""
    SELECT f.ClientId, f.Time, date_trunc('day', f.Time) + (l.rise - date_trunc('day', l.rise)) AS sunrise_dt,
           date_trunc('day', f.Time) + (l.fall - date_trunc('day', l.fall)) AS sunset_dt
    FROM weather_forecast f
    JOIN (SELECT ClientId, arg_max(SunriseDT, Time) AS rise, arg_max(SunsetDT, Time) AS fall FROM measurements GROUP BY 1) l
      ON f.ClientId = l.ClientId""")
def carry_sun_times(t: Tables):
    sun = agg.last_values(t.measurements, ["ClientId"], "Time", ["SunriseDT", "SunsetDT"])
    served = t.weather_forecast.select("ClientId", "Time").join(sun, "ClientId")
    return served.select(
        "ClientId",
        "Time",
        cal.at_time_of_day(F.col("Time"), F.col("SunriseDT")).alias("sunrise_dt"),
        cal.at_time_of_day(F.col("Time"), F.col("SunsetDT")).alias("sunset_dt"),
    )


@check("""
    SELECT e.event_id, round(m.Temperature - 273.15, 6) + 0.0 AS celsius, round(e.PowerToPv / 1000.0, 6) AS kilowatt,
           round(e.PowerToPv * 0.25 / 1000, 6) AS kwh
    FROM energy e JOIN measurements m ON e.event_id = m.event_id""")
def unit_convert(t: Tables):
    both = t.energy.join(t.measurements.select("event_id", "Temperature"), "event_id")
    power = F.col("PowerToPv").cast("double")
    return rounded(
        both.select(
            "event_id",
            val.kelvin_to_celsius(F.col("Temperature")).alias("celsius"),
            val.watt_to_kilowatt(power).alias("kilowatt"),
            val.watt_to_kwh(power).alias("kwh"),
        )
    )


@check("""
    SELECT event_id, coalesce(CASE WHEN LoadEnergyCalculated <= 40000 THEN LoadEnergyCalculated END,
                              CAST(PowerFromLoad AS DOUBLE)) AS SolarPower FROM energy""")
def coalesce_fallback(t: Tables):
    known = val.spike_to_null(F.col("LoadEnergyCalculated"))
    return t.energy.select("event_id", F.coalesce(known, F.col("PowerFromLoad").cast("double")).alias("SolarPower"))


@check("""
    SELECT event_id, Time, CASE WHEN PowerPV - 300 < 0 OR strftime(Time, '%H:%M:%S') < strftime(SunriseDT, '%H:%M:%S')
             OR strftime(Time, '%H:%M:%S') > strftime(SunsetDT, '%H:%M:%S') THEN 0.0 ELSE PowerPV - 300 END AS SolarPower_pred
    FROM measurements""")
def clamp_night(t: Tables):
    clamped = val.night_to_zero(F.col("PowerPV") - 300, F.col("Time"), F.col("SunriseDT"), F.col("SunsetDT"))
    return t.measurements.select("event_id", "Time", clamped.alias("SolarPower_pred"))


@check("SELECT event_id, CAST(strftime(ts, '%H%M%S') AS INT) AS TimeOfDay FROM events")
def time_of_day_number(t: Tables):
    return t.raw("events").select("event_id", cal.time_of_day_number(F.col("ts")).alias("TimeOfDay"))


@check('SELECT event_id AS "Event_id", ts AS "Ts", value AS "Value" FROM events')
def capitalise_columns(t: Tables):
    return val.capitalise_columns(t.raw("events").select("event_id", "ts", "value"))


@check("""
    SELECT ClientId, unnest(generate_series(first, last, INTERVAL 15 MINUTE)) AS bin FROM (
      SELECT ClientId, time_bucket(INTERVAL 15 MINUTE, min(TimeStampMeasured)) AS first,
             time_bucket(INTERVAL 15 MINUTE, max(TimeStampMeasured)) AS last FROM energy GROUP BY 1) q""")
def time_grid(t: Tables):
    bounds = t.energy.groupBy("ClientId").agg(F.min("TimeStampMeasured").alias("a"), F.max("TimeStampMeasured").alias("b"))
    starts = bounds.withColumn("a", cal.bin_start("a")).withColumn("b", cal.bin_start("b"))
    return starts.select("ClientId", F.explode(cal.grid(F.col("a"), F.col("b"))).alias("bin"))


@check("""
    WITH hours AS (
      SELECT ClientId, date_trunc('hour', TimeStampMeasured) AS hour, min(LoadEnergyCalculated) AS lo,
             max(LoadEnergyCalculated) AS hi FROM energy GROUP BY 1, 2)
    SELECT ClientId, hour, CAST(p AS INT) AS p,
           round(CASE p WHEN 0 THEN (lo + hi) / 2 WHEN 1 THEN (hi + hi) / 2 ELSE hi END, 6) AS v
    FROM hours, generate_series(0, 3) g(p)""")
def array_shape_ops(t: Tables):
    """Mean of two arrays, first n, last value held, then flattened with positions."""
    hours = t.energy.groupBy("ClientId", cal.truncate(F.col("TimeStampMeasured"), "HOUR").alias("hour")).agg(
        F.min("LoadEnergyCalculated").alias("lo"), F.max("LoadEnergyCalculated").alias("hi")
    )
    mean = val.mean_of_arrays(F.array("lo", "hi", "lo"), F.array("hi", "hi", "hi"))
    held = val.pad_with_last(F.slice(mean, 1, 2), 2)
    return rounded(hours.select("ClientId", "hour", F.posexplode(held).alias("p", "v")))


@check("""
    SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS version
    FROM part""")
def version_from_name(t: Tables):
    bad = F.when(F.col("p_size") % 7 == 0, F.lit("x")).otherwise(F.lit(""))
    name = F.concat(F.lit("model_4_v"), bad, F.col("p_size").cast("string"), F.lit(".keras"))
    parsed = t.raw("part").select("p_partkey", val.version_of(name).alias("version"))
    return parsed.withColumn("version", F.col("version").cast("double"))
