"""Forecasting jobs against direct computation on small frames."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattloom.operators import columns, linear
from wattloom.plans import load_daily, load_hourly, profiles, slots, solar_daily, sweep
from wattloom.sources import schemas

KEY = ["ClientId"]
START = datetime(2024, 1, 1)


def bins(n):
    return [START + timedelta(minutes=15 * i) for i in range(n)]


def direct(x, y, ridge):
    """Ridge on standardised features with an unpenalised intercept."""
    mean, sd = x.mean(0), x.std(0)
    z = (x - mean) / np.where(sd > 0, sd, 1)
    z[:, sd == 0] = 0
    w = np.linalg.solve(z.T @ z + ridge * np.eye(x.shape[1]), z.T @ (y - y.mean(0))) / np.where(sd > 0, sd, 1)[:, None]
    return np.column_stack([y.mean(0) - mean @ w, w.T])


class TestRidge:
    def frame(self, seed=0, n=300):
        rng = np.random.default_rng(seed)
        pdf = pd.DataFrame(rng.normal(size=(n, 3)) * [1, 50, 0.01] + [0, 1000, 0], columns=["a", "b", "c"])
        pdf["flat"] = 4.0
        pdf["ClientId"] = np.where(rng.random(n) < 0.8, 1, 2)
        pdf["y"] = 3 * pdf.a - 0.2 * pdf.b + 100 * pdf.c + rng.normal(size=n)
        pdf["z"] = pdf.b + rng.normal(size=n)
        return pdf

    def test_equals_direct_solution(self, spark):
        pdf, features = self.frame(), ["a", "b", "c", "flat"]
        df = spark.createDataFrame(pdf).withColumn("ClientId", F.col("ClientId").cast("int")).repartition(7)
        models = linear.fit_ridge(df, KEY, features, ["y", "z"], ridge=2.0)
        for r in models.collect():
            part = pdf[pdf.ClientId == r.ClientId]
            want = direct(part[features].to_numpy(), part[["y", "z"]].to_numpy(), 2.0)
            np.testing.assert_allclose(np.array(r.coefficients), want, rtol=1e-6, atol=1e-6)
            assert r.rows == len(part)
        scored = linear.predict(df, models, KEY, features).toPandas()
        weights = {r.ClientId: np.array(r.coefficients) for r in models.collect()}
        want = [weights[c] @ np.r_[1, x] for c, x in zip(scored.ClientId, scored[features].to_numpy(), strict=True)]
        np.testing.assert_allclose(np.stack(scored.predictions), want)

    def test_too_few_rows_and_nulls(self, spark):
        rows = [(1, 1.0, 2.0), (1, 2.0, None), (1, None, 1.0), (2, 1.0, 1.0), (2, 2.0, 2.0), (2, 3.0, 3.0)]
        df = spark.createDataFrame(rows, "ClientId int, x double, y double")
        models = linear.fit_ridge(df, KEY, ["x"], ["y"], ridge=1e-9, min_rows=3).collect()
        assert [(r.ClientId, r.rows) for r in models] == [(2, 3)]
        np.testing.assert_allclose(models[0].coefficients, [[0, 1]], atol=1e-6)
        lost = linear.predict(df, spark.createDataFrame(models), KEY, ["x"]).where("ClientId = 1")
        assert all(r.predictions is None for r in lost.collect())

    def test_targets_ahead_equal_shipped_targets(self, spark):
        rng = np.random.default_rng(1)
        n, horizon = 120, 5
        pdf = pd.DataFrame({"ClientId": 1, "bin": np.arange(n), "v": rng.normal(size=n), "x": rng.normal(size=n)})
        pdf.loc[[10, 50], "x"] = np.nan
        pdf["is_train"] = pdf.bin < 90
        rows = [(1, int(r.bin), float(r.v), None if np.isnan(r.x) else float(r.x), bool(r.is_train)) for r in pdf.itertuples()]
        df = spark.createDataFrame(rows, "ClientId int, bin int, v double, x double, is_train boolean")
        got = np.array(linear.moments_ahead(df, KEY, "bin", ["v", "x"], "v", horizon, "is_train").first().moments)
        total = np.zeros((3 + horizon, 3 + horizon))
        for i in range(90 - horizon):
            if i not in (10, 50):
                z = np.r_[1, pdf.v[i], pdf.x[i], pdf.v[i + 1 : i + 1 + horizon]]
                total += np.outer(z, z)
        np.testing.assert_allclose(got.reshape(total.shape), total)


def site_readings(spark, days, seed=0, sites=(1, 2)):
    """One reading per five minutes with a daily shape, and weather every ten."""
    rng = np.random.default_rng(seed)
    rows, sky = [], []
    for site in sites:
        for i in range(days * 288):
            ts = START + timedelta(minutes=5 * i)
            base = 5000 * site * (1.5 + np.sin(2 * np.pi * ts.hour / 24))
            rows.append((site, ts, float(base / 3 + rng.normal() * 20), int(base + rng.normal() * 50)))
            if i % 2 == 0:
                sky.append((site, ts, float(280.0 + 5 * np.sin(2 * np.pi * i / 288)), 50 + i % 7, 3, 1000, 2.0))
    energy = spark.createDataFrame(
        rows, "ClientId int, TimeStampMeasured timestamp_ntz, LoadEnergyCalculated double, PowerFromLoad long"
    )
    measurements = spark.createDataFrame(
        sky, "ClientId int, Time timestamp_ntz, Temperature double, Humidity int, Clouds int, Pressure int, WindSpeed double"
    )
    return energy, measurements


class TestDailyLoad:
    def test_forecast_follows_the_daily_shape(self, spark):
        energy, measurements = site_readings(spark, 12)
        out = load_daily.forecast(energy, measurements, cutoff="2020-01-01 00:00:00").toPandas()
        assert out.groupby("ClientId").size().tolist() == [100, 100]
        for site, part in out.sort_values("Timestamp").groupby("ClientId"):
            assert part.Timestamp.tolist() == bins(12 * 96 + 100)[12 * 96 :]
            hours = part.Timestamp.dt.hour.to_numpy()[:96]
            shape = 5000 * site * (1.5 + np.sin(2 * np.pi * hours / 24))
            got = part[load_daily.FORECAST].to_numpy()
            assert np.abs(got[:96] - shape).mean() < 0.1 * shape.mean()
            assert (got[96:] == got[95]).all()

    def test_repeatable(self, spark):
        energy, measurements = site_readings(spark, 8, sites=(1,))
        first, second = (
            load_daily.forecast(energy.repartition(n), measurements, cutoff="2020-01-01 00:00:00").orderBy("Timestamp").toPandas()
            for n in (2, 5)
        )
        pd.testing.assert_frame_equal(first, second, rtol=1e-6)

    def test_short_sites_get_no_forecast(self, spark):
        energy, measurements = site_readings(spark, 3, sites=(1,))
        assert load_daily.forecast(energy, measurements, cutoff="2020-01-01 00:00:00").count() == 0

    def test_evaluation_uses_held_out_rows_only(self, spark):
        energy, measurements = site_readings(spark, 12, sites=(1,))
        parts = load_daily.split(load_daily.supervised(energy, measurements, cutoff="2020-01-01 00:00:00")).cache()
        usable = parts.where("usable").count()
        assert parts.where("usable AND is_train").count() == int(0.8 * usable)
        errors = load_daily.held_out(parts, load_daily.train(parts))
        assert errors.agg(F.min("bin")).first()[0] > parts.where("is_train").agg(F.max("bin")).first()[0]
        assert load_daily.evaluate(parts, load_daily.train(parts)).first().WMAPE_percent < 10


    def test_only_better_models_replace_the_old_ones(self, spark):
        energy, measurements = site_readings(spark, 10)
        parts = load_daily.split(load_daily.supervised(energy, measurements, cutoff="2020-01-01 00:00:00")).cache()
        none = spark.createDataFrame([], schemas.RUNS)
        runs, first = load_daily.retrain(parts, none, None, "2024-01-11T00:01:00")
        assert [r.was_in_use for r in runs.collect()] == [True, True]
        # site 1 had a poor model in use, site 2 a perfect one
        old = columns.cast_to(
            spark.createDataFrame(
                [(1, "2024-01-01T00:00:00", 1e6, 1e6, True), (2, "2024-01-01T00:00:00", 0.0, 0.0, True)],
                "ClientId int, TrainEnd string, WMAPE_percent double, RMSE double, was_in_use boolean",
            ),
            schemas.RUNS,
        )
        kept = first.withColumn("rows", F.lit(-1).cast("long"))
        runs, active = load_daily.retrain(parts, old, kept, "2024-01-11T00:01:00")
        assert {r.ClientId: r.was_in_use for r in runs.collect()} == {1: True, 2: False}
        models = {r.ClientId: r.rows for r in active.collect()}
        assert models[1] > 0 and models[2] == -1 and len(models) == 2


class TestHourlyLoad:
    def test_four_steps_after_now(self, spark):
        energy, measurements = site_readings(spark, 4)
        now = "2024-01-04 11:45:00"
        out = load_hourly.forecast(energy, measurements, now, trees=10, depth=4).orderBy("ClientId", "h").toPandas()
        assert out.h.tolist() == [1, 2, 3, 4] * 2
        assert out.Time.tolist()[:4] == [datetime(2024, 1, 4, 12) + timedelta(minutes=15 * k) for k in range(4)]
        for site, part in out.groupby("ClientId"):
            shape = 5000 * site * (1.5 + np.sin(2 * np.pi * 12 / 24))
            assert np.abs(part.LoadPower - shape).mean() < 0.5 * shape

    def test_steps_follow_the_daily_shape_and_sites_scale(self, spark):
        energy, measurements = site_readings(spark, 6)
        out = load_hourly.forecast(energy, measurements, "2024-01-06 08:45:00", trees=20, depth=4).toPandas()
        by_site = {c: p.sort_values("h").LoadPower.to_numpy() for c, p in out.groupby("ClientId")}
        assert all(len(set(v.round(3))) > 1 for v in by_site.values())
        # site 2 has twice the power of site 1 and shares its models
        np.testing.assert_allclose(by_site[2] / by_site[1], 2, rtol=0.1)

    def test_targets_and_labels(self, spark):
        energy, measurements = site_readings(spark, 2, sites=(1,))
        table = load_hourly.supervised(energy, measurements)
        long = load_hourly.long_form(table)
        series = {r.bin: r[load_hourly.TARGET] for r in load_hourly.merged_series(energy, measurements).collect()}
        rows = long.select("bin", "h", "label").collect()
        assert rows and all(series[r.bin + timedelta(minutes=15 * r.h)] == r.label for r in rows)
        origins = [r.bin for r in table.collect()]
        known = [series.get(b + timedelta(minutes=15 * h)) is not None for b in origins for h in range(1, 5)]
        assert len(rows) == sum(known) < 4 * len(origins)


    def test_no_full_history_gives_no_rows(self, spark):
        energy, measurements = site_readings(spark, 1, sites=(1,))
        out = load_hourly.forecast(energy.where(F.hour("TimeStampMeasured") % 2 == 0), measurements, "2024-01-01 20:00:00")
        assert out.columns == ["ClientId", "h", "Time", "LoadPower"] and out.isEmpty()


class TestRecords:
    def test_records_give_the_same_forecast(self, spark):
        from checks.tables import Tables
        from checks.forecasts import batch_score, batch_score_records
        from conftest import SF

        names = ["ClientId", "Timestamp", F.round(load_daily.FORECAST, 4)]
        direct, records = (query(Tables(spark, SF)).select(names) for query in (batch_score, batch_score_records))
        assert direct.count() == records.count() == 500
        assert direct.exceptAll(records).isEmpty()


class TestSlots:
    def test_hundred_rows_and_default(self, spark):
        rows = []
        for d in range(22):
            for s in range(96):
                if s != 5:
                    rows.append((1, START + timedelta(days=d, minutes=15 * s), float(100 * s + (d % 2) * 10)))
        series = spark.createDataFrame(rows, "ClientId int, bin timestamp_ntz, ConsumerPower1 double")
        out = slots.forecast(series).orderBy("Time").toPandas()
        assert out.Time.tolist()[:96] == [START + timedelta(days=22, minutes=15 * s) for s in range(96)]
        assert out.Time.tolist()[96:] == [START + timedelta(days=23, minutes=15 * s) for s in (1, 2, 3, 4)]
        assert out.Predicted[5] == 0
        # days alternate by 10 within a slot, and day 22 is an even one
        others = [s for s in range(96) if s != 5]
        np.testing.assert_allclose(out.Predicted[others], [100 * s for s in others], atol=8)
        assert out.Predicted[96:].tolist() == out.Predicted[1:5].tolist()


class TestProfiles:
    def test_clusters_and_blend(self, spark):
        rng = np.random.default_rng(3)
        rows = []
        for site in (1, 2):
            for d in range(14):
                shape = np.arange(96) if d % 2 else np.arange(96)[::-1]
                for s in range(96):
                    rows.append((site, START + timedelta(days=d, minutes=15 * s), float(site * (shape[s] + 10 + rng.normal() * 0.01))))
        series = spark.createDataFrame(rows, "ClientId int, bin timestamp_ntz, v double")
        days = profiles.profiles(series, "v")
        assert days.select(F.size("profile")).distinct().collect() == [(100,)]
        assigned, scaler, model = profiles.cluster(days, k=2)
        got = {(r.ClientId, r.Date.day): r.cluster for r in assigned.collect()}
        # the last four slots belong to the day after, so the last day may stand alone
        for site in (1, 2):
            assert len({got[site, d] for d in range(1, 13, 2)}) == 1
            assert len({got[site, d] for d in range(2, 13, 2)}) == 1
            assert got[site, 1] != got[site, 2]

        ahead = spark.createDataFrame(
            [(1, START + timedelta(days=20, minutes=15 * s), float(s + 10)) for s in range(96)],
            "ClientId int, Time timestamp_ntz, Predicted double",
        )
        out = profiles.hybrid_forecast(ahead, scaler, model).orderBy("Time").toPandas()
        assert len(out) == 100
        state = scaler.where("ClientId = 1").first()
        means, stds = np.array(state.means), np.array(state.stds)
        profile = np.r_[np.arange(96) + 10.0, [105.0] * 4]
        scaled = (profile - means) / np.where(stds == 0, 1, stds)
        centres = np.array(model.clusterCenters())
        centre = centres[((centres - scaled) ** 2).sum(1).argmin()] * np.where(stds == 0, 1, stds) + means
        np.testing.assert_allclose(out.lstm_predictions, profile)
        np.testing.assert_allclose(out.hybrid_predictions, (profile + centre) / 2)
        hours = profiles.hourly(profiles.hybrid_forecast(ahead, scaler, model)).orderBy("bin").toPandas()
        np.testing.assert_allclose(hours.lstm_predictions, profile.reshape(25, 4).mean(1))

    def test_gaps_take_the_day_before(self, spark):
        rows = [(1, START + timedelta(days=d, minutes=15 * s), 10.0 * d + s) for d in range(3) for s in range(96) if (d, s) != (1, 7)]
        series = spark.createDataFrame(rows, "ClientId int, bin timestamp_ntz, v double")
        filled = {r.bin: r.v for r in profiles.filled_days(series, "v").collect()}
        assert filled[START + timedelta(days=1, minutes=15 * 7)] == 7
        assert len(filled) == 288


class TestSweep:
    def test_against_direct_fit(self, spark):
        rng = np.random.default_rng(7)
        n, test, horizon = 160, 40, 3
        v = np.sin(np.arange(n) / 5) + rng.normal(size=n) * 0.1
        rows = [(1, ts, float(x)) for ts, x in zip(bins(n), v, strict=True)]
        series = spark.createDataFrame(rows, "ClientId int, bin timestamp_ntz, v double")
        scores = sweep.sweep(series, "v", test_rows=test, lengths=[4, 8, 500], ridges=[1.0], horizon=horizon)
        got = {r.seq_len: (r.huber_scaled, r.mse_scaled, r.mae_scaled) for r in scores.collect()}
        assert set(got) == {4, 8}
        train = v[: n - test]
        scaled = (v - train.min()) / (train.max() - train.min())
        for length in (4, 8):
            origins = range(8, n - test - horizon + 1)
            x = np.array([scaled[i - length : i][::-1] for i in origins])
            y = np.array([scaled[i : i + horizon] for i in origins])
            w = direct(x, y, 1.0)
            later = range(n - test, n - horizon + 1)
            error = np.array([scaled[i : i + horizon] - w @ np.r_[1, scaled[i - length : i][::-1]] for i in later])
            small = np.abs(error) <= 1
            huber = np.where(small, error**2 / 2, np.abs(error) - 0.5).mean()
            np.testing.assert_allclose(got[length], (huber, (error**2).mean(), np.abs(error).mean()), rtol=1e-8)
        best = sweep.best_trial(scores).first()
        assert best.huber_scaled == min(h for h, _, _ in got.values())


class TestSolar:
    def frames(self, spark, days=8):
        rows, history, energy, served = [], [], [], []
        for i in range(days * 96):
            ts = START + timedelta(minutes=15 * i)
            hour = ts.hour + ts.minute / 60
            power = max(0.0, float(10 * np.sin(np.pi * (hour - 6) / 12))) if 6 <= hour <= 18 else 0.0
            day = datetime(ts.year, ts.month, ts.day)
            rows.append((1, ts, 275.0 + power, 60.0, power, "Clear" if power else "Night", "x", day + timedelta(hours=6), day + timedelta(hours=18)))
            if i < 4 * 96:
                history.append((1, ts, power))
            energy.append((1, ts + timedelta(seconds=20), int(power * 1000)))
        for h in range(30):
            ts = START + timedelta(days=days, hours=h)
            hour = ts.hour
            power = max(0.0, float(10 * np.sin(np.pi * (hour - 6) / 12))) if 6 <= hour <= 18 else 0.0
            served.append((1, ts, 1.85 + power, 60.0, "Clear" if power else "Storm", "x"))
        return (
            spark.createDataFrame(
                rows,
                "ClientId int, Time timestamp_ntz, Temperature double, Humidity double, PowerPV double, Weather string,"
                " WeatherDescription string, SunriseDT timestamp_ntz, SunsetDT timestamp_ntz",
            ),
            spark.createDataFrame(history, "ClientId int, Time timestamp_ntz, SolarPower double"),
            spark.createDataFrame(energy, "ClientId int, TimeStampMeasured timestamp_ntz, PowerToPv long"),
            spark.createDataFrame(
                served, "ClientId int, Time timestamp_ntz, Temperature double, Humidity double, Weather string, WeatherDescription string"
            ),
        )

    def test_series_joins_history_and_meter_without_overlap(self, spark):
        measurements, history, energy, _ = self.frames(spark)
        series = solar_daily.training_series(measurements, history, energy)
        assert series.count() == 8 * 96 and series.select("bin").distinct().count() == 8 * 96
        noon = series.where(F.hour("bin") == 12).where(F.minute("bin") == 0).collect()
        assert all(r.SolarPower == pytest.approx(10) and r.Temperature == pytest.approx(275 + 10 - 273.15) for r in noon)

    def test_site_without_history_is_fitted_on_its_meter(self, spark):
        measurements, history, energy, _ = self.frames(spark, days=1)
        elsewhere = history.withColumn("ClientId", F.lit(9))
        assert solar_daily.training_series(measurements, elsewhere, energy).count() == 96

    def test_no_readings_give_no_rows(self, spark):
        measurements, history, energy, served = self.frames(spark, days=1)
        out = solar_daily.forecast(measurements.limit(0), history, energy, served, "2024-01-09 00:01:00", ["Temperature", "Humidity"])
        assert out.isEmpty() and "SolarPower_pred" in out.columns

    def test_forecast_is_dark_at_night_and_bright_at_noon(self, spark):
        measurements, history, energy, served = self.frames(spark)
        out = solar_daily.forecast(
            measurements, history, energy, served, "2024-01-09 00:01:00", ["Temperature", "Humidity"], trees=5, depth=4
        ).orderBy("Time").toPandas()
        assert out.Time.tolist() == [datetime(2024, 1, 9) + timedelta(minutes=15 * i) for i in range(29 * 4 + 1)]
        clock = out.Time.dt.strftime("%H:%M:%S")
        assert (out.SolarPower_pred[(clock < "06:00:00") | (clock > "18:00:00")] == 0).all()
        assert (out.SolarPower_pred >= 0).all()
        assert out.SolarPower_pred[(clock >= "11:00:00") & (clock <= "13:00:00")].min() > 5
