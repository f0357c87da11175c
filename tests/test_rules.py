"""Small frames with results worked out by hand."""

from datetime import date, datetime

import pandas
import pytest
from pyspark.sql import functions as F

from wattloom.functions import calendar as cal
from wattloom.functions import values as val
from wattloom.operators import aggregates as agg
from wattloom.operators import assembly, columns, filters, joins, metrics, ordered, sets, transforms
from wattloom.plans import gate, load_daily, publish

KEY = ["ClientId"]


def t(text, day="2024-01-01"):
    return datetime.fromisoformat(f"{day} {text}")


def readings(spark, pairs, client=1):
    rows = [(client, t(at), None if v is None else float(v)) for at, v in pairs]
    return spark.createDataFrame(rows, "ClientId int, TimeStampMeasured timestamp_ntz, LoadEnergyCalculated double")


class TestEnergySeries:
    def series(self, df):
        out = load_daily.energy_series(df, "2020-01-01 00:00:00")
        return [r[load_daily.TARGET] for r in out.orderBy("ClientId", "bin").collect()]

    def test_spike_is_filled_before_the_sum(self, spark):
        df = readings(spark, [("00:01:00", 1), ("00:16:00", 2), ("00:17:00", 50000), ("01:02:00", 4)])
        assert self.series(df) == [1, 4, 0, 0, 4]

    def test_spike_that_opens_a_bin_takes_an_earlier_bin(self, spark):
        df = readings(spark, [("00:01:00", 7), ("00:40:00", 50000), ("00:41:00", 60000), ("00:42:00", 1)])
        assert self.series(df) == [7, 0, 15]

    def test_bin_of_spikes_only_passes_on_the_older_value(self, spark):
        df = readings(spark, [("00:01:00", 7), ("00:16:00", 50000), ("00:31:00", 50000)])
        assert self.series(df) == [7, 7, 7]

    def test_spike_without_any_earlier_value_adds_nothing(self, spark):
        df = readings(spark, [("00:01:00", 50000), ("00:02:00", 3), ("00:16:00", 50000)])
        assert self.series(df) == [3, 3]

    def test_sum_above_the_limit_takes_the_bin_before(self, spark):
        df = readings(spark, [("00:01:00", 5), ("00:16:00", 30000), ("00:17:00", 30000), ("00:31:00", 2)])
        assert self.series(df) == [5, 5, 2]

    def test_first_sum_above_the_limit_stays_null(self, spark):
        df = readings(spark, [("00:01:00", 30000), ("00:02:00", 30000), ("00:16:00", 2)])
        assert self.series(df) == [None, 2]

    def test_sites_do_not_mix(self, spark):
        a = readings(spark, [("00:01:00", 1), ("00:20:00", 50000)], 1)
        b = readings(spark, [("00:05:00", 9), ("00:16:00", 50000)], 2)
        assert self.series(a.union(b)) == [1, 1, 9, 9]


class TestResample:
    def test_sum_is_zero_and_mean_is_null_in_a_gap(self, spark):
        df = readings(spark, [("00:00:00", 1), ("00:14:59", 2), ("00:15:00", 4), ("00:46:00", None)])
        value = "LoadEnergyCalculated"
        sums = agg.resample_sum(df, KEY, "TimeStampMeasured", [value]).orderBy("bin").collect()
        means = agg.resample_mean(df, KEY, "TimeStampMeasured", [value]).orderBy("bin").collect()
        assert [r[value] for r in sums] == [3, 4, 0, 0]
        assert [r[value] for r in means] == [1.5, 4, None, None]

    def test_mode_prefers_the_largest_and_names_nothing(self, spark):
        values = [(1, v) for v in ["b", "a", "c", "a", "b"]] + [(2, None), (2, None)]
        df = spark.createDataFrame(values, "k int, v string")
        assert sorted(map(tuple, agg.modes(df, ["k"], ["v"]).collect())) == [(1, "b"), (2, "Unknown")]

    def test_mixed_gap_rows(self, spark):
        df = spark.createDataFrame(
            [(1, t("00:01:00"), 2.0, "x", t("06:00:00")), (1, t("00:31:00"), 4.0, "y", None)],
            "ClientId int, Time timestamp_ntz, n double, w string, s timestamp_ntz",
        )
        out = agg.resample_mixed(df, KEY, "Time").orderBy("bin").collect()
        assert [(r.n, r.w, r.s) for r in out] == [(2, "x", t("06:00:00")), (None, "Unknown", None), (4, "y", None)]

    def test_spine_drops_off_grid_rows_and_reaches_the_last_instant(self, spark):
        df = spark.createDataFrame(
            [(1, t("00:00:00"), 1), (1, t("00:20:00"), 2), (1, t("00:30:00"), 3), (1, t("01:05:00"), 4)],
            "ClientId int, Time timestamp_ntz, v int",
        )
        out = joins.join_spine_left(df, KEY, "Time").orderBy("Time").collect()
        assert [(r.Time.strftime("%H:%M"), r.v) for r in out] == [
            ("00:00", 1), ("00:15", None), ("00:30", 3), ("00:45", None), ("01:00", None)
        ]


class TestQuantiles:
    @pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0] * 50 + [1.0, 9.0], [float(i * i % 97) for i in range(1000)]])
    def test_against_sorted_list(self, spark, values):
        df = spark.createDataFrame([(1, v) for v in values], "k int, v double")
        got = {r.probability: r.quantile for r in agg.quantiles(df, ["k"], "v", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
        ordered_values = sorted(values)
        for p, q in got.items():
            rank = p * (len(values) - 1)
            low, part = int(rank), rank - int(rank)
            high = min(low + 1, len(values) - 1)
            assert q == pytest.approx(ordered_values[low] + (ordered_values[high] - ordered_values[low]) * part)
        assert len(got) == 5


class TestSolarPairs:
    def test_weights_stand_for_pairs(self, spark):
        def at(minute, second):
            return t(f"00:{minute:02d}:{second:02d}")

        sky = [(1, at(0, 1), 1.0, 5.0, "a"), (1, at(0, 30), 4.0, None, "b"), (1, at(1, 0), 9.0, 7.0, "b"), (1, at(20, 0), 2.0, None, "a"),
               (1, at(21, 0), 3.0, None, "c"), (1, at(21, 9), 5.0, 2.0, "c"), (1, at(50, 0), 1.0, None, "z")]
        measurements = spark.createDataFrame(sky, "ClientId int, Time timestamp_ntz, Temperature double, PowerPV double, Weather string")
        history = spark.createDataFrame(
            [(1, at(0, 0), 1.0), (1, at(0, 0), 2.0), (1, at(0, 0), None), (1, at(1, 0), 8.0)],
            "ClientId int, Time timestamp_ntz, SolarPower double",
        )
        energy = spark.createDataFrame(
            [(1, at(20, 1), 1000), (1, at(20, 2), 3000), (1, at(21, 2), None), (1, at(21, 3), 6000)],
            "ClientId int, TimeStampMeasured timestamp_ntz, PowerToPv long",
        )
        since = joins.cut_over(measurements, history)
        pairs = sets.union_all(
            joins.join_pv_history(measurements, history), joins.join_pv_recent(measurements, energy, since)
        ).drop("PowerPV")
        weighed = sets.union_all(
            joins.weigh_pv_history(measurements, history), joins.weigh_pv_recent(measurements, energy, since)
        ).drop("PowerPV")
        want = agg.resample_mixed(pairs, KEY, "Time").orderBy("bin").toPandas()
        got = agg.resample_mixed(weighed, KEY, "Time", weight="pairs", weights={"SolarPower": "known"}).orderBy("bin").toPandas()
        pandas.testing.assert_frame_equal(got[want.columns], want)
        assert len(weighed.collect()) == len(sky) < pairs.count()


class TestTime:
    def test_autumn_hour_keeps_two_keys(self, spark):
        df = spark.createDataFrame([(t("00:30:00", "2025-10-26"),), (t("01:30:00", "2025-10-26"),)], "ts timestamp_ntz")
        out = df.select("ts", cal.to_local(F.col("ts")).alias("local")).collect()
        assert {r.local for r in out} == {t("02:30:00", "2025-10-26")}
        assert len({r.ts for r in out}) == 2

    def test_season_of_every_month(self, spark):
        months = spark.range(1, 13).select(cal.season(F.col("id")).alias("s")).collect()
        assert [r.s for r in months] == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]

    def test_recent_days_start_at_local_midnight(self, spark):
        stamps = [t("22:59:59", "2024-07-02"), t("22:00:00", "2024-07-02"), t("21:59:59", "2024-07-02")]
        df = spark.createDataFrame([(s,) for s in stamps], "Time timestamp_ntz")
        kept = filters.recent_days(df, "Time", "2024-07-10 12:00:00").collect()
        assert sorted(r.Time for r in kept) == sorted(stamps[:2])

    def test_night_bounds_count_as_day(self, spark):
        rows = [(t(at), v) for at, v in [("05:59:59", 5.0), ("06:00:00", 5.0), ("18:00:00", 5.0), ("18:00:01", 5.0), ("12:00:00", -1.0)]]
        df = spark.createDataFrame(rows, "ts timestamp_ntz, v double").withColumns(
            {"rise": F.lit(t("06:00:00")).cast("timestamp_ntz"), "fall": F.lit(t("18:00:00")).cast("timestamp_ntz")}
        )
        out = df.orderBy("ts").select("ts", val.night_to_zero(F.col("v"), F.col("ts"), F.col("rise"), F.col("fall")).alias("p"))
        assert [r.p for r in sorted(out.collect())] == [0, 5, 0, 5, 0]


class TestFilters:
    def test_range_excludes_start_and_includes_end(self, spark):
        df = readings(spark, [("00:00:00", 1), ("00:00:01", 2), ("01:00:00", 3), ("01:00:01", 4)])
        kept = filters.half_open_range(df, "TimeStampMeasured", "2024-01-01 00:00:00", "2024-01-01 01:00:00")
        assert sorted(r.LoadEnergyCalculated for r in kept.collect()) == [2, 3]

    def test_power_band_drops_nulls(self, spark):
        df = spark.createDataFrame([(2999,), (3000,), (149999,), (150000,), (None,)], "p int")
        assert sorted(r.p for r in filters.power_band(df, "p").collect()) == [3000, 149999]

    def test_bad_timestamps_are_dropped(self, spark):
        df = spark.createDataFrame([("2024-01-01 00:00:00",), ("nonsense",), (None,)], "s string")
        assert [r.ts for r in filters.drop_bad_timestamps(df, "s", "ts").collect()] == [t("00:00:00")]

    def test_guard_ignores_nan_and_infinity(self, spark):
        rows = [(1, v) for v in (1.0, float("nan"), float("inf"), None, 2.0)]
        df = spark.createDataFrame(rows, "ClientId int, v double")
        assert tuple(filters.min_history_guard(df, KEY, 3, "v").first()) == (1, 2, False)

    def test_asof_takes_whole_last_row(self, spark):
        rows = [(1, t("00:00:00"), 1, "a"), (1, t("01:00:00"), None, "b"), (1, t("02:00:00"), 3, "c")]
        df = spark.createDataFrame(rows, "ClientId int, ts timestamp_ntz, v int, s string")
        assert tuple(filters.asof_last_row(df, KEY, "ts", "2024-01-01 01:30:00").first()) == rows[1]


class TestZones:
    def test_truncation_and_labels_ignore_the_session_zone(self, spark):
        """The local spring gap and the autumn hour are ordinary hours of a naive UTC clock."""
        stamps = ["2025-03-30 02:30:10.5", "2025-03-30 01:59:59", "2025-10-26 02:30:10", "2025-03-30 03:00:00"]
        df = spark.createDataFrame([(s,) for s in stamps], "s string")
        before = spark.conf.get("spark.sql.session.timeZone")
        got = {}
        for zone in ("UTC", "Europe/Ljubljana"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            try:
                ts = F.col("s").cast("timestamp_ntz")
                out = df.select(
                    *[cal.truncate(ts, u).cast("string").alias(u) for u in ("SECOND", "MINUTE", "HOUR", "DAY")],
                    cal.slot(ts).alias("slot"),
                    val.night_to_zero(F.lit(1.0), ts, F.lit("2025-01-01 02:15:00").cast("timestamp_ntz"), F.lit("2025-01-01 18:00:00").cast("timestamp_ntz")).alias("p"),
                )
                got[zone] = out.collect()
            finally:
                spark.conf.set("spark.sql.session.timeZone", before)
        assert got["UTC"] == got["Europe/Ljubljana"]
        assert tuple(got["UTC"][0]) == ("2025-03-30 02:30:10", "2025-03-30 02:30:00", "2025-03-30 02:00:00", "2025-03-30 00:00:00", "02:30:10", 1.0)

    def test_as_of_row_is_one_row(self, spark):
        rows = [(1, datetime(2025, 1, 1), 1, "b"), (1, datetime(2025, 1, 1), 2, "a"), (1, datetime(2025, 1, 2), 0, None), (2, datetime(2025, 1, 1), None, "x")]
        df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, a int, b string")
        got = sorted(map(tuple, filters.asof_last_row(df, ["k"], "ts", "2025-01-01 12:00:00").collect()))
        assert got == [(1, datetime(2025, 1, 1), 2, "a"), (2, datetime(2025, 1, 1), None, "x")]

    def test_replaced_rows_go_for_sites_without_a_forecast(self, spark):
        old = spark.createDataFrame([(c, datetime(2025, 1, d), 5) for c in (1, 2) for d in (1, 3)], "ClientId int, Time timestamp_ntz, LoadPower long")
        new = spark.createDataFrame([(1, datetime(2025, 1, 4), 7)], old.schema)
        got = sorted(map(tuple, publish.hourly_load(old, new, "2025-01-02 00:00:00").collect()))
        assert got == [(1, datetime(2025, 1, 1), 5), (1, datetime(2025, 1, 4), 7), (2, datetime(2025, 1, 1), 5)]

    def test_site_without_a_cut_over_keeps_its_readings(self, spark):
        readings = spark.createDataFrame([(1, datetime(2025, 1, 1), 2.0), (2, datetime(2025, 1, 1), 3.0)], "ClientId int, Time timestamp_ntz, PowerPV double")
        energy = spark.createDataFrame([], "ClientId int, TimeStampMeasured timestamp_ntz, PowerToPv long")
        since = spark.createDataFrame([(1, datetime(2025, 1, 2))], "ClientId int, cut_over timestamp_ntz")
        assert [(r.ClientId, r.SolarPower) for r in joins.join_pv_recent(readings, energy, since).collect()] == [(2, 3.0)]


class TestTransforms:
    def test_constant_column_scales_to_zero_and_back(self, spark):
        df = spark.createDataFrame([(1, 7.0), (1, 7.0)], "ClientId int, v double")
        params = transforms.fit_minmax(df, KEY, ["v"])
        scaled = transforms.minmax_scale(df, params, KEY, ["v"])
        assert [r.v for r in scaled.collect()] == [0, 0]
        assert [r.v for r in transforms.minmax_inverse(scaled, params, KEY, "v").collect()] == [7, 7]
        moments = transforms.fit_standard(df, KEY, ["v"])
        standard = transforms.standard_scale(df, moments, KEY, ["v"])
        assert [r.v for r in standard.collect()] == [0, 0]
        assert [r.v for r in transforms.standard_inverse(standard, moments, KEY, ["v"]).collect()] == [7, 7]

    def test_values_outside_the_fitted_range_are_not_clipped(self, spark):
        df = spark.createDataFrame([(1, 0.0), (1, 10.0)], "ClientId int, v double")
        new = spark.createDataFrame([(1, 15.0), (1, -5.0)], "ClientId int, v double")
        out = transforms.minmax_scale(new, transforms.fit_minmax(df, KEY, ["v"]), KEY, ["v"])
        assert sorted(r.v for r in out.collect()) == [-0.5, 1.5]

    def test_labels_and_unseen(self, spark):
        train = spark.createDataFrame([("c",), ("a",), ("b",), ("a",), ("ab",)], "w string")
        serve = spark.createDataFrame([("a",), ("zz",), ("c",)], "w string")
        labels = transforms.fit_labels(train, [], "w")
        assert sorted(map(tuple, labels.select("w", "code").collect())) == [("a", 0), ("ab", 1), ("b", 2), ("c", 3)]
        codes = {r.w: r.w_encoded for r in transforms.safe_label_encode(serve, labels, [], "w").collect()}
        assert codes == {"a": 0, "zz": 0, "c": 3}
        assert [r.w for r in joins.anti_unseen(serve, labels, ["w"]).collect()] == ["zz"]

    def test_monday_has_no_column(self, spark):
        df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 7),)], "d date").withColumn("ts", F.col("d").cast("timestamp_ntz"))
        hot = transforms.one_hot_weekday(df, "ts").orderBy("d").drop("d", "ts").collect()
        assert [sum(r) for r in hot] == [0, 1] and hot[1].DayOfWeek_6 == 1


class TestColumns:
    def test_align(self, spark):
        df = spark.createDataFrame([(1, 2, 3)], "a int, b int, x int")
        assert columns.align_columns(df, ["b", "c", "a"]).first().asDict() == {"b": 2, "c": 0, "a": 1}

    def test_union_keeps_repeats(self, spark):
        a = spark.createDataFrame([(1, 2)], "a int, b int")
        b = spark.createDataFrame([(1,)], "a int")
        assert sorted(map(tuple, sets.union_all(a, a, b).na.fill(-1).collect())) == [(1, -1), (1, 2), (1, 2)]

    def test_version_of_odd_names(self, spark):
        names = ["model_4_v10.keras", "model_4_v9.keras", "model_4_vx.keras", "other.keras", "model_7_v2.keras"]
        files = spark.createDataFrame([(n,) for n in names], "file_name string")
        assert sorted(map(tuple, gate.latest_version(files).collect())) == [(4, 10, 11), (7, 2, 3)]

    def test_latest_date(self, spark):
        names = ["bilstm_4_dommm_2025-01-02.keras", "bilstm_4_dommm_2025-03-01.keras", "bilstm_4_dommm_bad.keras"]
        files = spark.createDataFrame([(n,) for n in names], "file_name string")
        assert [tuple(r) for r in gate.latest_dated(files).collect()] == [("bilstm_4_dommm", date(2025, 3, 1))]


class TestMetrics:
    def test_by_hand(self, spark):
        df = spark.createDataFrame([(1, 2.0, 1.0), (1, 4.0, 7.0)], "k int, y double, p double")
        r = metrics.evaluate(df, ["k"], "y", "p").first()
        assert (r.MAE, r.MSE, r.Huber) == (2, 5, 1.5)
        assert r.R2 == pytest.approx(1 - 10 / 2)
        assert r.SMAPE_percent == pytest.approx((100 / 3 + 300 / 11) / 2)
        assert r.WMAPE_percent == pytest.approx(400 / 6)

    def test_flat_target_has_no_r2(self, spark):
        df = spark.createDataFrame([(1, 2.0, 1.0), (1, 2.0, 3.0)], "k int, y double, p double")
        assert metrics.evaluate(df, ["k"], "y", "p", ["R2"]).first().R2 is None

    def test_gate(self, spark):
        champion = spark.createDataFrame([(1, 100.0, 100.0)], "ClientId int, WMAPE_percent double, RMSE double")
        rows = [(1, 98.0, 100.0), (1, 98.0, 102.0), (1, 99.5, 90.0), (2, 500.0, 500.0)]
        new = spark.createDataFrame(rows, "ClientId int, WMAPE_percent double, RMSE double")
        decided = gate.champion_gate(new, champion).collect()
        assert {(r.ClientId, r.WMAPE_percent, r.RMSE): r.accepted for r in decided} == dict(zip(rows, [True, False, False, True], strict=True))

    def test_newest_run_in_use(self, spark):
        rows = [(1, "2024-01-01", True, 1), (1, "2024-03-01", False, 2), (1, None, True, 3), (1, "2024-02-01", True, 4)]
        runs = spark.createDataFrame(rows, "ClientId int, TrainEnd string, was_in_use boolean, run_id int")
        runs = runs.withColumn("TrainEnd", F.try_to_timestamp("TrainEnd"))
        assert gate.latest_in_use(runs, "run_id").first().run_id == 4


class TestAssembly:
    def test_grid_and_hold(self, spark):
        df = spark.createDataFrame([(1, t("23:30:00")), (1, t("23:45:00"))], "ClientId int, bin timestamp_ntz")
        grid = assembly.future_grid(df, KEY, "bin", 2).orderBy("h").collect()
        assert [(r.h, r.Timestamp) for r in grid] == [(1, t("00:00:00", "2024-01-02")), (2, t("00:15:00", "2024-01-02"))]
        forecast = spark.createDataFrame([(1, r.Timestamp, float(r.h)) for r in grid], "ClientId int, Timestamp timestamp_ntz, p double")
        held = assembly.hold_last(forecast, KEY, "Timestamp", "p").orderBy("Timestamp").collect()
        assert [r.p for r in held] == [1, 2, 2, 2, 2, 2]
        assert held[-1].Timestamp == t("01:15:00", "2024-01-02")

    def test_next_day_head(self, spark):
        days = [(1, date(2024, 1, d), [float(10 * d + i) for i in range(n)]) for d, n in ((1, 4), (3, 5), (4, 1), (5, 4))]
        df = spark.createDataFrame(days, "ClientId int, Date date, values array<double>")
        out = {r.Date.day: r.profile for r in joins.join_next_day_head(df, KEY, 2, 4).collect()}
        assert out == {1: [10, 11, 12, 13, 30, 31], 3: [30, 31, 32, 33, 33, 33], 5: [50, 51, 52, 53, 53, 53]}

    def test_sequences_keep_nulls_in_place(self, spark):
        rows = [(1, i, None if i == 2 else float(i)) for i in range(6)]
        df = spark.createDataFrame(rows, "ClientId int, bin int, v double")
        before = {r.bin: r.sequence for r in ordered.input_sequences(df, KEY, "bin", ["v"], 3).collect()}
        assert before == {3: [0, 1, None], 4: [1, None, 3], 5: [None, 3, 4]}
        upto = {r.bin: r.sequence for r in ordered.input_sequences(df, KEY, "bin", ["v"], 3, include_current=True).collect()}
        assert upto[5] == [3, 4, 5] and len(upto) == 4
        ahead = {r.bin: r.target for r in ordered.target_vector(df, KEY, "bin", "v", 2).collect()}
        assert ahead == {0: [1, None], 1: [None, 3], 2: [3, 4], 3: [4, 5]}

    def test_targets_by_time_do_not_jump_a_gap(self, spark):
        rows = [(1, t("00:00:00"), 1.0), (1, t("00:15:00"), 2.0), (1, t("00:45:00"), 4.0)]
        df = spark.createDataFrame(rows, "ClientId int, bin timestamp_ntz, v double")
        out = ordered.targets_by_time(df, KEY, "bin", "v", 2).orderBy("bin").collect()
        assert [(r.y_1, r.y_2) for r in out] == [(2, None), (None, 4), (None, None)]
