"""Sinks, files and streams."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.tables import CUTOFF, Tables
from conftest import SF_SMALL
from wattloom import session
from wattloom.plans import load_daily
from wattloom.session import work_path
from wattloom.sources import readers, schemas, sinks
from wattloom.streaming import jobs

T = [datetime(2024, 1, 1, h) for h in range(6)]
FORECAST = "ClientId int, Time timestamp_ntz, LoadPower long"


class TestReplace:
    def frames(self, spark):
        old = spark.createDataFrame([(c, T[h], 10 * c + h) for c in (1, 2) for h in range(4)], FORECAST)
        new = spark.createDataFrame([(1, T[h], 100 + h) for h in (2, 3, 4)], FORECAST)
        since = new.groupBy("ClientId").agg(F.min("Time").alias("since"))
        return old, new, since

    def test_bound_is_removed(self, spark, rows):
        old, new, since = self.frames(spark)
        got = rows(sinks.replace_from(old, new, since), "ClientId", "LoadPower")
        assert got == [(1, 10), (1, 11), (1, 102), (1, 103), (1, 104), (2, 20), (2, 21), (2, 22), (2, 23)]

    def test_bound_is_kept_when_strict(self, spark, rows):
        old, new, since = self.frames(spark)
        got = rows(sinks.replace_from(old, new, since, strict=True), "ClientId", "LoadPower")
        assert (1, 12) in got and (1, 102) in got and (1, 13) not in got

    def test_a_version_is_never_overwritten(self, spark):
        root = work_path(spark, "versions")
        df = spark.range(3)
        sinks.write_version(df, root, "v=1")
        with pytest.raises(Exception, match="already exists"):
            sinks.write_version(df, root, "v=1")


class TestFiles:
    def test_run_history_of_mixed_files(self, spark, tmp_path):
        (tmp_path / "list.json").write_text('[{"ClientId": 1, "RMSE": 2.5, "was_in_use": true}, {"ClientId": 2}]')
        (tmp_path / "single.json").write_text('{"ClientId": 3, "TrainEnd": "2025-01-01"}')
        (tmp_path / "broken.json").write_text('{"ClientId": 4, "RMSE": ')
        got = readers.read_run_history(spark, str(tmp_path))
        assert sorted(r.ClientId for r in got.collect()) == [1, 2, 3]
        assert got.schema.names == schemas.RUNS.names

    def test_tuner_state(self, spark, tmp_path):
        (tmp_path / "oracle.json").write_text('{"trials": {"a": {"score": 0.5}, "b": {"score": null}, "c": {}},\n "x": 1}')
        assert [tuple(r) for r in readers.scan_trial_scores(spark, str(tmp_path)).collect()] == [("a", 0.5)]

    def test_json_array_of_readings(self, spark, tmp_path):
        (tmp_path / "r.json").write_text('[{"clientId": 1, "timeStampMeasured": "2025-01-01T00:15:00", "loadEnergyCalculated": 1.5}]')
        schema = "clientId int, timeStampMeasured timestamp_ntz, loadEnergyCalculated double"
        row = readers.scan_json_readings(spark, str(tmp_path), schema, multi_line=True).first()
        assert row.asDict() == {"ClientId": 1, "TimeStampMeasured": datetime(2025, 1, 1, 0, 15), "LoadEnergyCalculated": 1.5}

    def test_pv_csv(self, spark, tmp_path):
        (tmp_path / "pv.csv").write_text("date;time;c23525.pv_power\n2025-01-01;10:15:00;3.25\nbad;x;1\n")
        got = sorted(map(tuple, readers.scan_csv_pv(spark, str(tmp_path)).collect()), key=lambda r: r[1])
        assert got == [(None, 1.0), (datetime(2025, 1, 1, 10, 15), 3.25)]

    def test_schemas_are_unique_tables(self):
        for table in (schemas.CLIENTS, schemas.ENERGY, schemas.MEASUREMENTS, schemas.RUNS, schemas.LOAD_PREDICTIONS):
            assert len(set(table.names)) == len(table.names)


class TestWorkFolder:
    def test_setting_is_used(self, spark):
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named:
            assert session.work_root(spark) == named.rstrip("/")
        assert session.work_path(spark, "a") != session.work_path(spark, "a")

    def test_stored_copy_cuts_the_lineage(self, spark):
        df = session.stored(spark.range(5).withColumn("x", F.col("id") * 2), "five")
        assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert df.count() == 5

    def test_only_threads_of_the_driver_may_share_a_local_folder(self):
        class Context:
            master = "local-cluster[2,1,1024]"

            def getCheckpointDir(self):
                return None

        class Session:
            sparkContext = Context()
            conf = {}

        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.work_root(Session())


class TestReplacedDays:
    def test_only_changed_days_are_rewritten(self, spark, tmp_path):
        path = str(tmp_path / "forecast")
        schema = "ClientId int, Time timestamp_ntz, LoadPower long"
        old = [(c, datetime(2025, 1, d, h), 10 * d + c) for c in (1, 2) for d in (1, 2, 3, 4) for h in (0, 12)]
        nobody = spark.createDataFrame([], "ClientId int, since timestamp_ntz")
        sinks.replace_days(spark.createDataFrame(old, schema), nobody, path)

        def files():
            return {str(f.relative_to(path)) for f in (tmp_path / "forecast").rglob("*.parquet")}

        before = files()
        # site 1 gets a new forecast, site 2 of the same run gets none
        since = spark.createDataFrame([(c, datetime(2025, 1, 3, 6)) for c in (1, 2)], "ClientId int, since timestamp_ntz")
        new = [(1, datetime(2025, 1, 3, 18), 7)]
        sinks.replace_days(spark.createDataFrame(new, schema), since, path)
        got = sorted(map(tuple, spark.read.parquet(path).select("ClientId", "Time", "LoadPower").collect()))
        assert got == sorted([r for r in old if r[1] < datetime(2025, 1, 3, 6)] + new)
        assert {f for f in before if "day=2025-01-0" in f and f[14] in "12"} <= files()
        assert not any("day=2025-01-04" in f for f in files())
        sinks.replace_days(spark.createDataFrame(new, schema), since, path)
        assert sorted(map(tuple, spark.read.parquet(path).select("ClientId", "Time", "LoadPower").collect())) == got


class TestStreams:
    COLUMNS = ["ClientId", "TimeStampMeasured", "event_id", "LoadEnergyCalculated"]

    def test_resample_resumes_without_repeats(self, spark):
        energy = Tables(spark, SF_SMALL).energy.select(self.COLUMNS)
        landed, out, checkpoint = (work_path(spark, n) for n in ("in", "out", "cp"))
        middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
        for part in (F.col("TimeStampMeasured") < middle, F.col("TimeStampMeasured") >= middle):
            energy.where(part).write.mode("append").parquet(landed)
            stream = jobs.resampled(jobs.read_stream(spark, landed, energy.schema), "TimeStampMeasured", "LoadEnergyCalculated")
            jobs.run_to_parquet(stream, out, checkpoint)
        got = spark.read.parquet(out)
        assert got.count() == got.select("ClientId", "bin").distinct().count()
        batch = load_daily.agg.binned(energy, ["ClientId"], "TimeStampMeasured", {"n": F.count("LoadEnergyCalculated")})
        # the bins the watermark has not passed yet are still open
        assert batch.count() - got.count() <= 2
        assert got.join(batch, ["ClientId", "bin"]).where("n = readings").count() == got.count()

    def test_repeated_batch_replaces_itself(self, spark):
        rows = spark.createDataFrame([(1, T[0], 5), (1, T[1], 6)], FORECAST)
        landed, out = work_path(spark, "in"), work_path(spark, "out")
        rows.write.parquet(landed)
        # a lost checkpoint makes the stream start over
        for _ in range(2):
            jobs.publish_batches(jobs.read_stream(spark, landed, rows.schema), out, work_path(spark, "cp"))
        assert jobs.current_forecast(spark.read.parquet(out)).count() == 2

    def test_compaction_at_any_moment(self, spark, monkeypatch):
        landed, out, checkpoint = (work_path(spark, n) for n in ("in", "out", "cp"))
        schema = spark.createDataFrame([], FORECAST).schema

        def live():
            return sorted((r.ClientId, r.Time, r.LoadPower, r.batch_id) for r in jobs.current_forecast(jobs.read_batches(spark, out, schema)).collect())

        def folders(place, name):
            return jobs._numbered(spark, place, name, False)

        assert jobs.compact_batches(spark, out, schema) is None and live() == []
        sizes = []
        for i in range(6):
            rows = spark.createDataFrame([(c, t, 10 * i + k) for c in (1, 2) for k, t in enumerate(T[min(i, 2) :])], FORECAST)
            rows.coalesce(1).write.mode("append").parquet(landed)
            jobs.publish_batches(jobs.read_stream(spark, landed, rows.schema), out, checkpoint)
            before = live()
            assert jobs.compact_batches(spark, out, schema) == i
            assert live() == before and jobs.compact_batches(spark, out, schema) is None
            sizes.append(len(folders(out, "batch_id")))
        assert max(sizes) <= 2 and folders(f"{out}/_states", "upto") == [4, 5]
        # a state that was not finished does not count, and the batches before it are still there
        rows.coalesce(1).write.mode("append").parquet(landed)
        jobs.publish_batches(jobs.read_stream(spark, landed, rows.schema), out, checkpoint)
        before = live()
        jobs.current_forecast(jobs.read_batches(spark, out, schema)).limit(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{out}/_states/upto=6")
        assert live() == before
        assert jobs.compact_batches(spark, out, schema) == 6 and live() == before

    def test_later_forecasts_win_from_their_start(self, spark):
        issued = [(0, 1, T[0], 1), (0, 1, T[1], 2), (0, 1, T[3], 3), (0, 2, T[3], 9), (1, 1, T[2], 4), (2, 1, T[4], 5)]
        batches = spark.createDataFrame(issued, "batch_id int, ClientId int, Time timestamp_ntz, LoadPower long")
        live = sorted(r.LoadPower for r in jobs.current_forecast(batches).collect())
        assert live == [1, 2, 4, 5, 9]

    def test_bins_follow_late_rows_and_restarts(self, spark):
        energy = Tables(spark, SF_SMALL).energy.select(self.COLUMNS)
        landed, by_day, bins = (work_path(spark, n) for n in ("in", "days", "bins"))
        checkpoint = work_path(spark, "cp")
        for i in (1, 0, 2):
            energy.where(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(landed)
            readings = jobs.read_stream(spark, landed, energy.schema, files_per_batch=1)
            jobs.incremental_bins(readings, by_day, bins, checkpoint, CUTOFF, tie=("event_id",))
        got = jobs.series_from_states(spark.read.parquet(bins))
        want = load_daily.energy_series(energy, CUTOFF, tie=("event_id",))
        names = ["ClientId", "bin", F.round(load_daily.TARGET, 6)]
        assert got.count() == want.count() > 0
        assert got.select(names).exceptAll(want.select(names)).isEmpty()


def test_two_writers_never_claim_one_version(spark):
    from concurrent.futures import ThreadPoolExecutor

    root = work_path(spark, "models")
    with ThreadPoolExecutor(8) as pool:
        claimed = list(pool.map(lambda _: sinks.claim_version(spark, root, 4), range(24)))
    assert sorted(claimed) == list(range(5, 29))
    assert sinks.claim_version(spark, root, 40) == 41 and sinks.claim_version(spark, root, 4, "site2-v") == 5
