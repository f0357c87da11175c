"""Ordered operators split by chunk and block against plain pandas, with one site that owns most rows."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattloom.operators import ordered
from wattloom.plans import load_daily

KEY = ["ClientId"]
TS = "ts"


def frame(seed, n=600, hot=0.7):
    rng = np.random.default_rng(seed)
    site = np.where(rng.random(n) < hot, 1, rng.integers(2, 6, n))
    value = np.where(rng.random(n) < 0.4, np.nan, rng.integers(0, 1000, n))
    # few distinct instants: ties are common, and whole chunks are null or absent
    return pd.DataFrame({"ClientId": site, "at": rng.integers(0, 60, n) ** 2 // 9, "id": np.arange(n), "v": value})


def to_spark(spark, pdf):
    rows = [(int(c), int(a), int(i), None if np.isnan(v) else float(v)) for c, a, i, v in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "ClientId int, at long, id long, v double").repartition(5)
    # ten instants share a second, three seconds an hour
    second = F.floor(F.col("at") / 10)
    micros = F.floor(second / 3) * 3_600_000_000 + second % 3 * 1_000_000 + F.col("at") % 10
    return df.withColumn("ts", F.timestamp_micros(micros).cast("timestamp_ntz"))


def as_pandas(df, *names):
    return df.select("id", *names).toPandas().set_index("id").sort_index()[list(names)]


def expected(pdf, function):
    ordered_rows = pdf.sort_values(["ClientId", "at", "id"])
    return function(ordered_rows, ordered_rows.groupby("ClientId", sort=False)).reindex(pdf.index)


@pytest.mark.parametrize("seed", range(3))
class TestAgainstPandas:
    def test_fill_forward(self, spark, seed):
        pdf = frame(seed)
        got = as_pandas(ordered.fill_forward(to_spark(spark, pdf), KEY, ["at", "id"], ["v"], TS), "v")["v"]
        want = expected(pdf, lambda rows, groups: groups["v"].ffill())
        pd.testing.assert_series_equal(got.astype(float), want, check_names=False, check_index=False)

    def test_row_ordinal_and_total(self, spark, seed):
        pdf = frame(seed)
        got = as_pandas(ordered.row_ordinal(to_spark(spark, pdf), KEY, ["at", "id"], TS, "index", "total"), "index", "total")
        want = expected(pdf, lambda rows, groups: groups.cumcount())
        assert got["index"].tolist() == want.tolist()
        assert got["total"].tolist() == pdf.groupby("ClientId")["id"].transform("count").tolist()

    @pytest.mark.parametrize("block", [1, 3, 64, 10_000])
    def test_neighbours_across_blocks(self, spark, seed, block):
        pdf = frame(seed, 200)
        wanted = {"back_1": ("v", 1), "back_7": ("v", 7), "ahead_2": ("v", -2)}
        out = ordered.neighbour_columns(to_spark(spark, pdf), KEY, ["at", "id"], wanted, TS, block)
        got = as_pandas(out, *wanted)
        assert len(got) == len(pdf)
        for name, (_, k) in wanted.items():
            want = expected(pdf, lambda rows, groups, k=k: groups["v"].shift(k))
            pd.testing.assert_series_equal(got[name].astype(float), want, check_names=False, check_index=False)

    def test_split(self, spark, seed):
        pdf = frame(seed)
        size = pdf.groupby("ClientId")["id"].transform("count")
        place = expected(pdf, lambda rows, groups: groups.cumcount())
        for args, limit in (({"fraction": 0.8}, np.floor(size * 0.8)), ({"test_rows": 40}, size - 40)):
            got = as_pandas(ordered.chronological_split(to_spark(spark, pdf), KEY, ["at", "id"], TS, **args), "is_train")
            assert got["is_train"].tolist() == (place < limit).tolist()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(st.integers(1, 2), st.integers(0, 40), st.none() | st.integers(0, 9)), min_size=1, max_size=40),
    block=st.integers(1, 6),
)
def test_any_rows(spark, rows, block):
    pdf = pd.DataFrame(
        [(c, a, i, np.nan if v is None else float(v)) for i, (c, a, v) in enumerate(rows)], columns=["ClientId", "at", "id", "v"]
    )
    df = to_spark(spark, pdf).coalesce(1)
    filled = as_pandas(ordered.fill_forward(df, KEY, ["at", "id"], ["v"], TS), "v")["v"].astype(float)
    want = expected(pdf, lambda rows, groups: groups["v"].ffill())
    assert filled.fillna(-1).tolist() == want.fillna(-1).tolist()
    lagged = as_pandas(ordered.lag_features(df, KEY, ["at", "id"], "v", 2, TS, block), "lag_2")["lag_2"].astype(float)
    want = expected(pdf, lambda rows, groups: groups["v"].shift(2))
    assert lagged.fillna(-1).tolist() == want.fillna(-1).tolist()


def reference_series(pdf, limit=40000.0):
    """The clean series of one site, step by step in pandas."""
    rows = pdf.sort_values("ts").set_index("ts")["v"].astype(float)
    summed = rows.where(rows <= limit).ffill().resample("15min").sum()
    return summed.where(summed <= limit).ffill()


@pytest.mark.parametrize("seed", range(3))
def test_energy_series_against_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    n = 500
    offsets = np.sort(rng.choice(4 * 86400, n, replace=False))
    pdf = pd.DataFrame({"ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(offsets, unit="s"), "v": rng.choice([10.0, 900.0, 25000.0, 50000.0], n)})
    rows = [(1, r.ts.to_pydatetime(), r.v) for r in pdf.itertuples()]
    df = spark.createDataFrame(rows, "ClientId int, TimeStampMeasured timestamp_ntz, LoadEnergyCalculated double")
    got = load_daily.energy_series(df, "2020-01-01 00:00:00").orderBy("bin").toPandas()
    want = reference_series(pdf)
    assert got["bin"].tolist() == want.index.tolist()
    np.testing.assert_allclose(got[load_daily.TARGET].astype(float), want.to_numpy())


@pytest.mark.parametrize("span", [1, 60, 3600])
def test_crowded_readings(spark, span):
    """Most readings of site 1 fall into one second, one minute or one hour."""
    rng = np.random.default_rng(11)
    start = pd.Timestamp("2024-01-01")
    stamps = set()
    for site, n, seconds in ((1, 400, span), (1, 100, 86400), (2, 80, 86400)):
        stamps |= {(site, start + pd.Timedelta(int(s) * 1000 + 17, "us")) for s in rng.choice(seconds * 1000, n, replace=False)}
    stamps = sorted(stamps)
    values = rng.choice([10.0, 90.0, 250.0, 50000.0, 60000.0], len(stamps))
    pdf = pd.DataFrame([(c, ts, i, v) for i, ((c, ts), v) in enumerate(zip(stamps, values, strict=True))], columns=["ClientId", "ts", "id", "v"])
    df = spark.createDataFrame(
        [(c, ts.to_pydatetime(), i, float(v)) for c, ts, i, v in pdf.itertuples(index=False)],
        "ClientId int, TimeStampMeasured timestamp_ntz, id long, LoadEnergyCalculated double",
    )
    got = load_daily.energy_series(df, "2020-01-01 00:00:00").orderBy("ClientId", "bin").toPandas()
    for site, own in pdf.groupby("ClientId"):
        want = reference_series(own)
        mine = got[got.ClientId == site]
        assert mine["bin"].tolist() == want.index.tolist()
        np.testing.assert_allclose(mine[load_daily.TARGET].astype(float), want.to_numpy())

    v = "LoadEnergyCalculated"
    spiked = df.withColumn(v, F.when(F.col(v) < 40000, F.col(v)))
    for order in (["TimeStampMeasured"], ["TimeStampMeasured", "id"]):
        a = ordered.fill_forward(spiked, KEY, order, [v], "TimeStampMeasured").select("id", v)
        b = ordered.fill_forward(spiked, KEY, order, [v], None).select("id", v)
        assert a.exceptAll(b).isEmpty()
    a = ordered.lag_features(df, KEY, ["TimeStampMeasured"], v, 3, "TimeStampMeasured", 50).select("id", "lag_1", "lag_3")
    b = ordered.lag_features(df, KEY, ["TimeStampMeasured"], v, 3).select("id", "lag_1", "lag_3")
    assert a.exceptAll(b).isEmpty() and a.count() == len(stamps)


def test_aligned_series_equals_join_of_two_grids(spark):
    from wattloom.operators import joins

    rng = np.random.default_rng(5)
    start = pd.Timestamp("2024-01-01")

    def stamps(n, shift):
        return [(start + pd.Timedelta(int(s), "s")).to_pydatetime() for s in np.sort(rng.integers(shift, shift + 2 * 86400, n))]

    energy = spark.createDataFrame(
        [(c, ts, float(rng.choice([5.0, 700.0, 50000.0]))) for c in (1, 2) for ts in stamps(120, 0)],
        "ClientId int, TimeStampMeasured timestamp_ntz, LoadEnergyCalculated double",
    ).withColumn("id", F.monotonically_increasing_id())
    sky = spark.createDataFrame(
        [(c, ts, 1.0, 2.0) for c in (2, 3) for ts in stamps(60, 40000)],
        "ClientId int, Time timestamp_ntz, Temperature double, Humidity double",
    )
    cutoff = "2020-01-01 00:00:00"
    together = load_daily.joined_series(energy, sky, cutoff=cutoff)
    apart = joins.join_on_bin(load_daily.energy_series(energy, cutoff), load_daily.weather_series(sky))
    names = ["ClientId", "bin", load_daily.TARGET, "Temperature", "Humidity"]
    firsts = load_daily.energy_series(energy, cutoff).groupBy("ClientId").agg(F.min("bin").alias("first"))
    minutes = F.timestamp_diff("MINUTE", "first", "bin") / 15
    assert together.join(firsts, "ClientId").where(F.col("index") != minutes).isEmpty()
    assert together.count() > 100
    assert together.select(names).exceptAll(apart.select(names)).isEmpty()
    assert apart.select(names).exceptAll(together.select(names)).isEmpty()
