"""Regression on input windows that are never stored, against windows that are."""

import numpy as np
import pandas as pd
from wattloom.operators import windows
from wattloom.plans import load_daily

from test_models import KEY, direct, site_readings

INPUTS = {"v": 9, "x": 4, "flat": 5}


def series(n=260, seed=4, site=1):
    rng = np.random.default_rng(seed)
    v = np.cumsum(rng.normal(size=n)) + 1000
    x = rng.normal(size=n) * 1e-3
    x[[i for i in (31, 140) if i < n]] = np.nan
    return pd.DataFrame({"ClientId": site, "bin": np.arange(n), "v": v, "x": x, "flat": 7.0, "is_train": np.arange(n) < n - 60})


def dense(pdf, horizon):
    """Rows with whole windows, their inputs and targets."""
    found = []
    for t in range(len(pdf)):
        if t >= max(INPUTS.values()) - 1:
            row = np.concatenate([pdf[c].to_numpy()[t - n + 1 : t + 1][::-1] for c, n in INPUTS.items()])
            ends = t + horizon < len(pdf) and pdf.is_train[t + horizon]
            y = pdf.v.to_numpy()[t + 1 : t + 1 + horizon]
            if np.isfinite(row).all():
                found.append((t, row, np.r_[y, np.full(horizon - len(y), np.nan)], bool(ends)))
    return found


def frame(spark, *sites):
    rows = [tuple(None if v != v else v for v in r) for pdf in sites for r in pdf.astype(object).itertuples(index=False)]
    return spark.createDataFrame(rows, "ClientId int, bin int, v double, x double, flat double, is_train boolean")


def test_products_equal_those_with_stored_windows():
    rng = np.random.default_rng(0)
    columns, lengths = rng.normal(size=(2, 40)), [5, 3]
    padded = np.hstack([np.zeros((2, 10)), columns])
    matrix = np.array([np.concatenate([padded[f, 10 + t - n + 1 : 10 + t + 1][::-1] for f, n in enumerate(lengths)]) for t in range(40)])
    product = windows.Windows(columns, lengths)
    w, r = rng.normal(size=(3, 8)), rng.normal(size=(3, 40))
    np.testing.assert_allclose(product.times(w), w @ matrix.T, atol=1e-12)
    np.testing.assert_allclose(product.back(r), r @ matrix, atol=1e-12)


def test_equals_a_dense_solution_of_all_steps(spark):
    horizon = windows.STEPS + 3  # more than one block
    one, two = series(), series(seed=9, site=2)
    short = series(n=20, site=3)
    df = frame(spark, one, two, short).repartition(5)
    models = windows.fit(df, KEY, "bin", INPUTS, "v", horizon, "is_train", ridge=2.0, tolerance=1e-12, rounds=5000).cache()
    assert sorted({r.ClientId for r in models.collect()}) == [1, 2]
    scored = windows.ahead(df, models, KEY, "bin", INPUTS, "v", horizon).toPandas()
    every = windows.ahead(df.selectExpr("*", "not is_train as test"), models, KEY, "bin", INPUTS, "v", horizon, "test").toPandas()
    for pdf in (one, two):
        site, rows = pdf.ClientId[0], dense(pdf, horizon)
        x, y = (np.array([r[i] for r in rows if r[3]]) for i in (1, 2))
        want = direct(x, y, 2.0)
        fitted = models.toPandas().query("ClientId == @site").sort_values("h")
        assert fitted.h.tolist() == list(range(1, horizon + 1)) and set(fitted["rows"]) == {len(x)}
        np.testing.assert_allclose(np.array(fitted.coefficients.tolist()), want, rtol=1e-5, atol=1e-5)
        last = scored.query("ClientId == @site").sort_values("h")
        assert set(last.bin) == {rows[-1][0]} and last.y.isna().all()
        np.testing.assert_allclose(last.p, want @ np.r_[1, rows[-1][1]], rtol=1e-6)
        tests = [r for r in rows if not pdf.is_train[r[0]]]
        got = every.query("ClientId == @site").sort_values(["bin", "h"])
        assert got.bin.tolist() == [t for t, *_ in tests for _ in range(horizon)]
        np.testing.assert_allclose(got.y, np.concatenate([r[2] for r in tests]))
        np.testing.assert_allclose(got.p, np.concatenate([want @ np.r_[1, r[1]] for r in tests]), rtol=1e-6)


def test_empty_series_and_sites_without_a_model(spark):
    empty = frame(spark, series().iloc[:0])
    models = windows.fit(empty, KEY, "bin", INPUTS, "v", 2, "is_train")
    assert models.count() == 0
    assert windows.ahead(empty, models, KEY, "bin", INPUTS, "v", 2).count() == 0
    assert windows.ahead(frame(spark, series()), models, KEY, "bin", INPUTS, "v", 2).count() == 0


def test_the_daily_job_sees_its_whole_window(spark):
    assert sum(load_daily.WINDOW_INPUTS.values()) == 16 * 288 + 303
    energy, measurements = site_readings(spark, 14)
    table = load_daily.window_table(energy, measurements, cutoff="2020-01-01 00:00:00").cache()
    models = load_daily.train_windows(table).cache()
    errors = load_daily.metrics.evaluate(load_daily.held_out_windows(table, models), KEY, "y", "p").collect()
    assert len(errors) == 2 and all(r.WMAPE_percent < 10 for r in errors)
    out = load_daily.forecast_windows(table, models).toPandas()
    assert out.groupby("ClientId").size().tolist() == [100, 100]
    for site, part in out.sort_values("Timestamp").groupby("ClientId"):
        shape = 5000 * site * (1.5 + np.sin(2 * np.pi * part.Timestamp.dt.hour.to_numpy()[:96] / 24))
        assert np.abs(part[load_daily.FORECAST].to_numpy()[:96] - shape).mean() < 0.1 * shape.mean()
