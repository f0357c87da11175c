"""The registered jobs do the whole job: the plans' own numbers, all test rows."""

import inspect
from datetime import datetime, timedelta

import pytest

import checks.forecasts  # noqa: F401
from checks.tables import QUERIES
from conftest import SF_SMALL
from wattloom.plans import load_daily, load_hourly, solar_daily, sweep


@pytest.mark.parametrize("name, plan", [("forecast_hourly_direct", load_hourly), ("forecast_daily_pv", solar_daily)])
def test_forecasts_fit_with_the_plans_own_numbers(spark, monkeypatch, name, plan):
    own, seen = inspect.signature(plan.forecast), []
    monkeypatch.setattr(plan, "forecast", lambda *a, **k: seen.append(own.bind(*a, **k).arguments) or spark.range(0))
    QUERIES[name](spark, SF_SMALL)
    assert len(seen) == 1 and not {"trees", "depth"} & set(seen[0])
    assert load_hourly.TREES == 500


def test_the_sweep_is_judged_on_all_test_rows(spark, monkeypatch):
    seen = []
    errors = sweep.trial_errors
    monkeypatch.setattr(sweep, "trial_errors", lambda split, **grid: seen.append(split) or errors(split, **grid))
    QUERIES["hyperparameter_sweep"](spark, SF_SMALL)
    counts = seen[0].where("NOT is_train").groupBy("ClientId").count().collect()
    assert counts and {r["count"] for r in counts} == {3840}
    assert seen[0].where("is_train").count() > 0


def test_the_energy_series_in_bins_of_five_minutes(spark):
    start = datetime(2024, 1, 1)
    rows = [(1, start + timedelta(minutes=m), v) for m, v in ((0, 1.0), (4, 2.0), (5, 3.0), (17, 4.0))]
    energy = spark.createDataFrame(rows, "ClientId int, TimeStampMeasured timestamp_ntz, LoadEnergyCalculated double")
    got = load_daily.energy_series(energy, "2023-01-01 00:00:00", width=5).orderBy("bin").collect()
    assert [(r["bin"], r[load_daily.TARGET]) for r in got] == [(start + timedelta(minutes=5 * k), v) for k, v in enumerate((3.0, 3.0, 0.0, 4.0))]
