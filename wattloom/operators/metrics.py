"""Forecast errors as aggregates: all sites (and horizons) in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
TINY = 1e-8
HUBER_DELTA = 1.0


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mae(y: Column | str, p: Column | str) -> Column:
    return F.avg(F.abs(_c(y) - _c(p)))


def mse(y: Column | str, p: Column | str) -> Column:
    error = _c(y) - _c(p)
    return F.avg(error * error)


def rmse(y: Column | str, p: Column | str) -> Column:
    return F.sqrt(mse(y, p))


def r2(y: Column | str, p: Column | str) -> Column:
    """1 - SSE / SST; null where the target does not vary."""
    error = _c(y) - _c(p)
    spread = F.var_pop(_c(y)) * F.count(_c(y))
    return 1 - F.sum(error * error) / F.nullif(spread, F.lit(0.0))


def smape100(y: Column | str, p: Column | str) -> Column:
    """Symmetric percentage error on the scale 0 to 100, that is without the factor 2."""
    y, p = _c(y), _c(p)
    return F.avg(100 * F.abs(y - p) / (F.abs(y) + F.abs(p) + TINY))


def wmape(y: Column | str, p: Column | str) -> Column:
    """Total absolute error in percent of the total absolute target."""
    y, p = _c(y), _c(p)
    total = F.sum(F.abs(y))
    return F.when(total + TINY != 0, 100 * F.sum(F.abs(y - p)) / (total + TINY))


def huber(y: Column | str, p: Column | str, delta: float = HUBER_DELTA) -> Column:
    error = F.abs(_c(y) - _c(p))
    return F.avg(F.when(error <= delta, 0.5 * error * error).otherwise(delta * (error - 0.5 * delta)))


ALL = {
    "MAE": mae,
    "MSE": mse,
    "RMSE": rmse,
    "R2": r2,
    "SMAPE_percent": smape100,
    "WMAPE_percent": wmape,
    "Huber": huber,
}


RUN_ERRORS = ("MAE", "RMSE", "SMAPE_percent", "WMAPE_percent")


def evaluate(df: DataFrame, keys: list[str], y: str, p: str, names: list[str] | None = None) -> DataFrame:
    """The named errors per key over rows that have both values."""
    wanted = names or list(ALL)
    both = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    return both.groupBy(*keys).agg(*[ALL[n](y, p).alias(n) for n in wanted])


def run_summary(
    scored: DataFrame, keys: list[str], y: str, p: str, is_train: str, trained_at: str, settings: dict[str, object]
) -> DataFrame:
    """One row per key for the run history: errors on the held-out rows, row counts and settings."""
    train = F.col(is_train)
    held_y = F.when(~train, F.col(y))
    held_p = F.when(~train, F.col(p))
    summary = scored.groupBy(*keys).agg(
        *[ALL[n](held_y, held_p).alias(n) for n in RUN_ERRORS],
        F.count(F.lit(1)).alias("n_rows_total"),
        F.count_if(train).alias("n_train_rows"),
        F.count_if(~train).alias("n_test_rows"),
    )
    return summary.withColumns({"TrainEnd": F.lit(trained_at), **{k: F.lit(v) for k, v in settings.items()}})
