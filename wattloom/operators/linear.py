"""Ridge regression for every site (or site and slot) at once.

Each task reduces its rows to one small moment matrix per key (features x features and targets), so the
shuffle carries matrices and never rows, and a key that owns most rows is still reduced in parallel. All
horizons share the feature moments: many targets cost one pass, without a row per horizon.
"""

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HELD_KEYS = 512
BLOCK = 4096


def _key_types(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def moments(df: DataFrame, keys: list[str], features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """``(keys, moments)``: the flattened sum of ``z z'`` over rows with ``z = (1, features, targets)``.

    Rows with a null among them are left out. One row per key and map task, to be added up.
    """
    columns = [*features, *targets]
    size = len(columns) + 1
    used = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).na.drop("any")

    def reduce_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}

        def emit() -> pd.DataFrame:
            rows = [(*key, matrix.ravel()) for key, matrix in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=[*keys, "moments"])

        for batch in batches:
            for key, rows in batch.groupby(keys, sort=False):
                z = np.column_stack([np.ones(len(rows)), rows[columns].to_numpy(float)])
                held[key] = held.get(key, np.zeros((size, size))) + z.T @ z
            if len(held) > HELD_KEYS:
                yield emit()
        if held:
            yield emit()

    return used.mapInPandas(reduce_partition, f"{_key_types(df, keys)}, moments array<double>")


def moments_ahead(
    series: DataFrame,
    keys: list[str],
    order: str,
    features: Sequence[str],
    target: str,
    horizon: int,
    train: str,
) -> DataFrame:
    """As :func:`moments` for the next ``horizon`` values of a gap-free series as targets.

    The targets of a row are rows of its own group, so they are viewed there and not shipped 96 times. A
    row counts if its features are known and its last target is still a training row. A group is one
    series, whose length the time grid bounds.
    """
    size = 1 + len(features) + horizon
    columns = list(dict.fromkeys([target, *features]))
    numbers = [F.col(c).cast("double").alias(c) for c in columns]

    def reduce_series(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches).sort_values(order)
        total = np.zeros((size, size))
        origins = len(rows) - horizon
        if origins > 0:
            x = rows[list(features)].to_numpy(float)[:origins]
            y = np.lib.stride_tricks.sliding_window_view(rows[target].to_numpy(float)[1:], horizon)
            counts = rows[train].to_numpy(bool)[horizon:] & np.isfinite(x).all(axis=1)
            for at in range(0, origins, BLOCK):
                part = slice(at, at + BLOCK)
                z = np.column_stack([np.ones(len(x[part])), x[part], y[part]])[counts[part]]
                z = z[np.isfinite(z).all(axis=1)]
                total += z.T @ z
        yield pd.DataFrame([(*key, total.ravel())], columns=[*keys, "moments"])

    schema = f"{_key_types(series, keys)}, moments array<double>"
    return series.select(*keys, order, train, *numbers).groupBy(*keys).applyInPandas(reduce_series, schema)


def solve_moments(total: np.ndarray, n_features: int, ridge: float) -> np.ndarray:
    """Coefficients ``(targets, 1 + features)`` from summed moments, on standardised features."""
    n = total[0, 0]
    mean = total[0, 1:] / n
    cov = total[1:, 1:] / n - np.outer(mean, mean)
    sd = np.sqrt(np.clip(np.diag(cov)[:n_features], 0, None))
    sd = np.where(sd > 1e-9 * np.maximum(1.0, np.abs(mean[:n_features])), sd, np.inf)
    inner = cov[:n_features, :n_features] / np.outer(sd, sd) + (ridge / n) * np.eye(n_features)
    right = cov[:n_features, n_features:] / sd[:, None]
    # a constant feature has a zero row but for the ridge, and gets no weight
    scaled = np.linalg.solve(inner, right) if ridge > 0 else np.linalg.lstsq(inner, right, rcond=None)[0]
    weights = scaled / sd[:, None]
    intercept = mean[n_features:] - mean[:n_features] @ weights
    return np.column_stack([intercept, weights.T])


def solve_ridge(
    partials: DataFrame,
    keys: list[str],
    n_features: int,
    n_targets: int,
    candidates: Sequence[tuple[int, float]],
    min_rows: int = 2,
) -> DataFrame:
    """Add up partial moments and solve for every candidate ``(first k features, ridge)``.

    Matrices of a key are added as they arrive, so memory does not grow with their number.
    """
    size = 1 + n_features + n_targets
    columns = [*keys, "n_features", "ridge", "rows", "coefficients"]

    def solve(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size * size)
        for batch in batches:
            for part in batch["moments"]:
                total += part
        total = total.reshape(size, size)
        rows = int(round(total[0, 0]))
        out = []
        for used, ridge in candidates if rows >= min_rows else ():
            keep = np.r_[0 : 1 + used, 1 + n_features : size]
            weights = solve_moments(total[np.ix_(keep, keep)], used, ridge)
            out.append((*key, used, float(ridge), rows, [list(map(float, w)) for w in weights]))
        yield pd.DataFrame(out, columns=columns)

    schema = f"{_key_types(partials, keys)}, n_features int, ridge double, rows long, coefficients array<array<double>>"
    return partials.groupBy(*keys).applyInPandas(solve, schema)


def fit_ridge(
    df: DataFrame,
    keys: list[str],
    features: Sequence[str],
    targets: Sequence[str],
    ridge: float = 1.0,
    min_rows: int = 2,
) -> DataFrame:
    """``(keys, rows, coefficients)``: per target the intercept and one weight per feature.

    Keys with fewer than ``min_rows`` usable rows have no model.
    """
    partials = moments(df, keys, features, targets)
    models = solve_ridge(partials, keys, len(features), len(targets), [(len(features), ridge)], min_rows)
    return models.drop("n_features", "ridge")


def dot(coefficients: Column, features: Column) -> Column:
    """Intercept plus weighted sum, for an array of weights that starts with the intercept."""
    products = F.zip_with(coefficients, F.concat(F.array(F.lit(1.0)), features), lambda w, x: w * x)
    return F.aggregate(products, F.lit(0.0), lambda a, x: a + x)


def predict(
    df: DataFrame, models: DataFrame, keys: list[str], features: Sequence[str], name: str = "predictions"
) -> DataFrame:
    """Attach an array with one prediction per target. Keys without a model get null."""
    inputs = F.array(*[F.col(f).cast("double") for f in features])
    scored = df.join(models.select(*keys, "coefficients"), keys, "left")
    return scored.withColumn(name, F.transform("coefficients", lambda w: dot(w, inputs))).drop("coefficients")
