"""Ridge regression on whole input windows, for every site at once.

Row t of the regression holds ``x[t], x[t-1], ..`` of every input column, hundreds of rows back: thousands of inputs. Neither a window nor the
matrix of their moments is stored. The normal equations are solved by conjugate gradients, whose products with the matrix and its transpose
are lagged cross-products of the series, taken by Fourier transforms.

A group is one series, whose length the time grid bounds, and a block of steps; the blocks of a site share no sums, so they are tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Steps ahead that are solved for together.
STEPS = 12
# Fixed values of the solver: share of the first residual at which it stops, and rounds after which it does.
TOLERANCE, ROUNDS = 1e-4, 400
# Below this a column, or a lag of it, counts as constant (units of its spread).
FLAT = 1e-9


class Windows:
    """The matrix whose row t has the last ``lengths[f]`` values of every column ``f`` up to t, newest first."""

    def __init__(self, columns: np.ndarray, lengths: list[int]):
        self.rows, self.lengths = columns.shape[1], lengths
        self.size = 1 << int(self.rows + max(lengths) - 1).bit_length()
        self.spectra = np.fft.rfft(columns, self.size)

    def times(self, weights: np.ndarray) -> np.ndarray:
        """(steps, inputs) to (steps, rows): one convolution for each column."""
        total = np.zeros((len(weights), self.size // 2 + 1), complex)
        for spectrum, part in zip(self.spectra, np.split(weights, np.cumsum(self.lengths)[:-1], axis=1), strict=True):
            total += spectrum * np.fft.rfft(part, self.size)
        return np.fft.irfft(total, self.size)[:, : self.rows]

    def back(self, values: np.ndarray) -> np.ndarray:
        """(steps, rows) to (steps, inputs): the lagged cross-products with each column."""
        spectrum = np.fft.rfft(values, self.size)
        return np.hstack([np.fft.irfft(s.conj() * spectrum, self.size)[:, :n] for s, n in zip(self.spectra, self.lengths, strict=True)])


def known_windows(columns: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Rows before which, themselves included, every column has its whole window without a gap."""
    at = np.arange(columns.shape[1])
    known = np.ones(columns.shape[1], bool)
    for values, length in zip(columns, lengths, strict=True):
        gap = np.maximum.accumulate(np.where(np.isfinite(values), -1, at))
        known &= at - gap >= length
    return known


def solve(x: np.ndarray, y: np.ndarray, used: np.ndarray, lengths: list[int], ridge: float, tolerance: float, rounds: int) -> tuple[np.ndarray, int, float]:
    """(steps, 1 + inputs) coefficients from columns ``x`` and targets ``y`` (steps, rows) over ``used`` rows; rounds taken, residual left.

    Inputs are standardised over the used rows and the intercept is not penalised; constant inputs get no weight.
    """
    n = int(used.sum())
    mark = used.astype(float)
    shift = np.array([c[np.isfinite(c)].mean() if np.isfinite(c).any() else 0.0 for c in x])
    scale = np.array([c[np.isfinite(c)].std() if np.isfinite(c).any() else 0.0 for c in x])
    scale = np.where(scale > FLAT * np.maximum(1.0, np.abs(shift)), scale, np.inf)
    z = np.where(np.isfinite(x), (x - shift[:, None]) / scale[:, None], 0.0)
    matrix = Windows(z, lengths)
    mean = matrix.back(mark[None])[0] / n
    variance = Windows(z * z, lengths).back(mark[None])[0] / n - mean**2
    weight = np.where(variance > FLAT, 1 / np.sqrt(np.where(variance > FLAT, variance, 1.0)), 0.0)

    def product(v: np.ndarray) -> np.ndarray:
        p = matrix.times(v * weight) * mark
        p -= (p.sum(axis=1, keepdims=True) / n) * mark  # the means of all inputs at once
        return matrix.back(p) * weight + ridge * v

    level = np.where(used, y, 0.0).sum(axis=1, keepdims=True) / n
    left = matrix.back(np.where(used, y - level, 0.0)) * weight
    found, way = np.zeros_like(left), left.copy()
    size = (left * left).sum(axis=1)
    goal = size * tolerance**2
    taken = 0
    while taken < rounds and (size > goal).any():
        through = product(way)
        steep = (way * through).sum(axis=1)
        step = np.where((size > goal) & (steep > 0), size / np.where(steep > 0, steep, 1.0), 0.0)[:, None]
        found += step * way
        left -= step * through
        size, before = (left * left).sum(axis=1), size
        way = left + (size / np.where(before > 0, before, 1.0))[:, None] * way
        taken += 1
    rest = np.sqrt((size / np.where(goal > 0, goal, 1.0)).max()) * tolerance
    weights = found * weight
    intercept = level - weights @ mean[:, None]
    per_input = np.repeat(scale, lengths)
    own = weights / per_input
    return np.hstack([intercept - own @ np.repeat(shift, lengths)[:, None], own]), taken, float(rest)


def _columns(rows: pd.DataFrame, inputs: Mapping[str, int]) -> np.ndarray:
    return rows[list(inputs)].to_numpy(float).T


def _ahead(values: np.ndarray, first: int, last: int) -> np.ndarray:
    """(steps, rows): the values ``first`` to ``last`` rows later, NaN beyond the end."""
    out = np.full((last - first + 1, len(values)), np.nan)
    for i, h in enumerate(range(first, last + 1)):
        if h < len(values):
            out[i, : len(values) - h] = values[h:]
    return out


def _in_blocks(series: DataFrame, keys: list[str], order: str, columns: list[str], horizon: int, *more: str) -> DataFrame:
    """The series once for each block of steps, in many small partitions: solving takes far longer than the few rows suggest, so they are not to be merged."""
    tasks = max(8, 4 * int(series.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = F.explode(F.array(*[F.lit(b) for b in range(-(-horizon // STEPS))])).alias("block")
    numbers = [F.col(c).cast("double").alias(c) for c in columns]
    return series.select(*keys, order, *more, *numbers, blocks).repartition(tasks, *keys, "block")


def fit(
    series: DataFrame, keys: list[str], order: str, inputs: Mapping[str, int], target: str, horizon: int, train: str,
    ridge: float = 1.0, min_rows: int = 2, tolerance: float = TOLERANCE, rounds: int = ROUNDS,
) -> DataFrame:
    """``(keys, h, rows, rounds, residual, coefficients)`` for each step of the next ``horizon`` values of a gap-free series.

    ``inputs`` names the columns and how many rows back each is seen. A row counts if its windows and next ``horizon`` targets are known
    and the last of these is a training row. Keys with fewer than ``min_rows`` such rows have no model. ``residual`` is the share of the
    first residual that was left.
    """
    lengths = list(inputs.values())
    columns = list(dict.fromkeys([target, *inputs]))
    out = [*keys, "h", "rows", "rounds", "residual", "coefficients"]

    def one(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches).sort_values(order)
        *site, block = key
        first, last = block * STEPS + 1, min((block + 1) * STEPS, horizon)
        x, values = _columns(rows, inputs), rows[target].to_numpy(float)
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
        used = np.zeros(len(rows), bool)
        origins = max(0, len(rows) - horizon)
        # all targets of a row count, not only those of this block, so that every step learns from the same rows
        complete = bad[1 + horizon :] - bad[1 : 1 + origins] == 0
        used[:origins] = complete & rows[train].to_numpy(bool)[horizon:] & known_windows(x, lengths)[:origins]
        models = []
        if used.sum() >= max(min_rows, 1):
            found, taken, rest = solve(x, _ahead(values, first, last), used, lengths, ridge, tolerance, rounds)
            models = [(*site, first + i, int(used.sum()), taken, rest, w.tolist()) for i, w in enumerate(found)]
        yield pd.DataFrame(models, columns=out)

    types = ", ".join(f"`{k}` {series.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{types}, h int, rows long, rounds int, residual double, coefficients array<double>"
    dealt = _in_blocks(series, keys, order, columns, horizon, train)
    return dealt.groupBy(*keys, "block").applyInPandas(one, schema)


def ahead(
    series: DataFrame, models: DataFrame, keys: list[str], order: str, inputs: Mapping[str, int], target: str, horizon: int, origins: str | None = None
) -> DataFrame:
    """``(keys, order, h, y, p)`` for the rows marked in ``origins``, or else for the last row of each key that has whole windows.

    Rows without whole windows and keys without a model give nothing; ``y`` is null where the series has ended.
    """
    lengths = list(inputs.values())
    columns = list(dict.fromkeys([target, *inputs]))
    out = [*keys, order, "h", "y", "p"]

    def one(key: tuple[Any, ...], rows: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        rows, fitted = rows.sort_values(order), fitted.sort_values("h")
        x = _columns(rows, inputs) if len(rows) and len(fitted) else np.empty((len(lengths), 0))
        at = np.flatnonzero(known_windows(x, lengths))
        at = at[-1:] if origins is None else at[rows[origins].to_numpy(bool)[at]]
        if not len(at):
            return pd.DataFrame(columns=out)
        weights = np.array(fitted["coefficients"].tolist())
        steps = fitted["h"].to_numpy()
        p = weights[:, :1] + Windows(np.where(np.isfinite(x), x, 0.0), lengths).times(weights[:, 1:])[:, at]
        y = _ahead(rows[target].to_numpy(float), int(steps[0]), int(steps[-1]))[steps - steps[0]][:, at]
        found = {k: [v] * p.size for k, v in zip(keys, key, strict=False)}
        found |= {order: np.tile(rows[order].to_numpy()[at], len(steps)), "h": np.repeat(steps, len(at)), "y": y.ravel(), "p": p.ravel()}
        return pd.DataFrame(found)[out]

    types = ", ".join(f"`{k}` {series.schema[k].dataType.simpleString()}" for k in (*keys, order))
    left = _in_blocks(series, keys, order, columns, horizon, *([origins] if origins else [])).groupBy(*keys, "block")
    right = models.withColumn("block", F.floor((F.col("h") - 1) / STEPS).cast("int")).groupBy(*keys, "block")
    scored = left.cogroup(right).applyInPandas(one, f"{types}, h int, y double, p double")
    return scored.withColumn("y", F.nanvl("y", F.lit(None).cast("double")))
