"""Hyper-parameter sweep over input length and regularisation, judged on the last rows of every site.

Hyperband: brackets start many trials on a small budget or few on a large one; on each rung a third of a bracket's trials survives
and gets three times the budget. A budget is a share of the newest training rows.
"""

from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.operators import linear, ordered, transforms
from wattloom.operators.clustering import draw
from wattloom.session import stored

# Fixed values.
LENGTHS = list(range(192, 768 + 1, 48))
TEST_ROWS = 3840
HORIZON = 96
HUBER_DELTA = 1.0
RIDGES = [1.0, 100.0]
MAX_BUDGET = 15
FACTOR = 3
# Ridges are drawn between these, each decade alike.
RIDGE_RANGE = (1e-2, 1e4)
KEY = ["ClientId"]

BLOCK = 2048


class Trial(NamedTuple):
    trial: int
    bracket: int
    seq_len: int
    ridge: float


def rungs(budget: int = MAX_BUDGET, factor: int = FACTOR) -> dict[tuple[int, int], tuple[int, float]]:
    """``(bracket, rung)`` to the number of trials on it and their budget."""
    top = 0
    while factor ** (top + 1) <= budget:
        top += 1
    out = {}
    for bracket in range(top, -1, -1):
        first = -(-(top + 1) * factor**bracket // (bracket + 1))
        for rung in range(bracket + 1):
            out[bracket, rung] = (first // factor**rung, budget / factor ** (bracket - rung))
    return out


def draws(plan: dict[tuple[int, int], tuple[int, float]], lengths: list[int] = LENGTHS) -> list[Trial]:
    """The trials of all brackets: lengths alike, ridges log-uniform; the same in every run."""
    low, high = np.log10(RIDGE_RANGE)
    first = [bracket for (bracket, rung), (n, _) in plan.items() if rung == 0 for _ in range(n)]
    return [
        Trial(i, b, lengths[int(draw("length", i) * len(lengths))], float(10 ** (low + (high - low) * draw("ridge", i))))
        for i, b in enumerate(first)
    ]


def survivors(scores: DataFrame, plan: dict[tuple[int, int], tuple[int, float]], loss: str = "huber_scaled") -> DataFrame:
    """Add ``survived`` to ``(bracket, rung, trial, loss)``: as many of the lowest losses as the next rung has places.

    Ties go to the lower trial number; trials without a loss do not survive, nor does any the last rung.
    """
    place = F.row_number().over(Window.partitionBy("bracket", "rung").orderBy(F.asc_nulls_last(loss), "trial"))
    places = [(F.col("bracket") == b) & (F.col("rung") == r) & (place <= plan.get((b, r + 1), (0, 0))[0]) for b, r in plan]
    return scores.withColumn("survived", reduce(lambda x, y: x | y, places) & F.col(loss).isNotNull())


def halving(
    spark: SparkSession,
    trials: list[Trial],
    evaluate: Callable[[list[tuple[Trial, float]], int], DataFrame],
    plan: dict[tuple[int, int], tuple[int, float]],
    loss: str = "huber_scaled",
) -> DataFrame:
    """All rungs: trial, bracket, seq_len, ridge, rung, budget, the columns of ``evaluate`` and ``survived``.

    ``evaluate`` takes trials with their budgets, and the rung, and gives a row per trial. All brackets climb a rung in one job; only numbers of the trials, whose
    number the plan fixes, come back to the driver.
    """
    alive, done = trials, []
    for rung in range(1 + max(r for _, r in plan)):
        now = [(t, plan[t.bracket, rung][1]) for t in alive if (t.bracket, rung) in plan]
        if not now:
            break
        on = spark.createDataFrame([(*t, rung, float(b)) for t, b in now], "trial int, bracket int, seq_len int, ridge double, rung int, budget double")
        judged = survivors(on.join(evaluate(now, rung), "trial", "left"), plan, loss)
        done.append(stored(judged, "rung"))
        kept = {r["trial"] for r in done[-1].where("survived").select("trial").collect()}
        alive = [t for t in alive if t.trial in kept]
    return reduce(DataFrame.unionByName, done)


def _windows(values: np.ndarray, lags: int, horizon: int) -> np.ndarray:
    """All spans of ``lags + horizon`` values, as views."""
    return np.lib.stride_tricks.sliding_window_view(values, lags + horizon)


def _design(spans: np.ndarray, lags: int) -> np.ndarray:
    """Rows ``(1, lag_1 .. lag_L, y_0 .. y_H-1)``, the newest lag first."""
    return np.column_stack([np.ones(len(spans)), spans[:, :lags][:, ::-1], spans[:, lags:]])


def scaled_split(series: DataFrame, value: str, test_rows: int = TEST_ROWS) -> DataFrame:
    """``(ClientId, bin, v, is_train)``: scaled to the range of the training rows."""
    split = ordered.chronological_split(
        series.select(*KEY, "bin", F.col(value).alias("v")).na.drop("any"), KEY, ["bin"], None, test_rows=test_rows
    )
    params = transforms.fit_minmax(split.where("is_train"), KEY, ["v"])
    return transforms.minmax_scale(split, params, KEY, ["v"])


def trial_errors(
    split: DataFrame,
    lengths: list[int] = LENGTHS,
    ridges: list[float] = RIDGES,
    horizon: int = HORIZON,
    trials: list[tuple[Trial, float]] | None = None,
) -> DataFrame:
    """Error sums per site and trial: ``(ClientId, seq_len, ridge, n, se, ae, huber)``; of given trials, see :func:`rung_errors`.

    A group is one site's gap-free series, whose length the time grid bounds. The longest feasible input
    gives one moment matrix; every shorter input is a part of it. Lengths a site has too few training rows
    for are skipped. Test inputs may reach back into training rows.
    """
    if trials is not None:
        return rung_errors(split, trials, horizon)
    columns = [*KEY, "seq_len", "ridge", "n", "se", "ae", "huber"]

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches).sort_values("bin")
        train = rows.loc[rows["is_train"], "v"].to_numpy(float)
        every = rows["v"].to_numpy(float)
        feasible = [n for n in lengths if len(train) > n + horizon and len(every) - len(train) > horizon]
        out = []
        if feasible:
            longest = max(feasible)
            size = 1 + longest + horizon
            total = np.zeros((size, size))
            spans = _windows(train, longest, horizon)
            for at in range(0, len(spans), BLOCK):
                z = _design(spans[at : at + BLOCK], longest)
                total += z.T @ z
            test = _windows(every[len(train) - longest :], longest, horizon)
            for length in feasible:
                keep = np.r_[0 : 1 + length, 1 + longest : size]
                for ridge in ridges:
                    weights = linear.solve_moments(total[np.ix_(keep, keep)], length, ridge)
                    sums = _error_sums(test, weights, longest, length)
                    out.append((*key, length, float(ridge), int(sums[0]), *sums[1:]))
        yield pd.DataFrame(out, columns=columns)

    schema = "ClientId int, seq_len int, ridge double, n long, se double, ae double, huber double"
    return split.groupBy(*KEY).applyInPandas(run, schema)


def _error_sums(test: np.ndarray, weights: np.ndarray, longest: int, length: int) -> np.ndarray:
    """Number, squares, absolutes and Huber losses of all errors of the test spans, whose inputs are ``longest`` long."""
    sums = np.zeros(4)
    for at in range(0, len(test), BLOCK):
        z = _design(test[at : at + BLOCK], longest)
        error = np.abs(z[:, 1 + longest :] - z[:, : 1 + length] @ weights.T)
        small = error <= HUBER_DELTA
        loss = np.where(small, 0.5 * error**2, HUBER_DELTA * (error - 0.5 * HUBER_DELTA))
        sums += [error.size, (error**2).sum(), error.sum(), loss.sum()]
    return sums


def rung_errors(split: DataFrame, trials: list[tuple[Trial, float]], horizon: int = HORIZON, budget: float = MAX_BUDGET) -> DataFrame:
    """``(ClientId, trial, n, se, ae, huber)`` of trials that learn from the newest ``budget`` share of the training rows.

    A group is one site's series and one input length, so trials are dealt over tasks; trials of a length share moment matrices. Trials a site
    has too few rows for have no row of that site.
    """
    wanted: dict[int, list[tuple[int, float, float]]] = {}
    for t, share in trials:
        wanted.setdefault(t.seq_len, []).append((t.trial, t.ridge, share / budget))

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches).sort_values("bin")
        train, every, length = rows.loc[rows["is_train"], "v"].to_numpy(float), rows["v"].to_numpy(float), int(key[1])
        out, moments = [], {}
        if len(train) > length + horizon and len(every) - len(train) > horizon:
            spans, test = _windows(train, length, horizon), _windows(every[len(train) - length :], length, horizon)
            for trial, ridge, share in wanted[length]:
                if share not in moments:
                    used = spans[-max(1, round(share * len(spans))) :]
                    designs = (_design(used[at : at + BLOCK], length) for at in range(0, len(used), BLOCK))
                    moments[share] = sum(z.T @ z for z in designs)
                weights = linear.solve_moments(moments[share], length, ridge)
                n, *sums = _error_sums(test, weights, length, length)
                out.append((key[0], trial, int(n), *sums))
        yield pd.DataFrame(out, columns=[*KEY, "trial", "n", "se", "ae", "huber"])

    dealt = split.select(*KEY, "bin", "v", "is_train", F.explode(F.array(*[F.lit(n) for n in wanted])).alias("seq_len"))
    # fitting takes far longer than its few rows suggest: many small partitions, which are not to be merged
    dealt = dealt.repartition(max(8, 4 * int(split.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *KEY, "seq_len")
    return dealt.groupBy(*KEY, "seq_len").applyInPandas(run, "ClientId int, trial int, n long, se double, ae double, huber double")


def trial_scores(errors: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Huber loss, MSE and MAE per trial, over all sites unless keys are given."""
    n, trial = F.sum("n"), ["trial"] if "trial" in errors.columns else ["seq_len", "ridge"]
    return errors.groupBy(*(keys or []), *trial).agg(
        (F.sum("huber") / n).alias("huber_scaled"), (F.sum("se") / n).alias("mse_scaled"), (F.sum("ae") / n).alias("mae_scaled")
    )


def best_trial(scores: DataFrame) -> DataFrame:
    return scores.orderBy("huber_scaled", "seq_len", "ridge").limit(1)


def sweep(series: DataFrame, value: str, test_rows: int = TEST_ROWS, **grid) -> DataFrame:
    return trial_scores(trial_errors(scaled_split(series, value, test_rows), **grid))


def hyperband(
    series: DataFrame, value: str, test_rows: int = TEST_ROWS, lengths: list[int] = LENGTHS, horizon: int = HORIZON
) -> DataFrame:
    """Every trial on every rung it reached: trial, bracket, seq_len, ridge, rung, budget, losses, survived."""
    split, plan = stored(scaled_split(series, value, test_rows), "sweep-split"), rungs()

    def evaluate(trials: list[tuple[Trial, float]], rung: int) -> DataFrame:
        return trial_scores(trial_errors(split, trials=trials, horizon=horizon))

    return halving(series.sparkSession, draws(plan, lengths), evaluate, plan)


def best_of_full_budget(history: DataFrame) -> DataFrame:
    """The best of the trials that got the whole budget: its parameters, Huber loss, MSE and MAE."""
    full = history.where((F.col("budget") == MAX_BUDGET) & F.col("huber_scaled").isNotNull())
    return full.orderBy("huber_scaled", "trial").limit(1).select("seq_len", "ridge", "huber_scaled", "mse_scaled", "mae_scaled")
