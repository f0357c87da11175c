"""Hyperband brackets."""

from datetime import datetime, timedelta

import numpy as np

from wattloom.plans import sweep


def test_rungs_and_draws():
    plan = sweep.rungs(15, 3)
    assert {k: n for k, (n, _) in plan.items()} == {(2, 0): 9, (2, 1): 3, (2, 2): 1, (1, 0): 5, (1, 1): 1, (0, 0): 3}
    assert [round(plan[2, r][1], 3) for r in range(3)] == [1.667, 5, 15] and plan[0, 0][1] == plan[1, 1][1] == 15
    assert {n for (b, r), (n, _) in sweep.rungs(81, 3).items() if r == 0} == {81, 34, 15, 8, 5}
    trials = sweep.draws(sweep.rungs(81, 3))
    assert trials == sweep.draws(sweep.rungs(81, 3)) and len(trials) == 143
    assert {t.seq_len for t in trials} == set(sweep.LENGTHS)
    decades = np.histogram(np.log10([t.ridge for t in trials]), range(-2, 5))[0]
    assert decades.min() > 10


def test_convex_losses_lead_to_the_best_of_the_full_grid(spark):
    plan = sweep.rungs(27, 3)
    trials = sweep.draws(plan)
    loss = {t.trial: (np.log10(t.ridge) - 1) ** 2 + ((t.seq_len - 400) / 300) ** 2 for t in trials}
    asked = []

    def evaluate(now, rung):
        asked.append([b for _, b in now])
        return spark.createDataFrame([(t.trial, float(loss[t.trial] * (1 + 1 / b))) for t, b in now], "trial int, huber_scaled double")

    history = sweep.halving(spark, trials, evaluate, plan)
    full = history.where("budget = 27").orderBy("huber_scaled").collect()
    assert full[0]["trial"] == min(loss, key=loss.get)
    assert [len(a) for a in asked] == [sum(n for (_, r), (n, _) in plan.items() if r == k) for k in range(4)]
    for (bracket, rung), (n, budget) in plan.items():
        part = history.where(f"bracket = {bracket} AND rung = {rung}").collect()
        assert len(part) == n and {r["budget"] for r in part} == {budget}
        kept = sorted(part, key=lambda r: (r["huber_scaled"], r["trial"]))[: plan.get((bracket, rung + 1), (0, 0))[0]]
        assert {r["trial"] for r in part if r["survived"]} == {r["trial"] for r in kept}


def test_trials_without_a_loss_do_not_survive(spark):
    plan = sweep.rungs(3, 3)
    trials = sweep.draws(plan)
    history = sweep.halving(spark, trials, lambda now, rung: spark.createDataFrame([], "trial int, huber_scaled double"), plan)
    assert history.count() == sum(n for (_, r), (n, _) in plan.items() if r == 0) and history.where("survived").isEmpty()


def test_the_whole_budget_is_the_plain_fit(spark):
    rng = np.random.default_rng(3)
    n, test, horizon = 200, 40, 3
    rows = [(1, datetime(2024, 1, 1) + timedelta(minutes=15 * i), float(x)) for i, x in enumerate(np.sin(np.arange(n) / 5) + rng.normal(size=n) * 0.1)]
    split = sweep.scaled_split(spark.createDataFrame(rows, "ClientId int, bin timestamp_ntz, v double"), "v", test)
    plain = sweep.trial_errors(split, [8], [2.0], horizon).first()
    trials = [(sweep.Trial(0, 0, 8, 2.0), 15.0), (sweep.Trial(1, 0, 8, 2.0), 5.0), (sweep.Trial(2, 0, 500, 2.0), 15.0)]
    got = {r["trial"]: r for r in sweep.trial_errors(split, trials=trials, horizon=horizon).collect()}
    assert set(got) == {0, 1}
    np.testing.assert_allclose([got[0][c] for c in ("n", "se", "ae", "huber")], [plain[c] for c in ("n", "se", "ae", "huber")], rtol=1e-9)
    assert got[1]["se"] != got[0]["se"]
