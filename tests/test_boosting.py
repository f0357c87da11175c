"""Boosted trees: splits against exhaustive search, scores against a plain walk, reuse of stored ensembles."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattloom.operators import boosting


def exhaustive(x, y, trees, rate, depth, l2=1.0):
    """Predictions on ``x`` of trees grown by trying every value of every feature in every node."""
    out = np.full(len(y), y.mean())

    def grow(rows, level, g):
        total, best, chosen = g[rows].sum(), 0.0, None
        if level < depth:
            for f in range(x.shape[1]):
                for c in np.unique(x[rows, f])[1:]:
                    left = x[rows, f] < c
                    a, b = g[rows[left]], g[rows[~left]]
                    gain = a.sum() ** 2 / (len(a) + l2) + b.sum() ** 2 / (len(b) + l2) - total**2 / (len(rows) + l2)
                    if gain > best * (1 + 1e-9) + 1e-9:
                        best, chosen = gain, (f, c)
        if chosen is None:
            step[rows] = -rate * total / (len(rows) + l2)
        else:
            left = x[rows, chosen[0]] < chosen[1]
            grow(rows[left], level + 1, g)
            grow(rows[~left], level + 1, g)

    for _ in range(trees):
        step = np.zeros(len(y))
        grow(np.arange(len(y)), 0, out - y)
        out = out + step
    return out


def walked(x, nodes):
    by = {(t, n): (f, c, a, b, v) for t, n, f, c, a, b, v in nodes}
    out = []
    for row in x:
        total = 0.0
        for t in {t for t, _ in by}:
            n = 1
            while by[t, n][0] >= 0:
                f, c, a, b, _ = by[t, n]
                n = a if row[f] < c else b
            total += by[t, n][4]
        out.append(total)
    return np.array(out)


@pytest.mark.parametrize("seed", range(4))
def test_trees_of_exhaustive_search(seed):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=90), rng.integers(0, 3, 90), rng.normal(size=90).round(1)])
    y = x[:, 0] * 2 + np.sin(x[:, 2] * 3) + rng.normal(size=90) * 0.1
    nodes = list(boosting.grow_trees(x, y, trees=6, rate=0.3, depth=3))
    np.testing.assert_allclose(walked(x, nodes), exhaustive(x, y, 6, 0.3, 3), rtol=1e-9)


def test_learns_a_function_and_stops_at_constants():
    rng = np.random.default_rng(0)
    x = rng.uniform(-2, 2, size=(2000, 4))
    y = np.sin(2 * x[:, 0]) + x[:, 1] ** 2
    nodes = list(boosting.grow_trees(x, y, trees=100, rate=0.1, depth=4))
    other = rng.uniform(-1.9, 1.9, size=(300, 4))
    assert np.abs(walked(other, nodes) - np.sin(2 * other[:, 0]) - other[:, 1] ** 2).mean() < 0.1
    assert max(n for t, n, *_ in nodes) < 2 ** 5
    flat = list(boosting.grow_trees(x, np.full(2000, 7.0), trees=3, rate=0.1, depth=4))
    assert len(flat) == 4 and walked(other[:2], flat) == pytest.approx([7, 7])
    same = list(boosting.grow_trees(np.ones((50, 2)), rng.normal(size=50), trees=2, rate=0.1, depth=4))
    assert len(same) == 3


def test_edges():
    assert boosting.bin_edges(np.array([3.0, 1.0, 2.0, 3.0])).tolist() == [2, 3]
    many = boosting.bin_edges(np.arange(10_000.0), 16)
    assert len(many) == 15 and np.diff(many).min() > 500


ROWS = [(c, i, float(np.sin(i / 3 + c)), float(i % 5), float((np.sin(i / 3 + c) * 10 + i % 5) * (c + 1))) for c in (1, 2, 3) for i in range(60 if c < 3 else 1)]
SCHEMA = "ClientId int, i int, a double, b double, y double"
HOW = dict(inputs=["a", "b"], label="y", order=["i"], trees=20, rate=0.2, depth=3)


def test_ensembles_per_key_and_scores(spark):
    table = spark.createDataFrame(ROWS, SCHEMA)
    trees = boosting.fit(table, ["ClientId"], **HOW)
    got = {(r["ClientId"], r["i"]): r["prediction"] for r in boosting.predict(table, trees, ["ClientId"], ["a", "b"]).collect()}
    assert {c for c, _ in got} == {1, 2}  # one row makes no ensemble
    for c in (1, 2):
        rows = [r for r in ROWS if r[0] == c]
        x, y = np.array([r[2:4] for r in rows]), np.array([r[4] for r in rows])
        np.testing.assert_allclose([got[c, r[1]] for r in rows], exhaustive(x, y, 20, 0.2, 3), rtol=1e-9)
    leaves = trees.where("feature IS NULL")
    assert leaves.where("cut IS NOT NULL OR left IS NOT NULL OR right IS NOT NULL").isEmpty()
    assert trees.where("feature IS NOT NULL AND (left <> 2 * node OR right <> 2 * node + 1)").isEmpty()


def test_nulls_go_right_and_incomplete_rows_are_not_learned_from(spark):
    table = spark.createDataFrame([*ROWS, (1, 99, None, 0.0, 1e9), (2, 99, 0.0, 0.0, None)], SCHEMA)
    assert sorted(boosting.fit(table, ["ClientId"], **HOW).collect()) == sorted(boosting.fit(spark.createDataFrame(ROWS, SCHEMA), ["ClientId"], **HOW).collect())
    nodes = [(1, 0, 1, None, None, None, None, 1.0), (1, 1, 1, 0, 0.5, 2, 3, 0.0), (1, 1, 2, None, None, None, None, 10.0), (1, 1, 3, None, None, None, None, 20.0)]
    trees = spark.createDataFrame(nodes, f"ClientId int, {boosting.NODE}")
    rows = spark.createDataFrame([(1, 0.4), (1, 0.5), (1, None), (9, 0.1)], "ClientId int, a double")
    got = boosting.predict(rows, trees, ["ClientId"], ["a"])
    assert sorted((r["a"] is None, r["a"], r["prediction"]) for r in got.collect() if r["a"] is not None) == [(False, 0.4, 11.0), (False, 0.5, 21.0)]
    assert [r["prediction"] for r in got.where("a IS NULL").collect()] == [21.0]


def table_of(nodes):
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*nodes, strict=True), kinds, strict=True)], [c.split()[0] for c in boosting.NODE.split(", ")])


def small_trees(count):
    """Two cuts a tree, in the second feature and the first."""
    for t in range(count):
        yield t, 1, 1, (t % 7) / 7, 2, 3, 0.0
        yield t, 3, 0, (t % 11) / 11, 6, 7, 0.0
        for n in (2, 6, 7):
            yield t, n, None, None, None, None, float(t % 5 + n)


def test_memory_does_not_grow_with_rows_times_trees():
    nodes = table_of(small_trees(4000))
    x = np.random.default_rng(0).uniform(size=(2000, 2))
    tracemalloc.start()
    got = boosting._walk(x, nodes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    t = np.arange(4000)
    ends = np.where(x[:, 1:] < t % 7 / 7, 2, np.where(x[:, :1] < t % 11 / 11, 6, 7))
    np.testing.assert_allclose(got, (t % 5 + ends).sum(axis=1))
    assert peak < 16e6  # one array of all pairs takes 64 MB


def test_memory_does_not_grow_with_the_names_of_nodes():
    """A chain of 30 cuts; the names double with each."""
    chain = [(0, 2 ** (i + 1) - 1, 0, float(i), 2 ** (i + 2) - 2, 2 ** (i + 2) - 1, 0.0) for i in range(30)]
    leaves = [(0, 2 ** (i + 2) - 2, None, None, None, None, float(i)) for i in range(30)]
    got = boosting._walk(np.array([[-1.0], [0.5], [28.5], [29.5], [np.nan]]), table_of([*chain, *leaves]))
    assert got.tolist() == [0, 1, 29, 0, 0]  # the last right child is not there


def test_feature_out_of_the_inputs():
    with pytest.raises(IndexError):
        boosting._walk(np.zeros((2, 2)), table_of([(0, 1, 2, 0.5, 2, 3, 0.0), (0, 2, None, None, None, None, 1.0)]))


@pytest.mark.parametrize("few", [(7, 5), (10**6, 5), (7, 10**6)])
def test_trees_and_rows_are_dealt_to_groups_of_bounded_size(spark, monkeypatch, few):
    """Keys of 1, 40 and 3 trees, one of them null, one without rows; rows that come twice stay two."""
    monkeypatch.setattr(boosting, "PART_NODES", few[0])
    monkeypatch.setattr(boosting, "PART_ROWS", few[1])
    walk = boosting._walk

    def bounded(x, nodes):
        # parts are even but for chance, and a tree is not cut
        if len(x) > 6 * few[1] or nodes.num_rows > 6 * few[0]:
            raise AssertionError(f"{len(x)} rows meet {nodes.num_rows} nodes")
        return walk(x, nodes)

    monkeypatch.setattr(boosting, "_walk", bounded)
    counts = {("a", 1): 1, ("a", 2): 40, (None, 1): 3, ("z", 1): 2}
    trees = spark.createDataFrame([(*k, *n) for k, c in counts.items() for n in small_trees(c)], f"site string, h int, {boosting.NODE}")
    rng = np.random.default_rng(1)
    given = [(site, h, i, *rng.uniform(size=2).tolist()) for site, h in (("a", 1), ("a", 2), (None, 1), ("none", 1)) for i in range(60)]
    given = [*given, *given[60:70], ("a", 2, 99, None, 0.4)]
    rows = spark.createDataFrame(given, "site string, h int, i int, p double, q double")
    scored = boosting.predict(rows, trees, ["site", "h"], ["p", "q"], "sum")
    assert scored.columns == [*rows.columns, "sum"]
    want = []
    for site, h, i, p, q in given:
        if (site, h) in counts:
            ends = [2 if q < t % 7 / 7 else 6 if p is not None and p < t % 11 / 11 else 7 for t in range(counts[site, h])]
            want.append((str(site), h, i, str(p), q, float(sum(t % 5 + n for t, n in enumerate(ends)))))
    got = [(str(r["site"]), r["h"], r["i"], str(r["p"]), r["q"], r["sum"]) for r in scored.collect()]
    assert sorted(got) == sorted(want)


def test_only_keys_without_an_ensemble_are_fitted(spark):
    table = spark.createDataFrame(ROWS, SCHEMA)
    known = spark.createDataFrame([(1, 0, 1, None, None, None, None, 5.0)], f"ClientId int, {boosting.NODE}")
    trees = boosting.fit_or_reuse(table, ["ClientId"], known, **HOW)
    assert trees.where("ClientId = 1").count() == 1
    assert sorted(trees.where("ClientId = 2").collect()) == sorted(boosting.fit(table, ["ClientId"], **HOW).where("ClientId = 2").collect())


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    trees = boosting.fit(none, ["ClientId"], **HOW)
    assert trees.isEmpty() and boosting.predict(none, trees, ["ClientId"], ["a", "b"]).columns[-1] == "prediction"


def test_the_hourly_job_uses_stored_ensembles(spark, monkeypatch):
    from test_models import site_readings

    from wattloom.plans import load_hourly

    energy, measurements = site_readings(spark, 4)
    table = load_hourly.supervised(energy, measurements)
    known = load_hourly.fit(table, trees=4, depth=3).where("ClientId = 1").persist()
    assert {(r["ClientId"], r["h"]) for r in known.select("ClientId", "h").distinct().collect()} == {(1, h) for h in range(1, 5)}
    moved = known.withColumn("value", F.when(F.col("tree") == 0, 1e6).otherwise(0.0))
    out = load_hourly.forecast(energy, measurements, "2024-01-04 11:45:00", trees=4, depth=3, known=moved).collect()
    power = {(r["ClientId"], r["h"]): r["LoadPower"] for r in out}
    assert {power[1, h] for h in range(1, 5)} == {1e6} and all(power[2, h] < 1e5 for h in range(1, 5))
    assert len({power[2, h] for h in range(1, 5)}) > 1
