"""K-means of every key against plain rounds."""

import numpy as np

from wattloom.operators import clustering


def plain(x, centres, rounds=20):
    for _ in range(rounds):
        of = [min(range(len(centres)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(p, centres[j], strict=True)), j)) for p in x]
        centres = [np.mean([p for p, o in zip(x, of, strict=True) if o == j], axis=0) if j in of else c for j, c in enumerate(centres)]
    return np.array(centres)


def test_rounds_and_start():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(20, 3)) + 6 * rng.normal(size=3) for _ in range(4)])
    names = [str(i) for i in range(len(x))]
    first = clustering.start(names, x, 4, 7)
    assert first.tolist() == clustering.start(names, x, 4, 7).tolist() != clustering.start(names, x, 4, 8).tolist()
    assert len({tuple(c) for c in first}) == 4
    np.testing.assert_allclose(clustering.lloyd(x, first), plain(x, list(first)))


def test_few_different_points_and_far_groups(spark):
    rows = [(1, f"d{i}", [float(i % 2), 1.0]) for i in range(12)]
    rows += [(2, f"d{i}", [float(i // 4) * 100 + i % 4, 0.0]) for i in range(12)]
    points = spark.createDataFrame(rows, "ClientId int, d string, f array<double>")
    centres = clustering.fit(points, "ClientId", "d", "f", 3).persist()
    got = {}
    for r in centres.collect():
        got.setdefault(r["ClientId"], []).append(r["centroid"])
    assert sorted(got[1]) == [[0, 1], [1, 1]]
    assert sorted(got[2]) == [[1.5, 0], [101.5, 0], [201.5, 0]]
    assigned = clustering.assign(points, centres, "ClientId", "f").collect()
    assert len(assigned) == 24
    by_id = {(r["ClientId"], r["cluster"]): r["centroid"] for r in centres.collect()}
    assert all(sum((a - b) ** 2 for a, b in zip(r["f"], by_id[r["ClientId"], r["cluster"]], strict=True)) <= 2.25 for r in assigned)


def test_ties_go_to_the_first_centre_and_empty_centres_stay(spark):
    x = np.array([[0.0], [2.0]])
    np.testing.assert_allclose(clustering.lloyd(x, np.array([[1.0], [1.0], [50.0]])), [[1.0], [1.0], [50.0]])
    points = spark.createDataFrame([(1, "a", [1.0])], "ClientId int, d string, f array<double>")
    centres = spark.createDataFrame([(1, 0, [0.0]), (1, 1, [2.0])], "ClientId int, cluster int, centroid array<double>")
    assert clustering.assign(points, centres, "ClientId", "f").first()["cluster"] == 0
    assert clustering.fit(points.limit(0), "ClientId", "d", "f", 3).isEmpty()
