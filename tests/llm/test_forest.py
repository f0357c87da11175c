import numpy as np
from wattloom.llm import forest


def by_hand(ids, rows, every=50, k=5):
    x = np.array(rows, float)
    # running sums add component after component
    norm = np.sqrt(np.cumsum(x * x, axis=1)[:, -1])
    out = {}
    for q in [i for i, v in enumerate(ids) if v % every == 0]:
        score = np.cumsum(x * x[q], axis=1)[:, -1] / (norm * norm[q])
        others = np.flatnonzero(np.array(ids) != ids[q])
        out[ids[q]] = [(ids[j], score[j]) for j in sorted(others, key=lambda j: (-score[j], ids[j]))[:k]]
    return out


def grouped(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_recall_and_exact_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.collect()
    want = by_hand([r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    for df in (forest.neighbours(vectors), forest.search(forest.build(vectors, segment=300), vectors.where("vec_id % 50 = 0"), block=16)):
        got = grouped(df)
        assert set(got) == set(want) and all([r for r, *_ in v] == [1, 2, 3, 4, 5] for v in got.values())
        hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
        assert hits >= 0.9 * 5 * len(want)
        exact = {(q, v): s for q in want for v, s in want[q]}
        assert all(s == exact[q, v] for q in got for _, v, s in got[q] if (q, v) in exact)


def test_ascent_leaves_candidates_out_and_meets_near_ones():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(200, 32))
    x = np.repeat(centres, 40, axis=0) + 0.1 * rng.normal(size=(8000, 32))
    keys = forest.strings(x, forest.planes(32, 8, 24), 8, 24).T
    order = np.argsort(keys, axis=1, kind="stable").astype(np.uint32)
    row = {"n": 8000, "dim": 32, "vec_ids": np.arange(8000).tobytes(), "vectors": x.tobytes(), "strings": np.take_along_axis(keys, order, 1).tobytes(), "orders": order.tobytes()}
    segment = forest.Segment(row, 8, 24)
    counts = segment.counts(keys[:, :5].T)
    for q in range(5):
        for depth in (0, 1, 7, 24):
            assert counts[q, depth] == ((keys >> (24 - depth)) == (keys[:, q : q + 1] >> (24 - depth))).sum()
    depth = np.array([24 - np.argmax((c >= 200)[::-1]) for c in counts])
    for q, met in enumerate(segment.candidates(keys[:, :5].T, depth)):
        assert len(met) < 2000 and (met < 40).sum() > 30


def test_unusable_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [3.0, 0.0], None), (50, [0.0, 1.0], 1), (3, [0.0, 0.0], 1), (4, None, 1), (5, [1.0, None], 1),
        (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (None, [1.0, 0.0], 1), (100, [0.0, 0.0], 1), (150, [1.0, 1.0, 1.0], 1), (8, [], 1), (9, [1.0, 0.0], 1), (9, [1.0, 0.0], 1),
    ]
    got = grouped(forest.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")))
    assert [(v, s) for _, v, s in got[0]] == [(1, 1.0), (2, 1.0), (9, 1.0), (9, 1.0), (50, 0.0)]
    assert [v for _, v, _ in got[50]] == [0, 1, 2, 9, 9] and set(got) == {0, 50}


def test_many_equal_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, ([1.0] * 8 if i % 3 else rng.normal(size=8).tolist())) for i in range(3000)]
    got = grouped(forest.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    for q, found in got.items():
        if q % 3:
            assert [v for _, v, _ in found] == [v for v in range(1, 9) if v % 3 and v != q][:5]


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert forest.neighbours(empty).count() == 0
