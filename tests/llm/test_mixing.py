import random
from collections import defaultdict

from pyspark.sql import functions as F
from wattloom.llm import mixing


def by_hand(sizes):
    """Targets by resharing the excess until none is above its ceiling."""
    names = sorted((s for s in sizes if s is not None), key=str) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total = 1.5 * sum(sizes.values())
    capped: set = set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in capped else share[s] for s in names}
        capped |= above


def test_targets_by_resharing(spark):
    rng = random.Random(3)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 1, 10, rng.randrange(5000)]) for i in range(rng.randrange(1, 12))} | {None: rng.randrange(100)}
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        want = by_hand(sizes)
        for r in got.collect():
            assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]), sizes


def test_budgets_are_met(spark):
    rows = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("n", F.lit(1))).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["target"], r["source_size"]].append(r)
        assert r["taken"] <= 2 * r["size"] and r["taken"] % max(1, r["size"]) == 0
    for (target, _), docs in by.items():
        assert abs(sum(d["taken"] for d in docs) - target) <= max(d["size"] for d in docs) / 2 * len({target})
        times = {d["taken"] // d["size"] for d in docs if d["size"]}
        assert max(times) - min(times) <= 1  # whole epochs before the fraction


def test_epochs_repeat_documents_as_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    taken = {r["doc_id"]: r["taken"] // max(1, r["size"]) for r in mixing.mix(docs).collect() if r["size"]}
    times = {r["doc_id"]: r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()}
    assert times == {i: n for i, n in taken.items() if n}
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_good_documents_are_drawn_sooner(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.lit("plain words only in here")).otherwise(F.lit("## %% && ## %%")).alias("text"),
        F.concat(F.lit("s"), F.floor(F.col("id") / 2000)).alias("source"),
    )
    rows = [r for r in mixing.mix(docs).collect() if r["doc_id"] >= 4000]  # five sixths of an epoch
    share = [sum(r["taken"] > 0 for r in rows if r["doc_id"] % 2 == k) for k in (0, 1)]
    assert share[0] > 990 and 600 < share[1] < 720


def test_native_and_no_task_with_all_of_a_source(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("hot").alias("source"))
    out = mixing.mix(docs)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    cells = mixing.weighed(docs).groupBy("__bin").count()
    assert cells.agg(F.max("count")).first()[0] < 30


def test_odd_rows(spark, odd_documents, no_documents):
    rows = mixing.mix(odd_documents).collect()
    assert len(rows) == 14 and all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert sum(r["size"] for r in rows if r["doc_id"] in (3, 4, 5)) == 0
    assert mixing.mixed_documents(odd_documents).columns == odd_documents.columns
    assert mixing.mix(no_documents).count() == 0 and mixing.mixed_documents(no_documents).count() == 0
    assert sorted(map(str, mixing.mix(odd_documents.repartition(3)).collect())) == sorted(map(str, rows))
