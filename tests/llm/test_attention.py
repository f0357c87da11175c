import numpy as np
from wattloom.llm import attention
from wattloom.llm.common import held_out, labelled_sample

SF = "/root/testdata/sf0.01"


def test_held_out_documents_are_told_apart(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = attention.scored(docs, attention.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_are_never_read(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", (1 - labels.quality * held_out().cast("int")).cast("int")).where(held_out()).unionByName(labels.where(~held_out()))
    a, b = (attention.scored(docs, attention.fit(docs, x)).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, 6)) for n in (1, 4, 3, 2)] * 5
    labels = np.array([float(b[:, 0].max() > 0.5) for b in bags])
    model = attention.Model(6)
    first = model.scores(bags)
    after = model.fit(bags, labels).scores(bags)
    loss = [-np.mean(labels * np.log(y) + (1 - labels) * np.log(1 - y)) for y in (first, after)]
    assert loss[1] < 0.1 < loss[0]
    x, starts, of = attention._stacked(bags)
    weights = model._forward((x - model.mean) / model.scale, starts, of)[3]
    assert np.allclose(np.add.reduceat(weights, starts), 1)


def test_passages_cover_the_whole_text(monkeypatch):
    text = " ".join(["fine"] * 300 + ["$$$###"] * 40).encode()
    whole = attention.encode(text)
    assert whole.shape == (6, attention.FEATURES) and whole[5, ord("$")] > 0 and whole[0, ord("$")] == 0
    monkeypatch.setattr(attention, "CHUNK", attention.PASSAGE)
    assert np.array_equal(attention.encode(text), whole)


def test_one_class_or_no_labels(spark, odd_documents):
    for rows in ([], [(1, 1), (6, 1), (3, None), (None, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        scores = {r["score"] for r in attention.scored(odd_documents, attention.fit(odd_documents, labels)).collect()}
        assert len(scores) == 1 and (scores.pop() > 0.5) == bool(rows)


def test_sample_is_bounded_and_repeatable(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    a, b = (sorted(r["doc_id"] for r in labelled_sample(docs, x, "quality", 40).collect()) for x in (labels, labels.repartition(3)))
    assert a == b and len(a) == 40


def test_passages_of_the_sample_are_bounded(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    one = attention.fit(docs, labels, passages=1)  # the first document alone: one class, a constant
    assert len(set(one.scores([attention.encode(b"a b c"), attention.encode(b"$$$ ###")]))) == 1


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (9, 0), (10, 0), (6, 1)], "doc_id long, quality int")
    model = attention.fit(odd_documents, labels)
    rows = attention.scored(odd_documents, model).collect()
    assert len(rows) == 14 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    kept = attention.accepted(odd_documents, model)
    assert kept.schema == odd_documents.schema and kept.count() == sum(r["predicted"] for r in rows)
    assert attention.scored(no_documents, model).count() == 0 and attention.accepted(no_documents, model).count() == 0
