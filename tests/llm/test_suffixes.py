import hashlib
import random

import numpy as np
import pytest
from wattloom.llm import suffixes


def by_hand(rows, length):
    """Every string's first document, from a dictionary of all strings."""
    key = lambda i: (i is None, i or 0)
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - length + 1):
            s = raw[k : k + length]
            if s not in first or key(doc) < key(first[s]):
                first[s] = doc
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if key(first[raw[k : k + length]]) < key(doc):
                gone[k : k + length] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs, **args):
    return sorted((tuple(r) for r in suffixes.deduplicated(docs, **args).drop("kept").collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = by_hand(rows, 50)
    assert sum(r[2] for r in want) > 0 and found(docs) == want


@pytest.mark.parametrize("seed", range(4))
def test_small_alphabets_and_many_levels(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab") for _ in range(rng.randrange(3, 25))) for _ in range(12)]
    rows = [(rng.choice([None, *range(40)]), "".join(rng.choice([*pool, "é", "c", ""]) for _ in range(rng.randrange(0, 9)))) for _ in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for length, batch in ((6, 1), (9, 40), (13, 1000)):
        assert found(docs, length=length, batch=batch) == by_hand(rows, length)


def test_levels_grow_geometrically():
    family = suffixes.Family()
    for k in range(13):
        family.add(np.array([f"{k:04d}".encode()], "S4"))
        assert family.earlier(np.array([b"0000", b"9999"], "S4")).tolist() == [True, False]
        assert [i for i, x in enumerate(family.levels) if x is not None] == [i for i in range(4) if (k + 1) >> i & 1]
        assert all(len(x) == 1 << i for i, x in enumerate(family.levels) if x is not None)


def test_stretches_hold_every_suffix_once():
    rng = np.random.default_rng(3)
    sizes = [0, 3, 49, 50, 51, 400, 7, 120, 50]
    starts = np.cumsum([0, *sizes])
    raw = rng.integers(97, 100, starts[-1]).astype(np.uint8)
    first, n, anchors = suffixes.stretches(raw, starts, 50)
    places = [p for f, k in zip(first.tolist(), n.tolist(), strict=True) for p in range(f, f + k)]
    assert places == [s + k for s, size in zip(starts.tolist(), sizes, strict=False) for k in range(size - 49)]
    again = suffixes.stretches(raw[starts[5] : starts[6]], np.array([0, 400]), 50)
    inside = (first >= starts[5]) & (first < starts[6])
    assert np.array_equal(again[0] + starts[5], first[inside]) and np.array_equal(again[2], anchors[inside])


def test_a_passage_in_most_documents_is_one_piece_a_part(spark):
    passage = "".join(chr(97 + (k * k) % 26) for k in range(200))
    rows = [(i, f"{i:06d} own text {passage} and {i * 7919:09d}") for i in range(3000)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got == by_hand(rows, 50)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert found(odd_documents) == by_hand(rows, 50)
    assert found(no_documents) == []


def test_merged_spans():
    assert suffixes.merged(np.array([0, 2, 9, 10]), np.array([5, 3, 10, 12])) == [(0, 5), (9, 12)]
    assert suffixes.merged(np.empty(0, int), np.empty(0, int)) == []


@pytest.mark.parametrize("ids", [(5, 3, 5), (None, 3, None)])
def test_a_copy_of_a_later_id_that_comes_first(spark, ids):
    passage = "".join(chr(97 + (k * k) % 26) for k in range(80))
    rows = list(zip(ids, (f"one text {passage} ends", f"one text {passage} ends", f"another {passage} goes on"), strict=True))
    got = found(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert got == by_hand(rows, 50) and sum(r[2] for r in got) > len(rows[0][1])
