import numpy as np
from wattloom.llm import tiling

SF = "/root/testdata/sf0.01"


def by_hand(item, doc, shortest):
    """Greedy string tiling by trying all places: the longest unmarked match first."""
    in_item, in_doc, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = (shortest - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not in_item[i + n] and not in_doc[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < shortest:
            return tiles
        tiles.append((i, j, n))
        for k in range(n):
            in_item[i + k] = in_doc[j + k] = True


def test_tiles_like_exhaustive_tiling():
    rng = np.random.default_rng(1)
    for _ in range(60):
        item, doc = rng.integers(1, 4, rng.integers(0, 18)), rng.integers(0, 4, rng.integers(0, 40))
        got, want = tiling.tile(item, doc, 3), by_hand(item.tolist(), doc.tolist(), 3)
        assert [n for *_, n in got] == [n for *_, n in want]
        assert sum(n for *_, n in got) == sum(n for *_, n in want)


def test_planted_passages(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    found = tiling.contaminated(docs, bench)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    items = [(r["item_id"], tiling.tokens(r["text"])) for r in bench.collect()]
    want = set()
    for r in docs.collect():
        text = f" {' '.join(tiling.tokens(r['text']))} "
        want |= {(r["doc_id"], i) for i, words in items if f" {' '.join(words)} " in text}
    assert want and want <= got and len(got) <= len(want) + 2
    kept = {r["doc_id"] for r in tiling.clean(docs, bench).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {i for i, _ in got}
    blocks = list(tiling.blocks(bench, 1000))
    assert len(blocks) > 3 and sorted(r["item_id"] for b in blocks for r in b) == sorted(i for i, _ in items)


def test_moved_sentences_and_partial_passages(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(10)) for x in "abc")
    bench = spark.createDataFrame([(1, f"{a}. {b}. {c}."), (2, "too short"), (3, None), (None, a), (4, f"{a}. {b}. {c}.")], "item_id long, text string")
    docs = [(1, f"x {c.upper()}, y {a} z {b}"), (2, f"{a} and {b}"), (3, f"{a[:8]} {b} {c}"), (4, None), (5, "too short"), (5, f"{a}\n{b}\n{c}")]
    found = tiling.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    got = {(r["doc_id"], r["item_id"], r["covered_tokens"], r["tiles"]) for r in found.collect()}
    assert {r for r in got if r[1] is not None} == {(1, 1, 30, 3), (1, 4, 30, 3), (5, 1, 30, 1), (5, 4, 30, 1)}
    # items without an id are reported as such
    assert {r for r in got if r[1] is None} == {(1, None, 10, 1), (2, None, 10, 1), (5, None, 10, 1)} and found.count() == len(got)


def test_odd_rows(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    kept = tiling.clean(odd_documents, bench)
    assert kept.schema == odd_documents.schema and kept.count() == 11
    empty = spark.createDataFrame([], "item_id long, text string")
    assert tiling.clean(odd_documents, empty).count() == 14 and tiling.contaminated(odd_documents, empty).count() == 0
    assert tiling.clean(no_documents, bench).count() == 0 and tiling.contaminated(no_documents, bench).count() == 0


def test_items_without_an_id_are_cleaned_too(spark):
    passage = " ".join(f"a{i}" for i in range(10))
    bench = spark.createDataFrame([(1, "some other item of many words that nothing holds"), (None, passage), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {passage} y"), (2, "clean"), (None, None)], "doc_id long, text string")
    assert sorted(r["doc_id"] or 0 for r in tiling.clean(docs, bench).collect()) == [0, 2]


def test_repetitive_texts_take_little_memory():
    import tracemalloc

    item = np.ones(300, np.int64)
    tracemalloc.start()
    assert tiling.tile(item, np.ones(200_000, np.int64)) == [(0, 0, 300)]
    assert tracemalloc.get_traced_memory()[1] < 100_000_000
    tracemalloc.stop()
    period = np.tile(np.arange(1, 8), 40)
    tiles = tiling.tile(period, np.concatenate([period[3:150], [0], period[:60], [0], np.tile(np.arange(1, 8), 20_000)]))
    assert tiles == [(0, 209, 280)]
