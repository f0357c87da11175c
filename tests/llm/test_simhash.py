import random
from itertools import combinations

import numpy as np
import xxhash
from wattloom.llm import simhash
from wattloom.llm.components import roots


def by_hand(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, near):
    """Smallest member reachable, by union of all pairs."""
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(values))]


def test_fingerprints_and_components(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.report(docs).collect()}
    rows = sorted((r["doc_id"], by_hand(r["text"] or "")) for r in docs.collect())
    found = classes([f for _, f in rows], lambda a, b: (a ^ b).bit_count() <= 3)
    assert got == {i: (f"{f:016x}", rows[c][0]) for (i, f), c in zip(rows, found, strict=True)}
    assert len(set(found)) < len(rows)


def _walks(rng, groups, steps):
    """Groups of fingerprints that differ from one another by few bits."""
    out = set()
    for _ in range(groups):
        f = rng.getrandbits(64)
        for _ in range(steps):
            out.add(f)
            for _ in range(rng.choice([1, 2, 3, 4])):
                f ^= 1 << rng.randrange(64)
    return sorted(out)


def test_links_connect_what_all_pairs_connect(spark):
    rng = random.Random(5)
    values = _walks(rng, 12, 12) + [0, 1, (1 << 64) - 1]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    entries = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = classes(values, lambda a, b: (a ^ b).bit_count() <= 3)
    for longest in (simhash.LIST, 3, 1):  # longer lists are dealt on by two more bytes
        tree = {r["node"]: r["root"] for r in roots(simhash.links(entries, longest=longest)).collect()}
        got = [tree.get(v, v) for v in signed]
        assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want)), longest


def test_five_shared_bytes_meet_in_a_list_that_was_dealt_on():
    named = [set(p) for ways in simhash.DEALT for p in ways]
    assert len(named) == 80 and {len(p) for p in named} == {5}
    for shared in combinations(range(8), 5):
        # in a three-byte list, and after dealing it on in one that all five name
        assert any(set(p) <= set(shared) and set(shared) in [set(w) for w in ways] for p, ways in zip(simhash.POSTINGS, simhash.DEALT, strict=True))


def test_flips_connect_what_a_tally_of_the_list_connects():
    rng = random.Random(8)
    for way, sign in ((1, 0), (7, 1)):
        named = simhash.DEALT[7][way - 1]
        free = [8 * p + i for p in range(8) if p not in named for i in range(8)]
        base = rng.getrandbits(64) | sign << 63
        values = {base ^ sum(1 << i for i in rng.sample(free, rng.randrange(0, 9))) for _ in range(300)}
        fps = np.array(sorted(values), np.uint64)
        found = []
        for a, b in (simhash._forest(fps, 3, 5), simhash._forest_by_flips(fps, 7 * simhash.WAYS + way, 3)):
            pairs = list(zip(*(np.concatenate([np.empty(0, np.uint64), *x]).tolist() for x in (a, b)), strict=True))
            assert all((x ^ y).bit_count() <= 3 for x, y in pairs) and len(pairs) < len(fps)
            place = {v: i for i, v in enumerate(fps.tolist())}
            joined = {frozenset((place[x], place[y])) for x, y in pairs}
            found.append(classes(list(range(len(fps))), lambda i, j, joined=joined: frozenset((i, j)) in joined))
        assert found[0] == found[1] == classes(fps.tolist(), lambda x, y: (x ^ y).bit_count() <= 3)


def test_a_list_beyond_the_limit_is_dealt_on_within_one_job(spark):
    """A crowd that shares four bytes, in small batches: every list of it is long."""
    rng = random.Random(3)
    crowd = {0x7F00AA0000000000 | rng.getrandbits(20) << 8 for _ in range(3000)} | {(1 << 64) - 1 - x for x in range(50)}
    values = sorted(crowd)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    entries = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
    want = classes(values, lambda a, b: (a ^ b).bit_count() <= 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        for longest in (simhash.LIST, 100):
            tree = {r["node"]: r["root"] for r in roots(simhash.links(entries, longest=longest)).collect()}
            got = [tree.get(v, v) for v in signed]
            assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want)), longest
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_dense_groups_give_no_pairs(spark):
    base = 0x0123456789ABCDEF
    near = sorted({base ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40)})
    entries = spark.createDataFrame([(v,) for v in near], "fp long")
    found = simhash.links(entries)
    assert found.count() < 8 * len(near)
    assert len({r["root"] for r in roots(found).collect()}) == 1


def test_roots_of_a_long_chain_and_of_nothing(spark):
    chain = spark.range(300).selectExpr("id as a", "id + 1 as b")
    assert {r["root"] for r in roots(chain).collect()} == {0}
    assert roots(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


def test_one_of_each(spark, odd_documents, no_documents):
    kept = simhash.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    # copies of 1 go; 3, 4, 5 and the empty one without an id have fingerprint zero; texts without ids stay apart
    assert sorted(i for i, _ in texts if i is not None) == [1, 3, 6, 7, 8, 9, 10]
    assert sum(i is None for i, _ in texts) == 2
    assert simhash.one_of_each(no_documents).count() == 0 and simhash.report(no_documents).count() == 0


def test_odd_rows(spark, odd_documents):
    rows = simhash.report(odd_documents).collect()
    assert len(rows) == 14
    by = {r["doc_id"]: r for r in rows}
    assert by[4]["fingerprint"] == "0" * 16 and by[4]["component_id"] == by[5]["component_id"] == 3
    assert by[2]["component_id"] == 1 and by[7]["fingerprint"] == f"{by_hand('one'):016x}"


def test_chunks_of_a_long_text_add_up(monkeypatch):
    text = " ".join(f"w{i % 50}" for i in range(1000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text.encode()) == whole == by_hand(text)


def test_one_id_with_several_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in ("apple", "bear", "cloud"))
    rows = [(3, b.upper(), "s"), (7, a, "s"), (7, b, "s"), (7, c, "t"), (7, c, "u"), (None, c.title(), "v")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, source string").repartition(3)
        kept = sorted(tuple(r) for r in simhash.one_of_each(docs).collect())
        assert [r[:2] for r in kept] == [(3, b.upper()), (7, a), (7, c)]
        assert len({r for r in kept}) == 3
    again = [sorted(map(tuple, simhash.one_of_each(spark.createDataFrame(x, docs.schema)).collect())) for x in (rows, rows[::-1])]
    assert again[0] == again[1]
    # two texts of one fingerprint and one id: one stays
    assert simhash.one_of_each(spark.createDataFrame([(7, a, "s"), (7, a.upper(), "s")], docs.schema)).count() == 1
