import hashlib
import zlib

import pytest
from checks import runner
from wattloom.llm import merkle, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def by_hand(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the report, recursively."""
    lower = {c: c + 32 for c in range(65, 91)}

    def leaf(r, text):
        return sha("".join(map(field, (*r[:4], text))))

    def key(source):
        return (source is not None, (source or "").encode())

    def fold(hashes, at, own):
        """Levels up from a list of nodes: (last hash, text of siblings, hash with own in place)."""
        siblings = ""
        while len(hashes) > 1:
            run = hashes[at // 16 * 16 : at // 16 * 16 + 16]
            siblings += "".join(run[: at % 16] + run[at % 16 + 1 :])
            own = sha("".join(run[: at % 16] + [own] + run[at % 16 + 1 :]))
            hashes, at = [sha("".join(hashes[i : i + 16])) for i in range(0, len(hashes), 16)], at // 16
        return hashes[0], siblings, own

    sources = sorted({r[1] for r in rows}, key=key)
    groups = [sorted(((r[0] is not None, r[0] or 0, leaf(r, r[4]), r) for r in rows if r[1] == s), key=lambda x: x[:3]) for s in sources]
    subroots = [fold([g[2] for g in group], 0, "")[0] for group in groups]
    out = []
    for tree, group in enumerate(groups):
        for at, (_, _, h, r) in enumerate(group):
            chosen = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            own = leaf(r, None if r[4] is None else r[4].translate(lower)) if chosen else h
            _, below, own = fold([g[2] for g in group], at, own)
            root, above, own = fold(subroots, tree, own)
            out.append((r[0], h, subroots[tree], root, sha(below + above), own, own == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def got(docs):
    return sorted(map(tuple, merkle.report(docs).collect()), key=repr)


def test_odd_rows(spark, odd_documents, no_documents):
    assert got(odd_documents) == by_hand([tuple(r[c] for c in COLUMNS) for r in odd_documents.collect()])
    assert merkle.report(no_documents).count() == 0
    one = odd_documents.where("doc_id = 7")
    (row,) = merkle.report(one).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")


@pytest.mark.parametrize(("n", "sources"), [(16, 1), (17, 1), (273, 1), (600, 40), (300, 300), (1200, 3)])
def test_shapes(spark, n, sources):
    rows = [(i * 7 % n, None if i % sources == 1 else f"s{i % sources}é", "en", None, f"Text {i}" * (i % 3)) for i in range(n)]
    assert got(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")) == by_hand(rows)


def test_blocks_split_the_upper_nodes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 64)
    rows = [(i, "ab"[i % 7 == 0], "en", 1, f"T{i}") for i in range(900)]
    assert got(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")) == by_hand(rows)


def test_hot_source_of_equal_rows(spark):
    rows = [(1, "hot", "en", 1, "Same")] * 700 + [(i, f"s{i % 5}", "en", 1, "x") for i in range(300)]
    assert got(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")) == by_hand(rows)


def test_sql(spark, duck):
    same, message = runner.compare(queries.op13_merkle_manifest(spark, "/root/testdata/sf0.01"), duck, merkle.ORACLE)
    assert same, message


def test_untampered_and_changed(spark):
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(100)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    docs = spark.createDataFrame(rows, schema)
    manifest = merkle.Manifest(docs)
    assert {r["verified"] for r in manifest.proofs(changed=False).collect()} == {True}
    later = spark.createDataFrame([(i, "s", "en", 1, f"T{i}" if i != 42 else "t42") for i in range(100)], schema)
    assert [r["doc_id"] for r in merkle.changed_documents(spark, manifest, later).collect()] == [42]
