import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from wattloom.llm import tokenfile
from wattloom.session import work_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 20), max_size=300))
def test_elias_fano_round_trip(numbers):
    numbers = sorted(numbers)
    ef = tokenfile.EliasFano.encode(np.array(numbers, np.int64))
    assert ef.values().tolist() == numbers == [ef.select(i) for i in range(len(numbers))]


def test_elias_fano_is_near_minimal():
    numbers = np.sort(np.random.default_rng(0).integers(0, 1 << 24, 10_000))
    bits = 8 * tokenfile.EliasFano.encode(numbers).size() / len(numbers)
    assert bits < 2 + np.log2((1 << 24) / 10_000) + 0.6 + 1  # 64 in a plain table
    with pytest.raises(IndexError):
        tokenfile.EliasFano.encode(numbers).select(10_000)


def by_hand(docs):
    tokenizer = Tokenizer.from_file(PATH)
    rows, at = [], 0
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        rows.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return rows


def test_whole_table_and_single_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = work_path(spark, "ids")
    tokenfile.write(docs.repartition(7), path, PATH, segment=5000)
    got = sorted(map(tuple, tokenfile.read(spark, path).collect()))
    assert got == by_hand(sorted((r["doc_id"], r["text"]) for r in docs.collect()))
    some = tokenfile.ids_of(spark, path, [3, 150])
    tokenizer = Tokenizer.from_file(PATH)
    for i, ids in some.items():
        assert ids == tokenizer.encode(docs.where(f"doc_id = {i}").first()["text"], add_special_tokens=False).ids + [2]
    assert set(some) == {3, 150}


def test_words_are_encoded_as_in_their_text():
    texts = ["it's  John's\tbook\n\nend", "á é x y ́z", "ΟΔΟΣ ΣΑΣ.", "x\x1cy\x85z", "<|endoftext|> <|startoftext|>a", "12 34five", "日本語 テキスト", "\U0001f600\U0001f600 ok", "", "   "]
    tokenizer, encoder = Tokenizer.from_file(PATH), tokenfile.WordEncoder(open(PATH, encoding="utf-8").read(), remembered=5)
    for _ in range(2):
        got = [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(texts)]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_rows(spark, odd_documents, no_documents):
    rows = tokenfile.round_trip(odd_documents, PATH).collect()
    assert len(rows) == 14
    order = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order][:3] == [None] * 3 and [r["doc_id"] for r in order][3:] == sorted(r["doc_id"] for r in rows if r["doc_id"] is not None)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(order, order[1:], strict=False)) and order[0]["start"] == 0
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 5)} == {1}
    assert tokenfile.round_trip(no_documents, PATH).count() == 0
