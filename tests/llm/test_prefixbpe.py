import base64
import hashlib
from array import array

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from wattloom.llm import prefixbpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
with open(PATH, "rb") as file:
    RANKS = prefixbpe.read_ranks(file.read())
BRUTE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODER = prefixbpe.TextCoder(RANKS, PATTERN)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


TEXTS = st.one_of(
    st.text(max_size=60),
    st.text(alphabet="ab '\n.sSdré1 \t", max_size=80),
    st.text(alphabet="a ", max_size=80),
    st.lists(st.sampled_from(["the", " ", "  ", "\n", "ing", "'ll", "ation", "-", "--", "123", "é", "\U0001f600", "\x1c", "\xa0"]), max_size=40).map("".join),
)


@settings(max_examples=1500, deadline=None)
@given(TEXTS)
def test_as_the_library_encodes(text):
    packed = CODER.encode([text])[0]
    assert ids(packed) == BRUTE.encode_ordinary(text)
    assert CODER.decode(packed) == text.encode()
    assert CODER.ids(text.encode(), CODER.table(text)) == BRUTE.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=8))
def test_many_texts_at_once(texts):
    assert [ids(p) for p in CODER.encode(texts)] == [BRUTE.encode_ordinary(t) for t in texts]


@settings(max_examples=1500, deadline=None)
@given(st.binary(max_size=60) | st.text(alphabet="aeinrst", max_size=60).map(str.encode))
def test_every_prefix_ends_on_the_last_token_of_its_encoding(piece):
    last = CODER.coder.table(piece)
    for end in range(1, len(piece) + 1):
        assert CODER.coder.read(last[:end], piece[:end]) == BRUTE._encode_single_piece(piece[:end])


def test_appending_changes_nothing_before():
    piece = b"internationalisationalistically" * 3
    last = array("I")
    for end in range(1, len(piece) + 1):
        before = last[:]
        CODER.coder.extend(piece[:end], last)
        assert last[:-1] == before


@settings(max_examples=800, deadline=None)
@given(TEXTS, st.integers(0, 80), st.integers(0, 20), TEXTS)
def test_edits(text, at, removed, inserted):
    at = min(at, len(text))
    new, last, done = CODER.edit(text, CODER.table(text), at, removed, inserted)
    assert new == text[:at] + inserted + text[at + removed :]
    assert last.tolist() == CODER.table(new).tolist() and 0 <= done <= len(new.encode())


def test_an_edit_redoes_little():
    text = " ".join(f"word{i}" for i in range(50_000))
    _, last, done = CODER.edit(text, CODER.table(text), 200_000, 3, "new")
    assert done < 50 and len(last) == len(text)


def test_tokens_that_no_merges_reach():
    # "abc" has a rank, but neither "ab" nor "bc" has one: only the whole piece is this token
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 300, b"xy": 301, b"xyx": 302, b"yx": 303}
    own = tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = prefixbpe.TextCoder(ranks, PATTERN)
    for text in ("abc", "abcabc", " abc", "xyx", "xyxyx", "yxyx", "xxyyx abc"):
        assert ids(coder.encode([text])[0]) == own.encode_ordinary(text)


@pytest.mark.parametrize("text", ["x" * 200_000, " " * 50_000, "ab" * 30_000 + "\n\n  end", "1234567890" * 5000])
def test_long_texts(text):
    assert ids(CODER.encode([text])[0]) == BRUTE.encode_ordinary(text)


def expected(rows):
    out = []
    for doc_id, text in rows:
        found = BRUTE.encode_ordinary(text or "")
        packed = np.array(found, "<u4").tobytes()
        out.append((doc_id, len(found), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted(map(tuple, prefixbpe.digest(docs, PATH, PATTERN).collect()), key=repr)
    assert got == expected((r["doc_id"], r["text"]) for r in docs.collect())


def test_odd_rows(spark, odd_documents, no_documents):
    got = sorted(map(tuple, prefixbpe.digest(odd_documents, PATH, PATTERN).collect()), key=repr)
    assert got == expected((r["doc_id"], r["text"]) for r in odd_documents.collect())
    for empty in (prefixbpe.digest(no_documents, PATH, PATTERN), prefixbpe.tables(no_documents, PATH, PATTERN)):
        assert empty.count() == 0
    back = prefixbpe.decoded(prefixbpe.encoded(odd_documents, PATH, PATTERN), PATH, PATTERN)
    texts = sorted((r["text"] or "").encode() for r in odd_documents.collect())
    assert sorted(bytes(r["raw"]) for r in back.collect()) == texts


def test_stored_tables_and_edits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tables = prefixbpe.tables(docs, PATH, PATTERN)
    edits = spark.createDataFrame([(1, 5, 2, "new é"), (2, 0, 0, None), (3, 10_000_000, 1, " end")], "doc_id long, at long, removed long, inserted string")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = prefixbpe.edited(tables, edits, PATH, PATTERN).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, 3}
    for r in rows:
        assert ids(r["ids"]) == BRUTE.encode_ordinary(r["text"])
    assert next(r for r in rows if r["doc_id"] == 2)["text"] == texts[2]
    assert next(r for r in rows if r["doc_id"] == 3)["text"] == texts[3] + " end"


def test_rank_files():
    raw = b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in list(RANKS.items())[:300])
    assert prefixbpe.read_ranks(raw + b"\n") == dict(list(RANKS.items())[:300])
