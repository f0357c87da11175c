import re
from collections import Counter

import numpy as np
import pytest
from checks import runner
from hypothesis import given, settings
from hypothesis import strategies as st
from wattloom.llm import collocations, queries

LOWER = {c: c + 32 for c in range(65, 91)}


def by_hand(rows, limit=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= 10}
    dropped = set()
    for (lang, p), a in candidates.items():
        for part in (p[:2], p[1:]) if len(p) == 3 else ():
            if 100 * a >= 50 * candidates[lang, part]:
                dropped.add((lang, part))
    out = []
    for (lang, p), a in candidates.items():
        if (lang, p) in dropped:
            continue
        cuts = [(10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], totals[lang], score))
    ranked, rank = [], Counter()
    for lang, *_, phrase, a, left, right, n, score in sorted(out):
        rank[lang] += 1
        if rank[lang] <= limit:
            ranked.append((lang, rank[lang], phrase, a, left, right, n, score))
    return sorted(ranked)


def got(docs):
    return sorted(tuple(r) for r in collocations.best(docs).collect())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 3), st.integers(1, 9)), max_size=80), st.integers(0, 12))
def test_multikey(rows, least):
    end = 3
    rows = [(a, b, end if b == end else c, w) for a, b, c, w in rows]
    keys, weights = np.ascontiguousarray(np.array([r[:3] for r in rows], np.int64).reshape(-1, 3).T), np.array([r[3] for r in rows], np.int64)
    found = {}
    for depth, at, weight, _ in collocations.multikey(keys, weights, end, [least] * 3):
        for d, p, w in zip(depth, at, weight, strict=True):
            key = tuple(keys[: d + 1, p].tolist())
            assert key not in found
            found[key] = int(w)
    wanted = Counter()
    for *key, w in rows:
        for d in range(3):
            wanted[tuple(key[: d + 1])] += w
            if key[d] == end:
                break
    assert found == {k: w for k, w in wanted.items() if w >= least}


@pytest.fixture
def small(spark):
    rng = np.random.default_rng(5)
    words = ["the", "The", "of", "new", "york", "city", "état", "a", "b", "x\x00y", "-"]
    rows = [("en" if i % 3 else None, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(60))) for i in range(150)]
    rows += [("hot", "new york city " * 40)] * 50 + [("hot", f"the same {i} the same {i + 1}") for i in range(200)] + [("few", "one two three. " * 9), ("t", "one two " * 11)]
    return spark.createDataFrame(rows, "lang string, text string").repartition(5)


def test_against_counting(small):
    want = by_hand([tuple(r) for r in small.collect()])
    assert got(small) == want and len(want) > 100


@pytest.mark.parametrize(("words", "heavy"), [(7, 4), (64, 100_000), (1 << 20, 1)])
def test_blocks_and_heavy_words(small, monkeypatch, words, heavy):
    monkeypatch.setattr(collocations, "WORDS", words)
    monkeypatch.setattr(collocations, "HEAVY", heavy)
    assert got(small) == by_hand([tuple(r) for r in small.collect()])


def test_odd_rows(spark, odd_documents, no_documents):
    assert got(odd_documents) == by_hand([(r["lang"], r["text"]) for r in odd_documents.collect()])
    assert got(no_documents) == []
    assert got(spark.createDataFrame([(None, None), ("en", ""), ("en", " .,; \n")], "lang string, text string")) == []


def test_limit(small):
    rows = sorted(tuple(r) for r in collocations.best(small, 3).collect())
    assert rows == by_hand([tuple(r) for r in small.collect()], 3)


def test_sql(spark, duck):
    same, message = runner.compare(queries.op12_phrases(spark, "/root/testdata/sf0.01"), duck, collocations.ORACLE)
    assert same, message
