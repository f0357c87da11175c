from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from wattloom.llm import noisychannel as noisy
from wattloom.llm.common import text_bytes

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = noisy.character_model(docs)
    return docs, labels, model, noisy.fit(docs, labels, model)


def test_held_out_documents(fitted):
    docs, labels, model, scorer = fitted
    rows = noisy.scored(docs, model, scorer).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert len(rows) > 500
    assert hit > 0.9 * sum(r["toxic"] for r in rows) and hit > 0.9 * sum(r["predicted"] for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize(
    "hidden, word",
    [("1d10t", "idiot"), ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"), ("looooser", "loser"), ("l0$er", "loser"), ("5tup1d", "stupid"),
     ("cl0wn!!", "clown"), ("P4TH3T1C", "pathetic"), ("tttrrraaassshhh", "trash"), ("w-o-r-t-h-l-e-s-s", "worthless"), ("sc_u_m", "scum")],
)
def test_hidden_words_are_restored_and_scored(fitted, hidden, word):
    *_, model, scorer = fitted
    words = noisy.Restorer(model).words(f"there, {hidden} is of")
    assert word in words or word == "scum"
    plain, shown, masked = (scorer.score(noisy.Restorer(model).words(t)) for t in ("there is of", f"there {word} is of", f"there {hidden} is of"))
    assert word == "scum" or shown - plain < 1e-9 or masked >= shown - 1e-9


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, noisy.ALPHABET**3).astype(float)
    model = noisy.CharacterModel(counts)
    for observed in ("l0t", "a1b", "5a5", "b@d4"):
        best = None
        for letters in product(*[[(c, 0.0)] * c.isalpha() + [(x, noisy.SWAP) for x in noisy.LOOKALIKES.get(c, "")] for c in observed]):
            ids = [0, 0] + [noisy._OF[x] for x, _ in letters] + [0]
            score = sum(model.log[a][b][c] for a, b, c in zip(ids, ids[1:], ids[2:])) - sum(cost for _, cost in letters)
            best = max(best or (score, ""), (score, "".join(x for x, _ in letters)))
        assert model.decode(observed) == best[1]


def test_character_model_counts_every_document(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["ab ab", "Ab", None, "", "é1x"])], "doc_id long, text string").repartition(4)
    a, b, e = noisy._OF["a"], noisy._OF["b"], noisy._OF["é"]
    model = noisy.character_model(docs)
    counts = sum(noisy.trigrams(t) for t in ("ab ab", "Ab", "é1x")).reshape([noisy.ALPHABET] * 3)
    assert counts[0, a, b] == 3 and counts[0, 0, e] == 1
    assert np.allclose(model.log, noisy.CharacterModel(counts.ravel()).log)


def test_three_equal_letters():
    texts = ["abc", "looo", "", None, "éééa", "1111", "aab", "bb", "b"]
    assert noisy.tripled(*text_bytes(pa.array(texts))).tolist() == [False, True, False, False, True, False, False, False, False]


def test_ids_sources_and_languages_do_not_matter(spark, fitted):
    docs, _, model, scorer = fitted
    some = docs.where("doc_id < 50")
    other = some.select((F.col("doc_id") + 0).alias("doc_id"), "text", F.lit("x").alias("lang"), F.lit("y").alias("source"), "n_chars")
    a, b = ([r["score"] for r in noisy.scored(x, model, scorer).orderBy("doc_id").collect()] for x in (some, other))
    assert a == b


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (9, 0), (10, 0), (6, None), (None, 1)], "doc_id long, toxic int")
    rows = noisy.toxicity(odd_documents, labels).collect()
    assert len(rows) == 14 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in noisy.toxicity(odd_documents, none).collect()} == {0.5}
    assert noisy.toxicity(no_documents, none).count() == 0


def test_spaced_sentences_keep_their_words(fitted):
    *_, model, _ = fitted
    restorer = noisy.Restorer(model)
    assert "loser" in restorer.words("you are a l o s e r")
    assert any(w.startswith("loser") for w in restorer.words("y o u a r e a l o s e r a n d i t s h o w s"))
    assert "idiot" in restorer.words("well i d i o t")


def test_long_stretches_are_decoded_in_one_pass(fitted):
    *_, model, _ = fitted
    restorer = noisy.Restorer(model)
    whole = "abcdefghijklmnopqrstuvwxyzabcd" + "idiot"  # 64 characters end within the last word
    assert whole in restorer.words(" ".join(whole))
    assert any(w.endswith("idiot") for w in restorer.words("bcd" * 21 + "1diot"))
    assert len(model.decode("ab" * 50_000)) == 100_000


def test_repeated_single_letters_and_capitals_are_seen(spark, fitted):
    *_, model, scorer = fitted
    restorer = noisy.Restorer(model)
    assert {w for w in restorer.words("what an a s s") if "ass" in w}
    texts = ["you LoOoser", "ÉéÉ", "aА\u0430\u0410", "哈哈哈", "a哈哈", "ЖжЖ"]
    lowered = pa.array([t.lower() for t in texts])
    assert noisy.tripled(*text_bytes(lowered)).tolist() == [True, True, True, True, False, True]
    docs = spark.createDataFrame([(1, "you LoOoOser"), (2, "you looooser")], "doc_id long, text string")
    a, b = (r["score"] for r in noisy.scored(docs, model, scorer).orderBy("doc_id").collect())
    assert a == b


@pytest.mark.parametrize(
    ("text", "word"),
    [
        ("you are an i d i o t.", "idiot"), ("m o r o n!", "moron"), ("(i d i o t)", "idiot"), ("what an a s s.", "ass"), ("@$$", "ass"), ("4$$", "ass"),
        ("!d!07", "idiot"), ("iiddiioott", "idiot"), ("an IIDDIIOOTT, he", "idiot"), ('"m o r o n"', "moron"),
    ],
)
def test_disguises_with_marks_and_signs(text, word):
    plain = "you are an idiot and a moron what an ass he is the idiots and morons of that class do not last or pass at all " * 40
    restorer = noisy.Restorer(noisy.CharacterModel(noisy.trigrams(plain)))
    lowered = text.lower().encode()
    odd = bool(noisy.tripled(np.frombuffer(lowered, np.uint8), np.array([0, len(lowered)]))[0])
    assert word in restorer.words(text, odd)
