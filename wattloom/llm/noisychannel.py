"""Toxicity scores on text restored by a noisy-channel decoder.

Writers hide words by look-alike characters, by spacing letters out and by repeating them. Such a stretch becomes a lattice: every
observed character may stand for a few letters (or for nothing, between spaced letters; a space also for a word's edge; a repeated letter may stand for one or two), each at a
channel cost. A Viterbi pass over the lattice finds the letters that are likeliest under a character trigram model of the corpus and the
channel. Words without such signs have a lattice of one path and stay as they are.

The character model is counted over all documents. The score is a logistic regression on the words of the restored
text and their beginnings, fitted on at most ``SAMPLE`` labelled documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import held_out, labelled_sample, pieces, stored, text_bytes

SAMPLE = 8000
THRESHOLD = 0.3
# Features of that many sampled documents at least, and at most so many features.
LEAST, MOST = 3, 3000
LASSO = 2e-4
# Documents that a feature's share of positives is shrunk by; features count as proof above so many times the share of all.
SHRINK, PROOF, PROOFS = 2.0, 3.0, 20_000
# Letters of the character model: a-z, Latin-1 letters, one sign for any other letter, one for a word's edge.
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100)))
EDGE, OTHER = 0, len(_LETTERS) + 1
ALPHABET = OTHER + 1
_OF = {c: i + 1 for i, c in enumerate(_LETTERS)}
_CODE = np.zeros(0x110000, np.uint8)

# What a character may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "aeiou",
}
SPACERS = ".-_*~'`·"
# Costs of channel steps, in nats.
SWAP, DROP, REPEAT = 1.0, 0.2, 0.2
# Costs of a word's edge at a space between spaced letters. Trigrams alone cannot tell such edges surely, so all these readings count.
BORDERS = (0.2, 1.0, 2.0, float("inf"))

_LOOK = "".join(re.escape(c) for c in LOOKALIKES)
_WORD = re.compile(r"[^\W\d_]+")
# Signs of hiding: a look-alike next to a letter, three equal letters, single letters with one spacer between, look-alikes
# alone with a sign among them that stands for a letter only, every letter twice.
_HIDDEN = re.compile(
    rf"[^\W\d_][{_LOOK}]|[{_LOOK}][^\W\d_]|([^\W\d_])\1\1|(?<![^\W_])[^\W_](?:[{re.escape(SPACERS)}][^\W_]){{2,}}(?![^\W_])"
    rf"|^(?=.*[@$€£])[{_LOOK}]{{3,}}$|^(?:([^\W\d_])\2){{3,}}$"
)
# Marks may stand before the first and behind the last of spaced letters.
_OPENS, _CLOSES = "([\"'«", ".,;:!?)\"'»…]"
_SPACED = re.compile(
    rf"(?<!\S)[{re.escape(_OPENS)}]*[^\W_{_LOOK}](?: [^\s]){{2,}}[{re.escape(_CLOSES)}]*(?!\S)"
    rf"|(?<!\S)[{re.escape(_OPENS)}]*[^\s](?: [^\s]){{2,}}[{re.escape(_CLOSES)}]*(?!\S)"
)
_TAIL = re.compile(r"^(?:(?!!\w)[^\w@$+(|€£])+|(?:([^\w\s])\1{2,}|[.,;:!?)\"'»…*#&%])+$")


def _codes(text: str) -> np.ndarray:
    if not _CODE.any():
        for c in range(0x110000):
            if c < 0x250 and chr(c) in _OF:
                _CODE[c] = _OF[chr(c)]
        _CODE[0x100:0x3000] = OTHER
    return _CODE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def trigrams(text: str) -> np.ndarray:
    """Counts of character trigrams of the text's words, edges included, as a flat cube."""
    codes = _codes(f"  {text.lower()}  ").astype(np.int32)
    keys = codes[:-2] * (ALPHABET * ALPHABET)
    keys += codes[1:-1] * ALPHABET
    keys += codes[2:]
    counts = np.bincount(keys, minlength=ALPHABET**3)
    counts[0] = 0
    return counts


class CharacterModel:
    """Log probabilities of a letter after two others, interpolated with shorter histories."""

    def __init__(self, counts: np.ndarray):
        c3 = counts.reshape(ALPHABET, ALPHABET, ALPHABET).astype(np.float64)
        c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
        p1 = (c1 + 1) / (c1.sum() + ALPHABET)
        p2 = (c2 + 5 * p1) / (c2.sum(axis=1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2) / (c3.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(p3).tolist()

    def decode(self, observed: str, border: float = float("inf")) -> str:
        """The likeliest letters behind ``observed`` (lower case): Viterbi over the last two letters.

        A space may be nothing or, at the cost ``border``, a word's edge, which stays a space. There are at most as many states as pairs of letters, and
        their texts are chains that share what they have in common, so a stretch of any length is decoded in one pass.
        """
        log = self.log
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
        for k, c in enumerate(observed):
            options = [(c, 0.0)] if c in _OF or c.isalpha() else []
            options += [(x, SWAP) for x in LOOKALIKES.get(c, "")]
            inner = 0 < k < len(observed) - 1
            drop = DROP if not options or (inner and (c in SPACERS or c == " ")) else None
            again = k > 0 and c == observed[k - 1]
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, text) in states.items():
                steps = []
                if drop is not None:
                    steps.append((a, b, score - drop, text))
                if c == " " and inner and text and border < float("inf"):
                    steps.append((b, EDGE, score - border + log[a][b][EDGE], (text, " ")))
                if again and text and (text[1] == c or text[1] in LOOKALIKES.get(c, "")):
                    steps.append((a, b, score - REPEAT, text))
                for x, cost in options:
                    n = _OF.get(x, OTHER)
                    steps.append((b, n, score - cost + log[a][b][n], (text, x)))
                for a2, b2, s, t in steps:
                    if (a2, b2) not in after or s > after[a2, b2][0]:
                        after[a2, b2] = (s, t)
            states = after
        ends = [(score + log[a][b][EDGE], text) for (a, b), (score, text) in states.items()]
        best = max(score for score, _ in ends)
        return max(_spelled(text) for score, text in ends if score == best)


def _spelled(text: tuple | None) -> str:
    """The letters of a chain (letters before, letter)."""
    out = []
    while text:
        text, x = text
        out.append(x)
    return "".join(reversed(out))


def tripled(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which lower-cased texts hold a letter three times in a row, or three of a-z twice each: found on the bytes of all of them, at any number of bytes a letter."""
    out = np.zeros(len(starts) - 1, bool)
    if len(data) > 5:
        twice = (data[1:] == data[:-1]) & (data[1:] >= 0x61) & (data[1:] <= 0x7A)
        found = np.flatnonzero(twice[:-4] & twice[2:-2] & twice[4:])
        row = np.searchsorted(starts, found, "right") - 1
        out[row[found + 6 <= starts[row + 1]]] = True
    for width, low, high in ((1, 0x61, 0x7A), (2, 0xC3, 0xDF), (3, 0xE0, 0xEF), (4, 0xF0, 0xF4)):
        n = len(data) - 3 * width + 1
        if n <= 0:
            break
        same = (data[:n] == data[width : n + width]) & (data[:n] == data[2 * width : n + 2 * width])
        found = np.flatnonzero(same & (data[:n] >= low) & (data[:n] <= high))
        for k in range(1, width):
            found = found[(data[found + k] == data[found + k + width]) & (data[found + k] == data[found + k + 2 * width])]
        row = np.searchsorted(starts, found, "right") - 1
        out[row[found + 3 * width <= starts[row + 1]]] = True  # not from one text into the next
    return out


class Restorer:
    """Restored words of texts; what stands behind a token is remembered."""

    def __init__(self, model: CharacterModel, remembered: int = 200_000):
        self.model, self.remembered = model, remembered
        self.known: dict[str, tuple[str, ...]] = {}

    def _behind(self, token: str) -> tuple[str, ...]:
        if token not in self.known:
            if len(self.known) >= self.remembered:
                self.known.clear()
            core = _TAIL.sub("", token)
            out = [core] if core.isalpha() else _WORD.findall(token)
            if core and _HIDDEN.search(core):
                out += self.model.decode(core).split()
            self.known[token] = tuple(w for w in out if w)
        return self.known[token]

    def words(self, text: str, tripled: bool = True) -> set[str]:
        """The distinct words of the restored text, and those of the observed one.

        ``tripled`` tells whether a letter may stand three times in a row; else plain words are not looked through.
        """
        text = text.lower()
        tokens = text.split()
        found = set(tokens)
        out = {t for t in found if t.isalpha()}
        odd = found - out
        if tripled:
            for t in [t for t in out if _HIDDEN.search(t)]:
                out.update(self._behind(t))
        for t in odd:
            if t[-1] in ".,;:!?" and t[:-1].isalpha() and not tripled:
                out.add(t[:-1])
            else:
                out.update(self._behind(t))
        # spaced-out letters reach over tokens
        if b"\1\1" in bytes(map((1).__eq__, map(len, tokens))):
            for m in _SPACED.finditer(" ".join(tokens)):
                letters = m.group().lstrip(_OPENS)
                # marks right behind the last letter; a mark of its own may stand for a letter
                core = letters.rstrip(_CLOSES)
                letters = letters if core.endswith(" ") else core
                for border in BORDERS if len(letters) > 4 else ():
                    out.update(self.model.decode(letters, border).split())
        out.discard("")
        return out


PREFIXES = (3, 4, 5)


def features(word: str) -> tuple[str, ...]:
    """A word and its beginnings, which endings leave unchanged."""
    return (word, *(f"{word[:n]}~" for n in PREFIXES if len(word) > n))


class Lookup:
    """Values of features, found for words without building the features of each."""

    def __init__(self, values: dict[str, float]):
        self.values = values
        self.starts = {n: {f[:-1]: v for f, v in values.items() if f[-1] == "~" and len(f) == n + 1} for n in PREFIXES}

    def features(self, words: set[str]) -> set[str]:
        """The known features that the words have."""
        found = words & self.values.keys()
        for n, known in self.starts.items():
            if known:
                found.update(f"{w[:n]}~" for w in words if w[:n] in known and len(w) > n)
        return found

    def strongest(self, words: set[str], most: int = 3) -> list[float]:
        """The greatest values of different words, each word by its best feature; zeros where there are fewer."""
        best = {w: self.values[w] for w in words & self.values.keys()}
        for n, known in self.starts.items():
            if known:
                for w in words:
                    v = known.get(w[:n])
                    if v is not None and len(w) > n and v > best.get(w, 0.0):
                        best[w] = v
        return (sorted(best.values(), reverse=True) + [0.0] * most)[:most]


def _logistic(x) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def evidence(n, p, share: float):
    """Log odds that a document with the feature is positive, over those of any document; few documents prove little."""
    rate = np.clip((p + SHRINK * share) / (n + SHRINK), 1e-4, 1 - 1e-4)
    return np.log(rate / (1 - rate)) - np.log(share / (1 - share))


class Scorer:
    """The mean of two views of a text's words and beginnings.

    One is a sparse logistic regression on their presence, which weighs many weak signs. The other is a logistic regression on
    the strongest evidence of three words, which one unmistakable word can decide.
    """

    def __init__(self, bias: float = 0.0, weights: dict[str, float] | None = None, strong: dict[str, float] | None = None, trust=None):
        self.bias, self.weights = bias, Lookup(weights or {})
        self.strong = Lookup(strong or {})
        self.trust = np.array([0.0, 0.0, 0.0, bias] if trust is None else trust)

    def score(self, words: set[str]) -> float:
        total = self.bias + sum(self.weights.values[f] for f in sorted(self.weights.features(words)))
        proof = float(np.dot(self.trust, (*self.strong.strongest(words), 1.0)))
        return float((_logistic(total) + _logistic(proof)) / 2)


def fit_presence(rows: np.ndarray, cols: np.ndarray, labels: np.ndarray, features: int, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Weights and bias from the pairs (document, feature) that hold, by proximal steps with a lasso."""
    n, positive = len(labels), float(labels.sum())
    w, b, momentum, mb = np.zeros(features), float(np.log(positive / (n - positive))), 0.0, 0.0
    rate = 0.5 / np.sqrt(np.maximum(np.bincount(cols, minlength=features), 1) / n)  # rare features move as readily
    for _ in range(rounds):
        d = _logistic(np.bincount(rows, w[cols], n) + b) - labels
        momentum = 0.9 * momentum + np.bincount(cols, d[rows], features) / n
        mb = 0.9 * mb + d.mean()
        w -= 0.1 * rate * momentum
        w = np.sign(w) * np.maximum(np.abs(w) - 0.1 * rate * LASSO, 0)
        b -= 0.1 * mb
    return w, b


def fit_trust(proofs: np.ndarray, labels: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression on a few columns and a bias, by Newton steps."""
    x = np.column_stack((proofs, np.ones(len(proofs))))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        y = _logistic(x @ w)
        w -= np.linalg.solve((x * (y * (1 - y))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (y - labels) + 1e-2 * w)
    return w


def character_model(docs: DataFrame) -> CharacterModel:
    """Counted over every document; at most ALPHABET**3 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALPHABET**3, np.int64)
        for batch in pieces(batches, size=2_000_000):
            total += trigrams(" ".join(t or "" for t in batch.column(0).to_pylist()))
        keys = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total[keys])], ["key", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = np.zeros(ALPHABET**3)
    found = counted.toPandas()
    counts[found["key"].to_numpy()] = found["n"].to_numpy()
    return CharacterModel(counts)


def fit(docs: DataFrame, labels: DataFrame, model: CharacterModel, sample: int = SAMPLE, label: str = "toxic") -> Scorer:
    """A scorer from the restored words of at most ``sample`` labelled documents; held-out labels are never read."""
    chosen = labelled_sample(docs, labels, label, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in pieces(batches):
            found = [sorted({f for w in restorer.words(t or "") for f in features(w)}) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("label").cast(pa.int32()), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "bag"])

    seen = stored(chosen.mapInArrow(bags, "doc_id long, label int, bag array<string>"), "bags")
    n, positive = seen.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < positive < n:
        return Scorer(float(np.log((positive + 1) / (n - positive + 1))))
    share = positive / n
    counted = seen.select("label", F.explode("bag").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum("label").alias("p"))
    counted = stored(counted.where("n > 1"), "feature-counts")
    expected = F.col("n") * F.lit(share)
    telling = counted.where(F.col("n") >= LEAST).orderBy(((F.col("p") - expected) ** 2 / expected).desc(), "f").limit(MOST)
    names = [r["f"] for r in telling.select("f").collect()]
    index = {f: i for i, f in enumerate(names)}
    rate = (F.col("p") + SHRINK * share) / (F.col("n") + SHRINK)
    proving = counted.where(rate > F.lit(PROOF * share)).orderBy(rate.desc(), "f").limit(PROOFS).collect()
    strong = {r["f"]: float(evidence(r["n"], r["p"], share)) for r in proving}
    # what a document's own label adds to a count proves nothing about it
    without = [Lookup({r["f"]: float(evidence(r["n"] - 1, r["p"] - y, share)) for r in proving if r["n"] > 2}) for y in (0, 1)]

    def chosen_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, bags = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            found = [[index[f] for f in bag if f in index] for bag in bags]
            proofs = [without[y].strongest({f for f in bag if f[-1] != "~"}) for y, bag in zip(labels, bags, strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32())), pa.array(proofs, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "found", "proofs"])

    rows = seen.mapInArrow(chosen_features, "doc_id long, label int, found array<int>, proofs array<double>").orderBy("doc_id", "label").collect()
    sizes = [len(r["found"]) for r in rows]
    cols = np.array([k for r in rows for k in r["found"]], np.int64)
    known = np.array([r["label"] for r in rows], float)
    w, b = fit_presence(np.repeat(np.arange(len(rows)), sizes), cols, known, len(names))
    trust = fit_trust(np.array([r["proofs"] for r in rows]), known)
    return Scorer(b, {f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 1e-3}, strong, trust)


def scored(docs: DataFrame, model: CharacterModel, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; the score depends on the whole text alone, null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model, scorer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, scorer = shared.value
        restorer = Restorer(known)
        for batch in pieces(batches):
            flags = tripled(*text_bytes(pc.utf8_lower(batch.column(2))))
            texts = batch.column(2).to_pylist()
            score = np.array([scorer.score(restorer.words(t or "", f)) for t, f in zip(texts, flags, strict=True)])
            columns = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Count the character model, fit the scorer, score every document."""
    model = character_model(docs)
    return scored(docs, model, fit(docs, labels, model))
