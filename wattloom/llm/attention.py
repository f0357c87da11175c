"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded: how often each character class occurs in it,
how many of its words are distinct, repeat the one before, and how long they are; one learned layer turns this into a
vector. Gated attention gives each passage a weight, learned from the labels of whole documents, and the weighted sum of the
passage vectors is scored by a logistic unit.

Encoding and scoring run where the texts are, in one pass without a shuffle. The model is fitted on the driver from the encoded passages
of at most ``SAMPLE`` labelled documents and about ``PASSAGES`` passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattloom.llm.common import held_out, labelled_sample, pieces, stored

PASSAGE = 64
SAMPLE = 4000
PASSAGES = 100_000
THRESHOLD = 0.7
# ASCII characters each count for themselves, all other bytes together; then four word figures.
CLASSES = 129
FEATURES = CLASSES + 4
UNITS, GATES = 16, 8
ROUNDS, RATE, DECAY = 400, 0.02, 1e-3
# Words encoded at once.
CHUNK = PASSAGE * 4096

_CLASS = np.minimum(np.arange(256), CLASSES - 1).astype(np.int64)


def encode(text: bytes) -> np.ndarray:
    """Passages x features. The whole text is read; a text without words is one passage of zeros."""
    words = text.split()
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    return np.concatenate([_encode_words(words[a : a + CHUNK]) for a in range(0, len(words), CHUNK)])


def _encode_words(words: list[bytes]) -> np.ndarray:
    n, rows = len(words), -(-len(words) // PASSAGE)
    sizes = np.fromiter(map(len, words), np.int64, n)
    of = np.arange(n) // PASSAGE
    raw = np.frombuffer(b"".join(words), np.uint8)
    cells = np.repeat(of * CLASSES, sizes) + _CLASS[raw]
    counts = np.bincount(cells, minlength=rows * CLASSES).reshape(rows, CLASSES)
    hashes = np.fromiter(map(hash, words), np.int64, n)
    in_row = np.bincount(of, minlength=rows)
    repeats = np.zeros(n, bool)
    repeats[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    order = np.lexsort((hashes, of))
    sorted_hashes, sorted_of = hashes[order], of[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (sorted_hashes[1:] != sorted_hashes[:-1]) | (sorted_of[1:] != sorted_of[:-1])
    out = np.empty((rows, FEATURES), np.float32)
    total = counts.sum(axis=1, keepdims=True)
    out[:, :CLASSES] = np.sqrt(counts / np.maximum(total, 1))
    out[:, CLASSES] = np.bincount(sorted_of[fresh], minlength=rows) / in_row
    out[:, CLASSES + 1] = np.bincount(of[repeats], minlength=rows) / in_row
    out[:, CLASSES + 2] = np.log1p(total[:, 0] / in_row)
    out[:, CLASSES + 3] = np.log1p(in_row) / np.log1p(PASSAGE)
    return out


class Model:
    """Encoder layer, gated attention and logistic unit; ``bias`` alone where there is nothing to learn from."""

    def __init__(self, features: int = FEATURES, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(features), np.ones(features)
        self.p = {
            "E": rng.normal(0, 1 / np.sqrt(features), (features, UNITS)),
            "e": np.zeros(UNITS),
            "V": rng.normal(0, 0.3, (UNITS, GATES)),
            "U": rng.normal(0, 0.3, (UNITS, GATES)),
            "w": rng.normal(0, 0.3, GATES),
            "c": rng.normal(0, 0.3, UNITS),
            "b": np.zeros(1),
        }

    def _forward(self, x: np.ndarray, starts: np.ndarray, of: np.ndarray):
        p = self.p
        h = np.tanh(x @ p["E"] + p["e"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = (t * s) @ p["w"]
        a = np.exp(a - np.maximum.reduceat(a, starts)[of])
        a /= np.add.reduceat(a, starts)[of]
        z = np.add.reduceat(h * a[:, None], starts)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
        return h, t, s, a, z, y

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        """A probability for each bag of encoded passages."""
        if not bags:
            return np.empty(0)
        x, starts, of = _stacked(bags)
        return self._forward((x - self.mean) / self.scale, starts, of)[-1]

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> Model:
        """Full-batch Adam on the log loss. One class alone, or no labels, leave a constant score."""
        positive = float(labels.mean()) if len(labels) else 0.5
        if not len(labels) or not 0 < positive < 1:
            self.p = {k: np.zeros_like(v) for k, v in self.p.items()}
            self.p["b"] += np.log((len(labels) * positive + 1) / (len(labels) * (1 - positive) + 1))
            return self
        x, starts, of = _stacked(bags)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 0.05
        x = (x - self.mean) / self.scale
        p, m, v = self.p, {}, {}
        p["b"][:] = np.log(positive / (1 - positive))
        n = len(labels)
        for step in range(1, ROUNDS + 1):
            h, t, s, a, z, y = self._forward(x, starts, of)
            d = (y - labels) / n
            g = {"c": z.T @ d, "b": np.array([d.sum()])}
            dz = d[:, None] * p["c"]
            # softmax within a bag: each passage's share of what its bag's sum asks for
            pull = (h * dz[of]).sum(axis=1)
            da = a * (pull - np.add.reduceat(a * pull, starts)[of])
            g["w"] = (t * s).T @ da
            gate = da[:, None] * p["w"]
            dt, ds = gate * s * (1 - t * t), gate * t * s * (1 - s)
            g["V"], g["U"] = h.T @ dt, h.T @ ds
            dh = (a[:, None] * dz[of] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
            g["E"], g["e"] = x.T @ dh, dh.sum(axis=0)
            for k in p:
                g[k] = g[k] + DECAY * p[k] * (k in "EVUwc")
                m[k] = 0.9 * m.get(k, 0) + 0.1 * g[k]
                v[k] = 0.999 * v.get(k, 0) + 0.001 * g[k] ** 2
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self


def _stacked(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(b) for b in bags])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    return np.concatenate(bags).astype(np.float64), starts, np.repeat(np.arange(len(bags)), sizes)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, passages: int = PASSAGES, label: str = "quality") -> Model:
    """A model from at most ``sample`` labelled documents, all their passages; held-out labels are never read.

    Where such documents have more than ``passages`` passages, those with the smallest id hashes that reach this number.
    """
    chosen = labelled_sample(docs, labels, label, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            encoded = [encode((t or "").encode()).tobytes() for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("label").cast(pa.int32()), pa.array(encoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "passages"])

    encoded = stored(chosen.mapInArrow(run, "doc_id long, label int, passages binary"), "passages")
    own = F.octet_length("passages") / (4 * FEATURES)
    before = F.sum(own).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "passages")) - own  # `sample` rows at most
    kept = encoded.withColumn("before", before).where(F.col("before") < passages)
    rows = kept.orderBy("doc_id", "passages").select("label", "passages").collect()
    bags = [np.frombuffer(r["passages"], np.float32).reshape(-1, FEATURES) for r in rows]
    return Model().fit(bags, np.array([r["label"] for r in rows], float))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; the score depends on the text alone, null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, rows=500):
            score = model.scores([encode((t or "").encode()) for t in batch.column(2).to_pylist()])
            columns = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, rows=500):
            score = model.scores([encode((t or "").encode()) for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
