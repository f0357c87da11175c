"""Token-id files with Elias-Fano encoded document boundaries.

A file is a Parquet folder of segments. A segment holds the ids of successive documents, concatenated in as few bytes an id
as the vocabulary allows, and where each document starts, as an Elias-Fano sequence: the lower bits of every start packed
side by side, the upper bits as a bit vector with one set bit per document, and the place of every ``SAMPLED``-th set bit. A start is
found by ``select`` on the bit vector; no table of 64-bit offsets is kept. Documents follow each other in ascending id
order over all segments; a document's global start is its start in the segment plus two sums.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattloom.llm.common import pieces, stored
from wattloom.session import work_path

END = 2
# Ids in a segment, at least; a segment holds whole documents.
SEGMENT = 1 << 20
SAMPLED = 64
# Words, and pieces of words, whose ids a worker remembers.
REMEMBERED = 800_000

SEGMENTS = (
    "part int, segment int, before long, n_tokens long, n_docs int, width int, low_bits int, doc_ids array<long>, "
    "ids binary, low binary, high binary, samples binary"
)


class EliasFano:
    """A non-descending sequence of non-negative numbers below 2**32 in about two bits plus log2(last/n) each."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, int(values[-1] // n).bit_length() - 1)
        lows = (values[:, None] >> np.arange(low_bits)) & 1
        places = (values >> low_bits) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, np.uint8)
        high[places] = 1
        packed = (np.packbits(b.astype(np.uint8).ravel(), bitorder="little").tobytes() for b in (lows, high))
        return cls(n, low_bits, *packed, places[::SAMPLED].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """The ``i``-th number: from the sampled set bit before it a few bytes are read, never the whole sequence."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        samples = np.frombuffer(self.samples, "<u4")
        at, missing = int(samples[i // SAMPLED]), i % SAMPLED
        byte = at // 8
        bits = self.high[byte] & (0xFF << (at % 8) & 0xFF)
        while (ones := bits.bit_count()) <= missing:
            missing -= ones
            byte += 1
            bits = self.high[byte]
        for _ in range(missing):
            bits &= bits - 1
        place = 8 * byte + (bits & -bits).bit_length() - 1
        first = i * self.low_bits
        chunk = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8], "little") >> first % 8
        return (place - i) << self.low_bits | chunk & ((1 << self.low_bits) - 1)

    def values(self) -> np.ndarray:
        """All numbers."""
        if not self.n:
            return np.empty(0, np.int64)
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits]
        lows = bits.reshape(self.n, self.low_bits).astype(np.int64) << np.arange(self.low_bits)
        return ((places - np.arange(self.n)) << self.low_bits) + lows.sum(axis=1)

    def size(self) -> int:
        return len(self.low) + len(self.high) + len(self.samples)


# The normalizer and splitter that the quick way below follows, as tokenizer files state them.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# The same split for lower-case text of printable ASCII and Latin-1 letters, which the normalizer changes in no other way.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+")
_OTHER = re.compile(r"[^\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]")


class _Pieces(dict):
    """Piece to ids; what is not known yet goes to the tokenizer's model."""

    def __init__(self, tokenizer, written: dict[int, str], pack):
        super().__init__()
        self.tokenize, self.written, self.pack = tokenizer.model.tokenize, written, pack

    def __missing__(self, piece: str) -> bytes:
        pack = self.pack
        found = b"".join([pack(t.id) for t in self.tokenize(piece if piece.isascii() else piece.translate(self.written))])
        self[piece] = found
        return found


class WordEncoder:
    """Ids of texts as bytes, word by word; a word is encoded once and remembered.

    Fits tokenizers whose tokens never reach over a space or a line end and that treat what stands between them alike
    wherever it stands. Where the file states the usual splitter, plain text is split here and the pieces go to the file's
    model; other words, and all words of other files, go through the whole tokenizer.
    """

    def __init__(self, tokenizer_json: str, remembered: int = REMEMBERED):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        stated = json.loads(tokenizer_json)
        steps = (stated.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.splits = (stated.get("normalizer") or {}).get("normalizers") == _NORMALIZER and (
            [x.get("type") for x in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"].get("Regex") == _SPLIT
        )
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        # how the file's splitter writes the bytes of a letter
        letters = [chr(c) for c in (*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))] if self.splits else []
        written = {ord(c): "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in letters}
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.remembered = remembered
        self.pieces = _Pieces(self.tokenizer, written, struct.Struct("<H" if self.dtype.itemsize == 2 else "<I").pack)
        self.words: dict[str, bytes] = {}

    def _by_word(self, text: str) -> bytes:
        """Word by word: plain words by their pieces, others by the whole tokenizer."""
        words = text.split(" ")
        odd = [w for w in dict.fromkeys(words) if w not in self.words and not (self.splits and _plain(w))]
        for word, found in zip(odd, self.tokenizer.encode_batch(odd, add_special_tokens=False) if odd else (), strict=True):
            self.words[word] = np.array(found.ids, self.dtype).tobytes()
        known = self.words.get
        return b"".join([x if (x := known(w)) is not None else b"".join(map(self.pieces.__getitem__, _PIECES.findall(w.lower()))) for w in words])

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            text = text.replace("\n", " ")
            if self.splits and _plain(text):
                out.append(b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower()))))
            else:
                out.append(self._by_word(text))
            if len(self.pieces) + len(self.words) > self.remembered:
                self.pieces.clear()
                self.words.clear()
        return out


def _plain(text: str) -> bool:
    return "<|" not in text and (text.isascii() and text.isprintable() or not _OTHER.search(text))


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END, segment: int = SEGMENT) -> None:
    """Encode every text and write the segments below ``path``; ``tokenizer`` is the path of a tokenizer file.

    Documents are dealt to tasks by ranges of their ids, so the order over all segments is ascending; null ids come first,
    documents with one id follow each other by a hash of the text. Null texts are empty: the end id alone.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keys = [F.col("doc_id"), F.xxhash64("text")]
    ordered = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        part = TaskContext.get().partitionId()
        last = np.array([end], encoder.dtype).tobytes()
        width = encoder.dtype.itemsize
        number, before, waiting, held, doc_ids, sizes = 0, 0, 0, [], [], []

        def packed() -> pa.RecordBatch:
            starts = np.cumsum([0, *sizes[:-1]])
            ef = EliasFano.encode(starts)
            row = [part, number, before, waiting, len(sizes), width, ef.low_bits, doc_ids, b"".join(held), ef.low, ef.high, ef.samples]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _TYPES, strict=True)], _NAMES)

        for batch in pieces(batches):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                held.append(ids + last)
                sizes.append(len(ids) // width + 1)
                doc_ids.append(doc_id)
                waiting += sizes[-1]
                if waiting >= segment:
                    yield packed()
                    number, before = number + 1, before + waiting
                    held, doc_ids, sizes, waiting = [], [], [], 0
        if sizes:
            yield packed()

    ordered.mapInArrow(run, SEGMENTS).write.option("compression", "zstd").parquet(path)


_NAMES = [c.split()[0] for c in SEGMENTS.split(", ")]
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
_TYPES = [_KINDS[c.split()[1]] for c in SEGMENTS.split(", ")]
_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(model: str) -> WordEncoder:
    """A worker keeps its encoder, and the words it knows, from task to task."""
    key = hash(model)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(model)
    return _ENCODERS[key]


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as 32-bit little endian), from the files."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    until = F.sum("n").over(Window.orderBy("part"))  # a row for each writing task
    bases = stored(totals.select(F.col("part").alias("__part"), (until - F.col("n")).cast("long").alias("base")), "bases")
    rows = segments.join(bases, F.col("part") == F.col("__part")).select("base", *_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
                starts = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"]).values()
                sizes = np.diff(np.append(starts, len(ids)))
                raw = ids.view(np.uint8)
                sums = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["base"] + row["before"]), pa.array(sizes), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def ids_of(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """The ids of a few documents; only segments that hold one are decoded, a start is selected on its own."""
    wanted = spark.read.schema(SEGMENTS).parquet(path).where(F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("long") for i in doc_ids])))
    out = {}
    for row in wanted.toLocalIterator():
        ef = EliasFano(row["n_docs"], row["low_bits"], bytes(row["low"]), bytes(row["high"]), bytes(row["samples"]))
        for k, doc_id in enumerate(row["doc_ids"]):
            if doc_id in doc_ids:
                a, b = ef.select(k), ef.select(k + 1) if k + 1 < row["n_docs"] else row["n_tokens"]
                out[doc_id] = np.frombuffer(row["ids"], f"<u{row['width']}")[a:b].tolist()
    return out


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the documents' ids into the shared folder and read their boundaries and checksums back."""
    path = work_path(docs.sparkSession, "token-ids")
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path)
