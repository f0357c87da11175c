"""Byte-level BPE by prefix dynamic programming.

Text is split by a pattern, and each match (a piece) is encoded by itself. For every byte prefix of a piece the last token
of the prefix's encoding is stored. It is unique: a row of tokens is an encoding if and only if each two neighbours
are the encoding of their own bytes, so of all tokens that end a prefix just one fits behind the last token of what is left.
The encoding of a piece is read off backwards. Bytes that are appended extend the table without a change of what is
there, and after an edit only the pieces it touches are done again, from the first changed byte on.

Tables of whole texts hold four bytes for each byte of text; a token that belongs to the first byte of a piece is flagged, so
that a table also tells where pieces start.

Null texts are empty texts, which have no tokens. Rows are encoded one by one, so ties, repeats and null ids need no rule;
columns besides the id and the text are not read. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import in_arrow

# Parts of texts, pieces, and pairs of tokens, that a worker remembers; beyond that it starts anew.
REMEMBERED = 600_000
# Longer parts are encoded each time.
LONGEST = 64
FIRST = np.uint32(1 << 31)


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to rank from a rank file: a line for each token, base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


class PrefixCoder:
    """Tables of last tokens for pieces of bytes under given ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._left: dict[int, list[tuple[bytes, float]]] = {}
        self._right: dict[int, list[tuple[bytes, float]]] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        # tokens that merges lead to, and by their last bytes (three, or all of a shorter token) their lengths, longest first
        self.usable = {token: rank for token, rank in ranks.items() if len(token) == 1 or self.halves(rank) is not None}
        lengths: dict[bytes, set[int]] = {}
        for token in self.usable:
            lengths.setdefault(token[-3:], set()).add(len(token))
        for tail, found in lengths.items():
            if len(tail) == 3 and tail[1:] in self.usable:
                found.add(2)
        self.lengths = {tail: sorted(found - {1}) for tail, found in lengths.items()}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for single bytes and for tokens that no merges lead to."""
        if token not in self._halves:
            whole = self.bytes_of[token]
            parts = [whole[i : i + 1] for i in range(len(whole))]
            while len(parts) > 2:
                found = [(self.ranks.get(a + b, token), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
                rank, at = min(found)
                if rank >= token:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def _edge(self, token: int, side: int) -> list[tuple[bytes, float]]:
        """What stands at a token's edge while it is built: each such token's bytes, and the rank at which it is merged away."""
        known = self._right if side else self._left
        if token not in known:
            edge, at, until = [], token, float("inf")
            while True:
                edge.append((self.bytes_of[at], until))
                parts = self.halves(at)
                if parts is None:
                    break
                until, at = at, parts[side]
            known[token] = edge
        return known[token]

    def fits(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens side by side are encoded as these two.

        They are not if some token at the right edge of the first and some at the left edge of the second merge while both
        stand there. Equal merges go from left to right: one across the border precedes an equal one to its right.
        """
        pair = (a, b)
        known = self._fits.get(pair)
        if known is None:
            ranks, known = self.ranks, True
            for u, u_until in self._edge(a, 1):
                for v, v_until in self._edge(b, 0):
                    rank = ranks.get(u + v)
                    if rank is not None and rank < u_until and rank <= v_until:
                        known = False
            if len(self._fits) >= REMEMBERED:
                self._fits.clear()
            self._fits[pair] = known
        return known

    def extend(self, piece: bytes, last: array) -> None:
        """Add the last tokens of all prefixes of ``piece`` that ``last`` does not cover yet."""
        usable, lengths, pairs, slow = self.usable.get, self.lengths.get, self._fits.get, self.fits
        for end in range(len(last) + 1, len(piece) + 1):
            token = usable(piece[end - 1 : end])
            if end > 1:
                pair = (last[-1], token)
                fit = pairs(pair)
                if fit is None:
                    fit = slow(*pair)
                if not fit:
                    found = lengths(piece[end - 3 : end] if end > 2 else piece[:end])
                    if found is None:
                        found = lengths(piece[end - 2 : end], ()) if end > 2 else ()
                    for n in found:
                        token = usable(piece[end - n : end])
                        if token is None or n > end:
                            continue
                        if n == end:
                            break
                        pair = (last[end - n - 1], token)
                        fit = pairs(pair)
                        if fit or fit is None and slow(*pair):
                            break
            last.append(token)

    def table(self, piece: bytes) -> array:
        last = array("I")
        self.extend(piece, last)
        return last

    def read(self, last: array, piece: bytes) -> list[int]:
        """The piece's tokens from its table; a piece that is itself a token is that token."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        tokens, at = [], len(last)
        while at:
            token = last[at - 1]
            tokens.append(token)
            at -= len(self.bytes_of[token])
        return tokens[::-1]

    def encode(self, piece: bytes) -> list[int]:
        known = self.ranks.get(piece)
        return [known] if known is not None else self.read(self.table(piece), piece)

    def encode_all(self, pieces: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Tokens of many pieces: in sorted order each table goes on from what it shares with the one before."""
        before, last = b"", array("I")
        for piece in sorted(pieces):
            known = self.ranks.get(piece)
            if known is not None:
                yield piece, [known]
                continue
            same = 0
            for a, b in zip(piece, before, strict=False):
                if a != b:
                    break
                same += 1
            del last[same:]
            self.extend(piece, last)
            yield piece, self.read(last, piece)
            before = piece

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class TextCoder:
    """Encodes whole texts. No piece reaches over a single space between other characters: such parts are remembered."""

    _SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
    _BESIDE = re.compile(r"\s\s")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pieces = regex.compile(pattern)
        self.coder = PrefixCoder(ranks)
        # what follows a single space, up to the next one, to the packed ids of both
        self.parts: dict[str, bytes] = {}
        # a piece's packed ids
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        split = []
        for text in texts:
            # white space beside a space belongs to it
            plain = not (text[:1].isspace() or text[-1:].isspace() or self._BESIDE.search(text))
            parts = text.split(" ") if plain else self._SINGLE_SPACE.split(text)
            split.append(parts)
        if len(self.parts) >= REMEMBERED:
            self.parts.clear()
        new = {part for _, *rest in split for part in rest}.difference(self.parts)
        known = self._packed([" " + part for part in new])
        found = {part: known[" " + part] for part in new}
        self.parts.update((part, ids) for part, ids in found.items() if len(part) <= LONGEST)
        firsts = self._packed([parts[0] for parts in split])
        parts_of = self.parts if all(len(p) <= LONGEST for p in new) else {**self.parts, **found}
        return [b"".join([firsts[first], *map(parts_of.__getitem__, rest)]) for first, *rest in split]

    def _packed(self, stretches: list[str]) -> dict[str, bytes]:
        """Packed ids of stretches of text, each split by itself."""
        split = {s: [piece.encode() for piece in self.pieces.findall(s)] for s in stretches}
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        known = self.known
        new = {piece for pieces in split.values() for piece in pieces if piece not in known}
        long = {piece for piece in new if len(piece) > LONGEST}
        known.update((piece, array("I", ids).tobytes()) for piece, ids in self.coder.encode_all(new))
        out = {s: b"".join(map(known.__getitem__, pieces)) for s, pieces in split.items()}
        for piece in long:
            del known[piece]
        return out

    def decode(self, packed: bytes) -> bytes:
        return self.coder.decode(np.frombuffer(packed, "<u4").tolist())

    def table(self, text: str) -> np.ndarray:
        """The last token of each byte prefix of each piece, pieces one after the other."""
        tables = [self._flagged(self.coder.table(piece.encode())) for piece in self.pieces.findall(text)]
        return np.concatenate(tables) if tables else np.empty(0, np.uint32)

    def _flagged(self, last: array) -> np.ndarray:
        out = np.array(last, np.uint32)
        out[0] |= FIRST
        return out

    def ids(self, raw: bytes, table: np.ndarray) -> list[int]:
        """The tokens of a text from its bytes and its table."""
        starts = np.flatnonzero(table & FIRST).tolist() + [len(table)]
        last = table & ~FIRST
        return [t for a, b in zip(starts, starts[1:], strict=False) for t in self.coder.read(last[a:b].tolist(), raw[a:b])]

    def edit(self, text: str, table: np.ndarray, at: int, removed: int, inserted: str) -> tuple[str, np.ndarray, int]:
        """The text with ``removed`` characters from ``at`` on replaced, its table, and how many bytes were done again.

        A match depends on its characters and on the one behind it (and no further), so matches that end two
        bytes or more before the edit stay. From there on the text is matched anew until a match starts where one started before.
        """
        new = text[:at] + inserted + text[at + removed :]
        raw, old = new.encode(), text.encode()
        start, gone = len(text[:at].encode()), len(text[at : at + removed].encode())
        shift = len(inserted.encode()) - gone
        flagged = np.flatnonzero(table & FIRST)
        ends = np.append(flagged[1:], len(table))
        # a character may have four bytes, so matches whose next character lies before the edit end five bytes before it
        kept = int(np.searchsorted(ends, start - 5, side="right")) if len(flagged) else 0
        here = int(flagged[kept]) if kept < len(flagged) else (int(ends[-1]) if len(flagged) else 0)
        old_starts, out, done = set(flagged[kept:].tolist()) | {len(table)}, [table[:here]], 0
        at_char = len(raw[:here].decode())
        for match in self.pieces.finditer(new, at_char):
            if here - shift >= start + gone and here - shift in old_starts:
                break
            piece = match.group().encode()
            last = array("I")
            if here in old_starts:  # the part of the old match before the first change stays
                until = min((x for x in old_starts if x > here), default=here)
                same = 0
                while same < min(len(piece), until - here) and piece[same] == old[here + same]:
                    same += 1
                last.extend((table[here : here + same] & ~FIRST).tolist())
            done += len(piece) - len(last)
            self.coder.extend(piece, last)
            out.append(self._flagged(last))
            here += len(piece)
        if here < len(raw):
            out.append(table[here - shift :])
        return new, np.concatenate(out), done


_CODERS: dict[tuple[int, str], TextCoder] = {}


def _coder(ranks, pattern: str) -> TextCoder:
    """A worker's coder of a broadcast rank file, which is kept from task to task."""
    key = (hash(ranks.value), pattern)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = TextCoder(read_ranks(ranks.value), pattern)
    return _CODERS[key]


def _ranks(docs: DataFrame, path: str):
    """The rank file for the tasks; its size is that of the vocabulary, whatever the documents."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The documents as (doc_id, ids): ids are little-endian unsigned 32-bit numbers."""
    ranks = _ranks(docs, path)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _coder(ranks, pattern)
        return pa.record_batch([batch["doc_id"], pa.array(coder.encode(batch["text"].to_pylist()), pa.binary())], ["doc_id", "ids"])

    return in_arrow(_texts(docs), step, "doc_id long, ids binary")


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) back to (doc_id, raw), the bytes of the texts."""
    ranks = _ranks(rows, path)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _coder(ranks, pattern)
        return pa.record_batch([batch["doc_id"], pa.array(map(coder.decode, batch["ids"].to_pylist()), pa.binary())], ["doc_id", "raw"])

    return in_arrow(rows.select("doc_id", "ids"), step, "doc_id long, raw binary")


def tables(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text, last): the stored last token of each byte prefix, four bytes each, for later edits."""
    ranks = _ranks(docs, path)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _coder(ranks, pattern)
        last = (coder.table(t).astype("<u4").tobytes() for t in batch["text"].to_pylist())
        return pa.record_batch([batch["doc_id"], batch["text"], pa.array(last, pa.binary())], ["doc_id", "text", "last"])

    return in_arrow(_texts(docs), step, "doc_id long, text string, last binary")


def edited(rows: DataFrame, edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows of :func:`tables` after one edit each: (doc_id, text, last, ids, redone).

    ``edits`` has doc_id, at, removed (characters) and inserted. Rows without an edit stay out; a document has one edit at
    most. ``redone`` counts the bytes whose last token was computed again.
    """
    ranks = _ranks(rows, path)
    joined = rows.select("doc_id", "text", "last").join(
        edits.select(F.col("doc_id").alias("__of"), F.col("at").cast("long"), F.col("removed").cast("long"), F.coalesce("inserted", F.lit("")).alias("inserted")),
        F.col("doc_id") == F.col("__of"),
    )

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder, out = _coder(ranks, pattern), []
        for row in batch.to_pylist():
            text, last, done = coder.edit(row["text"], np.frombuffer(row["last"], "<u4"), row["at"], row["removed"], row["inserted"])
            ids = np.array(coder.ids(text.encode(), last), "<u4").tobytes()
            out.append((row["doc_id"], text, last.astype("<u4").tobytes(), ids, done))
        columns = [list(c) for c in zip(*out, strict=True)] or [[], [], [], [], []]
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "text", "last", "ids", "redone"])

    return in_arrow(joined.drop("__of"), step, "doc_id long, text string, last binary, ids binary, redone long")


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Each document's tokens and round trip: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ranks = _ranks(docs, path)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder, n, ids, texts = _coder(ranks, pattern), [], [], []
        for packed in coder.encode(batch["text"].to_pylist()):
            n.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            texts.append(hashlib.sha256(coder.decode(packed)).hexdigest())
        columns = [batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
        return pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_arrow(_texts(docs), step, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
