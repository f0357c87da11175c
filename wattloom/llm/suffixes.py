"""Removal of repeated passages with a logarithmic family of suffix arrays.

A string of ``LENGTH`` bytes is removed from every document but the first that holds it (by document id). Documents arrive in batches of
ascending ids. A batch gets a suffix array: its suffixes, cut at ``LENGTH`` bytes, in lexicographic order. It is merge-scanned
against the arrays of all existing levels; what is found there stands in an earlier document. The batch then becomes a level, and
two levels of equal size merge into one of the next size, so there are logarithmically many and an entry moves as often.

The suffix space is dealt to shards, each with a family of its own. A suffix belongs to the shard of its anchor: the smallest hash
among the grams of its first ``LENGTH`` bytes. Equal strings have equal anchors, and neighbouring suffixes mostly share one, so
a stretch of suffixes travels as one piece of text. Three passes keep what is moved small:

1. every part of the table (``PART`` rows) sends the distinct anchors it holds, a few bytes each; shards answer
   which of them other documents hold as well;
2. parts send the stretches under such anchors, one for each distinct stretch and part, since a part can settle its
   own repeats; shards run the index family over them and answer which suffixes stand in earlier documents;
3. parts cut the documents.

Copies of a whole text are told by its digest in the first pass, and travel no further. Shards and parts are as many as
the data needs; a passage or text that a third of all rows share is one piece for each part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import pieces, stored, text_bytes

LENGTH = 50
PART = 1024
# Suffixes of a batch.
BATCH = 1 << 19
LAST = (1 << 63) - 1

_TABLE = np.random.default_rng(2).integers(1, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 40) - 1)


def grams(raw: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` successive bytes: polynomials joined by doubling, mixed at the end."""
    power = {1: _TABLE[raw]}
    size = 1
    while size * 2 <= length:
        power[size * 2] = _joined(power[size], power[size], size)
        size *= 2
    out, done = power[size], size
    while done < length:
        size //= 2
        if done + size <= length:
            out, done = _joined(out, power[size], done), done + size
    out = out ^ (out >> np.uint64(32))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out


def _joined(a: np.ndarray, b: np.ndarray, gap: int) -> np.ndarray:
    n = max(0, len(b) - gap)
    return a[:n] * np.uint64(pow(_STEP, gap, 1 << 64)) + b[gap : gap + n]


def stretches(raw: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of suffixes of one document that share their anchor: (first suffix, suffixes, anchor).

    ``starts`` are the documents' borders; suffixes shorter than ``length`` are none.
    """
    gram = length // 2 + 1
    if len(raw) < length:
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64)
    least = grams(raw, gram)
    window, width = length - gram + 1, 1
    while width < window:
        gap = min(width, window - width)
        least = np.minimum(least[: len(least) - gap], least[gap:])
        width += gap
    n = len(least)
    inside = np.ones(n + 1, bool)
    inside[n] = False
    for back in range(1, length):
        ends = starts[1:] - back
        inside[ends[(ends >= 0) & (ends < n)]] = False
    if n < len(raw) - length + 1:
        raise AssertionError("a suffix without an anchor")
    new = inside[:n].copy()
    new[1:] &= (least[1:] != least[:-1]) | ~inside[: n - 1]
    first = np.flatnonzero(new)
    # a run ends where the next begins or where its document has no further suffix
    stop = np.flatnonzero(inside[:n] & ~inside[1 : n + 1])
    following = np.concatenate((first[1:], [n]))
    last = stop[np.searchsorted(stop, first)] + 1
    return first, np.minimum(following, last) - first, least[first]


def key_of(anchors: np.ndarray, shards: int) -> np.ndarray:
    """Shard in the upper bits, 40 more bits of the anchor below: the anchor as it travels."""
    mixed = anchors * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(31)
    return ((mixed >> np.uint64(40)) % np.uint64(shards)) << np.uint64(40) | (mixed & _LOW)


def _short(keys: np.ndarray) -> bytes:
    """Five bytes a key; the shard is known."""
    return np.ascontiguousarray((keys & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _long(raw: bytes, shard: int) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel() | np.uint64(shard << 40)


class Family:
    """Suffix arrays of levels; level ``i`` holds the suffixes of ``2**i`` batches, each string once."""

    def __init__(self):
        self.levels: list[np.ndarray | None] = []

    def earlier(self, suffixes: np.ndarray) -> np.ndarray:
        """Which of the sorted suffixes stand in a level."""
        found = np.zeros(len(suffixes), bool)
        for level in self.levels:
            if level is not None and len(suffixes):
                at = np.minimum(np.searchsorted(level, suffixes), len(level) - 1)
                found |= level[at] == suffixes
        return found

    def add(self, suffixes: np.ndarray) -> None:
        """A batch's sorted distinct suffixes become a level; equal-sized levels merge."""
        size = 0
        while size < len(self.levels) and self.levels[size] is not None:
            suffixes = np.unique(np.concatenate((self.levels[size], suffixes)))
            self.levels[size] = None
            size += 1
        if size == len(self.levels):
            self.levels.append(None)
        self.levels[size] = suffixes


def scan(texts: np.ndarray, starts: np.ndarray, docs: np.ndarray, length: int, batch: int = BATCH) -> np.ndarray:
    """Which suffixes of the stretches stand in an earlier document's stretch.

    Stretches come in ascending order of their documents; ``starts`` are their borders in ``texts``. The result has a flag for every
    byte of ``texts``, false where no whole suffix starts.
    """
    flags = np.zeros(len(texts), bool)
    if len(texts) < length:
        return flags
    windows = np.lib.stride_tricks.sliding_window_view(texts, length)
    family = Family()
    sizes = np.diff(starts) - length + 1
    until = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + batch, "right")))
        while end < len(sizes) and docs[end] == docs[end - 1]:
            end += 1  # a document is in one batch
        n = sizes[at:end]
        places = np.repeat(starts[at:end] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        of = np.repeat(docs[at:end], n)
        suffixes = np.ascontiguousarray(windows[places]).view(f"S{length}").ravel()
        order = np.argsort(suffixes, kind="stable")  # ties keep the documents' order
        suffixes, places, of = suffixes[order], places[order], of[order]
        fresh = np.ones(len(suffixes), bool)
        fresh[1:] = suffixes[1:] != suffixes[:-1]
        first = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        distinct = suffixes[first]
        flags[places] = family.earlier(distinct)[group] | (of > of[first][group])
        family.add(distinct)
        at = end
    return flags


def _numbered(docs: DataFrame) -> DataFrame:
    """(part, row, doc_id, text): where a row stands in its file names it; other tables are written first."""
    try:
        rows = docs.select("doc_id", "text", "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        rows = stored(docs.select("doc_id", "text"), "rows").select("doc_id", "text", "_metadata.file_path", "_metadata.row_index")
    return rows.select(
        F.xxhash64("file_path", F.floor(F.col("row_index") / PART)).alias("part"),
        (F.col("row_index") % PART).cast("int").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


_SENT = "shard int, part long, kind int, body binary"
# Kinds of rows, in the order in which a part's rows are read.
ANCHORS, REPEATED, DIGESTS, COPIES, PIECES, SPANS, TEXT = range(7)
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]


def _batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], ["shard", "part", "kind", "body"])


def _by_shard(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Sorted keys, shard by shard."""
    shard = (keys >> np.uint64(40)).astype(np.int64)
    cut = np.flatnonzero(np.diff(shard)) + 1
    for a, b in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(keys)])), strict=True):
        if b > a:
            yield int(shard[a]), keys[a:b]


def _send_anchors(shards: int, length: int):
    """Pass one, by part: anchors of its distinct texts, those that several documents hold apart, and the texts' digests."""

    def close(part: int, state) -> Iterator[tuple[int, int, int, bytes]]:
        digests, keys, texts = state
        firsts = np.array([min(d for d, _ in rows) for rows in digests.values()], np.int64)
        copies = []
        by_shard: dict[int, list[bytes]] = {}
        for digest, rows in digests.items():
            first = min(d for d, _ in rows)
            copies += [r for d, r in rows if d > first]
            kept = [r for d, r in rows if d == first]
            for r in kept:
                by_shard.setdefault(int.from_bytes(digest[:4], "little") % shards, []).append(
                    digest + first.to_bytes(8, "little", signed=True) + r.to_bytes(4, "little")
                )
        for shard, found in by_shard.items():
            yield shard, part, DIGESTS, b"".join(found)
        if copies:
            yield int(part % shards), part, COPIES, np.array(copies, "<u4").tobytes()
        if any(map(len, keys)):
            key, owner = np.concatenate(keys), firsts[np.concatenate(texts)]  # of a text in several documents, the one that keeps it
            order = np.lexsort((owner, key))
            key, owner = key[order], owner[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = key[1:] != key[:-1]
            first = np.flatnonzero(fresh)
            last = np.concatenate((first[1:], [len(key)])) - 1
            several = owner[last] != owner[first]
            for kind, some in ((ANCHORS, key[first[~several]]), (REPEATED, key[first[several]])):
                for shard, own in _by_shard(some):
                    yield shard, part, kind, _short(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state = None, None
        for batch in pieces(batches, rows=512, size=1_500_000):
            parts = batch.column(0).to_numpy()
            cut = np.flatnonzero(np.diff(parts)) + 1
            for a, b in zip(np.concatenate(([0], cut)).tolist(), np.concatenate((cut, [len(parts)])).tolist(), strict=True):
                if part != parts[a]:
                    if part is not None:
                        yield _batch(list(close(part, state)))
                    part, state = int(parts[a]), ({}, [], [])
                raw, starts = text_bytes(batch.column(3).slice(a, b - a))
                docs, rows = batch.column(2).to_numpy()[a:b], batch.column(1).to_numpy()[a:b]
                new, text = np.zeros(b - a, bool), np.zeros(b - a, np.int64)
                for k in range(b - a):
                    digest = hashlib.sha256(raw[starts[k] : starts[k + 1]]).digest()[:16]
                    new[k] = digest not in state[0]
                    text[k] = len(state[0])  # the place of a new digest among the part's
                    state[0].setdefault(digest, []).append((int(docs[k]), int(rows[k])))
                first, _, anchors = stretches(raw, starts, length)
                of = np.searchsorted(starts, first, "right") - 1
                keep = new[of]
                state[1].append(key_of(anchors[keep], shards))
                state[2].append(text[of[keep]])
        if part is not None:
            yield _batch(list(close(part, state)))

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, int, int, bytes]]]]:
    """Rows of sorted batches, all of one shard at a time."""
    held, at = [], None
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("shard", "part", "kind", "body")), strict=True):
            key = row[0]
            if key != at and held:
                yield at, held
                held = []
            at = key
            held.append(row)
    if held:
        yield at, held


def _answer_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass one, by shard: which of a part's anchors other documents hold too, and which of its texts are copies."""
    for shard, rows in _groups(batches):
        out = [(shard, part, COPIES, body) for _, part, kind, body in rows if kind == COPIES]
        sent = [(part, kind, _long(body, shard)) for _, part, kind, body in rows if kind in (ANCHORS, REPEATED)]
        if sent:
            key = np.sort(np.concatenate([k for _, _, k in sent] + [k for _, kind, k in sent if kind == REPEATED]))
            shared = np.unique(key[1:][key[1:] == key[:-1]])
            for part, _, own in sent:
                some = own[_in(own, shared)]
                if len(some):
                    out.append((shard, part, REPEATED, _short(some)))
        first: dict[bytes, int] = {}
        digests = [(part, body[k : k + 28]) for _, part, kind, body in rows if kind == DIGESTS for k in range(0, len(body), 28)]
        for _, d in digests:
            doc = int.from_bytes(d[16:24], "little", signed=True)
            first[d[:16]] = min(doc, first.get(d[:16], LAST))
        copies: dict[int, list[int]] = {}
        for part, d in digests:
            if int.from_bytes(d[16:24], "little", signed=True) > first[d[:16]]:
                copies.setdefault(part, []).append(int.from_bytes(d[24:28], "little"))
        out += [(shard, part, COPIES, np.array(r, "<u4").tobytes()) for part, r in copies.items()]
        yield _batch(out)


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Membership in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[tuple[int, bytes]]], Iterator]]:
    """For each part of sorted batches: its side rows by kind, and its texts as (row, doc, bytes)."""
    rows = (
        row
        for batch in pieces(batches, rows=512)
        for row in zip(*(batch.column(n).to_pylist() for n in ("part", "kind", "shard", "doc", "body")), strict=True)
    )
    row = next(rows, None)
    while row is not None:
        part, side = row[0], {}
        while row is not None and row[0] == part and row[1] != TEXT:
            side.setdefault(row[1], []).append((row[2], row[4]))
            row = next(rows, None)

        def texts() -> Iterator[tuple[int, int, bytes]]:
            nonlocal row
            while row is not None and row[0] == part:
                yield row[2], row[3], row[4]
                row = next(rows, None)

        yield part, side, texts()
        for _ in texts():
            pass


def _flags(side: dict[int, list[tuple[int, bytes]]]) -> set[int]:
    return {int(r) for _, body in side.get(COPIES, ()) for r in np.frombuffer(body, "<u4")}


def _send_pieces(shards: int, length: int):
    """Pass two, by part: the distinct stretches under shared anchors, for the smallest document that holds each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for part, side, texts in _by_part(batches):
            shared = np.sort(np.concatenate([np.empty(0, np.uint64), *[_long(body, s) for s, body in side.get(REPEATED, ())]]))
            copies = _flags(side)
            # stretch -> its number; shard, smallest document; occurrences (stretch, row, start)
            known: dict[bytes, int] = {}
            shard_of: list[int] = []
            least: list[int] = []
            seen: list[tuple[int, int, int, int]] = []
            held: list[tuple[int, int, bytes]] = []

            def work() -> None:
                raw = np.frombuffer(b"".join(t for _, _, t in held), np.uint8)
                starts = np.cumsum([0] + [len(t) for _, _, t in held])
                first, n, anchors = stretches(raw, starts, length)
                key = key_of(anchors, shards)
                hit = np.flatnonzero(_in(key, shared))
                of = np.searchsorted(starts, first[hit], "right") - 1
                joined = raw.tobytes()
                own = (key[hit] >> np.uint64(40)).tolist()
                for s, size, d, b in zip(first[hit].tolist(), (n[hit] + length - 1).tolist(), of.tolist(), own, strict=True):
                    piece = joined[s : s + size]
                    number = known.setdefault(piece, len(known))
                    row, doc, _ = held[d]
                    if number == len(least):
                        least.append(doc)
                        shard_of.append(b)
                    elif doc < least[number]:
                        least[number] = doc
                    seen.append((number, doc, row, s - int(starts[d])))
                held.clear()

            waiting = 0
            for row, doc, text in texts:
                if row not in copies and len(text) >= length:
                    held.append((row, doc, text))
                    waiting += len(text)
                if waiting > 1_000_000:
                    work()
                    waiting = 0
            if held:
                work()
            if not seen:
                continue
            number, doc, row, start = (np.array(c, np.int64) for c in zip(*seen, strict=True))
            size = np.array([len(p) for p in known], np.int64)
            first_doc = np.array(least, np.int64)
            settled = doc > first_doc[number]
            out = []
            if settled.any():
                out.append((int(part % shards), part, SPANS, _spans(row[settled], start[settled], start[settled] + size[number[settled]])))
            number, row, start = number[~settled], row[~settled], start[~settled]
            shard = np.array(shard_of, np.int64)
            by = np.lexsort((number, shard[number]))
            number, row, start = number[by], row[by], start[by]
            text = list(known)
            cut = np.concatenate(([0], np.flatnonzero(np.diff(shard[number])) + 1, [len(number)]))
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                own, local = np.unique(number[a:b], return_inverse=True)
                body = b"".join(
                    (
                        np.array([len(own), b - a], "<i8").tobytes(),
                        first_doc[own].tobytes(),
                        size[own].tobytes(),
                        local.astype(np.int64).tobytes(),
                        row[a:b].tobytes(),
                        start[a:b].tobytes(),
                        b"".join(text[k] for k in own.tolist()),
                    )
                )
                out.append((int(shard[number[a]]), part, PIECES, squeeze.compress(body)))
            yield _batch(out)

    return run


def _spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    return np.stack((row, start, end), axis=1).astype("<i8").tobytes()


def _answer_pieces(length: int, batch: int):
    """Pass two, by shard: the index family over its stretches, document by document; spans go back to their parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _groups(batches):
            out = [(shard, part, SPANS, body) for _, part, kind, body in rows if kind == SPANS]
            known: dict[bytes, int] = {}
            least: list[int] = []
            seen = []
            for _, part, kind, body in rows:
                if kind != PIECES:
                    continue
                raw = zstandard.ZstdDecompressor().decompress(body)
                n, m = np.frombuffer(raw, "<i8", 2).tolist()
                numbers = np.frombuffer(raw, "<i8", 2 * n + 3 * m, 16)
                docs, sizes, (of, row, start) = numbers[:n], numbers[n : 2 * n], numbers[2 * n :].reshape(3, m)
                at = 16 + 8 * (2 * n + 3 * m)
                here = np.empty(n, np.int64)
                for k, (doc, size) in enumerate(zip(docs.tolist(), sizes.tolist(), strict=True)):
                    here[k] = number = known.setdefault(raw[at : at + size], len(known))
                    at += size
                    if number == len(least):
                        least.append(doc)
                    elif doc < least[number]:
                        least[number] = doc
                seen.append((np.full(m, part), here[of], docs[of], row, start))
            if seen:
                part, number, doc, row, start = (np.concatenate(c) for c in zip(*seen, strict=True))
                text = list(known)
                first = np.array(least, np.int64)
                order = np.argsort(first, kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                starts = np.cumsum([0] + [len(text[k]) for k in order.tolist()])
                flags = scan(np.frombuffer(b"".join(text[k] for k in order.tolist()), np.uint8), starts, first[order], length, batch)
                edge = np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))
                run_from, run_to = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                whole = doc > first[number]
                found = [(part[whole], row[whole], start[whole], start[whole] + np.diff(starts)[place[number[whole]]])]
                # other occurrences take the flagged runs of their stretch
                part, number, row, start = part[~whole], place[number[~whole]], row[~whole], start[~whole]
                low, high = np.searchsorted(run_from, starts[number]), np.searchsorted(run_from, starts[number + 1])
                n = high - low
                which = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                shift = np.repeat(start - starts[number], n)
                found.append((np.repeat(part, n), np.repeat(row, n), shift + run_from[which], shift + run_to[which] + length - 1))
                part, row, low, high = (np.concatenate(c) for c in zip(*found, strict=True))
                order = np.argsort(part, kind="stable")
                part, row, low, high = part[order], row[order], low[order], high[order]
                cut = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)]))
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    if b > a:
                        out.append((shard, int(part[a]), SPANS, _spans(row[a:b], low[a:b], high[a:b])))
            yield _batch(out)

    return run


def _cut(length: int):
    """Pass three, by part: documents without the removed bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, side, texts in _by_part(batches):
            copies = _flags(side)
            spans = np.concatenate([np.empty((0, 3), np.int64), *[np.frombuffer(b, "<i8").reshape(-1, 3) for _, b in side.get(SPANS, ())]])
            spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
            rows = spans[:, 0]
            out = []
            for row, doc, text in texts:
                a, b = np.searchsorted(rows, row, "left"), np.searchsorted(rows, row, "right")
                own = [(0, len(text))] if row in copies and len(text) >= length else merged(spans[a:b, 1], spans[a:b, 2])
                kept = b"".join(text[x:y] for x, y in zip([0] + [e for _, e in own], [s for s, _ in own] + [len(text)], strict=True))
                out.append((None if doc == LAST else doc, len(text), len(text) - len(kept), len(own), hashlib.sha256(kept).hexdigest(), kept))
                if len(out) == 200:
                    yield _result(out)
                    out = []
            if out:
                yield _result(out)

    return run


def merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by spans in ascending order of their starts; touching spans are one run."""
    if not len(start):
        return []
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    return list(zip(start[first].tolist(), reach[np.concatenate((first[1:], [len(start)])) - 1].tolist(), strict=True))


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _result(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [c.split()[0] for c in _RESULT.split(", ")])


def deduplicated(docs: DataFrame, length: int = LENGTH, batch: int = BATCH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes kept, for every document.

    A byte goes if a string of ``length`` bytes covers it that also starts in a document with a smaller id; strings are judged on the
    input and never cross documents. Null texts are empty; null ids come after all others; rows that share an id do not
    remove each other; an empty table gives an empty result.
    """
    if length < 2:
        raise ValueError("strings of two bytes at least")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = 2 * tasks
    rows = _numbered(docs)
    text = rows.select("part", F.lit(TEXT).alias("kind"), F.col("row").alias("shard"), "doc", F.col("text").cast("binary").alias("body"))

    def by_shard(sent: DataFrame) -> DataFrame:
        return sent.repartition(tasks, "shard").sortWithinPartitions("shard")

    def by_part(side: DataFrame) -> DataFrame:
        side = side.select("part", "kind", "shard", F.lit(0).cast("long").alias("doc"), "body")
        return side.unionByName(text).repartition(tasks, "part").sortWithinPartitions("part", "kind", "doc", "shard")

    anchors = by_shard(rows.mapInArrow(_send_anchors(shards, length), _SENT))
    shared = stored(anchors.mapInArrow(_answer_anchors, _SENT), "shared-anchors")
    sent = by_shard(by_part(shared).mapInArrow(_send_pieces(shards, length), _SENT))
    spans = stored(sent.mapInArrow(_answer_pieces(length, batch), _SENT), "spans")
    side = spans.unionByName(shared.where(F.col("kind") == COPIES))
    return by_part(side).mapInArrow(_cut(length), _RESULT)


def report(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).drop("kept")


ORACLE = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT doc_id, hex(b) AS h, octet_length(b) AS n FROM d),
w AS (SELECT doc_id, CAST(i AS BIGINT) AS i, substr(h, 2 * i + 1, {2 * LENGTH}) AS s FROM h, generate_series(0, n - {LENGTH}) g(i)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
r AS (SELECT w.doc_id, w.i FROM w JOIN f ON w.s = f.s WHERE f.first < w.doc_id),
e AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {LENGTH} THEN 0 ELSE 1 END AS fresh FROM r),
k AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS span FROM e),
p AS (SELECT doc_id, span, min(i) AS a, max(i) + {LENGTH} AS z FROM k GROUP BY doc_id, span),
q AS (SELECT p.doc_id, span, a, z, n, substr(h, 2 * coalesce(lag(z) OVER (PARTITION BY p.doc_id ORDER BY a), 0) + 1,
             2 * (a - coalesce(lag(z) OVER (PARTITION BY p.doc_id ORDER BY a), 0))) AS before,
             substr(h, 2 * z + 1) AS after FROM p JOIN h ON p.doc_id = h.doc_id),
c AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans, string_agg(before, '' ORDER BY a) || arg_max(after, a) AS kept FROM q GROUP BY doc_id)
SELECT h.doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, h.h))) AS kept_sha256
FROM h LEFT JOIN c ON h.doc_id = c.doc_id
"""
