"""Benchmark decontamination by greedy string tiling.

Tokens of a test item and of a document are tiled: of all matches of unmarked tokens the longest is marked first, until none of
``SHORTEST`` tokens is left. Marked tokens belong to one tile only, in any order, so a passage whose sentences were moved is
covered all the same. A document is contaminated if tiles cover at least ``COVERAGE`` of an item.

Documents are scanned once per block of items and never shuffled: a block, bounded in bytes, is broadcast as a table
from the Karp-Rabin hash of every ``SHORTEST`` tokens to where they stand in the items. A document's own rolling hashes are
looked up there; only items it shares a seed with are tiled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from wattloom.llm.common import pieces, stored

SHORTEST = 5
COVERAGE = 0.8
BLOCK_BYTES = 16_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
_TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _TOKEN.findall(text.lower()) if text else []


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of every ``length`` successive ids."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mixed = ids.astype(np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(length):
        total = total * BASE + mixed[k : k + n]
    return total


class _Windows:
    """Hashes of all windows of any one length of a row of tokens, from sums of its prefixes."""

    def __init__(self, ids: np.ndarray):
        powers = np.full(len(ids) + 1, BASE, np.uint64)
        powers[0] = 1
        self.back = np.full(len(ids) + 1, _INVERSE, np.uint64)
        self.back[0] = 1
        np.cumprod(powers, out=powers)
        np.cumprod(self.back, out=self.back)
        self.sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(ids.astype(np.uint64) * powers[:-1], out=self.sums[1:])
        self.breaks = np.zeros(len(ids) + 1, np.int64)

    def block(self, blocked: np.ndarray) -> None:
        """Windows over blocked tokens no longer count."""
        np.cumsum(blocked, out=self.breaks[1:])

    def free(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where free windows start, and their hashes."""
        n = len(self.sums) - length
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero(self.breaks[length:] == self.breaks[:n])
        return at, (self.sums[at + length] - self.sums[at]) * self.back[at]


_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def tile(item: np.ndarray, doc: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in document, length), longest first; ties by place in the item, then in the document.

    The greatest length at which unmarked windows of both sides agree is found by bisection, as shorter windows of a match match as well.
    Windows of that length are then marked in order, after a check token by token. Memory is linear in both, also where words repeat:
    the document's places of a hash are walked once a round, never paired with all those of the item.
    """
    seeds, own = rolling(item, shortest), rolling(doc, shortest)
    hit = np.flatnonzero(np.isin(own, seeds))
    if not len(hit):
        return []
    # only what shares a seed with the item is looked at; a token that stands for a gap comes between
    edge = np.zeros(len(doc) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + shortest, -1)
    place = np.flatnonzero(np.cumsum(edge[:-1]))
    gaps = np.flatnonzero(np.diff(place) > 1) + 1
    place = np.insert(place, gaps, -1)
    part = np.where(place >= 0, doc[place], -1)
    in_item, in_part = np.zeros(len(item), bool), place < 0
    item_windows, part_windows = _Windows(item), _Windows(part)
    part_windows.block(in_part)
    tiles: list[tuple[int, int, int]] = []
    length = min(len(item), len(part))
    while length >= shortest:
        low, high = shortest - 1, length
        while low < high:
            middle = (low + high + 1) // 2
            if np.isin(item_windows.free(middle)[1], part_windows.free(middle)[1]).any():
                low = middle
            else:
                high = middle - 1
        length = low
        if length < shortest:
            break
        (of, hashes), (at, others) = item_windows.free(length), part_windows.free(length)
        by = np.argsort(others, kind="stable")
        at, others = at[by], others[by]
        first, last = np.searchsorted(others, hashes, "left"), np.searchsorted(others, hashes, "right")
        walked: dict[int, int] = {}
        for i, a, b in zip(of.tolist(), first.tolist(), last.tolist(), strict=True):
            if a == b or in_item[i : i + length].any():
                continue
            k = walked.get(a, a)
            while k < b and (in_part[at[k] : at[k] + length].any() or not np.array_equal(item[i : i + length], part[at[k] : at[k] + length])):
                k += 1
            walked[a] = k
            if k < b:
                j = int(at[k])
                in_item[i : i + length] = in_part[j : j + length] = True
                tiles.append((i, int(place[j]), length))
        item_windows.block(in_item)
        part_windows.block(in_part)
        length -= 1
    return tiles


class Block:
    """Test items ready for lookup: vocabulary, tokens and seeds."""

    def __init__(self, items: list[Row], shortest: int):
        self.shortest = shortest
        self.words: dict[str, int] = {}
        self.ids = [r["item_id"] for r in items]
        self.items = [np.array([self.words.setdefault(w, len(self.words) + 1) for w in tokens(r["text"])], np.int64) for r in items]
        seeds = [rolling(x, shortest) for x in self.items]
        hashes = np.concatenate([np.empty(0, np.uint64), *seeds])
        owners = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], owners[order]

    def search(self, text: str | None, coverage: float) -> list[tuple[int, int, int, int]]:
        """(item, its tokens, tokens covered, tiles) of every item that the text covers."""
        if not len(self.hashes) or not text:
            return []
        words = tokens(text)
        ids = np.fromiter(map(self.words.get, words, repeat(0)), np.int64, len(words))
        own = rolling(ids, self.shortest)
        if not len(own):
            return []
        strange = np.concatenate(([0], np.cumsum(ids == 0)))
        known = strange[self.shortest :] == strange[: -self.shortest]
        own = own[known]
        low = np.searchsorted(self.hashes, own)
        hit = self.hashes[np.minimum(low, len(self.hashes) - 1)] == own
        if not hit.any():
            return []
        found = np.unique(own[hit])
        low, high = np.searchsorted(self.hashes, found, "left"), np.searchsorted(self.hashes, found, "right")
        candidates = np.unique(np.concatenate([self.owners[a:b] for a, b in zip(low, high, strict=True)]))
        out = []
        for k in candidates.tolist():
            item = self.items[k]
            tiles = tile(item, ids, self.shortest)
            covered = sum(n for _, _, n in tiles)
            if covered >= coverage * len(item):
                out.append((self.ids[k], len(item), covered, len(tiles)))
        return out


def blocks(benchmark: DataFrame, size: int = BLOCK_BYTES) -> Iterator[list[Row]]:
    """Items in blocks of about ``size`` bytes, dealt by a hash; one block at a time is collected. Item ids may be null."""
    known = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text").distinct()
    total = known.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = -(-total // size)
    dealt = stored(known.withColumn("__block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n)))), "items")
    for b in range(n):
        if part := dealt.where(F.col("__block") == b).orderBy("item_id", "text").select("item_id", "text").collect():
            yield part


def contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and test item it covers: doc_id, item_id, item_tokens, covered_tokens, coverage, tiles.

    Null or empty texts and items of fewer than ``shortest`` tokens cover nothing and are not covered; repeated documents
    are reported each; without documents or items there are no rows. Items without an id are reported with a null one. A block's
    rows are stored before its broadcast goes and the next block comes.
    """
    schema = "doc_id long, item_id long, item_tokens int, covered_tokens int, tiles int"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for items in blocks(benchmark):
        block = docs.sparkSession.sparkContext.broadcast(Block(items, shortest))
        found = stored(rows.mapInArrow(_reporter(block, coverage), schema), "tiles")
        block.destroy()
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    share = F.col("covered_tokens") / F.col("item_tokens")
    return out.select("doc_id", "item_id", "item_tokens", "covered_tokens", share.alias("coverage"), "tiles")


def _reporter(block: Broadcast, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [
                (i, *hit)
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for hit in block.value.search(text, coverage)
            ]
            if found:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "item_tokens", "covered_tokens", "tiles"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST, coverage: float = COVERAGE) -> DataFrame:
    """The documents that cover no test item, with all their columns; a row is judged by its own text alone, and by items without an id too."""
    at = docs.columns.index("text")
    for items in blocks(benchmark):
        block = docs.sparkSession.sparkContext.broadcast(Block(items, shortest))

        def run(batches: Iterator[pa.RecordBatch], block: Broadcast = block) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                keep = [not block.value.search(text, coverage) for text in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
