"""SimHash near-duplicates through an index of positional bytes with count filtering.

A fingerprint has eight bytes. Two fingerprints that differ in at most three bits differ in at most three bytes, so at
least five of the eight positional bytes are shared. The index has a list for every three bytes at three positions of
one half; any five shared positions hold three in one half, so such pairs meet in a list (lists of single positions would hold a
256th of all fingerprints each and could not scale). Within a list the shared positional bytes of each pair are tallied, pairs
that reach the guaranteed minimum are retained, and their bit distance is verified.

Equal fingerprints are one entry. A list of more than ``LIST`` entries is dealt on by two more positional bytes: any five shared
bytes that hold the three of the list hold two of the other five positions, so the pair meets again in one of ten lists, and is tallied
there as anywhere. Such a list leaves three bytes open, which bounds it at 2 ** 24 entries. A task gives out a spanning forest of a
list's links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import in_arrow, stored
from wattloom.llm.components import roots, with_least

SHINGLE = 3
BITS = 3
SEED = 42
MATCHES = 5
LIST = 4096
# Three positional bytes of the lower or of the upper half.
POSTINGS = [tuple(4 * half + p for p in c) for half in (0, 1) for c in combinations(range(4), 3)]
# For each of these the ten ways to name two positions more.
DEALT = [[(*p, *c) for c in combinations([q for q in range(8) if q not in p], MATCHES - len(p))] for p in POSTINGS]
# Numbers of a list and of those it is dealt on to: ``WAYS * posting``, and the ones that follow.
WAYS = 1 + len(DEALT[0])
# Entries whose neighbours are looked up at once.
FRONTIER = 64
# A chunk of shingles whose bits are counted at once.
CHUNK = 1 << 18


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of UTF-8 text: a bit is 1 if over half the shingles' hashes have it; no words: 0."""
    words = text.lower().split()  # bytes: only A-Z are lowered, only ASCII white space separates
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): one row per document, the fingerprint as a signed long; ``carried`` columns of longs go along."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).cast(pa.binary())
        found = np.array([fingerprint(t or b"", shingle) for t in texts.to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *carried])

    schema = ", ".join(f"{c} long" for c in ("doc_id", "fp", *carried))
    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *carried), step, schema)


def _mask(positions: tuple[int, ...]) -> int:
    """The bits of some positional bytes, as a signed long."""
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def postings(entries: DataFrame) -> DataFrame:
    """(list, part, fp): every fingerprint in the eight lists of its positional bytes."""
    parts = [F.col("fp").bitwiseAND(F.lit(_mask(p))) for p in POSTINGS]
    keys = F.array(*[F.struct(F.lit(WAYS * i).alias("list"), part.alias("part")) for i, part in enumerate(parts)])
    return entries.select("fp", F.explode(keys).alias("k")).select("k.list", "k.part", "fp")


def dealt_on(rows: DataFrame, longest: int = LIST) -> DataFrame:
    """(list, part, fp) from rows that also have their list's ``count``: those of longer lists go on to the ten lists of five bytes."""
    masks = F.array(*[F.array(*[F.lit(_mask(p)) for p in ways]) for ways in DEALT])
    named = F.get(masks, F.expr(f"list div {WAYS}").cast("int"))
    way = F.struct(F.col("list").alias("list"), F.col("part").alias("part"))
    ways = F.transform(named, lambda m, j: F.struct((F.col("list") + j + 1).alias("list"), F.col("fp").bitwiseAND(m).alias("part")))
    keyed = rows.select("fp", F.explode(F.when(F.col("count") > longest, ways).otherwise(F.array(way))).alias("k"))
    return keyed.select("k.list", "k.part", "fp")


def _forest(fps: np.ndarray, bits: int, matches: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that connect what lies within ``bits`` of each other: breadth first, each entry is reached once."""
    left = fps
    a, b = [], []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            apart = left ^ at
            shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = shared >= matches
            near[near] = np.bitwise_count(apart[near]) <= bits
            if near.any():
                reached = left[near]
                a.append(np.full(len(reached), at, np.uint64))
                b.append(reached)
                frontier.extend(reached)
                left = left[~near]
    return a, b


def _forest_by_flips(fps: np.ndarray, list_id: int, bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """As :func:`_forest` for a list of five bytes, in time linear in its length: what lies near is looked up by flips of the open bits."""
    named = DEALT[list_id // WAYS][list_id % WAYS - 1]
    free = [8 * p + i for p in range(8) if p not in named for i in range(8)]
    flips = np.array([sum(1 << i for i in c) for k in range(1, bits + 1) for c in combinations(free, k)], np.uint64)
    fps = np.sort(fps)
    seen = np.zeros(len(fps), bool)
    a, b = [], []
    for seed in range(len(fps)):
        if seen[seed]:
            continue
        seen[seed] = True
        frontier = np.array([seed])
        while len(frontier):
            now, frontier = frontier[:FRONTIER], frontier[FRONTIER:]
            met = (fps[now][:, None] ^ flips).ravel()
            at = np.minimum(np.searchsorted(fps, met), len(fps) - 1)
            new = np.flatnonzero((fps[at] == met) & ~seen[at])
            reached, first = np.unique(at[new], return_index=True)
            seen[reached] = True
            a.append(fps[now[new[first] // len(flips)]])
            b.append(fps[reached])
            frontier = np.concatenate((frontier, reached))
    return a, b


def _linked_lists(bits: int, matches: int, longest: int):
    """Batches sorted by (list, part) in, links out; a list that goes on in the next batch is carried over."""
    none = np.empty(0, np.uint64)

    def links(lists: np.ndarray, parts: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero((lists[1:] != lists[:-1]) | (parts[1:] != parts[:-1])) + 1
        start, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(fps)]))
        two = start[end - start == 2]
        apart = fps[two] ^ fps[two + 1]
        near = ((apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= matches) & (np.bitwise_count(apart) <= bits)
        a, b = [fps[two][near]], [fps[two + 1][near]]
        for s, e in zip(start[end - start > 2], end[end - start > 2], strict=True):
            # a list longer than that has been dealt on, so it names five bytes
            x, y = _forest(fps[s:e], bits, matches) if e - s <= longest else _forest_by_flips(fps[s:e], int(lists[s]), bits)
            a += x
            b += y
        a, b = np.concatenate([none, *a]), np.concatenate([none, *b])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def joined(held: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists, parts, fps = (np.concatenate(x) for x in zip(*held, strict=True))
        return lists, parts, fps.astype(np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # rows of the list that may go on, after those of lists that have ended
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            lists, parts, _ = cols
            before = np.flatnonzero((lists != lists[-1]) | (parts != parts[-1]))
            at = before[-1] + 1 if len(before) else 0
            ended = at or (held and (held[-1][0][-1] != lists[-1] or held[-1][1][-1] != parts[-1]))
            if ended:
                yield links(*joined([*held, [c[:at] for c in cols]]))
                held = []
            held.append([c[at:] for c in cols])
        if held:
            yield links(*joined(held))

    return run


def links(entries: DataFrame, bits: int = BITS, longest: int = LIST) -> DataFrame:
    """(a, b): links between distinct fingerprints, as many as connect what is connected within ``bits`` bits.

    Every list is tallied in the same job. ``longest`` decides which are dealt on first, and changes no component.
    """
    if bits > BITS:
        raise ValueError(f"the lists guarantee links up to {BITS} bits")
    keys = postings(entries)
    sizes = stored(keys.groupBy("list", "part").count().where("count > 1"), "list-sizes")
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = dealt_on(keys.join(sizes, ["list", "part"]), longest)
    ordered = rows.repartition(tasks, "list", "part").sortWithinPartitions("list", "part", "fp")
    return ordered.mapInArrow(_linked_lists(bits, MATCHES, longest), "a long, b long")


def components(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, longest: int = LIST) -> DataFrame:
    """(doc_id, fp, component_id): the smallest id reachable over links of at most ``bits`` differing bits.

    Null and empty texts have fingerprint zero and link like any other. Null ids never name a component unless it has no
    other; repeated rows stay repeated; an empty table gives an empty result.
    """
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    rooted = _rooted(marked, bits, longest)
    # the fingerprint spreads the rows of a root; null firsts count as none
    near = with_least(rooted.select("fp", "root", F.struct(F.col("first").isNull().alias("none"), "first", "fp").alias("by")), "root", "by")
    named = near.select(F.col("fp").alias("of"), F.col("m.first").alias("component_id"))
    return marked.join(named, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id")


def _rooted(marked: DataFrame, bits: int = BITS, longest: int = LIST) -> DataFrame:
    """(fp, first, root): every fingerprint, its smallest id, and the fingerprint that stands for its component."""
    entries = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "entries")
    tree = stored(roots(links(entries.select("fp"), bits, longest)), "roots")
    rooted = entries.join(tree, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return stored(rooted, "rooted")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    found = components(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, one of each component: the one with its id.

    A document without an id stands behind all that have one; among such documents the text decides, as it does among
    different texts with one id. Rows of one id whose texts are in different components stay, one for each. Of rows with one id and
    one text one stays, which their other columns decide.
    """
    stand_in = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), stand_in), "__hash": F.xxhash64("text")})
    marked = fingerprints(keyed.select(F.col("__id").alias("doc_id"), "text", "__hash"), carried=("__hash",))
    marked = stored(marked, "fingerprints")
    roots_of = _rooted(marked).select(F.col("fp").alias("of"), "root")
    least = marked.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").alias("__id"), "__hash")).alias("row"))
    kept = least.join(roots_of, F.col("fp") == F.col("of")).groupBy("root").agg(F.min("row").alias("row"))
    kept = stored(kept.select("row.__id", "row.__hash"), "kept-rows")
    order = F.xxhash64(*[f.name for f in docs.schema if "map<" not in f.dataType.simpleString()])
    rows = keyed.join(kept, ["__id", "__hash"], "left_semi").groupBy("__id", "__hash")
    return rows.agg(F.min_by(F.struct(*docs.columns), order).alias("__row")).select("__row.*")
