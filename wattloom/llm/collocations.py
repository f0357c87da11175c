"""Phrase collocations by multikey quicksort of suffix pointers.

Every word of a piece starts a suffix: the language and up to three words. A multikey three-way quicksort parts suffix
pointers by their key at one depth into less, equal and greater; the equal part goes on at the next depth, the others at the same.
The size of an equal part is the count of its words as a phrase, and a part that is too small is abandoned with all it
holds. All parts of a round are split at once, as arrays.

Tasks sort the suffixes of their own blocks first, so that a suffix leaves a task once for each block, with its count.
Then suffixes are routed by their leading word, and sorted again per route with counts as weights. Words that hold more than a
``HEAVY``-th of all words (so there are at most that many) would be too much for a route: theirs are routed by all three words; what
routes hold of their two-word phrases are parts of counts that are added up, and only three-word phrases are abandoned there.

Null texts are empty, null languages are ``und``; ids are not read, so repeats count as often as they occur. Ties of scores
and counts are ordered by the phrase's bytes. An empty table has no phrases. Texts are counted whole; sorting goes by blocks of ``WORDS`` words.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattloom.llm.common import pieces, stored, text_bytes

LONGEST = 3
LEAST = 10
# A phrase is dropped if a longer one has at least this percentage of its count.
INSIDE = 50
BEST = 2000
# Words of a block; suffixes of a route, on average.
WORDS = 1 << 20
SUFFIXES = 1_000_000
HEAVY = 4096
# A language's ranking starts in so many parts.
SALTS = 64

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_SEPARATOR
_WORD[[0x20, 0x09]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


Parts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def multikey(keys: np.ndarray, weights: np.ndarray | None, end: int, least: list[int]) -> Iterator[Parts]:
    """Equal parts of a multikey three-way quicksort: (depth, a pointer of the part, its weight, whether it ends there).

    ``keys`` has a row for each depth and a column for each pointer; ``end`` marks the end of a suffix (not
    as a first key); no weights: one each. Parts
    that weigh less than ``least`` of their depth are abandoned. Each round splits all open parts around the median of
    three of their keys. A pointer left alone is read to its end at once.
    """
    least, last, n = np.array(least), len(keys) - 1, keys.shape[1]
    flat, order = keys.ravel(), np.arange(n, dtype=np.int32)
    sizes, depth = np.array([n], np.int32), np.zeros(1, np.int32)

    while len(order):
        alone = sizes == 1
        if alone.any():
            own = np.repeat(alone, sizes)
            at, level = order[own], depth[alone]
            weight = np.ones(len(at), np.int64) if weights is None else weights[at]
            while len(at):
                ends = (level > 0) & (keys[level, at] == end) | (level == last)
                found = weight >= least[level]
                yield level[found], at[found], weight[found], ends[found]
                on = found & ~ends
                at, level, weight = at[on], level[on] + 1, weight[on]
            order, sizes, depth = order[~own], sizes[~alone], depth[~alone]
            if not len(order):
                return
        parts = len(sizes)
        starts = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(parts, dtype=np.int32), sizes)
        key = flat[(depth.astype(np.int64) * n)[of] + order]
        a, b, c = key[starts], key[starts + sizes // 2], key[starts + sizes - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        at_pivot = pivot[of]
        less, equal = key < at_pivot, key == at_pivot
        ends = (depth == last) | (depth > 0) & (pivot == end)
        next_order, next_sizes, next_depth = [], [], []
        for chosen, is_equal in ((less, False), (equal, True), (~(less | equal), False)):
            at = np.flatnonzero(chosen)
            part = of[at]
            count = weight = np.bincount(part, minlength=parts)
            if weights is not None:  # exact: sums stay below 2**53
                weight = np.bincount(part, weights[order[at]], parts).astype(np.int64)
            keep = (count > 0) & (weight >= least[depth])
            if is_equal:
                first = order[at[(np.cumsum(count) - count)[keep]]]
                yield depth[keep], first, weight[keep], ends[keep]
                keep &= ~ends
            next_order.append(order[at[keep[part]]])
            next_sizes.append(count[keep].astype(np.int32))
            next_depth.append(depth[keep] + np.int32(is_equal))
        order, sizes, depth = map(np.concatenate, (next_order, next_sizes, next_depth))


def _words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where words start, their numbers, and the numbered words; words do not reach over ``starts``."""
    word = _WORD[raw]
    before, after = np.append(False, word[:-1]), np.append(word[1:], False)
    inner = starts[(starts > 0) & (starts < len(raw))]
    before[inner], after[inner - 1] = False, False
    first, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    offsets = np.append(0, np.cumsum(end - first)).astype(np.int64)
    data = np.ascontiguousarray(_LOWER[raw[word]])
    column = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    return first, column.indices.to_numpy().astype(np.int64), column.dictionary


def _keys(langs: np.ndarray, first: np.ndarray, second: np.ndarray, third: np.ndarray, words: int, names: int) -> np.ndarray:
    """Suffix keys, whose first is the word of a language; in 32 bits where they fit."""
    kind = np.int32 if (words + 1) * (names + 1) < 1 << 31 else np.int64
    return np.stack([langs.astype(kind) * words + first.astype(kind), second.astype(kind), third.astype(kind)])


class _Block:
    """The words of a slice of documents: ``ids``, ``langs`` (numbers), and whether the next word is in the same piece."""

    def __init__(self, batch: pa.RecordBatch):
        raw, starts = text_bytes(batch["text"])
        first, self.ids, self.words = _words(raw, starts)
        doc = np.searchsorted(starts, first, side="right") - 1
        piece = np.searchsorted(np.flatnonzero(_SEPARATOR[raw]), first)
        self.joined = np.append((doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1]), False) if len(first) else np.empty(0, bool)
        lang = batch["lang"].dictionary_encode()
        self.lang_names, self.langs = lang.dictionary.to_pylist(), lang.indices.to_numpy().astype(np.int64)[doc]

    def suffixes(self, low: int, high: int) -> np.ndarray:
        """Keys (language and word, second, third) of the suffixes that start at words ``low`` to ``high``, those of one word left out."""
        end, at = len(self.words), np.arange(low, high)[self.joined[low:high]]
        third = np.where(self.joined[at + 1], self.ids[np.minimum(at + 2, len(self.ids) - 1)], end)
        return _keys(self.langs[at], self.ids[at], self.ids[at + 1], third, len(self.words), len(self.lang_names))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _tally(numbers: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers and how often each occurs."""
    if below > 8 * len(numbers):
        return np.unique(numbers, return_counts=True)
    counts = np.bincount(numbers, minlength=below)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each slice with their counts, and the slice's words per language under a null word."""
    for batch in pieces(batches, size=8_000_000):
        block = _Block(batch)
        if not len(block.ids):
            continue
        n_words = len(block.words)
        both, counts = _tally(block.langs * n_words + block.ids, n_words * len(block.lang_names))
        langs = pa.array(block.lang_names).take(pa.array(both // n_words))
        words = block.words.cast(pa.large_string()).take(pa.array(both % n_words)).cast(pa.string())
        yield pa.record_batch([langs, words, pa.array(counts, pa.int64())], ["lang", "word", "n"])
        totals = np.bincount(block.langs, minlength=len(block.lang_names))
        yield pa.record_batch([pa.array(block.lang_names), pa.nulls(len(totals), pa.string()), pa.array(totals, pa.int64())], ["lang", "word", "n"])


def _hashes(values: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(v) for v in values], np.uint64)


def _mixed(*columns: np.ndarray) -> np.ndarray:
    """A hash of hashes."""
    out = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


_RUN = "route int, heavy boolean, langs string, words binary, n int, key_bytes int, count_bytes int, keys binary, counts binary"


def _small(values: np.ndarray) -> tuple[int, bytes]:
    """Numbers in as few bytes each as the largest needs."""
    size = next(s for s in (1, 2, 4, 8) if int(values.max()) < 1 << 8 * s)
    return size, values.astype(f"<u{size}").tobytes()


def _packed(route: int, heavy: bool, keys: np.ndarray, counts: np.ndarray, langs: list[str], words: pa.Array, number: np.ndarray) -> tuple:
    """Suffixes with the words they use, as a row of ``_RUN``; the end of a suffix is the number after the last word's.

    ``number`` is room for a number per word.
    """
    lang, first = np.divmod(keys[0], max(1, len(words)))
    parts = np.concatenate([first, keys[1], keys[2]])
    if len(words) > 32 * keys.shape[1]:
        used, parts = np.unique(parts, return_inverse=True)
    else:
        seen = np.zeros(len(words) + 1, bool)
        seen[parts] = True
        used = np.flatnonzero(seen)
        number[used] = np.arange(len(used))
        parts = number[parts]
    ended = used[-1] == len(words)
    texts = words.take(pa.array(used[: len(used) - ended])).cast(pa.binary())
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), b"\n")[0].as_py()
    of, lang = np.unique(lang, return_inverse=True)
    size, packed = _small(np.append(lang, parts))
    count_size, packed_counts = _small(counts)
    return int(route), bool(heavy), json.dumps([langs[i] for i in of]), texts, keys.shape[1], size, count_size, packed, packed_counts


def _runs(routes: int, heavy_words: list[tuple[str, bytes]]):
    """Sorted runs of each block's suffixes, a row for each route they go to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=8_000_000):
            block = _Block(batch)
            texts = block.words.to_pylist()
            hashes, lang_hashes = np.append(_hashes(texts), np.uint64(1)), _hashes([x.encode() for x in block.lang_names])
            lang_number = {x: i for i, x in enumerate(block.lang_names)}
            place = pc.index_in(pa.array([w for _, w in heavy_words], pa.large_binary()), value_set=block.words).to_pylist()
            heavy_keys = [lang_number[x] * len(texts) + i for (x, _), i in zip(heavy_words, place, strict=True) if i is not None and x in lang_number]
            size = len(block.lang_names) * len(texts)
            is_heavy = np.zeros(size, bool) if size <= 8 * len(block.ids) else None
            if is_heavy is not None:
                is_heavy[heavy_keys] = True
            number = np.empty(len(texts) + 1, np.int64)
            for low in range(0, len(block.ids), WORDS):
                keys = block.suffixes(low, min(low + WORDS, len(block.ids)))
                found = [(p, w) for _, p, w, ends in multikey(keys, None, len(texts), [0] * LONGEST) for p, w in [(p[ends], w[ends])]]
                if not found:
                    continue
                at, counts = (np.concatenate(x) for x in zip(*found, strict=True))
                keys = keys[:, at]
                lang, first = np.divmod(keys[0], len(texts))
                heavy = is_heavy[keys[0]] if is_heavy is not None else np.isin(keys[0], heavy_keys)
                lead = _mixed(lang_hashes[lang], hashes[first])
                lead[heavy] = _mixed(lead[heavy], hashes[keys[1][heavy]], hashes[keys[2][heavy]])
                to = (lead % np.uint64(routes)).astype(np.int64) * 2 + heavy
                order = np.argsort(to, kind="stable")
                cuts = np.flatnonzero(np.diff(to[order], prepend=-1, append=-1))
                rows = [_packed(to[order[a]] // 2, to[order[a]] % 2, keys[:, order[a:b]], counts[order[a:b]], block.lang_names, block.words, number) for a, b in zip(cuts, cuts[1:], strict=False)]
                kinds = [pa.int32(), pa.bool_(), pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                names = [x.split()[0] for x in _RUN.split(", ")]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


class _Route:
    """Suffixes of a route, under one numbering of its words."""

    def __init__(self):
        self.langs: dict[str, int] = {}
        self.words: pa.Array = pa.array([], pa.large_binary())
        self.keys, self.counts = np.empty((LONGEST + 1, 0), np.int32), np.empty(0, np.int64)

    def add(self, rows: list[dict]) -> None:
        """Take in runs under one numbering of all words."""
        if not rows:
            return
        texts = [b"\n".join(self.words.to_pylist()), *(row["words"] for row in rows)]
        texts = texts[0 if len(self.words) else 1 :]
        _, numbers, self_words = _words(np.frombuffer(b"\n".join(texts), np.uint8), np.zeros(1, np.int64))
        end, at = np.int32(len(self_words)), len(self.words)
        keys, counts = [np.vstack([self.keys[:1], np.append(numbers[:at], end)[self.keys[1:]]]).astype(np.int32)], [self.counts]
        for row in rows:
            n, size = row["n"], row["words"].count(b"\n") + 1
            packed = np.frombuffer(row["keys"], f"<u{row['key_bytes']}").astype(np.int32)
            langs = np.array([self.langs.setdefault(x, len(self.langs)) for x in json.loads(row["langs"])], np.int32)
            of = np.append(numbers[at : at + size], end).astype(np.int32)
            keys.append(np.vstack([langs[packed[:n]][None], of[packed[n:].reshape(LONGEST, n)]]))
            counts.append(np.frombuffer(row["counts"], f"<u{row['count_bytes']}").astype(np.int64))
            at += size
        self.words, self.keys, self.counts = self_words, np.hstack(keys), np.concatenate(counts)

    def suffixes(self) -> np.ndarray:
        return _keys(*self.keys, len(self.words), len(self.langs))

    def merge(self) -> None:
        found = [(p[e], w[e]) for _, p, w, e in multikey(self.suffixes(), self.counts, len(self.words), [0] * LONGEST)]
        at, self.counts = (np.concatenate(x) for x in zip(*found, strict=True))
        self.keys = self.keys[:, at]

    def phrases(self, least: list[int]) -> Iterator[pa.RecordBatch]:
        names, texts = pa.array(list(self.langs), pa.string()), pa.chunked_array([self.words.cast(pa.large_string()).cast(pa.string())]).combine_chunks()
        for depth, at, weight, _ in multikey(self.suffixes(), self.counts, len(self.words), least):
            keep = (depth >= 1) & (self.keys[depth + 1, at] < len(self.words))
            depth, keys, weight = depth[keep], self.keys[:, at[keep]], weight[keep]
            third = pa.array(np.where(depth == 2, keys[3], 0), mask=depth < 2)
            columns = [names.take(pa.array(keys[0])), texts.take(pa.array(keys[1])), texts.take(pa.array(keys[2])), texts.take(third), pa.array(weight)]
            yield pa.record_batch(columns, ["lang", "w1", "w2", "w3", "n"])


def _count_route(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    route, heavy, waiting, size = _Route(), key[1].as_py(), [], 0
    for batch in batches:
        for row in batch.to_pylist():
            waiting.append(row)
            size += row["n"]
            if size >= 2 * max(WORDS, len(route.counts)):
                route.add(waiting)
                route.merge()
                waiting, size = [], 0
    route.add(waiting)
    # a heavy word's suffixes are spread over routes: what is here of it may be few though it has many
    yield from route.phrases([0, 0, LEAST] if heavy else [LEAST] * LONGEST)


def counted(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of at least ``LEAST``: words (lang, word, n), phrases (lang, w1, w2, w3, n; w3 null for two words); totals (lang, n)."""
    spark, docs = docs.sparkSession, _rows(docs)
    words = docs.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = stored(words.where(F.col("word").isNull() | (F.col("n") >= LEAST)), "phrase-words")
    totals = words.where("word IS NULL").select("lang", "n")
    words = words.where("word IS NOT NULL")
    total = totals.agg(F.sum("n")).first()[0] or 0
    # at most HEAVY words
    heavy = [(r["lang"], r["word"].encode()) for r in words.where(F.col("n") > total / HEAVY).collect()]
    routes = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SUFFIXES))
    runs = docs.mapInArrow(_runs(routes, heavy), _RUN)
    grams = runs.groupBy("route", "heavy").applyInArrow(_count_route, "lang string, w1 string, w2 string, w3 string, n long")
    grams = grams.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)
    return words, stored(grams, "phrase-counts"), totals


def _score(a: str, left: str, right: str) -> str:
    a, left, right = (f"cast({x} AS decimal(20,0))" for x in (a, left, right))
    return f"cast(({a} * {a} * 1000000) div ({left} * {right}) AS bigint)"


def scored(docs: DataFrame) -> DataFrame:
    """All phrases that stay, with their lowest-scoring cut: lang, phrase, a, l, r, n, score."""
    words, grams, totals = counted(docs)
    first, second = (words.select(F.col("lang").alias(f"lang{i}"), F.col("word").alias(f"word{i}"), F.col("n").alias(f"n{i}")) for i in (1, 2))
    two = grams.where("w3 IS NULL").drop("w3")
    two = two.join(first, (F.col("lang") == F.col("lang1")) & (F.col("w1") == F.col("word1")))
    two = two.join(second, (F.col("lang") == F.col("lang2")) & (F.col("w2") == F.col("word2"))).select("lang", "w1", "w2", "n", "n1", "n2")
    two = stored(two, "phrase-pairs")

    three = grams.where("w3 IS NOT NULL")
    head = two.select(F.col("lang").alias("hl"), F.col("w1").alias("h1"), F.col("w2").alias("h2"), F.col("n").alias("n12"), "n1")
    tail = two.select(F.col("lang").alias("tl"), F.col("w1").alias("t1"), F.col("w2").alias("t2"), F.col("n").alias("n23"), F.col("n2").alias("n3"))
    cut = three.join(head, (F.col("lang") == F.col("hl")) & (F.col("w1") == F.col("h1")) & (F.col("w2") == F.col("h2")))
    cut = cut.join(tail, (F.col("lang") == F.col("tl")) & (F.col("w2") == F.col("t1")) & (F.col("w3") == F.col("t2")))
    cut = cut.withColumn("s1", F.expr(_score("n", "n1", "n23"))).withColumn("s2", F.expr(_score("n", "n12", "n3")))
    early = F.col("s1") <= F.col("s2")
    threes = cut.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"),
        F.when(early, F.col("n1")).otherwise(F.col("n12")).alias("l"), F.when(early, F.col("n23")).otherwise(F.col("n3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )

    inside = three.select("lang", "w1", "w2", "n").unionAll(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n"))
    inside = inside.groupBy("lang", "w1", "w2").agg(F.max("n").alias("longer"))
    kept = two.join(inside, ["lang", "w1", "w2"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("n") * INSIDE, F.lit(True)))
    twos = kept.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), F.col("n1").alias("l"), F.col("n2").alias("r"), F.expr(_score("n", "n1", "n2")).alias("score"))
    both = threes.select(*twos.columns).unionAll(twos)
    return both.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def best(docs: DataFrame, limit: int = BEST) -> DataFrame:
    """Each language's first ``limit`` phrases: lang, rank, phrase, a, l, r, n, score. Ranked in parts first, so that no task ranks a whole language.

    Scores reach from 0 to 1000000.
    """
    rows = stored(scored(docs), "phrase-scores")
    # at most 1001 bands of scores a language: those below the band that holds the last wanted phrase can go
    band = F.floor(F.col("score") / 1000)
    better = Window.partitionBy("__lang").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    bands = rows.groupBy(F.col("lang").alias("__lang"), band.alias("band")).count()
    bands = bands.withColumn("before", F.coalesce(F.sum("count").over(better), F.lit(0))).where(F.col("before") < limit)
    bands = bands.groupBy("__lang").agg(F.min("band").alias("lowest"))
    rows = rows.join(stored(bands, "phrase-bands"), (F.col("lang") == F.col("__lang")) & (band >= F.col("lowest")))
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))).where(F.col("rank") <= limit)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= limit)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), word_lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS MATERIALIZED (
  SELECT lang, unnest(ws) AS w1, unnest(list_concat(ws[2:], [NULL])) AS w2, unnest(list_concat(ws[3:], [NULL, NULL])[:len(ws)]) AS w3 FROM word_lists WHERE len(ws) > 0
), ones AS MATERIALIZED (
  SELECT lang, w1, count(*) AS f FROM grams GROUP BY lang, w1
), twos AS MATERIALIZED (
  SELECT lang, w1, w2, count(*) AS f FROM grams WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 10
), threes AS MATERIALIZED (
  SELECT lang, w1, w2, w3, count(*) AS f FROM grams WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang
), cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3 AS phrase, 1 AS cut, c.f AS a, x.f AS l, y.f AS r
  FROM threes c JOIN ones x ON x.lang = c.lang AND x.w1 = c.w1 JOIN twos y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 2, c.f, x.f, y.f
  FROM threes c JOIN twos x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 JOIN ones y ON y.lang = c.lang AND y.w1 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2, 1, c.f, x.f, y.f
  FROM twos c JOIN ones x ON x.lang = c.lang AND x.w1 = c.w1 JOIN ones y ON y.lang = c.lang AND y.w1 = c.w2
  WHERE NOT EXISTS (SELECT 1 FROM threes t WHERE t.lang = c.lang AND t.w1 = c.w1 AND t.w2 = c.w2 AND 100 * t.f >= 50 * c.f)
    AND NOT EXISTS (SELECT 1 FROM threes t WHERE t.lang = c.lang AND t.w2 = c.w1 AND t.w3 = c.w2 AND 100 * t.f >= 50 * c.f)
), lowest AS (
  SELECT *, (1000000 * a::HUGEINT * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang) QUALIFY rank <= 2000
"""
