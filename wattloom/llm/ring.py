"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A row's key is hashed to a cell of the ring. Every shard has several virtual nodes on the ring; a cell belongs to the
next node clockwise. Shards have room for a fixed number of rows, and rooms differ by one row at most and add up to
the number of rows. What does not fit into a shard continues clockwise to the next node whose shard has room. Balance
is therefore exact, and a change of the number of shards moves few rows besides those of the new shard.

Only row counts per cell reach the driver: a table of fixed size, whatever the number of rows. The rows themselves are
ranked within their cell, and a rank range of a cell goes to one shard.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wattloom.llm.common import stored

POSITIONS = 4096
# Sub-cells of a position: rows that share a key, but not a text, spread over them.
SALTS = 16
NODES = 64

_SEGMENTS = T.StructType(
    [
        T.StructField("__cell", T.IntegerType()),
        T.StructField("__low", T.LongType()),
        T.StructField("__high", T.LongType()),
        T.StructField("__shard", T.IntegerType()),
        T.StructField("__slot", T.LongType()),
    ]
)


def nodes(shards: int, per_shard: int = NODES) -> dict[float, int]:
    """Place on the ring, counted in cells' positions, to shard. Places depend on the shard and node alone, so they stay when shards are added."""
    placed: dict[float, int] = {}
    for shard in range(shards):
        for v in range(per_shard):
            at = int.from_bytes(hashlib.md5(f"{shard}:{v}".encode()).digest()[:8], "big") / 2**64 * POSITIONS
            while at in placed:
                at = math.nextafter(at, math.inf)
            placed[at] = shard
    return placed


def plan(counts: dict[int, int], shards: int, per_shard: int = NODES) -> list[tuple[int, int, int, int, int]]:
    """Rank ranges (cell, low, high, shard, first slot) from the rows per cell.

    In each round every node takes, in ring order, what waits there up to the room left in its shard; the rest moves on
    to the next node. Rooms add up to the rows, so all rows find a place within one turn of the ring.
    """
    ring = sorted(nodes(shards, per_shard).items())
    places = [p for p, _ in ring]
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    waiting: dict[int, list[tuple[int, int, int]]] = {}
    for cell in sorted(counts):
        waiting.setdefault(_next(places, cell // SALTS), []).append((cell, 0, counts[cell]))
    segments = []
    while waiting:
        passed: dict[int, list[tuple[int, int, int]]] = {}
        for i in sorted(waiting):
            shard = ring[i][1]
            for cell, low, high in waiting[i]:
                taken = min(high - low, room[shard] - filled[shard])
                if taken:
                    segments.append((cell, low, low + taken, shard, filled[shard]))
                    filled[shard] += taken
                if low + taken < high:
                    passed.setdefault((i + 1) % len(ring), []).append((cell, low + taken, high))
        waiting = passed
    return segments


def _next(places: list[float], position: int) -> int:
    """Index of the first node at or after the position, clockwise."""
    low, high = 0, len(places)
    while low < high:
        mid = (low + high) // 2
        if places[mid] < position:
            low = mid + 1
        else:
            high = mid
    return low % len(places)


def cell_of(key: Column, *rest: Column) -> Column:
    """Ring position from the key, sub-cell from key and content."""
    position = F.shiftrightunsigned(F.xxhash64(key), 52)
    salt = F.pmod(F.xxhash64(key, *rest), F.lit(SALTS))
    return (position * SALTS + salt).cast("int")


def measured(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` with the size in bytes plus one, the text's crc32 and the ring cell."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    out = docs.select(
        *columns, F.col("doc_id").alias("__key"), (F.octet_length(raw) + 1).cast("long").alias("__size"), F.crc32(raw).alias("__crc")
    )
    return out.withColumn("__cell", cell_of(F.col("__key"), F.col("__size"), F.col("__crc")))


def place(rows: DataFrame, shards: int = 16, per_shard: int = NODES) -> DataFrame:
    """``rows`` of :func:`measured` with ``__shard`` and ``__slot`` (gapless from 0 within the shard).

    Rows that agree in key, size and crc32 are interchangeable; their order is left open. An empty table stays empty.
    """
    spark: SparkSession = rows.sparkSession
    counted = rows.groupBy("__cell").count().collect()  # POSITIONS * SALTS rows at most
    segments = plan({r["__cell"]: r["count"] for r in counted}, shards, per_shard)
    lookup = spark.createDataFrame(segments, _SEGMENTS)
    order = Window.partitionBy("__cell").orderBy(F.xxhash64("__key"), "__key", "__crc", "__size")
    ranked = rows.withColumn("__rank", F.row_number().over(order).cast("long") - 1)
    # a segment per cell and at most one more per shard: a fixed bound, whatever the rows
    joined = ranked.join(F.broadcast(lookup.withColumnRenamed("__cell", "__of")), 
                         (F.col("__cell") == F.col("__of")) & (F.col("__rank") >= F.col("__low")) & (F.col("__rank") < F.col("__high")))
    return joined.withColumn("__slot", F.col("__slot") + F.col("__rank") - F.col("__low")).drop("__of", "__low", "__high", "__rank")


def digest(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Where each document goes: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: counts of any two shards differ by one at most. Null ids are an ordinary key, null texts count
    as empty, repeated rows get slots of their own.
    """
    rows = stored(measured(docs), "ring-rows")
    return place(rows, shards).select(
        F.col("__key").alias("doc_id"),
        F.col("__size").alias("size"),
        F.col("__crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("__shard").alias("shard"),
        F.col("__slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The documents with all their columns, and ``shard`` and ``slot`` (which replace columns of these names)."""
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    placed = place(measured(docs, *keep), shards)
    return placed.select(*keep, F.col("__shard").alias("shard"), F.col("__slot").alias("slot"))
