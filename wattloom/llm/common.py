"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import stored

__all__ = ["WORD", "held_out", "labelled_sample", "stored", "table", "text_bytes"]

# A word: a run of anything but ASCII white space; what ``bytes.split()`` yields.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str | Column = "doc_id") -> Column:
    """Rows whose labels no model may see: crc32 of the id as text leaves 2 when divided by 4 (null: no)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents as (doc_id, text, label): those with the smallest id hashes, none held out.

    Null labels and ids are left out; of several labels of one document the largest counts. Only the chosen ids
    and labels are broadcast or joined, so the texts are not shuffled.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    chosen = (
        usable.groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    chosen = stored(chosen, "labelled")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `limit` rows of two numbers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and where each row starts; nulls are empty. No copy where there are none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    start = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[start[0] : start[-1]] if len(start) else raw[:0], (start - start[0]) if len(start) else np.zeros(1, np.int64)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 2000, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded rows and bytes, one row at least, so that work arrays stay small."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).get_total_buffer_size() > 0 and batch.slice(at, n).nbytes > size:
                n = max(1, n // 2)
            yield batch.slice(at, n)
            at += n


def in_arrow(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """One batch in, one batch out, in slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield step(batch)

    return df.mapInArrow(run, schema)
