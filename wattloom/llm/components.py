"""Connected components of a link table, by alternating large-star and small-star steps.

Links are never gathered: each step is a grouped minimum (combined before the shuffle) and a join by node and part, so that a node
with very many links is in many tasks. Every round is written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import stored

ROUNDS = 100
SALTS = 64


def with_least(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``rows`` with ``m``, the least ``value`` of their ``key``.

    A key may have a third of all rows, so each row goes to one of ``SALTS`` parts of its key, and the one minimum goes to
    those parts that have rows.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(value), F.lit(SALTS)))
    parts = salted.groupBy(key, "__salt").agg(F.min(value).alias("m"))
    least = parts.groupBy(F.col(key).alias("__of")).agg(F.min("m").alias("m"), F.collect_list("__salt").alias("__parts"))
    least = least.select("__of", "m", F.explode("__parts").alias("__part"))
    return salted.join(least, (F.col(key) == F.col("__of")) & (F.col("__salt") == F.col("__part"))).select(*rows.columns, "m")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return with_least(both, "a", "b").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours (``b < a``) move to the smallest of them."""
    known = with_least(links, "a", "b")
    # the smallest neighbour's own link is the node's, every other one becomes that neighbour's
    return known.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b) but the roots themselves; the root is the smallest node.

    Nulls and loops are ignored; no links give no rows.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    current = stored(links.where("a != b").select(high.alias("a"), low.alias("b")).distinct(), "links")
    seen = None
    for _ in range(ROUNDS):
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        current = stored(_small_star(_large_star(current)).distinct(), "links")
    raise RuntimeError(f"no components after {ROUNDS} rounds")
