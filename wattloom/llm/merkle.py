"""A Merkle manifest of a document table, proved by a recursive query.

Every row is a leaf. A source's leaves ascend by id and sixteen at a time become their hash, level by level, down to one
subroot; the subroots in the order of their sources become the root in the same way. Levels are built one after the other, each
a grouping of a sixteenth of the rows before, and stored as node rows that are linked to their parents and hold the text
of their siblings. A recursive query then climbs from all leaves at once: each step joins the parent link, appends the siblings to
the proof and folds them into the hash of the leaf, which may be tampered with.

All above a run of sixteen leaves is shared by them, so they climb in one row with sixteen folded hashes and one text of
siblings. The upper nodes are met by very many climbers; a node row is repeated for each block of ``BLOCK`` leaves below it, so that a
row meets the climbers of one block at most, on every level and at every size.

Null ids come first, ties of ids are ordered by their leaves, and equal leaves are interchangeable. Null sources are a
source of their own, the first. Repeated rows are leaves of their own. An empty table has no leaves and no root. Columns besides the five
hashed ones are not read.
"""

from __future__ import annotations

import string
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattloom.llm.common import stored

ARITY = 16
BLOCK = 1 << 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Tree number of the tree over the subroots.
TOP = -1


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(text: Column) -> Column:
    """The hash of a row's fields, each with its length in bytes; ``text`` stands in for the text."""

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return sha(F.concat(*[field(text if name == "text" else F.col(name)) for name in FIELDS]))


def tampered_text() -> tuple[Column, Column]:
    """Which rows the tamper test changes, and their changed text: ids whose crc32 five divides, A-Z in lower case."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return chosen, F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, tampered): ``tampered`` is the leaf of the changed row, null where nothing is tampered with."""
    chosen, changed = tampered_text()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf_hash(F.col("text")).alias("leaf"),
        F.when(chosen, leaf_hash(changed)).alias("tampered"),
    )


def _numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """Leaves with their tree, number in it and place in the whole; the trees (tree, source, total); most leaves; trees.

    Rows are dealt to ranges and sorted there; a range's place, and where a source starts, are sums of counts per (range, source).
    A running number tells equal leaves apart, so that they spread over ranges as well.
    """
    order = ["source", "doc_id", "leaf", "__salt"]
    rows = stored(rows.withColumn("__salt", F.monotonically_increasing_id()), "merkle-leaves")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("__salt")
    ordered = stored(ordered.withColumn("__row", F.monotonically_increasing_id()), "merkle-ordered")
    ordered = ordered.withColumn("__part", F.shiftright("__row", 33)).withColumn("__row", F.col("__row").bitwiseAND((1 << 33) - 1))

    entries = stored(ordered.groupBy("__part", "source").agg(F.min("__row").alias("first"), F.count("*").alias("n")), "merkle-entries")
    # a row for each range
    parts = entries.groupBy("__part").agg(F.sum("n").alias("n"))
    so_far = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("offset"))
    entries = entries.join(F.broadcast(parts), "__part")
    trees = entries.groupBy("source").agg(
        F.min(F.col("offset") + F.col("first")).alias("start"), F.sum("n").alias("total"), F.min("__part").alias("__part")
    )
    starts = trees.groupBy("__part").agg(F.count("*").alias("n"))
    starts = starts.select("__part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("earlier"))
    rank = F.row_number().over(Window.partitionBy("__part").orderBy("start")) - 1
    trees = trees.join(F.broadcast(starts), "__part").select("source", "start", "total", (F.col("earlier") + rank).alias("tree"))
    trees = stored(trees, "merkle-trees")

    of = trees.withColumnRenamed("source", "__source")
    entries = entries.join(of, F.col("source").eqNullSafe(F.col("__source"))).select(
        F.col("__part").alias("__p"), F.col("source").alias("__s"), "offset", "start", "total", "tree"
    )
    entries = stored(entries, "merkle-entries")
    placed = ordered.join(entries, (F.col("__part") == F.col("__p")) & F.col("source").eqNullSafe(F.col("__s")))
    place = F.col("offset") + F.col("__row")
    placed = placed.select("tree", "total", place.alias("place"), (place - F.col("start")).alias("idx"), "doc_id", "leaf", "tampered")
    most = trees.agg(F.max("total"), F.count("*")).first()
    return placed, trees.select("tree", "source", "total"), most[0] or 0, most[1]


def _runs(placed: DataFrame) -> DataFrame:
    """Runs of sixteen leaves: members in order, and their hash (a lone leaf of its tree is itself)."""
    member = F.struct("idx", "doc_id", "leaf", "tampered")
    grouped = placed.groupBy("tree", F.floor(F.col("idx") / ARITY).alias("run")).agg(
        F.array_sort(F.collect_list(member)).alias("members"), F.min("place").alias("low"), F.max("place").alias("high"), F.max("total").alias("total")
    )
    hashes = F.transform("members", lambda m: m["leaf"])
    whole = F.when(F.col("total") == 1, hashes[0]).otherwise(sha(F.array_join(hashes, "")))
    return grouped.select("tree", "run", "members", "low", "high", F.ceil(F.col("total") / ARITY).alias("n"), "total", whole.alias("hash"))


def _level(nodes: DataFrame) -> DataFrame:
    """Parents of the nodes (tree, level, idx, hash, low, high, n): each with its children in order."""
    child = F.struct("idx", "of_tree", "of_level", "of_idx", "hash", "low", "high")
    return (
        nodes.where(F.col("n") > 1)
        .groupBy("tree", (F.col("level") + 1).alias("level"), F.floor(F.col("idx") / ARITY).alias("up"))
        .agg(F.array_sort(F.collect_list(child)).alias("kids"), F.max("n").alias("n"))
        .select("tree", "level", F.col("up").alias("idx"), "kids", F.ceil(F.col("n") / ARITY).alias("n"), sha(F.array_join(F.col("kids")["hash"], "")).alias("hash"))
    )


def _as_nodes(parents: DataFrame) -> DataFrame:
    return parents.select(
        "tree", "level", "idx", F.col("tree").alias("of_tree"), F.col("level").alias("of_level"), F.col("idx").alias("of_idx"),
        "hash", F.array_min("kids.low").alias("low"), F.array_max("kids.high").alias("high"), "n",
    )


def _linked(parents: DataFrame) -> DataFrame:
    """Node rows (tree, level, idx, block) with their parent and the hashes of their siblings before and after them."""
    hashes = F.col("kids")["hash"]
    rows = parents.select("tree", "level", "idx", hashes.alias("hashes"), F.posexplode("kids").alias("at", "kid"))
    return rows.select(
        F.col("kid.of_tree").alias("tree"),
        F.col("kid.of_level").alias("level"),
        F.col("kid.of_idx").alias("idx"),
        F.explode(F.sequence(F.floor(F.col("kid.low") / BLOCK), F.floor(F.col("kid.high") / BLOCK))).alias("block"),
        F.col("tree").alias("up_tree"),
        F.col("level").alias("up_level"),
        F.col("idx").alias("up_idx"),
        F.array_join(F.slice("hashes", F.lit(1), F.col("at")), "").alias("before"),
        F.array_join(F.slice("hashes", F.col("at") + 2, F.lit(ARITY)), "").alias("after"),
    )


def _height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT tree AS from_tree, run AS from_run, block, tree, 1 AS level, run AS idx, folded, '' AS siblings FROM {runs}
  UNION ALL
  SELECT c.from_tree, c.from_run, c.block, n.up_tree, n.up_level, n.up_idx,
         transform(c.folded, h -> sha2(concat(n.before, h, n.after), 256)), concat(c.siblings, n.before, n.after)
  FROM climb c JOIN {nodes} n ON c.tree = n.tree AND c.level = n.level AND c.idx = n.idx AND c.block = n.block
)
SELECT from_tree, from_run, folded, siblings FROM climb WHERE tree = {tree} AND level = {level}
"""


class Manifest:
    """The stored levels of a table: ``runs`` of leaves, linked ``nodes``, ``subroots`` (tree, subroot), and the ``root`` (None if empty)."""

    def __init__(self, docs: DataFrame):
        placed, self.trees, most, trees = _numbered(leaves(docs))
        self.runs = stored(_runs(placed), "merkle-runs")
        address = [F.col("tree").alias("of_tree"), F.lit(1).alias("of_level"), F.col("run").alias("of_idx")]
        nodes = self.runs.select("tree", F.lit(1).alias("level"), F.col("run").alias("idx"), *address, "hash", "low", "high", "n")
        done, links = [nodes.where("n = 1")], []
        for _ in range(_height(-(-most // ARITY))):
            parents = stored(_level(nodes), "merkle-level")
            links.append(_linked(parents))
            nodes = _as_nodes(parents)
            done.append(nodes.where("n = 1"))
        tops = stored(reduce(DataFrame.unionByName, done), "merkle-subroots")
        self.subroots = tops.select("tree", F.col("hash").alias("subroot"))

        nodes = tops.select(
            F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), "of_tree", "of_level", "of_idx",
            "hash", "low", "high", F.lit(trees).cast("long").alias("n"),
        )
        for _ in range(_height(trees)):
            parents = stored(_level(nodes), "merkle-top")
            links.append(_linked(parents))
            nodes = _as_nodes(parents)
        last = nodes.where("n = 1").select("of_tree", "of_level", "hash").first()
        self.root, self.at = (last["hash"], (last["of_tree"], last["of_level"])) if last else (None, (TOP, 0))
        self.nodes = stored(reduce(DataFrame.unionByName, links), "merkle-nodes") if links else None

    def climbed(self, changed: bool = True) -> DataFrame:
        """(from_tree, from_run, folded, siblings) at the root; ``folded`` starts from tampered leaves if ``changed``."""
        own = (lambda m: F.coalesce(m["tampered"], m["leaf"])) if changed else (lambda m: m["leaf"])
        hashes = F.transform("members", lambda m: m["leaf"])
        fold = lambda m, i: sha(F.concat(*_beside(hashes, i, own(m))))
        folded = F.when(F.col("total") == 1, F.transform("members", own)).otherwise(F.transform("members", fold))
        runs = self.runs.select("tree", "run", F.floor(F.col("low") / BLOCK).alias("block"), folded.alias("folded"))
        if self.nodes is None:
            return runs.select(F.col("tree").alias("from_tree"), F.col("run").alias("from_run"), "folded", F.lit("").alias("siblings"))
        spark = runs.sparkSession
        names = {"runs": f"runs_{uuid.uuid4().hex}", "nodes": f"nodes_{uuid.uuid4().hex}"}
        runs.createOrReplaceTempView(names["runs"])
        self.nodes.createOrReplaceTempView(names["nodes"])
        limit = "spark.sql.cteRecursionRowLimit"  # counts rows of all steps; the steps are bounded by the levels
        before = spark.conf.get(limit, None)
        spark.conf.set(limit, "-1")
        try:
            return stored(spark.sql(_CLIMB.format(**names, tree=self.at[0], level=self.at[1])), "merkle-climbed")
        finally:
            spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
            for name in names.values():
                spark.catalog.dropTempView(name)

    def proofs(self, changed: bool = True) -> DataFrame:
        """Per leaf: doc_id, leaf, subroot, root, siblings from the leaf's run up to the root, folded_root, verified."""
        hashes = F.transform("members", lambda m: m["leaf"])
        rows = self.runs.join(self.climbed(changed), (F.col("tree") == F.col("from_tree")) & (F.col("run") == F.col("from_run")))
        rows = rows.select("tree", hashes.alias("hashes"), "folded", "siblings", F.posexplode("members").alias("at", "member"))
        beside = _beside(F.col("hashes"), F.col("at"), F.lit(""))
        rows = rows.join(self.subroots, "tree")
        return rows.select(
            F.col("member.doc_id").alias("doc_id"),
            F.col("member.leaf").alias("leaf"),
            "subroot",
            F.lit(self.root).cast("string").alias("root"),
            F.concat(*beside, F.col("siblings")).alias("siblings"),
            F.get("folded", F.col("at")).alias("folded_root"),
            (F.get("folded", F.col("at")) == F.lit(self.root).cast("string")).alias("verified"),
        )


def _beside(hashes: Column, at: Column, own: Column) -> tuple[Column, Column, Column]:
    """The hashes before place ``at`` (from 0), ``own``, the hashes after it."""
    return F.array_join(F.slice(hashes, F.lit(1), at), ""), own, F.array_join(F.slice(hashes, at + 2, F.lit(ARITY)), "")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row, after the tamper test."""
    rows = Manifest(docs).proofs()
    return rows.select("doc_id", "leaf", "subroot", "root", sha(F.col("siblings")).alias("proof_sha256"), "folded_root", "verified")


def changed_documents(spark: SparkSession, manifest: Manifest, docs: DataFrame) -> DataFrame:
    """Ids whose rows in ``docs`` no longer have a leaf of the stored manifest: what an audit of a later copy reports."""
    known = manifest.runs.select(F.explode("members").alias("m")).select(F.col("m.doc_id").alias("__id"), F.col("m.leaf").alias("__leaf")).distinct()
    now = leaves(docs).select("doc_id", "leaf")
    return now.join(known, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("leaf") == F.col("__leaf")), "left_anti").select("doc_id").distinct()


ORACLE = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    -- crc32 bit by bit
    xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b:
      list_reduce(range(8)::BIGINT[], lambda r, i: xor(r >> 1, 3988292384 * (r & 1)), xor(c, b)), 4294967295::BIGINT), 4294967295) % 5 = 0 AS chosen
  FROM documents
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN chosen THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
  FROM fields
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), up AS (
  SELECT tree, 0 AS level, idx, leaf AS hash, n FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), (any_value(n) + 15) // 16 FROM up WHERE n > 1 GROUP BY tree, level, idx // 16
), subroots AS (
  SELECT tree, hash AS subroot, (SELECT count(DISTINCT tree) FROM placed) AS n FROM up WHERE n = 1
), top AS (
  SELECT 0 AS level, tree AS idx, subroot AS hash, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), (any_value(n) + 15) // 16 FROM top WHERE n > 1 GROUP BY level, idx // 16
), runs AS (
  SELECT tree, level, idx // 16 AS run, list(hash ORDER BY idx) AS hashes FROM up WHERE n > 1 GROUP BY tree, level, idx // 16
), top_runs AS (
  SELECT level, idx // 16 AS run, list(hash ORDER BY idx) AS hashes FROM top WHERE n > 1 GROUP BY level, idx // 16
), climb AS (
  SELECT row_number() OVER () AS row, doc_id, tree, leaf, 0 AS level, idx, n, coalesce(tampered, leaf) AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT row, doc_id, c.tree, leaf, c.level + 1, idx // 16, (n + 15) // 16,
    sha256(array_to_string(list_concat(hashes[:idx % 16], [folded], hashes[idx % 16 + 2:]), '')),
    proof || array_to_string(list_concat(hashes[:idx % 16], hashes[idx % 16 + 2:]), '')
  FROM climb c JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.idx // 16 WHERE n > 1
), climb_top AS (
  SELECT row, doc_id, c.tree, leaf, subroot, 0 AS level, c.tree AS idx, s.n, folded, proof FROM climb c JOIN subroots s ON s.tree = c.tree WHERE c.n = 1
  UNION ALL
  SELECT row, doc_id, tree, leaf, subroot, c.level + 1, idx // 16, (n + 15) // 16,
    sha256(array_to_string(list_concat(hashes[:idx % 16], [folded], hashes[idx % 16 + 2:]), '')),
    proof || array_to_string(list_concat(hashes[:idx % 16], hashes[idx % 16 + 2:]), '')
  FROM climb_top c JOIN top_runs r ON r.level = c.level AND r.run = c.idx // 16 WHERE n > 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM climb_top CROSS JOIN (SELECT hash AS root FROM top WHERE n = 1) WHERE n = 1
"""
