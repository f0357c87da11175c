"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations alone.

Every source has a budget of words. Whole epochs of a source come first; the rest of the budget is filled by a weighted
sample without replacement: a document's key is an exponential variable divided by its quality weight, documents are
taken in key order, and the prefix sum of their sizes decides where the budget ends.

A source may own a third of all rows, so its documents are never sorted in one task. Keys fall into ``BINS`` ordered bins; sums
per source and bin tell in which single bin the budget ends, and only that bin's documents are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattloom.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
CAP = 2
BINS = 4096
# Characters that prose uses rarely; their share lowers a document's quality weight.
MARKS = "#$%&*!|"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """Between 0.05 and 1: falls with the share of marks among the characters; 1 for empty and null texts."""
    marks = F.regexp_count(text, F.lit(f"[{MARKS}]"))
    share = marks / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.05), 1.0 - 4.0 * share), F.lit(1.0))


def order_key(doc_id: Column, text: Column, weight: Column) -> tuple[Column, Column]:
    """The sampling key and the digest it comes from: the same for the same document in every run."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary"))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 1).cast("double") / F.lit(float(2**52 + 1))
    return -F.log(uniform) / weight, digest


def weighed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` with source, size, sampling key, its digest and its bin."""
    key, digest = order_key(F.col("doc_id"), F.col("text"), quality(F.col("text")))
    sized = docs.select(
        *columns, F.col("doc_id").alias("__id"), F.col("source").alias("__source"), n_words(F.col("text")).alias("__size"), key.alias("__key"), digest.alias("__digest")
    )
    last = F.lit(BINS - 1)
    return sized.withColumn("__bin", F.least(last, F.floor(F.col("__key") / (1 + F.col("__key")) * BINS)).cast("int"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, cap: int = CAP) -> DataFrame:
    """Words per source: (source, source_size) in, with ``target`` out.

    Sources by code point, null last, weigh ``weights`` in turn and share ``total`` of all words; no target exceeds ``cap``
    times its source, and the excess is shared by weight among the others. Resharing ends where every target is the
    smaller of its ceiling and one common level times its weight, so the level is read off the sources ordered by
    ceiling over weight. One row per source: the windows over all of them see nothing else.
    """
    every = Window.partitionBy()
    ordered = Window.orderBy("__ratio", "__rank")
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("__rank") - 1) % len(weights) + 1).cast("int")).cast("long")
    out = (
        sizes.withColumn("__rank", rank)
        .withColumn("__weight", weight)
        .withColumn("__ratio", (F.col("source_size") * cap).cast("double") / F.col("__weight"))
        .withColumn("__budget", F.sum("source_size").over(every) * F.lit(total))
        .withColumn("__capped", F.coalesce(F.sum(F.col("source_size") * cap).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("__open", F.sum("__weight").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("__level", (F.col("__budget") - F.col("__capped")) / F.col("__open"))
    )
    level = F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "__rank", "__level"))).over(every)["__level"]
    ceiling = (F.col("source_size") * cap).cast("double")
    out = out.withColumn("__at", level)
    target = F.when(F.col("__at").isNull(), ceiling).otherwise(F.least(ceiling, F.col("__at") * F.col("__weight")))
    return out.select("source", "source_size", target.alias("target"))


def budgets(weighed_docs: DataFrame) -> DataFrame:
    """One row per source: target, whole epochs, the rest of the budget, and the bin where it ends."""
    cells = stored(weighed_docs.groupBy("__source", "__bin").agg(F.sum("__size").alias("__cell")), "mix-cells")
    sizes = cells.groupBy(F.col("__source").alias("source")).agg(F.sum("__cell").cast("long").alias("source_size"))
    per_source = stored(targets(sizes), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    per_source = per_source.withColumn("__epochs", epochs).withColumn("__rest", F.col("target") - F.col("__epochs") * F.col("source_size"))
    before = F.sum("__cell").over(Window.partitionBy("__source").orderBy("__bin")) - F.col("__cell")  # BINS rows per source
    ends = (
        cells.withColumn("__before", before)
        .join(per_source.select(F.col("source").alias("__of"), "__rest"), F.col("__source").eqNullSafe(F.col("__of")))
        .where((F.col("__before") <= F.col("__rest")) & (F.col("__rest") < F.col("__before") + F.col("__cell")))
        .select(F.col("__source").alias("__at"), F.col("__bin").alias("__end"), "__before")
    )
    joined = per_source.join(ends, F.col("source").eqNullSafe(F.col("__at")), "left").drop("__at")
    renamed = joined.withColumnsRenamed({"source": "__of", "source_size": "__source_size", "target": "__target"})
    return stored(renamed, "mix-budgets")


def drawn(weighed_docs: DataFrame, per_source: DataFrame) -> DataFrame:
    """``weighed_docs`` with how often each document is taken (``__times``) and its source's figures.

    Documents of bins before the end are taken once more than the epochs say, those after it are not; the documents of the
    end bin are taken in key order as long as the middle of the document lies within the budget, so the words taken miss
    the target by half a document at most. Ties in the key are broken by id, size and digest.
    """
    rows = weighed_docs.join(per_source, F.col("__source").eqNullSafe(F.col("__of"))).drop("__of")
    at_end = F.coalesce(F.col("__bin") == F.col("__end"), F.lit(False))
    whole = rows.where(~at_end).withColumn("__once", F.coalesce(F.col("__bin") < F.col("__end"), F.lit(False)).cast("long"))
    order = Window.partitionBy("__source").orderBy("__key", F.col("__id").asc_nulls_last(), "__size", "__digest")
    until = F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = rows.where(at_end).withColumn("__until", until + F.col("__before"))
    once = (2 * F.col("__until") - F.col("__size") <= 2 * F.col("__rest")).cast("long")
    ends = ends.withColumn("__once", once).drop("__until")
    return whole.unionByName(ends).withColumn("__times", F.col("__epochs") + F.col("__once"))


def mix(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken (words, repeats counted).

    Null texts have no words, null sources are one source, repeated rows are documents of their own; an empty table
    gives an empty result.
    """
    rows = stored(weighed(docs), "mix-rows")
    out = drawn(rows, budgets(rows))
    return out.select(
        F.col("__id").alias("doc_id"),
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.col("__times")).alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, each repeated as often as it is taken."""
    rows = weighed(docs, *docs.columns)
    per_source = budgets(weighed(docs))
    out = drawn(rows, per_source).where(F.col("__times") > 0)
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*docs.columns)


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS digest,
         CASE WHEN text IS NULL THEN 1.0::DOUBLE ELSE greatest(0.05::DOUBLE, 1.0::DOUBLE - 4.0::DOUBLE *
           ((length(text) - length(translate(text, '{MARKS}', '')))::DOUBLE / greatest(length(text), 1))) END AS weight
  FROM documents),
k AS (SELECT *, -ln((('0x' || substr(digest, 1, 13))::BIGINT + 1)::DOUBLE / {float(2**52 + 1)!r}::DOUBLE) / weight AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk FROM s),
w AS (SELECT *, CASE (rnk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM r),
o AS (SELECT *, (source_size * 2)::DOUBLE / weight AS ratio, sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS budget FROM w),
l AS (SELECT *, (budget - coalesce(sum(source_size * 2) OVER (ORDER BY ratio, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / (sum(weight) OVER (ORDER BY ratio, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM o),
f AS (SELECT level AS common_level FROM l WHERE level <= ratio ORDER BY ratio, rnk LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN (SELECT common_level FROM f) IS NULL THEN (source_size * 2)::DOUBLE
        ELSE least((source_size * 2)::DOUBLE, (SELECT common_level FROM f) * weight) END AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
        sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ASC NULLS LAST, k.size, k.digest
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN 2 * until - size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
