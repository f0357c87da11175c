"""Gradient-boosted regression trees for every key at once, stored as rows.

One group grows one ensemble, so ensembles of sites and steps grow in parallel and none waits for a driver loop. A group's
rows are one series, whose length the time grid bounds. Feature values are put into bins by quantile once; a tree grows level by level from
sums of gradients per node, feature and bin.

An ensemble is a table of nodes: tree 0 is a single leaf with the mean; a row of an inner node names its feature (a place in the
inputs), its cut and its children, a leaf its value. Rows whose value is below the cut go left; others, also nulls, go right.

Scores are sums over trees, so neither the rows nor the nodes of a key need to be in one place: both are dealt to parts of bounded size,
every part of the rows meets every part of the trees, and the sums of the parts are added up per row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.linear import _key_types
from wattloom.session import stored

NODE = "tree int, node int, feature int, cut double, left int, right int, value double"
NODE_COLUMNS = ["tree", "node", "feature", "cut", "left", "right", "value"]
BINS = 256
# Nodes of a key, and rows of it, that meet in one group, about; a tree's nodes stay together.
PART_NODES = 65_536
PART_ROWS = 65_536
# Pairs of a row and a tree that are walked together.
PAIRS = 65_536


def bin_edges(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Cuts of a feature, ascending: every value but the smallest where they are few, else values at even ranks."""
    distinct = np.unique(values)
    if len(distinct) > bins:
        ranks = np.quantile(values, np.arange(1, bins) / bins, method="higher")
        distinct = np.unique(np.append(distinct[0], ranks))
    return distinct[1:]


def grow_trees(
    x: np.ndarray, y: np.ndarray, trees: int, rate: float, depth: int, bins: int = BINS, l2: float = 1.0
) -> Iterator[tuple[int, int, int, float, int, int, float]]:
    """Rows ``(tree, node, feature, cut, left, right, value)``; feature, left and right are -1 in leaves.

    Squared error. A split maximises G_l^2/(n_l+l2) + G_r^2/(n_r+l2) - G^2/(n+l2), ties go to the first feature and the lowest cut; no
    split is made without a gain. A leaf gives ``rate * -G/(n+l2)``.
    """
    base = float(y.mean())
    yield 0, 1, -1, 0.0, -1, -1, base
    edges = [bin_edges(column, bins) for column in x.T]
    # every feature has room for as many bins as the largest
    width = 1 + max(map(len, edges), default=0)
    place = np.column_stack([np.searchsorted(e, column, side="right") for e, column in zip(edges, x.T, strict=True)])
    features = place.shape[1]
    slot = place + np.arange(features) * width
    error = base - y
    for tree in range(1, trees + 1):
        node, rows, names = np.zeros(len(y), np.int64), np.arange(len(y)), np.ones(1, np.int64)
        for level in range(depth + 1):
            parts = len(names)
            count, total = np.bincount(node, minlength=parts), np.bincount(node, error[rows], parts)
            split = np.zeros(parts, bool)
            if level < depth and width > 1:
                at = (node[:, None] * (features * width) + slot[rows]).ravel()
                shape = (parts, features, width)
                n = np.bincount(at, minlength=parts * features * width).reshape(shape).cumsum(axis=2, dtype=float)
                g = np.bincount(at, np.repeat(error[rows], features), parts * features * width).reshape(shape).cumsum(axis=2)
                # nothing on one side: no more than the node itself has, so no gain
                own = total**2 / (count + l2)
                gain = (total[:, None, None] - g) ** 2
                gain /= (count + l2)[:, None, None] - n
                g *= g
                n += l2
                g /= n
                gain += g
                gain = gain.reshape(parts, -1)
                best = gain.argmax(axis=1)
                found = gain[np.arange(parts), best] - own
                split = found > 1e-9 * (own + (error[rows] ** 2).max(initial=0.0))
            by, cut = np.divmod(best, width) if split.any() else (split, split)
            for i in np.flatnonzero(split):
                yield tree, int(names[i]), int(by[i]), float(edges[by[i]][cut[i]]), 2 * int(names[i]), 2 * int(names[i]) + 1, 0.0
            value = -rate * total / (count + l2)
            for i in np.flatnonzero(~split):
                yield tree, int(names[i]), -1, 0.0, -1, -1, float(value[i])
            ends = ~split[node]
            error[rows[ends]] += value[node[ends]]
            if not split.any():
                break
            rows, node = rows[~ends], node[~ends]
            right = place[rows, by[node]] > cut[node]
            # children of the nodes that were split, in the order of their names
            node = 2 * (np.cumsum(split) - 1)[node] + right
            names = np.column_stack([2 * names[split], 2 * names[split] + 1]).ravel()


def fit(
    table: DataFrame, keys: list[str], inputs: Sequence[str], label: str, order: Sequence[str], trees: int, rate: float, depth: int,
    bins: int = BINS, min_rows: int = 2,
) -> DataFrame:
    """``(keys, tree, node, feature, cut, left, right, value)`` of every key with ``min_rows`` rows that lack nothing.

    ``order`` fixes the order of a key's rows, so that reruns add the same numbers in the same order.
    """
    columns = [*keys, *NODE_COLUMNS]
    numbers = [F.col(c).cast("double").alias(c) for c in dict.fromkeys([*inputs, label]) if c not in order]
    used = table.na.drop("any", subset=[*inputs, label]).select(*keys, *order, *numbers)
    # growing takes far longer than its few rows suggest: many small partitions, which are not to be merged
    used = used.repartition(max(8, 4 * int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches).sort_values([*order, *inputs, label])
        if len(rows) >= min_rows:
            found = grow_trees(rows[list(inputs)].to_numpy(float), rows[label].to_numpy(float), trees, rate, depth, bins)
            nodes = pd.DataFrame(list(found), columns=columns[len(keys) :])
            for name, value in reversed(list(zip(keys, key, strict=True))):
                nodes.insert(0, name, value)
            yield nodes

    grown = used.groupBy(*keys).applyInPandas(run, f"{_key_types(table, keys)}, {NODE}")
    return grown.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in ("feature", "left", "right")}).withColumn(
        "cut", F.when(F.col("feature").isNotNull(), F.col("cut"))
    )


def fit_or_reuse(table: DataFrame, keys: list[str], known: DataFrame | None, **how) -> DataFrame:
    """Stored ensembles where a key has one; only the keys without are fitted. ``how`` as in :func:`fit`."""
    if known is None:
        return fit(table, keys, **how)
    missing = table.join(known.where("tree = 0").select(*keys), keys, "left_anti")
    return known.unionByName(fit(missing, keys, **how))


def _linked(nodes: pa.Table) -> tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the trees' first nodes, the depth, and by place the feature, cut, children (left after right) and value.

    What no row goes on from, a leaf or a child that is not there, is its own child; the latter is the last place, of value 0.
    """
    for c in ("tree", "node"):
        if nodes[c].null_count:
            raise ValueError(f"nodes without a {c}")
    tree, name = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    order = np.lexsort((name, tree))
    # of nodes that come twice the later one
    last = np.append((np.diff(tree[order]) != 0) | (np.diff(name[order]) != 0), True)
    order = order[last]
    nodes, name = nodes.take(order), name[order].astype(np.int64)
    numbers, rank = np.unique(tree[order], return_inverse=True)
    ids = (rank << 32) + name

    def place(ranks: np.ndarray, names: np.ndarray | int) -> np.ndarray:
        wanted = (ranks << 32) + names
        at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
        return np.where(ids[at] == wanted, at, len(ids))

    feature = np.append(nodes["feature"].fill_null(-1).to_numpy(), -1).astype(np.intp)
    cut, value = (np.append(nodes[c].fill_null(0.0).to_numpy(), 0.0) for c in ("cut", "value"))
    child = np.repeat(np.arange(len(feature)), 2)
    for side, c in enumerate(("right", "left")):
        child[side:-2:2] = place(rank, nodes[c].fill_null(0).to_numpy().astype(np.int64))
    inner = feature >= 0
    child[np.repeat(~inner, 2)] = np.repeat(np.flatnonzero(~inner), 2)
    first = place(np.arange(len(numbers)), 1)
    depth, level = 0, first
    while depth < len(ids) and inner[level].any():
        level = level[inner[level]]
        level = np.unique(np.concatenate([child[2 * level], child[2 * level + 1]]))
        depth += 1
    return first, depth, feature, cut, child, value


def _walk(x: np.ndarray, nodes: pa.Table) -> np.ndarray:
    """Sums over the trees of the leaves that rows reach."""
    first, depth, feature, cut, child, value = _linked(nodes)
    if feature.max() >= x.shape[1]:
        raise IndexError(f"feature {feature.max()} of {x.shape[1]} inputs")
    feature = np.maximum(feature, 0)
    out, step = np.empty(len(x)), max(1, PAIRS // len(first))
    for low in range(0, len(x), step):
        part = x[low : low + step]
        row = np.arange(len(part))[:, None] * x.shape[1]
        at = np.broadcast_to(first, (len(part), len(first)))
        for _ in range(depth):
            goes_left = part.take(feature.take(at) + row) < cut.take(at)  # not for NaN
            at = child.take(2 * at + goes_left)
        out[low : low + step] = value.take(at).sum(axis=1)
    return out


def predict(rows: DataFrame, trees: DataFrame, keys: list[str], inputs: Sequence[str], name: str = "prediction") -> DataFrame:
    """``rows`` of the keys that have an ensemble, with ``name``.

    Rows are stored first, so that their numbers hold; ``trees`` is read twice, to count and to score, and should be stored.
    """
    numbered = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "scored-rows")
    own, places = [f"_key_{i}" for i in range(len(keys))], [f"_x_{i}" for i in range(len(inputs))]
    named = [F.col(k).alias(o) for k, o in zip(keys, own, strict=True)]
    given = numbered.select(*named, "_row", *[F.col(c).cast("double").alias(p) for c, p in zip(inputs, places, strict=True)])
    nodes = trees.select(*named, *NODE_COLUMNS)

    def parts(table: DataFrame, most: int, part: str) -> DataFrame:
        return table.groupBy(*own).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(part))

    def by_key(table: DataFrame, other: DataFrame) -> DataFrame:
        """Keys that are null agree."""
        there = other.withColumnsRenamed({o: f"{o}_" for o in own})
        same = [F.col(o).eqNullSafe(F.col(f"{o}_")) for o in own]
        return table.join(there, reduce(and_, same)).drop(*[f"{o}_" for o in own])

    def dealt(table: DataFrame, by: str, part: str, other: str) -> DataFrame:
        """A part for each row of ``table``, and a copy for each part of the other side."""
        held = by_key(table, sizes).withColumn(part, F.pmod(F.xxhash64(by), part).cast("int"))
        return held.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).groupBy(*own, "_rows", "_trees")

    sizes = stored(by_key(parts(given, PART_ROWS, "_rows"), parts(nodes, PART_NODES, "_trees")), "score-parts")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        found = left.select(["_row", "_trees"])
        if not (left.num_rows and right.num_rows):
            return found.slice(0, 0).append_column("_sum", pa.array([], pa.float64()))
        x = np.column_stack([left[p].to_numpy() for p in places])
        return found.append_column("_sum", pa.array(_walk(x, right)))

    met = dealt(given, "_row", "_rows", "_trees").cogroup(dealt(nodes, "tree", "_trees", "_rows"))
    sums = met.applyInArrow(score, "_row long, _trees int, _sum double").groupBy("_row")
    # in the order of the parts, so that reruns add the same numbers in the same order
    ordered = sums.agg(F.array_sort(F.collect_list(F.struct("_trees", "_sum"))).alias("_sums"))
    total = F.aggregate("_sums", F.lit(0.0), lambda so_far, part: so_far + part["_sum"])
    return numbered.join(ordered.select("_row", total.alias(name)), "_row").drop("_row")
