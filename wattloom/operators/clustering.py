"""K-means for every key at once.

A key's points are its days, whose number the time grid bounds, so a group does all its rounds in place: one job and one
shuffle for all keys, whatever the number of rounds. The start is k-means++ with fixed draws: the next centre is the point with the largest
``ln(u) / d^2``, where ``d`` is its distance to the nearest centre so far and ``u`` a number in (0, 1) that the md5 of key, point and
draw gives. Reruns agree, and so does any engine that has md5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.operators.linear import _key_types

ROUNDS = 20


def draw(*names: Any) -> float:
    """A number in (0, 1) from the first eight hex digits of the md5 of the names, joined by colons."""
    digits = hashlib.md5(":".join(map(str, names)).encode()).hexdigest()[:8]
    return (int(digits, 16) + 0.5) / 2**32


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, points by centres."""
    return ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


def start(names: Sequence[str], x: np.ndarray, k: int, key: Any) -> np.ndarray:
    """The first centres; fewer than ``k`` where there are fewer different points."""
    nearest, chosen = np.ones(len(x)), []
    for j in range(k):
        if not (nearest > 0).any():
            break
        score = [np.log(draw(key, name, j)) / d if d > 0 else -np.inf for name, d in zip(names, nearest, strict=True)]
        chosen.append(int(np.argmax(score)))
        to_new = squares(x, x[chosen[-1:]])[:, 0]
        nearest = to_new if j == 0 else np.minimum(nearest, to_new)
    return x[chosen]


def lloyd(x: np.ndarray, centres: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Centres after at most ``rounds`` rounds; ties go to the first centre, a centre without points stays."""
    for _ in range(rounds):
        of = squares(x, centres).argmin(axis=1)
        moved = np.array([x[of == j].mean(axis=0) if (of == j).any() else c for j, c in enumerate(centres)])
        if (moved == centres).all():
            break
        centres = moved
    return centres


def fit(points: DataFrame, key: str, name: str, features: str, k: int, rounds: int = ROUNDS) -> DataFrame:
    """``(key, cluster, centroid)``: up to ``k`` centres of each key's points, ``features`` being arrays of one length."""
    columns = [key, "cluster", "centroid"]

    def run(keys: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches).sort_values("_name")
        x = np.array(rows["_x"].tolist(), float)
        centres = lloyd(x, start(rows["_name"].tolist(), x, k, keys[0]), rounds)
        yield pd.DataFrame([(keys[0], j, c.tolist()) for j, c in enumerate(centres)], columns=columns)

    used = points.select(key, F.col(name).cast("string").alias("_name"), F.col(features).alias("_x"))
    return used.groupBy(key).applyInPandas(run, f"{_key_types(points, [key])}, cluster int, centroid array<double>")


def _square(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d)


def assign(points: DataFrame, centres: DataFrame, key: str, features: str) -> DataFrame:
    """``points`` with the ``cluster`` of the nearest centre of their key; ties go to the first."""
    packed = centres.groupBy(key).agg(F.collect_list(F.struct("cluster", "centroid")).alias("_centres"))
    far = F.transform("_centres", lambda c: F.struct(_square(F.col(features), c["centroid"]).alias("d"), c["cluster"].alias("cluster")))
    return points.join(packed, key).withColumn("cluster", F.array_min(far)["cluster"]).drop("_centres")
