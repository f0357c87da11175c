"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name, repeats kept, absent columns null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left frame that the right one does not hold."""
    return left.select(*sorted(left.columns)).subtract(right.select(*sorted(right.columns)))
