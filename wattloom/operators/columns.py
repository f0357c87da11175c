"""Projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Project to the given columns under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def const_column(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def align_columns(df: DataFrame, wanted: Sequence[str], fill: object = 0) -> DataFrame:
    """Exactly the wanted columns in their order: missing ones filled, extra ones dropped."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in wanted])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a fixed schema in its order and types, null where absent."""
    present = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop what is there; names that are absent do not matter."""
    return df.drop(*names)


def cast_numeric(df: DataFrame, columns: Sequence[str], to: str = "double") -> DataFrame:
    return df.withColumns({c: F.col(c).cast(to) for c in columns})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def other_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType)]


def select_by_type(df: DataFrame, numeric: bool = True) -> DataFrame:
    return df.select(*(numeric_columns(df) if numeric else other_columns(df)))
