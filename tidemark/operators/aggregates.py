"""Counts, sums and unions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def count_rows(df: DataFrame, keys: Sequence[str], into: str) -> DataFrame:
    """``COUNT(*)`` per key; no keys gives the whole table's count."""
    return df.groupBy(*keys).agg(F.count("*").alias(into))


def count_present(df: DataFrame, keys: Sequence[str], column: str, into: str) -> DataFrame:
    """``COUNT(column)`` per key: NULLs are not counted."""
    return df.groupBy(*keys).agg(F.count(column).alias(into))


def sum_by(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Sums per key, as {new name: column}; a NULL key is a group of its own."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(name) for name, c in sums.items()])


def union_tagged(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """``UNION ALL`` by column name, each part marked in column ``tag``."""
    return union_all(df.select(F.lit(label).alias(tag), "*") for label, df in parts.items())


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
