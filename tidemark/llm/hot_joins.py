"""Joins to a side with one row a key, where some keys hold very many rows of the other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: A key is hot from one in so many rows on; so there are at most as many hot keys.
HOT = 4096


def join_by_weight(left: DataFrame, right: DataFrame, on: Sequence[str], weight: str) -> DataFrame:
    """Inner join of ``left`` to ``right``; null keys match each other.

    ``right`` has one row a key, and its ``weight`` says how many rows of
    ``left`` have that key. Keys with over one in ``HOT`` of all rows, of which
    there are fewer than ``HOT``, are broadcast, so their rows stay where they
    are; the other keys join by hash, and none of them can be hot. Both sides
    are read twice, so they should be settled.
    """
    names = [f"_key_{i}" for i in range(len(on))]
    keyed = right.select(*[F.col(c).alias(k) for c, k in zip(on, names)], *[c for c in right.columns if c not in on])
    same = reduce(Column.__and__, [left[c].eqNullSafe(F.col(k)) for c, k in zip(on, names)])
    total = right.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    hot = F.broadcast(keyed.where(F.col(weight) * HOT > total))
    cold = keyed.where(F.col(weight) * HOT <= total)
    rest = left.join(hot.select(*names), same, "left_anti")
    return left.join(hot, same).drop(*names).unionByName(rest.join(cold.hint("merge"), same).drop(*names))
