"""Equi-joins. Sizes decide the strategy; nothing is broadcast on faith."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a ``right`` without keys that hold very many of its rows.

    Spark broadcasts ``right`` if its measured size allows; otherwise both sides
    are shuffled and a hot key of ``left`` is split at run time.
    """
    return left.join(right, list(on), "left")


def sketch_of(on: Sequence[str], share: float) -> Column:
    """An aggregate: hashes of the keys that may hold over ``share`` of the rows, and how many rows each holds."""
    k = int(1 / share)
    tracked = min(max(16 * k, 1024), 1_000_000)
    return F.expr(f"approx_top_k(xxhash64({', '.join(f'`{c}`' for c in on)}), {k}, {tracked})")


def heavy_keys(df: DataFrame, on: Sequence[str], share: float) -> list[int]:
    """Hashes of the keys that hold over ``share`` of the rows of ``df``, NULLs aside.

    One scan of the key columns with a sketch of frequent items in each task;
    at most 1 / share hashes reach the driver. A key just above the share may be
    missed and one just below it be named: both only cost time.
    """
    known = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in on))
    found = known.agg(sketch_of(on, share).alias("top"), F.count("*").alias("n")).first()
    return [item["item"] for item in found["top"] if item["count"] > share * found["n"]]


def left_join_skewed(
    left: DataFrame, right: DataFrame, on: Sequence[str], share: float = 0.01, salts: int = 32
) -> DataFrame:
    """Left join to a ``right`` of which a few keys may hold very many rows.

    A left join can only split hot keys of its left side. The keys that are hot
    on the right are found first, and only their rows are joined by (key, salt):
    right rows are dealt over ``salts``, left rows are copied for each. As these
    keys have matches, that is an inner join; all other rows take the plain one.
    """
    on = list(on)
    hot = heavy_keys(right, on, share)
    if not hot:
        return left_join(left, right, on)
    is_hot = F.coalesce(F.xxhash64(*on).isin(*hot), F.lit(False))
    own = F.pmod(F.xxhash64(*right.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    dealt = right.where(is_hot).withColumn("_salt", own)
    copied = left.where(is_hot).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    matched = copied.join(dealt, [*on, "_salt"]).drop("_salt")
    # A left row whose hash is that of a hot key but whose key is another has no partner there.
    keys = right.where(is_hot).select(*on).distinct()
    apart = left.where(is_hot).join(F.broadcast(keys), on, "left_anti")
    rest = left_join(left.where(~is_hot), right.where(~is_hot), on)
    return rest.unionByName(matched).unionByName(apart, allowMissingColumns=True)


def lookup_join(
    df: DataFrame,
    dimension: DataFrame,
    column: str,
    key: str,
    take: dict[str, str],
) -> DataFrame:
    """Add columns of a lookup table: ``take`` is {lookup column: new name}."""
    renamed = dimension.select(
        F.col(key).alias("_lookup_key"), *[F.col(src).alias(dst) for src, dst in take.items()]
    )
    return df.join(renamed, F.col(column) == F.col("_lookup_key"), "left").drop("_lookup_key")


def inner_by_null_reject(
    left: DataFrame, right: DataFrame, on: Sequence[str], required: str
) -> DataFrame:
    """Left join whose result must have ``required``; Spark plans an inner join."""
    return left.join(right, list(on), "left").filter(F.col(required).isNotNull())


def new_periods(incoming: DataFrame, loaded: DataFrame | Collection[str], period: str) -> DataFrame:
    """Rows of ``incoming`` whose period has not been loaded yet.

    ``loaded`` is a table that holds periods, or the periods themselves (from a
    part table's record, say): then no stored row is read.
    """
    if isinstance(loaded, DataFrame):
        return incoming.join(loaded.select(period).distinct(), period, "left_anti")
    return incoming.where(~F.coalesce(F.col(period).isin(*loaded), F.lit(False))) if loaded else incoming
