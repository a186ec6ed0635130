"""One row per version, per key, or per key and period."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import day_string


class Newest(NamedTuple):
    """Of which versions the newest of a key will be taken: those that lead by ``order``, then by scrape day."""

    keys: tuple[str, ...]
    order: tuple[str, ...] = ()


class Dealt(NamedTuple):
    """Versions will be stored in this many buckets of these keys."""

    buckets: int
    keys: tuple[str, ...]


def snapshot_distinct(
    df: DataFrame,
    columns: Sequence[str],
    scraped_at: str = "scraped_at",
    day_column: str | None = None,
    keep_day: str | None = None,
    then: Newest | Dealt | None = None,
) -> DataFrame:
    """One row per distinct version and scrape day.

    Only ``columns`` are read, and repeats are dropped before the shuffle, so a
    record scraped a billion times costs each task one row. The day is text;
    ``keep_day`` names a column for it as a date.

    ``then`` tells what follows, so that rows are shuffled once for both, by its
    keys. If that is ``latest_per_key`` by these keys, this order and the day,
    versions that it could not choose are dropped before the shuffle too. If the
    rows are dealt over buckets, repeats are dropped after it, in their bucket.
    """
    days = df.select(*columns, F.to_date(scraped_at).alias("_day"))
    if isinstance(then, Newest):
        days = leading_rows(days, then.keys, [*then.order, "_day"])
    elif then is not None:
        days = days.repartition(then.buckets, *then.keys)
    versions = days.distinct()
    typed = [F.col("_day").alias(keep_day)] if keep_day else []
    return versions.select(*columns, day_string("_day").alias(day_column or scraped_at), *typed)


def _newest_first(order: str | Column) -> Column:
    # NULL counts as the largest value, so it leads a descending order.
    return (F.col(order) if isinstance(order, str) else order).desc_nulls_first()


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    ts: str | Column,
    tiebreak: Sequence[str | Column] = (),
) -> DataFrame:
    """The newest row of every key.

    Filtering the row number lets Spark keep one candidate per key and task
    before the shuffle, so a hot key never gathers in one place. Without a
    ``tiebreak`` that settles equal timestamps, the winner among them is open.
    """
    return first_per_key(df, keys, [_newest_first(c) for c in (ts, *tiebreak)])


def leading_rows(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The rows of every key that are newest by ``order``, all of them if several are."""
    window = Window.partitionBy(*keys).orderBy(*[_newest_first(c) for c in order])
    rank = "_rank_of_row"
    return df.withColumn(rank, F.rank().over(window)).filter(F.col(rank) == 1).drop(rank)


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]
) -> DataFrame:
    """The first row of every key under ``order`` (``DISTINCT ON``)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    rank = "_row_of_key"
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)
