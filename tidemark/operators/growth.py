"""Change against the previous report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import guarded_divide
from tidemark.session import settled


def growth_vs_prev(
    df: DataFrame,
    entity: Sequence[str],
    period: str,
    value: str,
    into: str,
    base: str = "current",
) -> DataFrame:
    """Add the growth of ``value`` since the entity's previous row.

    Growth is divided by the current value, or with ``base='previous'`` by the
    previous one. The first period gives NULL, a zero divisor gives 0, and gaps
    in the calendar are skipped. ``df`` must hold one row per entity and period,
    so an entity's window is no longer than the number of reports ever made.
    """
    before = F.lag(value, 1).over(_timeline(entity, period))
    return df.withColumn(into, _growth(df, value, before, base))


def growth_vs_prev_bucketed(
    df: DataFrame,
    entity: Sequence[str],
    period: str,
    value: str,
    into: str,
    base: str = "current",
) -> DataFrame:
    """``growth_vs_prev`` for entities with too many rows for one task.

    Rows are dealt by range of entity and period, and compared inside their
    partition. The first row that an entity has in a partition takes its
    predecessor from the entity's last row in the partition before, found on one
    row per entity and partition. No window is longer than a partition, or than
    the number of partitions.
    """
    entity = list(entity)
    order = F.col(period).asc_nulls_last()
    dealt = settled(df.repartitionByRange(*entity, order).withColumn("_part", F.spark_partition_id()))
    late = F.struct(F.col(period).isNull().alias("none"), F.col(period).alias("day"))
    last = dealt.groupBy(*entity, "_part").agg(F.max_by(F.struct(value), late).alias("_last"))
    before_part = F.lag("_last", 1).over(Window.partitionBy(*entity).orderBy("_part"))[value]
    carried = last.select(
        *[F.col(c).alias(f"_e{i}") for i, c in enumerate(entity)], F.col("_part").alias("_p"), before_part.alias("_carried")
    )
    within = Window.partitionBy(*entity, "_part").orderBy(order)
    rows = dealt.withColumn("_before", F.lag(F.struct(value), 1).over(within))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(entity):
        same &= F.col(c).eqNullSafe(F.col(f"_e{i}"))
    before = F.when(F.col("_before").isNull(), F.col("_carried")).otherwise(F.col("_before")[value])
    grown = rows.join(carried, same, "left").withColumn(into, _growth(df, value, before, base))
    return grown.drop("_part", "_p", "_before", "_carried", *[f"_e{i}" for i in range(len(entity))])


def _timeline(entity: Sequence[str], order: str):
    return Window.partitionBy(*entity).orderBy(F.col(order).asc_nulls_last())


def _growth(df: DataFrame, value: str, before: Column, base: str) -> Column:
    current = F.col(value)
    divisor = {"current": current, "previous": before}[base]
    kind = df.schema[value].dataType
    if isinstance(kind, T.DecimalType) and kind.scale:
        # Whole numbers on both sides of the division keep ratios such as
        # exactly 5 % on their side of a tier boundary.
        scale = F.lit(10**kind.scale)
        return guarded_divide((current - before) * scale, divisor * scale)
    return guarded_divide(current - before, divisor)
