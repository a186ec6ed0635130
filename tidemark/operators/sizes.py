"""Storage accounting: bytes per row, per period and per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# Bytes of a stored row's header and of each fixed-width type.
ROW_HEADER_BYTES = 24
TYPE_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def _value_bytes(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    width = TYPE_WIDTHS.get(type(field.dataType))
    if width is not None:
        size = F.lit(width)
    elif isinstance(field.dataType, T.DecimalType):
        # Two bytes per four digits, as variable-length numerics are stored.
        size = F.lit(2 * -(-field.dataType.precision // 4))
    elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    else:
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
    return F.when(value.isNotNull(), size).otherwise(F.lit(0))


def row_bytes(df: DataFrame, header: int = ROW_HEADER_BYTES) -> Column:
    """Size of a row in bytes: a header, fixed widths, and text by its length."""
    return reduce(
        lambda a, b: a + b,
        [_value_bytes(f).cast("bigint") for f in df.schema.fields],
        F.lit(header).cast("bigint"),
    )


def row_bytes_by_period(df: DataFrame, period: str | Column, into: str = "bytes") -> DataFrame:
    """Total row bytes of every report period (a column or an expression)."""
    key = F.col(period) if isinstance(period, str) else period
    return df.groupBy(key.alias("period")).agg(F.sum(row_bytes(df)).alias(into))


def average_of(df: DataFrame, value: str, into: str) -> DataFrame:
    """One-row average of an already summed column."""
    return df.agg(F.avg(value).alias(into))


def average_by_key(df: DataFrame, key: str, into: str = "avg_bytes") -> DataFrame:
    """Average row bytes of each key."""
    return df.groupBy(key).agg(F.avg(row_bytes(df)).alias(into))
