"""Where queries are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale, read on demand: ``tables.orders``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``, with its SQL."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Tables(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Result columns both engines print alike: decimals as doubles, times as text."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        columns.append(value.alias(field.name))
    return df.select(*columns)
