"""Writers: append, full refresh, and write-audit-publish."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import require_key
from tidemark.sources.files import delete_folder, names_in


def _laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value, so that tasks do not each write every value.

    Adaptive execution cuts a large value into files of the advisory size and
    joins small ones; one period may hold all rows.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def append_load(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append to a table, laid out by report period where one is named."""
    _laid_out(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table's whole content."""
    (
        _laid_out(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table as it was written: folder names give partition values of the declared types, none guessed."""
    return spark.read.schema(schema).parquet(path)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's first partition column, from the names of its folders alone."""
    marks = [name for name in names_in(spark, path) if name.startswith(f"{column}=")]
    return sorted(name.partition("=")[2] for name in marks)


def publish_view(df: DataFrame, name: str) -> None:
    """Expose a DataFrame to SQL in this session."""
    df.createOrReplaceTempView(name)


def write_audit_publish(
    df: DataFrame,
    table: str,
    root: str,
    key: str | None = "dim_id",
    audit: Callable[[DataFrame], None] | None = None,
    partition_by: Sequence[str] = (),
    temporary: bool = False,
    keep: int = 2,
) -> DataFrame:
    """Write a new version of ``table``, audit what was written, then publish it.

    The table is a view over its newest audited version below ``root``, so
    publishing moves no data and readers see either the old version or the new
    one. If the write or the audit fails the new version is deleted, the view
    still shows the old one, and the exception is passed on. The newest ``keep``
    versions stay, for readers that began before; older ones are deleted.
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{table}"
    version = f"{folder}/version={time.time_ns():020d}-{uuid.uuid4().hex}"
    try:
        _laid_out(df, partition_by).write.mode("errorifexists").partitionBy(*partition_by).parquet(version)
        written = read_typed(spark, version, df.schema)
        if key is not None:
            require_key(written, key)
        if audit is not None:
            audit(written)
    except Exception:
        delete_folder(spark, version)
        raise
    if temporary:
        publish_view(written, table)
    else:
        _publish(spark, table, version, df.schema, partition_by)
    for old in [n for n in names_in(spark, folder) if n.startswith("version=")][:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {_version_table(table, old)}")
        delete_folder(spark, f"{folder}/{old}")
    return spark.table(table)


def _publish(
    spark: SparkSession, table: str, version: str, schema: T.StructType, partition_by: Sequence[str]
) -> None:
    """A view over the version's files; over a table with declared types where folder names hold values."""
    source = f"parquet.`{version}`"
    if partition_by:
        source = _version_table(table, version.rsplit("/", 1)[1])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(f"`{c}`" for c in partition_by)
        spark.sql(f"CREATE TABLE {source} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{version}'")
        spark.sql(f"ALTER TABLE {source} RECOVER PARTITIONS")
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {names} FROM {source}")


def _version_table(table: str, version: str) -> str:
    """Name of the table over one version's folder."""
    return f"{table}_{version.partition('=')[2].replace('-', '_')}"
