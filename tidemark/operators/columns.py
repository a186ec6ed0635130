"""Projection, casting, filtering and schema alignment."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Keep ``columns`` only, as {new name: source column}."""
    return df.select(
        *[(F.col(src) if isinstance(src, str) else src).alias(name) for name, src in columns.items()]
    )


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType], safe: bool = False) -> DataFrame:
    """Cast in place; bad input is an error, or NULL when ``safe``."""
    casts = {
        name: F.col(name).try_cast(kind) if safe else F.col(name).cast(kind)
        for name, kind in types.items()
    }
    return df.withColumns(casts)


def not_null(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Rows where every one of ``columns`` is present."""
    for c in columns:
        df = df.filter((F.col(c) if isinstance(c, str) else c).isNotNull())
    return df


def equals(df: DataFrame, **values: object) -> DataFrame:
    """Rows where each named column has the given value."""
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def align_schema(
    df: DataFrame,
    schema: T.StructType,
    rename: Mapping[str, str] | None = None,
    generated: Iterable[str] = (),
) -> DataFrame:
    """Fit records to a table: lower-case names, fill in NULLs, drop the rest.

    ``rename`` maps a source column to its name in the table. ``generated``
    columns are the table's own business and are left out.
    """
    rename = dict(rename or {})
    skip = set(generated)
    sources = {}
    for name in df.columns:
        lowered = name.lower()
        sources[rename.get(lowered, lowered)] = name
    columns = []
    for field in schema.fields:
        if field.name in skip:
            continue
        source = sources.get(field.name)
        value = F.col(f"`{source}`") if source else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def extend(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """``SELECT *, expr AS name``."""
    return df.withColumns(dict(values))


def explode_with(
    df: DataFrame, kept: Mapping[str, str | Column], items: Column, into: str
) -> DataFrame:
    """One row per element of ``items``, each with the ``kept`` values of its row.

    The kept values are worked out before the explode; in one ``select`` with
    it, Spark would work them out again for every element.
    """
    base = df.select(
        *[(F.col(v) if isinstance(v, str) else v).alias(name) for name, v in kept.items()],
        items.alias(into),
    )
    return base.withColumn(into, F.explode(into))
