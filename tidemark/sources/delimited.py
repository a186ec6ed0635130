"""Call-report text: a header line and quoted comma-separated rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

# One report spells the charter number's header its own way.
HEADER_SPELLINGS = {"CU_Number": "CU_NUMBER"}

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def snake_case(name: str, legacy: bool = False) -> str:
    """A header as a column name.

    All-capital names are lower-cased. ``legacy`` keeps the older rule, where a
    capital equal to the first letter gets no underscore (``CycleCode`` becomes
    ``cyclecode``) and neighbouring capitals get one each.
    """
    for spelling, usual in HEADER_SPELLINGS.items():
        name = name.replace(spelling, usual)
    if name.isupper():
        return name.lower()
    if legacy:
        return re.sub(
            r"[A-Z]", lambda m: ("" if m[0] == name[0] else "_") + m[0].lower(), name
        )
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


def snake_case_columns(df: DataFrame, legacy: bool = False) -> DataFrame:
    """Rename every column with ``snake_case``. Names only; no data is read."""
    return df.toDF(*[snake_case(c, legacy) for c in df.columns])


def read_delimited(
    spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", legacy_names: bool = False
) -> DataFrame:
    """Text columns of delimited files, under snake-case names."""
    raw = spark.read.options(**CSV_OPTIONS).option("encoding", encoding).csv(path)
    return snake_case_columns(raw, legacy_names)


def parse_delimited(
    lines: DataFrame, column: str, header: str, keep: tuple[str, ...] = (), legacy_names: bool = False
) -> DataFrame:
    """Rows from delimited lines in a column, given the header line.

    Columns in ``keep`` travel with each row (the archive and member, say).
    """
    names = [snake_case(h.strip().strip("\"'"), legacy_names) for h in header.split(",")]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    record = F.from_csv(F.col(column), F.lit(_ddl(schema)), options).alias("record")
    return lines.select(*keep, record).select(*keep, "record.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` STRING" for f in schema.fields)
