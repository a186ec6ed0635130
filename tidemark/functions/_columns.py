from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def as_col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value
