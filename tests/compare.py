"""Run registered queries against their SQL and compare whole results.

Usage: python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from catalog import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, con, name: str, folder: str) -> str | None:
    """None if both engines agree, else what differs first."""
    df = QUERIES[name](spark, folder)
    got = _rows(df.columns, df.collect())
    result = con.sql(ORACLES[name])
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} vs {sorted(result.columns)}"
    kinds = {c: str(k) for c, k in zip(result.columns, result.types)}
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for c, k in df.dtypes:
        if names.get(k, k) != kinds[c]:
            return f"type of {c}: {k} vs {kinds[c]}"
    want = _rows(result.columns, result.fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} vs {sum(want.values())} rows; "
        f"spark only {list(extra)[:2]}; sql only {list(missing)[:2]}"
    )


def main() -> int:
    from tidemark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                verdict = difference(spark, con, name, folder)
            else:
                verdict = None if QUERIES[name](spark, folder).count() else "no rows"
        except Exception as e:  # report and go on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        bad += verdict is not None
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
