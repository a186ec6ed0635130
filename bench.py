"""Headline queries on the given tables; prints one JSON line.

BENCH_SF_DIR names the tables' folder, BENCH_CPUS the local cores. Every query
runs twice: "queries" and "value" are the second runs, "first_run" the first,
which include compilation.
"""

from __future__ import annotations

import json
import os
import sys
import time

from catalog import QUERIES
from tidemark.session import build_session

HEADLINE = (
    "metric_asset_deposit",
    "mart_company_contrib",
    "mart_credit_unions",
    "mart_banks",
    "metric_repo_totals",
    "map_company_contributor",
    "size_profile",
    "snapshot_distinct",
    "latest_per_key",
    "distinct_on",
    "growth_vs_prev",
    "left_join_key",
    "page_rows",
    "page_type_dispatch",
    "encoding_fallback",
)


def run(spark, folder: str, name: str) -> float:
    """Seconds to build a query and produce all of its rows."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    first = {name: run(spark, folder, name) for name in names}
    warm = {name: run(spark, folder, name) for name in names}
    result = {
        "metric": "total_headline_seconds_warm",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "first_run": first,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
