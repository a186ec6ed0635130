"""The counter rule and the storage projection as functions that SQL can call."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.plans.metrics import HORIZONS

TEXT_TO_NUM = r"""
CREATE OR REPLACE TEMPORARY FUNCTION text_to_num(value STRING COMMENT 'counter text, such as 1.2k')
RETURNS DECIMAL(30, 6)
COMMENT 'Counter text as a number; a k multiplies by 1000; null and ''null'' give NULL'
RETURN CAST(
  CAST(regexp_replace(nullif(value, 'null'), '[^0-9.]', '') AS DECIMAL(30, 9))
  * CASE WHEN contains(nullif(value, 'null'), 'k') THEN 1000 ELSE 1 END AS DECIMAL(30, 6))
"""

SIZE_PROJECTION = f"""
CREATE OR REPLACE TEMPORARY FUNCTION size_projection(
  current DOUBLE COMMENT 'size now',
  average DOUBLE COMMENT 'growth a report',
  today DATE DEFAULT current_date(),
  months_per_report INT DEFAULT 3)
RETURNS TABLE (months INT, total_size_gb DOUBLE, future_date DATE)
COMMENT 'Size at each horizon: current + average * months / months_per_report'
RETURN
  SELECT ahead, current + average * ahead / months_per_report, add_months(today, ahead)
  FROM (SELECT explode(array({", ".join(map(str, HORIZONS))})) AS ahead)
"""


def register(spark: SparkSession) -> None:
    """Make ``text_to_num`` and ``size_projection`` known to this session's SQL."""
    spark.sql(TEXT_TO_NUM)
    spark.sql(SIZE_PROJECTION)
