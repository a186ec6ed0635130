"""Crawled pages landed as gzip JSON: one document per file, or many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.schemas import TEXT, record
from tidemark.sources.json_landing import Landing, land_json

PAGE_META = ("link", "project_link", "repo_name", "source_repo_link", "domain", "og_company_name")


def page_schema(meta: Sequence[str] = PAGE_META) -> T.StructType:
    """Schema of a crawled page whose ``meta`` has the given keys."""
    return record(url=TEXT, body=TEXT, meta=record(**dict.fromkeys(meta, TEXT)))


PAGE_SCHEMA = page_schema()

# Fixed value: landed keys read <kind>/<job id>.json.gz or <kind>/<job id>/...
JOB_KEY_PATTERN = r"([^/]+)/([^/.]+)(?:\.json\.gz|/[^/]*)$"


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = PAGE_SCHEMA,
    multi_line: bool = True,
) -> DataFrame:
    """Documents of one file, a folder, or a glob, with the file's path.

    gzip is recognised by suffix. A folder is listed and read in parallel and
    has no limit on its number of files. A document that does not parse is an
    error.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line)
    docs = reader.json(path)
    return docs.withColumn("source_path", F.col("_metadata.file_path"))


def land_documents(
    spark: SparkSession,
    path: str | list[str],
    target: str,
    meta: Sequence[str] = PAGE_META,
    multi_line: bool = True,
    limit: int = 0,
) -> Landing:
    """Land crawled pages with these ``meta`` keys; at most ``limit`` may be of no use.

    A document that does not parse, or names no page, is a dead letter.
    """
    return land_json(spark, path, target, page_schema(meta), F.when(F.col("url").isNull(), "no url"), multi_line, limit)


def landed_documents(landing: Landing) -> DataFrame:
    """The landed pages, with the file of each as ``source_path``."""
    return landing.rows().withColumnRenamed("file", "source_path")


def job_id(source_path: Column | str) -> Column:
    """The job part of a landed document's path."""
    path = F.col(source_path) if isinstance(source_path, str) else source_path
    return F.nullif(F.regexp_extract(path, JOB_KEY_PATTERN, 2), F.lit(""))


def stamp_lineage(
    df: DataFrame, source_path: str = "source_path", now: Column | None = None
) -> DataFrame:
    """Add the crawl job and the scrape time (the clock unless injected)."""
    scraped = F.current_timestamp() if now is None else now
    return df.withColumns({"job_id": job_id(source_path), "scraped_at": scraped})
