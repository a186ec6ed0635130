"""Landed files to raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.dates import load_stamp, parse_day
from tidemark.functions.keys import md5_key
from tidemark.operators.columns import align_schema
from tidemark.plans.page_extracts import EXTRACTORS
from tidemark.session import scratch_dir
from tidemark.sources import archives
from tidemark.sources.archives import land_members, landed_columns
from tidemark.sources.documents import land_documents, landed_documents, stamp_lineage
from tidemark.sources.envelopes import land_envelopes, landed_fields, landed_records, require_complete
from tidemark.sources.part_tables import PartTable

BANK_TABLES = {
    "bank_institutions": schemas.RAW_BANK_INSTITUTIONS,
    "bank_financials": schemas.RAW_BANK_FINANCIALS,
}
# The call report's files and the raw tables they fill.
CALL_REPORT_TABLES = {
    "cu_branches": ("Credit Union Branch Information.txt", schemas.RAW_CU_BRANCHES),
    "cu_accounts": ("AcctDesc.txt", schemas.RAW_ACCOUNTS),
    "cu_fs220": ("FS220.txt", schemas.RAW_FS220),
    "cu_fs220a": ("FS220A.txt", schemas.RAW_FS220A),
    "cu_fs220d": ("FS220D.txt", schemas.RAW_FS220D),
    "cu_fs220n": ("FS220N.txt", schemas.RAW_FS220N),
}
# Each page table and the columns that, with the crawl job, identify a row.
PAGE_TABLES = {
    "projects": (schemas.RAW_PROJECTS, ("project_link",)),
    "repos": (schemas.RAW_REPOS, ("link",)),
    "contributors": (schemas.RAW_CONTRIBUTORS, ("source_repo_link", "profile_link")),
    "profiles": (schemas.RAW_PROFILES, ("link",)),
    "companies": (schemas.RAW_COMPANIES, ("website",)),
}


# What the source calls its own id, by table.
RENAMED = {
    "bank_institutions": schemas.BANK_INSTITUTIONS_RENAME,
    "bank_financials": schemas.BANK_FINANCIALS_RENAME,
}


def widened(known: T.StructType, names: list[str]) -> T.StructType:
    """``known`` with every further name as text, before the load time."""
    have = set(known.names)
    more = [T.StructField(n, schemas.TEXT) for n in names if n not in have]
    stamp = [f for f in known.fields if f.name == "scraped_at"]
    return T.StructType([f for f in known.fields if f.name != "scraped_at"] + more + stamp)


def raw_bank_table(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    now: Column | None = None,
    schema: T.StructType | None = None,
    complete: bool = True,
    landing: str | None = None,
    limit: int = 0,
) -> DataFrame:
    """A bank table from API responses, whose records have upper-case text keys.

    Responses are parsed once and kept below ``landing`` (a scratch folder
    unless named); up to ``limit`` of them may be dead letters. Every field that
    a record has becomes a column: the declared ones typed, the rest as text, the
    source's own ``id`` under its name in the table. Pass ``schema`` to say which
    columns to keep. Unless ``complete`` is False, the responses must hold as
    many records as they declare.
    """
    landed = land_envelopes(spark, path, landing or scratch_dir(spark, table), limit=limit)
    if complete:
        require_complete(landed)
    rename = RENAMED[table]
    found = landed_fields(landed)
    if schema is None:
        schema = widened(BANK_TABLES[table], [rename.get(n.lower(), n.lower()) for n in found])
    return _stamped(landed_records(landed, found), schema, now, rename)


def land_call_reports(spark: SparkSession, path: str | list[str], landing: str) -> None:
    """Land all tables' members of quarterly archives below ``landing``, opening each archive once."""
    land_members(spark, path, [member for member, _ in CALL_REPORT_TABLES.values()], landing)


def call_report_table(
    spark: SparkSession, landing: str, table: str, now: Column | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A credit-union table from landed archives, with every column that any of them has.

    Pass ``schema`` to say which columns to keep.
    """
    member, known = CALL_REPORT_TABLES[table]
    if schema is None:
        schema = widened(known, landed_columns(spark, landing, member))
    names = [f.name for f in schema.fields if f.name != "scraped_at"]
    return _stamped(archives.landed_records(spark, landing, member, names), schema, now)


def _stamped(
    landed: DataFrame, schema: T.StructType, now: Column | None, rename: dict[str, str] | None = None
) -> DataFrame:
    aligned = align_schema(landed, schema, rename, generated=("scraped_at",))
    return aligned.withColumn("scraped_at", load_stamp(now))


def raw_page_table(
    spark: SparkSession,
    path: str | list[str],
    kind: str,
    now: Column | None = None,
    multi_line: bool = True,
    landing: str | None = None,
    limit: int = 0,
) -> DataFrame:
    """A page table from crawled documents of one kind, keyed by job and page.

    Documents are parsed once and kept below ``landing`` (a scratch folder
    unless named); up to ``limit`` of them may be dead letters. For other
    ``meta`` keys, land them with ``land_documents`` and pass those on to
    ``page_rows_of``.
    """
    landed = land_documents(spark, path, landing or scratch_dir(spark, kind), multi_line=multi_line, limit=limit)
    return page_rows_of(landed_documents(landed), kind, now)


def page_rows_of(landed: DataFrame, kind: str, now: Column | None = None) -> DataFrame:
    """A page table from landed documents of one kind."""
    schema, natural_key = PAGE_TABLES[kind]
    documents = stamp_lineage(landed, now=now)
    rows = EXTRACTORS[kind](documents, keep=("job_id", "scraped_at"))
    return align_schema(rows.withColumn("id", md5_key(["job_id", *natural_key])), schema)


def landed_periods(spark: SparkSession, target: str, partition: str = "report_period") -> PartTable:
    """The table that ``land_new_periods`` keeps at ``target``."""
    return PartTable(spark, target, partition)


def land_new_periods(
    incoming: DataFrame, target: str, period: str, partition: str = "report_period"
) -> list[str]:
    """Append the report periods that the table does not hold yet; the names of their parts.

    The table is cut by the parsed period, and its records tell what is loaded.
    A run's periods become visible together when it is done: one that dies hides
    nothing from the next and adds nothing twice, and of two runs that bring the
    same period one is refused. A row without a period is an error, since no run
    could tell it is loaded.
    """
    missing = F.raise_error(F.lit(f"a row without {period} cannot be landed by period")).cast("date")
    dated = incoming.withColumn(partition, F.coalesce(parse_day(period), missing))
    return landed_periods(incoming.sparkSession, target, partition).append(dated)
