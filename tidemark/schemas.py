"""Declared schemas of the raw tables.

Raw tables are far wider than this (the regulators publish up to 250 columns);
these are the columns that staging reads, and their types. Ingest keeps every
column that the source has, those not named here as text.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Wider than any amount the regulators publish, with more places than they use; an
# overflow is an error.
MONEY = T.DecimalType(26, 6)
ENTITY_ID = T.DecimalType(18, 0)
TEXT = T.StringType()
INT = T.IntegerType()
TIME = T.TimestampType()


def record(**columns: T.DataType) -> T.StructType:
    """A struct type from named column types."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def _texts(*names: str) -> dict[str, T.DataType]:
    return dict.fromkeys(names, TEXT)


TAGS = T.ArrayType(TEXT)
LANGUAGES = T.ArrayType(record(name=TEXT, pct=TEXT))
ORGANIZATIONS = T.ArrayType(record(name=TEXT, href=TEXT, order=INT))

RAW_BANK_INSTITUTIONS = record(
    cert=ENTITY_ID,
    **_texts("name", "city", "stname", "webaddr", "dateupdt", "repdte"),
    scraped_at=TIME,
)
RAW_BANK_FINANCIALS = record(
    cert=ENTITY_ID, namefull=TEXT, asset=MONEY, dep=MONEY, repdte=TEXT, scraped_at=TIME
)
RAW_CU_BRANCHES = record(
    cu_number=ENTITY_ID,
    **_texts("cu_name", "physical_address_city", "physical_address_state_code", "cycle_date"),
    scraped_at=TIME,
)
RAW_FS220 = record(
    cu_number=ENTITY_ID,
    **_texts("cycle_date", "update_date"),
    acct_010=MONEY,
    acct_018=MONEY,
    acct_025b=MONEY,
    acct_083=MONEY,
    acct_902=MONEY,
    scraped_at=TIME,
)
RAW_FS220A = record(
    cu_number=ENTITY_ID,
    **_texts("cycle_date", "acct_452", "acct_115", "acct_350", "acct_131"),
    scraped_at=TIME,
)
RAW_FS220D = record(cu_number=ENTITY_ID, **_texts("cycle_date", "acct_891"), scraped_at=TIME)
RAW_FS220N = record(cu_number=ENTITY_ID, **_texts("cycle_date", "acct_is0020"), scraped_at=TIME)
RAW_ACCOUNTS = record(
    **_texts("account", "acct_name", "acct_desc", "table_name", "status"), scraped_at=TIME
)

RAW_PROJECTS = record(
    **_texts("id", "job_id", "section", "project_title", "project_link", "project_description"),
    scraped_at=TIME,
)
RAW_REPOS = record(
    **_texts("id", "job_id", "name", "link", "description", "project_link"),
    tags=TAGS,
    languages=LANGUAGES,
    **_texts("pull_requests", "commits", "stargazers", "forks", "contributors", "last_updated"),
    scraped_at=TIME,
)
RAW_CONTRIBUTORS = record(
    **_texts(
        "id", "job_id", "repo_name", "source_repo_link", "profile_link", "commits_to_source_repo"
    ),
    scraped_at=TIME,
)
RAW_PROFILES = record(
    **_texts(
        "id",
        "job_id",
        "link",
        "number_of_repos",
        "number_of_stars",
        "number_of_followers",
        "number_following",
        "number_of_contributions_past_year",
        "contrib_pct_code_review",
        "contrib_pct_commits",
        "contrib_pct_issues",
        "contrib_pct_pull_requests",
        "company_name",
        "email_domain",
    ),
    organizations=ORGANIZATIONS,
    scraped_at=TIME,
)
RAW_COMPANIES = record(
    **_texts(
        "id",
        "job_id",
        "name",
        "website",
        "domain",
        "github_url",
        "linkedin_url",
        "facebook_url",
        "twitter_url",
    ),
    scraped_at=TIME,
)
RAW_ENRICHMENT = record(id=INT, **_texts("source", "inputs", "outputs", "meta"), created_at=TIME)

# Columns a raw table fills in itself, and source names that differ from the table's.
GENERATED = ("id", "scraped_at")
BANK_INSTITUTIONS_RENAME = {"id": "institution_id"}
BANK_FINANCIALS_RENAME = {"id": "financials_id"}
