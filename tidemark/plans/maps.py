"""Which contributor works for which company."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.text import json_text
from tidemark.operators.columns import not_null
from tidemark.operators.joins import left_join_skewed
from tidemark.operators.snapshots import latest_per_key


def enriched_companies(enrichment: DataFrame) -> DataFrame:
    """Newest answer per domain: (company_name, domain, og_company_name)."""
    answers = enrichment.select(
        json_text("outputs", "$[0].name").alias("company_name"),
        json_text("meta", "$.og_company_name").alias("og_company_name"),
        json_text("outputs", "$[0].domain").alias("domain"),
        "created_at",
        "id",
    )
    known = not_null(answers, "og_company_name", "domain")
    return latest_per_key(known, ["domain"], "created_at", ["id"]).drop("created_at", "id")


def map_company_contributor(
    enrichment: DataFrame, profiles: DataFrame, contributors: DataFrame, share: float = 0.01
) -> DataFrame:
    """Company, its members' profiles, and the repositories they contribute to.

    Companies without profiles and profiles without contributions stay, with
    NULLs. A company that owns over ``share`` of all profiles, or a profile with
    as large a part of all contributions, is found by a scan of the key column,
    and its rows are dealt over many tasks.
    """
    companies = enriched_companies(enrichment)
    members = not_null(profiles.select("company_name", "link"), "company_name").select(
        F.col("company_name").alias("og_company_name"), F.col("link").alias("github_profile_link")
    )
    repos = contributors.select(
        F.col("profile_link").alias("github_profile_link"),
        F.col("source_repo_link").alias("contrib_on_repo_link"),
    )
    staffed = left_join_skewed(companies, members, ["og_company_name"], share)
    mapped = left_join_skewed(staffed, repos, ["github_profile_link"], share)
    return mapped.select("company_name", "domain", "github_profile_link", "contrib_on_repo_link")
