"""The two pipelines end to end, as plain composition."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import parse_day
from tidemark.operators.sizes import average_by_key
from tidemark.plans import maps, marts, metrics, staging
from tidemark.sources.lookups import states
from tidemark.sources.tables import full_refresh, write_audit_publish

REGULATOR_STAGING = {
    "bank_financials": staging.stage_bank_financials,
    "bank_institutions": staging.stage_bank_institutions,
    "cu_branches": staging.stage_cu_branches,
    "cu_fs220": staging.stage_fs220,
    "cu_fs220a": staging.stage_fs220a,
    "cu_fs220d": staging.stage_fs220d,
    "cu_fs220n": staging.stage_fs220n,
}
PAGE_STAGING = {
    "projects": staging.stage_projects,
    "repos": staging.stage_repos,
    "contributors": staging.stage_contributors,
    "profiles": staging.stage_profiles,
    "companies": staging.stage_companies,
}


def _stage_all(builders, raw: Mapping[str, DataFrame], root: str, now: Column | None):
    return {
        name: write_audit_publish(build(raw[name], now), f"staging_{name}", root)
        for name, build in builders.items()
    }


def run_regulator_pipeline(
    raw: Mapping[str, DataFrame], root: str, now: Column | None = None
) -> DataFrame:
    """Raw regulator tables to the asset-and-deposit metric, stored under ``root``.

    Every staging table is audited before a mart reads it, and each mart is
    written once and read back by what follows it.
    """
    staged = _stage_all(REGULATOR_STAGING, raw, root, now)
    spark = next(iter(raw.values())).sparkSession
    lookup = states(spark)
    banks = write_audit_publish(
        marts.mart_banks(staged["bank_financials"], staged["bank_institutions"], lookup),
        "mart_banks",
        root,
    )
    unions = write_audit_publish(
        marts.mart_credit_unions(
            staged["cu_branches"],
            staged["cu_fs220"],
            staged["cu_fs220a"],
            staged["cu_fs220d"],
            staged["cu_fs220n"],
            lookup,
        ),
        "mart_credit_unions",
        root,
    )
    target = f"{root}/metric_asset_deposit"
    full_refresh(metrics.metric_asset_deposit(banks, unions, ordered=False), target)
    return spark.read.parquet(target)


def run_page_pipeline(
    raw: Mapping[str, DataFrame], enrichment: DataFrame, root: str, now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Raw page tables to repository totals and company shares."""
    staged = _stage_all(PAGE_STAGING, raw, root, now)
    spark = enrichment.sparkSession
    company_map = write_audit_publish(
        maps.map_company_contributor(enrichment, staged["profiles"], staged["contributors"]),
        "map_company_contributor",
        root,
        key=None,
    )
    contributions = write_audit_publish(
        marts.mart_company_contrib(
            staged["repos"],
            staged["projects"],
            staged["contributors"],
            staged["companies"],
            company_map,
        ),
        "mart_company_contrib",
        root,
        key=None,
    )
    totals, shares = f"{root}/metric_repo_totals", f"{root}/metric_repo_company_share"
    full_refresh(metrics.metric_repo_totals(contributions), totals)
    full_refresh(metrics.metric_repo_company_share(contributions), shares)
    return spark.read.parquet(totals), spark.read.parquet(shares)


def regulator_size_profile(raw: Mapping[str, DataFrame], metric: DataFrame) -> DataFrame:
    """Storage of the regulator tables per report period, once the pipeline has run.

    The account descriptions, if given, have no period: their rows are sized by
    account name.
    """
    spark = metric.sparkSession
    profile = metrics.size_profile(
        {
            ("raw", "bank_financials"): (raw["bank_financials"], "repdte"),
            ("raw", "bank_institutions"): (raw["bank_institutions"], "repdte"),
            ("raw", "cu_branches"): (raw["cu_branches"], parse_day("cycle_date")),
            ("raw", "cu_fs220"): (raw["cu_fs220"], parse_day("cycle_date")),
            ("staging", "bank_financials"): (spark.table("staging_bank_financials"), "report_date"),
            ("staging", "bank_institutions"): (
                spark.table("staging_bank_institutions"),
                "report_date",
            ),
            ("staging", "cu_branches"): (spark.table("staging_cu_branches"), "period"),
            ("staging", "cu_fs220"): (spark.table("staging_cu_fs220"), "period"),
            ("data_marts", "banks"): (spark.table("mart_banks"), "report_date"),
            ("data_marts", "credit_unions"): (spark.table("mart_credit_unions"), "report_date"),
            ("metrics", "asset_deposit"): (metric, "report_date"),
        }
    )
    if "cu_accounts" not in raw:
        return profile
    accounts = average_by_key(raw["cu_accounts"], "acct_name")
    average = accounts.agg(F.avg("avg_bytes")).scalar()
    return profile.unionByName(
        accounts.select(
            F.lit("raw").alias("schema_name"),
            F.lit("cu_accounts").alias("table_name"),
            F.col("acct_name").alias("period"),
            F.col("avg_bytes").cast("bigint").alias("current_size_bytes"),
            average.alias("avg_size_bytes_by_qtrly_rp_date"),
        )
    )
