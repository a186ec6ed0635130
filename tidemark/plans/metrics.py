"""Marts to metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import months_ahead
from tidemark.functions.numbers import bytes_to_gib, growth_tier, ratio, tier_below
from tidemark.operators.aggregates import sum_by, union_all, union_tagged
from tidemark.operators.growth import growth_vs_prev
from tidemark.operators.sizes import row_bytes_by_period

# Projection horizons in months and the storage price per GB-month.
HORIZONS = (3, 6, 9, 12)
USD_PER_GB_MONTH = 0.40

INSTITUTION_COLUMNS = (
    "name",
    "city",
    "state",
    "state_code",
    "website",
    "domain",
    "total_assets",
    "total_deposits",
)


def metric_asset_deposit(banks: DataFrame, credit_unions: DataFrame, ordered: bool = True) -> DataFrame:
    """Asset tier and deposit growth of every institution and report date.

    The marts hold one row per institution and report, so a growth window is as
    long as one institution's history. Growth is taken of each mart before their
    union, so that a mart already distributed by its entity is not shuffled.
    ``ordered`` adds the report's final sort; leave it off when the result goes
    to a table.
    """
    marts = {"bank": _institutions(banks, "cert"), "credit union": _institutions(credit_unions, "cu_number")}
    metrics = union_tagged({kind: growth_of(mart, ["id_number"]) for kind, mart in marts.items()}, "inst_type")
    return metrics.orderBy("inst_type", "id_number", "report_date") if ordered else metrics


def growth_of(rows: DataFrame, entity: Sequence[str] = ("id_number", "inst_type")) -> DataFrame:
    """Asset tier and deposit growth of ``institutions`` rows, or of one mart's by ``id_number`` alone."""
    grown = growth_vs_prev(
        rows,
        entity,
        "report_date",
        "total_deposits",
        into="deposits_growth_prev_qtr",
    )
    return grown.withColumns(
        {
            "asset_tier": tier_below("total_assets"),
            "deposits_growth_prev_qtr_tier": growth_tier("deposits_growth_prev_qtr"),
        }
    )


def institutions(banks: DataFrame, credit_unions: DataFrame) -> DataFrame:
    """The rows of both marts under common names, ``report_date`` as a date."""
    return union_tagged(
        {"bank": _institutions(banks, "cert"), "credit union": _institutions(credit_unions, "cu_number")},
        "inst_type",
    )


def _institutions(mart: DataFrame, entity: str) -> DataFrame:
    return mart.select(F.col(entity).alias("id_number"), *INSTITUTION_COLUMNS, F.col("period").alias("report_date"))


def metric_repo_totals(contributions: DataFrame) -> DataFrame:
    """Per repository: all companies' contributors and commits together."""
    described = contributions.withColumnsRenamed(
        {
            "repo_num_of_commits": "total_num_of_commits",
            "repo_num_of_contribs": "total_num_of_contribs",
        }
    )
    return sum_by(
        described,
        [
            "repo_name",
            "repo_description",
            "repo_link",
            "total_num_of_commits",
            "total_num_of_contribs",
        ],
        {
            "num_of_top10_contribs_w_comp": "comp_num_of_contribs_on_repo",
            "num_of_commits_from_top10_contribs_w_comp": "comp_num_of_commits_on_repo",
        },
    )


def metric_repo_company_share(contributions: DataFrame, safe: bool = False) -> DataFrame:
    """Each company's share of a repository's commits and contributors.

    A repository without commits is an error, or a NULL share when ``safe``.
    """
    return contributions.select(
        "company_name",
        "domain",
        "linkedin_url",
        "repo_name",
        "repo_description",
        "repo_link",
        F.col("repo_num_of_commits").alias("repo_total_num_of_commits"),
        F.col("comp_num_of_commits_on_repo").alias("num_of_top10_contrib_commits_from_comp"),
        ratio("comp_num_of_commits_on_repo", "repo_num_of_commits", safe).alias(
            "pct_top10_contrib_commits_from_comp"
        ),
        F.col("repo_num_of_contribs").alias("repo_total_num_of_contribs"),
        F.col("comp_num_of_contribs_on_repo").alias("num_of_top10_contribs_from_comp"),
        ratio("comp_num_of_contribs_on_repo", "repo_num_of_contribs", safe).alias(
            "pct_top10_contribs_from_comp"
        ),
        F.to_date("scraped_at").alias("scraped_at"),
    )


def size_profile(tables: Mapping[tuple[str, str], tuple[DataFrame, str | Column]]) -> DataFrame:
    """Bytes per report period of every table, beside the table's average period.

    ``tables`` maps (schema, table) to its data and its report-period column.
    Each table is read once; the averages are taken over the per-period totals.
    """
    totals = union_all(
        row_bytes_by_period(df, period, "current_size_bytes").select(
            F.lit(schema).alias("schema_name"),
            F.lit(table).alias("table_name"),
            F.col("period").cast("string").alias("period"),
            "current_size_bytes",
        )
        for (schema, table), (df, period) in tables.items()
    )
    same_table = Window.partitionBy("schema_name", "table_name")
    return totals.withColumn(
        "avg_size_bytes_by_qtrly_rp_date", F.avg("current_size_bytes").over(same_table)
    )


def size_totals(profile: DataFrame) -> DataFrame:
    """One row: current size of all tables and their combined average report, in GiB.

    A table's average counts once, however many periods the profile lists.
    """
    tables = profile.groupBy("schema_name", "table_name").agg(
        F.sum("current_size_bytes").alias("current"),
        F.max("avg_size_bytes_by_qtrly_rp_date").alias("average"),
    )
    return tables.agg(
        bytes_to_gib(F.sum("current")).alias("total_current_size_gb"),
        F.sum(bytes_to_gib("average")).alias("total_avg_size_gb_by_qtrly_rp_date"),
    )


def size_projection(
    totals: DataFrame,
    current: str,
    average: str,
    today: Column | None = None,
    months_per_report: int = 3,
) -> DataFrame:
    """Size at each horizon: ``current + average * months``.

    ``average`` is the growth per ``months_per_report`` months; reports are
    quarterly. The older projection took a report's average for a month's: pass
    1 for its figures.
    """
    today = F.current_date() if today is None else today
    horizons = F.explode(F.array(*[F.lit(m) for m in HORIZONS])).alias("months")
    rows = totals.select("*", horizons)
    growth = F.col(average) * F.col("months") / F.lit(months_per_report)
    return rows.select(
        "months",
        (F.col(current) + growth).alias("total_size_gb"),
        months_ahead(today, F.col("months")).alias("future_date"),
    )


def cost_projection(
    sizes: DataFrame, current: str, average: str, price: float = USD_PER_GB_MONTH
) -> DataFrame:
    """Size and monthly cost now and at each horizon, one column apiece."""
    columns = {"current_cost_per_month_usd": F.col(current) * F.lit(price)}
    for months in HORIZONS:
        size = F.col(current) + F.col(average) * F.lit(months)
        columns[f"gb_in_{months}_months"] = size
        columns[f"cost_in_{months}_months_usd"] = size * F.lit(price)
    return sizes.withColumns(columns)
