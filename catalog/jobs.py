"""The composed jobs: staging, maps, marts and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog import fixtures as X
from catalog.registry import Tables, query
from catalog.rows import ASSET_LADDER, growth_ladder
from tidemark.functions.dates import quarter_end
from tidemark.functions.text import url_domain
from tidemark.plans import maps, marts, metrics, page_extracts, refresh, staging
from tidemark.session import scratch_dir, stored


def _doubles(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n.split('.')[-1]}" for n in names)


def _unstamped(df: DataFrame) -> DataFrame:
    return df.drop("loaded_at")


# --- staging ---------------------------------------------------------------


@query(
    "stg_financials",
    f"""
    SELECT {_doubles('cert', 'total_assets', 'total_deposits')}, name, report_date, dim_id,
           CAST(CAST(strptime(report_date, '%Y%m%d') AS DATE) AS VARCHAR) AS period, {X.DAY_START}
    FROM {X.SQL_FINANCIALS}
    """,
)
def stg_financials(t: Tables):
    return _unstamped(staging.stage_bank_financials(X.bank_financials(t)))


@query(
    "stg_institutions",
    f"""
    SELECT {_doubles('cert')}, name, city, state, website, report_date, date_updated, dim_id,
           CAST(CAST(strptime(report_date, '%m/%d/%Y') AS DATE) AS VARCHAR) AS period, {X.DAY_START}
    FROM {X.SQL_INSTITUTIONS}
    """,
)
def stg_institutions(t: Tables):
    return _unstamped(staging.stage_bank_institutions(X.bank_institutions(t)))


@query(
    "stg_branch_info",
    f"""
    SELECT {_doubles('cu_number')}, name, city, state_code, cycle_date, CAST(period AS VARCHAR) AS period, dim_id, {X.DAY_START}
    FROM {X.SQL_BRANCHES}
    """,
)
def stg_branch_info(t: Tables):
    return _unstamped(staging.stage_cu_branches(X.cu_branches(t)))


_FS220 = ("total_assets", "total_deposits", "loans_for_investment", "current_members", "dda_div_shr_dft_amt")
_FS220A = ("dda_div_shr_dft_cnt", "total_int_inc_ytd", "total_int_exp_ytd", "service_chg_ytd")


@query(
    "stg_fs220",
    f"""
    SELECT {_doubles('cu_number', *_FS220)}, cycle_date, update_date, CAST(period AS VARCHAR) AS period, dim_id, {X.DAY_START}
    FROM {X.SQL_FS220}
    """,
)
def stg_fs220(t: Tables):
    return _unstamped(staging.stage_fs220(X.cu_fs220(t)))


@query(
    "stg_fs220a",
    f"SELECT {_doubles('cu_number', *_FS220A)}, cycle_date, CAST(period AS VARCHAR) AS period, dim_id, {X.DAY_START} FROM {X.SQL_FS220A}",
)
def stg_fs220a(t: Tables):
    return _unstamped(staging.stage_fs220a(X.cu_fs220a(t)))


@query(
    "stg_fs220d",
    f"SELECT {_doubles('cu_number')}, cycle_date, CAST(period AS VARCHAR) AS period, website, dim_id, {X.DAY_START} FROM {X.SQL_FS220D}",
)
def stg_fs220d(t: Tables):
    return _unstamped(staging.stage_fs220d(X.cu_fs220d(t)))


@query(
    "stg_fs220n",
    f"""
    SELECT {_doubles('cu_number', 'other_non_int_inc_ytd')}, cycle_date, CAST(period AS VARCHAR) AS period, dim_id, {X.DAY_START}
    FROM {X.SQL_FS220N}
    """,
)
def stg_fs220n(t: Tables):
    return _unstamped(staging.stage_fs220n(X.cu_fs220n(t)))


@query(
    "stg_projects",
    f"""
    SELECT section, project_title, project_link, project_description, md5(project_link) AS dim_id, {X.SHOW_SCRAPED}
    FROM {X.SQL_PROJECTS}
    """,
)
def stg_projects(t: Tables):
    return _unstamped(staging.stage_projects(X.projects(t)))


@query(
    "stg_repos",
    f"""
    SELECT name, link, description, project_link, tags, '50%' AS pct, last_updated, md5(link) AS dim_id,
           {_doubles('pull_requests', 'commits', 'stargazers', 'forks', 'contributors')}, {X.SHOW_SCRAPED}
    FROM {X.SQL_REPOS}
    """,
)
def stg_repos(t: Tables):
    staged = _unstamped(staging.stage_repos(X.repos(t)))
    return staged.withColumns(
        {"tags": F.concat_ws(",", "tags"), "pct": F.col("languages")[0]["pct"]}
    ).drop("languages")


@query(
    "stg_contributors",
    f"""
    SELECT repo_name, source_repo_link, profile_link, {_doubles('commits_to_source_repo')},
           md5(source_repo_link || profile_link) AS dim_id, {X.SHOW_SCRAPED}
    FROM {X.SQL_CONTRIBUTORS}
    """,
)
def stg_contributors(t: Tables):
    return _unstamped(staging.stage_contributors(X.contributors(t)))


_COUNTERS = (
    "number_of_repos", "number_of_stars", "number_of_followers", "number_following",
    "number_of_contributions_past_year",
)


@query(
    "stg_profiles",
    f"""
    SELECT link, {_doubles(*_COUNTERS)}, company_name, CAST(NULL AS VARCHAR) AS email_domain,
           md5(link) AS dim_id, {X.SHOW_SCRAPED}
    FROM {X.SQL_PROFILES}
    """,
)
def stg_profiles(t: Tables):
    return _unstamped(staging.stage_profiles(X.profiles(t))).drop("organizations")


def _anchor(word: str) -> str:
    return rf"""NULLIF(regexp_extract(html, '(?s)<a\b[^>]*\shref="([^"]*{word}[^"]*)"', 1), '')"""


@query(
    "stg_companies",
    rf"""
    SELECT domain AS name, url AS website, domain, {_anchor('github')} AS github_url,
           {_anchor('linkedin')} AS linkedin_url, {_anchor('facebook')} AS facebook_url,
           {_anchor('twitter')} AS twitter_url, md5(domain) AS dim_id,
           strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id), '%Y-%m-%d %H:%M:%S') AS scraped_at
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY domain ORDER BY page_id DESC) AS rn
          FROM (SELECT *, regexp_extract(url, '(?s)(?:.*://)?(?:www\.)?([^/?]*)', 1) AS domain FROM pages))
    WHERE rn = 1
    """,
)
def stg_companies(t: Tables):
    home_pages = t.pages.select(
        "url",
        F.col("html").alias("body"),
        F.struct(url_domain("url").alias("domain"), url_domain("url").alias("og_company_name")).alias("meta"),
        F.expr(f"{X.START} + make_dt_interval(0, 0, 0, page_id)").alias("scraped_at"),
    )
    return _unstamped(
        staging.stage_companies(page_extracts.extract_companies(home_pages, keep=("scraped_at",)))
    )


# --- maps and marts --------------------------------------------------------

SQL_MAP = f"""(
    SELECT e.company_name, e.domain, p.link AS github_profile_link, c.source_repo_link AS contrib_on_repo_link
    FROM {X.SQL_ENRICHED} e
    LEFT JOIN (SELECT * FROM {X.SQL_PROFILES} WHERE company_name IS NOT NULL) p ON p.company_name = e.asked
    LEFT JOIN {X.SQL_CONTRIBUTORS} c ON c.profile_link = p.link)"""


def _contributors(t: Tables, *measures: str) -> DataFrame:
    """Staged contributors as a table, which the map's search for hot keys, the map and the mart all read."""
    staged = staging.stage_contributors(X.contributors(t))
    return stored(staged.select("source_repo_link", "profile_link", *measures), "contributors")


def _map(t: Tables, contributors: DataFrame) -> DataFrame:
    return maps.map_company_contributor(X.enrichment(t), staging.stage_profiles(X.profiles(t)), contributors)


@query("map_company_contributor", f"SELECT * FROM {SQL_MAP}")
def map_company_contributor(t: Tables):
    return _map(t, _contributors(t))


SQL_BANKS = rf"""(
    SELECT f.cert, f.name, i.city, i.state, CAST(n_nationkey AS VARCHAR) AS state_code, i.website,
           regexp_extract(i.website, '(?s)(?:.*://)?(?:www\.)?([^/?]*)', 1) AS domain,
           f.total_assets, f.total_deposits, f.report_date, md5(f.cert || f.report_date) AS dim_id
    FROM {X.newest(X.SQL_FINANCIALS, 'cert, report_date', 'day DESC, dim_id DESC')} f
    LEFT JOIN {X.newest(X.SQL_INSTITUTIONS, 'cert', "strptime(date_updated, '%m/%d/%Y') DESC, day DESC, dim_id DESC")} i
           ON i.cert = f.cert
    LEFT JOIN nation ON n_name = i.state)"""


def _banks(t: Tables) -> DataFrame:
    return marts.mart_banks(
        staging.stage_bank_financials(X.bank_financials(t), then=marts.NEWEST_REPORT),
        staging.stage_bank_institutions(X.bank_institutions(t), then=marts.NEWEST_ATTRIBUTES),
        X.nations_as_states(t),
    )


@query(
    "mart_banks",
    f"""
    SELECT {_doubles('cert', 'total_assets', 'total_deposits')}, name, city, state, state_code, website, domain,
           report_date, CAST(CAST(strptime(report_date, '%Y%m%d') AS DATE) AS VARCHAR) AS period, dim_id
    FROM {SQL_BANKS}
    """,
)
def mart_banks(t: Tables):
    return _banks(t)


def _form(table: str) -> str:
    return X.newest(table, "cu_number, period", "day DESC, dim_id DESC")


SQL_UNIONS = rf"""(
    SELECT f.cu_number, c.name, c.city, n_name AS state, c.state_code, d.website,
           regexp_extract(d.website, '(?s)(?:.*://)?(?:www\.)?([^/?]*)', 1) AS domain,
           {', '.join('f.' + c for c in _FS220)}, {', '.join('a.' + c for c in _FS220A)}, n.other_non_int_inc_ytd,
           f.cycle_date AS report_date, f.period, md5(f.cu_number || f.cycle_date) AS dim_id
    FROM {_form(X.SQL_FS220)} f
    LEFT JOIN {X.newest(X.SQL_BRANCHES, 'cu_number', 'period DESC, day DESC, dim_id DESC')} c ON c.cu_number = f.cu_number
    LEFT JOIN {_form(X.SQL_FS220A)} a ON a.cu_number = f.cu_number AND a.period = f.period
    LEFT JOIN {_form(X.SQL_FS220D)} d ON d.cu_number = f.cu_number AND d.period = f.period
    LEFT JOIN {_form(X.SQL_FS220N)} n ON n.cu_number = f.cu_number AND n.period = f.period
    LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = c.state_code)"""


def _unions(t: Tables) -> DataFrame:
    return marts.mart_credit_unions(
        staging.stage_cu_branches(X.cu_branches(t), then=marts.NEWEST_PLACE),
        staging.stage_fs220(X.cu_fs220(t), then=marts.NEWEST_FORM),
        staging.stage_fs220a(X.cu_fs220a(t), then=marts.NEWEST_FORM),
        staging.stage_fs220d(X.cu_fs220d(t), then=marts.NEWEST_FORM),
        staging.stage_fs220n(X.cu_fs220n(t), then=marts.NEWEST_FORM),
        X.nations_as_states(t),
    )


SQL_UNION_MART = f"""
    SELECT {_doubles('cu_number', *_FS220, *_FS220A, 'other_non_int_inc_ytd')}, name, city, state, state_code,
           website, domain, report_date, CAST(period AS VARCHAR) AS period, dim_id
    FROM {SQL_UNIONS}
    """


@query("mart_credit_unions", SQL_UNION_MART)
def mart_credit_unions(t: Tables):
    return _unions(t)


def _regulators(t: Tables) -> dict[str, DataFrame]:
    return {name: getattr(X, name)(t) for name in refresh.SOURCES}


@query("mart_credit_unions_stored", SQL_UNION_MART)
def mart_credit_unions_stored(t: Tables):
    """The forms stored in buckets of (charter, period), then joined as they lie."""
    stored = refresh.RegulatorTables(t.spark, scratch_dir(t.spark, "stored"), buckets=4)
    for name in ("cu_branches", *refresh.FORMS):
        refresh.stage_changes(stored, name, _regulators(t)[name])
    places = marts.newest_known(marts.union_places(stored.form("cu_branches")), "cu_number")
    return marts.unions_of(places, *[stored.form(name) for name in refresh.FORMS], X.nations_as_states(t))


SQL_CONTRIB = f"""(
    WITH staff AS {SQL_MAP}, contributions AS {X.SQL_CONTRIBUTORS},
    people AS (
        SELECT company_name, domain, contrib_on_repo_link AS link, COUNT(*) AS n_people
        FROM staff GROUP BY ALL),
    work AS (
        SELECT s.company_name, s.domain, c.source_repo_link AS link, SUM(c.commits_to_source_repo) AS n_commits
        FROM contributions c LEFT JOIN staff s
        ON s.contrib_on_repo_link = c.source_repo_link AND s.github_profile_link = c.profile_link
        GROUP BY ALL)
    SELECT people.company_name, people.domain, site.linkedin_url, r.name AS repo_name,
           COALESCE(project.project_description, r.description) AS repo_description, r.link AS repo_link,
           r.contributors AS repo_num_of_contribs, r.commits AS repo_num_of_commits,
           n_people AS comp_num_of_contribs_on_repo, CAST(n_commits AS BIGINT) AS comp_num_of_commits_on_repo,
           strftime(r.scraped_at, '%Y-%m-%d') AS scraped_at
    FROM people
    JOIN {X.SQL_REPOS} r ON r.link = people.link
    LEFT JOIN work ON work.link = people.link AND work.domain = people.domain
    LEFT JOIN {X.SQL_PROJECTS} project ON project.project_link = r.project_link
    LEFT JOIN {X.SQL_COMPANIES} site ON site.domain = people.domain
    WHERE people.company_name IS NOT NULL)"""


def _contrib(t: Tables) -> DataFrame:
    contributors = _contributors(t, "commits_to_source_repo")
    return marts.mart_company_contrib(
        staging.stage_repos(X.repos(t)),
        staging.stage_projects(X.projects(t)),
        contributors,
        staging.stage_companies(X.companies(t)),
        stored(_map(t, contributors), "company_map"),
    )


@query(
    "mart_company_contrib",
    f"""
    SELECT company_name, domain, linkedin_url, repo_name, repo_description, repo_link, comp_num_of_contribs_on_repo,
           scraped_at, {_doubles('repo_num_of_contribs', 'repo_num_of_commits', 'comp_num_of_commits_on_repo')}
    FROM {SQL_CONTRIB}
    """,
)
def mart_company_contrib(t: Tables):
    return _contrib(t)


# --- metrics ---------------------------------------------------------------


_SHARED = "name, city, state, state_code, website, domain, total_assets, total_deposits"


SQL_ASSET_DEPOSIT = f"""
    WITH tagged AS (
        SELECT 'bank' AS inst_type, cert AS id_number, {_SHARED}, CAST(strptime(report_date, '%Y%m%d') AS DATE) AS report_date
        FROM {SQL_BANKS}
        UNION ALL
        SELECT 'credit union', cu_number, {_SHARED}, period FROM {SQL_UNIONS}),
    grown AS (
        SELECT *, CASE WHEN total_deposits = 0 THEN 0.0::DOUBLE
            ELSE CAST(total_deposits - LAG(total_deposits) OVER (PARTITION BY id_number, inst_type ORDER BY report_date) AS DOUBLE)
                 / CAST(total_deposits AS DOUBLE) END AS deposits_growth_prev_qtr
        FROM tagged)
    SELECT inst_type, name, city, state, state_code, website, domain, CAST(report_date AS VARCHAR) AS report_date,
           {_doubles('id_number', 'total_assets', 'total_deposits')}, deposits_growth_prev_qtr,
           CASE {ASSET_LADDER} END AS asset_tier,
           CASE {growth_ladder('deposits_growth_prev_qtr')} END AS deposits_growth_prev_qtr_tier
    FROM grown ORDER BY inst_type, id_number, report_date
    """


@query("metric_asset_deposit", SQL_ASSET_DEPOSIT)
def metric_asset_deposit(t: Tables):
    return metrics.metric_asset_deposit(_banks(t), _unions(t))


@query("metric_asset_deposit_by_period", SQL_ASSET_DEPOSIT)
def metric_asset_deposit_by_period(t: Tables):
    """The metric after two runs of the refresh: scrapes up to a day, then all."""
    root, raw = scratch_dir(t.spark, "by-period"), _regulators(t)
    first = {name: df.where(F.col("scraped_at") < F.lit("1997-05-01").cast("timestamp_ntz")) for name, df in raw.items()}
    for tables in (first, raw):
        metric, _ = refresh.refresh_regulator_tables(tables, root, buckets=2, lookup=X.nations_as_states(t))
    return metric.orderBy("inst_type", "id_number", "report_date")


@query(
    "metric_repo_totals",
    f"""
    SELECT repo_name, repo_description, repo_link, CAST(repo_num_of_commits AS DOUBLE) AS total_num_of_commits,
           CAST(repo_num_of_contribs AS DOUBLE) AS total_num_of_contribs,
           CAST(SUM(comp_num_of_contribs_on_repo) AS BIGINT) AS num_of_top10_contribs_w_comp,
           CAST(SUM(comp_num_of_commits_on_repo) AS DOUBLE) AS num_of_commits_from_top10_contribs_w_comp
    FROM {SQL_CONTRIB} GROUP BY ALL
    """,
)
def metric_repo_totals(t: Tables):
    return metrics.metric_repo_totals(_contrib(t))


@query(
    "metric_repo_company_share",
    f"""
    SELECT company_name, domain, linkedin_url, repo_name, repo_description, repo_link,
           CAST(repo_num_of_commits AS DOUBLE) AS repo_total_num_of_commits,
           CAST(comp_num_of_commits_on_repo AS DOUBLE) AS num_of_top10_contrib_commits_from_comp,
           comp_num_of_commits_on_repo::DOUBLE / repo_num_of_commits::DOUBLE AS pct_top10_contrib_commits_from_comp,
           CAST(repo_num_of_contribs AS DOUBLE) AS repo_total_num_of_contribs,
           comp_num_of_contribs_on_repo AS num_of_top10_contribs_from_comp,
           comp_num_of_contribs_on_repo::DOUBLE / repo_num_of_contribs::DOUBLE AS pct_top10_contribs_from_comp,
           scraped_at
    FROM {SQL_CONTRIB}
    """,
)
def metric_repo_company_share(t: Tables):
    return metrics.metric_repo_company_share(_contrib(t))


# Row sizes: a 24-byte header, 8 bytes per long, double or time, 4 per int,
# 10 per 18-digit decimal, 14 per 26-digit one, and text by its length.
_PROFILED = {
    ("raw", "orders"): ("orders", X.quarter("o_orderdate"), "24 + 32 + strlen(o_orderstatus) + strlen(o_orderpriority)"),
    ("raw", "lineitem"): ("lineitem", X.quarter("l_shipdate"), "24 + 68 + strlen(l_returnflag) + strlen(l_linestatus)"),
    ("raw", "events"): ("events", "CAST(ts AS DATE)", "24 + 32 + strlen(event_type) + strlen(props)"),
    ("staging", "bank_financials"): (
        f"{X.SQL_FINANCIALS} f", "report_date", "24 + 10 + 2 * 14 + 8 + strlen(name) + strlen(report_date) + strlen(dim_id)",
    ),
    ("staging", "cu_fs220n"): (
        f"{X.SQL_FS220N} n", "cycle_date", "24 + 10 + 14 + 8 + strlen(cycle_date) + strlen(dim_id)",
    ),
    ("data_marts", "banks"): (
        f"{SQL_BANKS} b", "report_date",
        "24 + 10 + 2 * 14 + " + " + ".join(
            f"COALESCE(strlen({c}), 0)"
            for c in ("name", "city", "state", "state_code", "website", "domain", "report_date", "dim_id")
        ),
    ),
}
SQL_PROFILE = " UNION ALL ".join(
    f"SELECT '{schema}' AS schema_name, '{table}' AS table_name, CAST({period} AS VARCHAR) AS period, "
    f"CAST(SUM({size}) AS BIGINT) AS current_size_bytes FROM {source} GROUP BY ALL"
    for (schema, table), (source, period, size) in _PROFILED.items()
)


def _profile(t: Tables) -> DataFrame:
    return metrics.size_profile(
        {
            ("raw", "orders"): (t.orders, quarter_end("o_orderdate")),
            ("raw", "lineitem"): (t.lineitem, quarter_end("l_shipdate")),
            ("raw", "events"): (t.events, F.to_date("ts")),
            ("staging", "bank_financials"): (stg_financials(t).drop("period"), "report_date"),
            ("staging", "cu_fs220n"): (stg_fs220n(t).drop("period"), "cycle_date"),
            ("data_marts", "banks"): (_banks(t).drop("period"), "report_date"),
        }
    )


@query(
    "size_profile",
    f"""
    SELECT *, AVG(current_size_bytes) OVER (PARTITION BY schema_name, table_name) AS avg_size_bytes_by_qtrly_rp_date
    FROM ({SQL_PROFILE})
    """,
)
def size_profile(t: Tables):
    return _profile(t)


@query(
    "size_forecast",
    f"""
    WITH per_table AS (
        SELECT schema_name, table_name, SUM(current_size_bytes) AS current, AVG(current_size_bytes) AS average
        FROM ({SQL_PROFILE}) GROUP BY 1, 2),
    totals AS (SELECT SUM(current)::DOUBLE / 1073741824.0 AS current, SUM(average / 1073741824.0) AS average FROM per_table)
    SELECT months, round(current + average * months / 3.0, 9) AS total_size_gb,
           CAST(CAST(DATE '2024-01-31' + to_months(CAST(months AS INTEGER)) AS DATE) AS VARCHAR) AS future_date
    FROM totals, (VALUES (3), (6), (9), (12)) h(months)
    """,
)
def size_forecast(t: Tables):
    totals = metrics.size_totals(_profile(t))
    today = F.lit("2024-01-31").cast("date")
    projected = metrics.size_projection(
        totals, "total_current_size_gb", "total_avg_size_gb_by_qtrly_rp_date", today
    )
    return projected.withColumn("total_size_gb", F.round("total_size_gb", 9))
