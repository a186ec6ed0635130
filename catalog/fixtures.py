"""Raw regulator and page tables derived from the given tables.

Each raw table exists twice: as a DataFrame for the jobs, and as SQL for their
oracles. The given tables' keys play the entities: customers are banks,
suppliers are credit unions and contributors, parts are repositories and nations
are companies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalog.registry import Tables
from tidemark.functions.dates import quarter_end
from tidemark.schemas import ENTITY_ID, MONEY

START = "timestamp '2024-01-01 00:00:00'"
SITE = "https://code.example"


def _text(*parts: str | Column) -> Column:
    """Parts joined as text: ``"$name"`` is a column, other text stands for itself."""
    return F.concat(*[_part(p) for p in parts])


def _part(part: str | Column) -> Column:
    if isinstance(part, Column):
        return part
    return F.col(part[1:]) if part.startswith("$") else F.lit(part)


def _after(seconds: str) -> Column:
    return F.expr(f"{START} + make_dt_interval(0, 0, 0, {seconds})")


def _whole(column: str, factor: float = 1.0) -> Column:
    return F.floor(F.col(column) * F.lit(factor))


# --- regulators ------------------------------------------------------------


def bank_financials(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").cast(ENTITY_ID).alias("cert"),
        _text("Bank ", "$o_custkey").alias("namefull"),
        _whole("o_totalprice").cast(MONEY).alias("asset"),
        _whole("o_totalprice", 0.5).cast(MONEY).alias("dep"),
        F.date_format(quarter_end("o_orderdate"), "yyyyMMdd").alias("repdte"),
        F.col("o_orderdate").alias("scraped_at"),
    )


def bank_institutions(t: Tables) -> DataFrame:
    kind = F.col("o_orderkey") % 4
    site = (
        F.when(kind == 0, _text("https://www.bank", "$o_custkey", ".example.com/home?x=1"))
        .when(kind == 1, _text("www.bank", "$o_custkey", ".example.org/a"))
        .when(kind == 2, _text("bank", "$o_custkey", ".example.net"))
    )
    return t.orders.select(
        F.col("o_custkey").cast(ENTITY_ID).alias("cert"),
        F.when(F.col("o_orderkey") % 7 != 0, _text("Bank ", "$o_custkey")).alias("name"),
        F.col("o_orderpriority").alias("city"),
        _text("NATION_", F.col("o_orderkey") % 25).alias("stname"),
        site.alias("webaddr"),
        F.date_format(quarter_end("o_orderdate"), "MM/dd/yyyy").alias("repdte"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("dateupdt"),
        F.col("o_orderdate").alias("scraped_at"),
    )


def _cycle() -> Column:
    return F.date_format(quarter_end("l_shipdate"), "M/d/yyyy").alias("cycle_date")


def _charter() -> Column:
    return F.col("l_suppkey").cast(ENTITY_ID).alias("cu_number")


def _seen() -> Column:
    return F.col("l_shipdate").alias("scraped_at")


def cu_branches(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _charter(),
        _text("Union ", "$l_suppkey").alias("cu_name"),
        F.col("l_returnflag").alias("physical_address_city"),
        (F.col("l_partkey") % 25).cast("string").alias("physical_address_state_code"),
        _cycle(),
        _seen(),
    )


def cu_fs220(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _charter(),
        _cycle(),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("update_date"),
        _whole("l_extendedprice").cast(MONEY).alias("acct_010"),
        _whole("l_extendedprice", 0.5).cast(MONEY).alias("acct_018"),
        F.col("l_partkey").cast(MONEY).alias("acct_025b"),
        _whole("l_quantity").cast(MONEY).alias("acct_083"),
        F.col("l_orderkey").cast(MONEY).alias("acct_902"),
        _seen(),
    )


def cu_fs220a(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _charter(),
        _cycle(),
        _whole("l_quantity").cast("string").alias("acct_452"),
        _text(_whole("l_extendedprice"), ".50").alias("acct_115"),
        F.col("l_partkey").cast("string").alias("acct_350"),
        F.col("l_orderkey").cast("string").alias("acct_131"),
        _seen(),
    )


def cu_fs220d(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _charter(),
        _cycle(),
        _text("https://www.cu", "$l_suppkey", ".example.com/", "$l_linenumber").alias("acct_891"),
        _seen(),
    )


def cu_fs220n(t: Tables) -> DataFrame:
    return t.lineitem.select(
        _charter(), _cycle(), F.col("l_orderkey").cast("string").alias("acct_is0020"), _seen()
    )


def nations_as_states(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_name").alias("state"), F.col("n_nationkey").cast("string").alias("alpha2")
    )


# --- crawled pages ---------------------------------------------------------


def projects(t: Tables) -> DataFrame:
    return t.part.select(
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("id"),
        F.col("p_type").alias("section"),
        _text("Project ", "$p_brand").alias("project_title"),
        _text(f"{SITE}/", "$p_brand").alias("project_link"),
        F.when(F.col("p_size") % 2 == 0, _text("About ", "$p_brand", " ", "$p_size")).alias(
            "project_description"
        ),
        _after("p_partkey % 1000").alias("scraped_at"),
    )


def repos(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    return t.part.select(
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("id"),
        F.col("p_name").alias("name"),
        _text(f"{SITE}/o/r", F.expr("p_partkey div 2")).alias("link"),
        F.col("p_type").alias("description"),
        _text(f"{SITE}/", "$p_brand").alias("project_link"),
        F.array("p_type", "p_brand").alias("tags"),
        F.array(F.struct(F.col("p_brand").alias("name"), F.lit("50%").alias("pct"))).alias("languages"),
        size.alias("pull_requests"),
        _text("1,", F.lpad(size, 3, "0")).alias("commits"),
        _text(size, ".5k").alias("stargazers"),
        F.when(F.col("p_size") % 5 == 0, "null").otherwise(size).alias("forks"),
        (F.col("p_size") + 1).cast("string").alias("contributors"),
        F.when(F.col("p_size") % 7 == 0, "null")
        .otherwise(_text("2023-05-", F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"), "T10:00:00"))
        .alias("last_updated"),
        _after("p_partkey").alias("scraped_at"),
    )


def contributors(t: Tables) -> DataFrame:
    quantity = _whole("l_quantity").cast("string")
    return t.lineitem.select(
        _text(
            F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), "-", "$l_linenumber", "-",
            F.lpad(quantity, 3, "0"),
        ).alias("id"),
        _text("repo", F.expr("l_partkey div 2")).alias("repo_name"),
        _text(f"{SITE}/o/r", F.expr("l_partkey div 2")).alias("source_repo_link"),
        _text(f"{SITE}/u", "$l_suppkey").alias("profile_link"),
        _text(quantity, " commits").alias("commits_to_source_repo"),
        F.col("l_shipdate").alias("scraped_at"),
    )


def profiles(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    nobody = F.lit(None).cast("string")
    return t.customer.select(
        F.lpad(key, 12, "0").alias("id"),
        _text(f"{SITE}/u", F.expr("c_custkey div 15")).alias("link"),
        key.alias("number_of_repos"),
        _text("1.", F.col("c_custkey") % 10, "k").alias("number_of_stars"),
        _text(key, " followers").alias("number_of_followers"),
        F.when(F.col("c_custkey") % 4 == 0, "null").otherwise(key).alias("number_following"),
        _text("1,", F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), " contributions in the last year").alias(
            "number_of_contributions_past_year"
        ),
        F.when(F.col("c_nationkey") % 5 != 0, _text("NATION_", "$c_nationkey")).alias("company_name"),
        nobody.alias("email_domain"),
        F.lit(None).cast("array<struct<name:string,href:string,order:int>>").alias("organizations"),
        _after("c_custkey % 7").alias("scraped_at"),
    )


def companies(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.lpad(F.col("s_suppkey").cast("string"), 12, "0").alias("id"),
        F.col("s_name").alias("name"),
        _text("https://www.nation", "$s_nationkey", ".example.com/", "$s_suppkey").alias("website"),
        _text("nation", "$s_nationkey", ".example.com").alias("domain"),
        F.lit(None).cast("string").alias("github_url"),
        F.when(F.col("s_suppkey") % 3 != 0, _text("https://www.linkedin.com/company/", "$s_suppkey")).alias(
            "linkedin_url"
        ),
        F.lit(None).cast("string").alias("facebook_url"),
        F.lit(None).cast("string").alias("twitter_url"),
        _after("s_suppkey").alias("scraped_at"),
    )


def enrichment(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    domain = F.when(key % 11 != 0, _text("nation", "$c_nationkey", ".example.com"))
    answer = F.struct(_text("Company ", "$c_nationkey", "-", "$c_custkey").alias("name"), domain.alias("domain"))
    asked = F.struct(F.when(key % 13 != 0, _text("NATION_", "$c_nationkey")).alias("og_company_name"))
    return t.customer.select(
        key.alias("id"),
        F.to_json(F.array(answer)).alias("outputs"),
        F.to_json(asked).alias("meta"),
        _after("c_custkey % 1000").alias("created_at"),
    )


# --- the same tables, staged, in SQL ---------------------------------------


def quarter(column: str) -> str:
    return f"CAST(date_trunc('quarter', {column}) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"


def newest(table: str, keys: str, order: str) -> str:
    return (
        f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {table}) WHERE rn = 1)"
    )


SQL_FINANCIALS = f"""(
    SELECT DISTINCT cert, name, asset * 1000 AS total_assets, dep * 1000 AS total_deposits, report_date,
           md5(cert || name || asset || dep || report_date || day) AS dim_id, day
    FROM (SELECT o_custkey AS cert, 'Bank ' || o_custkey AS name,
                 CAST(floor(o_totalprice) AS BIGINT) AS asset,
                 CAST(floor(o_totalprice * 0.5) AS BIGINT) AS dep,
                 strftime({quarter('o_orderdate')}, '%Y%m%d') AS report_date,
                 strftime(o_orderdate, '%Y%m%d') AS day FROM orders))"""

SQL_INSTITUTIONS = f"""(
    SELECT DISTINCT *, md5(cert || COALESCE(name, '') || city || state || COALESCE(website, '')
                           || date_updated || report_date || day) AS dim_id
    FROM (SELECT o_custkey AS cert, CASE WHEN o_orderkey % 7 <> 0 THEN 'Bank ' || o_custkey END AS name,
                 o_orderpriority AS city, 'NATION_' || (o_orderkey % 25) AS state,
                 CASE o_orderkey % 4 WHEN 0 THEN 'https://www.bank' || o_custkey || '.example.com/home?x=1'
                      WHEN 1 THEN 'www.bank' || o_custkey || '.example.org/a'
                      WHEN 2 THEN 'bank' || o_custkey || '.example.net' END AS website,
                 strftime({quarter('o_orderdate')}, '%m/%d/%Y') AS report_date,
                 strftime(o_orderdate, '%m/%d/%Y') AS date_updated,
                 strftime(o_orderdate, '%Y%m%d') AS day FROM orders))"""

_LINES = f"""(
    SELECT *, l_suppkey AS cu_number, {quarter('l_shipdate')} AS period,
           strftime({quarter('l_shipdate')}, '%-m/%-d/%Y') AS cycle_date,
           strftime(l_shipdate, '%Y%m%d') AS day, CAST(floor(l_extendedprice) AS BIGINT) AS price,
           CAST(floor(l_extendedprice * 0.5) AS BIGINT) AS half, CAST(floor(l_quantity) AS BIGINT) AS quantity
    FROM lineitem)"""

SQL_BRANCHES = f"""(
    SELECT DISTINCT *, md5(cu_number || name || city || state_code || cycle_date || day) AS dim_id
    FROM (SELECT cu_number, 'Union ' || cu_number AS name, l_returnflag AS city,
                 CAST(l_partkey % 25 AS VARCHAR) AS state_code, cycle_date, period, day FROM {_LINES}))"""

SQL_FS220 = f"""(
    SELECT DISTINCT *, md5(cu_number || cycle_date || update_date || total_assets || total_deposits
                           || loans_for_investment || current_members || dda_div_shr_dft_amt || day) AS dim_id
    FROM (SELECT cu_number, cycle_date, period, strftime(l_shipdate, '%m/%d/%Y') AS update_date,
                 price AS total_assets, half AS total_deposits, l_partkey AS loans_for_investment,
                 quantity AS current_members, l_orderkey AS dda_div_shr_dft_amt, day FROM {_LINES}))"""

SQL_FS220A = f"""(
    SELECT DISTINCT *, md5(cu_number || cycle_date || dda_div_shr_dft_cnt || price || '.50'
                           || total_int_exp_ytd || service_chg_ytd || day) AS dim_id
    FROM (SELECT cu_number, cycle_date, period, quantity AS dda_div_shr_dft_cnt, price,
                 price + 0.5 AS total_int_inc_ytd, l_partkey AS total_int_exp_ytd,
                 l_orderkey AS service_chg_ytd, day FROM {_LINES}))"""

SQL_FS220D = f"""(
    SELECT DISTINCT *, md5(cu_number || cycle_date || website || day) AS dim_id
    FROM (SELECT cu_number, cycle_date, period,
                 'https://www.cu' || cu_number || '.example.com/' || l_linenumber AS website, day FROM {_LINES}))"""

SQL_FS220N = f"""(
    SELECT DISTINCT *, md5(cu_number || cycle_date || other_non_int_inc_ytd || day) AS dim_id
    FROM (SELECT cu_number, cycle_date, period, l_orderkey AS other_non_int_inc_ytd, day FROM {_LINES}))"""

DAY_START = "strftime(strptime(day, '%Y%m%d'), '%Y-%m-%d %H:%M:%S') AS scraped_at"
SHOW_SCRAPED = "strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at"


def _at(seconds: str) -> str:
    return f"TIMESTAMP '2024-01-01 00:00:00' + to_seconds({seconds})"


SQL_PROJECTS = newest(
    f"""(SELECT p_partkey, p_type AS section, 'Project ' || p_brand AS project_title,
                '{SITE}/' || p_brand AS project_link,
                CASE WHEN p_size % 2 = 0 THEN 'About ' || p_brand || ' ' || p_size END AS project_description,
                {_at('p_partkey % 1000')} AS scraped_at FROM part)""",
    "project_link",
    "scraped_at DESC, p_partkey DESC",
)

SQL_REPOS = newest(
    f"""(SELECT p_partkey, p_name AS name, '{SITE}/o/r' || (p_partkey // 2) AS link, p_type AS description,
                '{SITE}/' || p_brand AS project_link, p_size AS pull_requests, 1000 + p_size AS commits,
                (p_size + 0.5) * 1000 AS stargazers, CASE WHEN p_size % 5 <> 0 THEN p_size END AS forks,
                p_size + 1 AS contributors,
                CASE WHEN p_size % 7 <> 0 THEN '2023-05-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') || ' 10:00:00'
                END AS last_updated,
                p_type || ',' || p_brand AS tags, {_at('p_partkey')} AS scraped_at FROM part)""",
    "link",
    "scraped_at DESC, p_partkey DESC",
)

SQL_CONTRIBUTORS = newest(
    f"""(SELECT l_orderkey, l_linenumber, 'repo' || (l_partkey // 2) AS repo_name,
                '{SITE}/o/r' || (l_partkey // 2) AS source_repo_link, '{SITE}/u' || l_suppkey AS profile_link,
                CAST(floor(l_quantity) AS BIGINT) AS commits_to_source_repo, l_shipdate AS scraped_at FROM lineitem)""",
    "source_repo_link, profile_link",
    "scraped_at DESC, l_orderkey DESC, l_linenumber DESC, commits_to_source_repo DESC",
)

SQL_PROFILES = newest(
    f"""(SELECT c_custkey, '{SITE}/u' || (c_custkey // 15) AS link, c_custkey AS number_of_repos,
                (10 + c_custkey % 10) * 100 AS number_of_stars, c_custkey * 1 AS number_of_followers,
                CASE WHEN c_custkey % 4 <> 0 THEN c_custkey END AS number_following,
                1000 + c_nationkey AS number_of_contributions_past_year,
                CASE WHEN c_nationkey % 5 <> 0 THEN 'NATION_' || c_nationkey END AS company_name,
                {_at('c_custkey % 7')} AS scraped_at FROM customer)""",
    "link",
    "scraped_at DESC, c_custkey DESC",
)

SQL_COMPANIES = newest(
    f"""(SELECT s_suppkey, 'nation' || s_nationkey || '.example.com' AS domain,
                CASE WHEN s_suppkey % 3 <> 0 THEN 'https://www.linkedin.com/company/' || s_suppkey END AS linkedin_url,
                {_at('s_suppkey')} AS scraped_at FROM supplier)""",
    "domain",
    "scraped_at DESC, s_suppkey DESC",
)

SQL_ENRICHED = newest(
    f"""(SELECT c_custkey, 'Company ' || c_nationkey || '-' || c_custkey AS company_name,
                'nation' || c_nationkey || '.example.com' AS domain, 'NATION_' || c_nationkey AS asked,
                {_at('c_custkey % 1000')} AS created_at FROM customer
         WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0)""",
    "domain",
    "created_at DESC, c_custkey DESC",
)
