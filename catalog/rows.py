"""Projections, filters, scalar functions and table functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import Tables, query
from tidemark.functions import dates, keys, numbers, sql, text
from tidemark.operators import columns
from tidemark.operators.growth import growth_vs_prev
from tidemark.plans import metrics
from tidemark.sources.lookups import name_of

PRICE = T.DecimalType(20, 2)


@query("project_rename", "SELECT s_suppkey AS supplier, s_name AS name FROM supplier")
def project_rename(t: Tables):
    return columns.project(t.supplier, {"supplier": "s_suppkey", "name": "s_name"})


@query(
    "cast_projection",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
           CAST(CAST(p_size AS VARCHAR) || '.25' AS DOUBLE) AS size_number,
           CAST(p_retailprice AS DOUBLE) AS p_retailprice,
           NULL::DOUBLE AS name_number
    FROM part
    """,
)
def cast_projection(t: Tables):
    texts = t.part.select(
        "p_partkey",
        F.concat(F.col("p_size").cast("string"), F.lit(".25")).alias("size_number"),
        "p_retailprice",
        F.col("p_name").alias("name_number"),
    )
    strict = columns.cast_columns(
        texts, {"p_partkey": "string", "size_number": PRICE, "p_retailprice": PRICE}
    )
    return columns.cast_columns(strict, {"name_number": "double"}, safe=True)


@query(
    "unit_scale",
    "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(20,2)) * 1000 AS DOUBLE) AS dollars FROM orders",
)
def unit_scale(t: Tables):
    price = F.col("o_totalprice").cast(PRICE)
    return t.orders.select("o_orderkey", numbers.unit_scale(price).alias("dollars"))


@query("literal_tag", "SELECT c_custkey, 'customer' AS kind FROM customer")
def literal_tag(t: Tables):
    return t.customer.select("c_custkey", F.lit("customer").alias("kind"))


@query(
    "star_extend",
    "SELECT *, p_size * 2 AS double_size, p_brand || '/' || p_type AS label FROM part",
)
def star_extend(t: Tables):
    return columns.extend(
        t.part, {"double_size": F.col("p_size") * 2, "label": F.concat("p_brand", F.lit("/"), "p_type")}
    )


@query(
    "not_null_filter",
    """
    SELECT event_id, user_id FROM events
    WHERE json_extract_string(props, '$.k') IS NOT NULL AND value IS NOT NULL
    """,
)
def not_null_filter(t: Tables):
    return columns.not_null(t.events, text.json_text("props", "$.k"), "value").select(
        "event_id", "user_id"
    )


@query(
    "equality_filter",
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) = DATE '1997-05-28'
    """,
)
def equality_filter(t: Tables):
    # A day is a range of times: as bounds it reaches the scan, as a cast it would not.
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1997-05-28", "1997-05-29"))
    day = t.orders.filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))
    return columns.equals(day, o_orderstatus="F").select("o_orderkey", "o_orderstatus")


@query(
    "null_sentinel",
    """
    SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name END AS name FROM part
    """,
)
def null_sentinel(t: Tables):
    stored = t.part.select(
        "p_partkey", F.when(F.col("p_size") % 5 == 0, "null").otherwise(F.col("p_name")).alias("name")
    )
    return stored.select("p_partkey", text.null_sentinel("name").alias("name"))


@query(
    "coalesce_pick",
    "SELECT p_partkey, COALESCE(NULLIF(p_type, 'SMALL'), p_brand) AS label FROM part",
)
def coalesce_pick(t: Tables):
    return t.part.select(
        "p_partkey",
        F.coalesce(F.nullif(F.col("p_type"), F.lit("SMALL")), "p_brand").alias("label"),
    )


# Fixed values, written out apart from the library's own so that either can catch the other's mistake.
ASSET_LADDER = """
    WHEN total_assets < 500000000 THEN 'Less than $500M'
    WHEN total_assets < 1000000000 THEN '$500M to $1B'
    WHEN total_assets < 5000000000 THEN '$1B to $5B'
    WHEN total_assets < 10000000000 THEN '$5B to $10B'
    WHEN total_assets < 50000000000 THEN '$10B to $50B'
    WHEN total_assets < 100000000000 THEN '$50B to $100B'
    WHEN total_assets < 500000000000 THEN '$100B to $500B'
    WHEN total_assets < 1000000000000 THEN '$500B to $1T'
    WHEN total_assets < 3000000000000 THEN '$1T to $3T'
    ELSE 'Greater than $3T'
"""


def growth_ladder(column: str) -> str:
    """The growth tiers as CASE branches; NULL meets none of them."""
    return f"""
        WHEN {column} <= -0.05 THEN '>5% decline'
        WHEN {column} <= 0.0 THEN '0% to 5% decline'
        WHEN {column} <= 0.05 THEN '0% to 5% growth'
        WHEN {column} > 0.05 THEN '>5% growth'
    """


@query(
    "tier_upper_bounds",
    f"""
    SELECT o_orderkey, CASE {ASSET_LADDER.replace('total_assets', 'assets')} END AS tier
    FROM (SELECT o_orderkey,
                 CASE WHEN o_orderstatus = 'P' THEN NULL
                      ELSE CAST(o_totalprice AS DECIMAL(20,2)) * (1 + o_orderkey % 50 * o_orderkey % 20000000)
                 END AS assets
          FROM orders)
    """,
)
def tier_upper_bounds(t: Tables):
    key = F.col("o_orderkey")
    spread = (F.lit(1) + key % 50 * key % 20000000).cast("decimal(10,0)")
    assets = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast(PRICE) * spread)
    return t.orders.select("o_orderkey", numbers.tier_below(assets).alias("tier"))


def _customer_quarters(t: Tables):
    return (
        t.orders.select(
            "o_custkey",
            dates.quarter_end("o_orderdate").alias("quarter"),
            F.col("o_totalprice").cast(PRICE).alias("price"),
        )
        .groupBy("o_custkey", "quarter")
        .agg(F.sum("price").cast(PRICE).alias("deposits"))
    )


CUSTOMER_QUARTERS = """
    SELECT o_custkey,
           CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter,
           SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS deposits
    FROM orders GROUP BY 1, 2
"""
CUSTOMER_GROWTH = f"""
    SELECT o_custkey, quarter, deposits,
           CASE WHEN deposits = 0 THEN 0.0
                ELSE CAST((deposits - LAG(deposits) OVER (PARTITION BY o_custkey ORDER BY quarter)) * 100 AS DOUBLE)
                     / CAST(deposits * 100 AS DOUBLE) END AS growth
    FROM ({CUSTOMER_QUARTERS})
"""


@query(
    "growth_tier",
    f"""
    SELECT o_custkey, CAST(quarter AS VARCHAR) AS quarter,
           CASE {growth_ladder('growth')} END AS tier
    FROM ({CUSTOMER_GROWTH})
    """,
)
def growth_tier(t: Tables):
    grown = growth_vs_prev(_customer_quarters(t), ["o_custkey"], "quarter", "deposits", "growth")
    return grown.select("o_custkey", "quarter", numbers.growth_tier("growth").alias("tier"))


@query(
    "guarded_divide",
    """
    SELECT p_partkey, CASE WHEN p_size - 10 = 0 THEN 0 ELSE p_retailprice / (p_size - 10) END AS share
    FROM part
    """,
)
def guarded_divide(t: Tables):
    return t.part.select(
        "p_partkey", numbers.guarded_divide("p_retailprice", F.col("p_size") - 10).alias("share")
    )


@query("md5_key_strict", "SELECT s_suppkey, md5(s_suppkey || s_name || NULLIF(s_nationkey, 3)) AS key FROM supplier")
def md5_key_strict(t: Tables):
    nation = F.nullif(F.col("s_nationkey"), F.lit(3))
    return t.supplier.select("s_suppkey", keys.md5_key(["s_suppkey", "s_name", nation]).alias("key"))


@query(
    "md5_key_coalesced",
    """
    SELECT s_suppkey,
           md5(s_suppkey || COALESCE(s_name, '') || COALESCE(CAST(NULLIF(s_nationkey, 3) AS VARCHAR), '')) AS key
    FROM supplier
    """,
)
def md5_key_coalesced(t: Tables):
    nation = F.nullif(F.col("s_nationkey"), F.lit(3))
    return t.supplier.select(
        "s_suppkey", keys.md5_key(["s_suppkey"], optional=["s_name", nation]).alias("key")
    )


@query("md5_single", "SELECT page_id, md5(url) AS key FROM pages")
def md5_single(t: Tables):
    return t.pages.select("page_id", keys.md5_key(["url"]).alias("key"))


@query("day_string", "SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events")
def day_string(t: Tables):
    return t.events.select("event_id", dates.day_string("ts").alias("day"))


@query(
    "parse_day",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders",
)
def parse_day(t: Tables):
    spellings = F.array(
        *[F.date_format("o_orderdate", f) for f in ("yyyyMMdd", "M/d/yyyy", "M/d/yyyy H:mm:ss", "yyyy-MM-dd")]
    )
    written = t.orders.select(
        "o_orderkey", F.get(spellings, (F.col("o_orderkey") % 4).cast("int")).alias("written")
    )
    return written.select("o_orderkey", dates.parse_day("written").alias("day"))


@query("load_stamp", "SELECT o_orderkey, '2024-01-02 03:04:05' AS loaded_at FROM orders")
def load_stamp(t: Tables):
    now = F.lit("2024-01-02 03:04:05").cast("timestamp")
    return t.orders.select("o_orderkey", dates.load_stamp(now).alias("loaded_at"))


@query(
    "url_domain",
    r"""
    SELECT page_id, written, regexp_extract(written, '(?s)(?:.*://)?(?:www\.)?([^/?]*)', 1) AS domain
    FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN replace(url, '://', '://www.')
                 WHEN 2 THEN upper(url) ELSE NULL END AS written FROM pages)
    """,
)
def url_domain(t: Tables):
    kind = F.col("page_id") % 4
    written = (
        F.when(kind == 0, F.col("url"))
        .when(kind == 1, F.replace("url", F.lit("://"), F.lit("://www.")))
        .when(kind == 2, F.upper("url"))
    )
    return t.pages.select("page_id", written.alias("written")).withColumn(
        "domain", text.url_domain("written")
    )


@query("split_first", "SELECT doc_id, split_part(text, ' ', 1) AS word FROM documents")
def split_first(t: Tables):
    return t.documents.select("doc_id", text.split_first("text").alias("word"))


@query(
    "strip_non_numeric",
    "SELECT doc_id, regexp_replace(text, '[^0-9.]', '', 'g') AS digits FROM documents",
)
def strip_non_numeric(t: Tables):
    return t.documents.select("doc_id", text.strip_non_numeric("text").alias("digits"))


@query(
    "json_path_text",
    """
    SELECT event_id, json_extract_string('[' || props || ']', '$[0].k') AS k,
           json_extract_string('[' || props || ']', '$[0].absent') AS absent
    FROM events
    """,
)
def json_path_text(t: Tables):
    wrapped = F.concat(F.lit("["), "props", F.lit("]"))
    return t.events.select(
        "event_id",
        text.json_text(wrapped, "$[0].k").alias("k"),
        text.json_text(wrapped, "$[0].absent").alias("absent"),
    )


@query("ratio", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity AS unit FROM lineitem")
def ratio(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.ratio("l_extendedprice", "l_quantity").alias("unit")
    )


@query("bytes_to_gib", "SELECT doc_id, n_chars::DOUBLE / 1073741824.0::DOUBLE AS gib FROM documents")
def bytes_to_gib(t: Tables):
    return t.documents.select("doc_id", numbers.bytes_to_gib("n_chars").alias("gib"))


@query(
    "months_ahead",
    """
    SELECT o_orderkey, CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS later
    FROM orders
    """,
)
def months_ahead(t: Tables):
    return t.orders.select("o_orderkey", dates.months_ahead("o_orderdate", 3).alias("later"))


@query(
    "previous_quarter_end",
    """
    SELECT o_orderkey,
           CAST(CAST(date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS quarter
    FROM orders
    """,
)
def previous_quarter_end(t: Tables):
    return t.orders.select("o_orderkey", dates.previous_quarter_end("o_orderdate").alias("quarter"))


@query(
    "format_period",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%m/%d/%Y') AS us,
           strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y-%m') AS year_month
    FROM orders
    """,
)
def format_period(t: Tables):
    styles = [dates.format_period("o_orderdate", s).alias(s) for s in dates.PERIOD_STYLES]
    return t.orders.select("o_orderkey", *styles)


@query(
    "state_name_of",
    """
    SELECT c_custkey, n_name AS place
    FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN 'NATION_' || c_nationkey
                    WHEN 1 THEN CAST(c_nationkey AS VARCHAR) ELSE 'nowhere' END AS written FROM customer)
    LEFT JOIN nation ON written = n_name OR written = CAST(n_nationkey AS VARCHAR)
    """,
)
def state_name_of(t: Tables):
    kind = F.col("c_custkey") % 3
    written = (
        F.when(kind == 0, F.concat(F.lit("NATION_"), "c_nationkey"))
        .when(kind == 1, F.col("c_nationkey").cast("string"))
        .otherwise("nowhere")
    )
    named = t.nation.select("n_name", F.col("n_nationkey").cast("string").alias("code"))
    people = t.customer.select("c_custkey", written.alias("written"))
    return name_of(people, "written", named, "n_name", "code", "place").drop("written")


SQL_COUNTERS = """
    SELECT p_partkey,
           CASE WHEN written = 'null' THEN NULL
                ELSE CAST(regexp_replace(written, '[^0-9.]', '', 'g') AS DOUBLE)
                     * CASE WHEN contains(written, 'k') THEN 1000 ELSE 1 END END AS number
    FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '1,' || lpad(CAST(p_size AS VARCHAR), 3, '0')
                 WHEN 1 THEN p_size || '.5k' WHEN 2 THEN p_size || ' commits'
                 WHEN 3 THEN 'null' ELSE p_size || '+ likes' END AS written FROM part)
    """


def _counters(t: Tables):
    kind, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    written = (
        F.when(kind == 0, F.concat(F.lit("1,"), F.lpad(size, 3, "0")))
        .when(kind == 1, F.concat(size, F.lit(".5k")))
        .when(kind == 2, F.concat(size, F.lit(" commits")))
        .when(kind == 3, "null")
        .otherwise(F.concat(size, F.lit("+ likes")))
    )
    return t.part.select("p_partkey", written.alias("written"))


@query("text_to_num", SQL_COUNTERS)
def text_to_num(t: Tables):
    return _counters(t).select("p_partkey", text.text_to_num("written").alias("number"))


@query("text_to_num_sql", SQL_COUNTERS)
def text_to_num_sql(t: Tables):
    """The counter rule as SQL calls it."""
    sql.register(t.spark)
    _counters(t).createOrReplaceTempView("written_counters")
    return t.spark.sql("SELECT p_partkey, text_to_num(written) AS number FROM written_counters")


# Customer balances stand in for table sizes: current size and average growth.
SIZES = """
    SELECT c_nationkey, CAST(SUM(CAST(round(c_acctbal) AS BIGINT)) AS BIGINT) AS current_size,
           COUNT(*) AS average
    FROM customer GROUP BY 1
"""


def _sizes(t: Tables):
    return t.customer.groupBy("c_nationkey").agg(
        F.sum(F.round("c_acctbal").cast("bigint")).alias("current_size"),
        F.count("*").alias("average"),
    )


SQL_PROJECTION = f"""
    SELECT months, current_size::DOUBLE + (average * months)::DOUBLE / 3::DOUBLE AS total_size_gb,
           CAST(CAST(DATE '2024-01-31' + to_months(CAST(months AS INTEGER)) AS DATE) AS VARCHAR) AS future_date
    FROM ({SIZES}), (VALUES (3), (6), (9), (12)) h(months)
    """


@query("size_projection", SQL_PROJECTION)
def size_projection(t: Tables):
    today = F.lit("2024-01-31").cast("date")
    return metrics.size_projection(_sizes(t), "current_size", "average", today)


@query("size_projection_sql", SQL_PROJECTION)
def size_projection_sql(t: Tables):
    """The projection as SQL calls it."""
    sql.register(t.spark)
    _sizes(t).createOrReplaceTempView("table_sizes")
    return t.spark.sql(
        "SELECT p.* FROM table_sizes, LATERAL size_projection(CAST(current_size AS DOUBLE), CAST(average AS DOUBLE), DATE'2024-01-31') AS p"
    )


_COSTS = ", ".join(
    f"CAST(current_size + average * {m} AS BIGINT) AS gb_in_{m}_months, "
    f"(current_size + average * {m})::DOUBLE * 0.4::DOUBLE AS cost_in_{m}_months_usd"
    for m in (3, 6, 9, 12)
)


@query(
    "cost_projection",
    f"""
    SELECT c_nationkey, current_size, average,
           current_size::DOUBLE * 0.4::DOUBLE AS current_cost_per_month_usd, {_COSTS}
    FROM ({SIZES})
    """,
)
def cost_projection(t: Tables):
    return metrics.cost_projection(_sizes(t), "current_size", "average")
