"""Joins, aggregations, windows, unions, key audits and incremental forms."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import Tables, query
from catalog.rows import CUSTOMER_GROWTH, PRICE, _customer_quarters
from tidemark.functions import dates, text
from tidemark.operators import aggregates, growth, joins, quality, sizes, snapshots
from tidemark.session import scratch_dir
from tidemark.streaming import incremental


# --- joins -----------------------------------------------------------------


@query(
    "left_join_key",
    """
    SELECT c_custkey, c_mktsegment, o_orderkey
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    """,
)
def left_join_key(t: Tables):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    customers = t.customer.select("c_custkey", "c_mktsegment")
    return joins.left_join(customers, orders, ["c_custkey"])


@query(
    "left_join_period",
    """
    SELECT o_orderkey, o_custkey, m.quantity
    FROM orders LEFT JOIN (
        SELECT l_suppkey, strftime(l_shipdate, '%m/%d/%Y') AS shipped,
               CAST(SUM(CAST(l_quantity AS DECIMAL(20,2))) AS DOUBLE) AS quantity
        FROM lineitem GROUP BY 1, 2) m
    ON m.l_suppkey = o_custkey AND strptime(m.shipped, '%m/%d/%Y') = o_orderdate
    """,
)
def left_join_period(t: Tables):
    shipped = (
        t.lineitem.select(
            F.col("l_suppkey").alias("entity"),
            F.date_format("l_shipdate", "MM/dd/yyyy").alias("shipped"),
            F.col("l_quantity").cast(PRICE).alias("quantity"),
        )
        .groupBy("entity", "shipped")
        .agg(F.sum("quantity").alias("quantity"))
        .select("entity", dates.parse_day("shipped").alias("period"), "quantity")
    )
    orders = t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_custkey").alias("entity"),
        F.to_date("o_orderdate").alias("period"),
    )
    return joins.left_join(orders, shipped, ["entity", "period"]).drop("entity", "period")


@query(
    "broadcast_lookup",
    """
    SELECT s_suppkey, n_name AS nation, n_regionkey AS region
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
    """,
)
def broadcast_lookup(t: Tables):
    suppliers = t.supplier.select("s_suppkey", "s_nationkey")
    take = {"n_name": "nation", "n_regionkey": "region"}
    return joins.lookup_join(suppliers, t.nation, "s_nationkey", "n_nationkey", take).drop("s_nationkey")


@query(
    "star_left_chain",
    """
    SELECT o_orderkey, c_name, n_name, a.quantity, b.last_line
    FROM orders
    LEFT JOIN (SELECT l_orderkey, CAST(SUM(CAST(l_quantity AS DECIMAL(20,2))) AS DOUBLE) AS quantity
               FROM lineitem GROUP BY 1) a ON a.l_orderkey = o_orderkey
    LEFT JOIN (SELECT l_orderkey, MAX(l_linenumber) AS last_line
               FROM lineitem GROUP BY 1) b ON b.l_orderkey = o_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    """,
)
def star_left_chain(t: Tables):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    amounts = lines.groupBy("o_orderkey").agg(F.sum(F.col("l_quantity").cast(PRICE)).alias("quantity"))
    lengths = lines.groupBy("o_orderkey").agg(F.max("l_linenumber").alias("last_line"))
    facts = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    facts = joins.left_join(facts, amounts, ["o_orderkey"])
    facts = joins.left_join(facts, lengths, ["o_orderkey"])
    people = t.customer.select("c_custkey", "c_name", "c_nationkey")
    facts = joins.left_join(facts, people, ["c_custkey"])
    named = joins.lookup_join(facts, t.nation, "c_nationkey", "n_nationkey", {"n_name": "n_name"})
    return named.select("o_orderkey", "c_name", "n_name", "quantity", "last_line")


@query(
    "map_chain_left",
    """
    SELECT n_name, s_suppkey, l_orderkey, l_linenumber, l_partkey
    FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey
    LEFT JOIN lineitem ON l_suppkey = s_suppkey
    """,
)
def map_chain_left(t: Tables):
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    suppliers = t.supplier.select("s_nationkey", "s_suppkey")
    lines = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), "l_orderkey", "l_linenumber", "l_partkey")
    staffed = joins.left_join(nations, suppliers, ["s_nationkey"])
    return joins.left_join(staffed, lines, ["s_suppkey"]).drop("s_nationkey")


_PART_LINES = "SELECT l_partkey, COUNT(*) AS n_lines FROM lineitem GROUP BY 1"


@query(
    "left_join_null_reject",
    f"""
    SELECT p_partkey, p_name, n_lines FROM part LEFT JOIN ({_PART_LINES}) ON l_partkey = p_partkey
    WHERE n_lines IS NOT NULL
    """,
)
def left_join_null_reject(t: Tables):
    big = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n_lines"))
    return joins.inner_by_null_reject(t.part.select("p_partkey", "p_name"), big, ["p_partkey"], "n_lines")


@query(
    "two_key_left_join",
    """
    SELECT a.l_partkey, a.l_suppkey, a.n_lines, r.n_orders
    FROM (SELECT l_partkey, l_suppkey, COUNT(*) AS n_lines FROM lineitem GROUP BY 1, 2) a
    LEFT JOIN (SELECT o_custkey AS l_partkey, o_custkey % 100 AS l_suppkey, COUNT(*) AS n_orders FROM orders GROUP BY 1, 2) r
    ON r.l_partkey = a.l_partkey AND r.l_suppkey = a.l_suppkey
    """,
)
def two_key_left_join(t: Tables):
    pair = ["l_partkey", "l_suppkey"]
    lines = aggregates.count_rows(t.lineitem, pair, "n_lines")
    orders = t.orders.select(F.col("o_custkey").alias("l_partkey"), (F.col("o_custkey") % 100).alias("l_suppkey"))
    return joins.left_join(lines, aggregates.count_rows(orders, pair, "n_orders"), pair)


@query(
    "scalar_subquery",
    """
    SELECT o_orderkey, o_totalprice,
           (SELECT AVG(quantity) FROM (
               SELECT CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS quantity FROM lineitem GROUP BY l_orderkey)) AS usual_quantity
    FROM orders
    """,
)
def scalar_subquery(t: Tables):
    sums = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("bigint")).cast("double").alias("quantity"))
    usual = sums.agg(F.avg("quantity"))
    return t.orders.select("o_orderkey", "o_totalprice", usual.scalar().alias("usual_quantity"))


# --- aggregations ----------------------------------------------------------


@query(
    "snapshot_distinct",
    """
    SELECT DISTINCT l_partkey, l_returnflag, strftime(l_shipdate, '%Y%m%d') AS ship_day FROM lineitem
    """,
)
def snapshot_distinct(t: Tables):
    return snapshots.snapshot_distinct(
        t.lineitem, ["l_partkey", "l_returnflag"], "l_shipdate", "ship_day"
    )


@query(
    "count_rows_by_key",
    """
    SELECT s_nationkey, l_returnflag, l_linestatus, COUNT(*) AS n_rows
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3
    """,
)
def count_rows_by_key(t: Tables):
    # Lines are counted per supplier first, so the join carries counts, not lines.
    by_supplier = aggregates.count_rows(
        t.lineitem, ["l_suppkey", "l_returnflag", "l_linestatus"], "n"
    )
    placed = by_supplier.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return aggregates.sum_by(placed, ["s_nationkey", "l_returnflag", "l_linestatus"], {"n_rows": "n"})


@query(
    "count_nonnull_by_key",
    """
    SELECT user_id, COUNT(CASE WHEN event_type <> 'click' THEN value END) AS n_values
    FROM events GROUP BY 1
    """,
)
def count_nonnull_by_key(t: Tables):
    value = F.when(F.col("event_type") != "click", F.col("value"))
    return aggregates.count_present(
        t.events.select("user_id", value.alias("value")), ["user_id"], "value", "n_values"
    )


@query("global_count", "SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def global_count(t: Tables):
    return aggregates.count_rows(t.orders.filter(F.col("o_orderstatus") == "F"), [], "n")


@query(
    "sum_after_left_join",
    """
    SELECT s_nationkey, l_returnflag, CAST(SUM(CAST(l_quantity AS DECIMAL(20,2))) AS DOUBLE) AS quantity
    FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
    GROUP BY 1, 2
    """,
)
def sum_after_left_join(t: Tables):
    suppliers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    by_supplier = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(
        F.sum(F.col("l_quantity").cast(PRICE)).alias("q")
    )
    placed = joins.left_join(by_supplier, suppliers, ["l_suppkey"])
    return aggregates.sum_by(placed, ["s_nationkey", "l_returnflag"], {"quantity": "q"})


@query(
    "rollup_to_entity",
    """
    SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(SUM(lines) AS BIGINT) AS lines,
           CAST(SUM(quantity) AS DOUBLE) AS quantity
    FROM part JOIN (SELECT l_partkey, l_suppkey, COUNT(*) AS lines,
                           SUM(CAST(l_quantity AS DECIMAL(20,2))) AS quantity
                    FROM lineitem GROUP BY 1, 2) ON l_partkey = p_partkey
    GROUP BY 1, 2, 3, 4, 5
    """,
)
def rollup_to_entity(t: Tables):
    pairs = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey"), "l_suppkey").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast(PRICE)).alias("q")
    )
    described = pairs.join(t.part.drop("p_retailprice"), "p_partkey")
    return aggregates.sum_by(
        described,
        ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
        {"lines": "n", "quantity": "q"},
    )


# Fixed widths plus text length: two longs, a double and a time are 8 bytes each.
_ORDER_BYTES = "24 + 32 + strlen(o_orderstatus) + strlen(o_orderpriority)"
_ORDER_SUMS = f"""
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS period, CAST(SUM({_ORDER_BYTES}) AS BIGINT) AS bytes
    FROM orders GROUP BY 1
"""


@query("row_bytes_by_period", _ORDER_SUMS)
def row_bytes_by_period(t: Tables):
    return sizes.row_bytes_by_period(t.orders, F.to_date("o_orderdate"))


@query("avg_of_sums", f"SELECT AVG(bytes) AS avg_bytes FROM ({_ORDER_SUMS})")
def avg_of_sums(t: Tables):
    totals = sizes.row_bytes_by_period(t.orders, F.to_date("o_orderdate"))
    return sizes.average_of(totals, "bytes", "avg_bytes")


@query(
    "avg_by_key",
    f"SELECT o_orderpriority, AVG({_ORDER_BYTES}) AS avg_bytes FROM orders GROUP BY 1",
)
def avg_by_key(t: Tables):
    return sizes.average_by_key(t.orders, "o_orderpriority")


@query(
    "global_sums",
    """
    SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) AS price,
           CAST(SUM(o_orderkey) AS BIGINT) AS orderkeys
    FROM orders
    """,
)
def global_sums(t: Tables):
    orders = t.orders.select(F.col("o_totalprice").cast(PRICE).alias("p"), "o_orderkey")
    return aggregates.sum_by(orders, [], {"price": "p", "orderkeys": "o_orderkey"})


# --- windows ---------------------------------------------------------------


@query(
    "latest_per_key",
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1
    """,
)
def latest_per_key(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return snapshots.latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).drop("o_orderdate")


@query(
    "latest_per_json_key",
    """
    SELECT k, event_id, event_type FROM (
        SELECT *, json_extract_string(props, '$.k') AS k,
               ROW_NUMBER() OVER (PARTITION BY json_extract_string(props, '$.k')
                                  ORDER BY ts DESC NULLS FIRST, event_id DESC) AS rn
        FROM events) WHERE rn = 1
    """,
)
def latest_per_json_key(t: Tables):
    keyed = t.events.select(text.json_text("props", "$.k").alias("k"), "event_id", "event_type", "ts")
    return snapshots.latest_per_key(keyed, ["k"], "ts", ["event_id"]).drop("ts")


@query(
    "distinct_on",
    """
    SELECT DISTINCT ON (user_id, day) user_id, day, event_id, value
    FROM (SELECT *, strftime(ts, '%Y%m%d') AS day FROM events)
    ORDER BY user_id, day, ts DESC, event_id DESC
    """,
)
def distinct_on(t: Tables):
    events = t.events.select("user_id", dates.day_string("ts").alias("day"), "event_id", "value", "ts")
    newest = [F.desc_nulls_first("ts"), F.desc_nulls_first("event_id")]
    return snapshots.first_per_key(events, ["user_id", "day"], newest).drop("ts")


@query(
    "distinct_on_latest",
    """
    SELECT DISTINCT ON (l_suppkey) l_suppkey, l_orderkey, l_partkey
    FROM lineitem ORDER BY l_suppkey, l_shipdate DESC, l_orderkey DESC, l_partkey DESC
    """,
)
def distinct_on_latest(t: Tables):
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_partkey", "l_shipdate")
    newest = snapshots.latest_per_key(lines, ["l_suppkey"], "l_shipdate", ["l_orderkey", "l_partkey"])
    return newest.drop("l_shipdate")


@query(
    "growth_vs_prev",
    f"""
    SELECT o_custkey, CAST(quarter AS VARCHAR) AS quarter, CAST(deposits AS DOUBLE) AS deposits, growth
    FROM ({CUSTOMER_GROWTH})
    """,
)
def growth_vs_prev(t: Tables):
    return growth.growth_vs_prev(_customer_quarters(t), ["o_custkey"], "quarter", "deposits", "growth")


@query(
    "growth_vs_prev_bucketed",
    """
    SELECT o_orderstatus, o_orderkey, CASE WHEN price = 0 THEN 0.0
           ELSE CAST((price - LAG(price) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey)) * 100 AS DOUBLE)
                / CAST(price * 100 AS DOUBLE) END AS growth
    FROM (SELECT *, CAST(o_totalprice AS DECIMAL(20,2)) AS price FROM orders)
    """,
)
def growth_vs_prev_bucketed(t: Tables):
    # Three statuses own all orders: far too many rows for one window each.
    orders = t.orders.select("o_orderstatus", "o_orderkey", F.col("o_totalprice").cast(PRICE).alias("price"))
    grown = growth.growth_vs_prev_bucketed(orders, ["o_orderstatus"], "o_orderkey", "price", "growth")
    return grown.drop("price")


# --- sort and set operations -----------------------------------------------


@query(
    "multi_key_sort",
    "SELECT o_orderstatus, o_custkey, o_orderkey FROM orders ORDER BY o_orderstatus, o_custkey, o_orderkey",
)
def multi_key_sort(t: Tables):
    orders = t.orders.select("o_orderstatus", "o_custkey", "o_orderkey")
    return orders.orderBy("o_orderstatus", "o_custkey", "o_orderkey")


@query(
    "union_all_tagged",
    """
    SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier
    """,
)
def union_all_tagged(t: Tables):
    def people(df, prefix, key):
        return df.select(
            F.col(key).alias("id"), F.col(f"{prefix}_name").alias("name"), F.col(f"{prefix}_acctbal").alias("balance")
        )

    return aggregates.union_tagged(
        {"customer": people(t.customer, "c", "c_custkey"), "supplier": people(t.supplier, "s", "s_suppkey")},
        "kind",
    )


_COUNTED = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query(
    "union_all_many",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {n}" for n in _COUNTED),
)
def union_all_many(t: Tables):
    return aggregates.union_all(
        aggregates.count_rows(getattr(t, n), [], "n_rows").select(F.lit(n).alias("table_name"), "n_rows")
        for n in _COUNTED
    )


# --- key audits ------------------------------------------------------------


@query(
    "duplicate_gate",
    "SELECT COUNT(user_id) AS count, user_id FROM events GROUP BY user_id HAVING COUNT(user_id) > 1",
)
def duplicate_gate(t: Tables):
    return quality.duplicate_keys(t.events, "user_id")


@query(
    "key_constraint",
    """
    SELECT CASE WHEN key IS NULL THEN 'null' ELSE 'duplicate' END AS reason, key, COUNT(*) AS count
    FROM (SELECT CASE WHEN l_returnflag <> 'A' THEN l_orderkey END AS key FROM lineitem)
    GROUP BY key HAVING key IS NULL OR COUNT(*) > 1
    """,
)
def key_constraint(t: Tables):
    key = F.when(F.col("l_returnflag") != "A", F.col("l_orderkey")).alias("key")
    return quality.key_violations(t.lineitem.select(key), "key")


# --- incremental -----------------------------------------------------------


def _landed_events(t: Tables) -> tuple[str, T.StructType]:
    path = scratch_dir(t.spark, "landed-events")
    events = t.events.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp"))
    events.repartitionByRange("event_id").write.parquet(path)
    return path, events.schema


@query(
    "incremental_land",
    "SELECT event_id, user_id, event_type, strftime(ts, '%Y%m%d') AS day FROM events",
)
def incremental_land(t: Tables):
    landed, schema = _landed_events(t)
    target, checkpoint = scratch_dir(t.spark, "events"), scratch_dir(t.spark, "events-progress")

    def shape(df):
        return df.select("event_id", "user_id", "event_type", dates.day_string("ts").alias("day"))

    for _ in range(2):  # the second run finds nothing new
        stream = incremental.file_stream(t.spark, landed, schema)
        incremental.incremental_land(stream, target, checkpoint, shape)
    return t.spark.read.parquet(target)


@query(
    "incremental_latest",
    """
    SELECT user_id, event_id, event_type FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def incremental_latest(t: Tables):
    landed, schema = _landed_events(t)
    target, checkpoint = scratch_dir(t.spark, "latest"), scratch_dir(t.spark, "latest-progress")
    stream = incremental.file_stream(t.spark, landed, schema)
    incremental.incremental_latest(stream, target, checkpoint, ["user_id"], "ts", ["event_id"])
    newest = incremental.read_latest(t.spark, target)
    return newest.select("user_id", "event_id", "event_type")
