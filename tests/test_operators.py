"""Properties of the operators, and the plans they lead to."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tidemark.operators import aggregates, columns, growth, joins, quality, sizes, snapshots
from tidemark.plans import metrics
from tidemark.sources import envelopes


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


SCRAPES = "k string, v int, scraped_at timestamp"


def scrapes(spark):
    data = [
        ("a", 1, "2024-01-01 08:00:00"),
        ("a", 1, "2024-01-01 20:00:00"),
        ("a", 1, "2024-01-02 08:00:00"),
        ("a", 2, "2024-01-01 08:00:00"),
        ("b", None, "2024-01-01 08:00:00"),
        ("b", None, "2024-01-01 09:00:00"),
    ]
    df = spark.createDataFrame(data, "k string, v int, t string")
    return df.select("k", "v", F.col("t").cast("timestamp").alias("scraped_at"))


def test_snapshot_distinct_keeps_one_version_per_day(spark):
    once = snapshots.snapshot_distinct(scrapes(spark), ["k", "v"])
    assert rows(once) == [
        ("a", 1, "20240101"), ("a", 1, "20240102"), ("a", 2, "20240101"), ("b", None, "20240101"),
    ]
    again = snapshots.snapshot_distinct(
        once.withColumn("scraped_at", F.to_timestamp("scraped_at", "yyyyMMdd")), ["k", "v"]
    )
    assert rows(again) == rows(once)


def test_latest_per_key_prefers_null_times_and_then_the_tiebreak(spark):
    data = [("a", 1, 5), ("a", 2, None), ("b", 3, 7), ("b", 4, 7)]
    df = spark.createDataFrame(data, "k string, id int, ts int")
    assert rows(snapshots.latest_per_key(df, ["k"], "ts", ["id"])) == [("a", 2, None), ("b", 4, 7)]


def test_latest_per_key_limits_before_the_shuffle(spark):
    text = plan(snapshots.latest_per_key(table(spark, "orders"), ["o_custkey"], "o_orderdate"))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_left_join_skewed_is_a_left_join(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (2, "y")], "k int, a string")
    right = spark.createDataFrame([(2, "p"), (2, "q"), (None, "r"), (3, "s")], "k int, b string")
    for share in (0.01, 0.4, 1.0):
        assert rows(joins.left_join_skewed(left, right, ["k"], share)) == rows(left.join(right, "k", "left"))
    assert rows(joins.left_join_skewed(left, right.limit(0), ["k"])) == rows(left.join(right.limit(0), "k", "left"))


def test_left_join_skewed_finds_and_deals_the_hot_key(spark):
    """One key owns most of the right side; no task may be left with all of its rows."""
    # Partitions as small as these would be put together.
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("a"))
        right = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 100).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("b"),
        )
        hot = joins.heavy_keys(right, ["k"], 0.1)
        assert hot == [spark.sql("SELECT xxhash64(7L)").first()[0]]
        joined = joins.left_join_skewed(left, right, ["k"], 0.1)
        assert "_salt" in plan(joined)
        assert joined.count() == left.join(right, "k", "left").count()
        sizes = joined.where("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in sizes) == 40_200 and max(r["count"] for r in sizes) < 30_000 and len(sizes) > 1
        assert "_salt" not in plan(joins.left_join_skewed(left, right.where("k <> 7"), ["k"], 0.1))
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_null_reject_becomes_an_inner_join(spark):
    part = table(spark, "part").select("p_partkey")
    lines = table(spark, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).count()
    text = plan(joins.inner_by_null_reject(part, lines, ["p_partkey"], "count"))
    assert "LeftOuter" not in text and "Inner" in text


def test_growth_divides_by_the_current_value(spark):
    data = [
        ("a", 1, "100.00"), ("a", 2, "80.00"), ("a", 4, "100.00"), ("a", 5, "0.00"), ("a", 6, "10.00"), ("b", 1, None), ("b", 2, "5.00"),
    ]
    df = spark.createDataFrame(data, "k string, p int, t string").select(
        "k", "p", F.col("t").cast("decimal(18,2)").alias("v")
    )
    got = growth.growth_vs_prev(df, ["k"], "p", "v", "g")
    assert rows(got, "k", "p", "g") == [
        ("a", 1, None), ("a", 2, -0.25), ("a", 4, 0.2), ("a", 5, 0.0), ("a", 6, 1.0), ("b", 1, None), ("b", 2, None),
    ]
    previous = growth.growth_vs_prev(df, ["k"], "p", "v", "g", base="previous")
    assert rows(previous, "k", "p", "g")[1] == ("a", 2, -0.2)


def test_growth_boundaries_are_exact(spark):
    """Growth of exactly 5 % stays in the lower tier, whatever the cents."""
    data = [(i, p, v) for i, (x, y) in enumerate([("0.57", "0.60"), ("95.00", "100.00"), ("0.63", "0.60"), ("3.00", "3.00")]) for p, v in ((1, x), (2, y))]
    df = spark.createDataFrame(data, "k int, p int, t string").select(
        "k", "p", F.col("t").cast("decimal(18,2)").alias("v")
    )
    got = growth.growth_vs_prev(df, ["k"], "p", "v", "g").filter("p = 2")
    assert rows(got, "k", "g") == [(0, 0.05), (1, 0.05), (2, -0.05), (3, 0.0)]


def test_bucketed_growth_is_growth(spark):
    orders = table(spark, "orders").select(
        "o_orderstatus", "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("v")
    ).filter("o_orderkey % 7 < 5")
    holes = orders.withColumn("v", F.when(F.col("o_orderkey") % 11 != 0, F.col("v")))
    holes = holes.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")))
    lost = holes.filter("o_orderkey % 20 = 1").groupBy("o_orderstatus").agg(F.max("v").alias("v"))
    holes = holes.unionByName(lost.select("o_orderstatus", F.lit(None).cast("bigint").alias("o_orderkey"), "v"))
    args = (["o_orderstatus"], "o_orderkey", "v", "g")
    plainly = rows(growth.growth_vs_prev(holes, *args), "o_orderstatus", "o_orderkey", "g")
    assert rows(growth.growth_vs_prev_bucketed(holes, *args), "o_orderstatus", "o_orderkey", "g") == plainly


def test_row_bytes(spark):
    df = spark.createDataFrame([(1, "é", None), (2, None, True)], "a bigint, b string, c boolean")
    assert [r[0] for r in df.coalesce(1).select(sizes.row_bytes(df)).collect()] == [24 + 8 + 2, 24 + 8 + 1]


def test_duplicate_keys_ignore_nulls_and_violations_do_not(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "dim_id string")
    assert rows(quality.duplicate_keys(df)) == [(2, "a")]
    assert rows(quality.key_violations(df)) == [("duplicate", "a", 2), ("null", None, 2)]
    quality.require_no_duplicates(df.filter("dim_id is null or dim_id = 'b'"))
    with pytest.raises(quality.AuditFailed, match="1 values"):
        quality.require_no_duplicates(df)
    with pytest.raises(quality.AuditFailed, match="1 repeated values, 2 rows"):
        quality.require_key(df)


def test_align_schema_fills_and_drops(spark):
    from tidemark.schemas import RAW_BANK_FINANCIALS

    df = spark.createDataFrame([("7", "Bank", "12", "x")], "CERT string, NAMEFULL string, ASSET string, EXTRA string")
    got = columns.align_schema(df, RAW_BANK_FINANCIALS, generated=("scraped_at",))
    assert got.columns == ["cert", "namefull", "asset", "dep", "repdte"]
    assert rows(got) == [(Decimal(7), "Bank", Decimal("12.00"), None, None)]


def test_size_projection_modes(spark):
    totals = spark.createDataFrame([(10.0, 3.0)], "now double, average double")
    today = F.lit("2024-01-31").cast("date")
    published = metrics.size_projection(totals, "now", "average", today, months_per_report=1)
    assert [r.total_size_gb for r in published.orderBy("months").collect()] == [19.0, 28.0, 37.0, 46.0]
    quarterly = metrics.size_projection(totals, "now", "average", today)
    assert [r.total_size_gb for r in quarterly.orderBy("months").collect()] == [13.0, 16.0, 19.0, 22.0]
    assert str(published.orderBy("months").first().future_date) == "2024-04-30"


def test_union_keeps_duplicates(spark):
    one = spark.createDataFrame([(1,)], "x int")
    assert rows(aggregates.union_tagged({"a": one, "b": one}, "tag")) == [("a", 1), ("b", 1)]


def test_quarter_filter_reaches_the_scan(spark):
    from datetime import date

    text = plan(envelopes.for_quarter(table(spark, "orders"), "o_orderdate", date(1997, 9, 30)))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_period_filter_prunes_partitions(spark, tmp_path):
    from datetime import date

    df = spark.createDataFrame([("20230331", 1), ("20230630", 2)], "repdte string, v int")
    df.write.partitionBy("repdte").parquet(str(tmp_path / "t"))
    stored = spark.read.schema("v int, repdte string").parquet(str(tmp_path / "t"))
    wanted = envelopes.for_period(stored, "repdte", date(2023, 6, 30))
    assert "PartitionFilters: [isnotnull(repdte" in plan(wanted)
    assert rows(wanted) == [(2, "20230630")]


def test_no_python_outside_pages_and_archives(spark):
    from catalog import QUERIES

    python_allowed = {"archive_member_read", "page_type_dispatch"}
    eager = {
        "gz_json_document_read", "prefix_scan", "append_load", "full_refresh_write", "paged_scan",
        "write_audit_publish", "incremental_land", "incremental_latest", "json_envelope_read",
        "mart_credit_unions_stored", "metric_asset_deposit_by_period",
    }
    for name in sorted(set(QUERIES) - python_allowed - eager):
        text = plan(QUERIES[name](spark, SMALL))
        assert "Python" not in text and "InPandas" not in text, name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_credit_union_forms_share_their_exchange(spark):
    """Five inputs, each distributed once for its window and not again for the joins."""
    from catalog import fixtures as X
    from catalog.registry import Tables
    from tidemark.plans import marts, staging

    t = Tables(spark, SMALL)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = marts.mart_credit_unions(
            staging.stage_cu_branches(X.cu_branches(t)),
            staging.stage_fs220(X.cu_fs220(t)),
            staging.stage_fs220a(X.cu_fs220a(t)),
            staging.stage_fs220d(X.cu_fs220d(t)),
            staging.stage_fs220n(X.cu_fs220n(t)),
            X.nations_as_states(t),
        )
        text = plan(mart)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    by_form = [line for line in text.splitlines() if "Exchange hashpartitioning(cu_number" in line and "period" in line]
    assert len(by_form) == 4
