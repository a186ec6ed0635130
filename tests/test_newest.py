"""Marts made straight from raw tables: the same rows as over whole staging tables, in one exchange a table."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_jobs import frame
from tidemark import schemas
from tidemark.operators.snapshots import Newest, leading_rows, snapshot_distinct
from tidemark.plans import marts, metrics, staging
from tidemark.sources.lookups import states

DAYS = ["2023-04-01 08:00:00", "2023-04-01 09:00:00", "2023-04-02 08:00:00", None]


def unions(spark):
    """Three unions, spelled two ways, each report scraped on several days, in two versions, and whole rows twice."""
    cases = [(c, d, at, v) for c in ("1", "2", None) for d in ("3/31/2023", "2023-03-31", "6/30/2023", None) for at in DAYS for v in ("1", "2")]
    # What has a NULL in its key has no dim_id, so only one version of it can be told apart.
    cases = [x for x in cases if None not in x or (x[3] == "1" and x[1] != "2023-03-31")] * 2
    base = [dict(cu_number=c, cycle_date=d, scraped_at=at) for c, d, at, _ in cases]
    with_version = lambda **columns: [
        b | {name: (v if kind == "v" else kind) for name, kind in columns.items()} for b, (_, _, _, v) in zip(base, cases, strict=True)
    ]
    return {
        "branches": frame(spark, schemas.RAW_CU_BRANCHES, *with_version(cu_name="U", physical_address_city="v", physical_address_state_code="TX")),
        "fs220": frame(spark, schemas.RAW_FS220, *with_version(update_date="v", acct_010="v", acct_018="v", acct_025b="1", acct_083="2", acct_902="3")),
        "fs220a": frame(spark, schemas.RAW_FS220A, *with_version(acct_452="v", acct_115="1.50", acct_350="4", acct_131="1")),
        "fs220d": frame(spark, schemas.RAW_FS220D, *with_version(acct_891="v")),
        "fs220n": frame(spark, schemas.RAW_FS220N, *with_version(acct_is0020="v")),
    }


def union_mart(spark, raw, place=None, form=None):
    staged = [staging.stage_cu_branches(raw["branches"], then=place)]
    for name in ("fs220", "fs220a", "fs220d", "fs220n"):
        staged.append(getattr(staging, f"stage_{name}")(raw[name], then=form))
    return marts.mart_credit_unions(*staged, states(spark))


def banks(spark):
    reports = [
        dict(cert=c, namefull="B", asset=a, dep=a, repdte=r, scraped_at=at)
        for c in ("1", "2", None) for r in ("20230331", "20230630") for at in DAYS for a in ("1", "2")
        if a == "1" or (c and at)
    ] * 2
    known = [
        dict(cert=c, name="B", city=city, stname="Texas", webaddr=None, dateupdt=d, repdte="03/31/2023", scraped_at=at)
        for c in ("1", "2", None) for d in ("04/01/2023", "04/02/2023", None) for at in DAYS for city in ("a", "b")
        if c or city == "a"
    ] * 2
    return frame(spark, schemas.RAW_BANK_FINANCIALS, *reports), frame(spark, schemas.RAW_BANK_INSTITUTIONS, *known)


def bank_mart(spark, financials, institutions, report=None, attributes=None):
    staged = staging.stage_bank_financials(financials, then=report), staging.stage_bank_institutions(institutions, then=attributes)
    return marts.mart_banks(*staged, states(spark))


def test_leading_rows_keep_ties_and_nulls_lead(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d"), (2, 9, "e"), (None, 3, "f")], "k int, t int, v string")
    assert rows(leading_rows(df, ["k"], ["t"]), "v") == [("b",), ("c",), ("d",), ("f",)]


def test_newest_versions_are_found_before_the_shuffle(spark):
    df = spark.range(4000).selectExpr("id % 10 as k", "id as v", "timestamp '2023-01-01' + make_interval(0, 0, 0, int(id % 40)) as scraped_at")
    got = snapshot_distinct(df, ["k", "v"], then=Newest(("k",)))
    assert got.count() == 1000 and got.select("k", "scraped_at").distinct().count() == 10
    plan = got._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert plan.count("Exchange") == 1 and "WindowGroupLimit" in below and "Partial" in below


def test_marts_from_raw_rows_are_those_of_whole_staging_tables(spark):
    raw = unions(spark)
    told = union_mart(spark, raw, marts.NEWEST_PLACE, marts.NEWEST_FORM)
    assert rows(told) == rows(union_mart(spark, raw)) and told.schema == union_mart(spark, raw).schema
    fin, inst = banks(spark)
    told = bank_mart(spark, fin, inst, marts.NEWEST_REPORT, marts.NEWEST_ATTRIBUTES)
    assert rows(told) == rows(bank_mart(spark, fin, inst)) and told.count() == 6


def test_text_that_is_no_amount_is_refused_in_old_versions_too(spark):
    raw = unions(spark)
    old = dict(cu_number="1", cycle_date="3/31/2023", acct_452="none", acct_115="1", acct_350="1", acct_131="1", scraped_at="2020-01-01 00:00:00")
    raw["fs220a"] = raw["fs220a"].unionByName(frame(spark, schemas.RAW_FS220A, old))
    for newest in (None, marts.NEWEST_FORM):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            union_mart(spark, raw, form=newest).collect()


def test_a_raw_table_is_shuffled_once_for_a_mart_and_a_mart_once_for_the_metric(spark):
    from catalog import fixtures as X, jobs
    from catalog.registry import Tables
    from tests.conftest import SMALL

    t = Tables(spark, SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = F.broadcast(X.nations_as_states(t))
        forms = [getattr(staging, f"stage_{n}")(getattr(X, f"cu_{n}")(t), then=marts.NEWEST_FORM) for n in ("fs220", "fs220a", "fs220d", "fs220n")]
        mart = marts.mart_credit_unions(staging.stage_cu_branches(X.cu_branches(t), then=marts.NEWEST_PLACE), *forms, lookup)
        exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        # One for each raw table, and one for the place, which joins by charter alone.
        assert exchanges(mart) == 6
        fin, inst = staging.stage_bank_financials(X.bank_financials(t), then=marts.NEWEST_REPORT), staging.stage_bank_institutions(X.bank_institutions(t), then=marts.NEWEST_ATTRIBUTES)
        assert exchanges(metrics.metric_asset_deposit(marts.mart_banks(fin, inst, lookup), mart, ordered=False)) == 6 + 3
        assert jobs._banks(t).count() == marts.mart_banks(fin, inst, lookup).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
