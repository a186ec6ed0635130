"""The refresh by period against the full pipeline, and which files it leaves alone."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_jobs import frame, regulator_raw
from tidemark import schemas
from tidemark.plans import marts, metrics, pipeline, refresh, staging

MARCH, JUNE, SEPTEMBER = date(2023, 3, 31), date(2023, 6, 30), date(2023, 9, 30)


def landed(spark, **more):
    raw = regulator_raw(spark)
    return {name: df.unionByName(more[name]) if name in more else df for name, df in raw.items()}


def september(spark):
    """A quarter in which bank 3 and union 2 report first; union 1's place stays as it is."""
    at = "2023-10-01 08:00:00"
    union = {"cycle_date": "9/30/2023", "scraped_at": at}
    return {
        "bank_financials": frame(
            spark, schemas.RAW_BANK_FINANCIALS,
            dict(cert="1", namefull="Bank 1", asset="1", dep="110", repdte="20230930", scraped_at=at),
            dict(cert="3", namefull="Bank 3", asset="1", dep="7", repdte="20230930", scraped_at=at),
        ),
        "cu_branches": frame(spark, schemas.RAW_CU_BRANCHES, dict(union, cu_number="1", cu_name="Union", physical_address_city="Austin", physical_address_state_code="TX")),
        "cu_fs220": frame(
            spark, schemas.RAW_FS220,
            *[dict(union, cu_number=c, update_date="x", acct_010="1", acct_018="150", acct_025b="1", acct_083="2", acct_902="3") for c in "12"],
        ),
    }


def files(root):
    """Where each part of the marts and the metric is read from, and when those files were written."""
    spark_tables = {}
    for name in ("marts/banks", "marts/credit_unions", "metrics/asset_deposit"):
        for part in (root / name / "data").glob("load=*/*=*"):
            spark_tables[f"{name}/{part.name}"] = max(f.stat().st_mtime_ns for f in part.glob("*.parquet"))
    return spark_tables


def full(spark, raw, root):
    return rows(pipeline.run_regulator_pipeline(raw, str(root)).select(*sorted(metrics_columns())))


def metrics_columns():
    return [
        "inst_type", "id_number", *metrics.INSTITUTION_COLUMNS, "report_date", "asset_tier",
        "deposits_growth_prev_qtr", "deposits_growth_prev_qtr_tier",
    ]


def run(raw, root):
    metric, changed = refresh.refresh_regulator_tables(raw, str(root), buckets=2)
    return rows(metric.select(*sorted(metrics_columns()))), changed


def moved(spark, updated="10/15/2023", at="2023-11-02 00:00:00"):
    """A later version of bank 1's attributes."""
    row = dict(cert="1", name="Bank 1", city="Moved", stname="Iowa", webaddr="x.com", dateupdt=updated, repdte="09/30/2023", scraped_at=at)
    return frame(spark, schemas.RAW_BANK_INSTITUTIONS, row)


def metric_loads(spark, root):
    return refresh.RegulatorTables(spark, str(root)).metric.state().loads


def test_run_after_run_equals_the_full_pipeline_and_writes_what_changed(spark, tmp_path):
    root, raw = tmp_path / "by_period", landed(spark)
    got, changed = run(raw, root)
    assert got == full(spark, raw, tmp_path / "full") and changed["asset_deposit"] == {MARCH, JUNE}

    before = files(root)
    again, changed = run(raw, root)
    assert again == got and not any(changed.values()) and files(root) == before

    # A new period is all that is written.
    raw = landed(spark, **september(spark))
    got, changed = run(raw, root)
    assert got == full(spark, raw, tmp_path / "full")
    assert changed["banks"] == changed["credit_unions"] == changed["asset_deposit"] == {SEPTEMBER}
    after = files(root)
    assert {n: t for n, t in after.items() if n in before} == before
    assert {n.partition("=")[2] for n in set(after) - set(before)} == {"2023-09-30"}

    # Bank 1's June report is scraped again: its next report, September's, looks back on it.
    late = frame(spark, schemas.RAW_BANK_FINANCIALS, dict(cert="1", namefull="Bank 1", asset="9", dep="50", repdte="20230630", scraped_at="2023-11-01 00:00:00"))
    raw["bank_financials"] = raw["bank_financials"].unionByName(late)
    loads = metric_loads(spark, root)
    got, changed = run(raw, root)
    assert got == full(spark, raw, tmp_path / "full")
    assert (changed["banks"], changed["credit_unions"], changed["asset_deposit"]) == ({JUNE}, set(), {JUNE, SEPTEMBER})
    now = metric_loads(spark, root)
    assert [n for n in now if now[n] == loads[n]] == ["report_date=2023-03-31"]

    # New attributes reach every period of their institution; the same ones in a later version change no mart.
    raw["bank_institutions"] = raw["bank_institutions"].unionByName(moved(spark))
    got, changed = run(raw, root)
    assert got == full(spark, raw, tmp_path / "full") and changed["banks"] == {MARCH, JUNE, SEPTEMBER}
    raw["bank_institutions"] = raw["bank_institutions"].unionByName(moved(spark, "10/16/2023", "2023-11-03 00:00:00"))
    again, changed = run(raw, root)
    assert again == got and changed["bank_institutions"] == {SEPTEMBER} and not changed["banks"]


@pytest.mark.parametrize("dies", ["refresh_banks", "refresh_metric"])
def test_a_run_that_dies_leaves_the_next_all_that_is_to_do(spark, tmp_path, monkeypatch, dies):
    run(landed(spark), tmp_path / "by_period")
    raw = landed(spark, **september(spark))
    raw["bank_institutions"] = raw["bank_institutions"].unionByName(moved(spark))
    with monkeypatch.context() as patched:
        patched.setattr(refresh, dies, lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(raw, tmp_path / "by_period")
    got, changed = run(raw, tmp_path / "by_period")
    assert got == full(spark, raw, tmp_path / "full")
    assert not any(changed[name] for name in refresh.SOURCES)  # staged by the run that died
    assert changed["asset_deposit"] == {MARCH, JUNE, SEPTEMBER}


def test_stored_forms_are_joined_without_an_exchange(spark, tmp_path):
    run(landed(spark), tmp_path)
    tables = refresh.RegulatorTables(spark, str(tmp_path), buckets=2)
    forms = [tables.form(name).hint("merge") for name in refresh.FORMS]
    newest = [marts.newest_form(form, list(form.columns[2:3])) for form in forms]
    joined = newest[0].join(newest[1], ["cu_number", "period"], "left").join(newest[2], ["cu_number", "period"], "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2 and plan.count("Window [") == 3
    mart = tables.unions.read()
    assert mart.count() == 2 and mart.where(F.col("other_non_int_inc_ytd") == 9).count() == 1


def test_a_table_has_more_buckets_the_more_rows_it_has(spark, tmp_path, monkeypatch):
    def dealt(name):
        table = refresh.RegulatorTables(spark, str(tmp_path / "grown"), buckets=1).staged[name]
        state = table.state()
        return state.notes["buckets"], set(state.loads.values())

    monkeypatch.setattr(refresh, "BUCKET_ROWS", 2)
    raw = landed(spark)
    n = raw["bank_financials"].count()
    refresh.refresh_regulator_tables(raw, str(tmp_path / "grown"), buckets=1)
    buckets, loads = dealt("bank_financials")
    assert n > 2 and buckets >= n / 2 and len(loads) == 1

    # Rows of a later period alone deal the whole table anew once it has outgrown its buckets.
    def late(i):
        return dict(cert=str(100 + i), namefull="Bank", asset="1", dep="7", repdte="20230930", scraped_at="2023-10-01 08:00:00")

    more = frame(spark, schemas.RAW_BANK_FINANCIALS, *[late(i) for i in range(9 * buckets)])
    raw["bank_financials"] = raw["bank_financials"].unionByName(more)
    metric, _ = refresh.refresh_regulator_tables(raw, str(tmp_path / "grown"), buckets=1)
    after, loads = dealt("bank_financials")
    assert after > buckets and len(loads) == 1
    assert rows(metric.select(*sorted(metrics_columns()))) == full(spark, raw, tmp_path / "full")
    staged = refresh.RegulatorTables(spark, str(tmp_path / "grown"), buckets=1).form("bank_financials")
    assert staged.count() == staging.stage_bank_financials(raw["bank_financials"]).count() and staged.where("cert >= 100").select("cert").distinct().count() == 9 * buckets
