"""Landed files all the way to raw tables."""

import gzip
import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_jobs import REPO
from tidemark.plans import ingest
from tidemark.sources.documents import land_documents, landed_documents, read_documents
from tidemark.sources.envelopes import land_envelopes, landed_records, require_complete
from tidemark.sources.json_landing import TooManyBad

NOW = "timestamp '2024-01-01 00:00:00'"


def test_bank_table_from_responses(spark, tmp_path):
    for page, certs in enumerate([(1, 2), (3,)]):
        records = [
            {"data": {"ID": f"x{c}", "CERT": c, "NAMEFULL": "Bank", "ASSET": 12.5, "REPDTE": "20230331", "UNUSED": 1}, "score": 1}
            for c in certs
        ]
        (tmp_path / f"{page}.json").write_text(json.dumps({"meta": {"total": 3}, "data": records}))
    raw = ingest.raw_bank_table(spark, str(tmp_path), "bank_financials", F.expr(NOW))
    assert raw.columns == ["cert", "namefull", "asset", "dep", "repdte", "financials_id", "unused", "scraped_at"]
    assert rows(raw, "financials_id", "unused")[0] == ("x1", "1")
    assert [(int(c), float(a), d) for c, a, d in rows(raw, "cert", "asset", "dep")] == [(1, 12.5, None), (2, 12.5, None), (3, 12.5, None)]


def archive(path, header, *lines, encoding="utf-8"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(f"{path.stem}/FS220N.txt", "\r\n".join([header, *lines]).encode(encoding))


def test_call_report_layouts_may_differ_by_archive(spark, tmp_path):
    archive(tmp_path / "2023-03.zip", '"CU_Number","CYCLE_DATE","ACCT_IS0020","OTHER"', '"1","3/31/2023","5.50","é"', encoding="latin-1")
    archive(tmp_path / "2023-06.zip", "OTHER,ACCT_IS0020,CU_NUMBER", '"multi\r\nline, text",7,2', "short")
    landing = str(tmp_path / "landed")
    ingest.land_call_reports(spark, str(tmp_path / "*.zip"), landing)
    raw = ingest.call_report_table(spark, landing, "cu_fs220n", F.expr(NOW))
    assert raw.columns[:3] == ["cu_number", "cycle_date", "acct_is0020"] and raw.columns[-1] == "scraped_at"
    assert set(raw.columns[3:-1]) == {"other"} and "é" in {r.other for r in raw.collect()}
    got = [(None if c is None else int(c), d, a) for c, d, a in rows(raw, "cu_number", "cycle_date", "acct_is0020")]
    assert sorted(got, key=repr) == sorted([(1, "3/31/2023", "5.50"), (2, None, "7"), (None, None, None)], key=repr)


def test_only_new_periods_are_appended(spark, tmp_path):
    target = str(tmp_path / "raw")

    def land(*records):
        df = spark.createDataFrame(records, "cycle_date string, v int")
        ingest.land_new_periods(df, target, "cycle_date")
        return rows(ingest.landed_periods(spark, target).read(), "cycle_date", "v")

    assert land(("3/31/2023", 1), ("3/31/2023", 2)) == [("3/31/2023", 1), ("3/31/2023", 2)]
    # The first quarter under another spelling is known already.
    assert land(("2023-03-31", 3), ("6/30/2023", 4)) == [("3/31/2023", 1), ("3/31/2023", 2), ("6/30/2023", 4)]


def test_responses_must_be_whole_and_all_there(spark, tmp_path):
    page = {"meta": {"total": 2}, "data": [{"data": {"CERT": "1"}}, {"data": {"CERT": "2"}}]}
    for name, text in {"whole": json.dumps(page), "cut": json.dumps(page)[:-20], "short": json.dumps(page | {"data": page["data"][:1]})}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "0.json").write_text(text)
    read = lambda name, **k: ingest.raw_bank_table(spark, str(tmp_path / name), "bank_financials", **k)
    assert read("whole").count() == 2
    with pytest.raises(TooManyBad, match="1 of 1 documents cannot be used, 0 allowed.*0.json: does not parse"):
        read("cut", complete=False)
    with pytest.raises(ValueError, match="1 records landed of 2"):
        read("short")
    assert read("short", complete=False).count() == 1


def test_rows_without_a_period_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("3/31/2023", 1), (None, 2)], "cycle_date string, v int")
    with pytest.raises(Exception, match="without cycle_date"):
        ingest.land_new_periods(df, str(tmp_path / "raw"), "cycle_date")


def test_cut_documents_are_errors(spark, tmp_path):
    (tmp_path / "0.json").write_text('{"url": "u", "body": "b')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_documents(spark, str(tmp_path)).count()


def test_page_table_from_documents(spark, tmp_path):
    folder = tmp_path / "repos" / "job7"
    folder.mkdir(parents=True)
    for name in ("r", "s"):
        doc = {"url": f"https://github.com/o/{name}", "body": REPO, "meta": {"project_link": "P"}}
        (folder / f"{name}.json.gz").write_bytes(gzip.compress(json.dumps(doc).encode()))
    raw = ingest.raw_page_table(spark, str(folder), "repos", F.expr(NOW))
    first = raw.orderBy("name").first()
    assert first.id == hashlib.md5(b"job7https://github.com/o/r").hexdigest()
    assert (first.job_id, first.name, first.commits, first.tags) == ("job7", "r", "1,234", ["etl", "sql"])
    assert raw.count() == 2


def test_one_cut_file_among_ten_is_a_dead_letter(spark, tmp_path):
    folder = tmp_path / "request"
    folder.mkdir()
    for i in range(10):
        text = json.dumps({"meta": {"total": 20}, "data": [{"data": {"CERT": str(i), "N": j}} for j in range(2)]})
        (folder / f"{i}.json").write_text(text[:-9] if i == 4 else text)
    target = str(tmp_path / "landed")
    with pytest.raises(TooManyBad, match="1 of 10"):
        land_envelopes(spark, str(folder), target)
    assert not list((tmp_path / "landed").glob("load=*"))  # taken back whole
    landing = land_envelopes(spark, str(folder), target, limit=1)
    assert (landing.good, landing.bad) == (9, 1)
    assert rows(landed_records(landing, ["CERT", "N"])) == [(str(i), str(j)) for i in range(10) if i != 4 for j in range(2)]
    (letter,) = landing.dead_letters().collect()
    assert letter.file.endswith("request/4.json") and letter.reason == "does not parse" and letter.n_chars > 50
    with pytest.raises(ValueError, match="18 records landed of 20 declared"):
        require_complete(landing)
    raw = ingest.raw_bank_table(spark, str(folder), "bank_financials", F.expr(NOW), complete=False, limit=1)
    assert raw.count() == 18 and raw.schema["cert"].dataType.typeName() == "decimal"


def test_unreadable_and_unfit_documents_are_dead_letters(spark, tmp_path):
    folder = tmp_path / "repos" / "job7"
    folder.mkdir(parents=True)
    whole = gzip.compress(json.dumps({"url": "u", "body": "b" * 500, "meta": {"link": "L", "crawl": "c9"}}).encode())
    (folder / "good.json.gz").write_bytes(whole)
    (folder / "cut.json.gz").write_bytes(whole[:-20])
    (folder / "nameless.json.gz").write_bytes(gzip.compress(b'{"body": "b"}'))
    (folder / "empty.json.gz").write_bytes(gzip.compress(b""))
    with pytest.raises(TooManyBad):
        land_documents(spark, str(folder), str(tmp_path / "landed"), limit=2)
    landing = land_documents(spark, str(folder), str(tmp_path / "landed"), meta=["link", "crawl"], limit=3)
    # Keys of meta that no page table has can be had as well.
    assert rows(landed_documents(landing), "url", "meta.link", "meta.crawl") == [("u", "L", "c9")]
    letters = {r.file.rsplit("/", 1)[1]: r.reason for r in landing.dead_letters().collect()}
    assert letters["cut.json.gz"] in ("cannot be read", "does not parse") and letters["nameless.json.gz"] == "no url"
    assert set(letters) == {"cut.json.gz", "nameless.json.gz", "empty.json.gz"} and landing.bad == 3


def test_nothing_to_land(spark, tmp_path):
    (tmp_path / "in").mkdir()
    landing = land_envelopes(spark, str(tmp_path / "in"), str(tmp_path / "landed"))
    assert (landing.good, landing.bad) == (0, 0) and landing.rows().count() == landing.dead_letters().count() == 0


def test_six_tables_open_each_archive_once(spark, tmp_path):
    quarters = ["2023-03", "2023-06", "2023-09"]
    for q, quarter in enumerate(quarters):
        with zipfile.ZipFile(tmp_path / f"{quarter}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for table, (member, _) in ingest.CALL_REPORT_TABLES.items():
                lines = ['"CU_NUMBER","CU_NAME"', *[f'"{q}{i}","{table} é"' for i in range(3)]]
                z.writestr(f"{quarter}/{member.upper()}", "\r\n".join(lines).encode("latin-1" if q == 1 else "utf-8"))
    landing = str(tmp_path / "landed")
    ingest.land_call_reports(spark, str(tmp_path / "*.zip"), landing)
    for table in ingest.CALL_REPORT_TABLES:
        raw = ingest.call_report_table(spark, landing, table, F.expr(NOW))
        names = {r.cu_name for r in raw.collect()} if "cu_name" in raw.columns else set()
        assert raw.count() == 9 and names <= {f"{table} é"}
    landed = spark.read.parquet(landing)
    openings = rows(landed.groupBy("archive").agg(F.count_distinct("opening"), F.count_distinct("member")))
    assert [(n, m) for _, n, m in openings] == [(1, 6)] * 3
    # The flag of each member, not the archive's order, decides how its bytes are read.
    assert rows(landed.where("kind = 'info'").groupBy("clean").count()) == [(False, 6), (True, 12)]


def test_an_archive_without_a_member_gives_no_rows(spark, tmp_path):
    archive(tmp_path / "2023-03.zip", "CU_NUMBER", "1")
    ingest.land_call_reports(spark, str(tmp_path / "*.zip"), str(tmp_path / "landed"))
    assert ingest.call_report_table(spark, str(tmp_path / "landed"), "cu_fs220", F.expr(NOW)).count() == 0
    archive(tmp_path / "empty.zip", "")
    ingest.land_call_reports(spark, str(tmp_path / "empty.zip"), str(tmp_path / "none"))
    assert ingest.call_report_table(spark, str(tmp_path / "none"), "cu_fs220n", F.expr(NOW)).count() == 0
