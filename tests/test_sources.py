"""Landed files: envelopes, delimited text, archives, documents and tables."""

import gzip
import json
import zipfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import schemas
from tidemark.operators.columns import align_schema
from tidemark.operators.joins import lookup_join, new_periods
from tidemark.operators.quality import AuditFailed
from tidemark.session import scratch_dir
from tidemark.sources import archives, delimited, documents, envelopes, lookups, tables
from tidemark.sources.newest import BUCKET
from tidemark.sources.part_tables import PartTable
from tidemark.streaming import incremental


def test_envelope_pages_are_read_together(spark, tmp_path):
    record = schemas.record(CERT=schemas.INT, NAME=schemas.TEXT)
    for page, records in enumerate([[(1, "a"), (2, "b")], [(3, None)], []]):
        body = {"meta": {"total": 3}, "data": [{"data": {"CERT": c, "NAME": n}, "score": 1} for c, n in records]}
        (tmp_path / f"page-{page}.json").write_text(json.dumps(body, indent=1))
    read = envelopes.read_envelopes(spark, str(tmp_path), record)
    assert read.columns == ["CERT", "NAME"]
    assert rows(read) == [(1, "a"), (2, "b"), (3, None)]


CALL_REPORT = '"CU_Number","CYCLE_DATE","Acct_Name"\r\n"1","3/31/2023 0:00:00","A, ""quoted"" | piped"\r\n"2","3/31/2023 0:00:00",""\r\n'


def test_delimited_file(spark, tmp_path):
    (tmp_path / "FS220.txt").write_bytes(CALL_REPORT.encode())
    read = delimited.read_delimited(spark, str(tmp_path / "FS220.txt"))
    assert read.columns == ["cu_number", "cycle_date", "acct_name"]
    assert rows(read, "cu_number", "acct_name")[0] == ("1", 'A, "quoted" | piped')
    legacy = delimited.read_delimited(spark, str(tmp_path / "FS220.txt"), legacy_names=True)
    assert legacy.columns == ["cu_number", "cycle_date", "acct__name"]


def _archive(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(f"{path.stem}/{name}", content)


def test_archive_members_and_their_encodings(spark, tmp_path):
    header = "CU_NUMBER,CU_NAME\r\n"
    _archive(tmp_path / "2023-03.zip", {"Branches.txt": (header + '"1","Café"\r\n"2","Plain"').encode("utf-8"), "Readme.txt": "no"})
    _archive(tmp_path / "2023-06.zip", {"branches.TXT": (header + '"3","Café"\r\n"4","Plain"\r\n').encode("iso-8859-1")})
    lines = archives.read_members(spark, str(tmp_path / "*.zip"), ["branches.txt"])
    assert lines.count() == 6
    body = lines.filter("line_no > 1")
    parsed = delimited.parse_delimited(body, "line", header.strip(), keep=("archive",))
    assert rows(parsed, "cu_number", "cu_name") == [("1", "Café"), ("2", "Plain"), ("3", "Café"), ("4", "Plain")]


def test_long_members_arrive_whole(spark, tmp_path):
    n = archives.LINES_PER_BATCH * 2 + 5
    _archive(tmp_path / "a.zip", {"x.txt": "\n".join(str(i) for i in range(n))})
    lines = archives.read_members(spark, str(tmp_path), ["x.txt"])
    got = lines.agg(F.count("*"), F.countDistinct("line_no"), F.sum(F.col("line").cast("bigint")), F.max("line_no")).first()
    assert tuple(got) == (n, n, n * (n - 1) // 2, n)


def test_encoding_is_settled_per_file(spark):
    data = [
        ("utf", 1, "naïve".encode()), ("utf", 2, b"plain"),
        ("latin", 1, "naïve".encode("latin-1")), ("latin", 2, "é ok".encode()), ("latin", 3, None),
    ]
    df = spark.createDataFrame(data, "file string, n int, bytes binary")
    got = archives.decode_with_fallback(df, "bytes", ["file"])
    assert rows(got, "file", "n", "text") == [
        ("latin", 1, "naïve"), ("latin", 2, "Ã© ok"), ("latin", 3, None), ("utf", 1, "naïve"), ("utf", 2, "plain"),
    ]


def test_gzip_documents_and_their_job(spark, tmp_path):
    folder = tmp_path / "repos" / "e31bb378"
    folder.mkdir(parents=True)
    for i in range(3):
        doc = {"url": f"https://h/o/r{i}", "body": "<p>\n</p>", "meta": {"project_link": "p"}}
        (folder / f"{i}.json.gz").write_bytes(gzip.compress(json.dumps(doc, indent=2).encode()))
    read = documents.read_documents(spark, str(folder))
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    stamped = documents.stamp_lineage(read, now=now)
    assert rows(stamped, "url", "meta.project_link", "job_id")[0] == ("https://h/o/r0", "p", "e31bb378")
    assert stamped.count() == 3
    single = documents.read_documents(spark, str(folder / "0.json.gz"))
    assert single.count() == 1
    key = spark.createDataFrame([("projects/abc123.json.gz",)], "k string")
    assert key.select(documents.job_id("k")).first()[0] == "abc123"


def test_raw_bank_tables_from_envelopes(spark):
    record = schemas.record(ID=schemas.TEXT, CERT=schemas.TEXT, NAMEFULL=schemas.TEXT, ASSET=schemas.TEXT)
    body = '{"data":[{"data":{"ID":"x1","CERT":"7","NAMEFULL":"B","ASSET":"12.5"}}]}'
    parsed = envelopes.parse_envelopes(spark.createDataFrame([(body,)], "body string"), "body", record)
    target = schemas.record(financials_id=schemas.TEXT, **{f.name: f.dataType for f in schemas.RAW_BANK_FINANCIALS})
    raw = align_schema(parsed, target, rename=schemas.BANK_FINANCIALS_RENAME, generated=("scraped_at",))
    assert raw.columns == ["financials_id", "cert", "namefull", "asset", "dep", "repdte"]
    first = raw.first()
    assert first.financials_id == "x1" and float(first.asset) == 12.5 and first.dep is None
    # The identifier may also be the table's own business.
    assert "financials_id" not in align_schema(parsed, target, generated=("financials_id",)).columns


def test_state_lookup_is_broadcast(spark):
    df = spark.createDataFrame([("TX",), ("ZZ",), (None,)], "state_code string")
    joined = lookup_join(df, lookups.states(spark), "state_code", "alpha2", {"state": "state"})
    assert rows(joined) == [("TX", "Texas"), ("ZZ", None), (None, None)]
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert len(lookups.STATES) == 51


def test_period_gate(spark):
    incoming = spark.createDataFrame([("20230331", 1), ("20230630", 2), (None, 3)], "p string, v int")
    loaded = spark.createDataFrame([("20230331",), ("20230331",)], "p string")
    assert rows(new_periods(incoming, loaded, "p"), "v") == [(2,), (3,)]
    assert rows(new_periods(incoming, loaded.limit(0), "p"), "v") == [(1,), (2,), (3,)]


def test_append_keeps_and_refresh_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("q1", 1), ("q2", 2)], "q string, v int")
    tables.append_load(df, path, ["q"])
    tables.append_load(df.filter("v = 2"), path, ["q"])
    assert rows(spark.read.parquet(path), "v") == [(1,), (2,), (2,)]
    tables.full_refresh(df.filter("v = 2"), path, ["q"])
    assert rows(spark.read.parquet(path), "v") == [(2,)]


def test_partitions_are_written_by_few_tasks_but_a_large_one_by_many(spark, tmp_path):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.shuffle.partitions": "200"}
    saved = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        value = F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(99)
        df = spark.range(0, 40_000, 1, 16).select(value.alias("q"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        tables.append_load(df, str(tmp_path / "t"), ["q"])
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)
    files = {q: len(list((tmp_path / "t" / f"q={q}").glob("*.parquet"))) for q in (*range(7), 99)}
    # Sixteen tasks would each have written every value.
    assert files[99] > 4 and sum(files[q] for q in range(7)) < 16 * 7 / 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40_000


def test_failed_audit_leaves_the_published_table(spark, tmp_path):
    good = spark.createDataFrame([("a", 1), ("b", 2)], "dim_id string, v int")
    bad = spark.createDataFrame([("a", 1), ("a", 3)], "dim_id string, v int")
    root = str(tmp_path)
    published = tables.write_audit_publish(good, "kept", root)
    assert rows(published) == [("a", 1), ("b", 2)]
    with pytest.raises(AuditFailed):
        tables.write_audit_publish(bad, "kept", root)
    assert rows(spark.table("kept")) == [("a", 1), ("b", 2)]
    assert len(list((tmp_path / "kept").glob("version=*"))) == 1
    newer = tables.write_audit_publish(good.withColumn("v", F.col("v") * 10), "kept", root)
    assert rows(newer) == rows(spark.table("kept")) == [("a", 10), ("b", 20)]


def test_publish_writes_once(spark, tmp_path):
    """What is published is what was audited, even if the source is not repeatable."""
    df = spark.range(50).select(F.uuid().alias("dim_id"))
    published = tables.write_audit_publish(df, "random_ids", str(tmp_path))
    assert rows(published) == rows(spark.table("random_ids"))


def session_like(setting, master):
    conf = SimpleNamespace(get=lambda key, default=None: setting or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_follows_the_session_setting():
    shared = session_like("hdfs://shared/scratch/", "yarn")
    first, second = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert first.startswith("hdfs://shared/scratch/x-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session_like(None, "yarn"), "x")
    assert scratch_dir(session_like(None, "local[2]"), "x").startswith("/")


EVENT = schemas.record(k=schemas.TEXT, v=schemas.INT, ts=schemas.INT)


def _land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("k", "v", "ts"), line))) for line in lines))


def test_landing_takes_every_file_once(spark, tmp_path):
    landed, target, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        stream = incremental.file_stream(spark, str(landed), EVENT, "json")
        incremental.incremental_land(stream, target, progress, lambda df: df.select("k", "v"))
        return rows(spark.read.parquet(target))

    _land(landed, "1.json", [("a", 1, 1), ("b", 2, 1)])
    assert run() == [("a", 1), ("b", 2)]
    assert run() == [("a", 1), ("b", 2)]
    _land(landed, "2.json", [("a", 3, 2)])
    assert run() == [("a", 1), ("a", 3), ("b", 2)]


def _latest(spark, tmp_path, checkpoint="progress", **options):
    stream = incremental.file_stream(spark, str(tmp_path / "in"), EVENT, "json", maxFilesPerTrigger="1")
    incremental.incremental_latest(stream, str(tmp_path / "out"), str(tmp_path / checkpoint), ["k"], "ts", ["v"], **options)
    return rows(incremental.read_latest(spark, str(tmp_path / "out")))


def test_incremental_latest_survives_late_rows_and_repeats(spark, tmp_path):
    _land(tmp_path / "in", "1.json", [("a", 1, 5), ("a", 2, 3), ("b", 1, 1), (None, 4, 4)])
    assert _latest(spark, tmp_path) == [("a", 1, 5), ("b", 1, 1), (None, 4, 4)]
    _land(tmp_path / "in", "2.json", [("a", 9, 4), ("b", 7, 2), (None, 3, 3)])
    newest = [("a", 1, 5), ("b", 7, 2), (None, 4, 4)]
    assert _latest(spark, tmp_path) == newest
    # Another checkpoint counts its batches from 0 again: refused, unless it is to take over.
    with pytest.raises(incremental.ForeignCheckpoint):
        _latest(spark, tmp_path, "again")
    assert _latest(spark, tmp_path, "again", adopt=True) == newest
    with pytest.raises(incremental.ForeignCheckpoint):
        _latest(spark, tmp_path)


def test_fifty_batches_leave_one_set_of_files_a_bucket(spark, tmp_path):
    want = {}
    for i in range(50):
        lines = [(f"k{(i * 7 + j) % 20}", i, (i * 13 + j) % 40) for j in range(3)]
        _land(tmp_path / "in", f"{i:02}.json", lines)
        for k, v, ts in lines:
            want[k] = max(want.get(k, (-1, -1)), (ts, v))
    assert _latest(spark, tmp_path, buckets=4, grace=0) == sorted((k, v, ts) for k, (ts, v) in want.items())
    live = [p for p in (tmp_path / "out" / "data").rglob("key_bucket=*")]
    assert len(live) <= 4 and len({p.name for p in live}) == len(live)
    assert len(list((tmp_path / "out" / "_commits").glob("*.json"))) == 1


def test_a_batch_that_dies_or_is_repeated_changes_nothing(spark, tmp_path, monkeypatch):
    _land(tmp_path / "in", "1.json", [("a", 1, 5), ("b", 1, 1)])
    before = _latest(spark, tmp_path)
    _land(tmp_path / "in", "2.json", [("a", 2, 6), ("c", 1, 1)])
    commit = PartTable._commit

    def killed(*_):
        raise RuntimeError("killed before the record")

    monkeypatch.setattr(PartTable, "_commit", killed)
    with pytest.raises(Exception, match="killed"):
        _latest(spark, tmp_path)
    assert rows(incremental.read_latest(spark, str(tmp_path / "out"))) == before

    def dies_after(*args):
        commit(*args)
        raise RuntimeError("killed after the record")

    monkeypatch.setattr(PartTable, "_commit", dies_after)
    with pytest.raises(Exception, match="killed"):
        _latest(spark, tmp_path)
    monkeypatch.setattr(PartTable, "_commit", commit)
    after = [("a", 2, 6), ("b", 1, 1), ("c", 1, 1)]
    assert rows(incremental.read_latest(spark, str(tmp_path / "out"))) == after
    version = PartTable(spark, str(tmp_path / "out"), BUCKET).state().version
    # The stream does its batch again, finds it recorded, and leaves the table alone.
    assert _latest(spark, tmp_path) == after
    assert PartTable(spark, str(tmp_path / "out"), BUCKET).state().version == version


def test_partition_values_keep_their_types(spark, tmp_path):
    df = spark.createDataFrame([("007", "20230331", 1), ("010", "20230630", 2)], "code string, day string, v int")
    for name, temporary in (("coded", True), ("coded_for_good", False)):
        published = tables.write_audit_publish(df, name, str(tmp_path), key=None, partition_by=["day", "code"], temporary=temporary)
        assert dict(published.dtypes) == dict(df.dtypes)
        assert rows(published, "code", "day", "v") == rows(df)
    tables.append_load(df, str(tmp_path / "plain"), ["code"])
    assert rows(tables.read_typed(spark, str(tmp_path / "plain"), df.schema), "code", "day", "v") == rows(df)
    assert tables.partition_values(spark, str(tmp_path / "plain"), "code") == ["007", "010"]


def test_old_and_failed_versions_go(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, dim_id string")
    for _ in range(4):
        tables.write_audit_publish(df, "again", str(tmp_path), temporary=True)
    assert len(list((tmp_path / "again").glob("version=*"))) == 2
    broken = df.withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        tables.write_audit_publish(broken, "again", str(tmp_path), temporary=True)
    assert len(list((tmp_path / "again").glob("version=*"))) == 2 and spark.table("again").count() == 2
