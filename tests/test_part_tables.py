"""Tables whose parts are replaced whole: what is visible when, to whom, and for how long."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import ingest
from tidemark.sources import files
from tidemark.sources.part_tables import Conflict, PartTable


def frame(spark, *records):
    return spark.createDataFrame(records, "day string, v int").withColumn("day", F.col("day").cast("date"))


def seen(table):
    return rows(table.read().select(F.col("day").cast("string"), "v"))


def test_a_file_is_put_once(spark, tmp_path):
    path = str(tmp_path / "a" / "1.json")
    assert files.read_text(spark, path) is None
    assert files.put_new(spark, path, "é") and not files.put_new(spark, path, "other")
    assert files.read_text(spark, path) == "é" and files.names_in(spark, str(tmp_path / "a"), folders=False) == ["1.json"]


def test_parts_are_added_and_replaced_whole(spark, tmp_path):
    table = PartTable(spark, str(tmp_path), "day")
    with pytest.raises(ValueError, match="not been written"):
        table.read()
    assert table.append(frame(spark, ("2023-03-31", 1), ("2023-03-31", 2), (None, 3))) == ["day=2023-03-31", "day=__HIVE_DEFAULT_PARTITION__"]
    assert table.append(frame(spark, ("2023-03-31", 9), ("2023-06-30", 4), (None, 9))) == ["day=2023-06-30"]
    assert seen(table) == [("2023-03-31", 1), ("2023-03-31", 2), ("2023-06-30", 4), (None, 3)]
    assert table.append(frame(spark, ("2023-03-31", 9))) == []
    old = table.state()
    assert table.replace(frame(spark, ("2023-03-31", 7))) == ["day=2023-03-31"]
    assert seen(table) == [("2023-03-31", 7), ("2023-06-30", 4), (None, 3)]
    # Who began earlier reads on, until the grace period is over.
    assert table.read(state=old).count() == 4
    assert table.vacuum() == [] and table.read(state=old).count() == 4
    assert len(table.vacuum(0)) == 1
    assert seen(table) == [("2023-03-31", 7), ("2023-06-30", 4), (None, 3)] and table.state().version == 3
    assert table.read(["day=2023-06-30"]).count() == 1 and table.read([]).count() == 0


def test_a_killed_append_hides_and_repeats_nothing(spark, tmp_path):
    table = PartTable(spark, str(tmp_path), "day")
    table.append(frame(spark, ("2023-03-31", 1)))
    more = frame(spark, *[("2023-06-30", i) for i in range(50)], ("2023-09-30", 60))
    half = more.withColumn("v", F.when(F.col("v") < 60, F.col("v")).otherwise(F.raise_error(F.lit("killed")).cast("int")))
    for _ in range(2):
        with pytest.raises(Exception, match="killed"):
            table.append(half)
        assert seen(table) == [("2023-03-31", 1)]
    # A writer that is gone leaves its files; they are no rows either.
    more.write.partitionBy("day").parquet(str(tmp_path / "data" / "load=vdead"))
    assert seen(table) == [("2023-03-31", 1)]
    assert table.append(more) == ["day=2023-06-30", "day=2023-09-30"]
    assert table.read().count() == 52 and table.append(more) == []
    table.vacuum(0)
    assert table.read().count() == 52 and not (tmp_path / "data" / "load=vdead").exists()


def test_of_two_writers_of_a_part_one_is_refused(spark, tmp_path):
    table = PartTable(spark, str(tmp_path), "day")
    table.append(frame(spark, ("2023-03-31", 1)))
    base = table.state()
    table.append(frame(spark, ("2023-06-30", 2)))
    # Another part: both stand. The same part: the later one is refused and leaves no files.
    assert table.replace(frame(spark, ("2023-09-30", 3)), base) == ["day=2023-09-30"]
    loads = files.names_in(spark, str(tmp_path / "data"))
    with pytest.raises(Conflict, match="2023-06-30"):
        table.replace(frame(spark, ("2023-06-30", 4), ("2023-12-31", 4)), base)
    assert files.names_in(spark, str(tmp_path / "data")) == loads
    assert seen(table) == [("2023-03-31", 1), ("2023-06-30", 2), ("2023-09-30", 3)]


def test_columns_may_come_later(spark, tmp_path):
    table = PartTable(spark, str(tmp_path), "day")
    table.append(frame(spark, ("2023-03-31", 1)))
    table.append(frame(spark, ("2023-06-30", 2)).withColumn("w", F.lit("x")).drop("v"))
    assert rows(table.read(), "v", "w") == [(1, None), (None, "x")]
    with pytest.raises(ValueError, match="v is int"):
        table.append(frame(spark, ("2023-09-30", 2)).withColumn("v", F.lit("x")))
    with pytest.raises(ValueError, match="cut by day"):
        PartTable(spark, str(tmp_path), "v").read()


def test_a_failed_landing_is_repeated_whole(spark, tmp_path):
    target = str(tmp_path)
    landed = spark.createDataFrame([("3/31/2023", 1), ("2023-06-30", 2)], "cycle_date string, v int")
    with pytest.raises(Exception, match="without cycle_date"):
        ingest.land_new_periods(landed.unionByName(spark.createDataFrame([(None, 3)], "cycle_date string, v int")), target, "cycle_date")
    assert ingest.land_new_periods(landed, target, "cycle_date") == ["report_period=2023-03-31", "report_period=2023-06-30"]
    assert rows(ingest.landed_periods(spark, target).read(), "v") == [(1,), (2,)]


def test_stored_buckets_need_no_exchange(spark, tmp_path):
    def stored(name, n):
        table = PartTable(spark, str(tmp_path / name), "day", bucket_by=["k", "period"], buckets=3)
        wide = spark.range(n).select((F.col("id") % 7).alias("k"), F.col("id").alias(name), F.expr("date'2023-03-31' + int(id % 2)").alias("day"))
        wide = wide.withColumn("period", F.col("day"))
        table.append(wide.where("day = date'2023-03-31'"))
        table.append(wide)
        table.replace(wide.where("day = date'2023-04-01'"))
        return table.as_table(f"stored_{name}")

    left, right = stored("a", 40), stored("b", 30)
    joined = left.join(right.drop("day").hint("merge"), ["k", "period"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    plain = spark.range(40).join(spark.range(30).withColumnRenamed("id", "b"), F.expr("id % 7 = b % 7 and id % 2 = b % 2"))
    assert joined.count() == plain.count() and left.count() == 40
