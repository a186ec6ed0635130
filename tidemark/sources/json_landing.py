"""JSON files landed in one parse: good rows to one side, bad ones to the other, both counted.

What parses and is fit for use goes to ``kind=good`` below a landing's folder;
what does not goes to ``kind=bad`` with its file and the reason. The counts come
from the very pass that writes, and a landing with more bad rows than its limit
allows is taken back whole. Everything after reads the landed columns; the JSON
is not parsed again.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.sources.files import delete_folder

CORRUPT = "_corrupt_record"
BAD = "file string, reason string, n_chars long"


class TooManyBad(ValueError):
    """More rows than allowed could not be used; nothing was landed."""


class Landing(NamedTuple):
    """Where a landing's rows are, their schema, and how many were good and bad."""

    spark: SparkSession
    path: str
    schema: T.StructType
    good: int
    bad: int

    def rows(self) -> DataFrame:
        """The good rows, with the file of each."""
        if not self.good:
            return self.spark.createDataFrame([], _with_file(self.schema))
        return self.spark.read.schema(_with_file(self.schema)).parquet(f"{self.path}/kind=good")

    def dead_letters(self) -> DataFrame:
        """The bad rows' files, reasons and lengths."""
        if not self.bad:
            return self.spark.createDataFrame([], BAD)
        return self.spark.read.schema(BAD).parquet(f"{self.path}/kind=bad")

    def drop(self) -> None:
        delete_folder(self.spark, self.path)


def _with_file(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("file", T.StringType())])


def land_json(
    spark: SparkSession,
    path: str | list[str],
    target: str,
    schema: T.StructType,
    unfit: Column | None = None,
    multi_line: bool = True,
    limit: int = 0,
) -> Landing:
    """Land the documents under ``path`` in a new folder below ``target``.

    A document is bad if it does not parse under ``schema`` or if ``unfit``
    gives a reason for it. With one document a file (``multi_line``), a file
    that cannot be read at all, such as a compressed one cut short, is a bad
    row too; in a file of many lines it is an error, as lines before the cut
    would be landed and those after it be missed without a trace.
    """
    folder = f"{target.rstrip('/')}/load=v{uuid.uuid4().hex}"
    text = T.StructField(CORRUPT, T.StringType())
    reader = spark.read.schema(T.StructType([*schema.fields, text])).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line)
    read = reader.option("ignoreCorruptFiles", multi_line).json(path).withColumn("file", F.col("_metadata.file_path"))
    own = F.lit(None).cast("string") if unfit is None else unfit
    judged = read.withColumn("reason", F.when(F.col(CORRUPT).isNotNull(), F.lit("does not parse")).otherwise(own))
    counts = Observation()
    counted = judged.observe(counts, F.count_if(F.col("reason").isNull()).alias("good"), F.count("reason").alias("bad"))
    bad = F.col("reason").isNotNull()
    routed = counted.select(
        *[F.when(~bad, F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields],
        "file",
        "reason",
        F.length(CORRUPT).cast("long").alias("n_chars"),
        F.when(bad, "bad").otherwise("good").alias("kind"),
    )
    try:
        routed.write.partitionBy("kind").parquet(folder)
        found = counts.get
        landing = Landing(spark, folder, schema, int(found["good"]), int(found["bad"]))
        if multi_line:
            landing = _with_unreadable(landing, path)
        if landing.bad > limit:
            first = landing.dead_letters().orderBy("file").first()
            raise TooManyBad(f"{landing.bad} of {landing.good + landing.bad} documents cannot be used, {limit} allowed; {first['file']}: {first['reason']}")
    except Exception:
        delete_folder(spark, folder)
        raise
    return landing


def _with_unreadable(landing: Landing, path: str | list[str]) -> Landing:
    """Add the files that gave no row: their names are compared, no content is read."""
    spark = landing.spark
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    seen = landing.rows().select("file").union(landing.dead_letters().select("file"))
    missing = files.join(seen.distinct(), "file", "left_anti")
    lost = missing.select("file", F.lit("cannot be read").alias("reason"), F.lit(None).cast("long").alias("n_chars"))
    counts = Observation()
    found = lost.observe(counts, F.count("*").alias("bad"))
    found.write.mode("append").parquet(f"{landing.path}/kind=bad")
    return landing._replace(bad=landing.bad + int(counts.get["bad"]))
