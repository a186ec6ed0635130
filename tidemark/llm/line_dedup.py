"""Lines that many documents share, found through levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z lowered; keys
below ``LEAST_CHARS`` code points never count. Documents come in batches, from
the largest ids down. A batch is reduced to one row a key (documents, largest
id), which merge-joins every run: keys that no run has are new, and the batch's
largest id is their owner, as later batches hold smaller ids only; of keys known
before only the count is kept. These rows are the batch's own run. Runs are
tables in buckets of the key's hash, sorted in each, so a batch is shuffled once
and the runs never. Two runs of a level are compacted to one of the next level
by a merge join, so there is one run a level at most, as many levels as a number
of batches has binary digits, and a key is rewritten once a level. Keys of
``LEAST_DOCS`` documents or more lose their lines but in their owner.

Counts are pre-aggregated by key and document before any shuffle by key, and a
key that holds many of all lines meets them by broadcast. Keys are told apart by
128 bits of hash. No run outlives the call; the lines' hashes stay in the
scratch folder while the result is read.

Defined results: a null or empty text is one empty line. Rows that repeat an id
are one document with the lines of all. A row without an id is no document: it
counts for nothing and loses the common lines. Columns other than doc_id and
text are not read.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

import string
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.checkpoints import cut
from tidemark.llm.hot_joins import join_by_weight
from tidemark.session import scratch_dir
from tidemark.sources.files import delete_folder

LEAST_CHARS = 40
LEAST_DOCS = 5
BATCHES = 6
#: White space cut from the ends of a line.
SPACES = " \t\n\x0b\x0c\r"
HASHES = ["h1", "h2"]


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), string.ascii_uppercase, string.ascii_lowercase)


def line_hashes(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, text_id, at, h1, h2) of every line of ``docs`` (doc_id, text) that is long enough to count."""
    # The sum is worked out below the explode; beside it, it would be worked out for every line.
    whole = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_id"), _lines("text").alias("lines"))
    lines = whole.select("doc_id", "text_id", F.posexplode("lines").alias("at", "line"))
    keys = lines.select("doc_id", "text_id", "at", _key(F.col("line")).alias("key")).where(F.length("key") >= least_chars)
    return keys.select("doc_id", "text_id", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """Runs of (h1, h2, owner, n): a key has one row with an owner, and rows without that add to its count."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.root = scratch_dir(spark, "line-runs")
        #: The run of each level, or None where there is none.
        self.levels: list[str | None] = []

    def _written(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, *HASHES).sortBy(*HASHES).option("path", f"{self.root}/{name}")
        writer.format("parquet").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        delete_folder(self.spark, f"{self.root}/{name}")

    def _merged(self, one: DataFrame, other: DataFrame) -> DataFrame:
        more = other.select(*HASHES, F.col("owner").alias("other_owner"), F.col("n").alias("other_n"))
        rows = one.join(more.hint("merge"), HASHES, "full")
        n = F.coalesce("n", F.lit(0)) + F.coalesce("other_n", F.lit(0))
        return rows.select(*HASHES, F.coalesce("owner", "other_owner").alias("owner"), n.alias("n"))

    def _runs(self) -> list[str]:
        return [name for name in self.levels if name is not None]

    def run_of(self, lines: DataFrame) -> DataFrame:
        """The run of a batch of ``lines`` (doc_id, h1, h2): new keys have an owner, known ones none."""
        by_document = lines.select("doc_id", *HASHES).distinct()
        rows = by_document.groupBy(*HASHES).agg(F.max("doc_id").alias("owner"), F.count("*").alias("n"))
        known = F.lit(False)
        for i, name in enumerate(self._runs()):
            owned = self.spark.table(name).where("owner IS NOT NULL").select(*HASHES, F.lit(True).alias(f"in_{i}"))
            rows = rows.join(owned.hint("merge"), HASHES, "left")
            known = known | F.col(f"in_{i}").isNotNull()
        return rows.select(*HASHES, F.when(~known, F.col("owner")).alias("owner"), "n")

    def add(self, lines: DataFrame) -> None:
        """Take in a batch, of ids that are all smaller than those before, and compact equal levels."""
        new, level = self._written(self.run_of(lines)), 0
        while level < len(self.levels) and self.levels[level] is not None:
            old = self.levels[level]
            merged = self._written(self._merged(self.spark.table(old), self.spark.table(new)))
            self.levels[level] = None
            self._drop(old)
            self._drop(new)
            new, level = merged, level + 1
        self.levels[level : level + 1] = [new]

    def counts(self) -> DataFrame:
        """(h1, h2, owner, n) of every key."""
        return reduce(self._merged, [self.spark.table(name) for name in self._runs()])

    def close(self) -> None:
        for name in self._runs():
            self._drop(name)
        self.levels = []
        delete_folder(self.spark, self.root)


def _bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ids that cut ``docs`` into about equal batches, the smallest first."""
    shares = F.array(*[F.lit(i / batches) for i in range(1, batches)])
    return sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] or []))


def common_lines(lines: DataFrame, bounds: list[int], least_docs: int = LEAST_DOCS) -> DataFrame:
    """(h1, h2, owner, n) of keys of at least ``least_docs`` documents, from written ``lines`` with their batch."""
    runs = LineRuns(lines.sparkSession)
    try:
        for batch in range(len(bounds) + 1):
            runs.add(lines.where(F.col("batch") == batch))
        return cut(runs.counts().where(F.col("n") >= least_docs))
    finally:
        runs.close()


def drop_common_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES
) -> DataFrame:
    """doc_id, text without its common lines, n_lines (before) and n_dropped, for every row of ``docs``."""
    spark = docs.sparkSession
    bounds = _bounds(docs, batches)
    below = [F.when(F.col("doc_id") <= bound, 1).otherwise(0) for bound in bounds]
    path = scratch_dir(spark, "line-hashes")
    # Batch 0 has the largest ids; lines without an id are in none.
    batch = F.when(F.col("doc_id").isNull(), -1).otherwise(sum(below, F.lit(0)))
    line_hashes(docs, least_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc_id long, text_id string, at int, h1 long, h2 long, batch int").parquet(path)
    common = common_lines(lines, bounds, least_docs)

    counted = lines.select("doc_id", "text_id", "at", *HASHES)
    met = join_by_weight(counted, common, HASHES, "n").where(~F.col("doc_id").eqNullSafe(F.col("owner")))
    dropped = met.groupBy(F.col("doc_id").alias("_doc"), F.col("text_id").alias("_text")).agg(F.collect_set("at").alias("gone"))
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = whole.join(dropped, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.md5("text") == F.col("_text")), "left")
    split = rows.select("doc_id", "text", "gone", _lines("text").alias("lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    stay = F.array_join(F.transform(places, lambda at: F.get("lines", at)), "\n")
    return split.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(stay).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
