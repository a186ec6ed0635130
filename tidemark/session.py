"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    # The scrape day is cut from a timestamp, so the zone is part of the result.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

PARTITION_BYTES = 256 << 20


def shuffle_conf(shuffle_bytes: int) -> dict[str, str]:
    """Shuffle width for a job of known size; pass it to ``build_session``.

    Adaptive execution merges small partitions but never adds any, so a job
    starts with enough for its largest shuffle to fit in memory.
    """
    wanted = -(-shuffle_bytes // PARTITION_BYTES)
    return {"spark.sql.shuffle.partitions": str(max(wanted, 200))}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs rely on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Where the setting is absent and the session is local (tests, laptops) a
    temporary folder takes its place until the process ends; a cluster without
    it is refused, because its executors could not see a folder of the driver's.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What queries in here shuffle is deleted as each ends, not when the driver happens to collect garbage.

    For writes and audits, which nothing else reads from.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def settled(df: DataFrame) -> DataFrame:
    """``df`` as computed now, kept in the shared checkpoint folder.

    For rows that are read twice and must be the same both times, such as those
    that carry the number of their partition.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there.

    For rows that cost much and are read several times, each time other columns,
    so that Spark would not see that they are the same.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
