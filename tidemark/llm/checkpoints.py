"""Lineage cuts in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import scratch_dir


def cut(df: DataFrame) -> DataFrame:
    """``df`` as computed now, kept in ``spark.checkpoint.dir``.

    Executors that are lost later do not take it with them. A folder of our own
    takes its place only where the setting is absent (tests).
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()
