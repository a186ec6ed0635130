"""Process every landed file once, then stop."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.files import read_text
from tidemark.sources.newest import NewestTable


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """The files of a folder as a stream; ``maxFilesPerTrigger`` sets batch size."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def incremental_land(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    partition_by: Sequence[str] = (),
) -> None:
    """Append what is new to ``target``, exactly once, and return.

    ``shape`` aligns and stamps the records. The checkpoint remembers the files
    done and the file sink commits whole batches, so a restart repeats nothing.
    """
    query = (
        shape(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


class ForeignCheckpoint(Exception):
    """The table is kept by a stream with another checkpoint; nothing was changed."""


def stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the stream that a checkpoint belongs to; None before its first run."""
    told = read_text(spark, f"{checkpoint.rstrip('/')}/metadata")
    return None if told is None else json.loads(told)["id"]


def incremental_latest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    ts: str,
    tiebreak: Sequence[str | Column] = (),
    buckets: int = 64,
    grace: float = 3600,
    adopt: bool = False,
) -> None:
    """Keep each key's newest row as files arrive; read it with ``read_latest``.

    Keys are dealt over ``buckets`` parts of a table. A batch is cut down to its
    own newest rows, and only the parts it touches are read and written anew; one
    record publishes them, with the stream's id and the batch's number. So the
    table holds one row a key and one set of files a part, a batch that died or
    is repeated changes nothing, and a stream with another checkpoint is refused
    (``ForeignCheckpoint``): its batches would count from 0 again. ``adopt`` lets
    it take the table over, for a checkpoint that is lost: rows met twice change
    nothing. Files that no record reads go ``grace`` seconds after they were
    written. The number of buckets stays what it was when the table began.
    """
    spark = stream.sparkSession
    newest = NewestTable(spark, target, keys, ts, tiebreak, stream.schema, buckets)
    own, notes = stream_id(spark, checkpoint), newest.table.state().notes
    if notes and notes["stream"] != own and not adopt:
        raise ForeignCheckpoint(f"{target} is kept by stream {notes['stream']}, {checkpoint} has {own}")

    def write(batch: DataFrame, batch_id: int) -> None:
        state, own = newest.table.state(), stream_id(spark, checkpoint)
        if state.notes.get("stream") != own or state.notes["batch"] < batch_id:
            newest.merge(batch, state, {"stream": own, "batch": batch_id})

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    newest.table.vacuum(grace)


def read_latest(spark: SparkSession, target: str) -> DataFrame:
    """The newest row of every key over all batches so far."""
    return NewestTable(spark, target).read()
