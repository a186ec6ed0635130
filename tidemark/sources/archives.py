"""Members of landed zip archives, and text of uncertain encoding."""

from __future__ import annotations

import codecs
import csv
import io
import uuid
import zipfile
from collections.abc import Iterator
from typing import IO

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_dir
from tidemark.sources.delimited import snake_case

LINE_SCHEMA = "archive string, member string, line_no long, line string"
LANDED_SCHEMA = "archive string, opening string, line_no long, fields array<string>, clean boolean, member string, kind string"
LINES_PER_BATCH = 10_000
BLOCK_BYTES = 1 << 20
#: Longest field of a delimited member; the csv module stops at 128 KiB by itself.
FIELD_BYTES = 1 << 30


def read_members(spark: SparkSession, path: str | list[str], members: list[str]) -> DataFrame:
    """Text lines of the named members of every zip archive under ``path``."""
    return member_lines(spark.read.format("binaryFile").load(path), members)


def member_lines(archives: DataFrame, members: list[str]) -> DataFrame:
    """Text lines of the named members of archives held as (path, content) rows.

    An archive is one compressed stream, so it is opened by one task, which
    hands its lines on in small batches. Members are matched by their name
    without folders. A member is UTF-8 unless it holds a byte sequence that is
    not, and then all of it is ISO-8859-1.
    """

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for archive, name, opened, info in _members(batches, members):
            yield from _line_batches(archive, name, opened, info)

    return archives.select("path", "content").mapInPandas(lines, LINE_SCHEMA)


# -- all members in one pass --------------------------------------------------


def opened(path: str, mode: str = "rb") -> IO[bytes]:
    """A file as a seekable stream, wherever pyarrow can reach it (local, hdfs, s3, gs, abfs)."""
    system, name = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    if mode == "wb":
        system.create_dir(name.rsplit("/", 1)[0])
        return system.open_output_stream(name)
    return system.open_input_file(name)


class _Watched(io.RawIOBase):
    """A member's bytes on their way to a reader; whether all of them so far were UTF-8."""

    def __init__(self, member: IO[bytes]) -> None:
        self.member, self.decoder, self.clean = member, codecs.getincrementaldecoder("utf-8")(), True

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        block = self.member.read(len(into))
        into[: len(block)] = block
        if self.clean:
            try:
                self.decoder.decode(block, final=not block)
            except UnicodeDecodeError:
                self.clean = False
        return len(block)


def land_members(spark: SparkSession, path: str | list[str], members: list[str], target: str) -> None:
    """Land the named delimited members of every archive under ``path``, in one pass.

    Each archive is opened once, by path and as a stream, whatever its size, and
    each member is decompressed once. Its rows are landed by member below
    ``target``, every byte as the letter of ISO-8859-1; what was found out by
    the member's end (its header, and whether all of it is UTF-8) is landed as
    one more row. Reading joins the two. Members are matched by their name
    without folders, in any case.
    """
    wanted = {m.lower() for m in members}

    def land(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["path"]:
                opening = uuid.uuid4().hex
                with opened(archive) as file, zipfile.ZipFile(file) as held:
                    for info in held.infolist():
                        member = info.filename.rsplit("/", 1)[-1].lower()
                        if member in wanted:
                            yield from _landed(archive, opening, member, held, info)

    files = spark.read.format("binaryFile").load(path).select("path")
    # One archive is one stream; an archive of its own for each task that there can be.
    n = max(files.count(), 1)
    dealt = files.repartition(n, F.monotonically_increasing_id())
    dealt.mapInPandas(land, LANDED_SCHEMA).write.partitionBy("member", "kind").parquet(target)


def _landed(archive: str, opening: str, member: str, held: zipfile.ZipFile, info: zipfile.ZipInfo) -> Iterator[pd.DataFrame]:
    with held.open(info) as stream:
        watched = _Watched(stream)
        csv.field_size_limit(FIELD_BYTES)
        rows = csv.reader(io.TextIOWrapper(io.BufferedReader(watched, BLOCK_BYTES), "iso-8859-1", newline=""))
        header = next(rows, [])
        first, lines = 1, []

        def frame(kind: str, values: list, line_no, clean=None) -> pd.DataFrame:
            return pd.DataFrame({"archive": archive, "opening": opening, "line_no": line_no, "fields": values, "clean": clean, "member": member, "kind": kind})

        for row in rows:
            lines.append(row)
            if len(lines) == LINES_PER_BATCH:
                yield frame("rows", lines, range(first, first + len(lines)))
                first, lines = first + len(lines), []
        if lines:
            yield frame("rows", lines, range(first, first + len(lines)))
        if watched.clean:
            header = [name.encode("iso-8859-1").decode("utf-8") for name in header]
        yield frame("info", [_header(header)], [0], watched.clean)


def _part(spark: SparkSession, landed: str, member: str, kind: str) -> DataFrame:
    """Rows of one member and kind; none where no archive has the member."""
    rows = spark.read.schema(LANDED_SCHEMA).parquet(landed)
    return rows.where((F.col("member") == member.lower()) & (F.col("kind") == kind))


def landed_columns(spark: SparkSession, landed: str, member: str) -> list[str]:
    """Snake-case names of all columns that any archive's ``member`` has, in order of their names."""
    names = _part(spark, landed, member, "info").select(F.explode("fields").alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())


def landed_records(spark: SparkSession, landed: str, member: str, columns: list[str] | None = None) -> DataFrame:
    """Named columns (all, unless given) of one landed member, as text.

    Each archive's member is read by its own header, so archives of different
    years may lay their columns out differently; a column an archive lacks is
    NULL. A member is UTF-8 unless it holds a byte sequence that is not, and
    then all of it is ISO-8859-1.
    """
    columns = landed_columns(spark, landed, member) if columns is None else columns
    place = lambda name: F.nullif(F.array_position("fields", F.lit(name)), F.lit(0)).cast("int") - 1
    info = _part(spark, landed, member, "info").select(
        F.col("opening").alias("_opening"), F.col("clean").alias("_clean"), *[place(c).alias(f"_at_{i}") for i, c in enumerate(columns)]
    )
    rows = _part(spark, landed, member, "rows").select("opening", "fields")
    known = rows.join(info, rows["opening"] == info["_opening"])
    fields = [F.get("fields", F.col(f"_at_{i}")) for i in range(len(columns))]
    return known.select(*[_text(value).alias(c) for c, value in zip(columns, fields)])


def _text(letters: Column) -> Column:
    """What letters of ISO-8859-1 stand for: in ASCII themselves, in a clean member the UTF-8 of their bytes."""
    plain = ~F.col("_clean") | (F.octet_length(letters) == F.length(letters))
    return F.when(plain, letters).otherwise(F.encode(letters, "ISO-8859-1").cast("string"))


def read_member_records(
    spark: SparkSession, path: str | list[str], member: str, columns: list[str] | None = None
) -> DataFrame:
    """Named columns of one member of every archive, landed in a scratch folder on the way."""
    landed = scratch_dir(spark, "members")
    land_members(spark, path, [member], landed)
    return landed_records(spark, landed, member, columns)


def _header(names: list[str]) -> list[str]:
    return [snake_case(name.strip("'")) for name in names]


def _members(
    batches: Iterator[pd.DataFrame], members: list[str]
) -> Iterator[tuple[str, str, zipfile.ZipFile, zipfile.ZipInfo]]:
    wanted = {m.lower() for m in members}
    for batch in batches:
        for archive, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as opened:
                for info in opened.infolist():
                    name = info.filename.rsplit("/", 1)[-1]
                    if name.lower() in wanted:
                        yield archive, name, opened, info


def _encoding(opened: zipfile.ZipFile, info: zipfile.ZipInfo) -> str:
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        with opened.open(info) as member:
            while block := member.read(BLOCK_BYTES):
                decoder.decode(block)
            decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return "iso-8859-1"
    return "utf-8"


def _line_batches(
    archive: str, name: str, opened: zipfile.ZipFile, info: zipfile.ZipInfo
) -> Iterator[pd.DataFrame]:
    encoding = _encoding(opened, info)
    held: list[str] = []
    first = 1
    with opened.open(info) as member:
        for line in member:
            held.append(line.rstrip(b"\r\n").decode(encoding))
            if len(held) == LINES_PER_BATCH:
                yield _frame(archive, name, first, held)
                first, held = first + len(held), []
    if held:
        yield _frame(archive, name, first, held)


def _frame(archive: str, member: str, first: int, lines: list[str]) -> pd.DataFrame:
    numbers = range(first, first + len(lines))
    return pd.DataFrame(
        {"archive": archive, "member": member, "line_no": numbers, "line": lines}
    )


def decode_with_fallback(
    df: DataFrame, column: str, file_key: list[str], into: str = "text"
) -> DataFrame:
    """Bytes as text: UTF-8, or ISO-8859-1 for a whole file with any bad byte.

    Whether a file is clean is settled by a partial aggregate that yields one
    flag per file; lines are not gathered by file.
    """
    as_text = F.col(column).cast("string")
    clean = df.groupBy(*file_key).agg(F.bool_and(F.is_valid_utf8(as_text)).alias("_clean"))
    flagged = df.join(clean, file_key, "left")
    text = F.when(F.col("_clean"), as_text).otherwise(F.decode(F.col(column), "ISO-8859-1"))
    return flagged.withColumn(into, text).drop("_clean", column)
