"""Legacy web archives: ARC files, versions 1 and 2, converted to WARC and read back.

An ARC file opens with a version block, whose second line names the version; in
every later header line the fields are counted from the right, since a URL may
hold spaces, and the last one declares the record's length. A record becomes a
WARC record with an identifier derived from its archive and place, its 14-digit
date as ISO 8601, a type from its content, and digests of block and payload. Of
records with equal payloads of at least ``LEAST_REVISIT`` bytes, that with the
smallest page id stays a response; the others become revisits of it that hold
the HTTP header only.

Archives are files of about ``ARCHIVE_BYTES`` of content, one compressed member
a record, in a folder that all executors share. A task writes under a name of
its own and then renames, so a lost or repeated task leaves whole archives only.
One record at a time is in memory. What is shuffled is an index: a digest and a
place for each record, never a payload.

Defined results: a null html is an empty payload. A null url becomes
``about:blank``. A null page id comes back null and ranks last. Of repeated rows
one is the response. Records cut short and header lines that do not parse are
errors that name the archive.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from typing import IO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.checkpoints import cut

#: Archives that one task converts, where there are more than cores.
TASK_ARCHIVES = 16
ARCHIVE_BYTES = 16 << 20
LEAST_REVISIT = 100
CAPTURED = "20000101000000"
HOST = "0.0.0.0"

# Fixed values of the formats: the fields of a header line, by version.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code",
        "Checksum", "Location", "Offset", "Filename", "Archive-length",
    ),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

MANIFEST = "path string, records long"
INDEX = "path string, number long, page_id long, payload_bytes long, payload_digest string"
RECORD = (
    "record_id string, record_type string, target_uri string, date string, page_id long, "
    "payload_bytes long, payload_digest string, refers_to_id string"
)


class ArcRecord(NamedTuple):
    """A record's place in its archive, header fields by name, and content."""

    number: int
    fields: dict[str, str]
    content: bytes


# -- ARC --------------------------------------------------------------------


def arc_version_block(name: str, version: int, date: str = CAPTURED) -> bytes:
    """The record that opens an archive."""
    body = f"{version} 0 tidemark\n{' '.join(FIELDS[version])}\n".encode()
    head = {"URL": f"filedesc://{name}", "IP-address": HOST, "Archive-date": date, "Content-type": "text/plain"}
    return arc_header(head, version, len(body)) + body + b"\n"


def arc_header(fields: dict[str, str], version: int, length: int) -> bytes:
    values = {**fields, "Archive-length": str(length)}
    return (" ".join(values.get(f, "-") for f in FIELDS[version]) + "\n").encode()


def read_arc(stream: IO[bytes], name: str) -> Iterator[ArcRecord]:
    """The records of an uncompressed ARC stream, its version block left out."""
    first = _arc_fields(stream.readline(), 1, name)
    version_block = _exactly(stream, _length(first, name), name)
    version = version_block.split(None, 1)[0].decode("latin-1") if version_block.strip() else ""
    if version not in ("1", "2"):
        raise ValueError(f"{name}: ARC version {version!r} is unknown")
    number = 0
    while line := stream.readline():
        if not line.strip():  # between records
            continue
        fields = _arc_fields(line, int(version), name)
        yield ArcRecord(number, fields, _exactly(stream, _length(fields, name), name))
        number += 1


def _arc_fields(line: bytes, version: int, name: str) -> dict[str, str]:
    names = FIELDS[version]
    values = line.decode("utf-8", "surrogateescape").rstrip("\r\n").rsplit(" ", len(names) - 1)
    if len(values) != len(names):
        raise ValueError(f"{name}: header line of {len(values)} fields, version {version} has {len(names)}: {line[:200]!r}")
    return dict(zip(names, values))


def _length(fields: dict[str, str], name: str) -> int:
    if not fields["Archive-length"].isdigit():
        raise ValueError(f"{name}: declared length {fields['Archive-length']!r}")
    return int(fields["Archive-length"])


def _exactly(stream: IO[bytes], n: int, name: str) -> bytes:
    found = stream.read(n)
    if len(found) != n:
        raise ValueError(f"{name}: {len(found)} bytes left of {n} declared")
    return found


def http_parts(content: bytes) -> tuple[bytes, bytes] | None:
    """Header (with its blank line) and payload of an HTTP response; None for other content."""
    if not content.startswith(b"HTTP/"):
        return None
    end = content.find(b"\r\n\r\n")
    return (content, b"") if end < 0 else (content[: end + 4], content[end + 4 :])


def http_value(header: bytes, name: str) -> str | None:
    for line in header.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode("latin-1")
    return None


def _page_id(header: bytes) -> int | None:
    value = http_value(header, "X-Page-Id")
    return None if value is None else int(value)


# -- WARC -------------------------------------------------------------------


def record_id(archive: str, number: int) -> str:
    """A record's identifier, the same whenever its archive is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{number}')}>"


def iso_date(date: str) -> str:
    """A 14-digit date (or the start of one) as WARC writes it."""
    if not date.isdigit() or not 4 <= len(date) <= 14:
        raise ValueError(f"ARC date {date!r}")
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]]
    return b"WARC/1.0\r\n" + "".join(lines).encode("utf-8", "surrogateescape") + b"\r\n" + block + b"\r\n\r\n"


def to_warc(record: ArcRecord, archive: str, original: tuple[str, str, str] | None) -> bytes:
    """The WARC record for an ARC record; ``original`` is (id, uri, ARC date) of what it revisits."""
    fields, parts = record.fields, http_parts(record.content)
    headers = [
        ("WARC-Type", "resource" if parts is None else "response" if original is None else "revisit"),
        ("WARC-Record-ID", record_id(archive, record.number)),
        ("WARC-Date", iso_date(fields["Archive-date"])),
        ("WARC-Target-URI", fields["URL"]),
    ]
    if fields["IP-address"] not in ("-", HOST):
        headers.append(("WARC-IP-Address", fields["IP-address"]))
    if parts is None:
        block, payload, kind = record.content, record.content, fields["Content-type"]
    else:
        block, payload, kind = record.content, parts[1], "application/http; msgtype=response"
    headers += [("Content-Type", kind), ("WARC-Payload-Digest", f"sha256:{_sha256(payload)}")]
    if original is not None and parts is not None:
        block = parts[0]
        headers += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", original[0]),
            ("WARC-Refers-To-Target-URI", original[1]),
            ("WARC-Refers-To-Date", iso_date(original[2])),
        ]
    headers.append(("WARC-Block-Digest", f"sha256:{_sha256(block)}"))
    return warc_record(headers, block)


def read_warc(stream: IO[bytes], name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: {line[:100]!r} where a record should begin")
        headers = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            headers[key] = value.strip()
        yield headers, _exactly(stream, int(headers["Content-Length"]), name)


# -- Spark ------------------------------------------------------------------


class _Archive:
    """An archive being written: members go to a name of this attempt's own until it is closed."""

    def __init__(self, folder: str, name: str) -> None:
        self.system, root = FileSystem.from_uri(folder)
        attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
        self.path, self.draft = f"{folder}/{name}", f"{root}/_{name}.{attempt}"
        self.final = f"{root}/{name}"
        self.system.create_dir(root, recursive=True)
        self.sink = self.system.open_output_stream(self.draft, compression=None)
        self.size, self.records = 0, 0

    def add(self, record: bytes, counts: bool = True) -> None:
        self.sink.write(gzip.compress(record, 1, mtime=0))
        self.size += len(record)
        self.records += counts

    def close(self) -> tuple[str, int]:
        self.sink.close()
        self.system.move(self.draft, self.final)
        return self.path, self.records


def _opened(path: str) -> IO[bytes]:
    system, place = FileSystem.from_uri(path)
    return gzip.GzipFile(fileobj=system.open_input_stream(place, compression=None))


def write_arc(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as ARC files; (path, records) of each.

    Tasks write either version in turn.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        version, archive, n = 1 + task % 2, None, 0
        for batch in batches:
            for page, url, html in zip(*(batch.column(i) for i in range(3))):
                payload = html.as_py() or b""
                page_header = f"X-Page-Id: {page}\r\n" if page.is_valid else ""
                content = (
                    f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"Content-Length: {len(payload)}\r\n{page_header}\r\n"
                ).encode() + payload
                if archive is None:
                    name = f"part-{task:05}-{n:05}.arc.gz"
                    archive, n = _Archive(folder, name), n + 1
                    archive.add(arc_version_block(name, version), counts=False)
                fields = {
                    "URL": quote(url.as_py() or "about:blank", safe=":/?#[]@!$&'()*+,;=%-._~"), "IP-address": HOST,
                    "Archive-date": CAPTURED, "Content-type": "text/html", "Result-code": "200",
                }
                archive.add(arc_header(fields, version, len(content)) + content + b"\n")
                if archive.size >= archive_bytes:
                    yield _batch([archive.close()], MANIFEST)
                    archive = None
        if archive is not None:
            yield _batch([archive.close()], MANIFEST)

    rows = pages.select("page_id", "url", F.encode("html", "utf-8").alias("html"))
    return cut(rows.mapInArrow(write, MANIFEST))


def find_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the archives in a folder; their content is not read."""
    return spark.read.format("binaryFile").load(folder).select("path")


def index_arc(archives: DataFrame) -> DataFrame:
    """A row of ``INDEX`` for each record of ``archives`` (path)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with _opened(path) as stream:
                    for record in read_arc(stream, path):
                        header, payload = http_parts(record.content) or (b"", record.content)
                        rows.append((path, record.number, _page_id(header), len(payload), _sha256(payload)))
                yield _batch(rows, INDEX)

    return archives.select("path").mapInArrow(index, INDEX)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows of a schema of longs and strings."""
    kinds = {"long": pa.int64(), "string": pa.string()}
    names, types = zip(*[f.split() for f in schema.split(", ")])
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))


def revisits(index: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(path, number, first_path, first_number) of every record that repeats an earlier one's payload."""
    rank = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "path", "number")
    large = index.where(F.col("payload_bytes") >= least)
    first = large.groupBy("payload_digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
    # Many records may share a digest: that side of the join can be split.
    return large.join(first, "payload_digest").select(
        "path", "number", F.col("first.path").alias("first_path"), F.col("first.number").alias("first_number")
    ).where("NOT (path = first_path AND number = first_number)")


def convert(archives: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Convert ARC files (path) to WARC files in ``folder``; (path, records) of each.

    What a file's records revisit is gathered by file, whose size has a bound.
    """
    again = revisits(cut(index_arc(archives)), least).groupBy("path")
    again = again.agg(F.collect_list(F.struct("number", "first_path", "first_number")).alias("again"))
    # Paths weigh little as rows: without a set number, adaptive execution would give them all to one task.
    n, cores = archives.count(), archives.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(n, cores), -(-n // TASK_ARCHIVES), 1)
    jobs = archives.select("path").join(again, "path", "left").repartition(tasks)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, again in zip(*(batch.column(i).to_pylist() for i in range(2))):
                firsts = {r["number"]: (r["first_path"], r["first_number"]) for r in again or ()}
                stem = path.rsplit("/", 1)[1]
                name = stem.removesuffix(".gz").removesuffix(".arc") + ".warc.gz"
                archive = _Archive(folder, name)
                about = warc_record(
                    [
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(stem, -1)), ("WARC-Date", iso_date(CAPTURED)),
                        ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                    ],
                    f"software: tidemark\r\nformat: WARC File Format 1.0\r\nconverted-from: {stem}\r\n".encode(),
                )
                archive.add(about, counts=False)
                with _opened(path) as stream:
                    for record in read_arc(stream, path):
                        first = firsts.get(record.number)
                        original = None
                        if first is not None:
                            # Equal payloads were captured from one place and time as far as ARC tells.
                            original = record_id(first[0].rsplit("/", 1)[1], first[1]), record.fields["URL"], record.fields["Archive-date"]
                        archive.add(to_warc(record, stem, original))
                yield _batch([archive.close()], MANIFEST)

    return cut(jobs.mapInArrow(write, MANIFEST))


def read_records(archives: DataFrame) -> DataFrame:
    """A row of ``RECORD`` for each record of WARC files (path); a response whose digest is false is an error."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with _opened(path) as stream:
                    for headers, block in read_warc(stream, path):
                        if headers["WARC-Type"] != "warcinfo":
                            rows.append(_described(headers, block, path))
                yield _batch(rows, RECORD)

    return archives.select("path").mapInArrow(read, RECORD)


def _described(headers: dict[str, str], block: bytes, path: str) -> tuple:
    head, payload = http_parts(block) or (b"", block)
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size = len(payload)
    if headers["WARC-Type"] == "revisit":
        size = int(http_value(head, "Content-Length"))
    elif _sha256(payload) != digest:
        raise ValueError(f"{path}: payload of {headers['WARC-Record-ID']} does not match its digest")
    return (
        headers["WARC-Record-ID"], headers["WARC-Type"], headers["WARC-Target-URI"], headers["WARC-Date"],
        _page_id(head), size, digest, headers.get("WARC-Refers-To"),
    )


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with refers_to: the page id of the record a revisit names.

    Archives are read once: what is told of their records is kept for the join.
    """
    records = cut(records)
    named = records.where("refers_to_id IS NOT NULL").select("refers_to_id").distinct()
    named = named.join(records.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")), "refers_to_id")
    return records.join(named, "refers_to_id", "left")
