"""Readers and writers."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import Tables, query
from tidemark.functions.keys import md5_key
from tidemark.operators.columns import align_schema
from tidemark.operators.joins import lookup_join, new_periods
from tidemark.schemas import record
from tidemark.session import scratch_dir
from tidemark.sources import archives, delimited, documents, envelopes, lookups, tables

LONG, INT, DOUBLE, TEXT, TIME = (
    T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampType()
)
SUPPLIER_RECORD = record(s_suppkey=LONG, s_name=TEXT, s_nationkey=INT, s_acctbal=DOUBLE)


@query("json_envelope_read", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def json_envelope_read(t: Tables):
    path = scratch_dir(t.spark, "responses")
    envelopes.wrap(t.supplier).write.text(path)
    landing = envelopes.land_envelopes(t.spark, path, scratch_dir(t.spark, "landed"), multi_line=False)
    return align_schema(envelopes.landed_records(landing, SUPPLIER_RECORD.names), SUPPLIER_RECORD)


@query(
    "quoted_delimited_read",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS part_key,
           p_name || ', "' || p_type || '"' AS part_name,
           p_brand || '|' || p_size AS brand_note
    FROM part
    """,
)
def quoted_delimited_read(t: Tables):
    fields = [
        F.col("p_partkey").cast("string"),
        F.concat("p_name", F.lit(', "'), "p_type", F.lit('"')),
        F.concat("p_brand", F.lit("|"), "p_size"),
    ]
    quoted = [F.concat(F.lit('"'), F.replace(f, F.lit('"'), F.lit('""')), F.lit('"')) for f in fields]
    lines = t.part.select(F.concat_ws(",", *quoted).alias("line"))
    return delimited.parse_delimited(lines, "line", '"PartKey","PartName","BrandNote"')


def _zip_each_batch(folder: str):
    """Writes the lines of each batch to an archive in ``folder``; a row for each."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            name = f"{uuid.uuid4().hex}.zip"
            with archives.opened(f"{folder}/{name}", "wb") as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("quarter/ORDERS.txt", "\r\n".join(["ORDER_KEY,PRIORITY", *batch["line"]]))
                archive.writestr("quarter/Notes.txt", "not wanted\r\n")
            yield pd.DataFrame({"path": [name]})

    return write


@query(
    "archive_member_read",
    "SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderpriority AS priority FROM orders",
)
def archive_member_read(t: Tables):
    lines = t.orders.select(
        F.format_string('"%s","%s"', F.col("o_orderkey").cast("string"), "o_orderpriority").alias("line")
    )
    folder, landed = scratch_dir(t.spark, "archives"), scratch_dir(t.spark, "members")
    lines.mapInPandas(_zip_each_batch(folder), "path string").count()
    archives.land_members(t.spark, f"{folder}/*.zip", ["orders.txt"], landed)
    return archives.landed_records(t.spark, landed, "orders.txt")


@query(
    "encoding_fallback",
    """
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, lines[i] AS text
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
         UNNEST(range(1, len(lines) + 1)) AS u(i)
    """,
)
def encoding_fallback(t: Tables):
    latin = F.col("text").rlike(r"^[\x00-\xFF]*$")
    # Settled once per document: beside the explode it would be settled per line.
    known = t.documents.select("doc_id", "text", latin.alias("latin"))
    lines = known.select(
        "doc_id", "latin", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    as_bytes = F.when(F.col("latin"), F.encode("line", "ISO-8859-1")).otherwise(
        F.encode("line", "UTF-8")
    )
    files = lines.select("doc_id", "line_no", as_bytes.alias("bytes"))
    return archives.decode_with_fallback(files, "bytes", ["doc_id"])


def _crawled(t: Tables):
    return t.pages.select(
        "url",
        F.col("html").alias("body"),
        F.struct(F.concat(F.lit("project-"), F.col("page_id") % 7).alias("project_link")).alias("meta"),
    )


@query(
    "gz_json_document_read",
    """
    SELECT url, md5(html) AS body_md5, 'project-' || (page_id % 7) AS project_link FROM pages
    """,
)
def gz_json_document_read(t: Tables):
    path = scratch_dir(t.spark, "gz-documents")
    _crawled(t).write.option("compression", "gzip").json(path)
    read = documents.read_documents(t.spark, path, multi_line=False)
    return read.select("url", F.md5("body").alias("body_md5"), "meta.project_link")


@query(
    "prefix_scan",
    "SELECT url, CAST(length(html) AS INTEGER) AS n_chars, page_id % 3 AS prefix FROM pages",
)
def prefix_scan(t: Tables):
    root = scratch_dir(t.spark, "prefixes")
    (
        t.pages.select("url", F.col("html").alias("body"), (F.col("page_id") % 3).alias("prefix"))
        .write.partitionBy("prefix")
        .option("compression", "gzip")
        .json(root)
    )
    read = documents.read_documents(t.spark, f"{root}/prefix=*/*.json.gz", multi_line=False)
    prefix = F.regexp_extract("source_path", r"prefix=(\d+)/", 1).cast("bigint")
    return read.select("url", F.length("body").alias("n_chars"), prefix.alias("prefix"))


@query(
    "schema_align",
    """
    SELECT s_suppkey AS supplier_id, s_name AS name, CAST(s_acctbal AS DOUBLE) AS balance,
           CAST(NULL AS VARCHAR) AS phone
    FROM supplier
    """,
)
def schema_align(t: Tables):
    upper = t.supplier.select(
        F.col("s_suppkey").alias("ID"),
        F.col("s_name").alias("NAME"),
        F.col("s_acctbal").alias("BALANCE"),
        F.col("s_nationkey").alias("UNUSED"),
    )
    schema = record(
        row_id=LONG, supplier_id=LONG, name=TEXT, balance=DOUBLE, phone=TEXT, scraped_at=TIME
    )
    return align_schema(
        upper, schema, rename={"id": "supplier_id"}, generated=["row_id", "scraped_at"]
    )


@query(
    "append_load",
    """
    SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders
    """,
)
def append_load(t: Tables):
    path = scratch_dir(t.spark, "append")
    orders = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("order_year")
    )
    final = F.col("o_orderstatus") == "F"
    for part in (orders.filter(final), orders.filter(~final)):
        tables.append_load(part.drop("o_orderstatus"), path, ["order_year"])
    return t.spark.read.parquet(path)


@query(
    "lineage_stamp",
    """
    SELECT url, 'job' || (page_id % 5) AS job_id, '2024-01-02 03:04:05' AS scraped_at FROM pages
    """,
)
def lineage_stamp(t: Tables):
    key = F.concat(F.lit("landing/repos/job"), F.col("page_id") % 5, F.lit("/"), "page_id", F.lit(".json.gz"))
    keyed = t.pages.select("url", key.alias("source_path"))
    now = F.lit("2024-01-02 03:04:05").cast("timestamp")
    return documents.stamp_lineage(keyed, now=now).drop("source_path")


@query("full_refresh_write", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def full_refresh_write(t: Tables):
    path = scratch_dir(t.spark, "refresh")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    tables.full_refresh(orders, path)
    tables.full_refresh(orders.filter(F.col("o_orderstatus") != "P"), path)
    tables.publish_view(t.spark.read.parquet(path), "refreshed_orders")
    return t.spark.sql("SELECT o_orderkey, o_orderstatus FROM refreshed_orders")


# Fixed values, written out apart from the library's own: every state's code and name.
_STATES = """
    AL Alabama, AK Alaska, AZ Arizona, AR Arkansas, CA California, CO Colorado, CT Connecticut, DE Delaware,
    DC District of Columbia, FL Florida, GA Georgia, HI Hawaii, ID Idaho, IL Illinois, IN Indiana, IA Iowa, KS Kansas,
    KY Kentucky, LA Louisiana, ME Maine, MD Maryland, MA Massachusetts, MI Michigan, MN Minnesota, MS Mississippi,
    MO Missouri, MT Montana, NE Nebraska, NV Nevada, NH New Hampshire, NJ New Jersey, NM New Mexico, NY New York,
    NC North Carolina, ND North Dakota, OH Ohio, OK Oklahoma, OR Oregon, PA Pennsylvania, RI Rhode Island,
    SC South Carolina, SD South Dakota, TN Tennessee, TX Texas, UT Utah, VT Vermont, VA Virginia, WA Washington,
    WV West Virginia, WI Wisconsin, WY Wyoming
"""
_NAMED = [state.split(maxsplit=1) for state in _STATES.split(",")]
_CODES = ", ".join(f"'{code}'" for code, _ in _NAMED)
_PAIRS = ", ".join(f"('{name.strip()}', '{code}')" for code, name in _NAMED)


@query(
    "lookup_dimension",
    f"""
    SELECT c.c_custkey, c.state_code, s.state
    FROM (SELECT c_custkey, [{_CODES}][c_custkey % 51 + 1] AS state_code FROM customer) c
    LEFT JOIN (VALUES {_PAIRS}) s(state, alpha2) ON s.alpha2 = c.state_code
    """,
)
def lookup_dimension(t: Tables):
    codes = F.array(*[F.lit(code) for code, _ in _NAMED])
    placed = t.customer.select(
        "c_custkey", F.get(codes, (F.col("c_custkey") % 51).cast("int")).alias("state_code")
    )
    return lookup_join(placed, lookups.states(t.spark), "state_code", "alpha2", {"state": "state"})


@query(
    "period_filtered_scan",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderdate >= DATE '1997-07-01' AND o_orderdate < DATE '1997-10-01'
    """,
)
def period_filtered_scan(t: Tables):
    quarter = envelopes.for_quarter(t.orders, "o_orderdate", date(1997, 9, 30))
    return quarter.select("o_orderkey", "o_custkey")


@query("paged_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def paged_scan(t: Tables):
    path = scratch_dir(t.spark, "pages")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    # A page of the request is one response; each declares how many records all of them have.
    record_ = F.struct(F.struct("*").alias("data"))
    pages = orders.groupBy(F.expr("o_orderkey div 10000").alias("page")).agg(F.collect_list(record_).alias("data"))
    meta = F.struct(orders.agg(F.count("*")).scalar().alias("total")).alias("meta")
    pages.select(F.to_json(F.struct(meta, "data")).alias("body")).write.text(path)
    landing = envelopes.land_envelopes(t.spark, path, scratch_dir(t.spark, "landed"), multi_line=False)
    envelopes.require_complete(landing)
    return align_schema(envelopes.landed_records(landing, orders.columns), orders.schema)


@query(
    "new_period_gate",
    """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS n_orders
    FROM orders o
    WHERE NOT EXISTS (
        SELECT 1 FROM lineitem l
        WHERE l.l_shipdate < DATE '1998-01-01'
          AND strftime(l.l_shipdate, '%Y-%m') = strftime(o.o_orderdate, '%Y-%m'))
    GROUP BY 1
    """,
)
def new_period_gate(t: Tables):
    # Lines of 1998 are not loaded yet: without new months the gate would have nothing to let in.
    incoming = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    loaded = t.lineitem.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    loaded = loaded.select(F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    fresh = new_periods(incoming, loaded, "month")
    return fresh.groupBy("month").agg(F.count("*").alias("n_orders"))


@query(
    "write_audit_publish",
    """
    SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || o_orderstatus) AS dim_id FROM orders
    """,
)
def write_audit_publish(t: Tables):
    keyed = t.orders.select("o_orderkey", md5_key(["o_orderkey", "o_orderstatus"]).alias("dim_id"))
    root = scratch_dir(t.spark, "publish")
    return tables.write_audit_publish(keyed, "audited_orders", root, temporary=True)
