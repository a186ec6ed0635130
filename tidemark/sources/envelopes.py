"""API responses landed as JSON: ``{"meta": ..., "data": [{"data": {...}}]}``."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.sources.json_landing import Landing, land_json

# Spellings of a report period in requests and raw tables.
PERIOD_FORMATS = {"compact": "%Y%m%d", "us": "%m/%d/%Y", "iso": "%Y-%m-%d"}


def envelope_schema(record: T.DataType) -> T.StructType:
    """Schema of a response whose records have the given fields."""
    element = T.StructType([T.StructField("data", record)])
    meta = T.StructType([T.StructField("total", T.LongType())])
    return T.StructType(
        [T.StructField("meta", meta), T.StructField("data", T.ArrayType(element))]
    )


def read_envelopes(
    spark: SparkSession, path: str | list[str], record: T.StructType, multi_line: bool = True
) -> DataFrame:
    """Records of all responses under ``path``; the pages of a request are files.

    Set ``multi_line=False`` for one response per line, which Spark can split. A
    response that does not parse (one cut short, say) is an error.
    """
    reader = spark.read.schema(envelope_schema(record)).option("mode", "FAILFAST").option("multiLine", multi_line)
    return unwrap(reader.json(path), "data")


#: A response whose records have whatever fields they have, as text.
LANDED = envelope_schema(T.MapType(T.StringType(), T.StringType()))


def land_envelopes(
    spark: SparkSession, path: str | list[str], target: str, multi_line: bool = True, limit: int = 0
) -> Landing:
    """Land all responses under ``path``, parsed once; at most ``limit`` may be of no use.

    A response that does not parse, or has no list of records, is a dead letter.
    """
    unfit = F.when(F.col("data").isNull(), "no records")
    return land_json(spark, path, target, LANDED, unfit, multi_line, limit)


def landed_fields(landing: Landing) -> list[str]:
    """Names of all fields that any landed record has; one row per name reaches the driver."""
    found = landing.rows().select(F.explode("data").alias("e"))
    names = found.select(F.explode(F.map_keys("e.data")).alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())


def landed_records(landing: Landing, fields: list[str]) -> DataFrame:
    """The landed records' fields of these names, as text."""
    records = landing.rows().select(F.explode("data").alias("e"))
    return records.select(*[F.col("e.data")[name].alias(name) for name in fields])


def require_complete(landing: Landing) -> None:
    """Raise unless every request's responses hold the number of records they declare.

    The responses of a request are the files of one folder; each repeats the
    request's ``meta.total``. Requests without a total are not judged. Dead
    letters count as no records.
    """
    folder = F.regexp_replace("file", "/[^/]*$", "")
    sizes = landing.rows().select(folder.alias("request"), F.col("meta.total").alias("total"), F.size("data").alias("n"))
    sums = sizes.groupBy("request").agg(F.max("total").alias("declared"), F.sum("n").alias("landed"))
    short = sums.where("declared <> landed").first()
    if short is not None:
        raise ValueError(f"{short['request']}: {short['landed']} records landed of {short['declared']} declared")


def parse_envelopes(df: DataFrame, column: str, record: T.StructType) -> DataFrame:
    """Records of responses held as text in a column."""
    parsed = F.from_json(F.col(column), envelope_schema(record), {"mode": "FAILFAST"})
    return unwrap(df.select(parsed["data"].alias("data")), "data")


def unwrap(responses: DataFrame, column: str) -> DataFrame:
    """One row per element of ``column``, its inner ``data`` object as columns."""
    return responses.select(F.explode(column).alias("element")).select("element.data.*")


def wrap(df: DataFrame, into: str = "body") -> DataFrame:
    """One single-record response per row, as text."""
    data = F.array(F.struct(F.struct("*").alias("data")))
    meta = F.struct(F.lit(1).cast("bigint").alias("total"))
    return df.select(F.to_json(F.struct(meta.alias("meta"), data.alias("data"))).alias(into))


def for_period(df: DataFrame, column: str, period: date, style: str = "compact") -> DataFrame:
    """Rows whose text period is the given one; prunes partitions stored by it."""
    return df.filter(F.col(column) == F.lit(period.strftime(PERIOD_FORMATS[style])))


def for_quarter(df: DataFrame, column: str, quarter_end: date) -> DataFrame:
    """Rows dated within the quarter that ends on ``quarter_end``.

    The bounds are literals of the column's own type, so the scan skips the
    partitions and row groups outside them.
    """
    kind = df.schema[column].dataType
    first = date(quarter_end.year, quarter_end.month - 2, 1)
    after = quarter_end + timedelta(days=1)
    low, high = (F.lit(d.isoformat()).cast(kind) for d in (first, after))
    return df.filter((F.col(column) >= low) & (F.col(column) < high))
