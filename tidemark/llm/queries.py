"""The numbered queries: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import attention_lm, decontamination, extraction, language_id, legacy_archives, line_dedup, mixing, quality_cnn, quality_rules, simhash, spelling, transcripts, vector_codes
from tidemark.session import scratch_dir
from tidemark.sources.files import delete_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_quality_rules")
def quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    ratio = quality_rules.model(docs, table(spark, folder, "labels"))
    return quality_rules.score(docs, ratio)


@query("op2_language_id")
def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_id.predict(docs, language_id.train(docs.where(~language_id.held_out())))


@query("op3_quality_classifier")
def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_cnn.predict(docs, quality_cnn.train(docs, table(spark, folder, "labels")))


@query("op4_chat_formatting")
def chats(spark: SparkSession, folder: str) -> DataFrame:
    return transcripts.recovered(table(spark, folder, "conversations"))


@query("op5_lm_scoring")
def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return attention_lm.score(table(spark, folder, "documents"))


@query("op6_simhash_near_duplicates")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op7_benchmark_decontamination")
def leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_html_extraction")
def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(table(spark, folder, "pages"))


ARCHIVES_SQL = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
ranked AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM sized)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM ranked
"""


@query("op9_legacy_archives", ARCHIVES_SQL)
def archives(spark: SparkSession, folder: str) -> DataFrame:
    old = scratch_dir(spark, "arc")
    arc = legacy_archives.write_arc(table(spark, folder, "pages"), old)
    warc = legacy_archives.convert(arc, scratch_dir(spark, "warc"))
    delete_folder(spark, old)
    found = legacy_archives.resolved(legacy_archives.read_records(warc))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _mixing_sql() -> str:
    """The same sums and draws, round by round."""
    m = mixing
    rounds = []
    for r in range(m.ROUNDS):
        primes = ", ".join(f"CASE WHEN blocks % {p} <> 0 THEN {p} END" for p in m.MULTIPLIERS[r:] + m.MULTIPLIERS[:r])
        before = "slots" if r == 0 else f"r{r - 1}"
        rounds += [
            f"a{r} AS (SELECT *, coalesce({primes}) AS a, (number * 1000003 + epoch * 7919 + {r} * 104729) % 2147483647 * 48271 % 2147483647 AS b FROM {before})",
            f"b{r} AS (SELECT *, (a * x + b) % blocks AS y FROM a{r})",
            f"c{r} AS (SELECT *, ((b * 69621 % 2147483647 * 2147483648 + b - y) % blocks + blocks) % blocks AS z FROM b{r})",
            f"r{r} AS (SELECT number, blocks, epoch, CASE WHEN "
            f"(greatest(y, z) % 2147483647 * 48271 + b) % 2147483647 * 69621 % 2147483647 // 65536 % 2 = 1 "
            f"THEN z ELSE y END AS x FROM c{r})",
        ]
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         row_number() OVER () AS row_id
  FROM documents),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(row_number() OVER (ORDER BY source NULLS LAST) AS BIGINT) AS number
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2 * source_size AS cap, CASE (number - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sums),
levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT CAST(sum(source_size) AS BIGINT) FROM sums)
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER (ORDER BY cap / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed),
goals AS (
  SELECT *, least(cap::DOUBLE, coalesce((SELECT level FROM levels WHERE cap > level * weight ORDER BY cap / weight, number LIMIT 1) * weight, cap::DOUBLE)) AS target,
         (source_size + {m.BLOCK - 1}) // {m.BLOCK} AS blocks
  FROM levels),
sources AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target * blocks / source_size) AS BIGINT) ELSE 0 END AS n_slots FROM goals),
numbered AS (SELECT number, blocks, CAST(unnest(range(n_slots)) AS BIGINT) AS slot FROM sources WHERE n_slots > 0),
slots AS (SELECT number, blocks, slot // blocks AS epoch, slot % blocks AS x FROM numbered),
{", ".join(rounds)},
times AS (SELECT number, x AS block, count(*) AS times FROM r{m.ROUNDS - 1} GROUP BY ALL),
placed AS (
  SELECT s.*, g.number, g.source_size, g.target,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY g.number ORDER BY s.doc_id, s.size, s.row_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN sources g ON s.source IS NOT DISTINCT FROM g.source),
pieces AS (
  SELECT *, CAST(unnest(range(start // {m.BLOCK}, (start + size - 1) // {m.BLOCK} + 1)) AS BIGINT) AS block FROM placed WHERE size > 0),
taken AS (
  SELECT p.row_id, CAST(sum((least(p.start + p.size, (p.block + 1) * {m.BLOCK}) - greatest(p.start, p.block * {m.BLOCK})) * coalesce(t.times, 0)) AS BIGINT) AS taken
  FROM pieces p LEFT JOIN times t ON p.number = t.number AND p.block = t.block GROUP BY p.row_id)
SELECT doc_id, source, size, source_size, target, coalesce(taken, 0) AS taken FROM placed LEFT JOIN taken USING (row_id)
"""


@query("op10_mixing_to_target_weights", _mixing_sql())
def mixing_to_weights(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query("op11_spelling_variants")
def spellings(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, folder, "documents")))


LINES_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT row_id, doc_id, CAST(unnest(range(len(lines))) AS BIGINT) AS place, unnest(lines) AS line FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
common AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= {line_dedup.LEAST_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.LEAST_DOCS}),
marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.owner AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_id
"""


@query("op12_line_dedup", LINES_SQL)
def lines(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.drop_common_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _codes_sql() -> str:
    """Every round's assignment against all entries, then its floors of means."""
    v = vector_codes
    steps = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (
  SELECT row_id, part, list_slice(v, part * len(v) // {v.PARTS} + 1, (part + 1) * len(v) // {v.PARTS}) AS p
  FROM kept, (SELECT unnest(range({v.PARTS})) AS part)),
first AS (SELECT row_id, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM kept),
book0 AS MATERIALIZED (SELECT part, entry, p AS c FROM parts JOIN first USING (row_id) WHERE entry < {v.ENTRIES})""",
    ]
    nearest = """near{r} AS MATERIALIZED (
  SELECT row_id, part, any_value(p) AS p, min({{'d': d, 'entry': entry}}) AS best
  FROM (SELECT row_id, s.part, p, entry, list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts s JOIN book{r} b ON s.part = b.part) GROUP BY row_id, part)"""
    mean = """mean{r} AS (
  SELECT part, entry, list(m ORDER BY i) AS c
  FROM (SELECT part, entry, i,
               CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
        FROM (SELECT part, best.entry AS entry, unnest(range(len(p))) AS i, unnest(p) AS x FROM near{r})
        GROUP BY part, entry, i) GROUP BY part, entry),
book{n} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m ON b.part = m.part AND b.entry = m.entry)"""
    for r in range(v.ROUNDS):
        steps += [nearest.format(r=r), mean.format(r=r, n=r + 1)]
    steps.append(nearest.format(r=v.ROUNDS))
    return f"""
WITH {", ".join(steps)},
coded AS (
  SELECT row_id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{v.ROUNDS} GROUP BY row_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book{v.ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (row_id)
"""


@query("op13_vector_codes", _codes_sql())
def vector_code(spark: SparkSession, folder: str) -> DataFrame:
    found, books = vector_codes.compress(table(spark, folder, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))
