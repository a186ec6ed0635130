"""Quality rules: base rules, then a hashed n-gram likelihood ratio.

Two multinomials over hashed word unigrams and bigrams are counted, one over
the trusted documents and one over the whole corpus. A document's score is the
mean, over all of its n-grams, of log(trusted share / corpus share); it is kept
if the score is at least a threshold. Nothing is drawn at random. Both shares
lean on ``PRIOR`` n-grams spread as in the corpus, so that an n-gram too rare to
tell counts for neither side, whatever the size of the trusted set.

Trusted documents are those whose labels all say quality 1. Counts cover every
document. A table of ``n_buckets`` numbers is all that reaches the driver or is
sent to the executors, whatever the corpus holds.

Defined results: a null text has no words and fails the base rules; so does an
empty one. Without any trusted document the ratio says nothing, and the base
rules decide alone. Repeated rows are scored alike and counted as often as they
stand there. Labels for unknown documents, or for a null id, are ignored.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text_bytes import Chunk, IN_WORD, chunks, combine, prefix_hash, span_hash, spans, words

N_BUCKETS = 1 << 16
PRIOR = 10.0
#: Natural-log units for an n-gram. Prose as in the corpus at large lies near 0.
THRESHOLD = -0.12
MIN_WORDS = 50
MOST_REPEATED_PCT = 50
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True

RULES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, llr double"
)


def ngram_buckets(hashes: np.ndarray, text: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every word unigram, then of every bigram within a text."""
    size = np.uint64(n_buckets)
    pair = np.flatnonzero(text[1:] == text[:-1])
    both = combine(hashes[pair], hashes[pair + 1])
    return np.concatenate([hashes % size, both % size]).astype(np.int64), np.concatenate([text, text[pair]])


def _word_hashes(chunk: Chunk):
    starts, ends, text = words(chunk)
    prefix = prefix_hash(chunk.data)
    return span_hash(prefix, starts, ends), starts, ends, text, prefix


def ngram_counts(docs: DataFrame, trusted: DataFrame, n_buckets: int = N_BUCKETS) -> DataFrame:
    """(bucket, trusted_n, corpus_n) over all of ``docs`` (doc_id, text).

    ``trusted`` (doc_id) must be unique. A document joins its flag by id; only
    the document side can be hot, and that side can be split. The join is dealt
    by hash at every size: trusted ids grow with the corpus, so they are never
    broadcast.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, target = np.zeros(n_buckets, np.int64), np.zeros(n_buckets, np.int64)
        for batch in batches:
            flags = np.asarray(batch.column(1))
            for chunk in chunks(batch.column(0)):
                hashes, _, _, text, _ = _word_hashes(chunk)
                bucket, owner = ngram_buckets(hashes, text, n_buckets)
                corpus += np.bincount(bucket, minlength=n_buckets)
                target += np.bincount(bucket[flags[chunk.first : chunk.last][owner]], minlength=n_buckets)
        seen = np.flatnonzero(corpus)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(target[seen]), pa.array(corpus[seen])],
            ["bucket", "trusted_n", "corpus_n"],
        )

    flagged = docs.select(F.col("doc_id").alias("id"), "text").join(
        trusted.select(F.col("doc_id").alias("id"), F.lit(True).alias("is_trusted")).hint("shuffle_hash"), "id", "left"
    )
    flagged = flagged.select("text", F.coalesce("is_trusted", F.lit(False)).alias("is_trusted"))
    parts = flagged.mapInArrow(count, "bucket int, trusted_n long, corpus_n long")
    return parts.groupBy("bucket").agg(F.sum("trusted_n").alias("trusted_n"), F.sum("corpus_n").alias("corpus_n"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say quality 1."""
    votes = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"))
    return votes.where("q = 1").select("doc_id")


def log_ratio(counts: DataFrame, n_buckets: int = N_BUCKETS) -> np.ndarray | None:
    """log(trusted share / corpus share) of every bucket, leaning on the prior.

    None without trusted n-grams. The table brought here has ``n_buckets`` rows.
    """
    target, corpus = np.zeros(n_buckets), np.zeros(n_buckets)
    for bucket, a, b in counts.collect():
        target[bucket], corpus[bucket] = a, b
    if not target.any():
        return None
    expected = corpus * (target.sum() / corpus.sum())
    return np.log((target + PRIOR) / (expected + PRIOR))


def measure(
    column: pa.Array, ratio: np.ndarray | None, n_buckets: int = N_BUCKETS, threshold: float = THRESHOLD
) -> dict[str, np.ndarray]:
    """The columns of ``RULES`` for one Arrow column of texts."""
    parts = [_measure_chunk(chunk, ratio, n_buckets, threshold) for chunk in chunks(column)]
    names = [field.split()[0] for field in RULES.split(", ")]
    kinds = {"base_failed": bool, "kept": bool, "llr": float}
    return {n: np.concatenate([p[n] for p in parts]) if parts else np.zeros(0, kinds.get(n, np.int64)) for n in names}


def _measure_chunk(chunk: Chunk, ratio, n_buckets: int, threshold: float) -> dict[str, np.ndarray]:
    n = chunk.last - chunk.first
    data, offsets = chunk.data, chunk.offsets
    hashes, starts, ends, text, prefix = _word_hashes(chunk)

    def total(flags: np.ndarray) -> np.ndarray:
        running = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=running[1:])
        return running[offsets[1:]] - running[offsets[:-1]]

    n_words = np.bincount(text, minlength=n)
    out = {
        "n_words": n_words,
        # A code point is counted at its first byte.
        "word_chars": total(IN_WORD[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": total(_IS_SYMBOL[data]),
        "n_dup_lines": _dup_lines(chunk, prefix, starts),
        "n_repeat_words": _repeat_words(hashes, text, n),
    }
    out["base_failed"] = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEATED_PCT * n_words)
    if ratio is None:
        out["llr"] = np.zeros(n)
        out["kept"] = ~out["base_failed"]
    else:
        bucket, owner = ngram_buckets(hashes, text, n_buckets)
        grams = np.bincount(owner, minlength=n)
        out["llr"] = np.bincount(owner, ratio[bucket], n) / np.maximum(grams, 1)
        out["kept"] = ~out["base_failed"] & (out["llr"] >= threshold)
    return out


def _dup_lines(chunk: Chunk, prefix: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    n = chunk.last - chunk.first
    starts, ends, text = spans(chunk.data != 10, chunk.offsets)
    has_word = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends, text = starts[has_word], ends[has_word], text[has_word]
    key = combine(span_hash(prefix, starts, ends), text.astype(np.uint64))
    first = np.unique(key, return_index=True)[1]
    return np.bincount(text, minlength=n) - np.bincount(text[first], minlength=n)


def _repeat_words(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Words of each text that stand in a 3-word window found there twice or more."""
    if len(hashes) < 3:
        return np.zeros(n, np.int64)
    at = np.flatnonzero(text[2:] == text[:-2])
    key = combine(hashes[at], hashes[at + 1], hashes[at + 2], text[at].astype(np.uint64))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for shift in range(3):
        covered[at[again] + shift] = True
    return np.bincount(text[covered], minlength=n)


def model(docs: DataFrame, labels: DataFrame, n_buckets: int = N_BUCKETS) -> np.ndarray | None:
    """The log ratios of a corpus, counted over all of it."""
    return log_ratio(ngram_counts(docs, trusted_ids(labels), n_buckets), n_buckets)


def score(
    docs: DataFrame, ratio: np.ndarray | None, n_buckets: int = N_BUCKETS, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs``: doc_id and the columns of ``RULES``."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(batch.column(1), ratio, n_buckets, threshold)
            arrays = [batch.column(0), *(pa.array(v) for v in found.values())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *found])

    return docs.select("doc_id", "text").mapInArrow(measured, f"doc_id long, {RULES}")


def keep(
    docs: DataFrame, ratio: np.ndarray | None, n_buckets: int = N_BUCKETS, threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are."""
    at = docs.columns.index("text")

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(measure(batch.column(at), ratio, n_buckets, threshold)["kept"]))

    return docs.mapInArrow(passing, docs.schema)
