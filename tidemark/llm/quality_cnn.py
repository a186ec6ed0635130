"""Quality classifier: a convolutional network over the bytes of whole documents, in numpy.

A document's bytes are cut into overlapping chunks of ``CHUNK`` that cover it
from end to end. Bytes are embedded, learned filters slide over each chunk, and
the largest response of each filter in a chunk is kept. The mean of these over
the chunks goes through a hidden layer into one probability.

Training uses at most ``SAMPLE`` labelled documents of each class, those whose
ids hash lowest, and of each at most ``TRAIN_CHUNKS`` chunks spread evenly over
it: a bound on what reaches the driver. Both classes weigh alike in training;
their shares among all labelled rows are put back in the last bias. Scoring
reads every chunk. The same rows give the same model.

Defined results: null and empty texts are one empty chunk and get its score.
Ids with labels of both kinds, and null labels or ids, teach nothing. With one
class only, every score is 1 or 0 after it; without labels, 0.5. Repeated rows
get equal scores.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.text_bytes import chunks

CHUNK = 256
OVERLAP = 64
WIDTH = 6
EMBEDDING = 4
FILTERS = 16
HIDDEN = 12
SAMPLE = 800
TRAIN_CHUNKS = 12
EPOCHS = 12
RATE = 0.01
CUT = 0.3
SEED = 7
#: Chunks taken through the network at a time.
BLOCK = 256

_PAD = 256


class Network(NamedTuple):
    embedding: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Documents whose labels never teach: crc32 of the id as text is 0 modulo 5. A null id is not among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def chunk_starts(size: int) -> np.ndarray:
    """Where the chunks of a document of ``size`` bytes begin."""
    return np.arange(0, max(size - OVERLAP, 1), CHUNK - OVERLAP)


def chunk_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Chunks as rows of byte numbers; what lies beyond a document's end is padding."""
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    out = np.full(at.shape, _PAD, np.int16)
    out[inside] = data[at[inside]]
    return out


def _responses(net: Network, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter in each chunk, and where it stands."""
    embedded = net.embedding[rows].reshape(len(rows), -1)
    windows = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * EMBEDDING, axis=1)[:, ::EMBEDDING]
    found = np.ascontiguousarray(windows).reshape(-1, WIDTH * EMBEDDING) @ net.filters
    found = found.reshape(len(rows), -1, FILTERS)
    place = found.argmax(1)
    return np.maximum(np.take_along_axis(found, place[:, None], 1)[:, 0] + net.filter_bias, 0), place


def _top(net: Network, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(pooled @ net.hidden + net.hidden_bias)
    return hidden, hidden @ net.out + net.out_bias[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Train on documents, each an array of chunk rows; Adam on the logistic loss."""
    rng = np.random.default_rng(seed)
    shapes = ((257, EMBEDDING), (WIDTH * EMBEDDING, FILTERS), (FILTERS,), (FILTERS, HIDDEN), (HIDDEN,), (HIDDEN,), (1,))
    scales = (0.5, (WIDTH * EMBEDDING) ** -0.5, 0.0, FILTERS**-0.5, 0.0, HIDDEN**-0.5, 0.0)
    net = Network(*[(rng.normal(size=s) * k).astype(np.float32) for s, k in zip(shapes, scales)])
    net.embedding[_PAD] = 0
    first, second, step = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net], 0
    weight = 0.5 / np.array([max((labels == k).mean(), 1e-9) for k in (0, 1)])
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(docs)), max(len(docs) // 32, 1)):
            grads = _gradients(net, [docs[i] for i in batch], labels[batch], weight)
            step += 1
            for p, g, m, v in zip(net, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.embedding[_PAD] = 0
    return net


def _gradients(net: Network, docs: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    rows = np.concatenate(docs)
    sizes = np.array([len(d) for d in docs])
    owner = np.repeat(np.arange(len(docs)), sizes)
    peaks, place = _responses(net, rows)
    pooled = np.add.reduceat(peaks, np.cumsum(sizes) - sizes) / sizes[:, None]
    hidden, logit = _top(net, pooled)
    d_logit = ((_sigmoid(logit) - labels) * weight[labels] / len(docs)).astype(np.float32)
    d_hidden = np.outer(d_logit, net.out) * (1 - hidden**2)
    d_peaks = ((d_hidden @ net.hidden.T) / sizes[:, None])[owner] * (peaks > 0)
    # Only the window at each filter's peak takes part in its gradient.
    at = place[:, :, None] + np.arange(WIDTH)
    own = rows[np.arange(len(rows))[:, None, None], at]
    window = net.embedding[own].reshape(len(rows), FILTERS, -1)
    d_filters = np.einsum("cfk,cf->kf", window, d_peaks)
    d_window = (d_peaks[:, :, None] * net.filters.T[None]).reshape(-1, EMBEDDING)
    d_embedding = np.stack([np.bincount(own.ravel(), d_window[:, e], 257) for e in range(EMBEDDING)], 1)
    return [
        d_embedding.astype(np.float32), d_filters, d_peaks.sum(0), pooled.T @ d_hidden,
        d_hidden.sum(0), hidden.T @ d_logit, d_logit.sum(keepdims=True),
    ]


def scores(net: Network, column: pa.Array) -> np.ndarray:
    """Probability of label 1 for every text of a column."""
    out = np.zeros(len(column))
    for part in chunks(column):
        starts = [chunk_starts(int(n)) + at for at, n in zip(part.offsets[:-1], np.diff(part.offsets))]
        sizes = np.array([len(s) for s in starts])
        ends = np.repeat(part.offsets[1:], sizes)
        starts = np.concatenate(starts)
        peaks = [
            _responses(net, chunk_bytes(part.data, starts[i : i + BLOCK], ends[i : i + BLOCK]))[0]
            for i in range(0, len(starts), BLOCK)
        ]
        pooled = np.add.reduceat(np.concatenate(peaks), np.cumsum(sizes) - sizes) / sizes[:, None]
        out[part.first : part.last] = _sigmoid(_top(net, pooled)[1])
    return out


def training_chunks(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(quality, chunks: binary) of at most ``sample`` documents of each class.

    ``labels`` must hold no row that may not teach. The ids that join the
    documents are at most two samples, so they are broadcast.
    """
    votes = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
    votes = votes.agg(F.min("quality").alias("q"), F.max("quality").alias("most")).where("q = most")
    lowest = [votes.where(F.col("q") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    chosen = lowest[0].union(lowest[1]).select(F.col("doc_id").alias("id"), "q")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for part in chunks(batch.column(1)):
                for at, end in zip(part.offsets[:-1], part.offsets[1:]):
                    starts = chunk_starts(int(end - at)) + at
                    spread = np.unique(np.linspace(0, len(starts) - 1, TRAIN_CHUNKS).astype(np.int64))
                    starts = starts[spread]
                    kept.append(chunk_bytes(part.data, starts, np.full(len(starts), end)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(kept, pa.binary())], ["id", "q", "chunks"])

    rows = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id")
    rows = rows.select("id", "text", F.col("q").cast("int").alias("q")).mapInArrow(cut, "id long, q int, chunks binary")
    # A repeated document teaches once.
    return rows.groupBy("id", "q").agg(F.min("chunks").alias("chunks"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> Network | float:
    """A network, or the score of every text where labels of both kinds are missing."""
    allowed = labels.where(~held_out())
    share = allowed.where("quality IN (0, 1)").agg(F.avg("quality")).first()[0]
    rows = sorted(training_chunks(docs, allowed, sample).collect())
    quality = np.array([r[1] for r in rows], np.int64)
    if share is None or len(set(quality)) < 2:
        return 0.5 if share is None else float(share)
    found = [np.frombuffer(r[2], np.int16).reshape(-1, CHUNK) for r in rows]
    net = fit(found, quality, epochs)
    net.out_bias[0] += np.log(share / (1 - share))
    return net


def predict(docs: DataFrame, model: Network | float) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.full(batch.num_rows, model) if isinstance(model, float) else scores(model, batch.column(2))
            arrays = [batch.column(0), batch.column(1), pa.array(score.astype(float)), pa.array((score >= CUT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(answer, "doc_id long, held_out boolean, score double, predicted int")
