"""Language-model scores: causal self-attention over subword ids, beside a word unigram base.

Text is its words, A-Z lowered, and one end. Each word is spelled in subwords of
a public vocabulary (never trained here); the end is one more id. The model
predicts each id from those before it in the document: embeddings, one layer of
masked attention with learned relative positions, a hidden layer, and a softmax
in two levels: over ``GROUPS`` groups, then over the ``MEMBERS`` classes of the
id's group. The most frequent ids are classes of their own; within a class that
ids share, each has its share of counts.
Documents are cut into blocks of ``STRIDE`` ids. A block's window is the block
and the one before, so windows overlap by half, and each id is scored once, in
the window whose last block it stands in. Scores add up to the log10 probability
of the whole text.

Counts of words and of subwords cover every training document, and the weights
of the network are fitted on every id of every training document. Training goes
in ``ROUNDS``: each task starts from the weights of the round before, learns from
all its documents of the round by Adam, and the weights of all tasks are averaged
by what each has learned from. The rounds share the documents out among them, each
taking more than the one before. Where that leaves a task fewer than
``LEAST_STEPS`` steps, every round takes all documents. Averages depend on how
the table is dealt to tasks, so ``score`` may differ between layouts of it.

The base sums log10((c + 1) / (N + V + 1)) over tokens. The 1 / HEAD_SHARE most
frequent words of the training documents (fewer where the last ones tie) are
broadcast and settle most tokens in place. Among them is every word that makes up
at least ``HEAD_SHARE`` of all training tokens; the others join their counts by
hash, and no key of that join can be hot by its training count.

Defined results: null and empty texts are one end. Without training documents
the counts are zero and every id is equally likely. Rows without an id teach and
are scored. Repeated rows are counted and scored as often as they stand there.
Words are told apart by 64-bit hashes.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.checkpoints import cut
from tidemark.llm.text_bytes import CHUNK_BYTES, Chunk, chunks, prefix_hash, span_hash, words

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer words are spelled in pieces, as merging takes the square of a length.
LONGEST = 256

HEAD_SHARE = 1e-5
STRIDE = 16
WIDTH = 16
HIDDEN = 32
GROUPS = 32
MEMBERS = 32
#: Classes of a single, frequent id, out of GROUPS * MEMBERS.
SINGLES = 1000
#: The rounds of training: from and to which of SLICES slices of a task's documents.
ROUNDS = ((0, 1), (1, 2), (2, 4), (4, 8), (8, 16))
SLICES = 16
#: Passes of ``fit``.
EPOCHS = 5
#: Steps that training takes at least in a task, however few its documents.
LEAST_STEPS = 200
#: Ids a task draws its batches from at a time.
DRAWN = 1 << 21
BATCH = 256
#: Blocks in a row that training takes together.
RUN = 8
RATE = 0.01
SEED = 11
#: Blocks scored at a time.
BLOCKS = 512
#: Words a task remembers the spelling and count of.
HELD = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Documents that never teach: crc32 of the id as text is 2 modulo 7. A null id may teach."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


# -- subwords ---------------------------------------------------------------


class Speller:
    """Subword ids of words, each spelled once while it is remembered."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.size = max(ranks.values()) + 2
        self.end = self.size - 1
        self.encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.begins = np.zeros(self.size, bool)
        self.begins[[i for piece, i in ranks.items() if piece.startswith(b" ")]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pool = np.zeros(1 << 16, np.int32)
        self.starts, self.sizes, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def spell(self, word: bytes) -> list[int]:
        if len(word) <= LONGEST:
            return self.encode(" " + word.decode("utf-8"))
        text = " " + word.decode("utf-8")
        return [i for at in range(0, len(text), LONGEST) for i in self.encode(text[at : at + LONGEST])]

    def places(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Numbers of the words with these hashes (distinct, ascending), in the order in which they were met."""
        if len(self.hashes) > HELD:
            self.forget()
        at = np.searchsorted(self.hashes, hashes)
        near = np.minimum(at, len(self.hashes) - 1)
        held = self.hashes[near] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        found, new = np.zeros(len(hashes), np.int64), np.flatnonzero(~held)
        found[held] = self.number[near[held]]
        if len(new):
            found[new] = np.arange(len(new)) + len(self.hashes)
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.number = np.insert(self.number, at[new], found[new])
            ids, sizes = self._spell_run(*_spaced(data, starts[new], ends[new]))
            if self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.int32)])
            self.pool[self.used : self.used + len(ids)] = ids
            self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.used += len(ids)
        return found

    def spell_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words, end to end, and how many each has."""
        return self._spell_run(b"".join(b" " + word for word in words), np.array([len(word) for word in words]))

    def _spell_run(self, text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``spell_all`` of words of these lengths, each after a space.

        They are spelled as one text: the first id of a word, and no other,
        begins with the space before it.
        """
        if lengths.max() <= LONGEST:
            ids = np.array(self.encode(text.decode("utf-8")), np.int32)
            edges = np.flatnonzero(self.begins[ids])
            if len(edges) == len(lengths):
                return ids, np.diff(edges, append=len(ids))
        each = [self.spell(word) for word in text.split(b" ")[1:]]
        return np.array([i for ids in each for i in ids], np.int32), np.array([len(ids) for ids in each], np.int64)

    def ids(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words by number, end to end, and how many each has."""
        n = self.sizes[found]
        at = np.repeat(self.starts[found] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.pool[at], n


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words at these places of ``data``, each after a space, and their lengths."""
    lengths = ends - starts
    edges = np.cumsum(lengths + 1)
    at = np.repeat(ends - edges, lengths + 1) + np.arange(edges[-1])
    text = data.take(at, mode="clip")
    text[edges - lengths - 1] = 32
    return text.tobytes(), lengths


class Tokens(NamedTuple):
    """Words of a chunk: hash and text of each, its distinct hashes, and where each is among them."""

    hashes: np.ndarray
    text: np.ndarray
    distinct: np.ndarray
    first: np.ndarray
    inverse: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def tokens(chunk: Chunk) -> Tokens:
    data = _LOWER[chunk.data]
    starts, ends, text = words(chunk)
    hashes = span_hash(prefix_hash(data), starts, ends)
    distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return Tokens(hashes, text, distinct, first, inverse, starts, ends, data)


def _spelled(speller: Speller, found: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of a chunk's words, end to end, and how many each word has."""
    if not len(found.hashes):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    places = speller.places(found.distinct, found.starts[found.first], found.ends[found.first], found.data)
    return speller.ids(places[found.inverse])


# -- counts -----------------------------------------------------------------


_SPELLED = "doc_id long, held_out boolean, ids binary"


def spelled(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Each row's subword ids (``id_type``), the end last. Its words can be told from them."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(vocabulary)
        kind = id_type(speller.size)
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                found, n = tokens(chunk), chunk.last - chunk.first
                ids, sizes = _spelled(speller, found)
                own = np.bincount(found.text, sizes, n).astype(np.int64) + 1
                whole = np.insert(ids, np.cumsum(own - 1), speller.end)
                keys = [batch.column(i).slice(chunk.first, n) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*keys, _binary(whole.astype(kind), own)], [f.split()[0] for f in _SPELLED.split(", ")])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(spell, _SPELLED)


def id_type(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.int32


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Runs of ``values`` of these sizes as bytes."""
    edges = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _edges(column: pa.Array) -> np.ndarray:
    """Where the values of a large_binary column begin and end."""
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]


def _values(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``_binary`` end to end, and the size of each."""
    column = column.cast(pa.large_binary())
    edges, body = _edges(column), column.buffers()[2]
    data = b"" if body is None else memoryview(body)[edges[0] : edges[-1]]
    return np.frombuffer(data, kind), np.diff(edges) // np.dtype(kind).itemsize


def _pieces(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of ``spelled`` in runs of about ``limit`` bytes of ids; a row is never cut."""
    for batch in batches:
        edges, low = _edges(batch.column("ids").cast(pa.large_binary())) if batch.num_rows else [], 0
        while low < batch.num_rows:
            high = max(int(np.searchsorted(edges, edges[low] + limit, "right")) - 1, low + 1)
            yield batch.slice(low, high - low)
            low = high


def word_hashes(ids: np.ndarray, sizes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of texts of ids, each with an end.

    A word's first id, and no other, begins with the space before it, and words
    are equal where their ids are.
    """
    starts = np.flatnonzero(begins[ids])
    text = np.searchsorted(np.cumsum(sizes), starts, "right")
    ends = np.minimum(np.append(starts[1:], len(ids)), (np.cumsum(sizes) - 1)[text])
    return span_hash(prefix_hash(ids), starts, ends), text


def frequent_from(times: pd.DataFrame, most: int) -> int:
    """The least count that no more than ``most`` words reach; ``times`` has how many ``words`` have each count ``n``."""
    times = times.sort_values("n", ascending=False)
    reached = times["n"][times["words"].cumsum() <= most]
    return int(reached.iloc[-1]) if len(reached) else int(times["n"].max() if len(times) else 0) + 1


class Lookup:
    """Where hashes are in an ascending array of them: what begins with the same bits is next to each other."""

    def __init__(self, held: np.ndarray) -> None:
        bits = len(held).bit_length() + 1
        self.held, self.shift = held, np.uint64(64 - bits)
        self.begins = np.searchsorted(held, np.arange(1 << bits, dtype=np.uint64) << self.shift)

    def at(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 where it is not held."""
        if not len(self.held):
            return np.full(len(hashes), -1)
        at, last = self.begins.take((hashes >> self.shift).astype(np.int64)), len(self.held) - 1
        np.minimum(at, last, out=at)
        left = np.flatnonzero(self.held.take(at) < hashes)
        while len(left):
            left = left[at.take(left) < last]
            at[left] += 1
            left = left[self.held.take(at.take(left)) < hashes.take(left)]
        at[self.held.take(at) != hashes] = -1
        return at


def counts(docs: DataFrame, begins: np.ndarray) -> DataFrame:
    """(is_word, key, n): words by hash and subwords by id, over all of ``docs`` (of ``spelled``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_ids, held, size = len(begins), [], 0
        subwords = np.zeros(n_ids, np.int64)

        def passed_on() -> pa.RecordBatch:
            keys, inverse = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            return _counted(True, keys.view(np.int64), np.bincount(inverse, np.concatenate([n for _, n in held])))

        for batch in _pieces(batches):
            ids, sizes = _values(batch.column(0), id_type(n_ids))
            subwords += np.bincount(ids, minlength=n_ids)
            held.append(np.unique(word_hashes(ids, sizes, begins)[0], return_counts=True))
            size += len(held[-1][0])
            if size > 4 * HELD:
                yield passed_on()
                held, size = [], 0
        if held:
            yield passed_on()
        seen = np.flatnonzero(subwords)
        yield _counted(False, seen, subwords[seen])

    parts = docs.select("ids").mapInArrow(count, "is_word boolean, key long, n long")
    return parts.groupBy("is_word", "key").agg(F.sum("n").alias("n"))


def _counted(is_word: bool, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(np.full(len(keys), is_word)), pa.array(keys), pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, ["is_word", "key", "n"])


# -- the network ------------------------------------------------------------


class Weights(NamedTuple):
    embedding: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    position: np.ndarray
    from_last: np.ndarray
    from_past: np.ndarray
    bias: np.ndarray
    group: np.ndarray
    group_bias: np.ndarray
    member: np.ndarray
    member_bias: np.ndarray


class Model(NamedTuple):
    """Weights, the embedding row and class of every id, and its log share within the class."""

    weights: Weights
    row: np.ndarray
    class_of: np.ndarray
    log_share: np.ndarray


def classes(subwords: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each id (the most frequent have one each, the others share by frequency), and ln share in it."""
    order, n = np.argsort(-subwords, kind="stable"), GROUPS * MEMBERS
    class_of = np.zeros(len(subwords), np.int64)
    class_of[order[:SINGLES]] = np.arange(min(SINGLES, len(order)))
    rest = order[SINGLES:]
    mass = np.cumsum(subwords[rest] + 1.0)
    if len(rest):
        class_of[rest] = SINGLES + np.minimum(mass / mass[-1] * (n - SINGLES), n - SINGLES - 1).astype(np.int64)
    smoothed = subwords + 1.0
    return class_of, np.log(smoothed / np.bincount(class_of, smoothed, n)[class_of])


#: (query, key): a place of a block sees itself and what stands before it.
_CAUSAL = np.arange(2 * STRIDE)[None] <= np.arange(STRIDE)[:, None] + STRIDE
#: How far back a key stands, 0 where it stands ahead.
_BACK = np.clip(np.arange(STRIDE)[:, None] + STRIDE - np.arange(2 * STRIDE)[None], 0, None)


def _attend(w: Weights, window: np.ndarray, first: np.ndarray):
    """Forward pass to the hidden layer for runs of blocks of embeddings (run, places, WIDTH).

    A run's first block is only looked back to; the others follow end to end.
    Queries meet embeddings, and embeddings are averaged: keys and values are
    products of them alone, so ``_folded`` takes their part.
    """
    meets, inward = _folded(w)
    seen = np.ones((*window.shape[:2], WIDTH + 1), window.dtype)  # a one beside every embedding adds up the odds
    seen[..., :-1] = window
    seen = _overlapping(seen)
    last = np.ascontiguousarray(window[:, STRIDE:]).reshape(-1, WIDTH)
    query = _by_block(last @ meets, len(window))
    # Below the odds stand their gradients, in time.
    pair = np.empty((*seen.shape[:2], 2 * STRIDE, 2 * STRIDE), window.dtype)
    odds = query @ seen[..., :WIDTH].swapaxes(2, 3)
    np.exp(np.clip(odds, -60, 60, out=odds), out=odds)
    odds = np.multiply(odds, np.exp(w.position)[_BACK] * _CAUSAL, out=pair[:, :, :STRIDE])
    pair.reshape(-1, 2 * STRIDE, 2 * STRIDE)[first, :STRIDE, :STRIDE] = 0  # a text's first block has none before it
    past = _flat(odds @ seen)
    total = past[:, -1:].copy()
    known = np.empty((len(past), 2 * WIDTH + 1), past.dtype)  # embedding, past and a one
    known[:, :WIDTH] = last
    np.divide(past, total, out=known[:, WIDTH:])
    hidden = known @ inward
    np.tanh(hidden, out=hidden)
    hidden[:, -1] = 1
    return hidden[:, :-1].reshape(-1, STRIDE, HIDDEN), (meets, inward, last, query, seen, pair, total, known, hidden)


def _folded(w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """What a place's embedding becomes to meet earlier ones, and what embedding, past and a one add to the hidden layer.

    The hidden layer has a one of its own at its end.
    """
    inward = np.zeros((2 * WIDTH + 1, HIDDEN + 1), w.bias.dtype)
    inward[:WIDTH, :-1], inward[WIDTH:-1, :-1], inward[-1, :-1] = w.from_last, w.value @ w.from_past, w.bias
    return w.query @ w.key.T * w.query.dtype.type(WIDTH**-0.5), inward


def _by_block(x: np.ndarray, runs: int) -> np.ndarray:
    return x.reshape(runs, -1, STRIDE, x.shape[-1])


def _overlapping(x: np.ndarray) -> np.ndarray:
    """The window (run, block, 2 * STRIDE, n) of every block of runs but their first: a view, not a copy."""
    run, place, value = x.strides
    shape = len(x), x.shape[1] // STRIDE - 1, 2 * STRIDE, x.shape[2]
    return np.lib.stride_tricks.as_strided(x, shape, (run, place * STRIDE, place, value))


def _added_up(x: np.ndarray) -> np.ndarray:
    """The sum, for every place of runs, of its values in the windows it is in."""
    runs, blocks, _, n = x.shape
    if blocks == 1:
        return x.reshape(runs, 2 * STRIDE, n)
    out = np.empty((runs, blocks + 1, STRIDE, n), x.dtype)
    out[:, :-1] = x[:, :, :STRIDE]
    out[:, -1] = 0
    out[:, 1:] += x[:, :, STRIDE:]
    return out


def _flat(x: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1])


def _row_sums(x: np.ndarray) -> np.ndarray:
    return (_flat(x) @ np.ones(x.shape[-1], x.dtype)).reshape(*x.shape[:-1], 1)


def blocked(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and targets of each text in blocks of ``STRIDE``, and which blocks begin a text.

    A text's inputs are an end and its ids but for the last. Targets beyond a text are -1.
    """
    n_blocks = -(-sizes // STRIDE)
    at = np.repeat((np.cumsum(n_blocks) - n_blocks) * STRIDE - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(ids))
    targets = np.full(int(n_blocks.sum()) * STRIDE, -1, np.int64)
    targets[at] = ids
    inputs = np.full(len(targets) + 1, end, np.int64)
    inputs[at + 1] = ids
    inputs = inputs[:-1]
    begin = np.cumsum(n_blocks) - n_blocks
    inputs[begin * STRIDE] = end
    first = np.zeros(int(n_blocks.sum()), bool)
    first[begin] = True
    return inputs.reshape(-1, STRIDE), targets.reshape(-1, STRIDE), first


class Tables(NamedTuple):
    """What each embedding row comes to at its places: scoring looks it up instead of multiplying.

    A row of ``place`` is what meets earlier embeddings, the embedding, a one and its part of the
    hidden layer. That is kept as h = 1 / (1 + exp(2 x)), where tanh x is 1 - 2 h, with a half at its
    end; the products around it are made to fit, and hold the biases.
    """

    place: np.ndarray
    from_past: np.ndarray
    group: np.ndarray
    member: np.ndarray
    weight: np.ndarray
    bounded: bool


def tables(w: Weights) -> Tables:
    """The products of all embedding rows; a one beside every embedding adds up the odds."""
    meets, inward = _folded(w)
    query, ones = w.embedding @ meets, np.ones((len(w.embedding), 1), w.embedding.dtype)
    bounded = np.linalg.norm(query, axis=1).max() * np.linalg.norm(w.embedding, axis=1).max() < 60
    inner = 2 * (w.embedding @ inward[:WIDTH] + inward[-1])
    outward = lambda x, bias: np.concatenate([-2 * x, 2 * (bias + x.sum(-2))[..., None, :]], -2)
    return Tables(
        np.concatenate([query, w.embedding, ones, inner], 1), 2 * inward[WIDTH:-1],
        outward(w.group, w.group_bias), outward(w.member, w.member_bias), np.exp(w.position)[_BACK] * _CAUSAL, bool(bounded),
    )


def _hidden(t: Tables, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The hidden layer of ``Tables``, by place, of blocks of embedding rows but the first, which is only looked back to."""
    found = t.place.take(rows.ravel(), 0)
    own, window = found[STRIDE:].reshape(len(first), STRIDE, -1), _overlapping(found[None])[0]
    odds = own[..., :WIDTH] @ window[..., WIDTH : 2 * WIDTH].swapaxes(1, 2)
    if not t.bounded:
        np.clip(odds, -60, 60, out=odds)
    np.exp(odds, out=odds)
    odds *= t.weight
    odds[first, :, :STRIDE] = 0  # a text's first block has none before it
    past = _flat(odds @ window[..., WIDTH : 2 * WIDTH + 1])
    hidden = (past[:, :-1] / past[:, -1:]) @ t.from_past
    hidden += _flat(own)[:, 2 * WIDTH + 1 :]
    with np.errstate(over="ignore"):
        np.exp(hidden, out=hidden)
    hidden += 1
    return np.reciprocal(hidden, out=hidden)


def log_probabilities(model: Model, inputs: np.ndarray, targets: np.ndarray, first: np.ndarray, known: Tables | None = None) -> np.ndarray:
    """Natural-log probability of every target, by block and place; 0 beyond a text's end."""
    out, known = np.zeros(targets.shape), known or tables(model.weights)
    rows = model.row[inputs]
    rows = np.concatenate([np.zeros_like(rows[:1]), rows])  # every window reaches one block back
    for at in range(0, len(targets), BLOCKS):
        hidden = _hidden(known, rows[at : at + BLOCKS + 1], first[at : at + BLOCKS])
        part = targets[at : at + BLOCKS].ravel()
        real = np.flatnonzero(part >= 0)
        own = part.take(real)
        out[at : at + BLOCKS].ravel()[real] = _chosen(known, hidden, real, model.class_of.take(own)) + model.log_share.take(own)
    return out


def _log_softmax_at(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    chosen = logits.ravel().take(np.arange(0, logits.size, logits.shape[1]) + at)
    return chosen - np.log(np.exp(logits, out=logits) @ np.ones(logits.shape[1], logits.dtype))


def _chosen(t: Tables, hidden: np.ndarray, at: np.ndarray, class_of: np.ndarray) -> np.ndarray:
    """Log probability of a class for each of the rows ``at`` of the hidden layer."""
    order = np.argsort(class_of.astype(np.uint16), kind="stable")  # by group, and so one product a group
    hidden, class_of = hidden.take(at.take(order), 0), class_of.take(order)
    group, member = class_of // MEMBERS, class_of % MEMBERS
    logits = np.empty((len(hidden), MEMBERS), hidden.dtype)
    for g, own in _by_group(group):
        np.matmul(hidden[own], t.member[g], out=logits[own])
    found = _log_softmax_at(logits, member)
    np.matmul(hidden, t.group, out=logits)
    out = np.empty(len(hidden))
    out[order] = found + _log_softmax_at(logits, group)
    return out


def _by_group(group: np.ndarray) -> list[tuple[int, slice]]:
    """Where each group stands in a sorted column of them."""
    edges = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
    return [(g, slice(a, b)) for g, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]


def begin(seen: np.ndarray, n_ids: int) -> tuple[Weights, np.ndarray]:
    """Weights before any training, and the embedding row of each id (0: not seen)."""
    rng = np.random.default_rng(SEED)
    row = np.zeros(n_ids, np.int32)
    row[seen] = np.arange(len(seen)) + 1
    d, h = WIDTH, HIDDEN
    shapes = ((len(seen) + 1, d), (d, d), (d, d), (d, d), (2 * STRIDE,), (d, h), (d, h), (h,))
    shapes += ((h, GROUPS), (GROUPS,), (GROUPS, h, MEMBERS), (GROUPS, MEMBERS))
    scales = (0.3, d**-0.5, d**-0.5, d**-0.5, 0, d**-0.5, d**-0.5, 0, h**-0.5, 0, h**-0.5, 0)
    w = Weights(*[(rng.normal(size=s) * k).astype(np.float32) for s, k in zip(shapes, scales)])
    w.embedding[0] = 0
    return w, row


class Trainer:
    """Weights that learn from batches of blocks by Adam; of the embeddings only rows of the batch move."""

    def __init__(self, weights: Weights, class_of: np.ndarray) -> None:
        # All weights but the embeddings are views of one array, which moves at once.
        self.rest = np.concatenate([p.ravel() for p in weights[1:]])
        edges = np.cumsum([p.size for p in weights[1:-1]])
        self.weights = Weights(weights.embedding, *[x.reshape(p.shape) for x, p in zip(np.split(self.rest, edges), weights[1:])])
        self.class_of, self.steps = class_of, 0
        self.rows = [weights.embedding, np.zeros_like(weights.embedding), np.zeros_like(weights.embedding)]
        self.others = [self.rest, np.zeros_like(self.rest), np.zeros_like(self.rest)]
        self.place = np.zeros(len(weights.embedding), np.int64)

    def step(self, rows: np.ndarray, targets: np.ndarray, first: np.ndarray, rate: float) -> None:
        met = np.zeros(len(self.place), bool)
        met[rows] = True
        own = np.flatnonzero(met)
        self.place[own] = np.arange(len(own))
        local = [x.take(own, 0) for x in self.rows]
        grads = _gradients(self.weights._replace(embedding=local[0]), self.place[rows], targets, first, self.class_of)
        self.steps += 1
        self._move(*local, grads[0], rate)
        self._move(*self.others, np.concatenate([g.ravel() for g in grads[1:]]), rate)
        for x, part in zip(self.rows, local):
            x[own] = part

    def _move(self, p: np.ndarray, mean: np.ndarray, square: np.ndarray, g: np.ndarray, rate: float) -> None:
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        down = square / (1 - 0.99**self.steps)
        np.sqrt(down, out=down)
        down += 1e-8
        np.divide(mean, down, out=down)
        down *= rate / (1 - 0.9**self.steps)
        p -= down

    def learn(self, rows: np.ndarray, targets: np.ndarray, first: np.ndarray, rates: Iterator[float], rng: np.random.Generator) -> None:
        """One pass over blocks (embedding rows, targets, which begin a text), in batches of runs drawn without return."""
        more = (0, -len(rows) % RUN)
        rows, targets = np.pad(rows, (more, (0, 0))), np.pad(targets, (more, (0, 0)), constant_values=-1)
        by_run = lambda x: x.reshape(len(x) // RUN, -1)
        before = rows[np.maximum(np.arange(0, len(rows), RUN) - 1, 0)]
        rows, targets, first = np.concatenate([before, by_run(rows)], 1), by_run(targets), by_run(np.pad(first, more, constant_values=True))
        for batch in np.array_split(rng.permutation(len(rows)), max(len(rows) * RUN // BATCH, 1)):
            self.step(rows[batch], targets[batch].reshape(-1, STRIDE), first[batch].ravel(), next(rates))


def fit(inputs: np.ndarray, targets: np.ndarray, first: np.ndarray, class_of: np.ndarray, epochs: int = EPOCHS) -> tuple[Weights, np.ndarray]:
    """Train on blocks in one place; the weights, and the embedding row of each id (0: not seen)."""
    w, row = begin(np.unique(inputs), len(class_of))
    rows, trainer, rng = row[inputs], Trainer(w, class_of), np.random.default_rng(SEED)
    each = max(-(-len(rows) // RUN) * RUN // BATCH, 1)
    epochs = epochs and max(epochs, -(-LEAST_STEPS // each))
    rates = (RATE * (1 - 0.9 * step / (epochs * each)) for step in range(1, epochs * each + 1))
    for _ in range(epochs):
        trainer.learn(rows, targets, first, rates, rng)
    # An id that was not met stands for an average one.
    w.embedding[0] = w.embedding[1:].mean(0)
    return trainer.weights, row


def _gradients(w: Weights, rows: np.ndarray, targets: np.ndarray, first: np.ndarray, class_of: np.ndarray) -> list[np.ndarray]:
    scale = w.embedding.dtype.type(WIDTH**-0.5)
    _, (meets, inward, last, query, seen, pair, total, known, hidden) = _attend(w, w.embedding.take(rows, 0), first)
    d_hidden, d_group, d_member = _output_gradients(w, hidden, targets, class_of)
    d_known = d_hidden @ inward.T
    # The queries' upper half meets the odds' gradients, the gradients of the past their odds.
    half = np.empty((*seen.shape[:2], 2 * STRIDE, WIDTH), pair.dtype)
    half[:, :, STRIDE:] = query
    d_past = d_known[:, WIDTH:]
    d_past /= total
    d_past[:, -1] = 0
    d_past[:, -1] = -_row_sums(d_past * known[:, WIDTH:])[:, 0]  # what the odds' sum takes back
    d_past = _by_block(d_past, len(rows))
    half[:, :, :STRIDE] = d_past[..., :-1]
    d_scores = d_past @ seen.swapaxes(2, 3)
    d_scores *= pair[:, :, :STRIDE]
    pair[:, :, STRIDE:] = d_scores
    d_query = _flat(d_scores @ seen[..., :-1])
    d_window = _added_up(pair.swapaxes(2, 3) @ half).reshape(len(rows), -1, WIDTH)
    d_last = d_query @ meets.T
    d_last += d_known[:, :WIDTH]
    d_window[:, STRIDE:] += d_last.reshape(len(rows), -1, WIDTH)
    own = rows.ravel()
    by_row = np.argsort(own.astype(np.uint16) if len(w.embedding) <= 1 << 16 else own, kind="stable")
    times = np.bincount(own, minlength=len(w.embedding))
    met = np.flatnonzero(times)
    d_embedding = np.zeros_like(w.embedding)
    d_embedding[met] = np.add.reduceat(_flat(d_window).take(by_row, 0), (np.cumsum(times) - times)[met], 0)
    d_position = np.bincount(_BACK.ravel(), d_scores.reshape(len(first), -1).sum(0), 2 * STRIDE)
    d_meets, d_inward = last.T @ d_query * scale, (known.T @ d_hidden)[:, :-1]
    d_past = d_inward[WIDTH:-1]
    return [
        d_embedding, d_meets @ w.key, d_meets.T @ w.query, d_past @ w.from_past.T, d_position.astype(pair.dtype),
        d_inward[:WIDTH], w.value.T @ d_past, d_inward[-1], d_group[:-1], d_group[-1], d_member[:, :-1], d_member[:, -1],
    ]


def _output_gradients(w: Weights, hidden: np.ndarray, targets: np.ndarray, class_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the hidden layer's sums, and of the groups' and members' products, each with its bias as a last row."""
    at = np.flatnonzero(targets.ravel() >= 0)
    classes_ = class_of.take(targets.ravel().take(at))
    order = np.argsort(classes_.astype(np.uint16), kind="stable")  # by group, and so one product a group
    at, classes_ = at.take(order), classes_.take(order)
    seen, group, member = hidden.take(at, 0), classes_ // MEMBERS, classes_ % MEMBERS
    w_group = np.concatenate([w.group, w.group_bias[None]])
    w_member = np.concatenate([w.member, w.member_bias[:, None]], 1)
    part = _softmax_gradient(seen @ w_group, group)
    d_seen, d_group, d_member = part @ w_group.T, seen.T @ part, np.zeros_like(w_member)
    by_group = _by_group(group)
    for g, own in by_group:
        np.matmul(seen[own], w_member[g], out=part[own])
    part = _softmax_gradient(part, member)
    d_inner = np.zeros((len(d_seen) + 1, d_seen.shape[1]), d_seen.dtype)  # the last row is that of places without a target
    for g, own in by_group:
        np.matmul(seen[own].T, part[own], out=d_member[g])
        np.matmul(part[own], w_member[g].T, out=d_inner[own])
    d_inner[:-1] += d_seen
    seen *= seen
    d_inner[:-1] *= np.subtract(1, seen, out=seen)
    place = np.full(len(hidden), len(at))
    place[at] = np.arange(len(at))
    return d_inner.take(place, 0), d_group, d_member


def _softmax_gradient(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The gradient of the mean negative log probability of the classes ``at``."""
    odds, scale = np.exp(logits, out=logits), logits.dtype.type(1 / len(logits))
    odds *= scale / _row_sums(odds)
    odds.reshape(-1)[np.arange(0, odds.size, odds.shape[1]) + at] -= scale
    return odds


# -- Spark ------------------------------------------------------------------


def _packed(w: Weights) -> np.ndarray:
    """All weights as rows of ``WIDTH``: the embeddings, then the others end to end."""
    rest = np.concatenate([p.ravel() for p in w[1:]])
    return np.concatenate([w.embedding, np.pad(rest, (0, -len(rest) % WIDTH)).reshape(-1, WIDTH)])


def _unpacked(rows: np.ndarray, like: Weights) -> Weights:
    rest, out, at = rows[len(like.embedding) :].ravel(), [rows[: len(like.embedding)]], 0
    for p in like[1:]:
        out.append(rest[at : at + p.size].reshape(p.shape))
        at += p.size
    return Weights(*[np.ascontiguousarray(p, np.float32) for p in out])


_LEARNED = ", ".join(["key long", "n double", *(f"v{i} double" for i in range(WIDTH))])


def learned(docs: DataFrame, model: Model, start: float, share: float, steps: float) -> DataFrame:
    """One round of training on all of ``docs`` (ids): rows of ``_packed`` weights, summed by how often each was learned from.

    ``start`` and ``share`` are the parts of all training before and in the
    round, and ``steps`` is about what a task takes in it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        end, kind = len(model.row) - 1, id_type(len(model.row))
        trainer = Trainer(Weights(*[p.copy() for p in model.weights]), model.class_of)
        rng = np.random.default_rng([SEED, TaskContext.get().partitionId()])
        least = -(-LEAST_STEPS * share // 1)
        used = np.zeros(len(model.weights.embedding), np.int64)

        def rates() -> Iterator[float]:
            while True:  # the first steps of Adam, whose means are fresh, are small ones
                done = min(start + share * trainer.steps / max(steps, least), 1)
                yield RATE * (1 - 0.9 * done) * min(1, (trainer.steps + 1) / 10)

        rate = rates()

        def drawn(held: list[tuple[np.ndarray, np.ndarray]], is_last: bool) -> None:
            ids, sizes = (np.concatenate(x) for x in zip(*held))
            inputs, targets, first = blocked(ids.astype(np.int64), sizes, end)
            rows = model.row[inputs]
            used[:] += np.bincount(rows[targets >= 0], minlength=len(used))
            trainer.learn(rows, targets, first, rate, rng)
            while is_last and trainer.steps < least:
                trainer.learn(rows, targets, first, rate, rng)

        held, size = [], 0
        for batch in _pieces(batches):
            held.append(_values(batch.column(0), kind))
            size += len(held[-1][0])
            if size >= DRAWN:
                drawn(held, False)
                held, size = [], 0
        if held:
            drawn(held, True)
        elif not trainer.steps:
            return
        rows = _packed(trainer.weights).astype(np.float64)
        n = np.concatenate([used, np.full(len(rows) - len(used), used.sum())]).astype(np.float64)
        keys = np.flatnonzero(n)
        values = rows[keys] * n[keys, None]
        arrays = [pa.array(keys), pa.array(n[keys]), *(pa.array(np.ascontiguousarray(v)) for v in values.T)]
        yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _LEARNED.split(", ")])

    sums = [F.sum(f.split()[0]).alias(f.split()[0]) for f in _LEARNED.split(", ")[1:]]
    return docs.select("ids").mapInArrow(learn, _LEARNED).groupBy("key").agg(*sums)


def train(docs: DataFrame, subwords: np.ndarray) -> Model | None:
    """The model of training documents (row, ids) with these subword counts; None without documents."""
    if not subwords[-1]:
        return None
    class_of, log_share = classes(subwords)
    weights, row = begin(np.flatnonzero(subwords), len(subwords))
    steps = int(subwords.sum()) / (STRIDE * BATCH * docs.rdd.getNumPartitions())
    done = 0
    for low, high in ROUNDS:
        share = (high - low) / SLICES
        own = docs
        if steps >= LEAST_STEPS:
            own = docs.where((F.col("row") % SLICES >= low) & (F.col("row") % SLICES < high))
        else:
            share = 1 / len(ROUNDS)
        sums = learned(own, Model(weights, row, class_of, log_share), done, share, steps * share).toArrow()
        done += share
        keys, n, *values = (column.to_numpy() for column in sums.columns)
        rows = _packed(weights).astype(np.float64)
        rows[keys] = np.stack(values, 1) / n[:, None]
        weights = _unpacked(rows, weights)
    # An id that was not met stands for an average one.
    weights.embedding[0] = weights.embedding[1:].mean(0)
    return Model(weights, row, class_of, log_share)


class Shared(NamedTuple):
    """What every scoring task has: the model, and the frequent words' hashes and base scores."""

    model: Model | None
    head: np.ndarray
    head_base: np.ndarray


_PART = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, tail array<long>, row long"


def _parts(docs: DataFrame, shared, begins: np.ndarray, end_count: int, denominator: float) -> DataFrame:
    """Scores of ``docs`` (of ``spelled``) with the words whose counts are still to be found."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, head, head_base = shared.value
        n_ids, frequent = len(begins), Lookup(head)
        products = None if model is None else tables(model.weights)
        end_base = np.log10((end_count + 1) / denominator)
        for batch in _pieces(batches):
            n = batch.num_rows
            whole, own = _values(batch.column(2), id_type(n_ids))
            hashes, text = word_hashes(whole, own, begins)
            at = frequent.at(hashes)
            known = at >= 0
            base = np.zeros(len(hashes))
            base[known] = head_base[at[known]]
            tail = np.flatnonzero(~known)
            if model is None:
                score = -own * np.log10(n_ids)
            else:
                inputs, targets, first = blocked(whole.astype(np.int64), own, n_ids - 1)
                logs = log_probabilities(model, inputs, targets, first, products).sum(1)
                score = np.add.reduceat(logs, np.flatnonzero(first)) / np.log(10)
            edges = np.concatenate([[0], np.cumsum(np.bincount(text[tail], minlength=n))]).astype(np.int32)
            arrays = [
                batch.column(0), batch.column(1), pa.array(np.bincount(text, minlength=n) + 1),
                pa.array(np.bincount(text[known], minlength=n) + int(end_count > 0)),
                pa.array(np.bincount(text, base, n) + end_base), pa.array(score),
                pa.ListArray.from_arrays(pa.array(edges), pa.array(hashes[tail].view(np.int64))), batch.column(3),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _PART.split(", ")])

    return docs.select("doc_id", "held_out", "ids", "row").mapInArrow(measure, _PART)


def score(docs: DataFrame, vocabulary: str = VOCABULARY, head_share: float = HEAD_SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row of ``docs``."""
    own = cut(spelled(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()))
    teaching, begins = own.where("NOT held_out"), Speller(vocabulary).begins
    counted = cut(counts(teaching, begins))
    word_counts = counted.where("is_word").select(F.col("key").alias("word"), "n")
    times = word_counts.groupBy("n").agg(F.count("*").alias("words")).toPandas()
    n_words, n_distinct = int((times["n"] * times["words"]).sum()), int(times["words"].sum())
    subwords = np.zeros(len(begins), np.int64)
    for key, n in counted.where("NOT is_word").select("key", "n").collect():
        subwords[key] = n
    end_count = int(subwords[-1])
    n_tokens = n_words + end_count
    denominator = float(n_tokens + n_distinct + (end_count > 0) + 1)

    frequent = word_counts.where(F.col("n") >= frequent_from(times, round(1 / head_share))).toPandas()
    order = np.argsort(frequent["word"].to_numpy(np.int64).view(np.uint64))
    head = frequent["word"].to_numpy(np.int64).view(np.uint64)[order]
    head_base = np.log10((frequent["n"].to_numpy(np.int64)[order] + 1) / denominator)
    model = train(teaching, subwords)
    shared = docs.sparkSession.sparkContext.broadcast(Shared(model, head, head_base))

    parts = cut(_parts(own, shared, begins, end_count, denominator))
    tails = parts.select("row", F.explode("tail").alias("word")).join(word_counts, "word", "left").groupBy("row")
    tails = tails.agg(
        F.sum(F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(denominator))).alias("tail_base"),
        F.count("n").alias("tail_known"),
    )
    zero = F.lit(0)
    return parts.drop("tail").join(tails, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", zero)).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", zero)).alias("base_score"),
        "score",
    )
