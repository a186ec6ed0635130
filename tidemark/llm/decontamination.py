"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits, A-Z lowered. Documents and benchmark
items are joined on shared windows of ``LEAST`` tokens (the seeds); each pair
that shares enough of them is tiled: running Karp-Rabin hashes find the longest
common runs of tokens not yet marked, which are marked in both texts, longest
first, with ever shorter search lengths down to ``LEAST``. The share of an
item's tokens that tiles cover does not depend on the order in which its
passages stand, so reordered ones are caught too. At ``COVERAGE`` or more the
document leaks the item.

The benchmark is taken in blocks of about ``BLOCK_BYTES`` of text by a hash of
the item, each broadcast to one scan of the documents: what is sent has a
bound, whatever the benchmark's size. Whole documents are compared, and no pair
is left out.

Defined results: null and empty texts, and items without tokens, match nothing.
Items without an id match like any other. An item of fewer than ``LEAST`` tokens leaks where it stands whole. Repeated
documents and repeated items give a row for each pair of them.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text_bytes import chunks, mix, prefix_hash, span_hash, spans

LEAST = 5
COVERAGE = 0.5
BLOCK_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_TOKEN = np.zeros(256, bool)
for _range in (range(48, 58), range(65, 91), range(97, 123), range(128, 256)):
    _IN_TOKEN[list(_range)] = True

LEAK = (
    "item_id long, item_tokens long, covered_tokens long, coverage double, "
    "tiles array<struct<item_at:long,doc_at:long,tokens:long>>"
)
_LEAK_TYPES = [
    pa.int64(), pa.int64(), pa.int64(), pa.float64(),
    pa.list_(pa.struct([("item_at", pa.int64()), ("doc_at", pa.int64()), ("tokens", pa.int64())])),
]


class Items(NamedTuple):
    """A block of the benchmark: token hashes of each item, and its seeds sorted by hash."""

    ids: list
    tokens: list[np.ndarray]
    widths: list[int]
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray
    seen: np.ndarray


def token_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last text of each chunk, its tokens' hashes and their text numbers."""
    for chunk in chunks(column):
        starts, ends, text = spans(_IN_TOKEN[chunk.data], chunk.offsets)
        yield chunk.first, chunk.last, span_hash(prefix_hash(_LOWER[chunk.data]), starts, ends), text


def index_items(ids: list, texts: list, least: int = LEAST) -> Items:
    tokens = []
    for first, last, hashes, text in token_hashes(pa.array(texts, pa.string())):
        tokens += [hashes[text == i] for i in range(last - first)]
    rows = []
    for item, own in enumerate(tokens):
        if len(own):
            found = _rolling(own, min(least, len(own)))
            rows.append((found, np.full(len(found), item), np.arange(len(found))))
    seeds, item, at = (np.concatenate(x) for x in zip(*rows)) if rows else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
    order = np.argsort(seeds, kind="stable")
    seen = np.zeros(1 << 20, bool)
    seen[seeds >> np.uint64(44)] = True
    widths = sorted({min(least, len(t)) for t in tokens if len(t)})
    return Items(ids, tokens, widths, seeds[order], item[order], at[order], seen)


def _seed_hits(items: Items, hashes: np.ndarray, text: np.ndarray):
    """(text, place in it, item, place in that) of every shared seed."""
    parts = []
    begin = np.searchsorted(text, np.arange(text[-1] + 2)) if len(text) else None
    for width in items.widths:
        found = _rolling(hashes, width)
        at = np.flatnonzero(items.seen[found >> np.uint64(44)])
        at = at[text[at] == text[at + width - 1]]
        low = np.searchsorted(items.seeds, found[at])
        n = np.searchsorted(items.seeds, found[at], "right") - low
        if n.any():
            hit = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(at, n)
            parts.append((text[at], at - begin[text[at]], items.seed_item[hit], items.seed_at[hit], np.full(len(at), width)))
    return [np.concatenate(x) for x in zip(*parts)] if parts else None


def tile(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in doc, length) of non-overlapping tiles."""
    free_item, free_doc, tiles = np.ones(len(item), bool), np.ones(len(doc), bool), []
    length = max(least, min(len(item), len(doc)))
    while True:
        longest = 0
        for size, i, j in sorted(_matches(item, doc, free_item, free_doc, length), key=lambda m: (-m[0], m[1], m[2])):
            longest = max(longest, size)
            if free_item[i : i + size].all() and free_doc[j : j + size].all():
                free_item[i : i + size] = free_doc[j : j + size] = False
                tiles.append((i, j, size))
        if longest:
            continue  # what the longest have cut short may still match at this length
        if length == least:
            return sorted(tiles)
        length = max(least, length // 2)


def _matches(item, doc, free_item, free_doc, length: int) -> list[tuple[int, int, int]]:
    """Maximal runs of at least ``length`` free tokens that both texts share."""
    own, other = _rolling(item, length), _rolling(doc, length)
    own_at, other_at = _free_windows(free_item, length), _free_windows(free_doc, length)
    places: dict[int, list[int]] = {}
    for i in own_at.tolist():
        places.setdefault(int(own[i]), []).append(i)
    found = []
    for j in other_at.tolist():
        for i in places.get(int(other[j]), ()):
            if i and j and free_item[i - 1] and free_doc[j - 1] and item[i - 1] == doc[j - 1]:
                continue  # part of a run that begins earlier
            size, most = 0, min(len(item) - i, len(doc) - j)
            while size < most and free_item[i + size] and free_doc[j + size] and item[i + size] == doc[j + size]:
                size += 1
            if size >= length:
                found.append((size, i, j))
    return found


def _rolling(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``length`` tokens."""
    n = len(tokens) - length + 1
    if n <= 0:
        return tokens[:0]
    prefix = prefix_hash(tokens)
    at = np.arange(n)
    return span_hash(prefix, at, at + length)


def _free_windows(free: np.ndarray, length: int) -> np.ndarray:
    if len(free) < length:
        return np.zeros(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[length:] == taken[:-length])


def leaks(items: Items, column: pa.Array, coverage: float = COVERAGE) -> Iterator[tuple]:
    """(row, item_id, item_tokens, covered_tokens, coverage, tiles) for each leak of a column's texts."""
    for first, _, hashes, text in token_hashes(column):
        hits = _seed_hits(items, hashes, text)
        if hits is None:
            continue
        order = np.lexsort((hits[1], hits[2], hits[0]))
        owner, at, item, place, width = (h[order] for h in hits)
        cuts = np.flatnonzero((owner[1:] != owner[:-1]) | (item[1:] != item[:-1])) + 1
        begin = np.searchsorted(text, np.arange(text[-1] + 2))
        for rows in np.split(np.arange(len(owner)), cuts):
            row, which, least = owner[rows[0]], item[rows[0]], int(width[rows[0]])
            own = items.tokens[which]
            # A tile is made of seeds: what they cover bounds what tiles can cover.
            if _covered(place[rows], least, len(own)).sum() < coverage * len(own):
                continue
            doc = hashes[begin[row] : begin[row + 1]]
            kept = np.flatnonzero(_covered(at[rows], least, len(doc)))
            gap = np.flatnonzero(np.diff(kept) > 1) + 1
            # Runs of the document that seeds cover, with a token no text has between them.
            part = np.insert(doc[kept], gap, mix(np.arange(len(gap)).astype(np.uint64) + np.uint64(1)))
            where = np.insert(kept, gap, -1)
            tiles = tile(own, part, least)
            covered = sum(t[2] for t in tiles)
            if covered >= coverage * len(own):
                spots = [{"item_at": i, "doc_at": int(where[j]), "tokens": n} for i, j, n in tiles]
                yield first + int(row), items.ids[which], len(own), covered, covered / len(own), spots


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:-1]) > 0


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, least: int = LEAST) -> Iterator:
    """The benchmark as broadcast ``Items`` of about ``block_bytes`` of text each.

    An item's id there is its id and how often it is repeated. Items are dealt by
    id and text, so one id with very many texts is spread as well.
    """
    spark = benchmark.sparkSession
    rows = benchmark.where("text IS NOT NULL").groupBy("item_id", "text").agg(F.count("*").alias("n"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(-(-size // block_bytes))
    for block in range(n):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        items = index_items([(r["item_id"], r["n"]) for r in own], [r["text"] for r in own], least)
        yield spark.sparkContext.broadcast(items)


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document and benchmark item it leaks, with the tiles that show it."""
    names = ["doc_id", *[f.split()[0] for f in ("item_id", "item_tokens", "covered_tokens", "coverage", "tiles")]]

    def scan(block) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(row, item, *rest) for row, (item, n), *rest in leaks(block.value, batch.column(1), coverage) for _ in range(n)]
                found = list(zip(*rows)) or [()] * 6
                arrays = [pa.array(x, kind) for x, kind in zip(found[1:], _LEAK_TYPES)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(found[0], pa.int64())), *arrays], names)

        return docs.select("doc_id", "text").mapInArrow(search, f"doc_id long, {LEAK}")

    out = None
    for block in blocks(benchmark, block_bytes):
        out = scan(block) if out is None else out.unionByName(scan(block))
    return docs.sparkSession.createDataFrame([], f"doc_id long, {LEAK}") if out is None else out


def keep_clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that leak no item, with their columns as they are."""
    at = docs.columns.index("text")
    schema = docs.schema

    def without(df: DataFrame, block) -> DataFrame:
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                good[[row for row, *_ in leaks(block.value, batch.column(at), coverage)]] = False
                yield batch.filter(pa.array(good))

        return df.mapInArrow(clean, schema)

    for block in blocks(benchmark, block_bytes):
        docs = without(docs, block)
    return docs
