"""Product codes of vectors, learned by Lloyd's rounds over cover trees, all in integers.

A component x is floor(``SCALE`` * x); a vector is cut into ``PARTS`` equal
parts, each with a codebook of ``ENTRIES`` entries. Vectors stay where Spark
dealt them: each task cuts its rows into blocks, and every part of a block
becomes a cover tree, built once. A node has a centre and a radius that covers
all below it; its children's centres cover it at half the scale, stand further
apart than that, and the first of them is the node's own. The points of a node
are a run of the tree's order, so differences of cumulative counts and sums give
any subtree's. In a round, an entry goes no further down a tree where the
triangle inequality says that another one is nearer to all below; a subtree with
one entry left is assigned whole. What is still open in a leaf is compared
point by point. Distances are exact integers; roots, which only prune, keep a
margin. Equal parts of a block are one point with a count.

A round moves sums by part and entry, added up in each task first; the codebooks
are all that reaches the driver, and they don't grow with the rows.

Defined results: vectors that are null or hold null or non-finite components are
left out. Vectors of the kept rows must have one length that ``PARTS`` divides,
with components that fit 26 bits once scaled; others are refused. Null ids come
last in the order of ids, equal ids in that of their vectors; equal rows are
coded as often as they stand there. With fewer vectors than entries a codebook
has as many entries as there are vectors; without any the result is empty.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.checkpoints import cut
from tidemark.llm.hot_joins import join_by_weight

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors of a block; of a leaf, points.
BLOCK = 4096
LEAF = 8
LARGEST = 1 << 26
#: Nodes compared with all entries at a time.
NODES = 1 << 14


class Tree(NamedTuple):
    """A cover tree: points in its order with their counts, and nodes as runs of them.

    A node's centre is the first point of its run. ``of_row`` leads from a row
    of the block to its point.
    """

    points: np.ndarray
    weight: np.ndarray
    of_row: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    child: np.ndarray
    children: np.ndarray
    radius: np.ndarray

    def packed(self) -> tuple[np.ndarray, ...]:
        """The arrays in half the bytes."""
        return (*[a.astype(np.int32) for a in self[:-1]], self.radius)


def unpacked(arrays: tuple[np.ndarray, ...]) -> Tree:
    return Tree(*[a.astype(np.int64) for a in arrays[:-1]], arrays[-1])


def _squares(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    away = points - entry
    return (away * away).sum(-1)


def _net(points: np.ndarray, own: np.ndarray, scale: float) -> list[np.ndarray]:
    """``own`` (rows of points, the centre first) in groups within ``scale`` of their first, centres further apart."""
    groups = []
    while len(own):
        near = _squares(points[own], points[own[0]]) <= scale * scale
        groups.append(own[near])
        own = own[~near]
    return groups


def build(rows: np.ndarray, leaf: int = LEAF) -> Tree:
    """The cover tree of ``rows`` (row, component: int64)."""
    points, of_row, weight = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    order = np.arange(len(points))
    radius, start, stop, child, children, scales, at = [0.0], [0], [len(points)], [0], [0], [0.0], 0
    while at < len(start):
        own = order[start[at] : stop[at]]
        radius[at] = float(np.sqrt(_squares(points[own], points[own[0]]).max(initial=0))) if len(own) else 0.0
        scale = min(scales[at], radius[at]) if at else radius[at]
        if len(own) > leaf and radius[at] > 0:
            groups = [own]
            while len(groups) == 1:  # a level that would repeat the node is left out
                scale /= 2
                groups = _net(points, own, scale)
            child[at], children[at] = len(start), len(groups)
            order[start[at] : stop[at]] = np.concatenate(groups)
            edges = start[at] + np.cumsum([0] + [len(g) for g in groups])
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
                start.append(low)
                stop.append(high)
                scales.append(scale)
                radius.append(0.0)
                child.append(0)
                children.append(0)
        at += 1
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    nodes = [np.array(a, np.int64) for a in (start, stop, child, children)]
    return Tree(points[order], weight[order], place[of_row.ravel()], *nodes, np.array(radius))


def _nearest(points: np.ndarray, entries: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Squared distances (far for entries that are not open), the nearest entry, and its distance."""
    squares = np.where(open_, _squares(points[:, None], entries), np.iinfo(np.int64).max)
    best = squares.argmin(1)
    return squares, best, np.take_along_axis(squares, best[:, None], 1)[:, 0]


def runs(tree: Tree, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs (start, stop, entry) of the tree's points that have the same nearest entry; ties go to the lower one."""
    stack = [(np.zeros(1, np.int64), np.ones((1, len(entries)), bool))] if len(tree.points) else []
    while stack:
        node, open_ = stack.pop()
        if len(node) > NODES:
            stack += [(node[NODES:], open_[NODES:]), (node[:NODES], open_[:NODES])]
            continue
        squares, best, least = _nearest(tree.points[tree.start[node]], entries, open_)
        reach = np.sqrt(least) + 2 * tree.radius[node]
        reach += 1e-9 * reach + 1e-6
        open_ &= np.sqrt(squares) <= reach[:, None]
        settled = (open_.sum(1) == 1) | (tree.radius[node] == 0)
        yield tree.start[node[settled]], tree.stop[node[settled]], best[settled]
        node, open_ = node[~settled], open_[~settled]
        inner = tree.children[node] > 0
        if inner.any():
            n = tree.children[node[inner]]
            own = np.repeat(np.arange(len(n)), n)
            below = tree.child[node[inner]][own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            stack.append((below, open_[inner][own]))
        if not inner.all():
            low, n = tree.start[node[~inner]], (tree.stop - tree.start)[node[~inner]]
            own = np.repeat(np.arange(len(n)), n)
            at = low[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            _, best, _ = _nearest(tree.points[at], entries, open_[~inner][own])
            yield at, at + 1, best


def sums(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and componentwise sum of the block's rows of each entry."""
    count, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    counts = np.concatenate([[0], np.cumsum(tree.weight)])
    totals = np.concatenate([np.zeros_like(tree.points[:1]), np.cumsum(tree.points * tree.weight[:, None], 0)])
    for start, stop, entry in runs(tree, entries):
        np.add.at(count, entry, counts[stop] - counts[start])
        np.add.at(total, entry, totals[stop] - totals[start])
    return count, total


def codes(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row of the block."""
    code = np.zeros(len(tree.points), np.int64)
    for start, stop, entry in runs(tree, entries):
        n = stop - start
        code[np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = np.repeat(entry, n)
    error = _squares(tree.points, entries[code]) if len(code) else code
    return code[tree.of_row], error[tree.of_row]


# -- Spark ------------------------------------------------------------------


def scaled(rows: DataFrame, vector: str | Column = "embedding") -> DataFrame:
    """(vec_id, label, vector: array<long>) of the rows that have a whole vector."""
    column = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    units = F.transform(column, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return rows.where(column.isNotNull() & F.coalesce(finite, F.lit(False))).select("vec_id", "label", units.alias("vector"))


def _width(kept: DataFrame) -> int:
    """The one length of all vectors, refused unless all can be coded exactly."""
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    low, high, most = kept.agg(F.min(F.size("vector")), F.max(F.size("vector")), F.max(largest)).first()
    if low is None:
        return 0
    if low != high or low % PARTS or not low:
        raise ValueError(f"vectors of {low} to {high} components; one length is needed that {PARTS} divides")
    if most >= LARGEST:
        raise ValueError(f"a component is {most} once scaled; below {LARGEST} distances are exact")
    return low


def _part(part: int, width: int) -> slice:
    return slice(part * width // PARTS, (part + 1) * width // PARTS)


def planted(kept: DataFrame, width: int, block: int = BLOCK) -> DataFrame:
    """Blocks of rows: (vec_ids, labels, trees), a tree for each part."""
    label = kept.schema["label"].dataType.simpleString()

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                own = batch.slice(at, block)
                units = own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                trees = pickle.dumps([build(units[:, _part(p, width)]).packed() for p in range(PARTS)])
                edges = pa.array([0, own.num_rows], pa.int32())
                whole = [pa.ListArray.from_arrays(edges, own.column(i)) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*whole, pa.array([trees], pa.binary())], ["vec_ids", "labels", "trees"])

    return kept.mapInArrow(plant, f"vec_ids array<long>, labels array<{label}>, trees binary")


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each part's next codebook (part, entry, component)."""
    n_parts, n_entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for trees in batch.column(0):
                for p, tree in enumerate(pickle.loads(trees.as_py())):
                    more, sum_ = sums(unpacked(tree), books[p])
                    count[p] += more
                    total[p] += sum_
        place = np.arange(total.size)
        used = np.repeat(count.ravel() > 0, width)
        arrays = [place[used], np.repeat(count.ravel(), width)[used], total.ravel()[used]]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["place", "n", "total"])

    found = blocks.select("trees").mapInArrow(add, "place long, n long, total long")
    after = books.ravel().copy()
    for place, n, total in found.groupBy("place").agg(F.sum("n"), F.sum("total")).collect():
        after[place] = total // n
    return after.reshape(books.shape)


def train(kept: DataFrame, blocks: DataFrame, width: int, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (part, entry, component) after ``rounds`` rounds."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).collect()
    start = np.array([r.vector for r in first], np.int64)
    books = np.stack([start[:, _part(p, width)] for p in range(PARTS)])
    for _ in range(rounds):
        books = _round(blocks, books)
    return books


def encoded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    label = blocks.schema["labels"].dataType.elementType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                trees = pickle.loads(batch.column(2)[i].as_py())
                found = [codes(unpacked(tree), books[p]) for p, tree in enumerate(trees)]
                code = np.stack([c for c, _ in found], 1).astype(np.uint8)
                error = sum(e for _, e in found)
                arrays = [batch.column(0)[i].values, batch.column(1)[i].values, pa.array([row.tobytes().hex() for row in code], pa.string()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(encode, f"vec_id long, label {label}, code string, error long")


def books_text(books: np.ndarray) -> str:
    """All components by part, entry and place, in decimal."""
    return ",".join(map(str, books.ravel().tolist()))


def compress(rows: DataFrame, vector: str | Column = "embedding", rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error) of the rows that have a whole vector, and the codebooks.

    label_error is the sum of errors over equal labels, nulls together.
    """
    kept = scaled(rows, vector)
    width = _width(kept)
    if not width:
        empty = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return empty, np.zeros((PARTS, 0, 0), np.int64)
    blocks = cut(planted(kept, width))
    books = train(kept, blocks, width, rounds)
    coded = cut(encoded(blocks, books))
    errors = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    found = join_by_weight(coded, cut(errors), ["label"], "n")
    return found.select("vec_id", "label", "code", "error", "label_error"), books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(books_text(books).encode()).hexdigest()
