"""SimHash near-duplicates, linked through BK-trees.

Texts become 64-bit fingerprints, equal ones are one node, and nodes that
differ in at most ``RADIUS`` bits are linked. Two such fingerprints agree whole
on at least two of five blocks of bits, so both stand in a common one of ten
buckets, each of about 26 bits: candidates stay in proportion to the input.
The fingerprints of a bucket form a BK-tree (children keyed by their Hamming
distance to the parent), which every member searches, following only the edges
within the radius of its own distance. A bucket above ``SHARD`` fingerprints is
cut into shards by hash, and each shard's tree goes to every shard of queries of
that bucket, so a hot bucket is many tasks and no link is lost. Only a spanning
forest of each tree's links leaves a task.

Defined results: a null text, an empty one and one of spaces only have
fingerprint zero, and are linked like any other. Repeated rows are copies of
each other. A null id joins its group but never names it, unless all are null.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.checkpoints import cut
from tidemark.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
SHARD = 4096
#: Shingles hashed at a time, and candidate pairs compared at a time.
BLOCK = 1 << 16
PAIRS = 1 << 19
#: Bucket rows taken into one forest.
FOREST = 1 << 16
#: Bit ranges (first, width); any two fingerprints within 3 bits agree on two of them.
BIT_BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text in UTF-8."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1]
    ends = ends[width - 1 :]
    set_bits, digest = np.zeros(64, np.int64), xxhash.xxh64_digest  # most significant byte first
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in pairs])
        columns = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
        for i in range(8):
            set_bits[8 * i : 8 * i + 8] += np.bincount(columns[:, i], minlength=256) @ _BITS_OF_BYTE
    return int.from_bytes(np.packbits(2 * set_bits > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp: long) for every row of ``docs``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(hashed, "doc_id long, fp long")


# -- BK-trees ---------------------------------------------------------------


class Forest:
    """BK-trees over the rows of several groups at once; rows of a group are distinct."""

    def __init__(self, prints: np.ndarray, group: np.ndarray, member: np.ndarray) -> None:
        """``group`` is sorted; rows where ``member`` is false are in no tree."""
        self.prints = prints
        self.root = np.full(int(group[-1]) + 1 if len(group) else 0, -1)
        pending = np.flatnonzero(member)
        slot = group[pending]
        edges, children = [], []
        first = True
        while len(pending):
            head = np.r_[True, slot[1:] != slot[:-1]]
            nodes = pending[head]
            if first:
                self.root[slot[head]] = nodes
            else:
                edges.append(slot[head])
                children.append(nodes)
            parent = nodes[np.cumsum(head) - 1][~head]
            pending = pending[~head]
            slot = parent * 65 + np.bitwise_count(prints[pending] ^ prints[parent])
            order = np.argsort(slot, kind="stable")
            pending, slot, first = pending[order], slot[order], False
        edges = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        children = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(edges)
        self.edges, self.children = edges[order], children[order]

    def links(self, queries: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query row, tree row) within ``radius``, a query's own row left out."""
        at = self.root[group[queries]]
        stack = [(queries[at >= 0], at[at >= 0])]
        while stack:
            query, node = stack.pop()
            if len(query) > PAIRS:
                half = len(query) // 2
                stack += [(query[half:], node[half:]), (query[:half], node[:half])]
                continue
            away = np.bitwise_count(self.prints[query] ^ self.prints[node]).astype(np.int64)
            near = (away <= radius) & (query != node)
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(away - radius, 0))
            n = np.searchsorted(self.edges, node * 65 + np.minimum(away + radius, 64), "right") - low
            if n.any():
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                stack.append((np.repeat(query, n), self.children[np.repeat(low, n) + within]))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Each row's smallest row it is joined with, after joining a and b pairwise."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def forest_links(prints: np.ndarray, group: np.ndarray, member: np.ndarray, asks: np.ndarray, radius: int = RADIUS):
    """Row pairs that join what links join within each group: a spanning forest of them."""
    label = np.arange(len(prints))
    forest = Forest(prints, group, member)
    for a, b in forest.links(np.flatnonzero(asks), group, radius):
        label = _merge(label, a, b)
    joined = np.flatnonzero(label != np.arange(len(label)))
    return joined, label[joined]


def _bucket_key(first: int, second: int):
    parts = [F.shiftrightunsigned("fp", at).bitwiseAND((1 << width) - 1) for at, width in (BIT_BLOCKS[first], BIT_BLOCKS[second])]
    table = [pair for pair in combinations(range(len(BIT_BLOCKS)), 2)].index((first, second))
    return F.lit(table << 26) + F.shiftleft(parts[0], 13) + parts[1]


def links(nodes: DataFrame, shard: int = SHARD, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that join all fingerprints of ``nodes`` (fp, distinct) within ``radius`` bits."""
    if radius > 3:
        raise ValueError("five blocks of bits find links of up to 3 bits")
    keys = F.array(*[_bucket_key(i, j) for i, j in combinations(range(len(BIT_BLOCKS)), 2)])
    rows = nodes.select("fp", F.explode(keys).alias("bucket"))
    full = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shards = F.ceil(F.col("n") / F.lit(shard)).cast("int")
    dealt = (
        rows.join(full, "bucket")
        .withColumn("shards", shards)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .select(
            "bucket",
            F.least("own", "other").alias("tree"),
            F.greatest("own", "other").alias("side"),
            "fp",
            F.expr("own <= other").alias("member"),
            F.expr("own >= other").alias("asks"),
        )
        .repartition("bucket", "tree", "side")
        .sortWithinPartitions("bucket", "tree", "side", "fp")
    )

    def joined(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        bucket, tree, side, prints = (table.column(i).to_numpy() for i in range(4))
        new = np.r_[True, (bucket[1:] != bucket[:-1]) | (tree[1:] != tree[:-1]) | (side[1:] != side[:-1])]
        a, b = forest_links(
            prints.view(np.uint64), np.cumsum(new) - 1, table.column(4).to_numpy(), table.column(5).to_numpy(), radius
        )
        return pa.RecordBatch.from_arrays([pa.array(prints[a]), pa.array(prints[b])], ["a", "b"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = list(zip(*(batch.column(i)[-1:].to_pylist() for i in range(3))))[0]
            same = np.ones(batch.num_rows, bool)
            for i in range(3):
                same &= batch.column(i).to_numpy() == group[i]
            last = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            # Rows before ``last`` complete the groups that are held.
            if last and sum(b.num_rows for b in held) + last >= FOREST:
                yield joined([*held, batch.slice(0, last)])
                held = [batch.slice(last)]
            else:
                held.append(batch)
        if held:
            yield joined(held)

    return dealt.mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, shard: int = SHARD, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs``.

    component_id is the smallest doc_id that links reach, the row's own included.
    """
    printed = cut(fingerprints(docs, shingle))
    found = component_ids(printed, links(printed.select("fp").distinct(), shard, radius))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def component_ids(printed: DataFrame, edges: DataFrame) -> DataFrame:
    """doc_id, fp and component_id for every row of ``printed`` (doc_id, fp), given edges of fp."""
    nodes = cut(printed.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    rooted = nodes.join(components(edges).withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_print = rooted.join(named, "root").select("fp", "component_id")
    return printed.join(by_print, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, shard: int = SHARD, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest id, with its columns as they are.

    Of rows that repeat a kept id, one stays. Rows without an id are kept, since
    no id tells them apart.
    """
    return first_of_groups(docs, near_duplicates(docs, shingle, shard, radius))


def first_of_groups(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay by ``found`` (doc_id, component_id)."""
    ids = cut(
        found.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.count("*").alias("n"), F.min(F.col("component_id") == F.col("doc_id")).alias("first"))
        .where("n > 1 OR NOT first")
        .select("doc_id", "first")
    )
    alone = docs.join(ids, "doc_id", "left_anti")
    repeated = docs.join(ids.where("first"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return alone.unionByName(repeated)
