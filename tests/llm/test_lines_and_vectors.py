"""Line dedup and vector codes against brute force, and on rows of every kind."""

import hashlib
import math
import random
import string
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.samples import CLASHES, documents, odd_rows, prose
from tidemark.llm import hot_joins, line_dedup, vector_codes

# -- lines ------------------------------------------------------------------

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute_lines(rows):
    """(doc_id, text, n_lines, n_dropped) of every row."""
    holders = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40 and i is not None:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(holders.get(key(x), ())) < 5 or i == max(holders[key(x)])]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def shared_rows():
    rng = random.Random(3)
    common = [prose(700 + i, 12) for i in range(12)]
    rows = []
    for i in range(60):
        lines = [prose(1000 + i, rng.randint(1, 15)), *rng.sample(common, 3), common[0], "", "short line", " \t" + common[1].upper() + "\x0b\r"]
        rng.shuffle(lines)
        rows.append((i * 3 % 61, "\n".join(lines), "en", "a"))
    rows += [rows[0], rows[1], (7, common[0] + "\n" + common[0], "en", "a"), (None, common[0] + "\nown", "en", None), (None, common[1], None, None)]
    return rows + [(200 + i, "É" + "é" * 38 + "\nx" if i < 3 else "É" + "é" * 39, "fr", "b") for i in range(9)] + odd_rows()


@pytest.mark.parametrize("batches, hot", [(6, 4096), (1, 1), (5, 3)])
def test_lines_are_dropped_as_by_brute_force(spark, batches, hot, monkeypatch):
    monkeypatch.setattr(hot_joins, "HOT", hot)
    rows = shared_rows()
    found = line_dedup.drop_common_lines(documents(spark, rows), batches=batches)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()), key=repr) == brute_lines(rows)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_lines_of_no_and_of_long_documents(spark):
    assert line_dedup.drop_common_lines(documents(spark, [])).count() == 0
    assert line_dedup.drop_common_lines(documents(spark, [(None, None, None, None)])).first().n_lines == 1
    lines = [prose(i, 25) for i in range(50)]
    rows = [(i, "\n".join(lines * 600), "en", "a") for i in range(6)]
    began = time.time()
    found = {r.doc_id: (r.n_lines, r.n_dropped, len(r.text)) for r in line_dedup.drop_common_lines(documents(spark, rows)).collect()}
    assert found == {i: (30_000, 0 if i == 5 else 30_000, len(rows[0][1]) if i == 5 else 0) for i in range(6)}
    assert time.time() - began < 60  # in proportion to the lines, not to their square


def test_runs_are_merged_without_an_exchange(spark):
    lines = spark.range(400).select((F.col("id") % 50).alias("doc_id"), (F.col("id") % 90).alias("h1"), F.lit(1).cast("long").alias("h2"))
    runs = line_dedup.LineRuns(spark)
    runs.add(lines.where("doc_id >= 25"))
    plan = runs.run_of(lines.where("doc_id < 25"))._jdf.queryExecution().executedPlan().toString()
    # Both exchanges are the batch's own: by line and document, then by line.
    assert plan.count("Exchange") == 2 and "SortMergeJoin" in plan
    runs.add(lines.where("doc_id < 25"))
    assert [name is not None for name in runs.levels] == [False, True]
    want = lines.distinct().groupBy("h1", "h2").agg(F.max("doc_id").alias("owner"), F.count("*").alias("n"))
    assert sorted(map(tuple, runs.counts().collect())) == sorted(map(tuple, want.collect()))
    runs.close()


# -- vectors ----------------------------------------------------------------


def brute_codes(rows, rounds=6):
    """The contract's rows of (vec_id, embedding, label), by plain loops."""
    kept = [(i, [math.floor(4096 * x) for x in v], la) for i, v, la in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    d = len(kept[0][1]) // 8
    part = lambda v, p: v[p * d : (p + 1) * d]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    books = [[part(v, p) for _, v, _ in first] for p in range(8)]
    nearest = lambda v, p: min(range(len(books[p])), key=lambda e: (far(part(v, p), books[p][e]), e))
    for _ in range(rounds):
        after = []
        for p in range(8):
            own = [nearest(v, p) for _, v, _ in kept]
            held = [[part(v, p) for (_, v, _), e in zip(kept, own) if e == at] for at in range(len(books[p]))]
            after.append([[sum(x) // len(vs) for x in zip(*vs)] if vs else old for vs, old in zip(held, books[p])])
        books = after
    coded = []
    for i, v, la in kept:
        own = [nearest(v, p) for p in range(8)]
        coded.append((i, "".join(f"{e:02x}" for e in own), sum(far(part(v, p), books[p][e]) for p, e in enumerate(own)), la))
    sums = {}
    for _, _, error, la in coded:
        sums[la] = sums.get(la, 0) + error
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(((i, c, e, sums[la]) for i, c, e, la in coded), key=repr), hashlib.sha256(text.encode()).hexdigest()


def vectors(spark, rows, clashes=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.selectExpr("*", *[f"'x' AS {c}" for c in (*CLASHES, "code", "error", "trees", "vector")]) if clashes else df


def coded(spark, rows):
    found, books = vector_codes.compress(vectors(spark, rows))
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found.collect()), key=repr), vector_codes.digest(books)


def odd_vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 6] + rng.normal(size=16) * 0.05], int(i) % 3 if i % 4 else None) for i in rng.permutation(90)]
    rows += [(200 + i, rows[0][1], 1) for i in range(60)]  # very many equal ones
    rows += [rows[3], (rows[3][0], rows[4][1], 2), (None, rows[5][1], None), (None, [0.0] * 16, 7)]
    return rows + [(300, None, 1), (301, [1.0] * 15 + [None], 1), (302, [math.nan] * 16, 1), (303, [math.inf] + [0.0] * 15, 1), (304, [-0.0] * 16, 1)]


@pytest.mark.parametrize("block, leaf", [(4096, 8), (7, 1)])
def test_codes_are_those_of_plain_loops(spark, block, leaf, monkeypatch):
    monkeypatch.setattr(vector_codes.planted, "__defaults__", (block,))
    monkeypatch.setattr(vector_codes.build, "__defaults__", (leaf,))
    assert coded(spark, odd_vectors()) == brute_codes(odd_vectors())


def test_few_vectors_and_none(spark):
    few = odd_vectors()[:5]
    assert coded(spark, few) == brute_codes(few)
    for rows in ([], [(1, None, 1), (2, [math.nan] * 16, None)]):
        found, books = vector_codes.compress(vectors(spark, rows))
        assert found.count() == 0 and vector_codes.digest(books) == hashlib.sha256(b"").hexdigest()
    for bad, said in (([1.0] * 16, "one length"), ([1e9] * 8, "scaled")):
        with pytest.raises(ValueError, match=said):
            vector_codes.compress(vectors(spark, [(1, [0.0] * 8, 1), (2, bad, 1)]))


def test_trees_cover_and_prune():
    rng = np.random.default_rng(9)
    x = np.floor(rng.normal(size=(12, 6)) * 9000)[rng.integers(0, 12, 3000)] + rng.integers(-40, 40, (3000, 6))
    x = x.astype(np.int64)
    tree = vector_codes.build(x)
    assert (tree.points[tree.of_row] == x).all() and tree.weight.sum() == len(x)
    for start, stop, radius, child, n in zip(tree.start, tree.stop, tree.radius, tree.child, tree.children):
        own = tree.points[start:stop]
        assert np.sqrt(((own - own[0]) ** 2).sum(1)).max() <= radius + 1e-9
        if n:  # children cut the node's run, the first with its own centre, their centres apart
            assert tree.start[child] == start and (tree.start[child + 1 : child + n] == tree.stop[child : child + n - 1]).all() and tree.stop[child + n - 1] == stop
    entries = x[:16]
    squares = ((x[:, None] - entries) ** 2).sum(-1)
    code, error = vector_codes.codes(tree, entries)
    assert (code == squares.argmin(1)).all() and (error == squares.min(1)).all()
    # Clustered points are assigned by the subtree.
    assert sum(len(start) for start, _, _ in vector_codes.runs(tree, np.unique(entries // 2000 * 2000, axis=0))) < len(tree.points) / 3
