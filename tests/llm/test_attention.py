"""The attention model against an unbatched one, and its gradients against differences."""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.samples import documents
from tidemark.llm import attention_lm as lm
from tidemark.llm.text_bytes import chunks


def small(seed=0, n_ids=60, texts=5, wide=False):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 70, texts)
    ids = rng.integers(0, n_ids - 1, sizes.sum()).astype(np.int64)
    end = n_ids - 1
    ids[np.cumsum(sizes) - 1] = end
    class_of, log_share = lm.classes(np.bincount(ids, minlength=n_ids))
    inputs, targets, first = lm.blocked(ids, sizes, end)
    w, row = lm.fit(inputs, targets, first, class_of, epochs=1)
    if wide:  # odds beyond the bound that exponentials are cut at
        w = w._replace(query=w.query * 6, key=w.key * 6)
    return ids, sizes, end, lm.Model(w, row, class_of, log_share), inputs, targets, first


def plain(ids, end, model):
    """Natural-log probability of each id of one text, one place at a time."""
    w, before, out = model.weights, [end, *ids[:-1].tolist()], []
    vectors = [w.embedding[model.row[i]].astype(float) for i in before]
    for t, target in enumerate(ids.tolist()):
        start = max(t // lm.STRIDE - 1, 0) * lm.STRIDE  # the block and the one before
        seen = range(start, t + 1)
        query = vectors[t] @ w.query * lm.WIDTH**-0.5
        odds = [math.exp(min(max(query @ (vectors[s] @ w.key), -60), 60)) * math.exp(w.position[t - s]) for s in seen]
        past = sum(o * (vectors[s] @ w.value) for o, s in zip(odds, seen)) / sum(odds)
        hidden = np.tanh(vectors[t] @ w.from_last + past @ w.from_past + w.bias)
        group, member = divmod(int(model.class_of[target]), lm.MEMBERS)
        groups, members = hidden @ w.group + w.group_bias, hidden @ w.member[group] + w.member_bias[group]
        log = lambda x, i: x[i] - math.log(np.exp(x).sum())
        out.append(log(groups, group) + log(members, member) + model.log_share[target])
    return out


@pytest.mark.parametrize("blocks", [512, 2, 1])
@pytest.mark.parametrize("wide", [False, True])
def test_scores_are_those_of_one_place_after_the_other(blocks, wide, monkeypatch):
    monkeypatch.setattr(lm, "BLOCKS", blocks)
    ids, sizes, end, model, inputs, targets, first = small(wide=wide)
    assert lm.tables(model.weights).bounded != wide
    found = lm.log_probabilities(model, inputs, targets, first)
    want = [x for text in np.split(ids, np.cumsum(sizes)[:-1]) for x in plain(text, end, model)]
    assert found[targets >= 0] == pytest.approx(want, abs=2e-3 if wide else 2e-4)
    assert not found[targets < 0].any()


def test_gradients_are_those_of_differences():
    _, _, _, model, inputs, targets, first = small(3)
    w = lm.Weights(*[p.astype(np.float64) for p in model.weights])
    rows = np.concatenate([np.concatenate([np.zeros_like(inputs[:1]), inputs[:-1]]), inputs], 1)
    rows = model.row[rows]

    def loss(w):
        hidden, _ = lm._attend(w, w.embedding[rows], first)
        real = targets >= 0
        seen, classes = hidden[real], model.class_of[targets[real]]
        log = lambda x, at: x[np.arange(len(at)), at] - np.log(np.exp(x).sum(1))
        group, member = classes // lm.MEMBERS, classes % lm.MEMBERS
        inner = np.einsum("nh,nhm->nm", seen, w.member[group]) + w.member_bias[group]
        return -(log(seen @ w.group + w.group_bias, group) + log(inner, member)).mean()

    grads = lm._gradients(w, rows, targets, first, model.class_of)
    rng = np.random.default_rng(1)
    for name, p, g in zip(w._fields, w, grads):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p.shape)
            if name == "embedding":
                at = (int(rng.choice(rows.ravel())), at[1])
            kept, step = p[at], 1e-5
            p[at] = kept + step
            up = loss(w)
            p[at] = kept - step
            down = loss(w)
            p[at] = kept
            assert g[at] == pytest.approx((up - down) / (2 * step), abs=2e-6), name


def test_every_training_document_teaches(spark):
    # The words of the 200 documents whose ids' hashes are largest stand in none of the 3,000 of smallest hash.
    teaching = spark.range(3800).where("crc32(string(id)) % 7 <> 2").orderBy(F.xxhash64("id"))
    ids = [r[0] for r in teaching.collect()]
    assert len(ids) > 3200
    rare = set(ids[-200:])
    rows = [(i, "alpha beta" if i not in rare else "epsilon zeta omega kappa " * 25, "en", "a") for i in ids]
    out = [r for r in lm.score(documents(spark, rows)).collect() if r.doc_id in rare]
    assert len(out) == 200 and all(r.score > 0.2 * r.base_score for r in out)


def test_training_takes_every_id_once_a_round(spark):
    texts = ["alpha beta gamma " * (20 * i % 700) for i in range(40)]
    own = lm.spelled(documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).cache()
    subwords = np.bincount(np.concatenate([np.frombuffer(r.ids, np.uint16) for r in own.collect()]), minlength=50257)
    class_of, log_share = lm.classes(subwords)
    weights, row = lm.begin(np.flatnonzero(subwords), len(subwords))
    sums = lm.learned(own, lm.Model(weights, row, class_of, log_share), 0, 0.01, 1).toPandas()
    by_row = sums[sums.key.between(1, len(weights.embedding) - 1)].set_index("key").n
    # A document's inputs are an end and its ids but for the last, which is the end: each id as often as it stands there.
    assert by_row.to_dict() == {int(row[i]): subwords[i] for i in np.flatnonzero(subwords)}
    assert set(sums[sums.key >= len(weights.embedding)].n) == {subwords.sum()}


def test_runs_of_blocks_have_the_gradients_of_single_ones():
    _, _, _, model, inputs, targets, first = small(3)
    rows, n = model.row[inputs], len(inputs) - 1 - (len(inputs) - 1) % 3
    one = np.concatenate([rows[:n], rows[1 : n + 1]], 1)
    runs = np.stack([rows[i : i + 4].ravel() for i in range(0, n, 3)])
    rest = targets[1 : n + 1], first[1 : n + 1], model.class_of
    for a, b in zip(lm._gradients(model.weights, one, *rest), lm._gradients(model.weights, runs, *rest)):
        np.testing.assert_allclose(a, b, atol=2e-6)


def test_words_are_told_from_their_ids():
    speller = lm.Speller(lm.VOCABULARY)
    texts = [["the", "a\u00a0b", "\u00a0", "the"], [], ["x" * 700, "\u3000x\u2003", "42nd", "don't,", "a\u00a0b"], ["the"]]
    ids = [[i for word in text for i in speller.spell(word.encode())] + [speller.end] for text in texts]
    hashes, text = lm.word_hashes(np.concatenate(ids).astype(np.uint16), np.array([len(i) for i in ids]), speller.begins)
    assert text.tolist() == [i for i, own in enumerate(texts) for _ in own]
    flat = [word for own in texts for word in own]
    assert all((a == b) == (x == y) for a, x in zip(hashes, flat) for b, y in zip(hashes, flat))


def test_as_many_words_are_frequent_as_may_be():
    times = pd.DataFrame({"n": [1, 40, 3, 7], "words": [5000, 2, 90, 8]})
    # By share alone, a hundredth of the tokens, two words would be: 5,406 tokens.
    assert [lm.frequent_from(times, most) for most in (1, 2, 10, 99, 100, 6000)] == [41, 40, 7, 7, 3, 1]
    assert lm.frequent_from(times.iloc[:0], 100) == 1


@pytest.mark.parametrize("n", [0, 1, 2, 700])
def test_hashes_are_found_where_they_are_held(n):
    rng = np.random.default_rng(n)
    some = np.concatenate([rng.integers(0, 1 << 64, 2000, np.uint64), np.arange(9, dtype=np.uint64), ~np.arange(9, dtype=np.uint64)])
    held = np.unique(rng.choice(some, n))
    want = {h: i for i, h in enumerate(held.tolist())}
    assert lm.Lookup(held).at(some).tolist() == [want.get(h, -1) for h in some.tolist()]


def test_words_met_again_keep_their_spelling(monkeypatch):
    monkeypatch.setattr(lm, "HELD", 6)
    speller, rng = lm.Speller(lm.VOCABULARY), np.random.default_rng(5)
    known = ["the", "don't,", "a\u00a0b", "x" * 700, "42nd", "\u3000x", "\x00", "gone", "ing", "zeta"]
    for _ in range(20):
        text = [known[i] for i in rng.integers(0, len(known), rng.integers(1, 9))]
        found = lm.tokens(next(chunks(pa.array([" ".join(text)]))))
        ids, sizes = lm._spelled(speller, found)
        each = [speller.spell(w.encode()) for w in text]
        assert ids.tolist() == [i for e in each for i in e] and sizes.tolist() == [len(e) for e in each]


def test_a_step_moves_every_weight_it_learns_from():
    _, _, _, model, inputs, targets, first = small(3)
    rows = np.concatenate([np.concatenate([np.zeros_like(inputs[:1]), inputs[:-1]]), inputs], 1)
    trainer = lm.Trainer(lm.Weights(*[p.copy() for p in model.weights]), model.class_of)
    grads = lm._gradients(model.weights, model.row[rows], targets, first, model.class_of)
    trainer.step(model.row[rows], targets, first, 0.01)
    for name, before, after, g in zip(model.weights._fields, model.weights, trainer.weights, grads):
        # Adam's first step is the rate, against the gradient's sign.
        sure = np.abs(g) > 1e-5
        np.testing.assert_allclose((after - before)[sure], -0.01 * np.sign(g)[sure], rtol=2e-2, err_msg=name)
