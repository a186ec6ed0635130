"""Operators on documents against brute force, and on rows of every kind."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.samples import DOCUMENT, documents, odd_rows, prose
from tidemark.llm import attention_lm, components, decontamination, language_id, quality_cnn, quality_rules, simhash
from tidemark.llm.text_bytes import chunks, prefix_hash, span_hash, words

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def lowered(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def shown(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- words ------------------------------------------------------------------


def test_words_and_hashes_of_chunks():
    texts = [t for _, t, _, _ in odd_rows()]
    found = []
    for chunk in chunks(pa.array(texts), limit=700):
        starts, ends, text = words(chunk)
        hashes = span_hash(prefix_hash(chunk.data), starts, ends)
        own = [(chunk.first + t, chunk.data[s:e].tobytes().decode()) for s, e, t in zip(starts, ends, text)]
        found += [(o, int(h)) for o, h in zip(own, hashes)]
    assert [o for o, _ in found] == [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t or "")]
    by_word = {}
    for (_, word), h in found:
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


# -- quality rules ----------------------------------------------------------


def brute_rules(text):
    found = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    covered = {i + k for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for k in range(3)}
    n = len(found)
    return (
        n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def test_base_rules_are_exact(spark):
    rows = odd_rows() + [(20, "a b c a b c d", "en", "a"), (21, "l one\nl one\n\n\nl one \n# $x", "en", "a"), (22, "la la " * 60, "en", "a")]
    out = quality_rules.score(documents(spark, rows), None)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert shown(out, "doc_id", *names) == sorted(((i, *brute_rules(t)) for i, t, _, _ in rows), key=repr)
    assert all(r.kept == (not r.base_failed) for r in out.collect())


def test_ratio_rejects_what_is_unlike_the_trusted(spark):
    good = [(i, prose(i, 120), "en", "a") for i in range(60)]
    junk = [(100 + i, " ".join(w + "###" for w in prose(i, 120).split()), "en", "a") for i in range(20)]
    docs = documents(spark, good + junk)
    labels = spark.createDataFrame([(i, 1) for i in range(0, 60, 2)] + [(1, 0), (1, 1), (100, 0), (None, 1), (999, 1)], "doc_id long, quality int")
    ratio = quality_rules.model(docs, labels)
    # counts by brute force
    counts = {k: (a, b) for k, a, b in quality_rules.ngram_counts(docs, quality_rules.trusted_ids(labels)).collect()}
    n_grams = {i: 2 * len(t.split()) - 1 for i, t, _, _ in good + junk}
    assert sum(b for _, b in counts.values()) == sum(n_grams.values())
    assert sum(a for a, _ in counts.values()) == sum(n_grams[i] for i in range(0, 60, 2))
    kept = {r.doc_id for r in quality_rules.score(docs, ratio).where("kept").collect()}
    assert kept == {i for i, *_ in good}
    stay = quality_rules.keep(docs, ratio)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == kept


def test_rules_without_labels_or_rows(spark):
    none = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.model(documents(spark, odd_rows()), labels) is None
    assert quality_rules.score(none, quality_rules.model(none, labels)).count() == 0


# -- language ---------------------------------------------------------------

EN, FR = "the and of thing wh er on", "le la que eau ré oui çon"


def test_language_of_known_and_unseen_words(spark):
    rows = [(i, prose(i, 60, EN if i % 2 else FR), "en" if i % 2 else "fr", "a") for i in range(200, 320)]
    docs = documents(spark, rows + odd_rows())
    model = language_id.train(docs.where(~language_id.held_out()).where("lang IN ('en', 'fr')").where("doc_id >= 200"))
    out = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    held = [i for i in range(200, 320) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(out[i].held_out for i in held)
    assert all(out[i].lang_pred == ("en" if i % 2 else "fr") for i in held)
    assert out[1].lang_pred == out[2].lang_pred == out[3].lang_pred == "und" and out[1].score == 0
    assert all(0 <= r.score <= 1 for r in out.values())
    assert language_id.predict(docs, model).count() == len(rows) + len(odd_rows())
    kept = language_id.keep_known(docs, model)
    assert kept.columns == docs.columns and {1, 2, 3}.isdisjoint(r.doc_id for r in kept.collect())


def test_word_and_gram_counts_are_exact(spark):
    docs = documents(spark, [(1, "The the, THE déjà_vu", "en", "a"), (2, None, "en", "a"), (3, "the", None, "a"), (4, "ab", "fr", "a")])
    counts = language_id.word_counts(docs)
    assert shown(counts, "lang", "word", "n") == [("en", "déjà", 1), ("en", "the", 3), ("en", "vu", 1), ("fr", "ab", 1)]
    sums = {(r.lang, r["size"]): r.n for r in language_id.gram_counts(counts).groupBy("lang", "size").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    want = Counter()
    for lang, word, n in [("en", "déjà", 1), ("en", "the", 3), ("en", "vu", 1), ("fr", "ab", 1)]:
        want[lang, 1] += n * len(word)
        for size in (2, 3, 4):
            want[lang, size] += n * max(len(word) + 3 - size, 0)
    assert sums == {k: v for k, v in want.items() if v}


def test_backoff_scores_by_hand():
    grams = lambda names, rows: language_id.Grams(*_sorted(names, rows))
    model = language_id.Model(["en", "fr"], grams(["the"], [[-1.0, -6.0]]), {1: grams(["z"], [[-2.0, -1.0]])}, 6.0)
    best, score = language_id.identify(model, pa.array(["the", "zq", "the zq", "qq", ""]))
    assert best.tolist() == [0, 1, 0, 0, -1]
    # "zq": z is known, q costs the penalty in both: means -4 and -3.5
    np.testing.assert_allclose(score, [1 / (1 + 1e-5), 1 / (1 + 10**-0.5), 1 / (1 + 10**-4.5), 0.5, 0], rtol=1e-6)


def _sorted(names, rows):
    def one(name):
        points = np.array([ord(c) for c in name], np.uint32)
        return span_hash(prefix_hash(points), np.array([0]), np.array([len(points)]))[0]

    hashes = np.array([one(n) for n in names], np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array(rows, np.float32)[order]


def test_language_without_training_rows(spark):
    assert language_id.train(documents(spark, [])) is None
    out = language_id.predict(documents(spark, odd_rows()), None)
    assert {r.lang_pred for r in out.collect()} == {"und"}
    assert language_id.keep_known(documents(spark, odd_rows()), None).count() == len(odd_rows())


# -- quality classifier -----------------------------------------------------


def test_chunks_cover_documents():
    for size in (0, 1, 64, 65, 255, 256, 257, 448, 449, 5000):
        starts = quality_cnn.chunk_starts(size)
        covered = {p for s in starts for p in range(s, min(s + quality_cnn.CHUNK, size))}
        assert covered == set(range(size)) and len(starts) >= 1


def test_classifier_gradients():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 256, (n, quality_cnn.CHUNK)).astype(np.int16) for n in (1, 3, 2)]
    labels, weight = np.array([0, 1, 1]), np.array([0.7, 1.2])
    net = quality_cnn.fit(docs, labels, epochs=0)
    net = quality_cnn.Network(*[p.astype(np.float64) + 0.05 * rng.normal(size=p.shape) for p in net])

    def loss():
        total = 0
        for doc, y in zip(docs, labels):
            logit = quality_cnn._top(net, quality_cnn._responses(net, doc)[0].mean(0))[1]
            total += weight[y] * np.log1p(np.exp(-logit if y else logit)) / len(docs)
        return total

    for p, g in zip(net, quality_cnn._gradients(net, docs, labels, weight)):
        at = np.unravel_index(np.abs(g).argmax(), p.shape)
        keep = p[at]
        p[at] = keep + 1e-5
        above = loss()
        p[at] = keep - 1e-5
        assert (above - loss()) / 2e-5 == pytest.approx(g[at], rel=1e-2, abs=1e-6)
        p[at] = keep


def test_classifier_tells_held_out_junk(spark):
    rows = [(i, prose(i, 150) if i % 3 else " ".join(w.upper() + "!!" for w in prose(i, 150).split()), "en", "a") for i in range(240)]
    docs = documents(spark, rows + odd_rows())
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(20, 240)] + [(None, 1), (10, None)], "doc_id long, quality int")
    model = quality_cnn.train(docs, labels)
    out = quality_cnn.predict(docs, model).collect()
    assert len(out) == len(rows) + len(odd_rows()) and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id >= 20]
    assert held and np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.95
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)


def test_classifier_without_both_classes(spark):
    docs = documents(spark, odd_rows())
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_cnn.train(docs, empty) == 0.5
    ones = spark.createDataFrame([(i, 1) for i in (4, 5, 6, 7, 9)], "doc_id long, quality int")
    assert {r.score for r in quality_cnn.predict(docs, quality_cnn.train(docs, ones)).collect()} == {1.0}
    assert quality_cnn.predict(documents(spark, []), 0.5).count() == 0


# -- language model ---------------------------------------------------------


def test_blocks_score_each_id_once():
    sizes = np.array([1, 16, 17, 40])
    ids = np.arange(sizes.sum())
    inputs, targets, first = attention_lm.blocked(ids, sizes, 99)
    assert targets[targets >= 0].tolist() == ids.tolist() and first.sum() == 4
    at = 0
    for size in sizes:
        rows = -(-size // attention_lm.STRIDE)
        own = inputs[at : at + rows].ravel()[:size]
        assert own.tolist() == [99, *targets[at : at + rows].ravel()[: size - 1]]
        at += rows


def test_words_spelled_together_as_alone():
    speller = attention_lm.Speller(attention_lm.VOCABULARY)
    found = ["the", "'s", "don't,", "a\u00a0b", "\u00a0", "\u3000x\u2003", "42nd", "ünï", "###", "😀😀", "x" * 250, "!'ll", "\x00", "ﬁ"]
    for own in (found, [*found, "y" * 900], ["z"]):
        raw = [w.encode() for w in own]
        ids, sizes = speller.spell_all(raw)
        each = [speller.spell(w) for w in raw]
        assert ids.tolist() == [i for e in each for i in e] and sizes.tolist() == [len(e) for e in each]


def test_blocks_do_not_depend_on_their_batch():
    rng = np.random.default_rng(0)
    class_of, log_share = attention_lm.classes(rng.integers(0, 50, 1400).astype(np.int64))
    ids, sizes = rng.integers(0, 1400, 9000), np.array([3000, 1, 5999])
    inputs, targets, first = attention_lm.blocked(ids, sizes, 1399)
    weights, row = attention_lm.fit(inputs, targets, first, class_of, epochs=0)
    model = attention_lm.Model(weights, row, class_of, log_share)
    whole = attention_lm.log_probabilities(model, inputs, targets, first)
    cut = int(np.flatnonzero(first)[2])
    alone = attention_lm.log_probabilities(model, inputs[cut:], targets[cut:], first[cut:])
    np.testing.assert_allclose(whole[cut:], alone, rtol=1e-4, atol=1e-5)
    # nothing later than a place counts for it
    changed = inputs.copy()
    changed[5, 9:] = 7
    again = attention_lm.log_probabilities(model, changed, targets, first)
    np.testing.assert_allclose(whole[5, :9], again[5, :9], rtol=1e-4, atol=1e-5)
    # over all ids, the probabilities of a place add up to 1
    total = sum(
        np.exp(attention_lm.log_probabilities(model, inputs[:1], np.full((1, attention_lm.STRIDE), i), first[:1])[0, 3]) for i in range(1400)
    )
    assert total == pytest.approx(1, abs=1e-3)


@pytest.mark.parametrize("head_share", [1e-5, 0.02, 1.0])
def test_lm_base_is_exact(spark, head_share):
    rows = [(i, prose(i, 40).title(), "en", "a") for i in range(10, 50)] + odd_rows()
    out = attention_lm.score(documents(spark, rows), head_share=head_share).collect()
    teaches = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    counts = Counter(w for i, t, _, _ in rows if teaches(i) for w in [*lowered(t), "\n"])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t, _, _ in rows:
        own = [*lowered(t), "\n"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        want[i, not teaches(i), len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)


def test_lm_learns_and_takes_no_documents(spark):
    rows = [(i, " ".join(["alpha beta gamma delta"] * 30), "en", "a") for i in range(60)]
    out = attention_lm.score(documents(spark, rows)).collect()
    # four words in turn: far likelier than words drawn by frequency
    assert all(r.score > 0.5 * r.base_score for r in out)
    assert attention_lm.score(documents(spark, [])).count() == 0


# -- near duplicates --------------------------------------------------------


def brute_print(text):
    own = lowered(text)
    shingles = [" ".join(own[i : i + 3]) for i in range(len(own) - 2)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_by_hand():
    for _, text, _, _ in odd_rows():
        if text is None or len(text) < 5000:
            assert simhash.fingerprint(text and text.encode()) == brute_print(text)


def brute_components(prints):
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j in range(i):
                if (a ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


@pytest.mark.parametrize("shard", [4096, 3])
def test_links_join_all_within_the_radius(spark, shard):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(140):
        base = rng.choice(prints)
        prints.append(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), shard)
    roots = {r.node: r.root for r in components.components(edges).collect()}
    label = brute_components(prints)
    want = {}
    for i, at in enumerate(label):
        want.setdefault(at, []).append(signed[i])
    got = {}
    for p in signed:
        got.setdefault(roots.get(p, p), []).append(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_tree_search_finds_every_near_print():
    rng = np.random.default_rng(2)
    prints = np.unique(rng.integers(0, 1 << 12, 900).astype(np.uint64))
    group, everyone = np.zeros(len(prints), np.int64), np.ones(len(prints), bool)
    forest = simhash.Forest(prints, group, everyone)
    found = {(int(a), int(b)) for x, y in forest.links(np.arange(len(prints)), group, 2) for a, b in zip(x, y)}
    away = np.bitwise_count(prints[:, None] ^ prints[None])
    assert found == {(int(a), int(b)) for a, b in zip(*np.nonzero((away <= 2) & (away > 0)))}


def test_near_duplicates_and_what_stays(spark):
    base = prose(50, 400).split()
    near = [*base[:200], "zzz", *base[201:]]
    rows = odd_rows() + [(30, " ".join(base), "en", "a"), (31, " ".join(near), "en", "a"), (32, " ".join(base).upper(), "en", "a"), (33, prose(51, 300), "en", "a")]
    docs = documents(spark, rows)
    prints = [brute_print(t) if t is None or len(t) < 60_000 else simhash.fingerprint(t.encode()) for _, t, _, _ in rows]
    label = brute_components(prints)
    least = {}
    for (i, *_), at in zip(rows, label):
        if i is not None:
            least[at] = min(i, least.get(at, i))
    want = sorted(((i, f"{p:016x}", least.get(at)) for (i, *_), p, at in zip(rows, prints, label)), key=repr)
    assert shown(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    stay = simhash.keep_first(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.where("doc_id IS NOT NULL").collect()) == sorted(set(least.values()))
    assert stay.where("doc_id IS NULL").count() == 1
    assert simhash.near_duplicates(documents(spark, [])).count() == 0 and simhash.keep_first(documents(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (7, 7)]
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges] * 2
    found = dict(shown(components.components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- decontamination --------------------------------------------------------


def brute_cover(item, doc, least):
    """Tokens of ``item`` that greedy tiles cover: the longest common run of unmarked tokens, again and again."""
    a, b = [object() if t is None else t for t in item], list(doc)
    covered = 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and a[i + n] is not None:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return covered
        covered += n
        a[i : i + n], b[j : j + n] = [None] * n, [0.5] * n


def test_tiling_against_brute_force():
    rng = random.Random(9)
    for _ in range(60):
        item = [rng.randint(0, 6) for _ in range(rng.randint(0, 18))]
        doc = [rng.randint(0, 6) for _ in range(rng.randint(0, 25))]
        if item and rng.random() < 0.6:
            doc[3:3] = item[len(item) // 2 :] + [9] + item[: len(item) // 2]
        tiles = decontamination.tile(np.array(item, np.uint64), np.array(doc, np.uint64), 3)
        assert sum(n for _, _, n in tiles) == brute_cover(item, doc, 3)
        assert all(item[i : i + n] == doc[j : j + n] for i, j, n in tiles)


@pytest.mark.parametrize("block_bytes", [4 << 20, 200])
def test_leaks_of_whole_and_reordered_passages(spark, block_bytes):
    items = [(i, prose(700 + i, 24)) for i in range(6)] + [(6, None), (7, ""), (8, "only three words"), (9, prose(700, 24)), (None, "x")]
    items += [items[0], (None, "to say")]
    half = [items[1][1].split()[:12], items[1][1].split()[12:]]
    rows = odd_rows() + [
        (40, prose(41, 30) + " " + items[0][1].upper().replace(" ", ", ") + ". " + prose(42, 30), "en", "a"),
        (41, " ".join([*half[1], prose(43, 9), *half[0]]), "en", "a"),
        (42, " ".join(items[2][1].split()[:8]) + " " + prose(44, 40), "en", "a"),
        (43, "he has only three words to say", "en", "a"),
    ]
    docs = documents(spark, rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.find_leaks(docs, benchmark, block_bytes=block_bytes)
    assert shown(out, "doc_id", "item_id", "covered_tokens") == sorted([(40, 0, 24), (40, 0, 24), (40, 9, 24), (41, 1, 24), (43, 8, 3), (43, None, 2)], key=repr)
    clean = decontamination.keep_clean(docs, benchmark, block_bytes=block_bytes)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.where("doc_id >= 40").collect()) == [42] and clean.count() == len(rows) - 3
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_leaks(docs, empty).count() == 0 and decontamination.keep_clean(docs, empty).count() == len(rows)
    assert decontamination.find_leaks(documents(spark, []), benchmark).count() == 0


def test_document_schema_is_kept(spark):
    docs = spark.createDataFrame([(4, prose(1, 80), "en", "a", 1)], DOCUMENT)
    for kept in (quality_rules.keep(docs, None), simhash.keep_first(docs)):
        assert kept.schema == docs.schema
