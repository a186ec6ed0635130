"""Spelling variants against every pair of words, and on rows of every kind."""

import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.samples import documents, odd_rows, prose
from tidemark.llm import spelling


def brute_words(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            counts[word[: h % len(word)] + word[h % len(word) + 1 :] if h % 97 == 0 else word] += 1
    return {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts.get(form[w]))
    return out


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def clustered(seed, n, letters="abé"):
    """Words of few letters, so that very many are one edit apart and grams repeat."""
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randint(5, 9))) for _ in range(n)}
    return {w: rng.randint(3, 60) for w in sorted(words)}


@pytest.mark.parametrize("common, most, shard", [(4096, 256, 2048), (4, 3, 2), (1, 10**6, 7), (64, 1, 50)])
def test_variants_are_those_of_all_pairs(spark, common, most, shard, monkeypatch):
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (common, most, shard))
    counts = clustered(common, 400) | {"z" * 60: 3, "z" * 61: 9, "z" * 59 + "y": 4, "abcde": 3, "xabcde": 6, "abcdex": 6}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(spelling.variants(words)) == brute_variants(counts)


def test_grams_left_by_an_edit_stand_in_the_other_word(spark):
    counts = clustered(7, 500, "abcd")
    dictionary = spelling.gram_dictionary(spark.createDataFrame([(w,) for w in counts], "word string"), 40)
    assert any(g.frequent for g in dictionary.values()) and not all(g.frequent for g in dictionary.values())
    assert sorted(g.rank for g in dictionary.values()) == list(range(len(dictionary)))
    grams = {w: spelling.grams(w, dictionary) for w in counts}
    for a in counts:
        for b in counts:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                lost = Counter(grams[a][0]) - Counter(grams[b][0])
                assert sum(lost.values()) <= grams[a][1] <= len(grams[a][0]) - 2


def test_words_of_whole_texts(spark):
    rows = odd_rows() + [(30 + i, f"Straße Straße straße {prose(5, 300)} Élan élan ÉLAN×÷ naïve_naïve naïve", "en", "a") for i in range(60)]
    counts = {r.word: r.n for r in spelling.word_counts(documents(spark, rows)).collect()}
    assert counts == brute_words(rows) and len(counts) > 50
    assert found(spelling.variants(spelling.word_counts(documents(spark, rows)))) == brute_variants(counts)


def test_no_rows_and_no_words(spark):
    for rows in ([], [(1, None, None, None), (None, "", None, None), (2, "1234 ab", None, None)]):
        assert spelling.variants(spelling.word_counts(documents(spark, rows))).count() == 0
