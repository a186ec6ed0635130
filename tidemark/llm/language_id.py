"""Language identification: whole words first, shorter character n-grams for unseen ones.

Words are runs of letters, lowered. A language's model holds the log10 relative
frequency of its words, and of the character n-grams (n = ``MOST_N`` down to 1)
of its words with a boundary mark at either end. A known word scores its log
frequency; an unseen word scores the mean of its n-grams of the greatest length
of which at least one is known. What a language lacks costs it ``penalty``. The
sums over a text's words are compared. The score is the share of the best
language among all, times how familiar the text is to it: over its words, one
for each that the language is known to have, and for the others the share of
their longest n-grams that it has. That does not grow with a text's length: a
long text in an unlearned language, or of noise, stays low.

All training texts are counted. A model keeps what makes up at least ``SHARE``
of its language's words, or of its n-grams of one length: at most 1 / SHARE
entries for each of these, whatever the corpus holds, which bounds what reaches
the driver and is broadcast.

Defined results: a null text, or one without letters, is ``und`` with score 0.
Training rows without a text or a language teach nothing. Without any training
row every text is ``und``. A text in letters no model knows gets the language
with the most training words, at score 0. Of languages that tie, the one
with the most training words wins, then the first by name. Repeated rows are
counted and answered as often as they stand there.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.checkpoints import cut
from tidemark.llm.text_bytes import Chunk, chunks, mix, prefix_hash, span_hash, spans

UNKNOWN = "und"
SHARE = 2e-5
MOST_N = 4
#: log10 units below the rarest thing a model may hold.
BELOW_RAREST = 1.0
#: Words for which counts are held before they are passed on.
HELD = 1 << 18

_PAD = 1


class Grams(NamedTuple):
    """Sorted hashes and, for each, a row of scores by language."""

    hashes: np.ndarray
    scores: np.ndarray


class Model(NamedTuple):
    langs: list[str]
    words: Grams
    grams: dict[int, Grams]
    penalty: float


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Documents that never teach: crc32 of the id as text is 2 modulo 4. A null id may teach."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _lower_letters(points: np.ndarray) -> np.ndarray:
    """Each code point lowered, or 0 if it is no letter."""
    out = np.zeros_like(points)
    small = np.array([_lower(i) for i in range(0x600)], np.uint32)
    low = points < len(small)
    out[low] = small[points[low]]
    if not low.all():
        seen, inverse = np.unique(points[~low], return_inverse=True)
        out[~low] = np.array([_lower(int(i)) for i in seen], np.uint32)[inverse]
    return out


def _lower(point: int) -> int:
    char = chr(point)
    if not char.isalpha():
        return 0
    low = char.lower()
    return ord(low) if len(low) == 1 else point


class Words(NamedTuple):
    """The words of a chunk, each after a boundary mark: letters, starts, ends, texts."""

    letters: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray


def letter_words(chunk: Chunk) -> Words:
    points = np.frombuffer(chunk.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first_bytes = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
    lowered = _lower_letters(points)
    starts, ends, text = spans(lowered != 0, first_bytes[chunk.offsets])
    sizes = ends - starts
    begin = np.cumsum(sizes + 1) - sizes
    letters = np.full(int((sizes + 1).sum()) + 1, _PAD, np.uint32)
    at = np.flatnonzero(lowered)
    letters[np.arange(len(at)) + np.repeat(np.arange(len(sizes)), sizes) + 1] = lowered[at]
    return Words(letters, begin, begin + sizes, text)


def gram_windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and word number of every n-gram of the words with their boundary marks."""
    size = words.ends - words.starts + 2
    count = np.maximum(size - n + 1, 0)
    start, step = words.starts - 1, np.zeros(len(size), np.int64)
    if n == 1:  # the marks alone say nothing
        count, step = size - 2, step + 1
    word = np.repeat(np.arange(len(size)), count)
    return np.repeat(start + step, count) + np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count), word


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all of ``docs`` (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], int] = {}
        for batch in batches:
            codes = batch.column(1).dictionary_encode()
            names, code = codes.dictionary.to_pylist(), np.asarray(codes.indices)
            for chunk in chunks(batch.column(0)):
                words = letter_words(chunk)
                if not len(words.starts):
                    continue
                lang = code[chunk.first : chunk.last][words.text]
                key = mix(span_hash(prefix_hash(words.letters), words.starts, words.ends) + lang.astype(np.uint64))
                _, first, n = np.unique(key, return_index=True, return_counts=True)
                body = words.letters.tobytes().decode("utf-32-le")
                for at, times in zip(first.tolist(), n.tolist()):
                    own = names[lang[at]], body[words.starts[at] : words.ends[at]]
                    held[own] = held.get(own, 0) + times
                if len(held) > HELD:
                    yield _counted(held)
                    held = {}
        if held:
            yield _counted(held)

    parts = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    return parts.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _counted(held: dict[tuple[str, str], int]) -> pa.RecordBatch:
    langs, words = zip(*held)
    arrays = [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["lang", "word", "n"])


def gram_counts(words: DataFrame, most_n: int = MOST_N) -> DataFrame:
    """(lang, size, gram, n): how often the counted words (lang, word, n) hold each n-gram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            langs, code, times = codes.dictionary, np.asarray(codes.indices), np.asarray(batch.column(2))
            for chunk in chunks(batch.column(1)):
                found = letter_words(chunk)
                if not len(found.starts):
                    continue
                prefix = prefix_hash(found.letters)
                lang, weight = (x[chunk.first : chunk.last][found.text] for x in (code, times))
                for n in range(1, most_n + 1):
                    at, word = gram_windows(found, n)
                    gram = span_hash(prefix, at, at + n)
                    _, first, inverse = np.unique(mix(gram + lang[word].astype(np.uint64)), return_index=True, return_inverse=True)
                    sums = np.bincount(inverse, weight[word]).astype(np.int64)
                    arrays = [
                        langs.take(pa.array(lang[word][first])), pa.array(np.full(len(first), n, np.int32)),
                        pa.array(gram[first].view(np.int64)), pa.array(sums),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["lang", "size", "gram", "n"])

    parts = words.select("lang", "word", "n").mapInArrow(count, "lang string, size int, gram long, n long")
    return parts.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


def _grams(rows: list, langs: dict[str, int], totals: dict[str, int], penalty: float) -> Grams:
    """Scores of (hash, lang, n) rows."""
    hashes = np.unique(np.array([r[0] for r in rows], np.int64).view(np.uint64))
    scores = np.full((len(hashes), len(langs)), -penalty, np.float32)
    for gram, lang, n in rows:
        scores[np.searchsorted(hashes, np.uint64(gram % (1 << 64))), langs[lang]] = np.log10(n / totals[lang])
    return Grams(hashes, scores)


def train(docs: DataFrame, share: float = SHARE, most_n: int = MOST_N) -> Model | None:
    """A model of the languages of ``docs`` (text, lang); None if there are none."""
    counts = cut(word_counts(docs))
    totals = {lang: n for lang, n in counts.groupBy("lang").agg(F.sum("n")).collect()}
    if not totals:
        return None
    names = sorted(totals, key=lambda lang: (-totals[lang], lang))
    langs = {lang: i for i, lang in enumerate(names)}
    penalty = BELOW_RAREST - np.log10(share)

    def frequent(rows: DataFrame, key: list[str]) -> DataFrame:
        sums = rows.groupBy(*key).agg(F.sum("n").alias("total"))
        return rows.join(sums, key).where(F.col("n") >= F.col("total") * share)

    rows = frequent(counts, ["lang"]).select("word", "lang", "n").collect()
    spelled = pa.array([r[0] for r in rows], pa.string())
    hashes = np.concatenate([np.zeros(0, np.uint64), *[_word_hashes(chunk) for chunk in chunks(spelled)]]).view(np.int64)
    words = _grams([(int(h), r[1], r[2]) for h, r in zip(hashes, rows)], langs, totals, penalty)
    by_size: dict[int, list] = {n: [] for n in range(1, most_n + 1)}
    sums: dict[tuple[int, str], int] = {}
    for size, gram, lang, n, total in (
        frequent(cut(gram_counts(counts, most_n)), ["lang", "size"]).select("size", "gram", "lang", "n", "total").collect()
    ):
        by_size[size].append((gram, lang, n))
        sums[size, lang] = total
    grams = {n: _grams(by_size[n], langs, {lang: sums.get((n, lang), 1) for lang in langs}, penalty) for n in by_size}
    return Model(names, words, grams, penalty)


def _word_hashes(chunk: Chunk) -> np.ndarray:
    words = letter_words(chunk)
    return span_hash(prefix_hash(words.letters), words.starts, words.ends)


def _find(grams: Grams, hashes: np.ndarray) -> np.ndarray:
    """Row of each hash, or -1."""
    if not len(grams.hashes):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(grams.hashes, hashes), len(grams.hashes) - 1)
    return np.where(grams.hashes[at] == hashes, at, -1)


def identify(model: Model | None, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language number (-1: none) and score of every text of a column."""
    best, score = np.full(len(column), -1), np.zeros(len(column))
    if model is None:
        return best, score
    for chunk in chunks(column):
        words = letter_words(chunk)
        n, n_langs = chunk.last - chunk.first, len(model.langs)
        prefix = prefix_hash(words.letters)
        row = _find(model.words, span_hash(prefix, words.starts, words.ends))
        known = row >= 0
        sums, familiar = np.zeros((n, n_langs)), np.zeros((n, n_langs))
        for lang in range(n_langs):
            scores = model.words.scores[row[known], lang]
            sums[:, lang] = np.bincount(words.text[known], scores, n)
            familiar[:, lang] = np.bincount(words.text[known], scores > -model.penalty, n)
        rest = np.flatnonzero(~known)
        longest = max(model.grams)
        for size in sorted(model.grams, reverse=True):
            left = Words(words.letters, words.starts[rest], words.ends[rest], words.text[rest])
            at, word = gram_windows(left, size)
            row = _find(model.grams[size], span_hash(prefix, at, at + size))
            found = row >= 0
            hits, all_grams = np.bincount(word[found], minlength=len(rest)), np.bincount(word, minlength=len(rest))
            for lang in range(n_langs):
                scores = model.grams[size].scores[row[found], lang]
                total = np.bincount(word[found], scores, len(rest))
                if size == longest:
                    has = np.bincount(word[found], scores > -model.penalty, len(rest)) / np.maximum(all_grams, 1)
                    familiar[:, lang] += np.bincount(left.text, has, n)
                mean = (total - model.penalty * (all_grams - hits)) / np.maximum(all_grams, 1)
                sums[:, lang] += np.bincount(left.text[hits > 0], mean[hits > 0], n)
            rest = rest[hits == 0]
        n_words = np.bincount(words.text, minlength=n)
        top = sums.argmax(1)
        odds = np.power(10.0, sums - sums.max(1, keepdims=True)).sum(1)
        own = familiar[np.arange(n), top] / np.maximum(n_words, 1)
        best[chunk.first : chunk.last] = np.where(n_words > 0, top, -1)
        score[chunk.first : chunk.last] = np.where(n_words > 0, np.clip(own / odds, 0, 1), 0)
    return best, score


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*(shared.value.langs if shared.value else []), UNKNOWN])
        for batch in batches:
            best, score = identify(shared.value, batch.column(2))
            best = np.where(best < 0, len(names) - 1, best)
            arrays = [batch.column(0), batch.column(1), names.take(pa.array(best)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(answer, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` in a language of the model, with a score of at least ``least``; columns as they are.

    Without a model nothing tells languages apart, and every row stays.
    """
    if model is None:
        return docs
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = identify(shared.value, batch.column(at))
            yield batch.filter(pa.array((best >= 0) & (score >= least)))

    return docs.mapInArrow(passing, docs.schema)
