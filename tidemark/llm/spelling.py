"""Spelling variants: words one edit apart, found through a variable-length gram index.

Words are counted over all texts. Between two marks, a word has a gram at every
place: the shortest run of ``LEAST`` to ``MOST`` code points from there that is
rare, or else the longest that fits. A run is rare up to one in ``COMMON`` of all
places. The gram dictionary holds the runs that are not rare, each with its
count, and the grams they extend to; it is pruned while it is counted, length by
length, as only runs that extend a frequent one are kept. Where a gram ends
depends on its own code points alone, so an edit changes just the grams that
cover it: of a word at most as many as cover one place (its affected bound,
``MOST`` at the most). All others stand in every word that is one edit away.

So of the grams of a word, in order of rarity, the first (bound + 1) hold one of
any near word's, and the first (bound + 2) two, as at least two are left; the
rarest that is left is also the rarest left of the other word, at the same place
or one off. Words are listed by (gram, length class); a list above ``LIST`` words is dealt anew by
pairs of grams, which finds the same words. Within a list, of words sorted by
place, pairs are merged by the bits of their grams: as many as the affected bound
allows may be missing on either side. What is left is verified letter by letter.
A list that stays above ``SHARD`` words is dealt in shards, each against each, so
no list is one task's alone; none is cut.

Words are of code points below 256, as the runs are.

Defined results: a null text has no words, a null id counts as an empty one in
the sum that picks altered words. Rows count as often as they stand there. Of
near words with equal counts the smallest in code-point order is the form.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.checkpoints import cut

WORD = "([A-Za-zÀ-ÿ]+)"
ALTERED = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: Code points of a gram.
LEAST, MOST = 2, 4
#: A run of code points is frequent from one in so many places of all words on.
COMMON = 1 << 12
#: Words of a list before pairs of grams take its place; of a shard.
LIST = 256
SHARD = 2048
#: Pairs compared at a time; longer words are compared one by one.
PAIRS = 1 << 18
WIDE = 48
#: Marks before and after a word.
BEGIN, END = "\x02", "\x03"


def word_counts(docs: DataFrame, altered: int = ALTERED, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of ``docs`` (doc_id, text) that are long and frequent enough."""
    run = F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(1)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    # Lowering whole runs is much faster, and the same where all letters are ASCII.
    ascii_ = F.octet_length("run") == F.length("run")
    low = F.when(ascii_, F.lower("run")).otherwise(F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    lowered = runs.select("id", low.alias("run"))
    sum_ = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = F.pmod(sum_, F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = lowered.select(F.when(sum_ % altered == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where((F.col("n") >= least_count) & (F.length("word") >= least_length))


# -- grams ------------------------------------------------------------------


class Gram(NamedTuple):
    """Its rank by rarity, whether it is frequent, and its bit."""

    rank: int
    frequent: bool
    bit: int


def gram_dictionary(words: DataFrame, common: int = COMMON) -> dict[str, Gram]:
    """The pruned dictionary: runs of LEAST to MOST code points of ``words`` (word).

    Runs longer than LEAST are in it if the run without its last code point is
    frequent. Fewer than ``common`` runs of a length are frequent, and a run
    extends to as many as there are letters: that bounds the dictionary.
    """
    marked = words.select(F.concat(F.lit(BEGIN), "word", F.lit(END)).alias("word"))
    least = marked.agg(F.coalesce(F.sum(F.length("word")), F.lit(0))).first()[0] / common
    found: dict[str, int] = {}
    frequent: list[str] = []
    for length in range(LEAST, MOST + 1):
        places = F.explode(F.sequence(F.lit(1), F.length("word") - (length - 1)))
        runs = marked.select("word", places.alias("at")).select(F.substring("word", F.col("at"), F.lit(length)).alias("run"))
        if length > LEAST:
            known = words.sparkSession.createDataFrame([(r,) for r in frequent], "start string")
            runs = runs.join(F.broadcast(known), F.substring("run", 1, length - 1) == F.col("start"), "left_semi")
        new = dict(runs.groupBy("run").count().collect())
        found |= new
        frequent = [r for r, n in new.items() if n > least]
        if not frequent:
            break
    order = sorted(found, key=lambda r: (found[r], r))
    return {r: Gram(rank, found[r] > least, 1 << zlib.crc32(r.encode()) % 64) for rank, r in enumerate(order)}


def grams(word: str, dictionary: dict[str, Gram]) -> tuple[list[Gram], int]:
    """The grams of a word by place, and how many of them one edit can change at most."""
    marked = BEGIN + word + END
    found, cover = [], [0] * (len(marked) + 1)
    for at in range(len(marked) - LEAST + 1):
        end = at + LEAST
        gram = dictionary[marked[at:end]]
        while gram.frequent and end - at < MOST and end < len(marked):
            end += 1
            gram = dictionary[marked[at:end]]
        found.append(gram)
        cover[at] += 1
        cover[end] -= 1
    bound = depth = 0
    for change in cover[:-2]:  # an edit meets the marks only beside a letter
        depth += change
        bound = max(bound, depth)
    return found, bound


# -- lists ------------------------------------------------------------------

_LISTED = "key long, size int, word binary, n long, at int, bits long, bound int"


def _listed(words: DataFrame, dictionary, by_pairs: bool) -> DataFrame:
    """Rows of ``words`` (word, n) in the lists of one gram, or of two.

    A size class is an even length and the next two, so two lengths that differ
    by one have a class in common, and odd ones just one.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dictionary.value
        for batch in batches:
            keys, places, times, every_bits, bounds, sizes = [], [], [], [], [], []
            texts = batch.column(0).to_pylist()
            for word in texts:
                found, bound = grams(word, known)
                bits = 0
                for gram in found:
                    bits |= gram.bit
                order = sorted([(gram.rank, at) for at, gram in enumerate(found)])[: bound + 1 + by_pairs]
                if by_pairs:
                    order = [((a << 32) + b, at) for (a, at), (b, _) in combinations(order, 2)]
                keys += [key for key, _ in order]
                places += [at for _, at in order]
                times.append(len(order))
                every_bits.append(bits)
                bounds.append(bound)
                sizes.append(len(word))
            own = np.repeat(np.arange(len(texts)), times)
            length = np.array(sizes, np.int64)[own]
            at = np.concatenate([np.arange(len(own)), np.flatnonzero(length % 2 == 0)])  # even lengths stand in two classes
            size = length[at] // 2
            size[len(own) :] -= 1
            row = own[at]
            word = pa.array([w.encode("latin-1") for w in texts], pa.binary()).take(pa.array(row))
            columns = [
                np.array(keys, np.int64)[at], size.astype(np.int32), word, batch.column(1).take(pa.array(row)), np.array(places, np.int32)[at],
                np.array(every_bits, np.uint64).view(np.int64)[row], np.array(bounds, np.int32)[row],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], _LISTED.replace(",", "").split()[::2])

    return words.select("word", "n").mapInArrow(listed, _LISTED)


def _letters(words: pa.Array, rows: np.ndarray) -> np.ndarray:
    """The letters of these rows' words, one byte each, with zeros behind and at least one at the end."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)[rows]
    out = np.zeros((len(rows), WIDE + 1), np.uint8)
    n = lengths.sum()
    within = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(rows)), lengths), within] = data[np.repeat(offsets[rows], lengths) + within]
    return out


def _near(rows: pa.Table) -> pa.RecordBatch:
    """Pairs (a, b) one edit apart, each way, of rows sorted by (list, at), with b's count."""
    rows = rows.combine_chunks()
    column = lambda name: rows.column(name).chunk(0)
    key, size, tree, side, at, bits, bound, member, asks = (
        column(c).to_numpy(zero_copy_only=False) for c in ("key", "size", "tree", "side", "at", "bits", "bound", "member", "asks")
    )
    words, bits = column("word"), bits.view(np.uint64)
    lengths = np.diff(np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]).astype(np.int64)
    new = (key[1:] != key[:-1]) | (size[1:] != size[:-1]) | (tree[1:] != tree[:-1]) | (side[1:] != side[:-1])
    # Partners stand after a row, in its list, at its place or the next.
    spot = np.concatenate([[0], np.cumsum(new)]) * (1 << 32) + at
    n = np.searchsorted(spot, spot + 1, "right") - np.arange(len(spot)) - 1
    ends = np.cumsum(n)
    ones, others = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    low = 0
    while low < len(n):
        high = max(int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIRS, "right")), low + 1)
        a = np.repeat(np.arange(low, high), n[low:high])
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n[low:high]) - n[low:high], n[low:high])
        low = high
        fits = np.bitwise_count(bits[a] & ~bits[b]) <= bound[a]
        a, b = a[fits], b[fits]
        fits = np.bitwise_count(bits[b] & ~bits[a]) <= bound[b]
        fits &= np.abs(lengths[a] - lengths[b]) <= 1
        # Two of the greatest length of a class meet in their other one.
        fits &= (lengths[a] + lengths[b]) < 4 * size[a] + 4
        fits &= (member[a] & asks[b]) | (asks[a] & member[b])
        a, b = a[fits], b[fits]
        near = one_edit(words, lengths, a, b)
        ones += [a[near], b[near]]
        others += [b[near], a[near]]
    one, other = pa.array(np.concatenate(ones)), pa.array(np.concatenate(others))
    return pa.RecordBatch.from_arrays([words.take(one), words.take(other), column("n").take(other)], ["a", "b", "n"])


def one_edit(words: pa.Array, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of words (in Latin-1) differ by exactly one inserted, deleted or replaced letter."""
    near = np.zeros(len(a), bool)
    swap = lengths[a] > lengths[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    long_ = lengths[b] > WIDE
    for i in np.flatnonzero(long_).tolist():
        near[i] = _one_edit(words[a[i]].as_py(), words[b[i]].as_py())
    rest = np.flatnonzero(~long_)
    if not len(rest):
        return near
    rows, place = np.unique(np.concatenate([a[rest], b[rest]]), return_inverse=True)
    letters = _letters(words, rows)
    short, more = letters[place[: len(rest)]], letters[place[len(rest) :]]
    own, longer = lengths[a[rest]], lengths[b[rest]]
    differ = short != more
    first = np.where(differ.any(1), differ.argmax(1), own)
    # Past the first difference the longer word is one letter ahead.
    place = np.arange(letters.shape[1])[None]
    moved = ((short[:, :-1] != more[:, 1:]) & (place >= first[:, None])[:, :-1] & (place < own[:, None])[:, :-1]).any(1)
    near[rest] = np.where(own == longer, differ.sum(1) == 1, ~moved)
    return near


def _one_edit(short: bytes, more: bytes) -> bool:
    at = next((i for i, (x, y) in enumerate(zip(short, more)) if x != y), len(short))
    if len(short) == len(more):
        return at < len(short) and short[at + 1 :] == more[at + 1 :]
    return short[at:] == more[at + 1 :]


def _pairs(listed: DataFrame, lists: DataFrame, shard: int) -> DataFrame:
    """Near pairs (a, b, n) of rows that stand in one of ``lists`` (key, size, rows)."""
    dealt = (
        listed.join(lists.where("rows > 1"), ["key", "size"])
        .withColumn("shards", F.ceil(F.col("rows") / F.lit(shard)).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("word"), F.col("shards")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .select(
            "key", "size", F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("side"),
            "word", "n", "at", "bits", "bound", F.expr("own <= other").alias("member"), F.expr("own >= other").alias("asks"),
        )
        .repartition("key", "size", "tree", "side")
        .sortWithinPartitions("key", "size", "tree", "side", "at")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            same = np.ones(batch.num_rows, bool)
            for i in range(4):
                values = batch.column(i).to_numpy()
                same &= values == values[-1]
            # Rows before the last list complete the lists that are held.
            last = 0 if same.all() else batch.num_rows - int(np.argmin(same[::-1]))
            if last and sum(b.num_rows for b in held) + last >= PAIRS // 4:
                yield _near(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = [batch.slice(last)]
            else:
                held.append(batch)
        if held:
            yield _near(pa.Table.from_batches(held))

    return dealt.mapInArrow(search, "a binary, b binary, n long")


def _lengths(listed: DataFrame) -> DataFrame:
    return cut(listed.groupBy("key", "size").agg(F.count("*").alias("rows")))


def near_pairs(words: DataFrame, common: int = COMMON, most: int = LIST, shard: int = SHARD) -> DataFrame:
    """Pairs (a, b), each way, of distinct ``words`` (word, n) that are one edit apart, with b's n.

    The words' code points are below 256; ``a`` and ``b`` are in Latin-1.
    """
    dictionary = words.sparkSession.sparkContext.broadcast(gram_dictionary(words, common))
    single = cut(_listed(words, dictionary, False))
    lists = _lengths(single)
    long_ = lists.where(F.col("rows") > most).select("key", "size")
    # Of a pair of grams the first is the rarer, the one whose list was long.
    again = single.join(long_, ["key", "size"], "left_semi").select(F.decode("word", "ISO-8859-1").alias("word"), "n").distinct()
    double = _listed(again, dictionary, True).withColumn("first", F.shiftright("key", 32))
    double = cut(double.join(long_.withColumnRenamed("key", "first"), ["first", "size"], "left_semi").drop("first"))
    found = _pairs(single, lists.where(F.col("rows") <= most), shard).union(_pairs(double, _lengths(double), shard))
    return found.distinct()


# -- forms ------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): where following forms ends. Each round doubles the steps taken.

    A form stands for at least twice its word's count, so there are no circles
    and no more rounds than the logarithm of that of the largest count.
    """
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = cut(at.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        moved = step.where("moved").limit(1).count()
        at = step.select("word", "root")
        if not moved:
            return at


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n for every row of ``words`` (word, n; distinct words)."""
    words = cut(words.select("word", "n"))
    text = F.decode("b", "ISO-8859-1")
    near = near_pairs(words).groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), text.alias("word"))).alias("best"))
    best = near.select(F.decode("a", "ISO-8859-1").alias("word"), "n_near", "best")
    most = -F.col("best.n")
    is_form: Column = most >= 2 * F.col("n")
    found = cut(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, most).alias("form_n"),
        )
    )
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
