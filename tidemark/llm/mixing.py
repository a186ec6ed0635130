"""Mixing sources to target weights, with DataFrame functions only.

Every source's words, in the order of its document ids, are packed into blocks
of ``BLOCK`` words. Sources share a budget of words by weight; a source's target
stops at ``MOST_EPOCHS`` times its size and the excess goes to the others. A
source fills as many slots as its target holds blocks. Each slot falls to an
output shard at random, so a source's counts by shard are a multinomial draw
that adds up to its slots. Slot i of a source, in epoch e = i div blocks, takes
the block at place i mod blocks of a permutation drawn for that source and
epoch, so no block is taken twice in an epoch. Each of its ``ROUNDS`` rounds
multiplies an index by a number prime to the blocks, shifts it, and may exchange
it with its mirror image (swap-or-not), which needs neither a table nor a sort.
Slots join blocks by (source, index), a key that no source can make hot.

Places within a source come from a range partition by (source, id): sums inside
a partition, then one row per partition and source. Sources are few beside
documents; their table is the only one that a single task sees whole.

Defined results: a null text has no words. A null source is a source of its own,
the last. A source without words has target 0. Rows that repeat an id are rows
of their own; which of two rows with equal id and size comes first cannot show.

An empty table gives an empty result. Columns other than those that the functions
name are not read, or pass through unread, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.checkpoints import cut

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_EPOCHS = 2
BLOCK = 64
SHARDS = 64
ROUNDS = 3
#: Slots that one row stands for before they are spread over tasks.
RUN = 1 << 14

#: Primes below 2**20, so that products with a block's number stay within 64 bits.
MULTIPLIERS = (1000003, 999983, 999979, 999961, 999959, 999953, 999931, 999917)
_PRIME = (1 << 31) - 1
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    """Runs without any of the six ASCII spaces; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD + "+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, budget: float = BUDGET, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, block: int = BLOCK) -> DataFrame:
    """source, number, source_size, target, blocks and slots of every source of ``sized`` (source, size).

    Sources are filled in the order of cap / weight. The level of the first that
    stays below its cap is that of all the rest: what resharing the excess
    again and again comes to.
    """
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    every = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spent = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sharing = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    is_open = F.col("cap") > F.col("level") * F.col("weight")
    cap, cycle = F.col("cap").cast("double"), F.array(*map(F.lit, weights))
    return (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", F.element_at(cycle, F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1))
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("level", (budget * F.sum("source_size").over(every) - spent) / sharing)
        .withColumn("open_level", F.first(F.when(is_open, F.col("level")), ignorenulls=True).over(every))
        .withColumn("target", F.least(cap, F.coalesce(F.col("open_level") * F.col("weight"), cap)))
        .withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("long"))
        .withColumn("slots", F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0).cast("long"))
        .select("source", "number", "source_size", "target", "blocks", "slots")
    )


def _rounds(runs: DataFrame, rounds: int) -> DataFrame:
    """``runs`` (number, epoch, blocks, ...) with each round's multiplier, shift and mirror.

    A multiplier is a prime that does not divide the number of blocks, so that
    multiplying by it takes no two indexes to one.
    """
    for r in range(rounds):
        primes = MULTIPLIERS[r:] + MULTIPLIERS[:r]
        coprime = F.coalesce(*[F.when(F.col("blocks") % p != 0, F.lit(p).cast("long")) for p in primes])
        seed = (F.col("number") * 1000003 + F.col("epoch") * 7919 + F.lit(r) * 104729) % _PRIME * 48271 % _PRIME
        runs = runs.withColumn(f"a{r}", coprime).withColumn(f"b{r}", seed)
        runs = runs.withColumn(f"c{r}", F.col(f"b{r}") * 69621 % _PRIME * (_PRIME + 1) + F.col(f"b{r}"))
    return runs


def permute(slots: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``slots`` (index, blocks, and the columns of ``_rounds``) with each index where its permutation takes it."""
    for r in range(rounds):
        others = [c for c in slots.columns if c not in ("index", "mirror")]
        moved = (F.col(f"a{r}") * F.col("index") + F.col(f"b{r}")) % F.col("blocks")
        slots = slots.select(*others, moved.alias("index"))
        slots = slots.select(*others, "index", F.pmod(F.col(f"c{r}") - F.col("index"), F.col("blocks")).alias("mirror"))
        coin = (F.greatest("index", "mirror") % _PRIME * 48271 + F.col(f"b{r}")) % _PRIME
        coin = F.shiftright(coin * 69621 % _PRIME, 16).bitwiseAND(1)
        slots = slots.select(*others, F.when(coin == 1, F.col("mirror")).otherwise(F.col("index")).alias("index"))
    return slots


def drawn_slots(sources: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """number, slot, shard and index (of the block that fills it) of every slot.

    Runs of slots are dealt to a set number of tasks: they weigh little as rows,
    and adaptive execution would give them all to one.
    """
    epochs = sources.where("slots > 0").select(
        F.col("number").cast("long"), "blocks", "slots", F.explode(F.expr("sequence(0L, (slots - 1) div blocks)")).alias("epoch")
    )
    epochs = epochs.withColumn("filled", F.least("blocks", F.col("slots") - F.col("epoch") * F.col("blocks")))
    runs = epochs.withColumn("run", F.explode(F.expr(f"sequence(0L, (filled - 1) div {RUN})")))
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = F.least(F.col("filled"), (F.col("run") + 1) * RUN) - 1
    slots = _rounds(runs.repartition(tasks, "number", "epoch", "run"), rounds)
    slots = slots.withColumn("place", F.explode(F.sequence(F.col("run") * RUN, end))).drop("run", "filled", "slots")
    slots = slots.withColumn("slot", F.col("epoch") * F.col("blocks") + F.col("place")).withColumnRenamed("place", "index")
    slots = permute(slots, rounds)
    return slots.select("number", "slot", F.pmod(F.xxhash64("number", "slot"), F.lit(shards)).alias("shard"), "index")


def shard_counts(slots: DataFrame) -> DataFrame:
    """How many slots each source fills in each output shard: the multinomial draw."""
    return slots.groupBy("shard", "number").agg(F.count("*").alias("slots"))


def _placed(rows: DataFrame, budget: float, weights: tuple[int, ...], most: int, block: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` (doc_id, source, size, ...) with their place in their source, and the sources."""
    ranged = cut(rows.repartitionByRange("source", "doc_id", "size").withColumn("part", F.spark_partition_id()))
    sources = cut(targets(ranged, budget, weights, most, block))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("source", "part").agg(F.sum("size").alias("n"))
    parts = parts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    parts = parts.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    parts = parts.select(F.col("source").alias("s"), F.col("part").alias("p"), "base", "number", "source_size", "target")
    before = Window.partitionBy("source", "part").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("within", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = within.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return placed.withColumn("start", F.col("base") + F.col("within")).drop("s", "p", "base", "within", "part"), sources


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """A row for each block that a document has words in: index, and the words [begin, stop) of the source."""
    end = F.col("start") + F.col("size")
    first, last = F.floor(F.col("start") / block), F.floor((end - 1) / block)
    return (
        placed.where("size > 0")
        .withColumn("index", F.explode(F.sequence(first, last)))
        .withColumn("begin", F.greatest(F.col("start"), F.col("index") * block))
        .withColumn("stop", F.least(end, (F.col("index") + 1) * block))
    )


def mix(docs: DataFrame, budget: float = BUDGET, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words the mix takes) for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long"), "source", word_count("text").alias("size"))
    placed, sources = _placed(rows, budget, weights, most, block)
    key = ["doc_id", "source", "size", "source_size", "target", "number", "start"]
    pieces = _pieces(placed, block).select(*key, "index", (F.col("stop") - F.col("begin")).alias("words"))
    times = drawn_slots(sources).groupBy("number", "index").agg(F.count("*").alias("times"))
    # Sources are few, but their slots are not: the planner must not take these for small.
    taken = pieces.join(times.hint("merge"), ["number", "index"], "left").groupBy(*key)
    taken = taken.agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    unused = placed.where("size = 0").select(*key, F.lit(0).cast("long").alias("taken"))
    return taken.unionByName(unused).select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_blocks(docs: DataFrame, budget: float = BUDGET, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, block: int = BLOCK) -> DataFrame:
    """shard, source, slot and text of every slot: the mix itself, in blocks of at most ``block`` words."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(_WORD), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("long"), "source", "text", word_count("text").alias("size"))
    placed, sources = _placed(rows, budget, weights, most, block)
    own = F.slice(words, (F.col("begin") - F.col("start") + 1).cast("int"), (F.col("stop") - F.col("begin")).cast("int"))
    pieces = _pieces(placed, block).select("number", "source", "index", "begin", F.concat_ws(" ", own).alias("words"))
    # A block has at most ``block`` pieces, each with a word or more.
    packed = pieces.groupBy("number", "source", "index").agg(F.array_sort(F.collect_list(F.struct("begin", "words"))).alias("pieces"))
    packed = packed.select("number", "source", "index", F.concat_ws(" ", "pieces.words").alias("text"))
    return drawn_slots(sources).hint("merge").join(packed, ["number", "index"]).select("shard", "source", "slot", "text")
