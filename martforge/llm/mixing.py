"""Mix sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Every source gets a target: its weight's share of all tokens, at most
   ``max_repeats`` times its own size; what is over is shared again by weight
   among the others until no target is above (a water level, found with
   window sums over the table of sources).
2. The mix has round(total / block_tokens) blocks. They are allocated to the
   sources by highest quotients target / (2 k + 1), then each source's blocks
   to its shards in the same way, by shard size, which gives an integer quota
   per shard.
3. A shard holds the documents of one source with the same seeded hash. Its
   quota is turned into words: quota times ``block_tokens``; a source at its
   cap is taken ``max_repeats`` times whole, and the rounding to whole blocks
   that a source's target leaves over goes to its largest shard. A shard's
   documents follow one another in seeded order and are cut into blocks of
   ``block_tokens`` (the last one is shorter). Its words are taken as often as
   they fit the quota whole; the rest of it is filled with blocks in the order
   of a seeded walk over all blocks, the last of them cut to what is left.

The number of shards depends on the tokens (one per ``shard_tokens``, about
``max_shards`` at most in all), so a source that holds a third of all rows is
spread over a third of the shards, and no window or table of step 2 has more
than about ``max_shards`` + 3 rows per source. Id and text choose the shard, so
rows of a null or repeated id are spread too; rows alike in both share one.

Only DataFrame and SQL functions. Defined results: a null text has size 0 and
is taken 0 times; a null source is a source of its own, the last one; repeated
rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import let, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_TOKENS = 64
SHARD_TOKENS = 1 << 15
MAX_SHARDS = 1 << 16
SEED = 20240229
_STEP = 1000000007  # a prime larger than any number of blocks in a shard: the walk visits every block once

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), 0)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   max_repeats: float = MAX_REPEATS) -> DataFrame:
    """source, source_size, nth and target of a table of (source, source_size).

    Sources in code point order (null last) weigh ``weights``, repeating. In
    the order of cap / weight the sources below the water level get their cap;
    the level is the tokens left over divided by the weights left. The table
    has one row per source, so its windows are small.
    """
    weight_list = F.array(*[F.lit(float(w)) for w in weights])
    weighed = (
        sources.withColumn("nth", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", F.element_at(weight_list, (F.col("nth") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * float(max_repeats))
    )
    rising = W.orderBy(F.col("cap") / F.col("weight"), "nth")
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    every = rising.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)

    def left(name: str) -> Column:
        return F.coalesce(F.sum(name).over(before), F.lit(0.0))

    leveled = weighed.withColumn(
        "level", (F.sum("source_size").over(every) - left("cap")) / (F.sum("weight").over(every) - left("weight")))
    free = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))
    return leveled.withColumn("water", F.first(free, ignorenulls=True).over(every)).select(
        "source", "source_size", "nth", F.least("cap", F.col("water") * F.col("weight")).alias("target"))


def apportion(units: DataFrame, group: list[str], unit: str, weight: str, seats: str) -> DataFrame:
    """Adds ``quota``: the ``seats`` of each group dealt to its units by highest quotients weight / (2 k + 1).

    A divisor a little too large gives each unit seats that it certainly has,
    one a little too small bounds them from above; only the quotients between
    the two (three per unit on average) are ranked.
    """
    over = W.partitionBy(*group)
    bounds = (
        units.filter(F.col(weight) > 0)
        .withColumn("half", F.count(F.lit(1)).over(over) / 2.0)
        .withColumn("ideal", F.col(weight) / F.sum(weight).over(over))
        .withColumn("sure", F.floor(F.col("ideal") * F.greatest(F.col(seats) - F.col("half"), F.lit(0.0)) + F.when(
            F.col(seats) > F.col("half"), 0.5).otherwise(0.0)))
        .withColumn("most", F.ceil(F.col("ideal") * (F.col(seats) + F.col("half")) + 0.5))
        .withColumn("open_seats", F.col(seats) - F.sum("sure").over(over))
    )
    ranked = (
        bounds.select(*group, unit, weight, "open_seats",
                      F.explode(F.sequence("sure", F.greatest(F.col("sure"), F.col("most") - 1))).alias("k"))
        .withColumn("quotient", F.col(weight) / (2 * F.col("k") + 1))
        .withColumn("place", F.row_number().over(over.orderBy(F.col("quotient").desc(), unit, "k")))
        .filter(F.col("place") <= F.col("open_seats"))
    )
    won = ranked.groupBy(*group, unit).agg(F.count(F.lit(1)).alias("won"))
    sure = bounds.select(*group, unit, "sure")
    quota = (F.coalesce("sure", F.lit(0)) + F.coalesce("won", F.lit(0))).cast("long")
    keys = [*group, unit]
    return (units.join(sure, keys, "left").join(won, keys, "left")
            .withColumn("quota", quota).drop("sure", "won"))


def _used(i: Column, block: int) -> Column:
    """Words at the head of block i that are taken once more: the walk's earlier blocks have had theirs of ``rest``."""
    def place(j: Column) -> Column:
        return F.pmod(j * _STEP + F.col("walk"), F.col("blocks"))

    last = F.col("blocks") - 1
    missing = F.when(place(i) > place(last), F.col("blocks") * block - F.col("room")).otherwise(F.lit(0))
    length = F.least(F.lit(block), F.col("room") - i * block)
    return F.greatest(F.lit(0), F.least(length, F.col("rest") - (place(i) * block - missing)))


def _again(i: Column, block: int) -> Column:
    """Words of a document in block i of its shard that are taken once more."""
    return F.greatest(F.lit(0), F.least(F.col("start") + F.col("size"), i * block + _used(i, block)) - F.greatest(
        F.col("start"), i * block))


def _blocks(block: int) -> Column:
    first = F.floor(F.col("start") / block)
    return F.sequence(first, F.greatest(first, F.floor((F.col("start") + F.col("size") - 1) / block)))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, block_tokens: int = BLOCK_TOKENS,
             seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken and where its blocks lie.

    ``mark`` is a hash of its text, ``start`` its place in its shard, ``whole``
    how often the shard is taken whole, and ``walk``, ``blocks``, ``room`` (the
    shard's words) and ``rest`` say which words are taken once more.
    """
    sizes = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("mark")),
                    "mix_sizes")
    sources = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats)
    one = W.partitionBy("mix")
    total = F.sum("source_size").over(one)
    shard_tokens = F.greatest(F.lit(float(SHARD_TOKENS)), total / MAX_SHARDS)
    sources = (
        sources.withColumn("mix", F.lit(0))
        .withColumn("mix_blocks", F.round(total / block_tokens).cast("long"))
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_tokens)).cast("long"))
    )
    sources = written(apportion(sources, ["mix"], "nth", "target", "mix_blocks").withColumnRenamed(
        "quota", "source_blocks"), "mix_sources")

    shard = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("mark")), F.col("shards"))
    of_source = sources.select(F.col("source").alias("key"), "source_size", "nth", "target", "source_blocks", "shards")
    dealt = sizes.join(of_source, sizes["source"].eqNullSafe(of_source["key"]), "inner").drop("key").withColumn(
        "shard", shard)
    of_shard = ["nth", "shard", "source_size", "target", "source_blocks"]
    shards = dealt.groupBy(*of_shard).agg(F.sum("size").alias("room"))
    shards = apportion(shards, ["nth"], "shard", "room", "source_blocks")
    largest = F.row_number().over(W.partitionBy("nth").orderBy(F.col("room").desc(), "shard")) == 1
    left_over = F.round("target").cast("long") - F.col("source_blocks") * block_tokens
    dealt_words = F.col("quota") * block_tokens + F.when(largest, left_over).otherwise(F.lit(0))
    most = F.col("room") * max_repeats
    words = F.when(F.col("target") >= F.col("source_size") * max_repeats, most).otherwise(
        F.greatest(F.lit(0), F.least(dealt_words, most)))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("room") / block_tokens)).cast("long")
    full = F.when(F.col("room") > 0, F.floor(F.col("words") / F.col("room"))).otherwise(F.lit(0)).cast("long")
    shards = shards.withColumn("blocks", blocks).withColumn("words", words).withColumn("whole", full).select(
        "nth", "shard", "room", "blocks", "whole", (F.col("words") - F.col("whole") * F.col("room")).alias("rest"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "nth", "shard"), F.col("blocks")).alias("walk"))

    seeded = W.partitionBy("nth", "shard").orderBy(
        F.xxhash64(F.lit(seed + 2), F.col("doc_id").cast("string")), "doc_id", "mark", "size")
    placed = dealt.withColumn("start", F.sum("size").over(seeded) - F.col("size"))
    joined = placed.join(shards, ["nth", "shard"], "left")
    again = F.aggregate(_blocks(block_tokens), F.lit(0).cast("long"), lambda n, i: n + _again(i, block_tokens))
    taken = F.when(F.col("size") > 0, F.col("whole") * F.col("size") + again).otherwise(F.lit(0).cast("long"))
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "mark",
                         "start", "whole", "rest", "walk", "blocks", "room")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    block_tokens: int = BLOCK_TOKENS, **options) -> DataFrame:
    """The mix itself: the documents' columns, one row for each time that words of a document are taken.

    A row that is taken whole keeps its text; else its text is its taken
    words, in order, joined by spaces. Rows that share an id, a source and a
    text share their plan too.
    """
    plan = mix_plan(docs, id_col, text_col, source_col, block_tokens=block_tokens, **options)
    plan = plan.filter(F.col("taken") > 0).select(
        F.struct("source", "size", "mark").alias("mix_key"), F.col("doc_id").alias("mix_id"), "start", "size", "taken",
        "whole", "rest", "walk", "blocks", "room").dropDuplicates(["mix_id", "mix_key"])
    # the documents travel as one column, whatever their columns are called
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.struct(F.col(source_col).cast("string").alias("source"),
                                word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("mark")).alias("key"))
    joined = rows.join(plan, rows["id"].eqNullSafe(plan["mix_id"]) & (F.col("key") == F.col("mix_key")), "inner")
    copies = joined.withColumn("partly", F.col("taken") - F.col("whole") * F.col("size")).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), (F.col("whole") + (F.col("partly") > 0).cast("long")).cast("int"))))
    picked = let(F.regexp_extract_all(F.col("text"), F.lit(WORD), 0), lambda words: F.flatten(F.transform(
        F.filter(_blocks(block_tokens), lambda i: _again(i, block_tokens) > 0), lambda i: F.slice(
            words, (F.greatest(F.col("start"), i * block_tokens) - F.col("start") + 1).cast("int"),
            _again(i, block_tokens).cast("int")))))
    cut = (F.col("copy") > F.col("whole")) & (F.col("partly") < F.col("size"))
    mixed = F.when(cut, F.array_join(picked, " ")).otherwise(F.col("text"))
    return copies.select(*[mixed.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
