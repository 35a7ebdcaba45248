"""Mixing sources to target weights (DataFrame functions only).

The words of each source's documents form one stream, packed into blocks of ``block_words``. A source's target
(in words) is spent on slots: whole passes over its blocks, then a pass that ends exactly at the target.

1. Draw: every seat that the sources' targets buy is thrown into one of the output shards by hash. The seats of a source
   in a shard are its count there: a multinomial draw for each shard, conditioned on the sources' totals, so that
   targets are met to the word.
2. Slots: a shard takes as many slots of a source as its count says, the ones after those of earlier shards.
3. Permutation: every pass maps its slots through a pseudorandom permutation of the block indexes of its own
   (swap-or-not: each round swaps an index with its mirror image about a round key, or not, by a hash bit, which
   is a permutation of any size without tables, and runs backwards too).
4. Slots meet blocks by (source, block index), and documents the blocks that they lie in.

What is counted by source (one row each) is ordered in one task; everything else is dealt out by number.

Defined results: null and empty texts have size 0 and take nothing; a source whose texts are all empty has
target 0; null is a source of its own, the last one; equal rows each take part as rows of their own;
an empty table gives an empty result. Only the columns named are read, so extra columns may clash freely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Seats that one row expands into; the rows of a large source are dealt out before they expand.
CHUNK = 16_384
#: Seats and slots of a task.
TASK = 65_536
SOURCE = ["no_source", "name"]


def swap_or_not(index: Column, size: Column, key: Column, rounds: int = 20, back: bool = False) -> Column:
    """A pseudorandom permutation of 0 .. size-1, chosen by ``key``; ``back``: its inverse (each round is its own)."""

    def turn(at: Column, i: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(key, i), size) - at, size)
        return F.when(F.xxhash64(key, i, F.greatest(at, mirror)).bitwiseAND(1) == 1, mirror).otherwise(at)

    steps = F.sequence(F.lit(rounds), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(rounds))
    return F.aggregate(steps, index.cast("long"), turn)


def running_before(rows: DataFrame, key: list[str], order: list[str], group: Column, value: str, name: str) -> DataFrame:
    """rows with ``name``: the sum of ``value`` over the rows of their key that come before them, by ``group``, then ``order``.

    Groups are summed first, so that a key of most rows is ordered in parts. Rows are read twice and should be
    materialised.
    """
    rows = rows.withColumn("__group", group)
    totals = rows.groupBy(*key, "__group").agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*key).orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*key, "__group", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*key, "__group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("__within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return own.join(totals, [*key, "__group"]).withColumn(name, F.col("__before") + F.col("__within")).drop("__group", "__before", "__within")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0, share: float = 1.0) -> DataFrame:
    """sources(source, source_size) -> also weight, target: ``share`` of all words dealt by weight, at most ``most`` x the size.

    Sources by code point, null last, weigh ``weights``, repeating. The excess over a capped target is reshared
    by weight until none is above: target = min(cap, level x weight), where the sources with the smallest
    cap / weight are the capped ones. These windows run over one row per source.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(nth - 1, F.lit(len(weights))) + 1).cast("int")))
    weighed = weighed.withColumn("cap", F.col("source_size") * float(most))
    everything = Window.partitionBy(F.lit(1))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    total = F.sum("source_size").over(everything) * float(share)
    leveled = (
        weighed.withColumn("total", total)
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
        # The first source, in this order, whose cap the level doesn't reach sets the level for all that follow.
        .withColumn("nth", F.row_number().over(before))
        .withColumn("open", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("nth", "level")))
        .withColumn("final", F.min("open").over(everything)["level"])
    )
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("final") * F.col("weight")))
    return leveled.select("source", "source_size", "weight", target.alias("target"))


def sized(documents: DataFrame) -> DataFrame:
    """documents -> doc_id, source, no_source, name, size, crc: the texts are read once, here."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = [F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name")]
    size = F.regexp_count(text, F.lit(WORD)).cast("long").alias("size")
    return cut(documents.select("doc_id", "source", *key, size, F.crc32(text.cast("binary")).alias("crc")))


def with_offsets(docs: DataFrame, bucket_rows: int = 65_536) -> DataFrame:
    """Rows of ``sized`` -> also start: words of the source's stream before the document. The stream runs by hash bucket, then id."""
    buckets = max(64, -(-docs.count() // bucket_rows))
    bucket = F.pmod(F.xxhash64("doc_id", "crc"), F.lit(buckets)).cast("int")
    return running_before(docs, SOURCE, ["doc_id", "crc", "size"], bucket, "size", "start")


def draw_counts(targets: DataFrame, shard_slots: int, seed: int, parts: int) -> DataFrame:
    """targets(no_source, name, slots, all_slots) -> no_source, name, out_shard, draws: each shard's drawn source counts."""
    shards = F.ceil(F.col("all_slots") / shard_slots).cast("long")
    chunks = targets.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {CHUNK}"))))
    first = F.col("chunk") * CHUNK
    # Dealt out by number, as the optimiser would see few rows and join their partitions.
    seats = chunks.repartition(parts, *SOURCE, "chunk").withColumn("seat", F.explode(F.sequence(first, F.least(first + (CHUNK - 1), F.col("slots") - 1))))
    thrown = seats.select(*SOURCE, F.pmod(F.xxhash64(*SOURCE, "seat", F.lit(seed + 1)), shards).alias("out_shard"))
    return thrown.groupBy(*SOURCE, "out_shard").agg(F.count(F.lit(1)).alias("draws"))


def draw_slots(targets: DataFrame, block_words: int, shard_slots: int, seed: int = 0) -> DataFrame:
    """targets(no_source, name, source_size, target) -> no_source, name, out_shard, pass, slot, block, words.

    ``words``: how many of the block's words the slot takes, from its start; less than the block has in the last slot only.
    """
    length = F.lit(block_words)
    t = targets.where("source_size > 0").withColumn("wanted", F.round("target").cast("long"))
    t = t.withColumn("blocks", F.ceil(F.col("source_size") / length).cast("long")).withColumn("passes", F.expr("wanted div source_size"))
    t = t.withColumn("rest", F.col("wanted") - F.col("passes") * F.col("source_size"))
    # The last pass takes a slot more than its words fill, as it may hold the short block before its end.
    t = t.withColumn("last", F.least(F.col("blocks"), F.ceil(F.col("rest") / length) + 1).cast("long") * (F.col("rest") > 0).cast("long"))
    t = t.withColumn("slots", F.col("passes") * F.col("blocks") + F.col("last")).where("slots > 0")

    def pass_key(number: str) -> Column:
        return F.xxhash64(*SOURCE, number, F.lit(seed))

    # Where the short block (the last index) is in the last pass decides how many words come before a slot.
    t = t.withColumn("short_slot", swap_or_not(F.col("blocks") - 1, F.col("blocks"), pass_key("passes"), back=True))
    t = cut(t.withColumn("all_slots", F.sum("slots").over(Window.partitionBy(F.lit(1)))))
    total = t.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-total // TASK))
    counts = cut(draw_counts(t, shard_slots, seed, parts))
    ranges = running_before(counts, SOURCE, ["out_shard"], F.expr("out_shard div 1024"), "draws", "first").join(t, SOURCE)
    at = ranges.repartition(parts, *SOURCE, "out_shard").withColumn("n", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("draws") - 1)))
    at = at.withColumn("pass", F.expr("n div blocks")).withColumn("slot", F.col("n") % F.col("blocks"))
    at = at.withColumn("block", swap_or_not(F.col("slot"), F.col("blocks"), pass_key("pass")))
    short = length * F.col("blocks") - F.col("source_size")
    before = F.col("slot") * length - F.when(F.col("slot") > F.col("short_slot"), short).otherwise(0)
    whole = F.when(F.col("block") == F.col("blocks") - 1, length - short).otherwise(length)
    words = F.when(F.col("pass") < F.col("passes"), whole).otherwise(F.greatest(F.lit(0), F.least(whole, F.col("rest") - before)))
    at = at.withColumn("words", words.cast("long")).where("words > 0")
    return at.select(*SOURCE, "out_shard", "pass", "slot", "block", "words")


def mix(documents: DataFrame, block_words: int = 128, shard_slots: int = 8192, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """documents(doc_id, text, source) -> (per document: doc_id, source, size, crc, source_size, target, taken; the drawn slots)."""
    sizes = sized(documents)
    docs = with_offsets(sizes)
    sources = sizes.groupBy(*SOURCE, "source").agg(F.sum("size").alias("source_size"))
    goals = source_targets(sources.select("source", "source_size"), weights, most)
    goals = cut(goals.select(F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name"), "source_size", F.col("target").cast("double").alias("target")))
    slots = draw_slots(goals, block_words, shard_slots, seed)
    taken_of = slots.groupBy(*SOURCE, "block").agg(F.collect_list("words").alias("takes"))
    last = F.col("start") + F.col("size") - 1
    pieces = docs.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(F.expr(f"start div {block_words}"), F.floor(last / block_words)))))
    low = F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0))
    high = F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.lit(block_words))
    pieces = pieces.select("doc_id", *SOURCE, "source", "size", "crc", "start", "block", low.alias("low"), high.alias("high"))
    met = pieces.join(taken_of.hint("merge"), [*SOURCE, "block"], "left")  # both sides grow with the texts
    got = F.aggregate(F.coalesce("takes", F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda s, w: s + F.greatest(F.lit(0), F.least(F.col("high"), w) - F.col("low")).cast("long"))
    # Within a source, rows that have words differ in start; rows that are alike in all the key columns are counted apart.
    key = ["doc_id", *SOURCE, "source", "size", "crc", "start"]
    own = met.groupBy(*key).agg(F.coalesce(F.sum(got), F.lit(0)).alias("taken"), F.when(F.col("size") == 0, F.count(F.lit(1))).otherwise(F.lit(1)).alias("rows"))
    own = own.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows").cast("long"))))
    result = own.join(goals, SOURCE).select("doc_id", "source", "size", "crc", "source_size", "target", F.col("taken").cast("long").alias("taken"))
    return result, slots
