"""Mixing of sources to target weights, without Python on the executors.

The words of each source form one stream, cut into blocks of fixed length. The mix is a row of slots, one
block each, grouped into output shards. A source has as many slots as its target needs; all slots of all
sources are dealt over the places of the mix by a pseudorandom permutation, so that each shard's counts of the sources are multinomial
draws conditioned on the totals, and the totals meet the targets. A source's slots
run through a pseudorandom permutation of its blocks, a second time if it is to be repeated. Slots and
blocks then meet by (source, block).

Targets: the sources in the order of their names (by code point, null last) weigh 5, 2, 1, repeating, and share 150 % of all words; a
target stops at twice its source's words, and what it can't take is shared by the others by weight.

The stream of a source is ordered by a hash bucket of doc_id and then doc_id, so that positions need only
sums per bucket and no task reads a whole source. Permutations are swap-or-not networks, computed from
the index alone.

Defined results: null and empty texts have size 0 and are taken 0 times; null is a source of its own; an empty
table gives an empty mix; repeated rows are separate documents. Sources without words have target 0.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.sources.workspace import Workspace

WEIGHTS = (5, 2, 1)
#: Words of the mix for each word of the input; words taken for each word of a source, at most.
SHARE = 1.5
LIMIT = 2
WORDS_PER_BLOCK = 128
SLOTS_PER_SHARD = 1024
BUCKETS = 4096
SLOTS_PER_CHUNK = 4096
#: Slots that one task makes, unless that were too many tasks.
SLOTS_PER_TASK = 1 << 17
MOST_TASKS = 20_000
WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 24
PRIME = (1 << 31) - 1


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Key, factor and shift of each round of a permutation."""
    keys, state = [], seed % PRIME
    for _ in range(ROUNDS):
        triple = []
        for _ in range(4):
            state = (state * 48271 + 11) % PRIME
            triple.append(state)
        keys.append((triple[0] * (1 << 30) + triple[1], triple[2] or 1, triple[3]))
    return keys


def permuted(index: Column, size: Column, tweak: Column, seed: int) -> Column:
    """A permutation of 0 .. size - 1 (Hoang, Morris and Rogaway's swap-or-not), another one for each ``tweak``."""
    names = ("key", "factor", "shift")
    rounds = F.array(*(F.struct(*(F.lit(v).cast("long").alias(n) for n, v in zip(names, k, strict=True))) for k in round_keys(seed)))

    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(r["key"], size) + F.pmod(tweak * r["factor"], size) - x, size)
        larger = F.greatest(x, other)
        mixed = F.pmod(F.pmod(larger, F.lit(PRIME)) * r["factor"] + r["shift"] + tweak, F.lit(PRIME))
        return F.when(F.pmod(F.floor(mixed / 8192), F.lit(2)) == 1, other).otherwise(x)

    return F.aggregate(rounds, index.cast("long"), step)


class Mix(NamedTuple):
    documents: DataFrame  # row, doc_id, rank, size, start: one row per document
    sources: DataFrame  # source, rank, size, target, blocks, slots
    places: DataFrame  # shard, place, rank, block, row, first_word, words: the mix


def _targets(documents: DataFrame) -> DataFrame:
    sizes = documents.groupBy("source").agg(F.sum("size").alias("size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(named).cast("long"))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", F.col("size") * float(LIMIT))
    # Filling by ratio of limit to weight: the first source that the level leaves below its limit gives the level.
    filled = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    level = (F.sum("size").over(Window.partitionBy()) * SHARE - F.sum("limit").over(filled) + F.col("limit")) / F.sum("weight").over(
        filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    levelled = ranked.withColumn("level", level)
    open_level = F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.col("level"))
    levelled = levelled.withColumn("level", F.first(open_level, ignorenulls=True).over(filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    blocks = F.ceil(F.col("size") / WORDS_PER_BLOCK)
    slots = F.when(F.col("size") > 0, F.least(blocks * LIMIT, F.round(target * blocks / F.col("size")).cast("long"))).otherwise(F.lit(0))
    counted = levelled.select("source", "rank", "size", target.alias("target"), blocks.alias("blocks"), slots.cast("long").alias("slots"))
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("first_slot", F.coalesce(F.sum("slots").over(before), F.lit(0))).withColumn("all_slots", F.sum("slots").over(Window.partitionBy()))


def mix_sources(documents: DataFrame, work: Workspace | None = None, seed: int = 20240229) -> Mix:
    """The mix of ``documents`` (doc_id, text, source); its tables are written to ``work``."""
    work = work or Workspace(documents.sparkSession)
    name = f"mix-{uuid.uuid4().hex[:8]}"
    bucket = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 3), 16, 10).cast("int")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized, _ = work.write(f"{name}-sizes", documents.select("doc_id", "source", size.alias("size"), bucket.alias("bucket")))
    sources, _ = work.write(f"{name}-sources", _targets(sized))
    ranks = sources.select(F.col("source").alias("_source"), "rank")
    ranked = sized.join(F.broadcast(ranks), sized["source"].eqNullSafe(ranks["_source"])).drop("_source", "source")

    # Positions in the stream: words of the buckets before, and words before within the bucket.
    sums = ranked.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("rank", "bucket").orderBy("doc_id", "size")
    start = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    placed = ranked.withColumn("within", start).withColumn("number", F.row_number().over(within)).join(sums, ["rank", "bucket"])
    row = F.struct("rank", "bucket", "number").alias("row")
    placed, _ = work.write(f"{name}-documents", placed.select(row, "doc_id", "rank", "size", (F.col("before") + F.col("within")).alias("start")))

    # Each block's pieces of documents.
    filled = placed.filter("size > 0").withColumn("end", F.col("start") + F.col("size"))
    covered = F.sequence(F.floor(F.col("start") / WORDS_PER_BLOCK), F.floor((F.col("end") - 1) / WORDS_PER_BLOCK))
    pieces = filled.withColumn("block", F.explode(covered))
    low = F.greatest("start", F.col("block") * WORDS_PER_BLOCK)
    high = F.least("end", (F.col("block") + 1) * WORDS_PER_BLOCK)
    pieces = pieces.select("rank", "block", "row", (low - F.col("start")).alias("first_word"), (high - low).alias("words"))

    # Slots of each source in chunks, so that a large source's slots are made by many tasks.
    chunks = sources.filter("slots > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / SLOTS_PER_CHUNK))))
    number = sources.agg(F.sum("slots")).first()[0] or 0
    chunks = chunks.repartition(min(MOST_TASKS, 1 + number // SLOTS_PER_TASK), "rank", "chunk")
    first = F.col("chunk") * SLOTS_PER_CHUNK
    slots = chunks.withColumn("slot", F.explode(F.sequence(first, F.least(first + SLOTS_PER_CHUNK, "slots") - 1)))
    at = permuted(F.col("first_slot") + F.col("slot"), F.col("all_slots"), F.lit(0).cast("long"), seed)
    block = permuted(F.pmod(F.col("slot"), F.col("blocks")), F.col("blocks"), F.col("rank"), seed + 1)
    # Written, so that the join below knows their real size.
    slots, _ = work.write(f"{name}-slots", slots.select("rank", block.alias("block"), at.alias("at")))
    dealt = slots.join(pieces, ["rank", "block"])
    shard, place = F.floor(F.col("at") / SLOTS_PER_SHARD), F.pmod(F.col("at"), F.lit(SLOTS_PER_SHARD))
    places = dealt.select(shard.alias("shard"), place.alias("place"), "rank", "block", "row", "first_word", "words")
    return Mix(placed, sources, work.write(f"{name}-places", places)[0])


def documents_of_mix(mix: Mix) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken``, the words that the mix takes of the document."""
    taken = mix.places.groupBy("row").agg(F.sum("words").alias("taken"))
    totals = mix.sources.select("rank", F.col("size").alias("source_size"), "target")
    rows = mix.documents.join(taken, "row", "left").join(F.broadcast(totals), "rank")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def texts_of_mix(mix: Mix, documents: DataFrame) -> DataFrame:
    """``shard``, ``place`` and the ``words`` of each slot, for documents with distinct ids."""
    words = documents.select("doc_id", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("all"))
    named = mix.places.join(mix.documents.select("row", "doc_id"), "row").join(words, "doc_id")
    part = F.slice("all", (F.col("first_word") + 1).cast("int"), F.col("words").cast("int"))
    pieces = named.select("shard", "place", F.struct("row", "first_word", part.alias("part")).alias("piece"))
    grouped = pieces.groupBy("shard", "place").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    return grouped.select("shard", "place", F.flatten(F.col("pieces.part")).alias("words"))
