"""Quotation links between messages, without Python on the executors.

Lines that begin with ``>`` are quoted, as many levels deep as they have of it. A passage is a run of lines of one level without blank lines
between; white space is evened out and case ignored before it is hashed. A quoted passage links to the
earliest message of the same conversation that holds a passage of its own with the same hash, if that is earlier than the quoting one.
With ``parts``, a quoted passage of n lines also links to any n neighbouring lines of an own passage that are alike line by line. Runs are
made for those n only that some quoted passage of the conversation has. A run is known by the hashes of two overlapping blocks of 2^k
lines, and the blocks of 2^k lines by those of half as many, so a message of any number of lines takes time in proportion to its lines
and the numbers of lines quoted in its conversation. Lines that announce a quotation belong to no own passage.
A message replies to the latest message that its outermost linked quotations come from. Following replies upwards gives
the message that began the thread; a conversation in reply order lists its threads by their first message, and the messages of
a thread by turn, so a message comes after the one that it replies to. Messages that
quote nothing known belong to the thread of the conversation itself, which comes first.

Lines are rows of their own; no group larger than a message is gathered: originals are the minimum of a hash, positions are sums over blocks of turns, and
replies are followed by doubling over written tables.

Defined results: a null text has no passage and stays null, and texts without quotations stay as they are; a message of quotations alone has an empty text. Messages without conversation or turn link to nothing and
have no position. Repeated messages are kept; they share their links and follow each other. Only turns that come later can quote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.sources.workspace import Workspace

QUOTED = r"^(?:[ \t]*>)+[ \t]?"
#: A line that announces a quotation; dropped where the message quotes.
ANNOUNCED = r"(?i)^on .* wrote:[ \t]*$"
TURNS_PER_BLOCK = 4096


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def message_lines(messages: DataFrame) -> DataFrame:
    """A row per line of the keyed messages: ``no``, ``level``, ``body``, ``kept`` (part of the own text) and the number of its passage, null for none."""
    lines = messages.select("_row", "conv_id", "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\r\n|\n|\r")).alias("no", "line"))
    level = F.length(F.regexp_replace(F.regexp_extract("line", QUOTED, 0), r"[^>]", ""))
    lines = lines.select("_row", "conv_id", "turn", "no", level.alias("level"), F.regexp_replace("line", QUOTED, "").alias("body"))
    of_message = Window.partitionBy("_row")
    in_order = of_message.orderBy("no")
    lines = lines.repartition("_row").withColumn("quotes", F.max("level").over(of_message) > 0)
    announces = (F.col("level") == 0) & F.col("quotes") & F.col("body").rlike(ANNOUNCED)
    # Blank lines and announcements end a passage and are of no level.
    lines = lines.withColumns({"kept": (F.col("level") == 0) & ~announces, "key": F.when((F.trim("body") == "") | announces, -1).otherwise(F.col("level"))})
    lines = lines.withColumn("starts", ~F.col("key").eqNullSafe(F.lag("key").over(in_order)))
    number = F.sum(F.col("starts").cast("int")).over(in_order)
    return lines.withColumn("passage", F.when(F.col("key") >= 0, number)).drop("key", "starts", "quotes")


def message_passages(lines: DataFrame) -> DataFrame:
    """Passages of the lines: level, number of lines, hash of the evened text, and a hash of each line."""
    in_order = F.array_sort(F.collect_list(F.struct("no", "body")))
    found = lines.filter("passage IS NOT NULL").groupBy("_row", "conv_id", "turn", "passage", "level").agg(in_order.alias("found"))
    text = F.array_join("found.body", " ")
    hashes = F.transform("found.body", lambda x: F.xxhash64(_normal(x)))
    return found.select("_row", "conv_id", "turn", "passage", "level", F.size("found").alias("lines"), F.md5(_normal(text).cast("binary")).alias("hash"), hashes.alias("hashes"))


def own_texts(messages: DataFrame, lines: DataFrame) -> DataFrame:
    """The messages with ``own``, the text without quotations, and ``n_quotes``, the number of quoted passages."""
    kept = F.array_sort(F.collect_list(F.when(F.col("kept"), F.struct("no", "body"))))
    quoted = F.count_distinct(F.when(F.col("level") > 0, F.col("passage"))).alias("n_quotes")
    # Quotations of blank lines only are no passage, but are taken out too.
    whole = lines.groupBy("_row").agg(kept.alias("kept"), quoted, (F.max("level") > 0).alias("quotes"))
    text = F.regexp_replace(F.array_join("kept.body", "\n"), r"^\s+|\s+$", "")
    found = messages.join(whole, "_row")
    return found.withColumns({"own": F.when(F.col("quotes"), text).otherwise(F.col("text")), "n_quotes": F.col("n_quotes").cast("int")}).drop("kept", "quotes", "text")


def _run(n: Column, at: Column) -> Column:
    """Key of the run of ``n`` lines from place ``at`` of the passage's ``blocks``: its first and last block of 2^k lines."""
    k = F.floor(F.log2(n.cast("double")) + 1e-9).cast("int")
    size = F.pow(F.lit(2.0), k).cast("int")
    hashes = [F.get(F.get("blocks", place).getField("hashes"), k) for place in (at, at + n - size)]
    return F.xxhash64(n, *hashes)


def quoted_runs(passages: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Run keys of the quoted passages, and of the runs of own passages as long as some quoted one of the conversation; ``most`` lines at most."""
    lengths = passages.filter("level > 0").select("conv_id", F.col("lines").alias("n")).distinct()
    used = passages.join(lengths.groupBy("conv_id").agg(F.min("n").alias("least")), "conv_id").filter("level > 0 OR lines > least")
    lines = used.select("_row", "conv_id", "turn", "passage", "level", "lines", "hash", F.posexplode("hashes").alias("at", "h0"))
    in_order = Window.partitionBy("_row", "passage").orderBy("at")
    levels = ["h0"]
    while 1 << len(levels) <= most:
        last = levels[-1]
        next_ = F.lead(last, 1 << (len(levels) - 1)).over(in_order)
        levels.append(f"h{len(levels)}")
        lines = lines.withColumn(levels[-1], F.when(next_.isNotNull(), F.xxhash64(last, next_)))
    block = F.array_sort(F.collect_list(F.struct("at", F.array(*levels).alias("hashes")))).alias("blocks")
    passages = lines.groupBy("_row", "conv_id", "turn", "passage", "level", "lines", "hash").agg(block)
    quoted = passages.filter("level > 0").select("conv_id", "turn", "level", "hash", _run(F.col("lines"), F.lit(0)).alias("run"))
    own = passages.filter("level = 0").join(lengths, "conv_id").filter("n < lines")
    places = own.select("conv_id", "turn", "n", "blocks", F.explode(F.sequence(F.lit(0), F.col("lines") - F.col("n"))).alias("place"))
    return quoted, places.select("conv_id", "turn", _run(F.col("n"), F.col("place")).alias("run"))


def link_quotations(messages: DataFrame, work: Workspace | None = None, parts: bool = False) -> DataFrame:
    """A row per message (conv_id, turn, role, text): its own text, what it replies to, and its place in reply order.

    ``parts`` lets quoted passages also be some lines of an own passage. ``n_quotes`` counts its quoted passages and ``n_linked`` those with an original; ``reply_to`` is the turn replied to;
    ``thread`` the turn that began its thread, null for the conversation's own; ``position`` counts from 0.
    """
    work = work or Workspace(messages.sparkSession)
    name = f"quotes-{uuid.uuid4().hex[:8]}"
    keyed, _ = work.write(f"{name}-messages", messages.select(F.monotonically_increasing_id().alias("_row"), "conv_id", "turn", "role", "text"))
    lines, _ = work.write(f"{name}-lines", message_lines(keyed))
    rows = own_texts(keyed, lines)
    named = lines.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    passages, _ = work.write(f"{name}-passages", message_passages(named))
    quoted = passages.filter("level > 0").select("conv_id", "turn", "level", "hash").distinct()
    originals = passages.filter("level = 0").groupBy("conv_id", "hash").agg(F.min("turn").alias("original"))
    found = quoted.join(originals, ["conv_id", "hash"]).select(*quoted.columns, "original")
    most = passages.filter("level > 0").agg(F.max("lines")).first()[0] if parts else None
    if most:
        asked, runs = quoted_runs(passages, most)
        runs = runs.groupBy("conv_id", "run").agg(F.min("turn").alias("original"))
        found = found.unionByName(asked.distinct().join(runs, ["conv_id", "run"]).select(*quoted.columns, "original"))
    links = found.filter("original < turn").groupBy(*quoted.columns).agg(F.min("original").alias("original"))
    latest_outermost = F.max(F.struct(-F.col("level"), F.col("original")))
    replies = links.groupBy("conv_id", "turn").agg(latest_outermost["original"].alias("reply_to"), F.count(F.lit(1)).alias("n_linked"))
    replies, left = work.write(f"{name}-replies", replies)

    # Each round follows twice as many replies as the one before.
    threads = replies.select("conv_id", "turn", F.col("reply_to").alias("thread"))
    rounds = 0
    while left:
        rounds += 1
        above = threads.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("_above"))
        followed = threads.join(above, ["conv_id", "thread"], "left")
        followed = followed.select("conv_id", "turn", F.coalesce("_above", "thread").alias("thread"), F.col("_above").isNotNull().alias("_moved"))
        followed, _ = work.write(f"{name}-threads-{rounds}", followed)
        left = followed.filter("_moved").count()
        threads = followed.drop("_moved")
    # The message that began a thread belongs to it.
    began = threads.select("conv_id", F.col("thread").alias("turn")).distinct().join(threads, ["conv_id", "turn"], "left_anti")
    threads = threads.unionByName(began.withColumn("thread", F.col("turn")))

    joined = rows.join(replies, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left")
    joined, _ = work.write(f"{name}-joined", joined.withColumn("block", F.floor(F.col("turn") / TURNS_PER_BLOCK)))
    placeless = joined.filter("conv_id IS NULL OR turn IS NULL").withColumn("position", F.lit(None).cast("long"))
    joined = joined.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    sizes = joined.groupBy("conv_id", "thread", "block").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("thread").asc_nulls_first(), "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("conv_id").alias("_conv"), F.col("thread").alias("_thread"), F.col("block").alias("_block"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("conv_id", "thread", "block").orderBy("turn", "role", "own")
    placed = joined.withColumn("within", F.row_number().over(within) - 1)
    same = (placed["conv_id"] == starts["_conv"]) & placed["thread"].eqNullSafe(starts["_thread"]) & (placed["block"] == starts["_block"])
    placed = placed.join(starts, same).withColumn("position", F.col("before") + F.col("within")).select(placeless.columns)
    linked = F.coalesce("n_linked", F.lit(0)).cast("int").alias("n_linked")
    return placed.unionByName(placeless).select("conv_id", "turn", "role", F.col("own").alias("text"), "n_quotes", linked, "reply_to", "thread", "position")
