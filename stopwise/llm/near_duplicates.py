"""Near-duplicate documents by bottom-k sketches of their word shingles.

Every document's set of distinct shingles is hashed once; its ``K`` smallest values are the sketch.

1. Documents with equal sets form a class; only the class's smallest document goes on.
2. Inverted lists over the retained values: each class enters those of its rarest values only, as many
   as a link must share one of (prefix filter on the overlap of two sketches). Values of one class
   have no list, and a passage in many documents is rare nowhere, so its list holds only documents
   that are mostly made of it.
3. In each list, classes of like size are first compared with the smallest one. What is linked then
   needs no further comparison with its own component: pairs are made only across components.
4. A pair passes if the sketch of its union, the smallest values of both, holds enough common values,
   and is confirmed on the full sets. Pairs across components are held against a parity sketch while
   they are made, so that hardly a pair of a large group of half-like documents becomes a row: ``PARITY_BITS``
   bits, each the parity of the number of values that fall on it. Where two sketches differ, the sets
   differ in at least one value, so as many differing bits as a link may have differing values
   lose no link, whatever the hash. Large sets, which fill such a sketch, are held against wider bottom-k sketches instead.
5. Links become components. All groups are joined by keys that Spark can split; no list, group or
   component is gathered in one task or on the driver.

Two sets with Jaccard similarity 0.8 have on average 0.8 K common values in the sketch of the union; ``OVERLAP``
is over five standard deviations below that, so a link is missed with a probability below 1e-6 before
the other lists it shares are counted. Sets of up to K shingles are their own sketch and nothing is
missed among them.

Defined results: null or empty texts, and texts of white space, have no shingles and are linked with
nothing, as are rows without doc_id. Repeated rows have equal sets. Rows with one doc_id and
different texts are one document, linked by any of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.llm.components import connected_components
from stopwise.llm.id_sets import rows_among
from stopwise.llm.words import Words, mix, slices, split_words, word_hashes
from stopwise.sources.workspace import Workspace

#: Retained values per set.
K = 32
#: Values of the wider sketch, cut to 32 bits, that pairs across components are held against.
WIDE = 192
#: Common values of two wide sketches' union that links have at least: five standard deviations below 0.8 WIDE.
WIDE_OVERLAP = 125
#: Bits of the parity sketch; sets of ``LARGE`` values or more have a wide sketch too, and a pair of such sets must pass both.
PARITY_BITS = 1024
PARITY_WORDS = PARITY_BITS // 64
LARGE = 1000
#: Common values that two linked sets' sketches have at least, when both sets have more than ``SMALL`` shingles.
OVERLAP = 14
#: Sets up to this size are compared whole by their sketches, as are the sets they can be linked with.
SMALL = 25
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a text of fewer words is one shingle, none is none."""
    hashes = word_hashes(words.vocabulary)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        chain = mix(hashes)
        for k in range(1, size):
            chain = mix(chain[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:])
    for start, end in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        if end - start >= size:
            yield np.unique(chain[start : end - size + 1])
        elif end > start:
            text = " ".join(words.vocabulary[c] for c in words.codes[start:end])
            yield mix(word_hashes([text], seed=size))
        else:
            yield np.zeros(0, np.uint64)


def _parities(values: np.ndarray) -> np.ndarray:
    """Parity sketch: each bit tells whether an odd number of values falls on it."""
    places = (mix(values ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(PARITY_BITS)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=PARITY_BITS) & 1).astype(np.uint8)).view(np.int64)


def _signed(values: np.ndarray) -> np.ndarray:
    """The same order as signed numbers."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*rows, np.zeros(0, np.int64)])))


def _sketches(documents: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``n``, two fingerprints of the set, its sketch, the wide one of a large set and the parity sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, one, two, sketch, wide, parities = [], [], [], [], [], []
                with np.errstate(over="ignore"):
                    for values in shingle_sets(split_words(part.column(1), pc.ascii_lower), size):
                        n.append(len(values))
                        one.append(values.sum(dtype=np.uint64).view(np.int64))
                        two.append(mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))
                        sketch.append(_signed(values[:K]))
                        wide.append(_signed(values[: WIDE if len(values) >= LARGE else 0]) >> 32)
                        parities.append(_parities(values))
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), _lists(sketch), _lists(wide).cast(pa.list_(pa.int32())), _lists(parities)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "one", "two", "sketch", "wide", "parities"])

    schema = "doc_id long, n long, one long, two long, sketch array<long>, wide array<int>, parities array<long>"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _full_sets(documents: DataFrame, size: int) -> DataFrame:
    """``id`` and all shingle hashes of each document, once if rows are repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [_signed(s) for s in shingle_sets(split_words(part.column(1), pc.ascii_lower), size)]
                with np.errstate(over="ignore"):
                    one = pa.array([s.sum() for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), one, _lists(sets)], names=["id", "one", "values"])

    every = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "id long, one long, values array<long>")
    return every.dropDuplicates(["id", "one"])


def _linked(common: Column, first: Column, second: Column) -> Column:
    return 100 * common >= PERCENT * (first + second - common)


def _like_sizes(first: Column, second: Column) -> Column:
    """Sizes that a link allows."""
    return (100 * first >= PERCENT * second) & (100 * second >= PERCENT * first)


def _likely(first: Column, second: Column, n_first: Column, n_second: Column, size: int, overlap: int) -> Column:
    """Whether the sketch of the union, the ``size`` smallest values of both, holds as many common values as a link's."""
    union = F.slice(F.array_sort(F.array_union(first, second)), 1, size)
    common = F.size(F.array_intersect(union, F.array_intersect(first, second)))
    whole = F.greatest(n_first, n_second) <= size
    return F.when(whole, _linked(common, n_first, n_second)).otherwise(common >= overlap)


def _band() -> Column:
    """Number of the band of set sizes, each a quarter wider than the one before."""
    return F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / PERCENT)))


def _postings(classes: DataFrame) -> DataFrame:
    """``value``, ``id``, ``n`` for the rarest retained values of each class that other classes have too."""
    every = classes.select("id", "n", F.explode("sketch").alias("value"))
    shared = every.groupBy("value").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    retained = F.least("n", F.lit(K))
    needed = F.when(F.col("n") <= SMALL, F.ceil(F.col("n") * PERCENT / 100)).otherwise(OVERLAP)
    rare_first = F.array_sort(F.collect_list(F.struct("times", "value")))
    by_class = every.join(shared, "value").groupBy("id", "n").agg(rare_first.alias("values"))
    alone = retained - F.size("values")
    entered = F.slice("values", F.lit(1), F.greatest(retained - needed + 1 - alone, F.lit(0)).cast("int"))
    return by_class.select("id", "n", F.explode(entered).alias("v")).select(F.col("v.value").alias("value"), "id", "n")


def _confirmed(work: Workspace, name: str, pairs: DataFrame, classes: DataFrame, documents: DataFrame, size: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) that are links."""
    first = classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    second = classes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(first, "a").join(second, "b")
    likely = _likely(F.col("sketch_a"), F.col("sketch_b"), F.col("n_a"), F.col("n_b"), K, OVERLAP)
    likely, _ = work.write(f"{name}-likely", both.filter(likely).select("a", "b").distinct())
    ids = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
    ids, _ = work.write(f"{name}-ids", ids)
    sets, _ = work.write(f"{name}-sets", _full_sets(rows_among(documents.select("doc_id", "text"), ids, "doc_id"), size))
    first = sets.select(F.col("id").alias("a"), F.col("values").alias("values_a"))
    second = sets.select(F.col("id").alias("b"), F.col("values").alias("values_b"))
    full = likely.join(first, "a").join(second, "b")
    common = F.size(F.array_intersect("values_a", "values_b"))
    links = full.filter(_linked(common, F.size("values_a"), F.size("values_b"))).select("a", "b")
    return work.write(f"{name}-links", links.distinct())[0]


def near_duplicates(documents: DataFrame, size: int = 5, work: Workspace | None = None) -> DataFrame:
    """``doc_id``, ``n_shingles`` (size of its set) and ``component_id`` (smallest doc_id reachable) of each row.

    ``size`` is the number of words in a shingle.
    """
    work = work or Workspace(documents.sparkSession)
    name = uuid.uuid4().hex[:8]
    sets, _ = work.write(f"{name}-sets", _sketches(documents, size))
    filled = sets.filter("n > 0 AND doc_id IS NOT NULL")
    smallest, _ = work.write(f"{name}-smallest", filled.groupBy("one", "two", "n").agg(F.min("doc_id").alias("id")))
    firsts = filled.join(smallest.withColumnRenamed("id", "doc_id"), ["doc_id", "one", "two", "n"], "left_semi")
    classes, _ = work.write(f"{name}-classes", firsts.dropDuplicates(["doc_id", "one", "two"]).select(F.col("doc_id").alias("id"), "n", "sketch", "wide", "parities"))
    postings, _ = work.write(f"{name}-postings", _postings(classes))

    band = _band().alias("band")
    leaders, _ = work.write(f"{name}-leaders", postings.groupBy("value", band).agg(F.min("id").alias("a")))
    pairs = postings.select("value", band, F.col("id").alias("b")).join(leaders, ["value", "band"]).filter("a < b").select("a", "b").distinct()
    links = _confirmed(work, f"{name}-first", pairs, classes, documents, size)
    joined = connected_components(work, f"{name}-first", links)

    placed = postings.join(joined, postings["id"] == joined["node"], "left").select("value", "id", "n", F.coalesce("component", "id").alias("component"))
    placed, _ = work.write(f"{name}-placed", placed)
    mixed = placed.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("value")
    mixed, _ = work.write(f"{name}-mixed", mixed)
    words = [F.get("parities", F.lit(k)).alias(f"parity_{k}") for k in range(PARITY_WORDS)]
    held = classes.select("id", _band().alias("band"), "wide", *words)
    across, _ = work.write(f"{name}-across", placed.join(mixed, "value").join(held, "id"))
    # Sets of linked documents are at most one size band apart.
    one = across.withColumn("met", F.col("band")).alias("one")
    two = across.withColumn("met", F.explode(F.array(F.col("band"), F.col("band") - 1))).alias("two")

    def of(column: str) -> tuple[Column, Column]:
        return F.col(f"one.{column}"), F.col(f"two.{column}")

    apart = (F.col("one.value") == F.col("two.value")) & (F.col("one.met") == F.col("two.met")) & (F.col("one.component") != F.col("two.component"))
    apart = apart & ((F.col("one.band") < F.col("two.band")) | (F.col("one.id") < F.col("two.id"))) & _like_sizes(*of("n"))
    # A link's sets differ in (100 - PERCENT) / (100 + PERCENT) of all their values at most.
    unlike = sum((F.bit_count(first.bitwiseXOR(second)) for first, second in (of(f"parity_{k}") for k in range(PARITY_WORDS))), F.lit(0))
    apart = apart & ((100 + PERCENT) * unlike <= (100 - PERCENT) * sum(of("n")))
    apart = apart & ((F.least(*of("n")) < LARGE) | _likely(*of("wide"), *of("n"), WIDE, WIDE_OVERLAP))
    pairs = one.join(two, apart).select(F.least(*of("id")).alias("a"), F.greatest(*of("id")).alias("b")).distinct()
    more = _confirmed(work, f"{name}-second", pairs, classes, documents, size)
    links = links.unionByName(more)
    joined = connected_components(work, f"{name}-all", links)

    rows = sets.select("doc_id", "n", "one", "two").join(smallest, ["one", "two", "n"], "left")
    rows = rows.join(joined, rows["id"] == joined["node"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
