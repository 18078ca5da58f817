"""Benchmark items that documents repeat or paraphrase, by latent semantic retrieval.

1. Word weights: the inverse frequency of each hashed word over the blocks of all documents.
2. Latent space: in the same reading of the documents every block of every document is added, with a drawn sign, to
   one of ``SKETCH`` rows of word counts. The rows, weighted, and those of the items' blocks span what blocks have in common:
   their leading ``RANK`` singular vectors are the space. Only BUCKETS x SKETCH whole numbers come back, so that no
   order of adding changes them.
3. Search: every passage of every document, two neighbouring blocks of ``STRIDE`` words, is projected
   and compared with the passages of every item by cosine.
   Latent cosines alone take in much text of the same language, so a candidate must also have, word by word, a share of the weight
   of the item's distinctive words, those that few items have.
   An item of fewer than ``SHORT`` words may fill no passage of a document, and what stands around it then decides the cosine. Such items
   have candidates of a second kind: every ``WIDE`` neighbouring blocks that hold as many of the item's words as
   the check asks for at least. Any ``(WIDE - 1) * STRIDE + 1`` words in a row lie within such blocks, so the check sees all of these.
4. Check: an item is confirmed in the words around a candidate passage by the longest common subsequence of
   the two, or by a shorter one together with the item's answer, its last ``ANSWER`` words, in the same order.

The items are a stated query set, held in memory in blocks of ``ITEMS_PER_BLOCK``; the documents are read once for the
weights and the space and once for each block, and never shuffled.

Defined results: null and empty texts contain nothing; items of fewer than ``SHORTEST`` words identify nothing and are
left out; equal items are all found; repeated documents are all found; without items or documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.words import Words, mix, slices, split_words, word_hashes

STRIDE = 12
#: Words between the passages of an item, so that one of them is nearly in line with the document's.
ITEM_STEP = 4
#: Blocks that wholly hold a short item at any place, and the length from which an item fills a passage at any place.
WIDE = 4
SHORT = 3 * STRIDE
#: Wide passages times short items that are counted at once.
COUNTS_AT_ONCE = 1 << 19
BUCKETS = 1 << 16
RANK = 48
SKETCH = 64
#: Bytes of text that are counted for the sketch or searched at once, and buckets that a task gives back at once.
TEXT_AT_ONCE = 1 << 20
BUCKETS_AT_ONCE = 1 << 13
ITEMS_PER_BLOCK = 2000
#: Share of the items that may have a distinctive word, and of a passage's distinctive weight that candidates have.
DISTINCTIVE = 0.05
DISTINCTIVE_SHARE = 0.25
PASSAGES_AT_ONCE = 2048
SHORTEST = 8
#: Cosine of a candidate; share of the item's words, in order, that confirms it, alone or with the answer.
CANDIDATE = 0.55
COMMON = 0.75
COMMON_WITH_ANSWER = 0.5
ANSWER = 6
PUNCTUATION = ".,;:!?\"'()[]"

FOUND = "doc_id long, item_id long, first_word long, last_word long, cosine double, common double, answer boolean"


class Items(NamedTuple):
    ids: list[int]
    words: list[np.ndarray]  # hashes
    passage_of: np.ndarray  # item of each passage
    passages: np.ndarray  # passage x rank, of length 1
    distinctive: np.ndarray  # sorted hashes of the distinctive words
    starts: np.ndarray  # where each one's items start in items_of
    items_of: np.ndarray
    weights: np.ndarray  # of each distinctive word
    needed: np.ndarray  # distinctive weight that a candidate for each passage has
    short: np.ndarray  # the short items
    short_words: np.ndarray  # sorted hashes of their words
    short_starts: np.ndarray  # where each one's items start in short_of
    short_of: np.ndarray  # places in short
    short_times: np.ndarray  # of the word in the item


def _hashes(words: Words) -> np.ndarray:
    """Hash of each distinct word without punctuation around it."""
    return mix(word_hashes([w.strip(PUNCTUATION) or w for w in words.vocabulary]))


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


def _blocks(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word of each block of STRIDE words, and its row. No block crosses rows."""
    lengths = np.diff(words.offsets)
    number = -(-lengths // STRIDE)
    row = np.repeat(np.arange(len(lengths)), number)
    within = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    return words.offsets[row] + within * STRIDE, row


def _openings(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First block of each passage, and whether it has a second one; a row of one block is one passage."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    follows = np.append(row[1:] == row[:-1], False)
    alone = ~follows & np.insert(row[1:] != row[:-1], 0, True)
    first = np.flatnonzero(follows | alone)
    return first, follows[first]


def _add_to_sketch(sketch: np.ndarray, words: Words, bucket: np.ndarray, seeds: np.ndarray) -> int:
    """Add each block's word counts, with its drawn sign, to its drawn row of ``sketch`` (bucket x row); the number of blocks."""
    starts, row = _blocks(words)
    drawn = mix(seeds.astype(np.uint64)[row] + mix((starts - words.offsets[row]).astype(np.uint64)))
    place, sign = (drawn % np.uint64(SKETCH)).astype(np.int64), np.where(drawn >> np.uint64(63), 1, -1).astype(np.int32)
    sizes = np.diff(np.append(starts, len(words.codes)))
    np.add.at(sketch.reshape(-1), bucket[words.codes] * SKETCH + np.repeat(place, sizes), np.repeat(sign, sizes))
    return len(starts)


def _statistics(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Inverse frequency weight of each bucket over the blocks of all documents, and the sketch of all blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, blocks = np.zeros(BUCKETS, np.int64), 0
        sketch = np.zeros((BUCKETS, SKETCH), np.int32)
        for batch in batches:
            for part in slices(batch, "text", TEXT_AT_ONCE):
                words = split_words(part.column(1))
                if not len(words.codes):
                    continue
                bucket = _buckets(_hashes(words))
                blocks += _add_to_sketch(sketch, words, bucket, part.column(0).to_numpy(zero_copy_only=False))
                times = np.bincount(words.codes, minlength=len(words.vocabulary))
                total += np.bincount(bucket, times, BUCKETS).astype(np.int64)
        used = np.flatnonzero(total)
        for low in range(0, len(used), BUCKETS_AT_ONCE):
            held = used[low : low + BUCKETS_AT_ONCE]
            rows = pa.FixedSizeListArray.from_arrays(pa.array(sketch[held].ravel()), SKETCH).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held]), rows], names=["bucket", "times", "row"])
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([blocks]), pa.array([[0] * SKETCH], pa.list_(pa.int32()))], names=["bucket", "times", "row"])

    seeded = documents.select(F.xxhash64(F.col("doc_id").cast("string")), "text")
    counted = seeded.mapInArrow(count, "bucket long, times long, row array<int>")
    sums = [F.sum(F.col("row")[k]).alias(f"r{k}") for k in range(SKETCH)]
    rows = counted.groupBy("bucket").agg(F.sum("times").alias("times"), *sums).toArrow()
    bucket, number = rows.column("bucket").to_numpy(), rows.column("times").to_numpy()
    held = bucket >= 0
    blocks = int(number[~held].sum())
    times = np.zeros(BUCKETS)
    times[bucket[held]] = number[held]
    sketch = np.zeros((BUCKETS, SKETCH))
    for k in range(SKETCH):
        sketch[bucket[held], k] = rows.column(f"r{k}").to_numpy()[held]
    return np.log((blocks + 1) / (np.minimum(times, blocks) + 1)) + 0.1, sketch


def _latent_space(sketch: np.ndarray, items: Words, weights: np.ndarray) -> np.ndarray:
    """Leading singular vectors of the weighted sketches of the documents and of the items (bucket x rank), which count the same."""
    own = np.zeros((BUCKETS, SKETCH), np.int32)
    _add_to_sketch(own, items, _buckets(_hashes(items)), mix(np.arange(1, len(items.offsets), dtype=np.uint64)))
    # Made in place, and given up before the directions are made orthogonal: the driver holds it beside all else.
    both = np.empty((BUCKETS, 2 * SKETCH))
    for k, part in enumerate((sketch, own)):
        half = both[:, k * SKETCH : (k + 1) * SKETCH]
        np.multiply(weights[:, None], part, out=half)
        half /= max(np.linalg.norm(half), 1e-9)
    del own, part, half
    _, directions = np.linalg.eigh(both.T @ both)
    leading = both @ directions[:, ::-1][:, :RANK]
    del both
    return np.linalg.qr(leading)[0].astype(np.float32)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), 1e-9)[:, None]


def _block_vectors(words: Words, bucket: np.ndarray, starts: np.ndarray, blocks: np.ndarray, weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Latent vectors of some blocks."""
    sizes = np.append(starts[1:], len(words.codes))[blocks] - starts[blocks]
    opens = np.cumsum(sizes) - sizes
    of = bucket[words.codes[np.repeat(starts[blocks] - opens, sizes) + np.arange(sizes.sum())]]
    return np.add.reduceat((weights[of, None] * basis[of]).astype(np.float32), opens, axis=0)


def _project(words: Words, bucket: np.ndarray, starts: np.ndarray, first: np.ndarray, paired: np.ndarray, weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Latent vectors of length 1 of the passages that open with the blocks ``first``."""
    blocks = np.unique(np.append(first, first[paired] + 1))
    vectors = _block_vectors(words, bucket, starts, blocks, weights, basis)
    passages = vectors[np.searchsorted(blocks, first)]
    passages[paired] += vectors[np.searchsorted(blocks, first[paired] + 1)]
    return _unit(passages)


def common_subsequence(first: list[int], second: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows (Hyyrö)."""
    places: dict[int, int] = {}
    for k, w in enumerate(first):
        places[w] = places.get(w, 0) | (1 << k)
    full = (1 << len(first)) - 1
    row = full
    for match in filter(None, map(places.get, second)):
        match &= row
        row = ((row + match) | (row - match)) & full
    return len(first) - row.bit_count()


def _prepared(ids: list[int], words: Words, weights: np.ndarray, basis: np.ndarray) -> Items:
    hashes = _hashes(words)
    bucket = _buckets(hashes)
    vectors = (weights[bucket, None] * basis[bucket]).astype(np.float32)
    row = words.row_of_word()
    pairs = np.unique(np.column_stack([words.codes, row]), axis=0)
    few = np.bincount(pairs[:, 0], minlength=len(hashes)) <= max(2, DISTINCTIVE * len(ids))
    # Words of the vocabulary that differ only in punctuation have one hash.
    own = weights[bucket] * few
    listed = np.unique(np.array([(hashes[c], r) for c, r in pairs if few[c]], dtype=[("word", np.uint64), ("item", np.int64)]))
    distinctive, starts = np.unique(listed["word"], return_index=True)
    each, passages, passage_of, needed = [], [], [], []
    for k, (start, end) in enumerate(zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True)):
        codes = words.codes[start:end]
        each.append(hashes[codes])
        for at in sorted({*range(0, max(1, len(codes) - 2 * STRIDE + 1), ITEM_STEP), max(0, len(codes) - 2 * STRIDE)}):
            part = codes[at : at + 2 * STRIDE]
            passages.append(vectors[part].sum(axis=0))
            passage_of.append(k)
            needed.append(DISTINCTIVE_SHARE * own[part].sum())
    weight = weights[_buckets(distinctive)]
    return Items(
        ids,
        each,
        np.array(passage_of),
        _unit(np.array(passages)),
        distinctive,
        np.append(starts, len(listed)),
        listed["item"],
        weight,
        np.array(needed),
        *_short_items(each),
    )


def _short_items(each: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The short items, and an index from their words to them."""
    short = np.array([k for k, words in enumerate(each) if len(words) < SHORT], np.int64)
    counted = [np.unique(each[k], return_counts=True) for k in short]
    listed = np.array([(w, k, n) for k, (words, times) in enumerate(counted) for w, n in zip(words, times, strict=True)], dtype=[("word", np.uint64), ("item", np.int64), ("times", np.int64)])
    listed.sort(order=["word", "item"])
    words, starts = np.unique(listed["word"], return_index=True)
    return short, words, np.append(starts, len(listed)), listed["item"], listed["times"]


def _short_candidates(items: Items, hashes: np.ndarray, words: Words, starts: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int]]:
    """First block and item of all wide passages with enough of a short item's words to be confirmed."""
    number = len(items.short)
    if not number:
        return
    needed = COMMON_WITH_ANSWER * np.array([len(items.words[k]) for k in items.short])
    at = np.minimum(np.searchsorted(items.short_words, hashes), len(items.short_words) - 1)
    known = np.where(items.short_words[at] == hashes, at, -1)[words.codes]
    places = np.flatnonzero(known >= 0)
    kinds = len(items.short_words)
    block, word = np.searchsorted(starts, places, side="right") - 1, known[places]
    step = max(1, COUNTS_AT_ONCE // number)
    for low in range(0, len(starts), step):
        a, b = np.searchsorted(block, [low, low + step + WIDE - 1])
        held = []
        for back in range(WIDE):
            first = block[a:b] - back
            inside = (first >= low) & (first < low + step)
            inside[inside] = row[first[inside]] == row[block[a:b][inside]]
            held.append((first[inside] - low) * kinds + word[a:b][inside])
        # A word counts once for a wide passage, as often as the item has it.
        seen = np.zeros(step * kinds, bool)
        seen[np.concatenate(held)] = True
        first, kind = np.divmod(np.flatnonzero(seen), kinds)
        each = items.short_starts[kind + 1] - items.short_starts[kind]
        entry = np.repeat(items.short_starts[kind], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        counts = np.bincount(np.repeat(first, each) * number + items.short_of[entry], items.short_times[entry], step * number).reshape(step, number)
        for place, item in zip(*(x.tolist() for x in np.nonzero(counts >= needed)), strict=True):
            yield low + place, int(items.short[item])


def _distinctive_weights(items: Items, hashes: np.ndarray, words: Words, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, item and weight of every distinctive word of every item in the text, in the order of the blocks."""
    if not len(items.distinctive):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    at = np.minimum(np.searchsorted(items.distinctive, hashes), len(items.distinctive) - 1)
    known = np.where(items.distinctive[at] == hashes, at, -1)[words.codes]
    places = np.flatnonzero(known >= 0)
    word = known[places]
    block = np.searchsorted(starts, places, side="right") - 1
    number = items.starts[word + 1] - items.starts[word]
    within = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    item = items.items_of[np.repeat(items.starts[word], number) + within]
    return np.repeat(block, number), item, np.repeat(items.weights[word], number)


def _confirm(item: np.ndarray, region: np.ndarray) -> tuple[float, bool]:
    """Share of the item's words that the region has in order, and whether its answer is among them."""
    wanted, given = item.tolist(), region.tolist()
    share, answer = common_subsequence(wanted, given) / len(wanted), wanted[-ANSWER:]
    # A smaller share confirms nothing, whatever the answer.
    return share, share >= COMMON_WITH_ANSWER and common_subsequence(answer, given) >= len(answer) - 1


def _search(documents: DataFrame, items: Items, weights: np.ndarray, basis: np.ndarray) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast((tuple(items), weights, basis))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_items, weights, basis = shared.value
        items = Items(*found_items)
        least = np.full(len(items.ids), np.inf)
        np.minimum.at(least, items.passage_of, items.needed)
        for batch in batches:
            for part in slices(batch, "text", TEXT_AT_ONCE):
                words = split_words(part.column(1))
                if not len(words.codes):
                    continue
                hashes = _hashes(words)
                bucket = _buckets(hashes)
                starts, block_row = _blocks(words)
                opening, paired = _openings(block_row)
                start, row = starts[opening], block_row[opening]
                block, item_of, weight = _distinctive_weights(items, hashes, words, starts)
                number = len(items.ids)
                best: dict[tuple[int, int], tuple] = {}
                for low in range(0, len(opening), PASSAGES_AT_ONCE):
                    chosen = slice(low, low + PASSAGES_AT_ONCE)
                    zero = opening[low]
                    own = opening[chosen] - zero
                    rows = own[-1] + 2
                    a, b = np.searchsorted(block, [zero, zero + rows])
                    held = np.bincount((block[a:b] - zero) * number + item_of[a:b], weight[a:b], rows * number).reshape(rows, number)
                    held = held[own] + held[own + 1] * paired[chosen][:, None]
                    # Passages without enough of any item need no cosines.
                    some = np.flatnonzero((held >= least).any(axis=1))
                    if not len(some):
                        continue
                    passages = _project(words, bucket, starts, opening[low + some], paired[low + some], weights, basis)
                    cosines = passages @ items.passages.T
                    near, of = np.nonzero((cosines >= CANDIDATE) & (held[some][:, items.passage_of] >= items.needed))
                    at_passage = low + some[near]
                    chosen = np.unique(np.column_stack([row[at_passage], items.passage_of[of], start[at_passage]]), axis=0, return_index=True)
                    for (r, item, at), k in zip(chosen[0].tolist(), chosen[1].tolist(), strict=True):
                        size = len(items.words[item])
                        first = max(at - size, int(words.offsets[r]))
                        last = min(at + 2 * STRIDE + size, int(words.offsets[r + 1]))
                        if best.get((r, item), (0, 0))[1] == 1.0:
                            continue
                        share, answer = _confirm(items.words[item], hashes[words.codes[first:last]])
                        if share >= COMMON or (share >= COMMON_WITH_ANSWER and answer):
                            origin = int(words.offsets[r])
                            cosine = float(cosines[near[k], of[k]])
                            best[r, item] = max(best.get((r, item), ()), (r, share, cosine, answer, first - origin, last - 1 - origin))
                for opens, item in _short_candidates(items, hashes, words, starts, block_row):
                    r, size = int(block_row[opens]), len(items.words[item])
                    origin, end = int(words.offsets[r]), int(words.offsets[r + 1])
                    first = max(int(starts[opens]) - size // 4, origin)
                    last = min(int(starts[opens]) + WIDE * STRIDE + size // 4, end)
                    if best.get((r, item), (0, 0))[1] == 1.0:
                        continue
                    share, answer = _confirm(items.words[item], hashes[words.codes[first:last]])
                    if share >= COMMON or (share >= COMMON_WITH_ANSWER and answer):
                        near = np.flatnonzero(row[slice(*np.searchsorted(opening, [opens, opens + WIDE - 1]))] == r) + np.searchsorted(opening, opens)
                        of = slice(*np.searchsorted(items.passage_of, [item, item + 1]))
                        # The last block of a row opens no passage of its own.
                        cosine = 0.0
                        if len(near):
                            passages = _project(words, bucket, starts, opening[near], paired[near], weights, basis)
                            cosine = float((passages @ items.passages[of].T).max())
                        best[r, item] = max(best.get((r, item), ()), (r, share, cosine, answer, first - origin, last - 1 - origin))
                ids = part.column(0)
                rows = sorted(best.items())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([r for (r, _), _ in rows], pa.int64())),
                        pa.array([items.ids[i] for (_, i), _ in rows], pa.int64()),
                        pa.array([v[4] for _, v in rows], pa.int64()),
                        pa.array([v[5] for _, v in rows], pa.int64()),
                        pa.array([v[2] for _, v in rows], pa.float64()),
                        pa.array([v[1] for _, v in rows], pa.float64()),
                        pa.array([v[3] for _, v in rows], pa.bool_()),
                    ],
                    names=["doc_id", "item_id", "first_word", "last_word", "cosine", "common", "answer"],
                )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND)


def find_benchmark_items(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and benchmark item (item_id, text) found in it, with the place and the evidence."""
    weights, sketch = _statistics(documents)
    numbered = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    blocks = max(1, -(-numbered.count() // ITEMS_PER_BLOCK))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    result = documents.sparkSession.createDataFrame([], FOUND)
    for k in range(blocks):
        rows = numbered.filter(block == k).orderBy("item_id").toArrow().to_pandas()
        words = split_words(pa.array(rows.text, pa.string()))
        long = np.flatnonzero(np.diff(words.offsets) >= SHORTEST)
        if not len(long):
            continue
        words = split_words(pa.array(rows.text.iloc[long], pa.string()))
        basis = _latent_space(sketch, words, weights)
        items = _prepared(rows.item_id.iloc[long].tolist(), words, weights, basis)
        result = result.unionByName(_search(documents, items, weights, basis))
    return result
