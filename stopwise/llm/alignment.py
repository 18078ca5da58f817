"""Tokens of two tokenizers over the same text, aligned by the bytes at which both end.

Each tokenizer's tokens end at rising byte offsets. The shorter list of ends drives: from where an even spread would put it, each end
gallops through the longer list in doubling steps until it is bracketed, and a binary search ends it. Equal ends cut both
token lists into groups. The ranks of the ends in the other list say which tokens of B each token of A overlaps: from
the number of B's ends up to the token's start, to the number of B's ends before the token's end. All ends of a slice of texts
are searched together, each in its own text's part of the list.

A text that is null or empty, or whose tokens' bytes do not give the text back, has no tokens. Rows may repeat and doc_id may be
null: rows are never matched by it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.tokens import SLICE_BYTES, ByteLevel, Pieces, Ragged
from stopwise.llm.words import add_columns, slices
from stopwise.sources.workspace import Workspace

INTS = T.ArrayType(T.IntegerType())
FIELDS = T.StructType([T.StructField(c, INTS) for c in ("a_ids", "b_ids", "a_cuts", "b_cuts", "b_first", "b_last")])
#: An id pair is one number, a_id * PAIR + b_id; a slice has about so many distinct links of its rows.
PAIR = 1 << 32
LINKS_OF_SLICE = 1 << 19
#: A row of slices is some MB, and whoever reads a row group may hold all of its rows: it ends after a few.
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1"}
STATISTICS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def galloping_ranks(keys: np.ndarray, values: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each key, the first place in ``[low, high)`` of the sorted ``values`` that holds no smaller one (``high`` if none).

    The search gallops from ``start`` towards the key, both ways in doubling steps, and halves the bracket that it finds.
    """
    if not len(values):
        return high.copy()
    floor, ceiling = low.copy(), high.copy()  # the answer is in [floor, ceiling]
    at = np.clip(start, low, np.maximum(high - 1, low))
    below = np.zeros(len(keys), bool)
    some = low < high
    below[some] = values[at[some]] < keys[some]
    floor[some & below] = at[some & below] + 1
    ceiling[some & ~below] = at[some & ~below]
    step, going = 1, np.flatnonzero(some & (floor < ceiling))
    while len(going):
        up = below[going]
        probe = np.where(up, np.minimum(at[going] + step, high[going] - 1), np.maximum(at[going] - step, low[going]))
        less = values[probe] < keys[going]
        floor[going[less]] = np.maximum(floor[going[less]], probe[less] + 1)
        ceiling[going[~less]] = np.minimum(ceiling[going[~less]], probe[~less])
        ended = (less != up) | (floor[going] >= ceiling[going])
        going, step = going[~ended], 2 * step
    going = np.flatnonzero(floor < ceiling)
    while len(going):
        middle = (floor[going] + ceiling[going]) // 2
        less = values[middle] < keys[going]
        floor[going[less]] = middle[less] + 1
        ceiling[going[~less]] = middle[~less]
        going = going[floor[going] < ceiling[going]]
    return floor


class Alignment(NamedTuple):
    """Places of common ends in both lists, and the first and last token of B that each token of A overlaps.

    All are places within the lists of all texts in a row, not within a text.
    """

    a_common: np.ndarray
    b_common: np.ndarray
    b_first: np.ndarray
    b_last: np.ndarray


def align(a_ends: Ragged, b_ends: Ragged) -> Alignment:
    """Alignment of each row's ends; both lists of a row end at the same byte, and each row's bytes lie behind those of the row before."""
    n_a, n_b = np.diff(a_ends.offsets), np.diff(b_ends.offsets)
    a_drives = n_a <= n_b
    counts = np.zeros(len(a_ends.values) + 1, np.int64)  # of each end of A: ends of B up to it, in all rows
    equal = np.zeros(len(a_ends.values), bool)
    for driven in (True, False):
        rows = np.flatnonzero(a_drives == driven)
        short, long = (a_ends, b_ends) if driven else (b_ends, a_ends)
        sizes = np.diff(short.offsets)[rows]
        of = np.repeat(rows, sizes)
        within = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = short.offsets[of] + within
        keys = short.values[place]
        low, high = long.offsets[of], long.offsets[of + 1]
        spread = low + within * (high - low) // np.maximum(np.diff(short.offsets)[of], 1)
        rank = galloping_ranks(keys, long.values, spread, low, high)
        same = (rank < high) & (long.values[np.minimum(rank, len(long.values) - 1)] == keys) if len(rank) else np.zeros(0, bool)
        if driven:
            equal[place[same]] = True
            counts[place] = rank + same
        else:
            equal[rank[same]] = True
            # An end of B counts for all of A's ends from its rank on, within its row.
            tally = np.bincount(rank[rank < high], minlength=len(a_ends.values) + 1)
            mine = np.repeat(rows, n_a[rows])
            inside = np.arange(len(mine)) - np.repeat(np.cumsum(n_a[rows]) - n_a[rows], n_a[rows])
            at = a_ends.offsets[mine] + inside
            summed = np.cumsum(tally)
            before = summed[a_ends.offsets[mine] - 1] * (a_ends.offsets[mine] > 0)
            counts[at] = b_ends.offsets[mine] + summed[at] - before
    counts = counts[:-1]
    first = np.concatenate(([0], counts[:-1])) if len(counts) else counts
    starts = a_ends.offsets[:-1][n_a > 0]
    first[starts] = b_ends.offsets[:-1][n_a > 0]
    a_common = np.flatnonzero(equal)
    return Alignment(a_common, counts[a_common] - 1, first, counts - equal)


class AlignedTexts(NamedTuple):
    a: Ragged
    b: Ragged
    alignment: Alignment


class Aligner:
    """Ids and alignment of a slice of texts by a byte-level and a piece vocabulary."""

    def __init__(self, a_vocabulary: bytes, b_vocabulary: bytes) -> None:
        self._a, self._b = ByteLevel(a_vocabulary, special_as_text=True), Pieces(b_vocabulary)
        self.bytes = tuple(np.array(e.bytes, object) for e in (self._a, self._b))
        self._sizes = tuple(np.array([len(t) for t in e.bytes], np.int64) for e in (self._a, self._b))

    def __call__(self, texts: pa.Array) -> AlignedTexts:
        given = pc.fill_null(texts.cast(pa.large_string()), "")
        space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        spaced = pc.if_else(pc.equal(pc.binary_length(given), 0), nothing, pc.binary_join_element_wise(space, given, nothing))
        found = [self._a(spaced), self._b(given)]
        wanted = b"".join(pc.cast(spaced, pa.large_binary()).to_pylist())
        bounds = np.concatenate(([0], np.cumsum(pc.binary_length(spaced).to_numpy(zero_copy_only=False))))
        right = np.ones(len(texts), bool)
        for ids, own, sizes in zip(found, self.bytes, self._sizes, strict=True):
            tokens = own[ids.values]
            # Usually all texts agree, which one comparison shows.
            if b"".join(tokens) != wanted or not np.array_equal(_sums(ids, sizes), np.diff(bounds)):
                for row, (x, y) in enumerate(zip(ids.offsets[:-1], ids.offsets[1:], strict=True)):
                    right[row] &= b"".join(tokens[x:y]) == wanted[bounds[row] : bounds[row + 1]]
        if not right.all():
            found = [_emptied(ids, right) for ids in found]
        ends = [Ragged(ids.offsets, np.cumsum(sizes[ids.values])) for ids, sizes in zip(found, self._sizes, strict=True)]
        return AlignedTexts(*found, align(*ends))


def _sums(ids: Ragged, sizes: np.ndarray) -> np.ndarray:
    ends = np.concatenate(([0], np.cumsum(sizes[ids.values])))
    return np.diff(ends[ids.offsets])


def _emptied(ids: Ragged, kept: np.ndarray) -> Ragged:
    sizes = np.diff(ids.offsets)
    values = ids.values[np.repeat(kept, sizes)]
    return Ragged(np.concatenate(([0], np.cumsum(np.where(kept, sizes, 0)))), values)


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _paths(a: str | None, b: str | None) -> tuple[str, str]:
    import public_tokenizers

    return a or public_tokenizers.path("byte_bpe_50k.json"), b or public_tokenizers.path("piece_bpe_32k.model")


def _vocabularies(documents: DataFrame, a_path: str | None, b_path: str | None):
    """The files' bytes for the executors; a vocabulary is a few MB, whatever the corpus."""
    found = []
    for path in _paths(a_path, b_path):
        with open(path, "rb") as file:
            found.append(file.read())
    return documents.sparkSession.sparkContext.broadcast(tuple(found))


def align_tokenizers(documents: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``documents`` with the token ids and the alignment of each whole text.

    ``a_ids`` and ``b_ids``; ``a_cuts`` and ``b_cuts``, the number of tokens up to the end of each group; ``b_first`` and ``b_last``,
    for each token of A the places in ``b_ids`` of the first and the last token that it overlaps. The vocabulary files are read
    on the driver. Columns of these names are replaced.
    """
    shared = _vocabularies(documents, a_path, b_path)

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        aligner = Aligner(*shared.value)

        def compute(texts: pa.Array) -> list[pa.Array]:
            a, b, found = aligner(texts)
            groups = np.searchsorted(found.a_common, a.offsets)
            of = np.repeat(np.arange(len(texts)), np.diff(groups))
            of_a = np.repeat(np.arange(len(texts)), np.diff(a.offsets))
            return [
                _lists(a.offsets, a.values),
                _lists(b.offsets, b.values),
                _lists(groups, found.a_common + 1 - a.offsets[of]),
                _lists(groups, found.b_common + 1 - b.offsets[of]),
                _lists(a.offsets, found.b_first - b.offsets[of_a]),
                _lists(a.offsets, found.b_last - b.offsets[of_a]),
            ]

        return compute

    return add_columns(documents, "text", FIELDS, make, SLICE_BYTES)


def _texts_of(ids: Ragged, common: np.ndarray, last: str, names: dict[str, np.ndarray]) -> np.ndarray:
    """Each token as decimal text and what follows it: a comma, or ``last`` behind a group."""
    texts = names[","][ids.values]
    texts[common] = names[last][ids.values[common]]
    return texts


def _digests(found: AlignedTexts, names: dict[str, np.ndarray]) -> list[str]:
    """SHA-256 of each row's groups as ``a1,a2|b1;a3|b2,b3``; an empty text for a row without tokens."""
    a, b, (a_common, b_common, _, _) = found
    a_sizes, b_sizes = np.diff(a_common, prepend=-1), np.diff(b_common, prepend=-1)
    # Where each token stands when a group's tokens of A come first, then those of B.
    texts = np.empty(len(a.values) + len(b.values), object)
    texts[np.arange(len(a.values)) + np.repeat(b_common + 1 - b_sizes, a_sizes)] = _texts_of(a, a_common, "|", names)
    texts[np.arange(len(b.values)) + np.repeat(a_common + 1, b_sizes)] = _texts_of(b, b_common, ";", names)
    cuts = (a.offsets + b.offsets).tolist()
    return ["" if x == y else hashlib.sha256(b"".join(texts[x:y])[:-1]).hexdigest() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


class Counted(NamedTuple):
    """Counts of a slice of rows: ``row`` holds ``pairs[code]`` as often as ``times``."""

    doc_ids: pa.Array
    numbers: np.ndarray
    digests: list[str]
    row: np.ndarray
    code: np.ndarray
    times: np.ndarray
    pairs: np.ndarray
    totals: np.ndarray


def _counted(doc_ids: pa.Array, found: AlignedTexts, names: dict[str, np.ndarray]) -> Counted:
    a, b, (a_common, _, first, last) = found
    rows = len(doc_ids)
    sizes = last - first + 1
    of = np.repeat(np.repeat(np.arange(rows), np.diff(a.offsets)), sizes)
    b_at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(of))
    pairs, codes = np.unique(np.repeat(a.values.astype(np.int64), sizes) * PAIR + b.values[b_at], return_inverse=True)
    held, times = np.unique(of * np.int64(len(pairs) + 1) + codes, return_counts=True)
    row, code = np.divmod(held, len(pairs) + 1)
    groups = np.diff(np.searchsorted(a_common, a.offsets))
    numbers = np.array([np.diff(a.offsets), np.diff(b.offsets), groups, np.bincount(of, minlength=rows)])
    return Counted(doc_ids, numbers, _digests(found, names), row, code, times, pairs, np.bincount(codes, minlength=len(pairs)))


def _merged(parts: list[Counted]) -> Counted:
    pairs, codes = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
    cuts = np.cumsum([0, *(len(p.pairs) for p in parts)])
    rows = np.cumsum([0, *(len(p.doc_ids) for p in parts)])
    totals = np.bincount(codes, np.concatenate([p.totals for p in parts]), len(pairs)).astype(np.int64)
    return Counted(
        pa.concat_arrays([p.doc_ids for p in parts]),
        np.concatenate([p.numbers for p in parts], axis=1),
        [d for p in parts for d in p.digests],
        np.concatenate([p.row + r for p, r in zip(parts, rows[:-1], strict=True)]),
        np.concatenate([codes[c:][p.code] for p, c in zip(parts, cuts[:-1], strict=True)]),
        np.concatenate([p.times for p in parts]),
        pairs,
        totals,
    )


def alignment_statistics(documents: DataFrame, a_path: str | None = None, b_path: str | None = None, work: Workspace | None = None) -> DataFrame:
    """``doc_id`` of each row with counts of its tokens, groups and links, what the links count corpus-wide, and a digest of the groups.

    The alignment is that of ``align_tokenizers``; its arrays are counted where they are made. A link is an occurrence pair of
    overlapping tokens; an id pair counts as many as it has in the corpus. ``n_best`` are the links whose id pair counts
    most of all pairs of its B id, ``count_sum`` adds up the counts of all links.

    A task's rows are counted in slices: a slice has each of its distinct pairs once, and for each row which of them it holds how often.
    Only the distinct pairs meet the corpus-wide counts, so a pair that is in every text costs a row a slice, not a row a text;
    a slice's counts then go back to it, one slice at a time, whose size its own pairs bound.
    """
    spark = documents.sparkSession
    work = work or Workspace(spark)
    name = f"alignment-{uuid.uuid4().hex[:8]}"
    kind = documents.schema["doc_id"].dataType.simpleString()
    row_fields = {"doc_ids": f"array<{kind}>"} | {c: "array<long>" for c in ("n_a", "n_b", "n_groups", "n_links")} | {"digests": "array<string>"}
    own_fields = {"starts": "array<int>", "codes": "array<int>", "times": "array<int>"}
    fields = {"slice": "long"} | row_fields | own_fields | {"pairs": "array<long>", "totals": "array<long>"}
    shared = _vocabularies(documents, a_path, b_path)

    def slice_row(number: int, parts: list[Counted]) -> pa.RecordBatch:
        c = _merged(parts)
        starts = np.searchsorted(c.row, np.arange(len(c.doc_ids) + 1))
        values = [c.doc_ids, *map(pa.array, c.numbers), pa.array(c.digests, pa.string())]
        values += [pa.array(v, pa.int32()) for v in (starts, c.code, c.times)] + [pa.array(c.pairs), pa.array(c.totals)]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values]
        return pa.RecordBatch.from_arrays([pa.array([number]), *lists], names=list(fields))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        most = max(map(len, aligner.bytes))
        names = {s: np.array([b"%d%s" % (k, s.encode()) for k in range(most)], object) for s in ",|;"}
        number, parts, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                parts.append(_counted(part.column(0), aligner(part.column(1)), names))
                held += len(parts[-1].row)
                if held >= LINKS_OF_SLICE:
                    yield slice_row(number, parts)
                    number, parts, held = number + 1, [], 0
        if parts:
            yield slice_row(number, parts)

    counted = ", ".join(f"{c} {t}" for c, t in fields.items())
    slices_, _ = work.write(f"{name}-slices", documents.select("doc_id", "text").mapInArrow(count, counted), **ROW_GROUPS)
    return _spread(slices_, work, name, f"doc_id {kind}, {STATISTICS}")


def _spread(slices_: DataFrame, work: Workspace, name: str, schema: str) -> DataFrame:
    """The statistics of the rows of all slices, with the corpus-wide counts of their pairs."""
    pair = F.posexplode(F.arrays_zip("pairs", "totals")).alias("place", "p")
    held = slices_.select("slice", pair).select("slice", "place", F.col("p.pairs").alias("pair"), F.col("p.totals").alias("total"))
    counts, _ = work.write(f"{name}-counts", held.groupBy("pair").agg(F.sum("total").alias("count")))
    b_id = F.pmod("pair", F.lit(PAIR))
    best = counts.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("most"))
    judged = counts.withColumn("b_id", b_id).join(best, "b_id").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    found = held.select("slice", "place", "pair").join(judged, "pair").select(F.col("slice").alias("of"), "place", "count", "best")

    def spread(one: pa.Table, found: pa.Table) -> pa.Table:
        lists = {c: one.column(c).combine_chunks().flatten() for c in one.column_names if c != "slice"}
        place, count, best = (found.column(c).to_numpy() for c in ("place", "count", "best"))
        counts, bests = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        counts[place], bests[place] = count, best
        code, times, cuts = (lists[c].to_numpy() for c in ("codes", "times", "starts"))
        n_best, count_sum = (np.concatenate(([0], np.cumsum(times * table[code]))) for table in (bests, counts))
        sums = {"n_best": n_best[cuts[1:]] - n_best[cuts[:-1]], "count_sum": count_sum[cuts[1:]] - count_sum[cuts[:-1]]}
        given = {"doc_id": lists["doc_ids"], "groups_sha256": lists["digests"]} | {c: lists[c] for c in ("n_a", "n_b", "n_groups", "n_links")}
        return pa.table(given | sums).select([f.split()[0] for f in schema.split(", ")])

    # One slice at a time: no list of the counts of many slices is held.
    rows = slices_.drop("pairs", "totals").groupBy("slice")
    return rows.cogroup(found.groupBy("of")).applyInArrow(spread, schema)
