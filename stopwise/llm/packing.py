"""Documents packed into training sequences by first-fit decreasing.

A document is its token ids and an end id. Whole sequences' worth is cut off from its start and needs no packing; what is left,
shorter than a sequence, goes to one of many groups by a hash of its row, so that groups are of like size whatever the documents
hold. In each group the rests are placed in order of falling length, each in the first sequence with room for it, which a tournament
tree of the sequences' free places finds in logarithmic time.

Lengths that do not fit together leave room: a group of like documents of just over half a sequence would waste nearly half. So
sequences with more than SMALL_GAP free places are topped up: the emptiest give their tokens to the fullest, cut where these
are full. One sequence a group may still have room; it is cut into sequences of powers of two, which need no padding.

Null texts count as empty, so they are the end id alone. Rows with equal or null doc_id are documents of their own, told apart
by ``row``. Documents without rows give no rows; other columns of the documents are left out.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.tokens import SLICE_BYTES, ByteLevel, Ragged
from stopwise.llm.words import slices
from stopwise.sources.workspace import Workspace

SEQUENCE = 2048
END = 1
#: Documents of a group, in expectation; and the most free places that a sequence may keep.
GROUP = 1024
SMALL_GAP = 16


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """The items of each bin: items by falling length (ties in their order), each in the first bin with room."""
    order = np.argsort(-lengths, kind="stable").tolist()
    leaves = 1 << max(0, len(order) - 1).bit_length()
    tree = [capacity] * (2 * leaves)
    bins: list[list[int]] = []
    for item, size in zip(order, lengths[order].tolist(), strict=True):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        at = node - leaves
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
        tree[node] -= size
        node //= 2
        while node:
            room = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == room:
                break
            tree[node] = room
            node //= 2
    return bins


def topped_up(bins: list[list[tuple[int, int, int]]], capacity: int, small_gap: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, start, length) with at most ``small_gap`` free places, or of a power of two."""
    fill = [sum(p[2] for p in b) for b in bins]
    open_bins = sorted((k for k in range(len(bins)) if capacity - fill[k] > small_gap), key=lambda k: (-fill[k], k))
    low, high = 0, len(open_bins) - 1
    while low < high:
        to, source = open_bins[low], open_bins[high]
        item, start, length = bins[source].pop()
        moved = min(length, capacity - fill[to])
        if moved < length:
            bins[source].append((item, start, length - moved))
        bins[to].append((item, start + length - moved, moved))
        fill[to] += moved
        fill[source] -= moved
        low += capacity - fill[to] <= small_gap
        high -= fill[source] == 0
    last = open_bins[low] if low < len(open_bins) and capacity - fill[open_bins[low]] > small_gap else None
    return [b for k, b in enumerate(bins) if b and k != last] + ([] if last is None else _powers_of_two(bins[last]))


def _powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    total, cut = sum(p[2] for p in pieces), []
    rest = list(reversed(pieces))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        cut.append([])
        while room:
            item, start, length = rest.pop()
            taken = min(length, room)
            cut[-1].append((item, start, taken))
            room -= taken
            if taken < length:
                rest.append((item, start + taken, length - taken))
    return cut


def _rows(columns: list[pa.Array], ids: Ragged, names: list[str]) -> pa.RecordBatch:
    """Pieces as Arrow rows: the columns before the ids, the ids, and their checksum over little-endian 32-bit values."""
    raw = ids.values.astype("<u4").tobytes()
    ends = (4 * ids.offsets).tolist()
    sums = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    lists = pa.ListArray.from_arrays(pa.array(ids.offsets, pa.int32()), pa.array(ids.values, pa.int32()))
    return pa.RecordBatch.from_arrays([*columns, lists, pa.array(sums, pa.int64())], names=names)


def pack_documents(
    documents: DataFrame,
    vocabulary: str | None = None,
    sequence: int = SEQUENCE,
    end_id: int = END,
    group: int = GROUP,
    work: Workspace | None = None,
) -> DataFrame:
    """Pieces of ``documents``: ``row``, ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids``, ``ids_crc32``.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's. ``vocabulary`` is the path of a
    byte-level vocabulary file, read on the driver.
    """
    spark = documents.sparkSession
    work = work or Workspace(spark)
    name = f"packing-{uuid.uuid4().hex[:8]}"
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    with open(vocabulary, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    given = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    fields = "row long, doc_id {}, doc_tokens long, start long, length long, sequence_id long, offset long, ids array<int>, ids_crc32 long"
    fields = fields.format(given.schema["doc_id"].dataType.simpleString())
    order = [f.split()[0] for f in fields.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ByteLevel(shared.value, special_as_text=False)
        whole = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = encode(part.column(2))
                ended = np.insert(found.values, found.offsets[1:], end_id)
                offsets = found.offsets + np.arange(len(found.offsets))
                tokens = np.diff(offsets)
                pieces = -(-tokens // sequence)
                of = np.repeat(np.arange(len(tokens)), pieces)
                start = sequence * (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
                length = np.minimum(sequence, tokens[of] - start)
                full = length == sequence
                number = 2 * (whole + np.cumsum(full) - 1)
                whole += int(full.sum())
                ids = Ragged(np.append(offsets[of] + start, offsets[-1]), ended)
                rows = pa.array(of)
                numbers = pa.array(number, pa.int64(), mask=~full)
                columns = [part.column(0).take(rows), part.column(1).take(rows), pa.array(tokens[of]), pa.array(start), pa.array(length), numbers]
                yield _rows([*columns, pa.array(np.zeros(len(of), np.int64))], ids, order)

    pieces, _ = work.write(f"{name}-pieces", given.mapInArrow(cut, fields))
    whole, rests = pieces.filter("sequence_id IS NOT NULL"), pieces.filter("sequence_id IS NULL")
    groups = max(1, -(-rests.count() // group))
    rests = rests.select(F.pmod(F.xxhash64(F.lit("packing"), "row"), F.lit(groups)).alias("group"), "row", "doc_id", "doc_tokens", "start", "ids")

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("row").combine_chunks()
        lists = table.column("ids").combine_chunks()
        offsets, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
        lengths = np.diff(offsets)
        bins = [[(k, 0, int(lengths[k])) for k in b] for b in first_fit_decreasing(lengths, sequence)]
        bins = topped_up(bins, sequence, SMALL_GAP)
        placed = np.array([(k, s, n) for b in bins for k, s, n in b], np.int64).reshape(-1, 3)
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        item, start, length = placed.T
        ends = np.cumsum(length)
        before = ends - length
        first = np.searchsorted(number, np.arange(len(bins)))
        ids = _spans(values, offsets[item] + start, length)
        rows = pa.array(item)
        columns = [table.column(c).take(rows).combine_chunks() for c in ("row", "doc_id", "doc_tokens")]
        starts = pa.array(table.column("start").to_numpy()[item] + start)
        numbers = pa.array(2 * ((table.column("group")[0].as_py() << 32) + number) + 1)
        columns += [starts, pa.array(length), numbers, pa.array(before - before[first][number])]
        return pa.Table.from_batches([_rows(columns, ids, order)])

    packed = rests.groupBy("group").applyInArrow(pack, fields)
    return whole.select(*order).unionByName(packed)


def _spans(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Ragged:
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    return Ragged(offsets, values[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])])
