"""Nearest neighbours by an inverted multi-index.

The two halves of the vectors are quantised separately, each with its own centroids, which are fitted on a bounded sample. A cell is
a pair of centroids. A query takes the cells in the order of the sum of its halves' distances to the centroids, until
these hold the wanted number of vectors; the largest sum among them is its reach, which stands for the cells without listing them.

Neighbouring cells make groups of about VECTORS_PER_GROUP vectors; a cell that holds more is dealt over several groups. A query goes to
the groups that hold a cell within its reach, with its vector and its reach only. A group compares the vectors of a centroid
of the first half with all queries that reach it at once, by a matrix product. What can be among the ``k`` nearest by that, and
lies in a cell within reach, is compared in double precision on the original vectors. Each group gives only the best ``k``
of each of its queries; a group with more than QUERIES_PER_GROUP queries is worked on by several tasks.

CANDIDATE_SHARE is measured for the hardest case, vectors without any structure: there a query compares nearly half of all vectors for
a recall above 0.9. Clustered vectors need far less.

Vectors that are null, empty or zero, that hold null or non-finite components, or that differ in length from most, take no
part, nor do those without id. Equal distances go to the smaller vec_id; a repeated vec_id takes part as often as
it is there, except as its own query's neighbour. With fewer than ``k`` candidates, all are returned.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.sources.workspace import Workspace

#: Vectors (in expectation) that the centroids are fitted on, for each centroid; and centroids of a half, at most.
SAMPLE_PER_CENTROID = 64
MOST_CENTROIDS = 1024
STEPS = 12
#: Share of all vectors that a query compares, and the smallest number.
CANDIDATE_SHARE = 0.45
LEAST_CANDIDATES = 2000
VECTORS_PER_GROUP = 8192
QUERIES_PER_GROUP = 4096
#: Queries and vectors that are compared at once, and pairs whose distance is then taken exactly.
QUERIES_AT_ONCE = 256
VECTORS_AT_ONCE = 2048
PAIRS_AT_ONCE = 1 << 15
#: The sums of a query's cells are counted in so many bins; only the cells of one of them are sorted.
BINS = 4096


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` (double) of the rows that take part."""
    cast = F.col("embedding").cast("array<double>")
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long"), cast.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter((F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), "length").limit(1).select(F.col("length").alias("_length"))
    return rows.join(F.broadcast(usual), F.size("vector") == F.col("_length")).drop("_length")


def _centroids(points: np.ndarray, number: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm from distinct points."""
    distinct = np.unique(points, axis=0)
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:number]]
    for _ in range(STEPS):
        nearest = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        times = np.bincount(nearest, minlength=len(centres))[:, None]
        centres = np.where(times > 0, sums / np.maximum(times, 1), centres)
    return centres


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)[None, :]


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(points[k : k + 4096], centres).argmin(axis=1) for k in range(0, len(points), 4096)])


def reach(sums: np.ndarray, sizes: np.ndarray, wanted: int) -> float:
    """The sum up to which cells, taken in the order of their ``sums``, hold ``wanted`` vectors; infinite if all of them are needed."""
    if sizes.sum() <= wanted:
        return np.inf
    low, high = sums.min(), sums.max()
    if not np.isfinite(high - low) or high <= low:
        return np.inf
    bins = np.minimum((sums - low) * (BINS / (high - low)), BINS - 1).astype(np.int32)
    held = np.cumsum(np.bincount(bins, sizes, BINS))
    last = np.searchsorted(held, wanted)
    inside = np.flatnonzero(bins == last)
    inside = inside[np.argsort(sums[inside], kind="stable")]
    before = held[last - 1] if last else 0
    return float(sums[inside[np.searchsorted(before + np.cumsum(sizes[inside]), wanted)]])


def nearest_cells(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Non-empty cells by the sum of their distances, ``first[i] + second[j]``, until they hold ``wanted`` vectors."""
    cells = np.flatnonzero(sizes)
    sums = np.add.outer(first, second).ravel()[cells]
    taken = sums <= reach(sums, sizes.ravel()[cells], wanted)
    return cells[taken][np.argsort(sums[taken], kind="stable")].tolist()


def groups_of_cells(sizes: np.ndarray, per_group: int) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of each cell; cells in a row share a group of about ``per_group`` vectors, larger cells have their own."""
    parts = np.maximum(1, -(-sizes // per_group))
    block, large = (np.cumsum(sizes) - 1) // per_group, parts > 1
    begins = (np.diff(block, prepend=-1) != 0) | large | np.concatenate(([False], large[:-1]))
    ends = np.cumsum(parts[begins])
    return (ends - parts[begins])[np.cumsum(begins) - 1], parts


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def _distances(points: np.ndarray, place: np.ndarray, queries: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Distance of each pair of a vector's place and a query's row, in double precision."""
    cuts = [slice(x, x + PAIRS_AT_ONCE) for x in range(0, len(row), PAIRS_AT_ONCE)]
    return np.concatenate([np.sqrt(((points[place[c]] - queries[row[c]]) ** 2).sum(axis=1)) for c in cuts])


class Found(NamedTuple):
    """Pairs found so far: query's row, vector's place and distance."""

    row: np.ndarray
    place: np.ndarray
    score: np.ndarray


def _best(found: Found, ids: np.ndarray, k: int) -> Found:
    """The ``k`` nearest of each row, ties to the smaller id."""
    order = np.lexsort((ids[found.place], found.score, found.row))
    row = found.row[order]
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
    kept = order[rank < k]
    return Found(*(v[kept] for v in found))


def nearest_of_group(
    ids: np.ndarray, points: np.ndarray, cells: tuple[np.ndarray, np.ndarray], own: np.ndarray, queries: np.ndarray,
    reaches: np.ndarray, centroids: tuple[np.ndarray, np.ndarray], k: int,
) -> Found:
    """The ``k`` nearest of a group's vectors for each query, among the cells within its reach; vectors are in the order of their first cell number."""
    first, second = cells
    low, high = centroids
    starts = np.flatnonzero(np.diff(first, prepend=-1)).tolist()
    ends = [*starts[1:], len(first)]
    segments = [(x, min(x + VECTORS_AT_ONCE, end)) for start, end in zip(starts, ends, strict=True) for x in range(start, end, VECTORS_AT_ONCE)]
    half, squares = low.shape[1], (points**2).sum(axis=1)
    to_first, to_second = _squares(queries[:, :half], low), _squares(queries[:, half:], high)
    found = Found(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    own_squares = (queries**2).sum(axis=1)
    # What a distance by the matrix product can be off, squared, and far more.
    slack = (points.shape[1] + 16) * 1e-15 * (own_squares + squares.max())
    bound = np.full(len(queries), np.inf)
    nearest_second = to_second.min(axis=1)
    for start, end in segments:
        to = to_first[:, first[start]]
        rows = np.flatnonzero(~(to + nearest_second > reaches))
        if not len(rows):
            continue
        near = own_squares[rows, None] + squares[None, start:end] - 2 * queries[rows] @ points[start:end].T
        open_ = np.flatnonzero(np.isinf(bound[rows]))
        if len(open_) and end - start > k:
            # The k-th nearest here is a bound for the queries that have none yet.
            some = rows[open_]
            away = to[some, None] + to_second[some][:, second[start:end]] > reaches[some, None]
            away |= ids[None, start:end] == own[some, None]
            kth = np.partition(np.where(away, np.inf, near[open_]), k - 1, axis=1)[:, k - 1]
            bound[some] = kth + 2 * slack[some]
        row, place = np.nonzero(~(near > bound[rows, None]))
        row, place = rows[row], place + start
        held = ~(to[row] + to_second[row, second[place]] > reaches[row]) & (ids[place] != own[row])
        row, place = row[held], place[held]
        if not len(row):
            continue
        more = (row, place, _distances(points, place, queries, row))
        found = _best(Found(*map(np.append, found, more)), ids, k)
        whole = np.flatnonzero(np.bincount(found.row, minlength=len(queries)) == k)
        worst = np.flatnonzero(np.diff(found.row, append=-1))
        worst = worst[np.isin(found.row[worst], whole)]
        bound[found.row[worst]] = np.minimum(bound[found.row[worst]], found.score[worst] ** 2 + 2 * slack[found.row[worst]])
    return found


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, work: Workspace | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (distance): the ``k`` nearest found of each row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    work = work or Workspace(spark)
    name = f"nearest-{uuid.uuid4().hex[:8]}"
    points, number = work.write(f"{name}-points", usable(vectors))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not number:
        return empty
    wanted_centroids = int(min(MOST_CENTROIDS, max(4, 2 ** round(np.log2(np.sqrt(number / 4) + 1)))))
    share = SAMPLE_PER_CENTROID * wanted_centroids / number
    draw = F.pmod(F.xxhash64(F.lit("centroids"), F.col("vec_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    sample = points.filter(draw < share).select("vector").toArrow().to_pandas()
    if not len(sample):
        sample = points.select("vector").limit(wanted_centroids).toArrow().to_pandas()
    sampled = np.stack(sample.vector)
    half = max(1, sampled.shape[1] // 2)
    low = _centroids(sampled[:, :half], wanted_centroids, 1)
    high = _centroids(sampled[:, half:], wanted_centroids, 2)
    shared = spark.sparkContext.broadcast((low, high))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = shared.value
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(1))
                cell = [pa.array(_nearest(rows[:, :half], low)), pa.array(_nearest(rows[:, half:], high))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *cell], names=["vec_id", "vector", "first", "second"])

    placed, _ = work.write(f"{name}-cells", points.mapInArrow(place, "vec_id long, vector array<double>, first long, second long"))
    sizes, _ = work.write(f"{name}-sizes", placed.groupBy("first", "second").agg(F.count(F.lit(1)).alias("size")))
    held = sizes.toArrow().to_pandas()
    counts = np.zeros((len(low), len(high)), np.int64)
    counts[held["first"], held["second"]] = held["size"]
    wanted = max(LEAST_CANDIDATES, int(CANDIDATE_SHARE * number))
    workers = spark.sparkContext.defaultParallelism
    cells = np.flatnonzero(counts)
    held = counts.ravel()[cells]
    group, parts = groups_of_cells(held, int(np.clip(number // (4 * workers), 1024, VECTORS_PER_GROUP)))
    number_of_groups = int(group[-1] + parts[-1])
    book = spark.sparkContext.broadcast((low, high, cells, held, group, parts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, high, cells, _, group, parts = book.value
        done = 0
        for batch in batches:
            cell = np.searchsorted(cells, batch.column(2).to_numpy() * len(high) + batch.column(3).to_numpy())
            part = (done + np.arange(batch.num_rows)) % parts[cell]
            done += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(group[cell] + part)], names=["vec_id", "vector", "first", "second", "group"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, cells, held, group, parts = book.value
        first_of, second_of = np.divmod(cells, len(high))
        begins = np.flatnonzero(np.diff(group, prepend=-1))
        largest = (low**2).sum(axis=1).max() + (high**2).sum(axis=1).max()
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(1))
                first, second = _squares(rows[:, :half], low), _squares(rows[:, half:], high)
                # So much more that sums of another matrix product tell the same cells.
                limits, visited = 1e-12 * ((rows**2).sum(axis=1) + largest), []
                for r in range(len(rows)):
                    sums = first[r, first_of] + second[r, second_of]
                    # One more than wanted, as the query itself is in a cell too.
                    limits[r] += reach(sums, held, wanted + 1)
                    at = begins[np.logical_or.reduceat(~(sums > limits[r]), begins)]
                    visited.append(np.repeat(group[at], parts[at]) + np.arange(parts[at].sum()) - np.repeat(np.cumsum(parts[at]) - parts[at], parts[at]))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, visited)]), pa.int32()), pa.array(np.concatenate(visited)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(limits), lists], names=["query_id", "vector", "reach", "groups"])

    asking = points.filter(is_query).dropDuplicates(["vec_id"]).select("vec_id", "vector")
    queries, number_of_queries = work.write(f"{name}-queries", asking)
    if not number_of_queries:
        return empty
    # Explicit numbers: adaptive execution would merge these few rows into one task, whatever work they make.
    shares = min(number_of_queries, max(workers, -(-number_of_queries // QUERIES_AT_ONCE)))
    fields = "query_id long, vector array<double>, reach double, groups array<long>"
    visits, _ = work.write(f"{name}-visits", queries.repartition(shares, "vec_id").mapInArrow(visit, fields))
    asked = visits.select("query_id", "vector", "reach", F.explode("groups").alias("group"))
    query_parts = F.ceil(F.count(F.lit(1)) / QUERIES_PER_GROUP).cast("int").alias("query_parts")
    asking_parts, _ = work.write(f"{name}-parts", asked.select("group").groupBy("group").agg(query_parts))
    part = F.pmod(F.xxhash64("query_id"), F.col("query_parts")).cast("int")
    keys = ["group", "query_part"]
    asked = asked.join(asking_parts, "group").withColumn("query_part", part).drop("query_parts").repartition(number_of_groups, *keys)
    dealt = placed.mapInArrow(deal, "vec_id long, vector array<double>, first long, second long, group long")
    all_parts = F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("query_part")
    left = dealt.join(asking_parts, "group").select("group", all_parts, "vec_id", "first", "second", "vector").repartition(number_of_groups, *keys)

    def compare(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        low, high, *_ = book.value
        names, parts = ["query_id", "vec_id", "score"], []
        if vectors.num_rows and queries.num_rows:
            vectors = vectors.take(pc.sort_indices(vectors["first"]))
            ids, points = vectors["vec_id"].to_numpy(), _matrix(vectors["vector"])
            cells = vectors["first"].to_numpy(), vectors["second"].to_numpy()
            for start in range(0, queries.num_rows, QUERIES_AT_ONCE):
                some = queries.slice(start, QUERIES_AT_ONCE)
                own, reaches = some["query_id"].to_numpy(), some["reach"].to_numpy()
                best = nearest_of_group(ids, points, cells, own, _matrix(some["vector"]), reaches, (low, high), k)
                parts.append(pa.table([pa.array(own[best.row]), pa.array(ids[best.place]), pa.array(best.score)], names=names))
        return pa.concat_tables(parts) if parts else pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names=names)

    best = left.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
