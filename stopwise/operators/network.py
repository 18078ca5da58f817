"""Reversed travel network: ride hops and walking edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.config import SEQUENCE_CHUNK, WALKING, WALKING_SPEED_MPS
from stopwise.functions.geo import METRES_PER_DEGREE, sphere_distance
from stopwise.operators.hot_keys import split_hot_keys

STOP_COLUMNS = ("stop_id", "stop_name", "stop_lon", "stop_lat", "parent_stop_id")
HOP_KEY = ("trip_id", "direction_id", "source_stop_sequence")


def _stop(alias: str, prefix: str) -> list[Column]:
    return [F.col(f"{alias}.{c}").alias(f"{prefix}_{c}") for c in STOP_COLUMNS]


def trip_hops(timetable: DataFrame) -> DataFrame:
    """Edges from each stop of a trip back to the stop before it.

    Every stop time takes part in two hops: it ends the one of its own sequence number and starts
    the next. One aggregate on (trip, direction, sequence) brings both ends together, so a trip is never
    gathered whole. Of stop times with one sequence number the latest is taken, for both hops the same.
    """
    stop = F.struct(*STOP_COLUMNS)
    description = F.format_string(
        "%s - %s (%s)", *[F.coalesce(c, F.lit("null")) for c in ("route_short_name", "route_desc", "trip_headsign")]
    )
    time = F.struct("arr_s", "dep_s", stop.alias("stop"), description.alias("trip_description"))
    none = F.lit(None).cast(_type_of(timetable, time))
    roles = F.array(
        F.struct(F.col("stop_sequence").alias("at"), time.alias("end"), none.alias("start")),
        F.struct((F.col("stop_sequence") + 1).alias("at"), none.alias("end"), time.alias("start")),
    )
    paired = (
        timetable.filter(F.col("direction_id").isNotNull())
        .select("trip_id", "direction_id", F.inline(roles))
        .groupBy("trip_id", "direction_id", F.col("at").alias("source_stop_sequence"))
        .agg(F.max("end").alias("end"), F.max("start").alias("start"))
        .filter("end.stop.stop_id != start.stop.stop_id")
    )
    return paired.select(
        *_stop("end.stop", "source"),
        *_stop("start.stop", "target"),
        "trip_id",
        "end.trip_description",
        "direction_id",
        "source_stop_sequence",
        F.col("start.dep_s").alias("dep_s"),
        F.col("end.arr_s").alias("arr_s"),
    )


def _type_of(data: DataFrame, column: Column):
    return data.select(column.alias("c")).schema["c"].dataType


def ill_timed_hops(hops: DataFrame) -> DataFrame:
    """Hops that would leave after they arrive; ``ride_runs`` leaves them out."""
    return hops.filter(F.col("dep_s") > F.col("arr_s"))


def ride_runs(hops: DataFrame, chunk: int = SEQUENCE_CHUNK) -> DataFrame:
    """Well-timed hops with ``run_start``: the first hop of the unbroken stretch they belong to.

    A stretch breaks where a hop is missing, where two hops do not meet at a stop, or where the vehicle would leave a stop
    before it arrives.
    Trips are cut into chunks of sequence numbers so that no task needs a whole trip; the last hop of a
    chunk is repeated in the next one, and stretches that reach a chunk's end are carried over.
    """
    seq = F.col("source_stop_sequence")
    timed = hops.filter(F.col("dep_s") <= F.col("arr_s"))
    own = F.floor(seq / chunk)
    last = F.pmod(seq, F.lit(chunk)) == chunk - 1
    chunked = timed.withColumn(
        "chunk", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    within = Window.partitionBy("trip_id", "direction_id", "chunk").orderBy("source_stop_sequence")
    before = F.lag(F.struct(seq.alias("seq"), "arr_s", F.col("source_stop_id").alias("stop_id"))).over(within)
    meets = before.stop_id == F.col("target_stop_id")
    joined = (before.seq == seq - 1) & (before.arr_s <= F.col("dep_s")) & meets
    marked = chunked.withColumn("breaks", ~F.coalesce(joined, F.lit(False))).filter(F.col("chunk") == own)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    started = marked.withColumn("started", F.max(F.when(F.col("breaks"), seq)).over(upto))

    order = Window.partitionBy("trip_id", "direction_id").orderBy("chunk")
    carried = started.filter(last).select(
        "trip_id",
        "direction_id",
        (F.col("chunk") + 1).alias("chunk"),
        F.max("started").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("carried"),
    )
    return (
        started.join(carried, ["trip_id", "direction_id", "chunk"], "left")
        .withColumn("run_start", F.coalesce("started", "carried"))
        .drop("chunk", "breaks", "started", "carried")
    )


def nearby_pairs(stops: DataFrame, max_distance: float) -> DataFrame:
    """Ordered pairs ``(source, target, distance)`` of different stops within ``max_distance`` metres.

    Stops meet on grid cells at least as large as the distance: a stop sits in one cell and is offered to the
    cells around it. Every row of cells has as many columns as its own latitude allows, and columns go round the globe.
    """
    height = max_distance / METRES_PER_DEGREE
    row = F.floor(F.col("stop_lat") / height)

    def columns(row: Column) -> Column:
        """Cells of a row; a cell spans what the distance can span between the rows next to it."""
        steepest = F.least(F.greatest(F.abs((row - 1) * height), F.abs((row + 2) * height)), F.lit(90.0))
        half = F.sin(F.radians(F.lit(height)) / 2) / F.greatest(F.cos(F.radians(steepest)), F.lit(1e-12))
        widest = F.degrees(2 * F.asin(F.least(half, F.lit(1.0)))) * (1 + 1e-9)
        return F.greatest(F.floor(360 / widest), F.lit(1))

    def column(row: Column) -> Column:
        return F.floor((F.col("stop_lon") + 180) / 360 * columns(row))

    stop = F.struct(*STOP_COLUMNS).alias("stop")
    gridded = stops.select(stop, F.pmod(column(row), columns(row)).alias("cell_x"), row.alias("cell_y"))
    around = [F.lit(i) for i in (-1, 0, 1)]
    rows = stops.withColumn("cell_y", F.explode(F.array(*[row + i for i in around])))
    at = F.col("cell_y")
    beside = F.array_distinct(F.array(*[F.pmod(column(at) + i, columns(at)) for i in around]))
    offered = rows.select(stop, F.explode(beside).alias("cell_x"), "cell_y")
    left, right = split_hot_keys(gridded, offered, ["cell_x", "cell_y"], ["stop"], rows_per_split=1000)
    pairs = left.withColumnRenamed("stop", "source").join(
        right.withColumnRenamed("stop", "target"), ["cell_x", "cell_y", "split"]
    )
    distance = sphere_distance(
        F.col("source.stop_lon"), F.col("source.stop_lat"), F.col("target.stop_lon"), F.col("target.stop_lat")
    )
    return pairs.select("source", "target", distance.alias("distance")).filter(
        (F.col("source.stop_id") != F.col("target.stop_id")) & (F.col("distance") <= max_distance)
    )


def transfer_times(pairs: DataFrame, transfers: DataFrame) -> DataFrame:
    """Pairs with the longest minimum transfer time given for them, 0 where none is given."""
    longest = transfers.groupBy(
        F.col("from_stop_id").alias("source_stop_id"), F.col("to_stop_id").alias("target_stop_id")
    ).agg(F.max("transfer_time").alias("transfer_time"))
    joined = pairs.join(longest, ["source_stop_id", "target_stop_id"], "left")
    return joined.withColumn("transfer_time", F.coalesce("transfer_time", F.lit(0)))


def walking_edges(
    stops: DataFrame,
    transfers: DataFrame,
    max_distance: float,
    walking_speed: float = WALKING_SPEED_MPS,
) -> DataFrame:
    """Walking edges in both directions with whole seconds of walking and the minimum transfer time."""
    pairs = nearby_pairs(stops, max_distance).select(
        *_stop("source", "source"),
        *_stop("target", "target"),
        (F.col("distance") / walking_speed).cast("long").alias("walk_s"),
    )
    return transfer_times(pairs, transfers)


def network(hops: DataFrame, walks: DataFrame) -> DataFrame:
    """Ride and walking edges in one typed table."""
    ends = [f"{end}_{c}" for end in ("source", "target") for c in STOP_COLUMNS]
    rides = hops.select(
        *ends,
        "trip_id",
        "trip_description",
        "source_stop_sequence",
        F.lit("ride").alias("kind"),
        F.lit(0).alias("transfer_time"),
        "dep_s",
        "arr_s",
        F.lit(None).cast("long").alias("walk_s"),
    )
    null_int = F.lit(None).cast("int")
    on_foot = walks.select(
        *ends,
        F.lit(WALKING).alias("trip_id"),
        F.lit("Walking").alias("trip_description"),
        null_int.alias("source_stop_sequence"),
        F.lit("walk").alias("kind"),
        "transfer_time",
        null_int.alias("dep_s"),
        null_int.alias("arr_s"),
        "walk_s",
    )
    return rides.unionByName(on_foot)


def unique_edges(edges: DataFrame) -> DataFrame:
    """One edge per (source, target, trip): the latest departure, the shorter walk."""
    key = ("source_stop_id", "target_stop_id", "trip_id")
    rest = [c for c in edges.columns if c not in key and c not in ("dep_s", "walk_s")]
    order = F.struct("dep_s", (-F.col("walk_s")).alias("brisk"), *rest)
    best = edges.groupBy(*key).agg(F.max(order).alias("e"))
    picked = best.select(*key, "e.dep_s", (-F.col("e.brisk")).alias("walk_s"), *[f"e.{c}" for c in rest])
    return picked.select(*edges.columns)


def without_edges(edges: DataFrame, banned: DataFrame) -> DataFrame:
    """Edges not listed in ``banned`` (source_stop_id, target_stop_id, trip_id)."""
    return edges.join(banned, ["source_stop_id", "target_stop_id", "trip_id"], "left_anti")


def stop_ends(edges: DataFrame) -> DataFrame:
    """Both ends of every edge as stop rows."""
    ends = F.array(*[F.struct(*[F.col(f"{end}_{c}").alias(c) for c in STOP_COLUMNS]) for end in ("source", "target")])
    return edges.select(F.inline(ends))


def stop_listing(edges: DataFrame) -> DataFrame:
    """Stops of the network by name."""
    return stop_ends(edges).select("stop_name", "stop_id").distinct().orderBy("stop_name", "stop_id")


def node_conflicts(nodes: DataFrame) -> DataFrame:
    """Stop ids that come with more than one name or position; the parent does not count.

    Equal rows are merged before the count, so a stop repeated many times costs nothing.
    """
    distinct = nodes.select("stop_id", "stop_name", "stop_lon", "stop_lat").distinct()
    return (
        distinct.groupBy("stop_id")
        .agg(F.count(F.lit(1)).alias("versions"))
        .filter("versions > 1")
    )
