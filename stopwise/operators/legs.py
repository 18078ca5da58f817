"""Legs of journeys: timing, compression, transfers and slack.

Leg tables have one row per leg, ``leg`` numbering the legs of a ``journey_id`` from 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.config import WALKING, WALKING_SPEED_MPS
from stopwise.functions.times import clock_hour, duration_text, format_clock


def timed_legs(legs: Column, departure: Column) -> Column:
    """Forward legs with the times of walks set from a running clock that starts at ``departure``.

    A walk lasts its walking time; what the minimum transfer time adds is waiting.
    """

    def step(acc: Column, leg: Column) -> Column:
        walks = leg.kind == "walk"
        start = F.when(walks, acc.clock).otherwise(leg.dep_s).cast("int")
        end = F.when(walks, acc.clock + leg.walk_s).otherwise(leg.arr_s).cast("int")
        timed = leg.withField("dep_s", start).withField("arr_s", end)
        return F.struct(end.alias("clock"), F.array_append(acc.done, timed).alias("done"))

    start = F.struct(departure.cast("int").alias("clock"), F.slice(legs, 1, 0).alias("done"))
    return F.aggregate(legs, start, step, lambda acc: acc.done)


def explode_legs(journeys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Leg rows of journeys with a ``legs`` array."""
    return journeys.select(*keys, F.posexplode("legs").alias("leg", "l")).select(*keys, "leg", "l.*")


def compress_legs(legs: DataFrame, keys: Sequence[str] = ("journey_id",)) -> DataFrame:
    """Merge consecutive legs on the same trip into one; walks stay as they are."""
    along = Window.partitionBy(*keys).orderBy("leg")
    same = (F.col("trip_id") != WALKING) & (F.col("trip_id") == F.lag("trip_id").over(along))
    starts = F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)
    part = F.sum("starts").over(along.rowsBetween(Window.unboundedPreceding, 0)) - 1
    parts = legs.withColumn("starts", starts).withColumn("part", part)
    return parts.groupBy(*keys, F.col("part").cast("int").alias("leg")).agg(
        F.first("trip_id").alias("trip_id"),
        F.min_by("from_stop_id", F.col("leg")).alias("from_stop_id"),
        F.max_by("to_stop_id", F.col("leg")).alias("to_stop_id"),
        F.min_by("dep_s", F.col("leg")).alias("dep_s"),
        F.max_by("arr_s", F.col("leg")).alias("arr_s"),
    )


def transfer_counts(legs: DataFrame, keys: Sequence[str] = ("journey_id",)) -> DataFrame:
    """Number of changes of trip per journey; walking counts as one trip."""
    along = Window.partitionBy(*keys).orderBy("leg")
    change = (F.col("trip_id") != F.lag("trip_id").over(along)).cast("int")
    changes = legs.withColumn("change", F.coalesce(change, F.lit(0)))
    return changes.groupBy(*keys).agg(F.sum("change").alias("transfers"))


def leg_slack(legs: DataFrame, keys: Sequence[str] = ("journey_id",), deadline: str = "deadline_s") -> DataFrame:
    """Per ride: time of readiness after the walks that follow it, and slack to the next ride or deadline.

    Walks before the first ride do not count.
    """
    along = Window.partitionBy(*keys).orderBy("leg")
    rides = F.col("trip_id") != WALKING
    numbered = legs.withColumn("ride", F.sum(rides.cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    merged = (
        numbered.filter("ride > 0")
        .groupBy(*keys, "ride", deadline)
        .agg(
            F.max(F.when(rides, F.col("trip_id"))).alias("trip_id"),
            F.max(F.when(rides, F.col("to_stop_id"))).alias("to_stop_id"),
            F.max(F.when(rides, F.col("dep_s"))).alias("dep_s"),
            F.max(F.when(rides, F.col("arr_s"))).alias("arr_s"),
            F.sum(F.when(~rides, F.col("arr_s") - F.col("dep_s")).otherwise(0)).alias("walk_s"),
        )
    )
    by_ride = Window.partitionBy(*keys).orderBy("ride")
    ready = F.col("arr_s") + F.col("walk_s")
    leaves = F.coalesce(F.lead("dep_s").over(by_ride), F.col(deadline))
    return merged.select(
        *keys,
        F.col("ride").cast("int").alias("ride"),
        "trip_id",
        "to_stop_id",
        F.pmod(clock_hour(ready), F.lit(24)).alias("hour"),
        (leaves - ready).alias("slack_s"),
    )


def journey_facts(journeys: DataFrame, walking_speed: float = WALKING_SPEED_MPS) -> DataFrame:
    """Header facts of journeys with timed ``legs``, with readable times."""
    first, last = F.get("legs", F.lit(0)), F.element_at("legs", -1)
    duration = last.arr_s - first.dep_s
    return journeys.withColumns(
        {
            "departure": format_clock(first.dep_s),
            "arrival": format_clock(last.arr_s),
            "duration_s": duration,
            "duration": duration_text(duration),
            "walked_m": F.col("walked_s") * walking_speed,
        }
    )


def leg_report(legs: DataFrame, hops: DataFrame, walking_speed: float = WALKING_SPEED_MPS) -> DataFrame:
    """Readable leg rows: trip description from the ride hops or walked metres, and times."""
    trips = hops.groupBy("trip_id").agg(F.max("trip_description").alias("trip_description"))
    metres = F.floor((F.col("arr_s") - F.col("dep_s")) * walking_speed).cast("int")
    description = F.when(F.col("trip_id") == WALKING, F.format_string("Walking %dm", metres)).otherwise(
        F.col("trip_description")
    )
    return legs.join(trips, "trip_id", "left").withColumns(
        {
            "description": description,
            "departure": format_clock(F.col("dep_s")),
            "arrival": format_clock(F.col("arr_s")),
        }
    ).drop("trip_description")
