"""Timetable of one travel day from schedule snapshots."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.config import BUSINESS_DAYS, DAY_S, MAX_ARRIVAL_HOUR, MIN_DEPARTURE_HOUR, WEEKDAYS
from stopwise.functions.times import day_shift, parse_clock, rotate_weekdays, wrap_clock
from stopwise.operators.regions import stops_within


def latest_snapshot(table: DataFrame, day: dt.date) -> DataFrame:
    """One row ``(pub_date)``: the last publication on or before ``day``, null if there is none."""
    return table.filter(F.col("pub_date") <= F.lit(day)).agg(F.max("pub_date").alias("pub_date"))


def at_snapshot(table: DataFrame, snapshot: Column) -> DataFrame:
    return table.filter(F.col("pub_date") == snapshot)


def snapshot_stops(stops: DataFrame, snapshot: Column, polygons: DataFrame) -> DataFrame:
    """Boarding stops (no ``location_type``) inside the polygons, with a cleaned parent id."""
    boarding = at_snapshot(stops, snapshot).filter(F.col("location_type").isNull())
    parent = F.regexp_replace("parent_station", "Parent", "")
    return stops_within(
        boarding.select("stop_id", "stop_name", "stop_lat", "stop_lon", parent.alias("parent_stop_id")), polygons
    ).distinct()


def service_calendar(calendar: DataFrame, snapshot: Column, day: dt.date) -> DataFrame:
    """Services of the snapshot valid on ``day``, with their weekday flags."""
    valid = at_snapshot(calendar, snapshot).filter(F.lit(day).between(F.col("start_date"), F.col("end_date")))
    return valid.select("service_id", *WEEKDAYS).distinct()


def snapshot_trips(trips: DataFrame, snapshot: Column) -> DataFrame:
    columns = ("trip_id", "route_id", "service_id", "direction_id", "trip_headsign")
    return at_snapshot(trips, snapshot).select(*columns).distinct()


def snapshot_routes(routes: DataFrame, snapshot: Column) -> DataFrame:
    return at_snapshot(routes, snapshot).select("route_id", "route_short_name", "route_desc").distinct()


def snapshot_transfers(transfers: DataFrame, snapshot: Column) -> DataFrame:
    return at_snapshot(transfers, snapshot).select(
        "from_stop_id", "to_stop_id", F.col("min_transfer_time").alias("transfer_time")
    )


def clock_times(stop_times: DataFrame) -> DataFrame:
    """Replace the text times by ``arr_s`` and ``dep_s`` within a day and add the day ``shift``.

    The shift follows the departure; the arrival is brought into the day on its own.
    """
    departure, arrival = parse_clock(F.col("departure_time")), parse_clock(F.col("arrival_time"))
    return stop_times.withColumns(
        {
            "dep_s": wrap_clock(departure),
            "arr_s": wrap_clock(arrival),
            "shift": day_shift(departure),
        }
    ).drop("departure_time", "arrival_time")


def shift_weekdays(timed: DataFrame) -> DataFrame:
    """Weekday flags as they apply to the shifted calendar day."""
    flags = rotate_weekdays([F.col(d) for d in WEEKDAYS], F.col("shift"))
    return timed.withColumns(dict(zip(WEEKDAYS, flags)))


def business_shifts(calendar: DataFrame) -> DataFrame:
    """Services with ``business``: for each day shift from 0 to 6, whether all working days are served."""
    served = []
    for shift in range(len(WEEKDAYS)):
        rotated = dict(zip(WEEKDAYS, rotate_weekdays([F.col(d) for d in WEEKDAYS], F.lit(shift))))
        served.append(reduce(lambda a, b: a & b, [rotated[d] for d in BUSINESS_DAYS]))
    return calendar.select("service_id", F.array(*served).alias("business"))


def timetable(
    stop_times: DataFrame,
    stops: DataFrame,
    trips: DataFrame,
    calendar: DataFrame,
    routes: DataFrame,
    deadline_s: int = DAY_S - 1,
    min_departure_hour: int = MIN_DEPARTURE_HOUR,
    max_arrival_hour: int = MAX_ARRIVAL_HOUR,
) -> DataFrame:
    """Stop times of working-day services within the hours and before the deadline.

    Conditions on times need no join, so they come first; which shifts a service serves is settled once
    per service. The join with stops precedes the one with
    trips: what follows groups by trip and can use the last join's partitioning.
    """
    latest = min(deadline_s, (max_arrival_hour + 1) * 3600 - 1)
    timed = clock_times(stop_times).filter(
        (F.col("arr_s") <= latest) & (F.col("dep_s") >= min_departure_hour * 3600)
    )
    described = trips.join(business_shifts(calendar), "service_id").join(routes, "route_id")
    joined = timed.drop("pub_date").join(stops, "stop_id").join(described, "trip_id")
    return joined.filter(F.get("business", F.col("shift"))).drop("business")
