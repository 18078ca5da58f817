"""Travel network of one day: timetable, ride hops and walking edges."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stopwise.config import DAY_S, MAX_ARRIVAL_HOUR, MIN_DEPARTURE_HOUR, WALKING_SPEED_MPS
from stopwise.operators import timetable as tt
from stopwise.operators.network import network, trip_hops, walking_edges
from stopwise.sources.tables import ScheduleTables


@dataclass(frozen=True)
class Timetable:
    stop_times: DataFrame
    stops: DataFrame
    transfers: DataFrame


def build_timetable(
    tables: ScheduleTables,
    polygons: DataFrame,
    day: dt.date,
    deadline_s: int = DAY_S - 1,
    min_departure_hour: int = MIN_DEPARTURE_HOUR,
    max_arrival_hour: int = MAX_ARRIVAL_HOUR,
) -> Timetable:
    """Timetable inside the polygons from the last snapshot before ``day``."""
    snapshot = tt.latest_snapshot(tables.stops, day).scalar()
    stops = tt.snapshot_stops(tables.stops, snapshot, polygons)
    stop_times = tt.timetable(
        tt.at_snapshot(tables.stop_times, snapshot),
        stops,
        tt.snapshot_trips(tables.trips, snapshot),
        tt.service_calendar(tables.calendar, snapshot, day),
        tt.snapshot_routes(tables.routes, snapshot),
        deadline_s,
        min_departure_hour,
        max_arrival_hour,
    )
    return Timetable(stop_times, stops, tt.snapshot_transfers(tables.transfers, snapshot))


@dataclass(frozen=True)
class TravelNetwork:
    hops: DataFrame
    walks: DataFrame

    @property
    def edges(self) -> DataFrame:
        return network(self.hops, self.walks)


def build_network(
    timetable: Timetable, max_distance: float, walking_speed: float = WALKING_SPEED_MPS
) -> TravelNetwork:
    return TravelNetwork(
        trip_hops(timetable.stop_times),
        walking_edges(timetable.stops, timetable.transfers, max_distance, walking_speed),
    )
