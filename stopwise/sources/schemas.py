"""Schemas of the source tables, as DDL."""

from __future__ import annotations

from stopwise.config import WEEKDAYS

STOPS = (
    "stop_id string, stop_name string, stop_lat double, stop_lon double, "
    "location_type string, parent_station string, pub_date date"
)
CALENDAR = (
    "service_id string, "
    + ", ".join(f"{day} boolean" for day in WEEKDAYS)
    + ", start_date date, end_date date, pub_date date"
)
TRIPS = (
    "trip_id string, route_id string, service_id string, direction_id int, trip_headsign string, pub_date date"
)
ROUTES = "route_id string, route_short_name string, route_desc string, pub_date date"
STOP_TIMES = (
    "trip_id string, stop_id string, stop_sequence int, arrival_time string, "
    "departure_time string, pub_date date"
)
TRANSFERS = "from_stop_id string, to_stop_id string, min_transfer_time int, pub_date date"
SHAPES = "uuid string, level string, wkb_geometry binary"
ARRIVALS = (
    "bpuic bigint, operating_day date, arr_time timestamp_ntz, dep_time timestamp_ntz, "
    "arr_actual timestamp_ntz, arr_status string, product_id string, unplanned boolean, "
    "failed boolean, transit boolean"
)
WEATHER_STATIONS = "Name string, lat string, lon string, Active string"
WEATHER_HISTORY = (
    "site string, observations array<struct<valid_time_gmt: bigint, precip_hrly: double, temp: int>>"
)
DISTRIBUTIONS = (
    "stop_id string, hour int, rain boolean, temperature string, percentiles array<bigint>, "
    "sample_size bigint, level int"
)
