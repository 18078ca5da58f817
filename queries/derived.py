"""Transport tables derived from the given tables, row by row wherever possible.

``queries/check_sql.py`` states the same tables in SQL.
"""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.config import WEEKDAYS
from stopwise.operators.history import Period
from stopwise.plans.delay_model import classified_history
from stopwise.plans.travel_network import Timetable, TravelNetwork, build_network, build_timetable
from stopwise.sources.shapes import POLYGON_CODE, decode_polygons
from stopwise.sources.tables import ScheduleTables, weather_stations

TRAVEL_DAY = dt.date(2024, 6, 3)
REGIONS = tuple(f"D{i}" for i in range(9))
DEADLINE_S = 20 * 3600
MAX_WALK_M = 1000
PERIOD = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
TRAINING_PERIOD = (dt.date(2024, 1, 1), dt.date(2024, 1, 15))
VALIDATION_PERIOD = (dt.date(2024, 1, 16), dt.date(2024, 1, 31))
MIN_CONFIDENCE = 0.3
#: Lines (in expectation) that a task numbers and all that follows on them in that task works on.
LINES_PER_TASK = 250_000

STOP_ID = "concat(8500000 + {k}, if({k} % 4 = 0, ':0:A', ''))"
CELL_LON = "(6.497D + {k} % 10 * 0.006D)"
CELL_LAT = "(46.498D + {k} div 10 * 0.004D)"


def _encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Polygon of one ring per row, as well-known binary."""
    for batch in batches:
        geometry = []
        for ring in batch.column("ring").to_pylist():
            flat = [coordinate for point in ring for coordinate in point]
            geometry.append(
                struct.pack("<BIII", 1, POLYGON_CODE, 1, len(ring)) + struct.pack(f"<{len(flat)}d", *flat)
            )
        columns = [batch.column("uuid"), batch.column("level"), pa.array(geometry, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["uuid", "level", "wkb_geometry"])


@dataclass
class Transport:
    """Transport tables over the Parquet tables in one folder."""

    spark: SparkSession
    root: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    @property
    def stops(self) -> DataFrame:
        k = "s_suppkey"
        return self.table("supplier").selectExpr(
            f"{STOP_ID.format(k=k)} AS stop_id",
            "s_name AS stop_name",
            f"46.50D + {k} div 10 * 0.004D AS stop_lat",
            f"6.50D + {k} % 10 * 0.006D AS stop_lon",
            f"if({k} % 11 = 10, '1', NULL) AS location_type",
            f"if({k} % 5 = 0, concat('Parent', 8500000 + {k}), NULL) AS parent_station",
            f"if({k} % 23 = 22, date'2024-09-01', date'2024-04-01') AS pub_date",
        )

    @property
    def polygons(self) -> DataFrame:
        """One L-shaped polygon per supplier around its stop, whose corner cut sometimes holds the stop."""
        k = "s_suppkey"
        corners = self.table("supplier").selectExpr(
            f"concat('D', {k} % 10, ' ') AS uuid",
            f"if({k} % 13 = 5, 'canton', 'district') AS level",
            f"{CELL_LON.format(k=k)} AS x0",
            f"{CELL_LON.format(k=k)} + 0.006D AS x1",
            f"{CELL_LON.format(k=k)} + if({k} % 17 = 3, 0.002D, 0.005D) AS xm",
            f"{CELL_LAT.format(k=k)} AS y0",
            f"{CELL_LAT.format(k=k)} + 0.004D AS y1",
            f"{CELL_LAT.format(k=k)} + if({k} % 17 = 3, 0.001D, 0.003D) AS ym",
        )
        vertices = ["x0,y0", "x1,y0", "x1,ym", "xm,ym", "xm,y1", "x0,y1", "x0,y0"]
        points = ", ".join(
            "named_struct('lon', {}, 'lat', {})".format(*v.split(",")) for v in vertices
        )
        return corners.selectExpr("uuid", "level", f"array(array({points})) AS rings")

    @property
    def shapes(self) -> DataFrame:
        """The polygons as well-known binary."""
        ring = F.transform(F.get("rings", F.lit(0)), lambda p: F.array(p.lon, p.lat)).alias("ring")
        return self.polygons.select("uuid", "level", ring).mapInArrow(
            _encode, "uuid string, level string, wkb_geometry binary"
        )

    @property
    def decoded_shapes(self) -> DataFrame:
        return decode_polygons(self.shapes)

    @property
    def regions(self) -> DataFrame:
        from stopwise.operators.regions import select_regions

        return select_regions(self.polygons, REGIONS)

    @property
    def routes(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "concat('R', n_nationkey) AS route_id",
            "n_name AS route_short_name",
            "'B' AS route_desc",
            "date'2024-04-01' AS pub_date",
        )

    @property
    def calendar(self) -> DataFrame:
        """Services 0-3 of each seven run on working days, 3 has expired, 4 rests on Friday, 5 runs
        from Sunday to Thursday and 6 at weekends."""
        rule = {d: "n_nationkey % 7 <= 4 OR n_nationkey % 7 = 5" for d in WEEKDAYS[:4]}
        rule["friday"] = "n_nationkey % 7 <= 3"
        rule["saturday"] = "n_nationkey % 7 = 6"
        rule["sunday"] = "n_nationkey % 7 IN (5, 6)"
        return self.table("nation").selectExpr(
            "concat('S', n_nationkey) AS service_id",
            *[f"({condition}) AS {day}" for day, condition in rule.items()],
            "date'2024-01-01' AS start_date",
            "if(n_nationkey % 7 = 3, date'2024-03-01', date'2024-12-31') AS end_date",
            "date'2024-04-01' AS pub_date",
        )

    @property
    def trips(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "concat('T', o_orderkey) AS trip_id",
            "concat('R', o_custkey % 25) AS route_id",
            "concat('S', o_orderkey % 25) AS service_id",
            "cast(o_orderkey % 2 AS int) AS direction_id",
            "o_orderpriority AS trip_headsign",
            "date'2024-04-01' AS pub_date",
        )

    @property
    def lines(self) -> DataFrame:
        """Order lines, numbered anew within their order: the given numbers repeat."""
        order = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
        )
        given = self.table("lineitem")
        # What follows on the lines of an order sorts them again and again in the same tasks, so these are of a bounded size.
        parts = max(self.spark.sparkContext.defaultParallelism, -(-given.count() // LINES_PER_TASK))
        return given.repartition(parts, "l_orderkey").withColumn("line", F.row_number().over(order))

    @property
    def stop_times(self) -> DataFrame:
        """Every line is a stop time of its order's trip."""
        seconds = "21600 + l_orderkey * 97 % 72000 + line * 240"
        clock = (
            "concat_ws(':', lpad(({s}) div 3600, 2, '0'), lpad(({s}) % 3600 div 60, 2, '0'), "
            "lpad(({s}) % 60, 2, '0'))"
        )
        return self.lines.selectExpr(
            "concat('T', l_orderkey) AS trip_id",
            f"{STOP_ID.format(k='l_suppkey')} AS stop_id",
            "cast(line AS int) AS stop_sequence",
            f"{clock.format(s=seconds + ' - 30')} AS arrival_time",
            f"{clock.format(s=seconds)} AS departure_time",
            "date'2024-04-01' AS pub_date",
        )

    @property
    def transfers(self) -> DataFrame:
        k = "s_suppkey"
        return self.table("supplier").selectExpr(
            f"{STOP_ID.format(k=k)} AS from_stop_id",
            f"{STOP_ID.format(k=f'({k} + 1)')} AS to_stop_id",
            f"cast(60 * ({k} % 30) AS int) AS min_transfer_time",
            "date'2024-04-01' AS pub_date",
        )

    @property
    def arrivals(self) -> DataFrame:
        day = "date_add(date'2024-01-01', datediff(l_shipdate, date'1995-01-01') % 30)"
        planned = "l_linenumber * 10800 + 7200 + l_partkey % 60 * 60"
        return (
            self.table("lineitem")
            .selectExpr(
                "8500000 + l_suppkey AS bpuic",
                f"{day} AS operating_day",
                f"timestampadd(SECOND, {planned}, cast({day} AS timestamp_ntz)) AS arr_time",
                "*",
            )
            .selectExpr(
                "bpuic",
                "operating_day",
                "arr_time",
                "if(l_partkey % 13 = 0, NULL, timestampadd(SECOND, 60, arr_time)) AS dep_time",
                "if(l_partkey % 17 = 0, NULL, "
                "timestampadd(SECOND, cast(l_quantity * 40 - 100 AS int), arr_time)) AS arr_actual",
                "element_at(array('REAL', 'GESCHAETZT', 'PROGNOSE', 'UNBEKANNT'), "
                "cast(l_orderkey % 4 AS int) + 1) AS arr_status",
                "element_at(array('Bus', 'BUS', 'Zug', 'Tram', 'Metro', 'Taxi', 'Schiff', '', NULL), "
                "cast(l_orderkey % 9 AS int) + 1) AS product_id",
                "l_partkey % 19 = 0 AS unplanned",
                "l_partkey % 23 = 0 AS failed",
                "l_partkey % 29 = 0 AS transit",
            )
        )

    @property
    def stations(self) -> DataFrame:
        """Weather stations, still as the text columns of the station list."""
        raw = self.table("customer").selectExpr(
            "concat('Site', c_custkey % 3) AS Name",
            "cast(46.50D + c_custkey % 89 * 0.001D AS string) AS lat",
            "cast(6.50D + c_custkey % 97 * 0.001D AS string) AS lon",
            "if(c_custkey % 5 = 0, 'False', 'True') AS Active",
        )
        return weather_stations(raw)

    @property
    def weather_documents(self) -> DataFrame:
        """Documents of at most 64 observations each: event ids are unique."""
        observation = F.expr(
            "named_struct('valid_time_gmt', cast(0 AS bigint), "
            "'precip_hrly', if(event_id % 4 = 0, NULL, value / 20), "
            "'temp', if(event_id % 9 = 0, NULL, cast(event_id * 7 % 30 - 5 AS int)))"
        )
        # Seconds since the epoch of a wall-clock time, whatever the session time zone.
        epoch = F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("ts"))
        return (
            self.table("events")
            .select(
                F.expr("concat('Site', user_id % 3)").alias("site"),
                F.expr("event_id div 64").alias("document"),
                observation.withField("valid_time_gmt", epoch).alias("observation"),
            )
            .groupBy("site", "document")
            .agg(F.collect_list("observation").alias("observations"))
        )

    @property
    def queries(self) -> DataFrame:
        """One journey query per customer."""
        stops = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        numbered = self.table("customer").withColumn("n", stops)
        return numbered.selectExpr(
            "c_custkey AS query_id",
            f"{STOP_ID.format(k='(c_custkey % n)')} AS from_stop_id",
            f"{STOP_ID.format(k='((c_custkey * 7 + 3) % n)')} AS to_stop_id",
            "cast(36000 + 1800 * (c_custkey % 10) AS int) AS arrival_s",
            f"{MAX_WALK_M} AS max_walk_m",
            "cast(1 + c_custkey % 3 AS int) AS k",
            "c_custkey % 2 = 0 AS rain",
            "cast(c_custkey % 25 - 5 AS int) AS temperature_c",
        )

    @property
    def schedule(self) -> ScheduleTables:
        return ScheduleTables(
            self.stops, self.calendar, self.trips, self.routes, self.stop_times, self.transfers
        )

    @cached_property
    def timetable(self) -> Timetable:
        return build_timetable(self.schedule, self.regions, TRAVEL_DAY, DEADLINE_S)

    @cached_property
    def network(self) -> TravelNetwork:
        return build_network(self.timetable, MAX_WALK_M)

    def history_of(self, period: Period) -> DataFrame:
        """Arrivals of a period with rain flag and temperature class, filled from that period alone."""
        return classified_history(
            self.arrivals, self.stops, self.polygons, self.stations, self.weather_documents, REGIONS, period
        )

    @property
    def history(self) -> DataFrame:
        return self.history_of(PERIOD)

    @property
    def journey_legs(self) -> DataFrame:
        """Legs of one journey per order, one for each line."""
        picked = self.lines.withColumnsRenamed({"l_partkey": "p", "l_suppkey": "s"})
        start = "25000 + l_orderkey % 20 * 1800"
        return picked.selectExpr(
            "l_orderkey AS journey_id",
            "cast(line AS int) AS leg",
            "if(p % 4 = 0, 'walking', concat('T', s % 3)) AS trip_id",
            f"{STOP_ID.format(k='s')} AS from_stop_id",
            f"{STOP_ID.format(k='(s + 1)')} AS to_stop_id",
            f"cast({start} + line * 900 AS int) AS dep_s",
            f"cast({start} + line * 900 + 200 + p % 600 AS int) AS arr_s",
            f"cast({start} + 7700 AS int) AS deadline_s",
            "l_orderkey % 2 = 0 AS rain",
            "element_at(array('low', 'medium', 'high'), cast(l_orderkey % 3 AS int) + 1) AS temperature",
        )
