"""The registered queries: every operator of the engine over the derived transport tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.derived import (
    MIN_CONFIDENCE,
    PERIOD,
    REGIONS,
    TRAVEL_DAY,
    TRAINING_PERIOD,
    VALIDATION_PERIOD,
    Transport,
)
from stopwise.config import GROUP_COLUMNS, WEEKDAYS
from stopwise.functions import classify, times
from stopwise.functions.probability import exponential_percentiles, probability_below
from stopwise.operators import distributions, history, legs, network, regions, timetable, validation
from stopwise.operators.confidence import connection_probabilities, journey_confidence
from stopwise.operators.journeys import pick_journeys, search_journeys
from stopwise.operators.latest import latest_departures
from stopwise.plans import delay_model, journey_plan
from stopwise.plans.travel_network import TravelNetwork, build_timetable
from stopwise.sources.shapes import with_bounds
from stopwise.sources.tables import read_weather_documents
from stopwise.sources.workspace import Workspace

Query = Callable[[Transport], DataFrame]
REGISTRY: dict[str, Query] = {}
KS_KEYS = ("stop_id", "type")
KS_MIN_SAMPLES = 15
KS_MIN_GROUP = 2


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, root: query(Transport(spark, root))

    return {name: bind(query) for name, query in REGISTRY.items()}


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _text(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


def _rounded(column: str, digits: int = 6) -> Column:
    return F.round(column, digits).alias(column)


def _nudged(column: str) -> Column:
    """Rounded so that exact halves go the same way whatever the order of multiplication."""
    return F.round(F.col(column) + 1e-9, 6).alias(column)


# Filters and snapshots


@register
def latest_snapshot(t: Transport) -> DataFrame:
    return timetable.latest_snapshot(t.stops, TRAVEL_DAY).select(_text("pub_date"))


@register
def service_calendar(t: Transport) -> DataFrame:
    snapshot = timetable.latest_snapshot(t.stops, TRAVEL_DAY).scalar()
    return timetable.service_calendar(t.calendar, snapshot, TRAVEL_DAY)


@register
def history_clean(t: Transport) -> DataFrame:
    stops = delay_model.region_stops(t.stops, t.regions)
    cleaned = history.arrival_history(t.arrivals, stops, period=PERIOD)
    return cleaned.select("stop_id", _text("operating_day"), _time("arr_time"), "delay", "type")


@register
def weekday_hours(t: Transport) -> DataFrame:
    usable = history.usable_arrivals(t.arrivals, PERIOD)
    return usable.groupBy("bpuic", _text("operating_day"), "product_id").agg(F.count(F.lit(1)).alias("n"))


# Timetable and network


@register
def timetable_of_day(t: Transport) -> DataFrame:
    return t.timetable.stop_times


REGISTRY["timetable"] = REGISTRY.pop("timetable_of_day")


@register
def timetable_whole_day(t: Transport) -> DataFrame:
    """All hours, so that trips that run past midnight show their shifted weekdays."""
    day = build_timetable(t.schedule, t.regions, TRAVEL_DAY, min_departure_hour=0, max_arrival_hour=23)
    return day.stop_times.select("trip_id", "stop_id", "stop_sequence", "arr_s", "dep_s", "shift")


@register
def trip_edges(t: Transport) -> DataFrame:
    return t.network.hops


@register
def ride_runs(t: Transport) -> DataFrame:
    return network.ride_runs(t.network.hops).select(
        "trip_id", "direction_id", "source_stop_sequence", "dep_s", "arr_s", "run_start"
    )


@register
def ill_timed_hops(t: Transport) -> DataFrame:
    # Departures are moved so that some hops are ill timed; those of the tables are not.
    moved = F.col("dep_s") + F.col("source_stop_sequence") % 3 * 200
    hops = t.network.hops.withColumn("dep_s", moved)
    return network.ill_timed_hops(hops).select("trip_id", "source_stop_sequence", "dep_s", "arr_s")


@register
def walking_edges(t: Transport) -> DataFrame:
    return t.network.walks


@register
def transfer_override(t: Transport) -> DataFrame:
    takes = F.greatest("walk_s", F.col("transfer_time").cast("long")).alias("takes_s")
    return t.network.walks.select("source_stop_id", "target_stop_id", "walk_s", "transfer_time", takes)


@register
def stops_in_region(t: Transport) -> DataFrame:
    return delay_model.region_stops(t.stops, t.regions)


@register
def wkb_shapes(t: Transport) -> DataFrame:
    vertices = F.aggregate("rings", F.lit(0), lambda n, ring: n + F.size(ring))
    return (
        with_bounds(t.decoded_shapes)
        .withColumn("vertices", vertices)
        .groupBy(F.trim("uuid").alias("uuid"), "level")
        .agg(
            F.count(F.lit(1)).alias("polygons"),
            F.sum("vertices").alias("vertices"),
            F.min("min_lon").alias("min_lon"),
            F.max("max_lat").alias("max_lat"),
        )
    )


@register
def travel_network(t: Transport) -> DataFrame:
    edges = network.unique_edges(t.network.edges)
    return edges.select(
        "source_stop_id", "target_stop_id", "trip_id", "trip_description", "source_stop_sequence", "kind",
        "transfer_time", "dep_s", "arr_s", "walk_s",
    )


REGISTRY["network"] = REGISTRY.pop("travel_network")


@register
def remaining_edges(t: Transport) -> DataFrame:
    edges = t.network.edges.select("source_stop_id", "target_stop_id", "trip_id", "arr_s")
    banned = edges.filter(F.col("arr_s") % 2 == 0).drop("arr_s")
    return network.without_edges(edges.drop("arr_s"), banned)


@register
def stop_listing(t: Transport) -> DataFrame:
    return network.stop_listing(t.network.edges)


@register
def node_conflicts(t: Transport) -> DataFrame:
    def named(table: str, key: str, name: str) -> DataFrame:
        return t.table(table).select(
            (F.col(key) + 8500000).alias("stop_id"),
            F.col(name).alias("stop_name"),
            F.lit(0.0).alias("stop_lon"),
            F.lit(0.0).alias("stop_lat"),
        )

    suppliers, customers = named("supplier", "s_suppkey", "s_name"), named("customer", "c_custkey", "c_name")
    return network.node_conflicts(suppliers.unionByName(customers))


# Delay model


@register
def stop_prefix_semi(t: Transport) -> DataFrame:
    kept = history.stations_semi_join(t.arrivals, delay_model.region_stops(t.stops, t.regions))
    return kept.groupBy("stop_id").agg(F.count(F.lit(1)).alias("n"))


@register
def closest_site(t: Transport) -> DataFrame:
    nearest = regions.closest_site(t.stations, regions.region_centroid(t.regions))
    return nearest.select("site", _rounded("distance", 3))


@register
def region_centroid(t: Transport) -> DataFrame:
    return regions.region_centroid(t.regions).select(_rounded("lon"), _rounded("lat"))


@register
def overlapping_regions(t: Transport) -> DataFrame:
    """Area and centroid of the regions together with copies of them moved by less than their size."""
    moved = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct((p.lon + 0.0023).alias("lon"), (p.lat + 0.0017).alias("lat"))))
    parts = regions.union_moments(t.regions.union(t.regions.withColumn("rings", moved)))
    return parts.selectExpr("round(area * 1e6, 6) AS area", "round(mx / area, 6) AS lon", "round(my / area, 6) AS lat")


def _weather(t: Transport) -> DataFrame:
    site = regions.closest_site(t.stations, regions.region_centroid(t.regions)).select("site").scalar()
    return history.hourly_weather(t.weather_documents, site, PERIOD)


@register
def weather_hourly(t: Transport) -> DataFrame:
    return _weather(t).withColumn("rain", F.round("rain", 6))


@register
def weather_json(t: Transport) -> DataFrame:
    """Weather documents written one a line, every seventh without its last character, and read back."""
    text = F.to_json(F.struct("site", "observations"))
    cut = F.when(F.col("document") % 7 == 3, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    path = f"{Workspace(t.spark).root}/weather"
    t.weather_documents.select(cut.alias("value")).write.text(path)
    read = read_weather_documents(t.spark, path, one_per_line=True)
    return read.groupBy("site", F.col("malformed").isNotNull().alias("malformed")).agg(
        F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.size("observations")), F.lit(0)).cast("long").alias("observations")
    )


def _history_weather(t: Transport) -> DataFrame:
    stops = delay_model.region_stops(t.stops, t.regions)
    return history.add_weather(history.arrival_history(t.arrivals, stops, period=PERIOD), _weather(t))


@register
def history_weather(t: Transport) -> DataFrame:
    return _history_weather(t).select(
        "stop_id", _time("arr_time"), "delay", "type", "year", "month", "weekofyear", "dayofmonth", "hour",
        _rounded("rain"), "temperature",
    )


@register
def impute_rain(t: Transport) -> DataFrame:
    filled = history.fill_rain(_history_weather(t))
    return filled.select("stop_id", _time("arr_time"), "delay", "type", _rounded("rain"))


@register
def impute_temperature(t: Transport) -> DataFrame:
    filled = history.fill_temperature(_history_weather(t))
    return filled.select("stop_id", _time("arr_time"), "delay", "type", _rounded("temperature"))


@register
def group_counts(t: Transport) -> DataFrame:
    return distributions.group_counts(t.history, GROUP_COLUMNS, 3)


def _percentiles_as_text(data: DataFrame) -> DataFrame:
    return data.withColumn("percentiles", F.concat_ws(",", F.col("percentiles").cast("array<string>")))


@register
def delay_percentiles(t: Transport) -> DataFrame:
    return _percentiles_as_text(distributions.delay_percentiles(t.history, ["stop_id"]))


@register
def delay_sketches(t: Transport) -> DataFrame:
    """Percentiles per stop from sketches per full key, held against the exact ranks."""
    arrivals, _ = Workspace(t.spark).write("history", t.history)
    sketches = distributions.merge_sketches(distributions.delay_sketches(arrivals), ["stop_id"])
    found = distributions.rank_errors(distributions.sketch_percentiles(sketches), arrivals, ["stop_id"])
    return found.select("stop_id", "sample_size", "within")


@register
def delay_distributions(t: Transport) -> DataFrame:
    return _percentiles_as_text(delay_model.fit(t.history))


@register
def delay_distributions_min5(t: Transport) -> DataFrame:
    return _percentiles_as_text(delay_model.fit(t.history, 5))


# Scalar functions over whole tables


@register
def gtfs_times(t: Transport) -> DataFrame:
    seconds = F.expr("21600 + l_orderkey * 97 % 72000 + l_linenumber * 240")
    clock = F.format_string("%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60)
    parsed = times.parse_clock(F.col("departure_time"))
    return (
        t.table("lineitem")
        .select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", clock.alias("departure_time"))
        .withColumns({"clock": times.format_clock(times.wrap_clock(parsed)), "shift": times.day_shift(parsed)})
    )


@register
def weekday_shift(t: Transport) -> DataFrame:
    shift = F.expr("l_linenumber % 4 + if(l_linenumber % 4 = 3, 4, 0)")
    lines = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shift.alias("shift"),
        F.expr("concat('S', l_orderkey % 25)").alias("service_id"),
    )
    shifted = timetable.shift_weekdays(lines.join(t.calendar.select("service_id", *WEEKDAYS), "service_id"))
    return shifted.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "monday", "friday")


@register
def classify_vehicle(t: Transport) -> DataFrame:
    product = F.col("product_id")
    return t.arrivals.groupBy(product, classify.vehicle_type(product).alias("type")).agg(
        F.count(F.lit(1)).alias("n")
    )


@register
def discretise_weather(t: Transport) -> DataFrame:
    observed = t.weather_documents.select(F.inline("observations"))
    classed = history.classify_weather(
        observed.select(F.col("precip_hrly").alias("rain"), F.col("temp").alias("temperature"))
    )
    return classed.groupBy("rain", "temperature").agg(F.count(F.lit(1)).alias("n"))


@register
def clip_delay(t: Transport) -> DataFrame:
    delay = F.expr("if(l_partkey % 17 = 0, NULL, cast(l_quantity * 40 - 100 AS bigint))")
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", classify.clip_delay(delay).alias("delay")
    )


@register
def duration_text(t: Transport) -> DataFrame:
    seconds = F.col("c_custkey") * 37 % 90000
    return t.table("customer").select("c_custkey", times.duration_text(seconds).alias("duration"))


@register
def time_arith(t: Transport) -> DataFrame:
    clock = F.col("o_orderkey") * 7919 % 86400
    amount = F.col("o_custkey") * 61 % 86400
    return t.table("orders").select(
        "o_orderkey",
        times.format_clock(times.add_seconds(clock, amount)).alias("later"),
        times.format_clock(times.subtract_seconds(clock, amount)).alias("earlier"),
        times.seconds_between(clock, amount).alias("apart"),
    )


@register
def local_time(t: Transport) -> DataFrame:
    epoch = F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("ts"))
    local = times.local_time(epoch + F.col("event_id") % 12 * 2629800)
    return t.table("events").select(
        "event_id",
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local"),
        F.initcap(times.weekday_name(local)).alias("weekday"),
    )


@register
def parse_local(t: Transport) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.table("events").select(
        "event_id", F.date_format(times.parse_local(text), "yyyy-MM-dd HH:mm:ss").alias("utc")
    )


@register
def exp_percentiles(t: Transport) -> DataFrame:
    chance = probability_below(F.col("value") / 10, exponential_percentiles(0.2))
    return t.table("events").select("event_id", F.round(chance, 6).alias("probability"))


@register
def error_bounds(t: Transport) -> DataFrame:
    known = t.table("customer").select("c_custkey", F.expr("0.1D + c_custkey % 80 / 100.0D").alias("p"))
    curve = validation.confidence_error_curve(known, "p", 0.1)
    return curve.select("c_custkey", "transfers", *[_rounded(c) for c in ("expected", "lowest", "highest")])


# Legs and confidence


@register
def compress_legs(t: Transport) -> DataFrame:
    return legs.compress_legs(t.journey_legs)


@register
def transfer_count(t: Transport) -> DataFrame:
    return legs.transfer_counts(t.journey_legs)


JOURNEY_CONTEXT = ("journey_id", "deadline_s", "rain", "temperature")


def _compressed(t: Transport) -> DataFrame:
    return legs.compress_legs(t.journey_legs, JOURNEY_CONTEXT)


@register
def leg_slack(t: Transport) -> DataFrame:
    return legs.leg_slack(_compressed(t)).select("journey_id", "ride", "trip_id", "to_stop_id", "hour", "slack_s")


@register
def cdf_lookup(t: Transport) -> DataFrame:
    slacks = legs.leg_slack(_compressed(t), ["journey_id", "rain", "temperature"])
    chances = connection_probabilities(slacks, delay_model.fit(t.history))
    return chances.select(
        "journey_id", "ride", "to_stop_id", "hour", "slack_s", "sample_size", _nudged("probability")
    )


@register
def journey_confidence_of_legs(t: Transport) -> DataFrame:
    confidence = journey_confidence(_compressed(t), delay_model.fit(t.history))
    return confidence.select("journey_id", _nudged("confidence"))


REGISTRY["journey_confidence"] = REGISTRY.pop("journey_confidence_of_legs")


# Journey search


@register
def best_journey(t: Transport) -> DataFrame:
    found = latest_departures(t.queries, t.network.hops, t.network.walks, Workspace(t.spark))
    return found.select("query_id", "from_stop_id", "to_stop_id", "arrival_s", "cost")


@register
def k_journeys(t: Transport) -> DataFrame:
    labels = search_journeys(t.queries, t.network.hops, t.network.walks, Workspace(t.spark))
    return pick_journeys(t.queries, labels).select(
        "query_id", "from_stop_id", "to_stop_id", "journey_rank", "cost", "dep_s", "transfers", "walked_s"
    )


@register
def journey_legs(t: Transport) -> DataFrame:
    work = Workspace(t.spark)
    # The search and the report look at the hops.
    hops, _ = work.write("network-hops", t.network.hops)
    found = journey_plan.find_journeys(t.queries, TravelNetwork(hops, t.network.walks), work)
    rows = legs.explode_legs(found, ["query_id", "journey_rank"])
    return legs.leg_report(rows, hops).select(
        "query_id", "journey_rank", "leg", "description", "trip_id", "from_stop_id", "to_stop_id", "departure",
        "arrival",
    )


@register
def journey_plan_with_confidence(t: Transport) -> DataFrame:
    planned = journey_plan.plan_journeys(
        t.queries, t.network, delay_model.fit(t.history), Workspace(t.spark), MIN_CONFIDENCE
    )
    return planned.select(
        "query_id", "from_stop_id", "to_stop_id", "journey_rank", "departure", "arrival", "duration", "transfers",
        _rounded("walked_m", 1), _rounded("confidence"),
    )


REGISTRY["journey_plan"] = REGISTRY.pop("journey_plan_with_confidence")


# Validation


def _ks(t: Transport) -> DataFrame:
    train, held_out = (t.history_of(p).filter(F.col("type").isNotNull()) for p in (TRAINING_PERIOD, VALIDATION_PERIOD))
    return validation.ks_by_group(train, held_out, KS_KEYS, min_samples=KS_MIN_SAMPLES)


@register
def ks_by_group(t: Transport) -> DataFrame:
    return _ks(t).select(*KS_KEYS, "n_train", "n_validation", _rounded("statistic"), _rounded("p_value"))


@register
def ks_by_weather_group(t: Transport) -> DataFrame:
    tests = validation.ks_by_group(
        t.history_of(TRAINING_PERIOD), t.history_of(VALIDATION_PERIOD), GROUP_COLUMNS, min_samples=KS_MIN_GROUP
    )
    return tests.select(*GROUP_COLUMNS, "n_train", "n_validation", _rounded("statistic"), _rounded("p_value"))


@register
def drift_summary(t: Transport) -> DataFrame:
    return validation.drift_summary(_ks(t)).select("tests", _rounded("share_rejected"), _rounded("mean_statistic"))


@register
def drift_histogram(t: Transport) -> DataFrame:
    return validation.value_histogram(_ks(t), "p_value", 10)


def _calibration(t: Transport) -> DataFrame:
    return validation.cdf_calibration(delay_model.fit(t.history_of(TRAINING_PERIOD)), t.history_of(VALIDATION_PERIOD))


@register
def cdf_calibration(t: Transport) -> DataFrame:
    return _calibration(t).select(
        *GROUP_COLUMNS, "percentile", "train_probability", _rounded("validation_probability")
    )


@register
def probability_histogram(t: Transport) -> DataFrame:
    return validation.probabilities_by_split(_calibration(t))
