"""The search for one journey a query against plain enumeration, with legs that hold together."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from queries import registered
from stopwise.operators import latest
from stopwise.operators.journeys import pick_journeys, search_journeys
from stopwise.operators.network import ride_runs
from stopwise.plans.journey_plan import plan_journeys
from stopwise.plans.travel_network import TravelNetwork
from stopwise.sources.workspace import Workspace
from test_journeys import MODEL, QUERIES, TRIPS, H, enumerate_journeys, hops_of, query, random_network, walks_of


def find(spark, queries, trips, walks):
    table = spark.createDataFrame(queries, QUERIES)
    found = latest.latest_journeys(table, hops_of(spark, trips), walks_of(spark, walks), Workspace(spark))
    return {r.query_id: r for r in found.collect()}


def checked_legs(row, trips, walks):
    """The legs follow one another in space and time and give the row's departure and walking."""
    near = {**walks, **{(b, a): s for (a, b), s in walks.items()}}
    at, clock, ridden = row.from_stop_id, row.dep_s, False
    assert row.legs[0].dep_s == row.dep_s and row.legs[-1].to_stop_id == row.to_stop_id
    for leg in row.legs:
        assert leg.from_stop_id == at
        if leg.kind == "walk":
            clock, ridden = max(clock, leg.dep_s) + near[leg.from_stop_id, leg.to_stop_id], False
        else:
            stops = trips[leg.trip_id]
            assert any(a[0] == leg.from_stop_id and a[2] == leg.dep_s and b[0] == leg.to_stop_id and b[1] == leg.arr_s
                       for k, a in enumerate(stops) for b in stops[k + 1 :])
            assert leg.dep_s >= clock + 120 * ridden
            clock, ridden = leg.arr_s, True
        at = leg.to_stop_id
    assert clock + 120 * ridden <= row.arrival_s
    assert row.walked_s == sum(leg.walk_s or 0 for leg in row.legs) <= 600
    places = [row.from_stop_id, *(leg.to_stop_id for leg in row.legs)]
    assert len(set(places)) == len(places)


@pytest.mark.parametrize("seed,stops,lines", [(0, 7, 40), (3, 8, 60), (8, 9, 70)])
def test_against_enumeration(spark, seed, stops, lines):
    names, trips, walks = random_network(seed, stops, lines)
    queries = [query(i, s, d, 3600) for i, (s, d) in enumerate((s, d) for s in names for d in names)]
    found = find(spark, queries, trips, walks)
    for d in names:
        every = enumerate_journeys(trips, walks, d, 3600, 600, 7)
        for q in (q for q in queries if q[2] == d):
            best = min((3600 - dep for dep, _ in every[q[1]]), default=None) if q[1] != d else None
            assert (found[q[0]].cost if q[0] in found else None) == best
    for row in found.values():
        checked_legs(row, trips, walks)


def test_worked_example_and_budget(spark):
    walks = {("X", "Y"): 300}
    found = find(spark, [query(1, "X", "Z", 10 * H), query(2, "X", "Z", 10 * H, walk=200), query(3, "Z", "X", 10 * H), query(4, "no", "Z", 10 * H)], TRIPS, walks)
    assert [leg.trip_id for leg in found[1].legs] == ["walking", "T3"] and found[1].walked_s == 300
    assert [leg.trip_id for leg in found[2].legs] == ["T1"] and set(found) == {1, 2}


def test_repeated_stops_and_long_waits(spark):
    around = {"T": [("A", 0, 10), ("B", 100, 110), ("A", 200, 210), ("D", 300, 310)]}
    assert find(spark, [query(1, "A", "D", 1000), query(2, "B", "D", 1000)], around, {})[1].dep_s == 210
    early = {"T": [("A", 0, 100), ("B", 200, 210)]}
    assert find(spark, [query(1, "A", "B", 80000)], early, {})[1].dep_s == 100
    line = {f"T{k}": [(f"P{k}", 1000 * k, 1000 * k + 10), (f"P{k + 1}", 1000 * k + 500, 1000 * k + 510)] for k in range(11)}
    assert len(find(spark, [query(1, "P0", "P11", 20000)], line, {})[1].legs) == 11


def test_rides_are_cut_where_a_stop_would_repeat(spark):
    around = {"T": [("A", 0, 10), ("B", 100, 110), ("A", 200, 210), ("D", 300, 310)]}
    assert ride_runs(hops_of(spark, around)).count() == 3
    rides = latest.search_rides(hops_of(spark, around))
    boardings = latest.run_boardings(latest.run_stops(rides)).first().boardings
    assert [(b.stop_id, b.until) for b in boardings] == [("A", boardings[2].place), ("B", None), ("A", None)]


def test_no_queries(spark):
    assert find(spark, [query(1, "X", "X", 10 * H)], TRIPS, {("X", "Y"): 300}) == {}


@pytest.mark.parametrize("search", [latest.latest_departures, search_journeys])
def test_hops_are_worked_through_once(spark, search):
    names, trips, walks = random_network(5, 6, 30)
    seen = spark.sparkContext.accumulator(0)
    # Looked at after the shuffle that the search needs, as the hops of a timetable are.
    hops = hops_of(spark, trips).repartition(2, "trip_id")
    counted = hops.withColumn("dep_s", F.udf(lambda v: seen.add(1) or v, "int")("dep_s"))
    queries = spark.createDataFrame([query(1, names[0], names[1], 3600, k=1)], QUERIES)
    search(queries, counted, walks_of(spark, walks), Workspace(spark)).collect()
    assert seen.value == hops.count()


def plan_of(queries, hops, walks, work):
    model = work.spark.createDataFrame([("P1", 9, False, "low", list(range(0, 1010, 10)), 30)], MODEL)
    return plan_journeys(queries, TravelNetwork(hops, walks), model, work, 0.0)


@pytest.mark.parametrize("search", [latest.latest_departures, search_journeys, plan_of])
def test_jobs_do_not_grow_with_the_legs(spark, search):
    jobs, walks = [], walks_of(spark, {("X", "Y"): 60})
    for legs in (2, 16):
        line = {f"T{k}": [(f"P{k}", 1000 * k, 1000 * k + 10), (f"P{k + 1}", 1000 * k + 500, 1000 * k + 510)] for k in range(legs)}
        queries = spark.createDataFrame([query(1, "P0", f"P{legs}", 20000)], QUERIES)
        group = f"legs-{search.__name__}-{legs}"
        spark.sparkContext.setJobGroup(group, group)
        assert search(queries, hops_of(spark, line), walks, Workspace(spark)).count() > 0
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 2


@pytest.mark.parametrize("k", [1, 3])
def test_walks_between_parts_that_no_ride_joins(spark, k):
    names, trips, walks = random_network(4, 5, 25)
    others, more, further = random_network(6, 5, 25)
    trips |= {f"U{t}": [(f"U{stop}", *times) for stop, *times in stops] for t, stops in more.items()}
    walks |= {(f"U{a}", f"U{b}"): s for (a, b), s in further.items()} | {("S0", "US1"): 150, ("S2", "US3"): 330, ("US4", "lone"): 140}
    stops = [*names, *(f"U{s}" for s in others), "lone"]
    queries = [query(i, s, d, 3600, k=k) for i, (s, d) in enumerate((s, d) for s in stops for d in ("S0", "S3", "US2", "lone") if s != d)]
    table = spark.createDataFrame(queries, QUERIES)
    labels = search_journeys(table, hops_of(spark, trips), walks_of(spark, walks), Workspace(spark), max_legs=4)
    found = {}
    for r in pick_journeys(table, labels).orderBy("query_id", "journey_rank").collect():
        found.setdefault(r.query_id, []).append(r.cost)
    for q in queries:
        every = enumerate_journeys(trips, walks, q[2], 3600, 600, 4)[q[1]]
        assert found.get(q[0], []) == sorted(3600 - dep for dep, _ in every)[:k]


def test_without_a_walking_budget_only_rides_count(spark):
    fields = QUERIES.replace("max_walk_m int", "max_walk_m double")
    table = spark.createDataFrame([(1, "X", "Z", 10 * H, None, 3, False, 5), (2, "X", "Z", None, 500.0, 3, False, 5)], fields)
    labels = search_journeys(table, hops_of(spark, TRIPS), walks_of(spark, {("X", "Y"): 300}), Workspace(spark))
    assert [leg.trip_id for r in labels.collect() for leg in r.legs] == ["T1"]


def test_legs_report_looks_at_the_hops_once(spark):
    seen = spark.sparkContext.accumulator(0)
    hops = hops_of(spark, TRIPS).repartition(2, "trip_id")
    counted = hops.withColumn("dep_s", F.udf(lambda v: seen.add(1) or v, "int")("dep_s"))
    given = SimpleNamespace(
        spark=spark, queries=spark.createDataFrame([query(1, "X", "Z", 10 * H)], QUERIES),
        network=TravelNetwork(counted, walks_of(spark, {("X", "Y"): 300})),
    )
    rows = registered.journey_legs(given).orderBy("journey_rank", "leg").collect()
    assert [(r.journey_rank, r.leg, r.description) for r in rows] == [(1, 0, "Walking 250m"), (1, 1, "T3"), (2, 0, "T1")]
    assert seen.value == hops.count()
