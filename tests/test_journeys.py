import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stopwise.operators import journeys as j
from stopwise.operators import legs as lg
from stopwise.operators.confidence import journey_confidence
from stopwise.plans import journey_plan as plan
from stopwise.plans.travel_network import TravelNetwork
from stopwise.sources.workspace import Workspace

HOPS = (
    "source_stop_id string, target_stop_id string, trip_id string, trip_description string, direction_id int, "
    "source_stop_sequence int, dep_s int, arr_s int"
)
WALKS = "source_stop_id string, target_stop_id string, transfer_time int, walk_s bigint"
QUERIES = (
    "query_id int, from_stop_id string, to_stop_id string, arrival_s int, max_walk_m int, k int, rain boolean, "
    "temperature_c int"
)
H = 3600


def hops_of(spark, trips):
    """Hops of trips given as {trip: [(stop, arr, dep), ...]}."""
    rows = [
        (b[0], a[0], trip, trip, 0, i + 2, a[2], b[1])
        for trip, stops in trips.items()
        for i, (a, b) in enumerate(zip(stops, stops[1:]))
    ]
    return spark.createDataFrame(rows, HOPS)


def walks_of(spark, walks):
    """Walks both ways, given as {(a, b): seconds or (seconds, transfer)}."""
    rows = []
    for (a, b), value in walks.items():
        seconds, transfer = value if isinstance(value, tuple) else (value, 0)
        rows += [(a, b, transfer, seconds), (b, a, transfer, seconds)]
    return spark.createDataFrame(rows, WALKS)


def query(query_id, start, end, arrival, walk=500, k=3):
    return (query_id, start, end, arrival, walk, k, False, 5)


def find(spark, queries, trips, walks, **options):
    table = spark.createDataFrame(queries, QUERIES)
    labels = j.search_journeys(table, hops_of(spark, trips), walks_of(spark, walks), Workspace(spark), **options)
    return j.pick_journeys(table, labels).orderBy("query_id", "journey_rank").collect()


TRIPS = {
    "T1": [("X", 0, 9 * H + 1800), ("Z", 9 * H + 57 * 60, 10 * H)],
    "T2": [("X", 0, 9 * H + 2400), ("Z", 9 * H + 59 * 60, 10 * H)],
    "T3": [("Y", 0, 9 * H + 2700), ("Z", 9 * H + 55 * 60, 10 * H)],
}


def test_worked_example(spark):
    found = find(spark, [query(1, "X", "Z", 10 * H)], TRIPS, {("X", "Y"): 300})
    assert [(r.cost, r.dep_s, r.walked_s, r.transfers) for r in found] == [
        (1200, 9 * H + 2400, 300, 1),
        (1800, 9 * H + 1800, 0, 0),
    ]
    assert [leg.trip_id for leg in found[0].legs] == ["walking", "T3"]
    assert [leg.trip_id for leg in found[1].legs] == ["T1"]


def test_walking_budget(spark):
    found = find(spark, [query(1, "X", "Z", 10 * H, walk=200)], TRIPS, {("X", "Y"): 300})
    assert [leg.trip_id for r in found for leg in r.legs] == ["T1"]
    exact = find(spark, [query(1, "X", "Z", 10 * H, walk=250, k=1)], TRIPS, {("X", "Y"): 300})
    assert exact[0].walked_s == 300


def test_transfer_time_counts_when_longer_than_the_walk(spark):
    found = find(spark, [query(1, "X", "Z", 10 * H, k=1)], TRIPS, {("X", "Y"): (300, 400)})
    assert found[0].cost == 10 * H - (9 * H + 2700 - 400)


def test_unreachable_and_equal_ends_give_no_row(spark):
    queries = [query(1, "Z", "X", 10 * H), query(2, "X", "X", 10 * H), query(3, "nowhere", "Z", 10 * H)]
    assert find(spark, queries, TRIPS, {("X", "Y"): 300}) == []


def test_ride_over_several_stops_needs_no_transfer_time(spark):
    trips = {"T": [("A", 0, 100), ("B", 200, 210), ("C", 300, 310)], "U": [("A", 0, 100), ("B", 200, 210)]}
    found = find(spark, [query(1, "A", "C", 1000)], trips, {})
    assert [[leg.trip_id for leg in r.legs] for r in found] == [["T"]]


def enumerate_journeys(trips, walks, end, arrival, budget_s, max_legs):
    """All journeys that repeat no stop, as {start: [(dep, walked)]}, by plain recursion."""
    arrivals = defaultdict(list)
    for trip, stops in trips.items():
        for b in range(1, len(stops)):
            for a in range(b):
                passed = [s[0] for s in stops[a:b]]
                if len({*passed, stops[b][0]}) == b - a + 1:
                    arrivals[stops[b][0]].append((trip, passed, stops[a][2], stops[b][1]))
    near = defaultdict(list)
    for (a, b), seconds in walks.items():
        near[a].append((b, seconds))
        near[b].append((a, seconds))
    found = defaultdict(list)

    def extend(stop, dep, walked, last, visited, legs):
        if legs:
            found[stop].append((dep, walked))
        if legs == max_legs:
            return
        for trip, passed, leaves, arrives in arrivals[stop]:
            latest = dep if last == "walking" else dep - 120
            if trip != last and not visited & {*passed} and arrives <= latest:
                extend(passed[0], leaves, walked, trip, visited | {*passed}, legs + 1)
        for start, seconds in near[stop]:
            if start not in visited and walked + seconds <= budget_s and dep - seconds >= 0:
                extend(start, dep - seconds, walked + seconds, "walking", visited | {start}, legs + 1)

    extend(end, arrival, 0, None, frozenset([end]), 0)
    return found


def random_network(seed, stops=7, trips=40):
    rng = random.Random(seed)
    names = [f"S{i}" for i in range(stops)]
    lines = {}
    for t in range(trips):
        clock, line = rng.randrange(0, 3000), []
        for stop in rng.sample(names, rng.randint(2, 4)):
            line.append((stop, clock, clock + rng.choice([0, 30])))
            clock += rng.randrange(130, 600)
        lines[f"T{t}"] = line
    walks = {}
    for _ in range(5):
        a, b = rng.sample(names, 2)
        if (b, a) not in walks:
            walks[a, b] = rng.randrange(130, 400)
    return names, lines, walks


@pytest.mark.parametrize("seed,stops,lines", [(0, 7, 40), (1, 7, 40), (2, 7, 40), (5, 9, 70)])
def test_search_against_enumeration(spark, seed, stops, lines):
    names, trips, walks = random_network(seed, stops, lines)
    arrival, legs = 3600, 4
    queries = [query(i * 10 + e, s, d, arrival) for i, s in enumerate(names) for e, d in enumerate(names) if s != d]
    pruned = defaultdict(list)
    for r in find(spark, queries, trips, walks, max_legs=legs):
        pruned[r.query_id].append(r.cost)
        stops = [leg.from_stop_id for leg in r.legs] + [r.legs[-1].to_stop_id]
        assert len(set(stops)) == len(stops) == len(r.legs) + 1
        assert (stops[0], stops[-1]) == (r.from_stop_id, r.to_stop_id)
        assert all(a.to_stop_id == b.from_stop_id for a, b in zip(r.legs, r.legs[1:]))
        assert r.walked_s == sum(leg.walk_s or 0 for leg in r.legs) <= 600
    unpruned = defaultdict(list)
    for r in find(spark, queries, trips, walks, max_legs=legs, prune=False):
        unpruned[r.query_id].append(r.cost)
    for d in names:
        every = enumerate_journeys(trips, walks, d, arrival, 600, legs)
        for q in (q for q in queries if q[2] == d):
            best = sorted(arrival - dep for dep, _ in every[q[1]])[:3]
            assert unpruned[q[0]] == best
            assert pruned[q[0]] == best


def test_folding_in_parts_keeps_the_same_journeys(spark, monkeypatch):
    monkeypatch.setattr(j, "FOLD_ROWS", 2)
    names, trips, walks = random_network(1)
    queries = [query(i, s, d, 3600) for i, (s, d) in enumerate((s, d) for s in names for d in names if s != d)]
    found = defaultdict(list)
    for r in find(spark, queries, trips, walks, max_legs=4):
        found[r.query_id].append(r.cost)
    for d in names:
        every = enumerate_journeys(trips, walks, d, 3600, 600, 4)
        for q in (q for q in queries if q[2] == d):
            assert found[q[0]] == sorted(3600 - dep for dep, _ in every[q[1]])[:3]


def test_one_journey_a_query_against_enumeration(spark):
    names, trips, walks = random_network(8, 9, 70)
    queries = [query(i, s, d, 3600, k=1) for i, (s, d) in enumerate((s, d) for s in names for d in names if s != d)]
    found = {r.query_id: r.cost for r in find(spark, queries, trips, walks, max_legs=4)}
    for q in queries:
        every = enumerate_journeys(trips, walks, q[2], 3600, 600, 4)[q[1]]
        assert found.get(q[0]) == min((3600 - dep for dep, _ in every), default=None)


def test_shared_search_gives_what_single_searches_give(spark):
    names, trips, walks = random_network(11)
    queries = [query(i, s, names[0], 3600, k=1 + i % 3) for i, s in enumerate(names[1:])]
    together = find(spark, queries, trips, walks, max_legs=3)
    for q in queries:
        alone = find(spark, [q], trips, walks, max_legs=3)
        assert [r.cost for r in alone] == [r.cost for r in together if r.query_id == q[0]]


def test_no_stop_is_passed_twice(spark):
    trips = {"T1": [("A", 90, 100), ("B", 200, 210), ("C", 300, 310)], "T2": [("C", 490, 500), ("B", 600, 610), ("D", 700, 710)]}
    found = find(spark, [query(1, "A", "D", 1000)], trips, {})
    assert [[(leg.trip_id, leg.from_stop_id) for leg in r.legs] for r in found] == [[("T1", "A"), ("T2", "B")]]
    around = {"T": [("A", 0, 10), ("B", 100, 110), ("A", 200, 210), ("D", 300, 310)]}
    assert [r.dep_s for r in find(spark, [query(1, "A", "D", 1000)], around, {})] == [210]


def test_long_waits_and_long_journeys_are_found(spark):
    early = {"T": [("A", 0, 100), ("B", 200, 210)]}
    assert len(find(spark, [query(1, "A", "B", 80000)], early, {})) == 1
    line = {f"T{k}": [(f"P{k}", 1000 * k, 1000 * k + 10), (f"P{k + 1}", 1000 * k + 500, 1000 * k + 510)] for k in range(11)}
    assert [len(r.legs) for r in find(spark, [query(1, "P0", "P11", 20000)], line, {})] == [11]


def test_a_short_span_first_finds_the_same_journeys(spark, monkeypatch):
    names, trips, walks = random_network(3, 5, 14)
    queries = [query(i, s, d, 3600, k=1 + i % 3) for i, (s, d) in enumerate((s, d) for s in names for d in names if s != d)]
    # Searches without an answer end too.
    queries += [query(900, "nowhere", names[0], 3600), query(901, names[0], "nowhere", 3600), query(902, names[1], names[1], 3600)]
    found = []
    for span in (1 << 20, 2400):
        monkeypatch.setattr(j, "SPAN_S", span, raising=False)
        found.append([(r.query_id, r.journey_rank, r.cost, r.transfers, r.walked_s, r.signature, r.legs) for r in find(spark, queries, trips, walks, max_legs=2)])
    assert found[0] == found[1] and len(found[0]) > 9


def test_labels_that_leave_too_early_to_be_an_answer_are_not_made(spark):
    trips = {f"T{k}": [("A", 0, 600 * k), ("B", 600 * k + 300, 600 * k + 310)] for k in range(60)}
    trips |= {f"U{k}": [("C", 0, 600 * k), ("A", 600 * k + 300, 600 * k + 310)] for k in range(60)}
    work = Workspace(spark)
    table = spark.createDataFrame([query(1, "A", "B", 36000, k=2), query(2, "C", "B", 36000, k=2)], QUERIES)
    labels = j.search_journeys(table, hops_of(spark, trips), walks_of(spark, {("X", "Y"): 60}), work)
    assert labels.filter("dep_s < 32400").count() == 0
    assert [r.dep_s for r in j.pick_journeys(table, labels).filter("query_id = 1").orderBy("journey_rank").collect()] == [35400, 34800]


LEGS = (
    "journey_id int, leg int, kind string, trip_id string, from_stop_id string, to_stop_id string, dep_s int, "
    "arr_s int, walk_s bigint, deadline_s int, rain boolean, temperature string"
)


def leg_rows(spark):
    def row(i, trip, a, b, dep, arr):
        return (1, i, "walk" if trip == "walking" else "ride", trip, a, b, dep, arr, None, 9 * H, False, "low")

    return spark.createDataFrame(
        [
            row(0, "T1", "A", "B", 7 * H, 7 * H + 900),
            row(1, "T1", "B", "8500003:0:1", 7 * H + 1000, 8 * H),
            row(2, "walking", "8500003:0:1", "D", 8 * H, 8 * H + 60),
            row(3, "walking", "D", "E", 8 * H + 60, 8 * H + 150),
            row(4, "T2", "E", "F", 8 * H + 600, 8 * H + 1200),
        ],
        LEGS,
    )


CONTEXT = ["journey_id", "deadline_s", "rain", "temperature"]


def test_compression_transfers_and_slack(spark):
    compressed = lg.compress_legs(leg_rows(spark), CONTEXT)
    rows = compressed.orderBy("leg").collect()
    assert [(r.trip_id, r.from_stop_id, r.to_stop_id) for r in rows] == [
        ("T1", "A", "8500003:0:1"),
        ("walking", "8500003:0:1", "D"),
        ("walking", "D", "E"),
        ("T2", "E", "F"),
    ]
    assert lg.transfer_counts(compressed).first().transfers == 2
    slacks = lg.leg_slack(compressed).orderBy("ride").collect()
    assert [(r.trip_id, r.hour, r.slack_s) for r in slacks] == [("T1", 8, 450), ("T2", 8, 2400)]


def test_confidence_multiplies_the_chances(spark):
    keys = [("8500003", 8, False, "low"), ("F", 8, False, "low")]
    model = spark.createDataFrame(
        [(*k, list(range(0, 1010, 10)), 30) for k in keys],
        "stop_id string, hour int, rain boolean, temperature string, percentiles array<bigint>, sample_size bigint",
    )
    row = journey_confidence(lg.compress_legs(leg_rows(spark), CONTEXT), model).first()
    assert row.confidence == pytest.approx(0.45 * 1.0)


MODEL = "stop_id string, hour int, rain boolean, temperature string, percentiles array<bigint>, sample_size bigint"


def test_plan_of_the_worked_example(spark):
    model = spark.createDataFrame([("Z", 9, False, "low", list(range(0, 1010, 10)), 30)], MODEL)
    travel = TravelNetwork(hops_of(spark, TRIPS), walks_of(spark, {("X", "Y"): 300, ("X", "W"): 120}))
    queries = spark.createDataFrame([query(1, "X", "Z", 10 * H), query(2, "W", "X", 10 * H)], QUERIES)
    planned = plan.plan_journeys(queries, travel, model, Workspace(spark), 0.0).orderBy("query_id", "journey_rank")
    rows = planned.collect()
    assert [(r.query_id, round(r.confidence, 6)) for r in rows] == [(1, 0.3), (1, 0.18), (2, 1.0)]
    assert (rows[0].departure, rows[0].arrival, rows[0].duration) == ("09:40:00", "09:55:00", "15m")
    assert rows[0].walked_m == pytest.approx(250)
    kept = plan.plan_journeys(queries, travel, model, Workspace(spark), 0.25).collect()
    assert sorted((r.query_id, r.journey_rank) for r in kept) == [(1, 1), (2, 1)]
    report = lg.leg_report(lg.explode_legs(planned, ["query_id", "journey_rank"]), travel.hops)
    first = report.filter("query_id = 1 AND journey_rank = 1").orderBy("leg").collect()
    assert [(r.description, r.departure, r.arrival) for r in first] == [
        ("Walking 250m", "09:40:00", "09:45:00"),
        ("T3", "09:45:00", "09:55:00"),
    ]


def test_consecutive_walks_share_one_clock(spark):
    legs = F.array(
        *[
            F.struct(
                F.lit("walk").alias("kind"), F.lit(None).cast("int").alias("dep_s"),
                F.lit(None).cast("int").alias("arr_s"), F.lit(s).cast("long").alias("walk_s"),
            )
            for s in (60, 90)
        ]
    )
    timed = spark.range(1).select(lg.timed_legs(legs, F.lit(1000)).alias("l")).first().l
    assert [(x.dep_s, x.arr_s) for x in timed] == [(1000, 1060), (1060, 1150)]


def test_lines_of_orders_come_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    from queries import derived

    columns = "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    rows = [(o if o % 50 else None, k % 2, k, o, 1.0, 2.0) for o in range(1500) for k in range(3)]
    spark.createDataFrame(rows, ", ".join(f"{c} double" if c in columns[4:] else f"{c} long" for c in columns)).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(derived, "LINES_PER_TASK", 100, raising=False)
    lines = derived.Transport(spark, str(tmp_path)).lines
    sizes = lines.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == len(rows)
    assert sorted(r["count"] for r in sizes)[-2] < 300
    numbered = lines.filter("l_orderkey = 7").orderBy("line").collect()
    assert [(r.line, r.l_linenumber, r.l_partkey) for r in numbered] == [(1, 0, 0), (2, 0, 2), (3, 1, 1)]
