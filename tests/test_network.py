import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stopwise.operators import network as n
from stopwise.operators import regions as r
from stopwise.operators import timetable as tt
from stopwise.operators.hot_keys import split_hot_keys

EVENTS = (
    "trip_id string, stop_id string, stop_sequence int, arr_s int, dep_s int, stop_name string, stop_lon double, "
    "stop_lat double, parent_stop_id string, direction_id int, route_short_name string, route_desc string, "
    "trip_headsign string"
)


def events(spark, rows):
    """Rows (trip, stop, sequence, arr, dep[, direction])."""
    full = [
        (t, s, q, a, d, f"name {s}", 0.0, 0.0, None, rest[0] if rest else 0, "1", "B", "end")
        for t, s, q, a, d, *rest in rows
    ]
    return spark.createDataFrame(full, EVENTS)


def edges(hops):
    return sorted((x.source_stop_id, x.target_stop_id, x.trip_id, x.dep_s, x.arr_s) for x in hops.collect())


def test_hops_run_backwards_between_consecutive_stops(spark):
    data = events(
        spark,
        [
            ("T", "A", 1, 90, 100),
            ("T", "B", 2, 200, 210),
            ("T", "B", 3, 300, 310),  # same stop: no hop
            ("T", "C", 5, 500, 510),  # gap: no hop
            ("T", "D", 6, 600, 610),
            ("N", "A", 1, 1, 1, None),  # no direction: no hop
            ("N", "B", 2, 2, 2, None),
        ],
    )
    assert edges(n.trip_hops(data)) == [("B", "A", "T", 100, 200), ("D", "C", "T", 510, 600)]
    assert n.trip_hops(data).first().trip_description == "1 - B (end)"


def test_repeated_stop_times_make_one_hop(spark):
    data = events(spark, [("T", "A", 1, 90, 100), ("T", "A", 1, 95, 105)] * 3 + [("T", "B", 2, 200, 210)] * 5)
    assert edges(n.trip_hops(data)) == [("B", "A", "T", 105, 200)]


@pytest.mark.parametrize("chunk", [2, 3, 512])
def test_runs_do_not_depend_on_the_chunk(spark, chunk):
    rows = [("T", f"S{q}", q, 100 * q, 100 * q + 10) for q in range(1, 12) if q != 7]
    rows += [("U", f"S{q}", q, 100 * q, 100 * q + 10) for q in range(1, 5)]
    rows[3] = ("T", "S4", 4, 400, 390)  # leaves before it arrives: the run breaks there
    found = n.ride_runs(n.trip_hops(events(spark, rows)), chunk).collect()
    starts = {(x.trip_id, x.source_stop_sequence): x.run_start for x in found}
    expected = {("T", q): 2 for q in (2, 3, 4)} | {("T", q): 5 for q in (5, 6)}
    expected |= {("T", q): 9 for q in (9, 10, 11)} | {("U", q): 2 for q in (2, 3, 4)}
    assert starts == expected


def test_ill_timed_hops_are_reported_and_left_out(spark):
    hops = n.trip_hops(events(spark, [("T", "A", 1, 0, 300), ("T", "B", 2, 200, 210)]))
    assert n.ill_timed_hops(hops).count() == 1
    assert n.ride_runs(hops).count() == 0


STOPS = "stop_id string, stop_name string, stop_lon double, stop_lat double, parent_stop_id string"
TRANSFERS = "from_stop_id string, to_stop_id string, transfer_time int"


def metres(a, b):
    (lon1, lat1), (lon2, lat2) = ([math.radians(x) for x in p] for p in (a, b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371008 * math.asin(math.sqrt(h))


@pytest.mark.parametrize("latitude", [0, 46.5, -69.9])
def test_walking_pairs_against_all_pairs(spark, latitude):
    rng = random.Random(latitude)
    places = {f"S{i}": (6.5 + rng.random() * 0.05, latitude + rng.random() * 0.03) for i in range(60)}
    places["S60"] = places["S0"]
    stops = spark.createDataFrame([(k, k, *p, None) for k, p in places.items()], STOPS)
    transfers = spark.createDataFrame([("S0", "S60", 90), ("S0", "S60", 60)], TRANSFERS)
    found = {
        (w.source_stop_id, w.target_stop_id): (w.walk_s, w.transfer_time)
        for w in n.walking_edges(stops, transfers, 700).collect()
    }
    expected = {
        (a, b): (int(metres(p, q) / (50 / 60)), 90 if (a, b) == ("S0", "S60") else 0)
        for a, p in places.items()
        for b, q in places.items()
        if a != b and metres(p, q) <= 700
    }
    assert found == expected


def test_crowded_cells_keep_all_pairs(spark):
    left = spark.range(500).select((F.col("id") % 2).alias("k"), "id")
    right = spark.range(4).select((F.col("id") % 2).alias("k"), F.col("id").alias("other"))
    a, b = split_hot_keys(left, right, ["k"], ["id"], rows_per_split=20)
    assert a.select("split").distinct().count() == 13
    joined = a.join(b, ["k", "split"])
    assert joined.count() == joined.select("id", "other").distinct().count() == 1000


def test_edge_sets(spark):
    hops = n.trip_hops(events(spark, [("T", "A", 1, 90, 100), ("T", "B", 2, 200, 210), ("T", "A", 3, 290, 300), ("T", "B", 4, 400, 410)]))
    stops = spark.createDataFrame([("A", "a", 0.0, 0.0, None), ("B", "b", 0.001, 0.0, None)], STOPS)
    walks = n.walking_edges(stops, spark.createDataFrame([], TRANSFERS), 500)
    edges_ = n.network(hops, walks)
    assert edges_.count() == 5
    unique = {(e.source_stop_id, e.target_stop_id, e.trip_id): e for e in n.unique_edges(edges_).collect()}
    assert len(unique) == 4
    assert unique["B", "A", "T"].dep_s == 300
    assert unique["A", "B", "walking"].walk_s == int(metres((0, 0), (0.001, 0)) / (50 / 60))
    banned = spark.createDataFrame([("B", "A", "T")], "source_stop_id string, target_stop_id string, trip_id string")
    assert n.without_edges(edges_, banned).count() == 3
    assert [s.stop_id for s in n.stop_listing(walks).collect()] == ["A", "B"]


def test_node_conflicts(spark):
    rows = [("A", "a", 0.0, 0.0, "P"), ("A", "a", 0.0, 0.0, "Q"), ("B", "b", 0.0, 0.0, None), ("B", "c", 0.0, 0.0, None)]
    assert [tuple(x) for x in n.node_conflicts(spark.createDataFrame(rows, STOPS)).collect()] == [("B", 2)]


def ring(*points):
    return [{"lon": float(x), "lat": float(y)} for x, y in points]


POLYGONS = "uuid string, level string, rings array<array<struct<lon: double, lat: double>>>"


def square(x, y, size):
    return ring((x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y))


def test_centroid_of_separate_squares(spark):
    wide = ring((2, 0), (4, 0), (4, 1), (2, 1), (2, 0))
    polygons = spark.createDataFrame(
        [("A ", "district", [square(0, 0, 1)]), ("B", "district", [wide]), ("C", "canton", [square(9, 9, 1)])], POLYGONS
    )
    row = r.region_centroid(r.select_regions(polygons, ["A", "B", "C"])).first()
    assert (row.lon, row.lat) == pytest.approx((2.166667, 0.5), abs=1e-6)


def test_stops_within_against_brute_force(spark):
    rng = random.Random(5)
    squares = [(rng.random(), rng.random(), 0.01 + rng.random() * 0.1) for _ in range(12)]
    polygons = spark.createDataFrame([("A", "district", [square(*s)]) for s in squares], POLYGONS)
    points = {f"S{i}": (rng.random(), rng.random()) for i in range(300)}
    stops = spark.createDataFrame([(k, k, *p, None) for k, p in points.items()], STOPS)
    inside = {
        k for k, (x, y) in points.items() if any(a < x < a + s and b < y < b + s for a, b, s in squares)
    }
    found = [x.stop_id for x in r.stops_within(stops, polygons).collect()]
    assert sorted(found) == sorted(inside) and len(inside) > 10


def plainly_inside(rings, x, y):
    """Even-odd rule over whole rings; points on an edge are outside."""
    odd = False
    for points in rings:
        for (ax, ay), (bx, by) in zip(points, points[1:]):
            cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
            if cross == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return False
            if ay <= y < by and cross > 0 or by <= y < ay and cross < 0:
                odd = not odd
    return odd


def star(rng, x, y, size, corners, snap=None):
    turns = sorted(rng.random() * 2 * math.pi for _ in range(corners))
    points = [(x + math.cos(t) * size * r, y + math.sin(t) * size * r) for t, r in ((t, rng.uniform(0.3, 1)) for t in turns)]
    if snap:
        points = [(round(a * snap) / snap, round(b * snap) / snap) for a, b in points]
    return [*points, points[0]]


@pytest.mark.parametrize("snap", [None, 8])
def test_cells_against_the_even_odd_rule(spark, snap):
    # With ``snap`` corners and places lie on the borders of cells, on edges and on corners of the polygons.
    rng = random.Random(snap or 0)
    shapes = []
    for _ in range(14):
        x, y, size = rng.uniform(-6, 6), rng.uniform(-6, 6), rng.choice([0.3, 1, 5])
        shapes.append([star(rng, x, y, size, rng.choice([3, 9, 120]), snap), star(rng, x, y, size * 0.3, 5, snap)])
    shapes.append(shapes[0])
    draw = (lambda: rng.randrange(-56, 57) / 8) if snap else (lambda: rng.uniform(-7, 7))
    places = [(draw(), draw()) for _ in range(1500)]
    corners = [p for rings in shapes for points in rings for p in points][::3]
    rows = [(f"S{i}", "s", *p, None) for i, p in enumerate(places + corners + places[:50])] + [("none", "s", None, None, None)]
    polygons = spark.createDataFrame([("A", "district", [ring(*points) for points in rings]) for rings in shapes], POLYGONS)
    found = sorted(x.stop_id for x in r.stops_within(spark.createDataFrame(rows, STOPS), polygons).collect())
    expected = sorted(k for k, _, x, y, _ in rows if x is not None and any(plainly_inside(rings, x, y) for rings in shapes))
    assert found == expected and 200 < len(expected) < 1500


def test_few_cells_cover_large_and_detailed_polygons(spark):
    box = spark.createDataFrame([("A", "district", [square(3.3, 40.1, 10)])], POLYGONS)
    cells = r.region_cells(box).collect()
    assert len(cells) <= 16 and all(c.edges for c in cells)
    rng = random.Random(3)
    detailed = star(rng, 5, 45, 5, 4000)
    cells = r.region_cells(spark.createDataFrame([("A", "district", [ring(*detailed)])], POLYGONS)).collect()
    assert len(cells) <= (4000**0.5 + 2) ** 2 and any(not c.edges for c in cells)


def test_no_polygons_hold_no_stops(spark):
    stops = spark.createDataFrame([("A", "a", 0.0, 0.0, None)], STOPS)
    assert r.stops_within(stops, spark.createDataFrame([], POLYGONS)).count() == 0
    empty = spark.createDataFrame([("A", "district", []), ("B", "district", [[]])], POLYGONS)
    assert r.stops_within(stops, empty).count() == 0


def test_closest_site_breaks_ties_by_name(spark):
    stations = spark.createDataFrame(
        [("B", 1.0, 0.0, True), ("A", -1.0, 0.0, True), ("C", 0.0, 0.0, False), ("D", None, 0.0, True)],
        "site string, lon double, lat double, active boolean",
    )
    centroid = spark.createDataFrame([(0.0, 0.0)], "lon double, lat double")
    stations = stations.filter("lon IS NOT NULL")
    assert r.closest_site(stations, centroid).first().site == "A"


def test_latest_snapshot(spark):
    table = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 2, 1),)], "pub_date date")
    assert tt.latest_snapshot(table, dt.date(2024, 1, 31)).first()[0] == dt.date(2024, 1, 1)
    assert tt.latest_snapshot(table, dt.date(2023, 1, 31)).first()[0] is None


def test_shifted_services(spark):
    days = "monday boolean, tuesday boolean, wednesday boolean, thursday boolean, friday boolean, saturday boolean, sunday boolean"
    rows = [("W", *[c == "T" for c in "TTTTTFF"]), ("S", *[c == "T" for c in "TTTTFFT"])]
    calendar = spark.createDataFrame(rows, f"service_id string, {days}")
    served = {x.service_id: x.business for x in tt.business_shifts(calendar).collect()}
    assert served["W"] == [True] + [False] * 6
    assert served["S"] == [False, True] + [False] * 5


def test_pairs_at_the_pole_and_the_date_line_agree_with_all_pairs(spark):
    draw = random.Random(1)
    places = [(draw.uniform(-180, 180), lat + draw.uniform(-0.02, 0.02)) for lat in (89.97, -89.97, 60, 0) for _ in range(40)]
    places += [(180 - draw.uniform(0, 0.01) if k % 2 else -180 + draw.uniform(0, 0.01), draw.uniform(-0.02, 0.02)) for k in range(40)]
    places += [(0.0, 90.0), (12.0, -90.0), (180.0, 10.0), (-180.0, 10.0)]
    rows = [(f"s{k}", f"n{k}", lon, lat, None) for k, (lon, lat) in enumerate(places)]
    stops = spark.createDataFrame(rows, "stop_id string, stop_name string, stop_lon double, stop_lat double, parent_stop_id string")
    found = {(r.a, r.b) for r in n.nearby_pairs(stops, 1500.0).selectExpr("source.stop_id a", "target.stop_id b").collect()}

    def metres(p, q):
        (lon1, lat1), (lon2, lat2) = (tuple(map(math.radians, x)) for x in (p, q))
        h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
        return 2 * 6371008.0 * math.asin(min(1, math.sqrt(h)))

    expected = {(f"s{i}", f"s{j}") for i, p in enumerate(places) for j, q in enumerate(places) if i != j and metres(p, q) <= 1500}
    assert len(expected) > 50 and found == expected


def test_one_of_repeated_stop_times_serves_both_hops(spark):
    rows = [("T", "A", 1, 90, 100), ("T", "B", 2, 200, 210), ("T", "C", 2, 190, 230), ("T", "D", 3, 300, 310)]
    hops = n.trip_hops(events(spark, rows))
    assert edges(hops) == [("B", "A", "T", 100, 200), ("D", "B", "T", 210, 300)]
    assert {x.run_start for x in n.ride_runs(hops).collect()} == {2}


def test_hops_that_do_not_meet_are_two_runs(spark):
    hops = n.trip_hops(events(spark, [("T", "A", 1, 90, 100), ("T", "B", 2, 200, 210), ("T", "C", 3, 300, 310)]))
    moved = hops.withColumn("source_stop_id", F.when(F.col("source_stop_sequence") == 2, "X").otherwise(F.col("source_stop_id")))
    assert sorted(x.run_start for x in n.ride_runs(moved).collect()) == [2, 3]


def _clipped(subject, clip):
    """What of a convex polygon lies in another one, both counterclockwise."""
    for (ax, ay), (bx, by) in zip(clip, clip[1:] + clip[:1]):
        def side(p):
            return (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)

        kept = []
        for p, q in zip(subject, subject[1:] + subject[:1]):
            if side(p) >= 0:
                kept.append(p)
            if (side(p) >= 0) != (side(q) >= 0):
                t = side(p) / (side(p) - side(q))
                kept.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        subject = kept
        if not subject:
            break
    return subject


def _moments(ring):
    parts = [(a, b, (a[0] * b[1] - b[0] * a[1]) / 2) for a, b in zip(ring, ring[1:] + ring[:1])]
    return [sum(w for *_, w in parts)] + [sum(w * (a[k] + b[k]) / 3 for a, b, w in parts) for k in (0, 1)]


def test_union_moments(spark):
    draw = random.Random(4)
    rings, expected = [], [0.0, 0.0, 0.0]
    for k in range(12):
        pair = []
        for _ in range(2):
            ring = [(draw.uniform(0, 3) + 5 * (k % 4), draw.uniform(0, 3) + 5 * (k // 4)) for _ in range(3)]
            pair.append(ring if _moments(ring)[0] > 0 else ring[::-1])
        for ring, sign in ((pair[0], 1), (pair[1], 1), (_clipped(*pair), -1)):
            expected = [e + sign * m for e, m in zip(expected, _moments(ring))]
        rings += [[pair[0]], [pair[1][::-1]]]
    square = [(-9.0, 0.0), (-5.0, 0.0), (-5.0, 4.0), (-9.0, 4.0)]
    hole = [(-8.0, 1.0), (-8.0, 3.0), (-6.0, 3.0), (-6.0, 1.0)]
    rings += [[square, hole], [square, hole], [[(-5.0, 0.0), (-4.0, 0.0), (-4.0, 4.0), (-5.0, 4.0)]]]
    for ring in (square, hole, rings[-1][0]):
        expected = [e + m for e, m in zip(expected, _moments(ring))]
    rows = [("u", "district", [[*ring, ring[0]] for ring in polygon]) for polygon in rings]
    schema = "uuid string, level string, rings array<array<struct<lon: double, lat: double>>>"
    found = r.union_moments(spark.createDataFrame(rows, schema)).first()
    assert list(found) == pytest.approx(expected, rel=1e-9)
    assert list(r.union_moments(spark.createDataFrame([], schema)).first()) == [None, None, None]


def test_closest_site_of_regions_in_two_subqueries_of_one_query(spark):
    schema = "uuid string, level string, rings array<array<struct<lon: double, lat: double>>>"
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    polygons = spark.createDataFrame([("D1", "district", [square])], schema)
    stations = spark.createDataFrame([("A", 1.0, 1.0, True), ("B", 9.0, 9.0, True)], "site string, lon double, lat double, active boolean")
    seen = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "site string, day int")

    def of_period(days):
        site = r.closest_site(stations, r.region_centroid(polygons)).select("site").scalar()
        return seen.filter((F.col("site") == site) & days).select("day")

    both = of_period(F.col("day") < 2).withColumn("part", F.lit(1)).unionByName(of_period(F.col("day") > 2).withColumn("part", F.lit(2)))
    assert sorted(map(tuple, both.collect())) == [(1, 1), (3, 2)]
