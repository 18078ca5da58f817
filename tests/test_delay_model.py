import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stopwise.operators import distributions as d
from stopwise.operators import history as h
from stopwise.operators import validation as v

SAMPLES = "stop_id string, hour int, rain boolean, temperature string, delay bigint"


def samples(spark, groups):
    rows = [(*key, delay) for key, delays in groups.items() for delay in delays]
    return spark.createDataFrame(rows, SAMPLES)


def expected_percentiles(values):
    ordered, n = sorted(values), len(values)
    return [ordered[max(1, (p * n + 99) // 100) - 1] for p in range(101)]


def test_back_off_levels(spark):
    data = samples(
        spark,
        {
            ("A", 8, False, "low"): [1, 2, 3],
            ("A", 8, False, "high"): [10],
            ("A", 9, True, "low"): [20],
            ("B", 8, False, "low"): [5, 6],
        },
    )
    rows = {tuple(r)[:4]: r for r in d.delay_distributions(data, min_samples=3).collect()}
    found = {key: (r.level, r.sample_size) for key, r in rows.items()}
    assert found == {
        ("A", 8, False, "low"): (0, 3),
        ("A", 8, False, "high"): (1, 4),
        ("A", 9, True, "low"): (3, 5),
    }
    assert rows["A", 9, True, "low"].percentiles == expected_percentiles([1, 2, 3, 10, 20])


@pytest.mark.parametrize("seed,threshold", [(1, 4), (2, 12), (3, 30)])
def test_distributions_against_brute_force(spark, seed, threshold):
    rng = random.Random(seed)
    groups = defaultdict(list)
    for _ in range(400):
        key = (rng.choice("ABC"), rng.choice([7, 8, 9]), rng.random() < 0.2, rng.choice(["low", "high"]))
        groups[key].append(rng.choice([0, 0, 5, rng.randrange(1801)]))
    expected = {}
    for key in groups:
        for level in range(4):
            pool = [x for other, xs in groups.items() if other[: 4 - level] == key[: 4 - level] for x in xs]
            if len(pool) >= threshold:
                expected[key] = (level, len(pool), expected_percentiles(pool))
                break
    result = d.delay_distributions(samples(spark, groups), min_samples=threshold).collect()
    assert {tuple(r)[:4]: (r.level, r.sample_size, r.percentiles) for r in result} == expected


def test_distributions_do_not_depend_on_a_hot_stop(spark):
    hot = samples(spark, {("A", 8, False, "low"): [7] * 3000 + [9] * 1000, ("B", 8, False, "low"): [1] * 40})
    rows = {r.stop_id: r for r in d.delay_distributions(hot).collect()}
    assert rows["A"].sample_size == 4000
    assert rows["A"].percentiles == [7] * 76 + [9] * 25
    assert rows["B"].percentiles == [1] * 101


def test_sketch_agrees_on_few_values(spark):
    data = samples(spark, {("A", 8, False, "low"): range(50)})
    exact = d.delay_percentiles(data, ["stop_id"]).first()
    sketch = d.delay_percentiles(data, ["stop_id"], approximate=True).first()
    assert exact.sample_size == sketch.sample_size == 50
    assert max(abs(a - b) for a, b in zip(exact.percentiles, sketch.percentiles)) <= 1


def test_lookup_falls_back(spark):
    model = d.delay_distributions(samples(spark, {("A", 8, False, "low"): [5] * 30}))
    requests = spark.createDataFrame(
        [("A", 8, False, "low"), ("A", 9, False, "low")], "stop_id string, hour int, rain boolean, temperature string"
    )
    rows = {r.hour: r for r in d.lookup_percentiles(requests, model).collect()}
    assert rows[8].sample_size == 30 and rows[8].percentiles == [5.0] * 101
    assert rows[9].sample_size == -1 and rows[9].percentiles[50] == pytest.approx(0.433217, abs=1e-6)


HISTORY = (
    "id int, year int, month int, weekofyear int, dayofmonth int, hour int, rain double, temperature double"
)


def test_weather_gaps(spark):
    rows = [
        (1, 2024, 1, 1, 1, 8, 1.0, 10.0),
        (2, 2024, 1, 1, 1, 9, 4.0, None),
        (3, 2024, 1, 1, 1, 9, 4.0, None),
        (4, 2024, 1, 1, 1, 10, None, None),  # day mean of rain, weighted by rows: 3.0
        (5, 2024, 1, 1, 2, 8, None, None),  # no rain that day: week mean; hour 8 of the week: 10
        (6, 2024, 1, 2, 9, 9, None, None),  # week unknown: month mean
        (7, 2024, 2, 5, 1, 9, None, 3.0),  # nothing known
    ]
    data = spark.createDataFrame(rows, HISTORY)
    filled = {r.id: r for r in h.fill_weather(data).collect()}
    assert len(filled) == 7
    assert [filled[i].rain for i in (4, 5, 6, 7)] == [3.0, 3.0, 3.0, None]
    assert [filled[i].temperature for i in (1, 2, 5)] == [10.0, None, 10.0]
    alone = {r.id: r.rain for r in h.fill_rain(data).collect()}
    assert alone == {i: r.rain for i, r in filled.items()}
    alone = {r.id: r.temperature for r in h.fill_temperature(data).collect()}
    assert alone == {i: r.temperature for i, r in filled.items()}


def documents(spark, observations):
    schema = "site string, observations array<struct<valid_time_gmt: bigint, precip_hrly: double, temp: int>>"
    return spark.createDataFrame([("X", observations)], schema)


def test_hourly_weather_takes_the_last_observation(spark):
    start = 1704067200  # 2024-01-01 01:00 in Zurich
    data = documents(spark, [(start, 1.0, 1), (start + 600, 2.0, None), (start + 3600, 3.0, 5)])
    period = (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    rows = {r.hour: r for r in h.hourly_weather(data, F.lit("X"), period).collect()}
    assert (rows[1].rain, rows[1].temperature) == (2.0, None)
    assert (rows[2].rain, rows[2].temperature) == (3.0, 5)
    assert h.hourly_weather(data, F.lit("Y"), period).count() == 0


def test_last_day_of_weather_is_open_unless_asked(spark):
    midnight = 1704150000  # 2024-01-02 00:00 in Zurich
    data = documents(spark, [(midnight, 1.0, 1), (midnight + 7200, 2.0, 2)])
    period = (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert [r.hour for r in h.hourly_weather(data, F.lit("X"), period).collect()] == [0]
    whole = h.hourly_weather(data, F.lit("X"), period, whole_last_day=True)
    assert sorted(r.hour for r in whole.collect()) == [0, 2]


ARRIVALS = (
    "bpuic bigint, operating_day date, arr_time timestamp_ntz, dep_time timestamp_ntz, arr_actual timestamp_ntz, "
    "arr_status string, product_id string, unplanned boolean, failed boolean, transit boolean"
)


def test_arrival_history(spark):
    day = dt.date(2024, 6, 3)
    at = dt.datetime(2024, 6, 3, 20, 59)

    def arrival(**changes):
        row = {
            "bpuic": 8500001, "operating_day": day, "arr_time": at, "dep_time": at,
            "arr_actual": at + dt.timedelta(seconds=90), "arr_status": "REAL", "product_id": "Bus",
            "unplanned": False, "failed": False, "transit": False, **changes,
        }
        return tuple(row.values())

    saturday = dt.date(2024, 6, 8)
    rows = [
        arrival(),
        arrival(),  # equal rows count once
        arrival(arr_actual=at - dt.timedelta(seconds=5), product_id="Tram"),
        arrival(bpuic=8500009),
        arrival(unplanned=True),
        arrival(failed=None),
        arrival(product_id=None),
        arrival(product_id="Taxi"),
        arrival(arr_status="UNBEKANNT"),
        arrival(arr_actual=None),
        arrival(dep_time=None),
        arrival(operating_day=saturday),
        arrival(arr_time=dt.datetime(2024, 6, 3, 21)),
        arrival(operating_day=dt.date(2025, 1, 6)),
    ]
    stops = spark.createDataFrame([("8500001",), ("8500001:0:A",), ("8500001:0:B",)], "stop_id string")
    found = h.arrival_history(spark.createDataFrame(rows, ARRIVALS), stops).collect()
    assert sorted((r.stop_id, r.delay, r.type) for r in found) == [("8500001", 0, "metro"), ("8500001", 90, "bus")]


def test_ks_statistic(spark):
    def group(values):
        return spark.createDataFrame([("A", x) for x in values], "stop_id string, delay bigint")

    row = v.ks_by_group(group([1, 2, 3, 4]), group([3, 4, 5, 6]), ["stop_id"], min_samples=4).first()
    assert row.statistic == pytest.approx(0.5) and row.p_value == pytest.approx(54 / 70)
    few = v.ks_by_group(group([1, 2, 3, 4]), group([3, 4, 5, 6]), ["stop_id"], min_samples=4, exact_up_to=3).first()
    assert few.p_value == pytest.approx(0.6994, abs=1e-3)
    assert (row.n_train, row.n_validation) == (4, 4)
    assert v.ks_by_group(group([1, 2]), group([3, 4]), ["stop_id"], min_samples=3).count() == 0


def test_calibration_counts_values_at_or_below(spark):
    model = d.delay_distributions(samples(spark, {("A", 8, False, "low"): range(101)}), min_samples=1)
    held_out = samples(spark, {("A", 8, False, "low"): [0, 50, 50, 200]})
    rows = {r.percentile: r for r in v.cdf_calibration(model, held_out).collect()}
    assert len(rows) == 101
    assert rows[100].train_probability == 1.0
    at_49, at_50 = (model.first().percentiles[p] for p in (49, 52))
    assert rows[49].validation_probability == (0.25 if at_49 < 50 else 0.75)
    assert rows[52].validation_probability == (0.25 if at_50 < 50 else 0.75)
    nothing = samples(spark, {("B", 8, False, "low"): [1]})
    assert {r.validation_probability for r in v.cdf_calibration(model, nothing).collect()} == {0.0}


def test_seeded_groups_are_stable(spark):
    groups = spark.range(100).select(F.col("id").cast("string").alias("stop_id"))
    first = v.sample_groups(groups, ["stop_id"], 5, 490).collect()
    again = v.sample_groups(groups.repartition(7), ["stop_id"], 5, 490).collect()
    assert first == again and len(first) == 5


def test_merged_sketches(spark):
    data = spark.range(60_000).selectExpr("id % 3 AS stop_id", "id % 7 AS hour", "id * 7919 % 1801 AS delay")
    days = [d.delay_sketches(data.filter(f"id % 2 = {k}"), ["stop_id", "hour"], "delay") for k in (0, 1)]
    merged = d.merge_sketches(days[0].union(days[1]), ["stop_id"])
    found = d.rank_errors(d.sketch_percentiles(merged), data, ["stop_id"], "delay").collect()
    assert [(r.sample_size, r.within) for r in found] == [(20_000, True)] * 3
    small = data.filter("id < 300")
    exact = d.rank_errors(d.sketch_percentiles(d.delay_sketches(small, ["stop_id"], "delay")), small, ["stop_id"], "delay")
    assert [r.rank_error for r in exact.collect()] == [0.0] * 3
