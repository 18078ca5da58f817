import itertools
import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stopwise.functions import classify, geo, probability, times

TENS = [10 * i for i in range(101)]
TWO_VALUES = [0] * 50 + [60] * 51


def doubles(values):
    return F.array(*[F.lit(float(x)) for x in values])


def test_clock_past_midnight(evaluate):
    parsed = times.parse_clock(F.lit("25:15:00"))
    assert evaluate(times.format_clock(times.wrap_clock(parsed))) == "01:15:00"
    assert evaluate(times.day_shift(parsed)) == 1
    assert evaluate(times.format_clock(times.wrap_clock(times.parse_clock(F.lit("23:59:00"))))) == "23:59:00"


@pytest.mark.parametrize("text", ["", "7", "07:30", "aa:10:00"])
def test_malformed_clock_is_null(evaluate, text):
    assert evaluate(times.parse_clock(F.lit(text))) is None


@pytest.mark.parametrize(
    "shift,expected",
    [(0, "TTTTFFT"), (1, "TTTTTFF"), (6, "TTTFFTT"), (7, None)],
)
def test_weekday_rotation(evaluate, shift, expected):
    sunday_to_thursday = [F.lit(c == "T") for c in "TTTTFFT"]
    rotated = evaluate(F.array(*times.rotate_weekdays(sunday_to_thursday, F.lit(shift))))
    assert rotated == ([c == "T" for c in expected] if expected else [None] * 7)


def test_time_arithmetic_stays_in_the_day(evaluate):
    assert evaluate(times.subtract_seconds(F.lit(10), F.lit(20))) is None
    assert evaluate(times.add_seconds(F.lit(86390), F.lit(20))) is None
    assert evaluate(times.add_seconds(F.lit(86390), F.lit(9), strict=True)) == 86399
    with pytest.raises(PySparkException):
        evaluate(times.subtract_seconds(F.lit(10), F.lit(20), strict=True))


@pytest.mark.parametrize("seconds,text", [(59, "0m"), (3540, "59m"), (3600, "1h 0m"), (7325, "2h 2m")])
def test_duration_text(evaluate, seconds, text):
    assert evaluate(times.duration_text(F.lit(seconds))) == text


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_local_time_ignores_the_session_zone(spark, evaluate, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert evaluate(times.local_time(F.lit(1704067200))) == dt.datetime(2024, 1, 1, 1)
        assert evaluate(times.local_time(F.lit(1719792000))) == dt.datetime(2024, 7, 1, 2)
        assert evaluate(times.parse_local(F.lit("2024-07-01 02:00:00"))) == dt.datetime(2024, 7, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_weekday_name_and_clock(evaluate):
    assert evaluate(times.weekday_name(F.lit(dt.date(2024, 6, 3)))) == "monday"
    assert evaluate(times.clock_of(F.lit("2024-06-03 10:02:03").cast("timestamp_ntz"))) == 36123
    assert evaluate(times.seconds_between(F.lit(100), F.lit(130))) == -30


@pytest.mark.parametrize("delay,clipped", [(-60, 0), (1799, 1799), (1800, 1800), (1900, 1800), (None, None)])
def test_clip_delay(evaluate, delay, clipped):
    assert evaluate(classify.clip_delay(F.lit(delay).cast("long"))) == clipped


@pytest.mark.parametrize("rain,flag", [(2.5, False), (2.51, True), (None, False)])
def test_rain_flag(evaluate, rain, flag):
    assert evaluate(classify.is_rainy(F.lit(rain).cast("double"))) is flag


@pytest.mark.parametrize(
    "degrees,name", [(5.9, "low"), (6.0, "medium"), (13.9, "medium"), (14.0, "high"), (None, "high")]
)
def test_temperature_class(evaluate, degrees, name):
    assert evaluate(classify.temperature_class(F.lit(degrees).cast("double"))) == name


@pytest.mark.parametrize("product,kind", [("BUS", "bus"), ("CS", "train"), ("Stadtbahn", "metro"), ("Taxi", None)])
def test_vehicle_type(evaluate, product, kind):
    assert evaluate(classify.vehicle_type(F.lit(product))) == kind


def test_distance_of_one_degree(evaluate):
    metres = evaluate(geo.sphere_distance(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)))
    assert metres == pytest.approx(111195.07, abs=0.01)


def ring(*points):
    return F.array(*[F.struct(F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat")) for x, y in points])


SQUARE = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
HOLE = [(0.5, 0.5), (1, 0.5), (1, 1), (0.5, 1), (0.5, 0.5)]
L_SHAPE = [(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)]


@pytest.mark.parametrize(
    "rings,x,y,inside",
    [
        ([SQUARE], 1.5, 1.5, True),
        ([SQUARE], 2, 1, False),
        ([SQUARE], 3, 1, False),
        ([SQUARE], 0, 0, False),
        ([SQUARE, HOLE], 0.75, 0.75, False),
        ([SQUARE, HOLE], 1.0, 0.75, False),
        ([SQUARE, HOLE], 0.25, 0.75, True),
        ([L_SHAPE], 1.5, 1.5, False),
        ([L_SHAPE], 0.5, 1.0, True),
        ([L_SHAPE], -1, 1, False),
    ],
)
def test_polygon_contains(evaluate, rings, x, y, inside):
    assert evaluate(geo.polygon_contains(F.array(*[ring(*r) for r in rings]), F.lit(float(x)), F.lit(float(y)))) is inside


@pytest.mark.parametrize("value,expected", [(-5, 0), (0, 0), (5, 0.005), (250, 0.25), (1000, 1)])
def test_interpolated_probability(evaluate, value, expected):
    assert evaluate(probability.probability_below(F.lit(float(value)), doubles(TENS))) == pytest.approx(expected)


@pytest.mark.parametrize("value,expected", [(0, 0), (30, 0.495), (60, 1)])
def test_probability_on_two_values(evaluate, value, expected):
    assert evaluate(probability.probability_below(F.lit(float(value)), doubles(TWO_VALUES))) == pytest.approx(expected)


def test_exponential_fallback(evaluate):
    values = evaluate(probability.exponential_percentiles())
    assert values[50] == pytest.approx(0.433217, abs=1e-6)
    assert values[99] == pytest.approx(2.878231, abs=1e-6)
    assert values[100] == math.inf
    below = probability.exponential_percentiles()
    assert evaluate(probability.probability_below(F.lit(10.0), below)) == pytest.approx(0.99)
    assert evaluate(probability.probability_below(F.lit(0.0), below)) == 0
    with pytest.raises(ValueError):
        probability.exponential_percentiles(0)


def test_probability_grows_with_the_value(spark):
    rows = spark.range(0, 1100).select(probability.probability_below(F.col("id").cast("double"), doubles(TENS)).alias("p"))
    values = [r.p for r in rows.collect()]
    assert all(0 <= a <= b <= 1 for a, b in zip(values, values[1:]))


def test_kolmogorov_p_value_against_a_direct_sum(evaluate):
    scaled = 0.3 * math.sqrt(40 * 50 / 90)
    direct = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * scaled**2) for j in range(1, 101))
    value = evaluate(probability.kolmogorov_p_value(F.lit(0.3), F.lit(40), F.lit(50)))
    assert value == pytest.approx(direct)
    assert evaluate(probability.kolmogorov_p_value(F.lit(0.0), F.lit(40), F.lit(50))) == 1


def test_exact_two_sample_against_all_orders():
    for n1, n2 in ((1, 1), (2, 3), (4, 4), (3, 6), (5, 4)):
        gaps = []
        for places in itertools.combinations(range(n1 + n2), n1):
            i = j = most = 0
            for k in range(n1 + n2):
                i, j = (i + 1, j) if k in places else (i, j + 1)
                most = max(most, abs(i * n2 - j * n1))
            gaps.append(most)
        for gap in range(n1 * n2 + 2):
            share = sum(g >= gap for g in gaps) / len(gaps)
            assert probability.exact_two_sample(n1, n2, gap) == pytest.approx(share, abs=1e-14)
    assert probability.exact_two_sample(5, 5, 25) == pytest.approx(2 / 252)
    # Two tails of one path each; far below what one less a sum would leave.
    assert probability.exact_two_sample(60, 60, 3600) == pytest.approx(2 / math.comb(120, 60), rel=1e-12)
    # Near the leading term of the asymptotic series for large samples.
    assert probability.exact_two_sample(1000, 900, 90_000) == pytest.approx(2 * math.exp(-2 * 0.01 * 1000 * 900 / 1900), rel=0.15)
