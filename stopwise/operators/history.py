"""Cleaning of actual arrivals, hourly weather and filling of weather gaps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.config import (
    ACCEPTED_ARRIVAL_STATUS,
    EXCLUDED_PRODUCTS,
    INFERENCE_PERIOD,
    LOW_TEMPERATURE,
    MAX_ARRIVAL_HOUR,
    MAX_DELAY_S,
    MEDIUM_TEMPERATURE,
    MIN_DEPARTURE_HOUR,
    RAIN_THRESHOLD,
    TIME_ZONE,
    VALID_YEARS,
)
from stopwise.functions.classify import clip_delay, is_rainy, station_id, temperature_class, vehicle_type
from stopwise.functions.times import is_weekday, local_time

Period = tuple[dt.date, dt.date]
HOUR_KEYS = ("year", "month", "dayofmonth", "hour")
MEANS = {
    "rain": (("year", "month", "dayofmonth"), ("year", "weekofyear"), ("year", "month")),
    "temperature": (("year", "weekofyear", "hour"), ("year", "month", "hour")),
}

#: Units of a mean's sums, a power of two.
MEAN_UNITS = float(1 << 30)


def usable_arrivals(
    arrivals: DataFrame,
    period: Period = INFERENCE_PERIOD,
    min_departure_hour: int = MIN_DEPARTURE_HOUR,
    max_arrival_hour: int = MAX_ARRIVAL_HOUR,
    valid_years: Sequence[int] = VALID_YEARS,
) -> DataFrame:
    """Regular measured arrivals of working days within the day's service hours."""
    start, end = period
    return arrivals.filter(
        F.col("operating_day").between(F.lit(start), F.lit(end))
        & ~F.col("unplanned")
        & ~F.col("failed")
        & ~F.col("transit")
        & F.col("arr_status").isin(*ACCEPTED_ARRIVAL_STATUS)
        & ~F.col("product_id").isin(*EXCLUDED_PRODUCTS)
        & F.col("arr_actual").isNotNull()
        & is_weekday(F.col("operating_day"))
        & (F.hour("arr_time") <= max_arrival_hour)
        & (F.hour("dep_time") >= min_departure_hour)
        & F.year("operating_day").isin(*valid_years)
    )


def stations_semi_join(arrivals: DataFrame, stops: DataFrame) -> DataFrame:
    """Arrivals at a station that has at least one platform among ``stops``."""
    stations = stops.select(station_id(F.col("stop_id")).alias("stop_id"))
    return arrivals.withColumn("stop_id", F.col("bpuic").cast("string")).join(stations, "stop_id", "left_semi")


def arrival_history(
    arrivals: DataFrame, stops: DataFrame, max_delay: int = MAX_DELAY_S, **filters
) -> DataFrame:
    """Distinct ``(stop_id, operating_day, arr_time, delay, type)`` of usable arrivals."""
    delay = F.timestamp_diff("SECOND", F.col("arr_time"), F.col("arr_actual"))
    measured = stations_semi_join(usable_arrivals(arrivals, **filters), stops)
    return measured.select(
        "stop_id",
        "operating_day",
        "arr_time",
        clip_delay(delay, max_delay).alias("delay"),
        vehicle_type(F.col("product_id")).alias("type"),
    ).distinct()


def hourly_weather(
    documents: DataFrame,
    site: Column,
    period: Period = INFERENCE_PERIOD,
    valid_years: Sequence[int] = VALID_YEARS,
    zone: str = TIME_ZONE,
    whole_last_day: bool = False,
) -> DataFrame:
    """Last observation of each local hour at ``site``.

    The period ends at midnight at the start of its last day unless ``whole_last_day`` is set. Rain and
    temperature are taken from the last observation even where it lacks a value.
    """
    start, end = period
    local = F.col("local")
    upper = local < F.lit(end + dt.timedelta(days=1)) if whole_last_day else local <= F.lit(end)
    observed = (
        documents.filter(F.col("site") == site)
        .select(F.inline("observations"))
        .select(
            local_time(F.col("valid_time_gmt"), zone).alias("local"),
            F.col("valid_time_gmt").alias("epoch"),
            F.col("precip_hrly").alias("rain"),
            F.col("temp").alias("temperature"),
        )
        .filter(F.year(local).isin(*valid_years) & (local >= F.lit(start)) & upper)
    )
    return observed.groupBy(
        F.year(local).alias("year"),
        F.month(local).alias("month"),
        F.dayofmonth(local).alias("dayofmonth"),
        F.hour(local).alias("hour"),
    ).agg(
        F.max_by("rain", F.struct(F.minute(local), "epoch", "rain")).alias("rain"),
        F.max_by("temperature", F.struct(F.minute(local), "epoch", "temperature")).alias("temperature"),
    )


def add_weather(history: DataFrame, weather: DataFrame) -> DataFrame:
    """History with the weather of the arrival hour, null where unknown, and calendar columns.

    ``weather`` has one row per hour.
    """
    day = F.col("operating_day")
    dated = history.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "weekofyear": F.weekofyear(day),
            "dayofmonth": F.dayofmonth(day),
            "hour": F.hour("arr_time"),
        }
    )
    return dated.join(weather, list(HOUR_KEYS), "left")


def _mean_over(column: str, keys: Sequence[str]) -> Column:
    window = Window.partitionBy(*keys)
    whole = F.sum(f"{column}_sum").over(window).cast("double")
    return whole / F.sum(f"{column}_n").over(window) / MEAN_UNITS


def _fill(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values as the first known mean of the groups in ``MEANS``, weighted by history rows.

    History is first summed per hour of the calendar. At most 8,928 (12 x 31 x 24) rows a year remain
    whatever its size: the windows run over those, a year at a time, and they are broadcast. Sums are of whole
    units, so that no order of adding changes a mean.
    """

    def units(c: str) -> Column:
        return F.sum(F.floor(F.col(c) * MEAN_UNITS + 0.5).cast("decimal(20,0)"))

    sums = [f(c).alias(f"{c}_{n}") for c in columns for f, n in ((units, "sum"), (F.count, "n"))]
    hours = (
        history.groupBy("year", "month", "weekofyear", "dayofmonth", "hour").agg(*sums).repartition("year")
    )
    means = [
        F.coalesce(*[_mean_over(c, keys) for keys in MEANS[c]]).alias(f"{c}_mean") for c in columns
    ]
    calendar = hours.select(*HOUR_KEYS, *means)
    joined = history.join(F.broadcast(calendar), list(HOUR_KEYS), "left")
    filled = joined.withColumns({c: F.coalesce(c, f"{c}_mean") for c in columns})
    return filled.select(*history.columns)


def fill_rain(history: DataFrame) -> DataFrame:
    """Missing rain as the mean of the same day, else week, else month."""
    return _fill(history, ["rain"])


def fill_temperature(history: DataFrame) -> DataFrame:
    """Missing temperature as the mean of the same hour in the week, else in the month."""
    return _fill(history, ["temperature"])


def fill_weather(history: DataFrame) -> DataFrame:
    """Both fillings from one pass over the history."""
    return _fill(history, ["rain", "temperature"])


def classify_weather(
    history: DataFrame,
    rain_threshold: float = RAIN_THRESHOLD,
    low: float = LOW_TEMPERATURE,
    medium: float = MEDIUM_TEMPERATURE,
) -> DataFrame:
    """Replace rain by a flag and temperature by a class."""
    return history.withColumns(
        {
            "rain": is_rainy(F.col("rain"), rain_threshold),
            "temperature": temperature_class(F.col("temperature"), low, medium),
        }
    )
