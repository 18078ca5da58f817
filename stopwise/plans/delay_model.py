"""Delay model: from arrivals and weather to delay distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.config import INFERENCE_PERIOD, MIN_SAMPLES
from stopwise.operators.distributions import delay_distributions
from stopwise.operators.history import (
    Period,
    add_weather,
    arrival_history,
    classify_weather,
    fill_weather,
    hourly_weather,
)
from stopwise.operators.regions import closest_site, region_centroid, select_regions, stops_within


def region_stops(stops: DataFrame, polygons: DataFrame) -> DataFrame:
    """Ids of boarding stops of any snapshot inside the polygons."""
    boarding = stops.filter(F.col("location_type").isNull()).select("stop_id", "stop_lon", "stop_lat")
    return stops_within(boarding, polygons).select("stop_id").distinct()


def classified_history(
    arrivals: DataFrame,
    stops: DataFrame,
    polygons: DataFrame,
    stations: DataFrame,
    weather_documents: DataFrame,
    region_ids: Sequence[str],
    period: Period = INFERENCE_PERIOD,
    **filters,
) -> DataFrame:
    """Delays of the regions' stations with rain flag and temperature class."""
    regions = select_regions(polygons, region_ids)
    site = closest_site(stations, region_centroid(regions)).select("site").scalar()
    weather = hourly_weather(weather_documents, site, period)
    history = arrival_history(arrivals, region_stops(stops, regions), period=period, **filters)
    return classify_weather(fill_weather(add_weather(history, weather)))


def fit(history: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    return delay_distributions(history, min_samples=min_samples)
