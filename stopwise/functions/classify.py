"""Discrete classes and clipping used as grouping keys of the delay model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopwise.config import (
    BUS_PRODUCTS,
    LOW_TEMPERATURE,
    MAX_DELAY_S,
    MEDIUM_TEMPERATURE,
    METRO_PRODUCTS,
    RAIN_THRESHOLD,
    STATION_ID_LENGTH,
    TRAIN_PRODUCTS,
)


def vehicle_type(product: Column) -> Column:
    return (
        F.when(product.isin(*BUS_PRODUCTS), "bus")
        .when(product.isin(*TRAIN_PRODUCTS), "train")
        .when(product.isin(*METRO_PRODUCTS), "metro")
    )


def clip_delay(delay: Column, maximum: int = MAX_DELAY_S) -> Column:
    """Delay within 0..maximum; null stays null."""
    bounded = F.least(F.greatest(delay, F.lit(0).cast("long")), F.lit(maximum).cast("long"))
    return F.when(delay.isNotNull(), bounded)


def is_rainy(rain: Column, threshold: float = RAIN_THRESHOLD) -> Column:
    """True strictly above the threshold; unknown counts as dry."""
    return F.coalesce(rain > threshold, F.lit(False))


def temperature_class(
    temperature: Column, low: float = LOW_TEMPERATURE, medium: float = MEDIUM_TEMPERATURE
) -> Column:
    """low, medium or high; unknown counts as high."""
    return F.when(temperature < low, "low").when(temperature < medium, "medium").otherwise("high")


def station_id(stop_id: Column) -> Column:
    """Station part of a platform id."""
    return F.substring(stop_id, 1, STATION_ID_LENGTH)
