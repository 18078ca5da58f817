"""Probability that a journey holds: every connection is made and the deadline is met."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.config import FALLBACK_RATE
from stopwise.functions.classify import station_id
from stopwise.functions.probability import probability_below
from stopwise.operators.distributions import lookup_percentiles
from stopwise.operators.legs import leg_slack


def connection_probabilities(
    slacks: DataFrame, distributions: DataFrame, rate: float = FALLBACK_RATE
) -> DataFrame:
    """Slack rows with the chance that the ride's delay stays below the slack."""
    keyed = slacks.withColumn("stop_id", station_id(F.col("to_stop_id")))
    found = lookup_percentiles(keyed, distributions, rate)
    chance = probability_below(F.col("slack_s").cast("double"), F.col("percentiles"))
    return found.withColumn("probability", chance)


def journey_confidence(
    legs: DataFrame,
    distributions: DataFrame,
    keys: Sequence[str] = ("journey_id",),
    deadline: str = "deadline_s",
    rate: float = FALLBACK_RATE,
) -> DataFrame:
    """Confidence per journey from compressed legs that carry ``rain`` and ``temperature``.

    Journeys without a ride have no row here; their confidence is 1.
    """
    context = [*keys, "rain", "temperature"]
    chances = connection_probabilities(leg_slack(legs, context, deadline), distributions, rate)
    return chances.groupBy(*keys).agg(F.product("probability").alias("confidence"))
