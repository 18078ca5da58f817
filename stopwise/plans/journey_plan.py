"""Journeys with confidence for a table of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.functions.classify import temperature_class
from stopwise.operators.confidence import journey_confidence
from stopwise.operators.journeys import pick_journeys, search_journeys
from stopwise.operators.legs import explode_legs, journey_facts, timed_legs
from stopwise.plans.travel_network import TravelNetwork
from stopwise.sources.workspace import Workspace


def find_journeys(
    queries: DataFrame,
    travel: TravelNetwork,
    workspace: Workspace,
    max_legs: int | None = None,
) -> DataFrame:
    """Up to ``k`` journeys per query, with timed legs.

    Queries: query_id, from_stop_id, to_stop_id, arrival_s, max_walk_m, k.
    """
    labels = search_journeys(queries, travel.hops, travel.walks, workspace, max_legs)
    picked = pick_journeys(queries, labels)
    return picked.withColumn("legs", timed_legs(F.col("legs"), F.col("dep_s")))


def add_confidence(journeys: DataFrame, distributions: DataFrame) -> DataFrame:
    """Journeys with ``confidence``; queries carry ``rain`` and ``temperature_c``."""
    keys = ["query_id", "journey_rank"]
    classed = journeys.withColumns(
        {"temperature": temperature_class(F.col("temperature_c")), "deadline_s": F.col("arrival_s")}
    )
    # The search's rides are whole rides already, so the legs are compressed.
    legs = explode_legs(classed, [*keys, "rain", "temperature", "deadline_s"])
    confidence = journey_confidence(legs, distributions, keys)
    joined = journeys.join(confidence, keys, "left")
    return joined.withColumn("confidence", F.coalesce("confidence", F.lit(1.0)))


def reliable_journeys(journeys: DataFrame, min_confidence: float) -> DataFrame:
    """Journeys that hold with at least ``min_confidence``, ranked again within their query."""
    order = Window.partitionBy("query_id").orderBy("cost", "transfers", "walked_s", "signature")
    kept = journeys.filter(F.col("confidence") >= min_confidence)
    return kept.withColumn("journey_rank", F.row_number().over(order))


def plan_journeys(
    queries: DataFrame,
    travel: TravelNetwork,
    distributions: DataFrame,
    workspace: Workspace,
    min_confidence: float,
    max_legs: int | None = None,
) -> DataFrame:
    """Journeys of each query that arrive in time with at least ``min_confidence``, best first."""
    found = find_journeys(queries, travel, workspace, max_legs)
    return journey_facts(reliable_journeys(add_confidence(found, distributions), min_confidence))
