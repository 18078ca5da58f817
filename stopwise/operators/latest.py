"""The latest-leaving journey of each query, by a search that goes back in time.

Where one journey a query is wanted, a label needs no path: what would come back to a stop is dominated by the stop's own label.
A search goes back from its deadline, event by event (``timed_search.latest_departures``), and ends when all its origins are reached, so
what is worse than the answer is not looked at. Its state is bounded by the stops it comes to and the runs it scans. Each search is
worked off by one task; ``latest_journeys`` makes labels with legs only for what an origin can come to when left at its answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.config import TRANSFER_TIME_S, WALKING_SPEED_MPS
from stopwise.operators import timed_search
from stopwise.operators.journeys import (  # noqa: F401
    FOLD_ROWS,
    LABELS,
    SEARCH_KEY,
    dealt,
    run_boardings,
    run_stops,
    search_rides,
    searches_of,
    stored_network,
)
from stopwise.sources.workspace import Workspace

DEPARTURES = "search_id long, stop_id string, dep_s int, walked_s long"


def _searches(queries: DataFrame, workspace: Workspace, walking_speed: float) -> tuple[DataFrame, int]:
    # Numbered, not hashed, so that no two searches can share an id.
    searches = searches_of(queries.withColumn("k", F.lit(1)), walking_speed).withColumn("search_id", F.monotonically_increasing_id())
    return workspace.write("latest-searches", searches)


def _answers(queries: DataFrame, searches: DataFrame, found: DataFrame) -> DataFrame:
    """Queries with the values of ``found`` for their search and origin."""
    asked = queries.join(searches.select(*SEARCH_KEY, "search_id"), list(SEARCH_KEY))
    values = [c for c in found.columns if c not in ("search_id", "stop_id", "transfers", "label_id")]
    joined = asked.join(found.withColumnRenamed("stop_id", "from_stop_id"), ["search_id", "from_stop_id"])
    cost = F.col("arrival_s") - F.col("dep_s")
    return joined.select(*queries.columns, cost.alias("cost"), *values)


def latest_departures(
    queries: DataFrame,
    hops: DataFrame,
    walks: DataFrame,
    workspace: Workspace,
    walking_speed: float = WALKING_SPEED_MPS,
    transfer_time: int = TRANSFER_TIME_S,
) -> DataFrame:
    """The best journey of each query without its legs: the query's columns, ``cost``, ``dep_s`` and ``walked_s``.

    Queries as in ``search_journeys``, whose ``k`` doesn't matter here. Of the labels that leave equally late, one with least
    walking is kept. Queries without a journey have no row.
    """
    tables = stored_network(hops, walks, workspace, "latest-")
    searches, count = _searches(queries, workspace, walking_speed)
    run = timed_search.departures_run(tables, transfer_time)
    found, _ = workspace.write("latest-departures", dealt(searches, count).mapInArrow(run, DEPARTURES))
    return _answers(queries, searches, found)


def latest_journeys(
    queries: DataFrame,
    hops: DataFrame,
    walks: DataFrame,
    workspace: Workspace,
    walking_speed: float = WALKING_SPEED_MPS,
    transfer_time: int = TRANSFER_TIME_S,
) -> DataFrame:
    """As ``latest_departures``, with the ``legs`` in travel order."""
    tables = stored_network(hops, walks, workspace, "latest-")
    searches, count = _searches(queries, workspace, walking_speed)
    run = timed_search.labels_run(tables, transfer_s=transfer_time, span_s=0, max_legs=None, wide=True, fold_rows=FOLD_ROWS, prune=True)
    labels, _ = workspace.write("latest-labels", dealt(searches, count).mapInArrow(run, LABELS))
    order = F.struct(-F.col("dep_s"), "walked_s", "transfers", "label_id")
    best = labels.groupBy("search_id", "stop_id").agg(F.min_by(F.struct("dep_s", "walked_s", F.reverse("legs").alias("legs")), order).alias("b"))
    return _answers(queries, searches, best.select("search_id", "stop_id", "b.*"))
