"""Search of the latest-leaving journeys that reach a stop by a deadline, for many queries at once.

The search runs backwards in rounds, one leg a round. A label says: from this stop one can still make
the destination when leaving at ``dep_s``. All queries to the same destination, deadline and walking
budget share one search.

A round extends the labels of the last round by rides that come to their stops (from any earlier stop of the run) and by walking
edges, drops what is dominated and keeps the rest. Label a dominates label b of the same stop when
it leaves no earlier, allows as late a connection and has walked no further: whatever goes on from b then
goes on from a, or, where that would pass a stop of a again, from a's own label at that stop.

For one journey per query a label is dropped when any other dominates it. For k journeys it is dropped
when labels of k different branches dominate it. A branch is the first label at which a dominating path
leaves the path of the dropped one. Paths of one branch can be cut short at the same stop and so stand
for one journey only; paths of k branches always give k different journeys.

A label leaves no later than the one it goes on from, and no later than those that dominate it. So a search that only keeps labels
that leave within a span before the best journey, and that an origin can come to, keeps the same ones of these as a search of all.
Searches start with a short span; origins that do not hold all journeys asked of them by then are searched again with twice the
span, in the end without any. Nothing else limits the labels.

The hops and walks are stored once; each search is then worked off as a whole by one task (``timed_search``), and searches are dealt
over as many tasks as there are cores, or more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.config import TRANSFER_TIME_S, WALKING_SPEED_MPS
from stopwise.operators import timed_search
from stopwise.operators.network import ride_runs
from stopwise.sources.workspace import Workspace

#: Candidates of one search and stop that come together before they are compared.
FOLD_ROWS = 512
#: Journeys are first looked for among those that leave so many seconds before the best one, at most.
SPAN_S = 600
#: Searches (on average) that a task works off, at most; it reads the network once for them.
SEARCHES_PER_TASK = 2000
SEARCH_KEY = ("to_stop_id", "arrival_s", "max_walk_m")
#: The columns of hops that a search needs.
HOP = ("trip_id", "direction_id", "source_stop_sequence", "source_stop_id", "target_stop_id", "dep_s", "arr_s")
LEG = (
    "struct<kind: string, trip_id: string, from_stop_id: string, to_stop_id: string, "
    "dep_s: int, arr_s: int, walk_s: bigint>"
)
LABELS = f"search_id long, stop_id string, dep_s int, walked_s long, transfers int, label_id long, legs array<{LEG}>"


def searches_of(queries: DataFrame, walking_speed: float = WALKING_SPEED_MPS) -> DataFrame:
    """One search per destination, deadline and walking budget, with the largest ``k`` asked of it and of each origin.

    A search without a walking budget (null) does not walk; without a deadline or an origin other than its end it is left out.
    """
    asked = queries.groupBy(*SEARCH_KEY, "from_stop_id").agg(F.max("k").cast("int").alias("k"))
    origin = F.when(
        (F.col("from_stop_id") != F.col("to_stop_id")) & (F.col("k") > 0), F.struct(F.col("from_stop_id").alias("stop_id"), "k")
    )
    budget = F.floor(F.col("max_walk_m") / walking_speed + 1e-9)
    searches = asked.groupBy(*SEARCH_KEY).agg(
        F.xxhash64(*SEARCH_KEY).alias("search_id"), F.max("k").alias("width"), F.collect_list(origin).alias("origins")
    )
    return searches.filter("arrival_s IS NOT NULL AND size(origins) > 0").withColumns(
        {"arrival_s": F.col("arrival_s").cast("int"), "budget_s": F.coalesce(budget, F.lit(-1)).cast("int")}
    )


def search_rides(hops: DataFrame) -> DataFrame:
    """The columns of ride hops that the search needs, with a run id."""
    return ride_runs(hops).select(
        "trip_id",
        F.xxhash64("trip_id", "direction_id", "run_start").alias("run_id"),
        F.col("source_stop_sequence").alias("seq"),
        F.col("source_stop_id").alias("alight_stop_id"),
        F.col("target_stop_id").alias("board_stop_id"),
        "dep_s",
        "arr_s",
    )


def run_stops(rides: DataFrame) -> DataFrame:
    """Stops of each run with their place: the boarding stop of each hop, with where and when it ends, and the last hop's end."""
    hop = F.struct(
        (F.col("seq") - 1).alias("place"), F.col("board_stop_id").alias("stop_id"), "dep_s",
        F.col("alight_stop_id").alias("next_stop_id"), "arr_s",
    )
    none = F.lit(None)
    end = F.struct(
        F.col("seq").alias("place"), F.col("alight_stop_id").alias("stop_id"), none.cast("int").alias("dep_s"),
        none.cast("string").alias("next_stop_id"), none.cast("int").alias("arr_s"),
    )
    both = rides.select("run_id", "trip_id", F.inline(F.array(hop, end)))
    values = ("stop_id", "dep_s", "next_stop_id", "arr_s")
    return both.groupBy("run_id", "trip_id", "place").agg(*[F.max(c).alias(c) for c in values])


def run_boardings(stops: DataFrame) -> DataFrame:
    """For each run its boardings in order; a ride from a boarding may end before place ``until``, where it would repeat a stop."""
    again = F.lead("place").over(Window.partitionBy("run_id", "stop_id").orderBy("place"))
    after = Window.partitionBy("run_id").orderBy("place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    limited = stops.withColumn("again", again).withColumn("until", F.min("again").over(after))
    boarding = F.struct("place", "stop_id", "dep_s", "until", "next_stop_id", "arr_s")
    return limited.filter("dep_s IS NOT NULL").groupBy("run_id", "trip_id").agg(F.array_sort(F.collect_list(boarding)).alias("boardings"))


def search_walks(walks: DataFrame) -> DataFrame:
    """Walks by the stops at their ends; one takes the longer of walking and minimum transfer time, only the walking counts for the budget."""
    takes = F.greatest("transfer_time", "walk_s").cast("int").alias("takes_s")
    return walks.select(
        F.col("source_stop_id").alias("at_stop_id"), F.col("target_stop_id").alias("start_stop_id"), F.col("walk_s").cast("long").alias("walk_s"), takes,
    ).dropna().distinct()


def stored_network(hops: DataFrame, walks: DataFrame, workspace: Workspace, prefix: str = "") -> tuple[str, str]:
    """The folders of the runs and walks that searches read.

    Runs look at the hops more than once; what these are made of is worked through once.
    """
    stored, _ = workspace.write(f"{prefix}hops", hops.select(*HOP))
    workspace.write(f"{prefix}runs", run_boardings(run_stops(search_rides(stored))))
    workspace.write(f"{prefix}walks", search_walks(walks))
    return f"{workspace.root}/{prefix}runs", f"{workspace.root}/{prefix}walks"


def dealt(searches: DataFrame, count: int) -> DataFrame:
    """``searches`` in as many parts as keep all cores at work, each of a bounded size on average."""
    cores = searches.sparkSession.sparkContext.defaultParallelism
    return searches.repartition(max(1, min(count, 2 * cores), -(-count // SEARCHES_PER_TASK)))


def search_journeys(
    queries: DataFrame,
    hops: DataFrame,
    walks: DataFrame,
    workspace: Workspace,
    max_legs: int | None = None,
    walking_speed: float = WALKING_SPEED_MPS,
    transfer_time: int = TRANSFER_TIME_S,
    prune: bool = True,
) -> DataFrame:
    """Labels of the searches behind ``queries``, one per journey kept: among them all that can be an answer.

    Rounds end when one brings no new label, or after ``max_legs`` if the caller wants no longer journeys. Without
    ``prune`` every journey that repeats no stop is kept. Otherwise a search keeps the labels at its origins and looks no further back
    than its answers need.
    """
    tables = stored_network(hops, walks, workspace)
    run = timed_search.labels_run(
        tables, transfer_s=transfer_time, span_s=SPAN_S, max_legs=max_legs, wide=dict(hops.dtypes)["source_stop_sequence"] == "bigint",
        fold_rows=FOLD_ROWS, prune=prune,
    )
    searches, count = workspace.write("searches", searches_of(queries, walking_speed))
    return workspace.write("labels", dealt(searches, count).mapInArrow(run, LABELS))[0]


def pick_journeys(queries: DataFrame, labels: DataFrame) -> DataFrame:
    """The ``k`` best journeys of each query by (cost, transfers, walking), ties by leg signature.

    Cost is the time from departure to the deadline. Queries without a journey have no row.
    """
    asked = queries.withColumn("search_id", F.xxhash64(*SEARCH_KEY))
    found = asked.join(
        labels.withColumnRenamed("stop_id", "from_stop_id"),
        ["search_id", "from_stop_id"],
    ).withColumn("cost", F.col("arrival_s") - F.col("dep_s"))
    order = Window.partitionBy("query_id").orderBy("cost", "transfers", "walked_s", "label_id")
    ranked = found.withColumn("journey_rank", F.row_number().over(order)).filter(F.col("journey_rank") <= F.col("k"))
    return ranked.select(
        *queries.columns,
        "journey_rank",
        "cost",
        "dep_s",
        "transfers",
        "walked_s",
        F.reverse("legs").alias("legs"),
        F.col("label_id").alias("signature"),
    )
