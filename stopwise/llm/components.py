"""Connected components of link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.sources.workspace import Workspace


def connected_components(work: Workspace, name: str, links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of ``links`` (a, b).

    Each round points every node at its smallest neighbour, follows the pointers twice, and carries the
    links over to the nodes pointed at; links within a component vanish, so the table shrinks until it is
    empty. Rounds are written tables, and only their row counts come to the driver.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    left, rows = work.write(f"{name}-links-0", ordered.distinct())
    found = left.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    rounds = 0
    while rows:
        rounds += 1
        both = left.union(left.select(F.col("b"), F.col("a")))
        smallest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other"))
        step, _ = work.write(f"{name}-step-{rounds}", smallest.select("node", F.least("node", "other").alias("to")))
        jump = _follow(_follow(step, step, "to"), step, "to").select("node", "to")
        jump, _ = work.write(f"{name}-jump-{rounds}", jump)
        moved = _follow(found, jump, "component")
        new = jump.join(found.select("node"), "node", "left_anti").select("node", F.col("to").alias("component"))
        found, _ = work.write(f"{name}-found-{rounds}", moved.unionByName(new))
        carried = _follow(_follow(left, jump, "a"), jump, "b")
        carried = carried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
        left, rows = work.write(f"{name}-links-{rounds}", carried.distinct())
    return found


def _follow(rows: DataFrame, step: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``column`` replaced by where ``step`` points it, if it does."""
    to = step.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
    joined = rows.join(to, rows[column] == to["_node"], "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_node", "_to")
