"""Splitting of join keys that hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SPLIT = 100_000


def split_hot_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    rows_per_split: int = ROWS_PER_SPLIT,
) -> tuple[DataFrame, DataFrame]:
    """Add a ``split`` column so that an equi-join on ``keys + split`` is balanced.

    Left rows of a key with many rows are spread over several splits by a hash of ``spread_by``; the
    right rows of that key are repeated once per split. Only keys above ``rows_per_split`` are kept in
    the side table, so it has at most rows / rows_per_split entries.
    """
    keys = list(keys)
    hot = (
        left.groupBy(*keys)
        .agg(F.ceil(F.count(F.lit(1)) / rows_per_split).cast("int").alias("splits"))
        .filter(F.col("splits") > 1)
    )
    splits = F.coalesce("splits", F.lit(1))
    spread = F.pmod(F.xxhash64(*spread_by), splits).cast("int")
    left = left.join(hot, keys, "left").withColumn("split", spread).drop("splits")
    right = (
        right.join(hot, keys, "left")
        .withColumn("split", F.explode(F.sequence(F.lit(0), splits - 1)))
        .drop("splits")
    )
    return left, right
