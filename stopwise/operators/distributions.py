"""Delay percentiles per group, backing off to coarser groups when samples are few."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.config import (
    FALLBACK_RATE,
    GROUP_COLUMNS,
    MIN_SAMPLES,
    PERCENTILE_ACCURACY,
    RANK_ERROR,
    SKETCH_SIZE,
    VALUE_COLUMN,
)
from stopwise.functions.probability import exponential_percentiles


def value_counts(data: DataFrame, keys: Sequence[str], value: str = VALUE_COLUMN) -> DataFrame:
    """Rows per key and value, combined before the shuffle; delays have at most 1,801 values a key."""
    return data.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def group_counts(data: DataFrame, keys: Sequence[str], min_samples: int = 1) -> DataFrame:
    """Sample size of each group that has at least ``min_samples``."""
    counts = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("sample_size"))
    return counts.filter(F.col("sample_size") >= min_samples)


def percentiles_of_counts(
    counts: DataFrame, keys: Sequence[str], value: str = VALUE_COLUMN, carry: str | None = None
) -> DataFrame:
    """Exact 101 percentiles per key from value counts; percentile p has rank max(1, ceil(p n / 100)).

    Each row fills the percentiles whose rank falls within its share of the sorted sample. A value may
    come in several rows. Non-null values of the column ``carry`` are gathered in a list.
    """
    group = Window.partitionBy(*keys)
    upto = F.sum("n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    extra = [carry] if carry else []
    ranked = counts.select(
        *keys, value, "n", *extra, upto.alias("upto"), F.sum("n").over(group).alias("sample_size")
    )

    def filled(cumulative: Column) -> Column:
        return F.when(cumulative > 0, F.floor(cumulative * 100 / F.col("sample_size")) + 1).otherwise(0)

    repeats = (filled(F.col("upto")) - filled(F.col("upto") - F.col("n"))).cast("int")
    # Only rows that fill a percentile are gathered: 101 at most.
    run = F.when(repeats > 0, F.struct(F.col(value).alias("value"), repeats.alias("repeats")))
    expanded = F.flatten(
        F.transform(F.array_sort(F.collect_list("run")), lambda r: F.array_repeat(r.value, r.repeats))
    )
    return (
        ranked.withColumn("run", run)
        .groupBy(*keys)
        .agg(
            expanded.alias("percentiles"),
            F.first("sample_size").alias("sample_size"),
            *[F.collect_list(c).alias(c) for c in extra],
        )
    )


def delay_percentiles(
    history: DataFrame,
    keys: Sequence[str] = GROUP_COLUMNS,
    value: str = VALUE_COLUMN,
    approximate: bool = False,
    accuracy: int = PERCENTILE_ACCURACY,
) -> DataFrame:
    """101 percentiles and sample size per group, exact or by a sketch."""
    if approximate:
        shares = [i / 100 for i in range(101)]
        return history.groupBy(*keys).agg(
            F.percentile_approx(value, shares, accuracy).alias("percentiles"),
            F.count(F.lit(1)).alias("sample_size"),
        )
    return percentiles_of_counts(value_counts(history, keys, value), keys, value)


def delay_sketches(
    history: DataFrame, keys: Sequence[str] = GROUP_COLUMNS, value: str = VALUE_COLUMN, size: int = SKETCH_SIZE
) -> DataFrame:
    """A quantile sketch per key, to be stored: those of new days or of coarser keys come from ``merge_sketches``."""
    return history.groupBy(*keys).agg(F.kll_sketch_agg_bigint(F.col(value).cast("long"), size).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """The sketches of each of the coarser ``keys`` merged; the history is not read again."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch", size).alias("sketch"))


def sketch_percentiles(sketches: DataFrame) -> DataFrame:
    """``sketches`` as 101 percentiles and sample size."""
    shares = F.array(*[F.lit(p / 100) for p in range(101)])
    found = {"percentiles": F.kll_sketch_get_quantile_bigint("sketch", shares), "sample_size": F.kll_sketch_get_n_bigint("sketch")}
    return sketches.withColumns(found).drop("sketch")


def rank_errors(
    percentiles: DataFrame, history: DataFrame, keys: Sequence[str], value: str = VALUE_COLUMN, most: float = RANK_ERROR
) -> DataFrame:
    """Keys, ``sample_size``, ``rank_error`` of the worst percentile and whether it is ``within`` ``most``.

    A percentile's rank is any of those that its value has in the exact sample.
    """
    group = Window.partitionBy(*keys)
    upto = F.sum("n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = value_counts(history, keys, value).withColumns({"upto": upto, "all": F.sum("n").over(group)})
    claimed = percentiles.select(*keys, "sample_size", F.posexplode("percentiles").alias("percentile", value))
    both = claimed.join(ranked, [*keys, value], "left")
    share = F.col("percentile") / 100
    off = F.greatest((F.col("upto") - F.col("n")) / F.col("all") - share, share - F.col("upto") / F.col("all"), F.lit(0.0))
    worst = both.groupBy(*keys, "sample_size").agg(F.max(F.when(F.col("upto").isNull(), 1.0).otherwise(off)).alias("rank_error"))
    return worst.withColumn("within", F.col("rank_error") <= most)


def delay_distributions(
    history: DataFrame,
    keys: Sequence[str] = GROUP_COLUMNS,
    value: str = VALUE_COLUMN,
    min_samples: int = MIN_SAMPLES,
) -> DataFrame:
    """Percentiles per full key from the finest prefix with ``min_samples``; ``level`` tells which.

    Level i drops the last i keys. Full keys whose coarsest group is still too small are left out.

    The history is counted once per key and value. The counts are then dealt by the first key, and all
    that follows stays within that partitioning: prefix sizes, choice of level, and percentiles of just
    the groups that some key chose. A first key holds at most (its full keys) x (distinct values) counts,
    144 x 1,801 for stop, hour, rain and temperature, however many samples there are.
    """
    keys = list(keys)
    depth = len(keys)
    prefixes = [Window.partitionBy(*keys[: depth - level]) for level in range(depth)]
    # From the finest window to the coarsest: the first sort serves them all.
    sized = value_counts(history, keys, value).repartition(F.col(keys[0]))
    for level, prefix in enumerate(prefixes):
        sized = sized.withColumn(f"size_{level}", F.sum("n").over(prefix))
    choice = F.coalesce(*[F.when(F.col(f"size_{i}") >= min_samples, i) for i in range(depth)])
    chosen = sized.withColumn("choice", choice).filter(F.col("choice").isNotNull())
    full_key = Window.partitionBy(*keys).orderBy(value)
    asks = F.when(F.row_number().over(full_key) == 1, F.struct(*keys))
    chosen = chosen.withColumn("asks", asks)
    for level, prefix in enumerate(prefixes):
        chosen = chosen.withColumn(f"serves_{level}", F.max(F.col("choice") == level).over(prefix))

    served = F.array_compact(F.array(*[F.when(F.col(f"serves_{i}"), i) for i in range(depth)]))
    level = F.col("level")
    masks = [
        (F.when(level < depth - i, F.col(k)) if i else F.col(k)).alias(f"group_{k}")
        for i, k in enumerate(keys)
    ]
    group_keys = ["level"] + [f"group_{k}" for k in keys]
    samples = chosen.select(*keys, value, "n", "choice", "asks", F.explode(served).alias("level")).select(
        "level", *masks, value, "n", F.when(level == F.col("choice"), F.col("asks")).alias("asks")
    )
    groups = percentiles_of_counts(samples, group_keys, value, carry="asks")
    answered = groups.select("percentiles", "sample_size", "level", F.explode("asks").alias("key"))
    return answered.select(*[f"key.{k}" for k in keys], "percentiles", "sample_size", "level")


def lookup_percentiles(
    requests: DataFrame, distributions: DataFrame, rate: float = FALLBACK_RATE
) -> DataFrame:
    """Requests with their percentiles; exponential ones and sample size -1 where the model has none."""
    keys = list(GROUP_COLUMNS)
    model = distributions.select(
        *keys, F.col("percentiles").cast("array<double>").alias("percentiles"), "sample_size"
    )
    found = requests.join(model, keys, "left")
    return found.withColumns(
        {
            "percentiles": F.coalesce("percentiles", exponential_percentiles(rate)),
            "sample_size": F.coalesce("sample_size", F.lit(-1).cast("long")),
        }
    )
