"""How well delay distributions carry over from one period to another."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopwise.config import EXACT_SAMPLES, GROUP_COLUMNS, MIN_SAMPLES, VALUE_COLUMN
from stopwise.functions import probability
from stopwise.functions.probability import error_bounds, exact_two_sample, kolmogorov_p_value

# The exact test runs on the executors, which need no copy of the library.
cloudpickle.register_pickle_by_value(probability)


def split_by_date(history: DataFrame, first_validation_day) -> tuple[DataFrame, DataFrame]:
    """Training rows before the day and validation rows from it on."""
    day, split = F.col("operating_day"), F.lit(first_validation_day)
    return history.filter(day < split), history.filter(day >= split)


def sample_groups(groups: DataFrame, keys: Sequence[str], count: int, seed: int) -> DataFrame:
    """``count`` groups chosen by a seeded hash of their key: the same ones whatever the partitioning."""
    draw = F.xxhash64(F.lit(seed), *keys)
    return groups.orderBy(draw, *keys).limit(count)


def ks_by_group(
    train: DataFrame,
    validation: DataFrame,
    keys: Sequence[str] = GROUP_COLUMNS,
    value: str = VALUE_COLUMN,
    min_samples: int = MIN_SAMPLES,
    exact_up_to: int = EXACT_SAMPLES,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and p-value of every group large enough in both samples.

    The p-value is exact where both samples have ``exact_up_to`` values at most, asymptotic otherwise.
    """
    keys = list(keys)
    both = train.select(*keys, value, F.lit(1).alias("t"), F.lit(0).alias("v")).unionByName(
        validation.select(*keys, value, F.lit(0).alias("t"), F.lit(1).alias("v"))
    )
    counts = both.groupBy(*keys, value).agg(F.sum("t").alias("t"), F.sum("v").alias("v"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    steps = counts.select(
        *keys,
        F.sum("t").over(upto).alias("t_upto"),
        F.sum("v").over(upto).alias("v_upto"),
        F.sum("t").over(group).alias("n_train"),
        F.sum("v").over(group).alias("n_validation"),
    ).filter((F.col("n_train") >= min_samples) & (F.col("n_validation") >= min_samples))
    gap = F.abs(F.col("t_upto") / F.col("n_train") - F.col("v_upto") / F.col("n_validation"))
    # Of whole numbers, as the exact test asks whether a path reaches the very same gap.
    whole = F.abs(F.col("t_upto") * F.col("n_validation") - F.col("v_upto") * F.col("n_train"))
    tests = steps.groupBy(*keys, "n_train", "n_validation").agg(F.max(gap).alias("statistic"), F.max(whole).alias("_gap"))
    p_value = kolmogorov_p_value(F.col("statistic"), F.col("n_train"), F.col("n_validation"))
    small = F.greatest("n_train", "n_validation") <= exact_up_to
    exact = _exact_p_value(F.when(small, F.col("n_train")), F.col("n_validation"), F.col("_gap"))
    return tests.withColumn("p_value", F.coalesce(exact, p_value)).drop("_gap")


def _exact_p_value(n_train: Column, n_validation: Column, gap: Column) -> Column:
    """The exact p-value, a row per group; null where ``n_train`` is."""
    compute = exact_two_sample

    @F.pandas_udf("double")
    def of_groups(n1: pd.Series, n2: pd.Series, gap: pd.Series) -> pd.Series:
        known: dict[tuple, float] = {}
        found = []
        for key in zip(n1, n2, gap, strict=True):
            if key[0] != key[0] or key[0] is None:
                found.append(None)
                continue
            key = tuple(map(int, key))
            if key not in known:
                known[key] = compute(*key)
            found.append(known[key])
        return pd.Series(found, dtype="float64")

    return of_groups(n_train, n_validation, gap)


def drift_summary(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Number of tests, share below ``alpha`` and mean statistic."""
    return tests.agg(
        F.count(F.lit(1)).alias("tests"),
        F.avg((F.col("p_value") < alpha).cast("double")).alias("share_rejected"),
        F.avg("statistic").alias("mean_statistic"),
    )


def value_histogram(data: DataFrame, column: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of a value in 0..1 in equal bins; 1 falls in the last one."""
    bucket = F.least(F.floor(F.col(column) * bins).cast("int"), F.lit(bins - 1))
    return data.groupBy(*keys, bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def cdf_calibration(
    distributions: DataFrame,
    validation: DataFrame,
    keys: Sequence[str] = GROUP_COLUMNS,
    value: str = VALUE_COLUMN,
) -> DataFrame:
    """Per group and percentile: trained probability and share of validation values at or below it.

    Percentiles and validation counts are merged by value and summed once along the group; groups hold
    101 percentiles and one row per distinct value.
    """
    keys = list(keys)
    points = distributions.select(*keys, F.posexplode("percentiles").alias("percentile", "at")).select(
        *keys, "at", F.col("percentile"), F.lit(0).cast("long").alias("n")
    )
    observed = validation.groupBy(*keys, F.col(value).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    merged = points.unionByName(observed.withColumn("percentile", F.lit(None).cast("int")))
    group = Window.partitionBy(*keys)
    along = group.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = merged.select(
        *keys, "percentile", F.sum("n").over(along).alias("below"), F.sum("n").over(group).alias("total")
    )
    share = F.when(F.col("total") > 0, F.col("below") / F.col("total")).otherwise(0.0)
    return summed.filter(F.col("percentile").isNotNull()).select(
        *keys,
        "percentile",
        (F.col("percentile") / 100).alias("train_probability"),
        share.alias("validation_probability"),
    )


def probabilities_by_split(calibration: DataFrame, bins: int = 20) -> DataFrame:
    """Histogram of trained and validation probabilities."""
    stacked = calibration.select(
        F.inline(
            F.array(
                F.struct(F.lit("train").alias("split"), F.col("train_probability").alias("probability")),
                F.struct(F.lit("val").alias("split"), F.col("validation_probability").alias("probability")),
            )
        )
    )
    return value_histogram(stacked, "probability", bins, ["split"])


def confidence_error_curve(
    probabilities: DataFrame, probability: str, error: float, transfers: int = 5
) -> DataFrame:
    """Confidence and its bounds for 1 to ``transfers`` transfers of equal probability."""
    lengths = F.explode(F.sequence(F.lit(1), F.lit(transfers)))
    listed = probabilities.select("*", lengths.alias("transfers"))
    bounds = error_bounds(F.col(probability), F.lit(error), F.col("transfers"))
    return listed.withColumn("bounds", bounds).select("*", "bounds.*").drop("bounds")
