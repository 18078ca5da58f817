"""Reading and writing of schedule, arrival, weather and model tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.sources import schemas


@dataclass(frozen=True)
class ScheduleTables:
    """The schedule snapshot tables, each a DataFrame with a ``pub_date`` column."""

    stops: DataFrame
    calendar: DataFrame
    trips: DataFrame
    routes: DataFrame
    stop_times: DataFrame
    transfers: DataFrame

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> ScheduleTables:
        """Tables of the session catalog; ``names`` maps each field to a table name."""
        return cls(**{f.name: spark.table(names[f.name]) for f in fields(cls)})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> ScheduleTables:
        """Parquet folders named after the fields under ``root``."""
        return cls(
            **{
                f.name: spark.read.schema(getattr(schemas, f.name.upper())).parquet(f"{root}/{f.name}")
                for f in fields(cls)
            }
        )


def use_namespace(spark: SparkSession, name: str) -> None:
    """Create a catalog namespace if it is missing and make it current."""
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted}")
    spark.sql(f"USE {quoted}")


def read_weather_stations(spark: SparkSession, path: str) -> DataFrame:
    """CSV list of weather stations with numeric position and boolean ``active``."""
    raw = spark.read.schema(schemas.WEATHER_STATIONS).option("header", True).csv(path)
    return weather_stations(raw)


def weather_stations(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("Name").alias("site"),
        F.col("lon").try_cast("double").alias("lon"),
        F.col("lat").try_cast("double").alias("lat"),
        F.col("Active").try_cast("boolean").alias("active"),
    )


def read_weather_documents(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """JSON weather documents with the text of what could not be read in ``malformed``, null for good rows.

    A file is one document or an array of them; with ``one_per_line`` each line is, and large files are split
    between tasks. Malformed texts have a row of their own without site and observations; blank ones have none.
    """
    document = T.StructType.fromDDL(schemas.WEATHER_HISTORY).simpleString()
    texts = spark.read.text(path, wholetext=not one_per_line).filter("trim(BOTH ' \t\r\n' FROM value) != ''")
    parsed = texts.withColumn("documents", F.from_json("value", f"array<{document}>"))
    malformed = F.when(F.col("documents").isNull(), F.col("value")).alias("malformed")
    one = F.when(F.col("documents").isNull(), F.array(F.lit(None).cast(document)))
    rows = parsed.select(malformed, F.explode(F.coalesce(one, "documents")).alias("d"))
    return rows.select("d.site", "d.observations", "malformed")


def read_weather_history(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """JSON weather documents that can be read, each a site with an array of observations."""
    return read_weather_documents(spark, path, one_per_line).filter("malformed IS NULL").drop("malformed")


def write_distributions(distributions: DataFrame, path: str) -> None:
    distributions.write.mode("overwrite").parquet(path)


def load_distributions(
    spark: SparkSession, path: str | None = None, distributions: DataFrame | None = None
) -> DataFrame:
    """Delay model from Parquet, or the given DataFrame when there is no path."""
    if path:
        return spark.read.schema(schemas.DISTRIBUTIONS).parquet(path)
    if distributions is None:
        raise ValueError("either a path or a DataFrame is needed")
    return distributions
