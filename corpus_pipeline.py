"""Corpus preparation: each stage works on all documents that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import decontamination, language, mixing, near_duplicates, toxicity
from stopwise.llm.id_sets import rows_without
from stopwise.sources.workspace import Workspace

#: Columns of documents that the operators read.
KNOWN = ("doc_id", "text", "lang", "source")
#: Mean probability of the words' best language below which a text counts as being in none.
LEAST_LANGUAGE = 0.4


def _unclashing(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its other columns under names that no operator uses, and what gives the names back."""
    names = {c: c if c in KNOWN else f"_kept_{k}" for k, c in enumerate(docs.columns)}
    renamed = docs.toDF(*names.values())
    return renamed, lambda found: found.select(*names.values()).toDF(*names)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the limit."""
    renamed, restored = _unclashing(docs)
    model = toxicity.fit(renamed, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return restored(toxicity.score_toxicity(renamed, model).filter(F.col("tox_score") < toxicity.TOXIC))


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows."""
    renamed, restored = _unclashing(docs)
    found = language.identify_languages(renamed, language.fit(renamed))
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE)
    return restored(found.filter(known))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, the one with the smallest doc_id, rows without one last; each row is judged by its own text.

    Rows that share a doc_id are different documents unless their texts are alike; rows without words all stay.
    """
    renamed, restored = _unclashing(docs)
    work = Workspace(spark)
    keyed, _ = work.write("keyed", renamed.withColumn("_row", F.monotonically_increasing_id()))
    own = Workspace(spark)
    found = near_duplicates.near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text"), work=own)
    placed = found.select(F.col("doc_id").alias("_row"), "component_id").join(keyed.select("_row", "doc_id"), "_row")
    placed, _ = own.write("placed", placed)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")).alias("first")
    kept, _ = own.write("kept", placed.groupBy("component_id").agg(first).select("first._row"))
    dropped, _ = work.write("dropped", placed.select("_row").join(kept, "_row", "left_anti"))
    own.drop()
    return restored(rows_without(keyed, dropped, "_row"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item is found, each judged by its own text, whatever its doc_id."""
    renamed, restored = _unclashing(docs)
    work = Workspace(spark)
    keyed, _ = work.write("keyed", renamed.withColumn("_row", F.monotonically_increasing_id()))
    leaks = decontamination.find_benchmark_items(keyed.select(F.col("_row").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaking, _ = work.write("leaking", leaks.select(F.col("doc_id").alias("_row")).distinct())
    return restored(rows_without(keyed, leaking, "_row"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix to the target weights takes of each document."""
    return mixing.documents_of_mix(mixing.mix_sources(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_languages),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix),
]

#: No SQL states the learned stages; tests hold the stages against plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs, _ = work.write(f"stage-{number}", stage(spark, docs, sf_dir))
    return docs
