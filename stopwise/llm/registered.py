"""One query per operator of this package, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import check_sql as sql
from stopwise.llm import alignment, decontamination, language, licenses, mixing, near_duplicates, nearest, packing, quality, quotations, toxicity, warc, whitening
from stopwise.llm.samples import held_out

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_words(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    labelled = language.identify_languages(documents.select("doc_id", "text"), language.fit(documents))
    spans = F.size("lang_spans").alias("n_spans")
    return labelled.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), spans)


def op2_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    scored = quality.score_quality(documents.select("doc_id", "text"), quality.fit(documents, _table(spark, folder, "labels")))
    predicted = (F.col("quality_score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), predicted)


def op3_toxic_passages(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    model = toxicity.fit(documents, _table(spark, folder, "labels"))
    scored = toxicity.score_toxicity(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("tox_score").alias("score"),
        (F.col("tox_score") >= toxicity.TOXIC).cast("int").alias("predicted"),
        F.size("tox_passages").alias("n_passages"),
    )


def op4_latent_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_benchmark_items(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    return quotations.link_quotations(_table(spark, folder, "conversations"), parts=True)


def op6_bottom_k_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates.near_duplicates(_table(spark, folder, "documents"), size=4)
    kept = F.col("doc_id") == F.col("component_id")
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(kept, F.lit(True)).alias("kept"))


def op7_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.write_archive(_table(spark, folder, "pages"))
    return warc.read_archive(archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_license_windows(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(_table(spark, folder, "documents"), licenses.notices(spark))


def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.documents_of_mix(mixing.mix_sources(_table(spark, folder, "documents")))


def op10_multi_index_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest_neighbours(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_galloping_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment_statistics(_table(spark, folder, "documents"))


def op12_tournament_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents")).drop("ids")


def op13_jacobi_davidson_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_language_words": op1_language_words,
        "op2_compression_quality": op2_compression_quality,
        "op3_toxic_passages": op3_toxic_passages,
        "op4_latent_leaks": op4_latent_leaks,
        "op5_quotation_links": op5_quotation_links,
        "op6_bottom_k_duplicates": op6_bottom_k_duplicates,
        "op7_warc_bundles": op7_warc_bundles,
        "op8_license_windows": op8_license_windows,
        "op9_mix_sources": op9_mix_sources,
        "op10_multi_index_neighbours": op10_multi_index_neighbours,
        "op11_galloping_alignment": op11_galloping_alignment,
        "op12_tournament_packing": op12_tournament_packing,
        "op13_jacobi_davidson_whitening": op13_jacobi_davidson_whitening,
    }


def check_sql() -> dict[str, str]:
    """SQL for the queries that it can express; the others are tested against plain versions of them."""
    return {
        "op6_bottom_k_duplicates": sql.NEAR_DUPLICATES,
        "op7_warc_bundles": sql.WARC,
        "op8_license_windows": sql.LICENSES,
        "op9_mix_sources": sql.MIX,
    }
