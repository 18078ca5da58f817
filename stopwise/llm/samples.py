"""Labelled rows for training: the held-out third, and samples of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the documents that no model may learn from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded_sample(rows: DataFrame, label: str, per_label: int, seed: str) -> DataFrame:
    """About ``per_label`` rows (all, if fewer) of each value of ``label``: those with the smallest hashes of doc_id.

    Rows without a label or doc_id are left out. The expected size is the bound; one value of the label
    takes a side table of one row, so labels are assumed to be few. Reruns give the same rows.
    """
    rows = rows.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    share = rows.groupBy(F.col(label).alias("_label")).agg((F.lit(float(per_label)) / F.count(F.lit(1))).alias("_share"))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.join(F.broadcast(share), rows[label] == F.col("_label")).filter(draw < F.col("_share"))
    return chosen.drop("_label", "_share")


def labelled_texts(documents: DataFrame, labels: DataFrame, label: str, per_label: int, seed: str) -> DataFrame:
    """Texts and the 0/1 ``label`` of a bounded sample of the labelled documents that aren't held out.

    A document with contradicting labels counts with the largest one. The sample's ids are bounded by
    ``per_label``, so they are broadcast to the documents instead of shuffling texts.
    """
    given = labels.filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = bounded_sample(given.filter(~held_out()), "label", per_label, seed)
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
