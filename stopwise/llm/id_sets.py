"""Rows of large tables chosen by a set of ids, without a shuffle of the rows that a table of bits can tell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the table, at most 8 MB, in rows of ``ROW_BITS``.
ID_BITS = 1 << 26
ROW_BITS = 1 << 15


def _placed(key: str) -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(ID_BITS))
    return F.floor(place / ROW_BITS).alias("_bits_row"), F.pmod(place, F.lit(ROW_BITS)).alias("_place")


def _marked(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_listed``, false only where ``key`` is not among ``ids``.

    The bits of hashed ids are bounded by ``ID_BITS`` however many there are. Ids far beyond that number would fill
    the table, and all rows would be marked; it never decides.
    """
    bits = ids.select(*_placed(key)).groupBy("_bits_row").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    held = rows.select("*", *_placed(key)).join(F.broadcast(bits), "_bits_row", "left")
    byte = "cast(conv(hex(substring(_bits, cast(_place DIV 8 AS int) + 1, 1)), 16, 10) AS int)"
    listed = F.coalesce(F.expr(f"shiftright({byte}, cast(_place % 8 AS int)) & 1 = 1"), F.lit(False))
    return held.withColumn("_listed", listed).drop("_bits_row", "_place", "_bits")


def rows_among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is among ``ids`` (``key``)."""
    return _marked(rows, ids, key).filter("_listed").drop("_listed").join(ids, key, "left_semi")


def rows_without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is not among ``ids`` (``key``), or null."""
    marked = _marked(rows, ids, key)
    doubtful = marked.filter("_listed").join(ids, key, "left_anti")
    return marked.filter("NOT _listed").unionByName(doubtful).drop("_listed")
