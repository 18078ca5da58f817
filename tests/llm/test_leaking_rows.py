"""Rows of the decontamination stage with no doc_id or a shared one."""

from pyspark.sql import functions as F

import corpus_pipeline


def test_rows_are_dropped_by_their_own_text(spark, tmp_path):
    item = " ".join(f"item{k}" for k in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = " ".join(f"clean{k}" for k in range(30))
    rows = [(None, f"{clean} {item}"), (7, f"{item} {clean}"), (7, clean), (None, clean)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_benchmark_leaks(spark, documents, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, clean), (7, clean)]


def test_near_duplicates_are_dropped_by_row(spark):
    same, other = "a b c d e f g", "h i j k l m n"
    rows = [(4, same), (2, same), (2, other), (None, same), (None, other), (7, None), (7, None), (8, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "_row": F.lit(1)})
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(2, same), (2, other), (7, None), (7, None), (8, " ")], key=str)
