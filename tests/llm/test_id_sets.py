"""Rows chosen by ids, and the stages of the pipeline that drop rows by them."""

from pyspark.sql import functions as F

import corpus_pipeline
from stopwise.llm import id_sets


def _rows(spark):
    values = [*range(2000), 7, 8, None, -5]
    return spark.createDataFrame([(v, f"text {v}") for v in values], "id long, text string")


def test_rows_with_and_without_ids(spark, monkeypatch):
    rows, ids = _rows(spark), spark.createDataFrame([(7,), (1900,), (-5,), (10**12,)], "id long")
    for bits in (id_sets.ID_BITS, 8):
        monkeypatch.setattr(id_sets, "ID_BITS", bits)
        among = id_sets.rows_among(rows, ids, "id")
        assert among.columns == rows.columns
        assert sorted(r.id for r in among.collect()) == [-5, 7, 7, 1900]
        without = id_sets.rows_without(rows, ids, "id")
        assert without.columns == rows.columns
        kept = [r.id for r in without.collect()]
        assert None in kept and sorted(v for v in kept if v is not None) == sorted([*(v for v in range(2000) if v not in (7, 1900)), 8])
    none = ids.limit(0)
    assert id_sets.rows_without(rows, none, "id").count() == rows.count() and id_sets.rows_among(rows, none, "id").count() == 0


def test_rows_that_no_id_names_are_not_shuffled(spark):
    ids = spark.createDataFrame([(7,), (1900,)], "id long")
    listed = id_sets._marked(_rows(spark), ids, "id").filter("_listed").select("id").collect()
    assert {r.id for r in listed} == {7, 1900} and len(listed) == 3


def test_stages_look_up_the_few_rows_that_go(spark, tmp_path, monkeypatch):
    asked = []

    def looked_up(rows, ids, key):
        asked.append(sorted(r[0] for r in ids.join(rows, key).select("doc_id").collect()))
        return id_sets.rows_without(rows, ids, key)

    monkeypatch.setattr(corpus_pipeline, "rows_without", looked_up)
    item = " ".join(f"item{k}" for k in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = [" ".join(f"d{k}w{w}" for w in range(12)) for k in range(40)]
    rows = [*enumerate(texts), (50, texts[3]), (51, texts[5]), (52, f"{texts[7]} {item}")]
    documents = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    kept = corpus_pipeline.drop_near_duplicates(spark, documents, "")
    assert sorted(r.doc_id for r in kept.collect()) == [*range(40), 52]
    kept = corpus_pipeline.drop_benchmark_leaks(spark, documents, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [*range(40), 50, 51]
    assert asked == [[50, 51], [52]]
