"""Registered queries of the package against their SQL, and the pipeline against its operators."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stopwise.llm import decontamination, language, mixing, near_duplicates, registered, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def rounded(row):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("name", sorted(registered.check_sql()))
def test_query(spark, database, name):
    cursor = database.execute(registered.check_sql()[name])
    columns = [c[0] for c in cursor.description]
    result = entry.queries()[name](spark, FOLDER)
    assert sorted(result.columns) == sorted(columns)
    mine = sorted((rounded(r) for r in result.select(*columns).collect()), key=repr)
    assert mine == sorted((rounded(r) for r in cursor.fetchall()), key=repr)


def test_all_operators_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in registered.queries()}
    assert numbers == set(range(1, 14))
    assert "pipeline" in entry.queries() and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near duplicates", "decontamination", "mixing"]


def test_pipeline(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = documents.selectExpr("*", "doc_id AS tox_score", "text AS `lang.score`")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    def applied(name, docs):
        result = stages[name](spark, docs, FOLDER)
        assert result.columns == docs.columns
        kept = result.collect()
        assert all(rows[r.doc_id] == r for r in kept)
        return spark.createDataFrame(kept, docs.schema), {r.doc_id for r in kept}, {r.doc_id for r in docs.collect()}

    model = toxicity.fit(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score_toxicity(documents, model).filter("tox_score >= 0.7").collect()}
    docs, kept, before = applied("toxicity", docs)
    assert kept == before - toxic
    docs, kept, before = applied("language", docs)
    known = language.identify_languages(docs, language.fit(docs)).filter("lang_pred != 'und' AND lang_score >= 0.4")
    assert kept == {r.doc_id for r in known.collect()}
    docs, kept, before = applied("near duplicates", docs)
    assert len(kept) < len(before)
    assert near_duplicates.near_duplicates(docs).filter("doc_id != component_id").count() == 0
    docs, kept, before = applied("decontamination", docs)
    leaks = decontamination.find_benchmark_items(documents, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    assert before - kept == {r.doc_id for r in leaks.collect()} & before and kept < before
    mixed = stages["mixing"](spark, docs, FOLDER).collect()
    assert sorted(map(rounded, mixed)) == sorted(map(rounded, mixing.documents_of_mix(mixing.mix_sources(docs)).collect()))
    assert {r.doc_id for r in mixed} == kept
    assert sorted(map(rounded, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(rounded, mixed))


def test_one_of_repeated_rows_stays(spark):
    rows = [(1, "a b c d e f g h", "en", "s", 1), (1, "a b c d e f g h", "en", "s", 1), (2, "a b c d e f g h", "en", "s", 1), (None, "a b c d e f g h", "en", "s", 1), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [1, 3]
