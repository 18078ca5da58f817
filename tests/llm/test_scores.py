"""Language, toxicity and quality: exact parts against plain versions, whole models on held-out rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopwise.llm import language, quality, toxicity
from stopwise.llm.samples import held_out

FOLDER = "/root/testdata/sf0.01"
ODD = [
    (1, None, "en", 1),
    (2, "", "en", 2),
    (3, " \t\n", None, 3),
    (4, "1234 -- 77.", "en", 4),
    (5, "word " * 30000, "en", 5),
    (6, "The same text of the two rows.", "en", 6),
    (6, "The same text of the two rows.", "en", 6),
    (None, "A text without an id.", "en", 7),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def odd(spark, name):
    """Rows with nulls, empty and long texts and repetitions, and a column named like a result."""
    return spark.createDataFrame(ODD, f"doc_id long, text string, lang string, {name} long")


def test_posteriors_agree_with_enumeration():
    draw = np.random.default_rng(1)
    edge = draw.random((3, 3)) + 0.1
    lengths = [0, 4, 1, 6, 0, 3]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    node = draw.random((offsets[-1], 3)) + 0.1
    found = language._posteriors(node, edge, offsets)
    for start, end in zip(offsets[:-1], offsets[1:], strict=True):
        expected = np.zeros((end - start, 3))
        for path in itertools.product(range(3), repeat=int(end - start)):
            weight = np.prod([node[start + t, k] for t, k in enumerate(path)]) * np.prod([edge[a, b] for a, b in itertools.pairwise(path)])
            for t, k in enumerate(path):
                expected[t, k] += weight
        if end > start:
            assert np.allclose(found[start:end], expected / expected.sum(axis=1, keepdims=True))


def test_languages(spark, documents):
    model = language.fit(documents)
    found = language.identify_languages(documents, model).filter(held_out())
    assert found.filter("lang_pred = lang").count() > 0.97 * found.count()
    mixed = "the and that with this for was are der die und nicht ein mit von den des".split()
    texts = spark.createDataFrame([(1, " ".join(mixed))], "doc_id long, text string")
    spans = language.identify_languages(texts, model).first().lang_spans
    assert spans[0].first_word == 0 and spans[-1].last_word == len(mixed) - 1
    assert all(a.last_word + 1 == b.first_word for a, b in itertools.pairwise(spans))
    rows = language.identify_languages(odd(spark, "lang_score"), model)
    assert rows.columns == ["doc_id", "text", "lang", "lang_pred", "lang_score", "lang_spans"]
    rows = rows.collect()
    assert [r.lang_pred == "und" and r.lang_score == 0 for r in rows] == [True] * 4 + [False] * 4
    assert len(rows[4].lang_spans) >= 1 and rows[5] == rows[6]
    assert language.identify_languages(documents.limit(0), model).count() == 0


def test_languages_without_labels(spark, documents):
    assert language.fit(documents.withColumn("lang", F.lit(None).cast("string"))) is None
    rows = language.identify_languages(documents.limit(3), None).collect()
    assert [(r.lang_pred, r.lang_score) for r in rows] == [("und", 0.0)] * 3
    one = language.fit(documents.filter("lang = 'de'").limit(40))
    assert {r.lang_pred for r in language.identify_languages(documents.limit(3), one).collect()} == {"de"}


def plain_segments(scores):
    """All maximal scoring segments, by cutting out the best one and going on at both sides."""

    def cut(low, high):
        best = None
        for a in range(low, high):
            total = 0.0
            for b in range(a, high):
                total += scores[b]
                if total > 1e-12 and (best is None or total > best[0] + 1e-9):
                    best = (total, a, b)
        if best is None:
            return []
        return [*cut(low, best[1]), (best[1], best[2], best[0]), *cut(best[2] + 1, high)]

    return cut(0, len(scores))


def test_segments_agree_with_the_plain_version():
    draw = random.Random(4)
    for _ in range(150):
        scores = [draw.uniform(0.05, 3) if draw.random() < 0.3 else -toxicity.DRIFT for _ in range(draw.randint(1, 40))]
        at = np.array([k for k, s in enumerate(scores) if s > 0], int)
        found = toxicity._segments(at, np.array([scores[k] for k in at]))
        expected = plain_segments(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in found], [s for *_, s in expected])


def test_toxicity(spark, documents, labels):
    model = toxicity.fit(documents, labels)
    scored = toxicity.score_toxicity(documents, model).filter(held_out()).join(labels, "doc_id")
    rows = scored.select("toxic", "tox_score", "tox_passages").collect()
    assert sum(r.tox_score >= 0.7 for r in rows if not r.toxic) <= 2
    assert sum(r.tox_score >= 0.7 for r in rows if r.toxic) >= 0.7 * sum(r.toxic for r in rows)
    assert all(0 <= r.tox_score <= 1 for r in rows)
    texts = spark.createDataFrame([(1, "calm words " * 400 + "idiot moron scum trash " + "calm words " * 400)], "doc_id long, text string")
    passage = toxicity.score_toxicity(texts, model).first().tox_passages
    assert len(passage) == 1 and passage[0].text == "idiot moron scum trash" and passage[0].first_word == 800
    rows = toxicity.score_toxicity(odd(spark, "TOX_SCORE"), model).collect()
    assert len(rows) == len(ODD) and all(r.tox_score < 0.5 for r in rows) and rows[0].tox_passages == []
    assert toxicity.score_toxicity(documents.limit(0), model).count() == 0


def test_toxicity_without_labels(spark, documents, labels):
    assert toxicity.fit(documents, labels.limit(0)) is None
    rows = toxicity.score_toxicity(documents.limit(3), None).collect()
    assert [(r.tox_score, r.tox_passages) for r in rows] == [(0.0, [])] * 3


def test_quality(spark, documents, labels):
    model = quality.fit(documents, labels)
    scored = quality.score_quality(documents, model).filter(held_out()).join(labels, "doc_id").collect()
    assert sum((r.quality_score >= 0.5) == bool(r.quality) for r in scored) > 0.95 * len(scored)
    rows = quality.score_quality(odd(spark, "quality_score"), model).collect()
    assert len(rows) == len(ODD) and rows[0].quality_score == rows[1].quality_score and rows[5] == rows[6]
    assert all(0 <= r.quality_score <= 1 for r in rows)
    assert quality.score_quality(documents.limit(0), model).count() == 0


def test_quality_without_labels(documents, labels):
    assert quality.fit(documents, labels.filter("quality = 1")) is None
    assert [r.quality_score for r in quality.score_quality(documents.limit(2), None).collect()] == [0.5, 0.5]


def test_chunks_hold_the_whole_text():
    for size in (0, 1, 2047, 2048, 3071, 3073, 100_000):
        text = bytes(k % 251 for k in range(size))
        assert b"".join(quality.chunks(text)) == text
        assert max(map(len, quality.chunks(text))) <= 1.5 * quality.CHUNK_BYTES


def test_labels_of_held_out_rows_change_nothing(spark, documents, labels):
    flipped = labels.select("doc_id", *(F.when(held_out(), 1).otherwise(F.col(c)).cast("int").alias(c) for c in ("quality", "toxic")))
    rows = documents.limit(150).cache()
    for fit, score, column in ((quality.fit, quality.score_quality, "quality_score"), (toxicity.fit, toxicity.score_toxicity, "tox_score")):
        first, second = (sorted((r.doc_id, r[column]) for r in score(rows, fit(documents, given)).collect()) for given in (labels, flipped))
        assert first == second
    other = documents.withColumn("lang", F.when(held_out(), "de").otherwise(F.col("lang")))
    first, second = (sorted((r.doc_id, r.lang_pred, r.lang_score) for r in language.identify_languages(rows, language.fit(given)).collect()) for given in (documents, other))
    assert first == second
