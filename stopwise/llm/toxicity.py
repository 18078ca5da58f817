"""Toxic passages by maximum-scoring segments over token log-odds.

Training counts the labelled texts of each class that have a word, hashed into a table of fixed size, and turns
the counts into log-odds with a Dirichlet prior. A word scores its log-odds less ``MARGIN`` standard
deviations, so that only words with evidence score above zero, and less a drift, so that neutral text
scores below. Each text is scanned once for all its maximal scoring segments (Ruzzo and Tompa's linear-time scan).
A segment of score S in n words has the expected number K n exp(-lambda S) of such
segments in clean text (Karlin and Altschul); lambda and K come from clean labelled texts. The extreme-value
scores lambda S - log(K n) of a text's significant segments add up to its evidence, which becomes a probability by
logistic regression on the labelled texts.

Defined results: a null or empty text, or one without any scoring word, has no passage and the score of a text without
evidence, below 0.5. Without labelled rows of both classes every score is 0. Repeated rows are scored alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.samples import held_out, labelled_texts
from stopwise.llm.words import Words, add_columns, mix, slices, split_words, word_hashes
from stopwise.sources.workspace import Workspace

#: Labelled rows of each class that training reads, at most (in expectation).
ROWS_PER_CLASS = 20_000
#: Size of the table of hashed words; bounds what the driver and each task hold.
BUCKETS = 1 << 20
#: Prior count of each word in each class.
PRIOR = 0.5
#: Standard deviations taken off the log-odds of a word.
MARGIN = 2.0
#: Score of a word without evidence, so that scores sum below zero in clean text.
DRIFT = 0.1
#: Characters of a word's stems, counted beside the word so that other endings of it score too.
STEMS = (5,)
#: Expected number of chance passages in one text below which a passage is reported.
SIGNIFICANT = 0.05
#: Score from which a document counts as toxic.
TOXIC = 0.7

PASSAGE = T.StructType(
    [
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("expected", T.DoubleType()),
        T.StructField("text", T.StringType()),
    ]
)
FIELDS = T.StructType([T.StructField("tox_score", T.DoubleType()), T.StructField("tox_passages", T.ArrayType(PASSAGE))])

PASSAGES = pa.list_(
    pa.struct(
        [
            ("first_word", pa.int64()),
            ("last_word", pa.int64()),
            ("score", pa.float64()),
            ("expected", pa.float64()),
            ("text", pa.string()),
        ]
    )
)


class ToxicityModel(NamedTuple):
    scores: np.ndarray  # by bucket
    rate: float  # lambda
    log_scale: float  # log K
    slope: float
    intercept: float

    def evidence(self, scores: list[float], n: int) -> float:
        """Normalised scores of the largest and of every other significant segment of ``n`` words, added up."""
        if not len(scores):
            return 0.0
        excess = self.rate * np.array(scores) - self.log_scale - math.log(n)
        return float(excess[excess >= -math.log(SIGNIFICANT)].sum() or excess.max())

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.intercept, -40, 40)))


def _buckets(vocabulary: list[str]) -> list[np.ndarray]:
    """Bucket of each word, and of each of its stems."""
    hashed = [word_hashes(vocabulary), *(word_hashes([w[:n] for w in vocabulary], seed=n) for n in STEMS)]
    return [(mix(h) % np.uint64(BUCKETS)).astype(np.int64) for h in hashed]


def _segments(at: np.ndarray, score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, as (first word, last word, score).

    ``at`` has the places of the words above zero, ``score`` theirs; every other word scores -DRIFT.
    """
    found: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum through
    total, end = 0.0, 0
    for place, value in zip(at.tolist(), score.tolist(), strict=True):
        before = total - DRIFT * (place - end)
        total, end = before + value, place + 1
        first, last, left, right = place, place, before, total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
        found.append((first, last, left, right))
    return [(a, b, r - l) for a, b, l, r in found]


def _word_scores(words: Words, table: np.ndarray) -> np.ndarray:
    """Score of each distinct word: the largest of its own and of its stems'."""
    return np.maximum.reduce([table[b] for b in _buckets(words.vocabulary)])


def _rows_with_scores(words: Words, by_word: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows that have words above zero: row, places in the row, scores."""
    above = np.flatnonzero((by_word > 0)[words.codes])
    cuts = np.searchsorted(above, words.offsets)
    for row in np.flatnonzero(np.diff(cuts)).tolist():
        at = above[cuts[row] : cuts[row + 1]]
        yield row, at - words.offsets[row], by_word[words.codes[at]]


def _rows_with_buckets(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each row and bucket of its words once; then the same for the stems."""
    seen = np.unique(words.row_of_word() * len(words.vocabulary) + words.codes)
    row, code = np.divmod(seen, max(len(words.vocabulary), 1))
    for bucket in _buckets(words.vocabulary):
        yield np.divmod(np.unique(row * BUCKETS + bucket[code]), BUCKETS)


def _counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Clean and toxic texts that have a word or a stem in the bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                label = part.column(1).to_numpy()
                for row, bucket in _rows_with_buckets(split_words(part.column(0))):
                    for y in (0, 1):
                        totals[y] += np.bincount(bucket[label[row] == y], minlength=BUCKETS)
        used = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[0, used]), pa.array(totals[1, used])], names=["bucket", "clean", "toxic"])

    rows = (
        labelled.select("text", "label")
        .mapInArrow(count, "bucket long, clean long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toArrow().to_pandas()
    )
    counts = np.zeros((2, BUCKETS))
    counts[0, rows.bucket], counts[1, rows.bucket] = rows.clean, rows.toxic
    return counts[0], counts[1]


def _log_odds(clean: np.ndarray, toxic: np.ndarray, all_clean: float, all_toxic: float) -> np.ndarray:
    """Log-odds with the Dirichlet prior, less MARGIN standard deviations, less the drift."""
    prior = PRIOR * BUCKETS
    a, b = toxic + PRIOR, clean + PRIOR
    odds = np.log(a / np.maximum(all_toxic + prior - a, PRIOR)) - np.log(b / np.maximum(all_clean + prior - b, PRIOR))
    return odds - MARGIN * np.sqrt(1 / a + 1 / b) - DRIFT


def _left_out_segments(labelled: DataFrame, clean: np.ndarray, toxic: np.ndarray) -> pd.DataFrame:
    """Label, length and segment scores of each labelled text.

    Each text is scored with its own words taken out of the counts, as new texts are.
    """
    sums = (float(clean.sum()), float(toxic.sum()))
    shared = labelled.sparkSession.sparkContext.broadcast((clean, toxic))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean, toxic = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column(0))
                buckets = _buckets(words.vocabulary)
                labels = part.column(1).to_numpy()
                lengths = np.diff(words.offsets)
                segments = []
                for row in range(len(labels)):
                    in_row = words.codes[words.offsets[row] : words.offsets[row + 1]]
                    codes = np.unique(in_row)
                    by_word = np.full(len(codes), -np.inf)
                    for bucket in (b[codes] for b in buckets):
                        counts = [clean[bucket], toxic[bucket]]
                        counts[labels[row]] = counts[labels[row]] - 1
                        by_word = np.maximum(by_word, _log_odds(*counts, *sums))
                    local = np.searchsorted(codes, in_row)
                    at = np.flatnonzero(by_word[local] > 0)
                    segments.append([s for _, _, s in _segments(at, by_word[local[at]])])
                columns = [part.column(1), pa.array(lengths), pa.array(segments, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "n", "segments"])

    return labelled.select("text", "label").mapInArrow(score, "label int, n long, segments array<double>").toArrow().to_pandas()


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method, with a little weight decay so that separable data end."""
    at = np.zeros(2)
    design = np.column_stack([x, np.ones(len(x))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -40, 40)))
        gradient = design.T @ (weight * (p - y)) + 0.1 * at
        curvature = (design * (weight * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        at -= np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def fit(documents: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> ToxicityModel | None:
    """Model of ``labels.toxic`` from the labelled documents that aren't held out; None without both classes."""
    work = Workspace(documents.sparkSession)
    labelled, _ = work.write("labelled", labelled_texts(documents, labels, "toxic", rows_per_class, "toxicity"))
    clean, toxic = _counts(labelled)
    if not clean.any() or not toxic.any():
        work.drop()
        return None
    rows = _left_out_segments(labelled, clean, toxic)
    work.drop()
    table = _log_odds(clean, toxic, clean.sum(), toxic.sum())
    null = rows[rows.label == 0]
    # The largest scores of clean texts: lambda from those above zero, whose excess is exponential.
    largest = null.segments.map(lambda s: max(s, default=0.0)).to_numpy(float)
    rate = float(np.clip(((largest > 0).sum() + 1) / (largest.sum() + 1), 0.1, 1.0))
    log_scale = math.log(((largest > 0).sum() + 0.5) / (null.n.sum() + 1))
    model = ToxicityModel(table.astype(np.float32), rate, log_scale, 1.0, 0.0)
    evidence = np.array([model.evidence(s, n) for s, n in zip(rows.segments, rows.n, strict=True)])
    # Halfway between the labels' shares and equal classes: a missed toxic text costs more than its rarity says.
    share = labels.filter(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("toxic").count().toArrow().to_pandas().set_index("toxic")["count"]
    weight = rows.label.map(share**0.5 / rows.groupby("label").size()).to_numpy()
    weight = weight / weight.mean()
    slope, intercept = _logistic(evidence, rows.label.to_numpy(float), weight)
    return model._replace(slope=slope, intercept=intercept)


def score_toxicity(documents: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``documents`` with ``tox_score`` (0 to 1) and ``tox_passages``, the significant passages of the whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(model and tuple(model))

    def make():
        model = shared.value and ToxicityModel(*shared.value)

        def compute(texts: pa.Array) -> list[pa.Array]:
            if model is None:
                return [pa.array(np.zeros(len(texts))), pa.array([[]] * len(texts), PASSAGES)]
            words = split_words(texts)
            by_word = _word_scores(words, model.scores)
            lengths = np.diff(words.offsets)
            evidence = np.zeros(len(texts))
            passages: list[list[dict]] = [[] for _ in range(len(texts))]
            for row, at, score in _rows_with_scores(words, by_word):
                segments = _segments(at, score)
                log_n = math.log(lengths[row])
                evidence[row] = model.evidence([s for _, _, s in segments], lengths[row])
                for first, last, s in segments:
                    expected = math.exp(min(model.log_scale + log_n - model.rate * s, 700))
                    if expected <= SIGNIFICANT:
                        codes = words.codes[words.offsets[row] + first : words.offsets[row] + last + 1]
                        text = " ".join(words.vocabulary[c] for c in codes)
                        passages[row].append({"first_word": first, "last_word": last, "score": s, "expected": expected, "text": text})
            return [pa.array(model.probability(evidence)), pa.array(passages, PASSAGES)]

        return compute

    return add_columns(documents, "text", FIELDS, make)
