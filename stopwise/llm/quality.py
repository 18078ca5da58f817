"""Text quality by compression with dictionaries of good and of bad text.

Two Zstandard dictionaries are built from chunks of labelled texts. Every chunk of a text is compressed with each; the
difference of the two sizes, divided by the chunk's own size, says which kind of text it resembles:
negative for good text. Dividing by the size of the chunk rather than of the compressed chunks leaves text that any compressor shrinks to
nothing near zero, where good text never is. A text's chunks count by their sizes; the mean and the worst chunk's difference are calibrated by
logistic regression on labelled texts that the dictionaries don't hold.

Defined results: null and empty texts have differences of 0 and the score that the calibration gives to these. Without
labelled texts of both classes every score is 0.5. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.samples import held_out, labelled_texts
from stopwise.llm.words import add_columns, slices
from stopwise.sources.workspace import Workspace

#: Labelled rows of each class that training reads, at most (in expectation); chunks of each text for the dictionaries, evenly spaced.
ROWS_PER_CLASS = 4000
CHUNKS_PER_TEXT = 4
CHUNK_BYTES = 2048
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
#: Share of the training rows that the dictionaries are built from; the others calibrate.
FOR_DICTIONARIES = 0.5

FIELDS = T.StructType([T.StructField("quality_score", T.DoubleType()), T.StructField("size_difference", T.DoubleType())])


class QualityModel(NamedTuple):
    good: bytes
    bad: bytes
    weights: np.ndarray  # of the differences' mean, of the worst, and of 1


def chunks(text: bytes) -> list[bytes]:
    """The whole text in chunks of about CHUNK_BYTES, all of like size."""
    number = max(1, round(len(text) / CHUNK_BYTES))
    cuts = np.linspace(0, len(text), number + 1).astype(int).tolist()
    return [text[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class _Compressors:
    def __init__(self, good: bytes, bad: bytes) -> None:
        packs = [zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_AUTO) for d in (good, bad)]
        for p in packs:
            p.precompute_compress(level=LEVEL)
        self.both = [zstandard.ZstdCompressor(dict_data=p, write_content_size=False, write_checksum=False, write_dict_id=False) for p in packs]

    def differences(self, text: bytes) -> tuple[float, float]:
        """Mean and largest difference of the text's chunks: (good - bad) / size."""
        if not text:
            return 0.0, 0.0
        sizes, saved = [], []
        for chunk in chunks(text):
            good, bad = (len(c.compress(chunk)) for c in self.both)
            sizes.append(len(chunk))
            saved.append(good - bad)
        return sum(saved) / sum(sizes), max(s / n for s, n in zip(saved, sizes, strict=True))


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; a small sample, which training refuses, is used as it is."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _training_chunks(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                labels, found = [], []
                for label, text in zip(part.column(0).to_pylist(), pc.cast(part.column(1), pa.binary()).to_pylist(), strict=True):
                    every = chunks(text or b"")
                    for k in sorted({int(x) for x in np.linspace(0, len(every) - 1, CHUNKS_PER_TEXT)}):
                        if every[k]:
                            labels.append(label)
                            found.append(every[k])
                yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(found, pa.binary())], names=["label", "chunk"])

    return texts.select("label", "text").mapInArrow(run, "label int, chunk binary")


def _calibrated(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's method, slightly damped so that separable rows end."""
    design = np.column_stack([rows, np.ones(len(rows))])
    at = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -40, 40)))
        gradient = design.T @ (weight * (p - labels)) + 1e-3 * at
        curvature = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(len(at))
        step = np.linalg.solve(curvature, gradient)
        at -= step * min(1.0, 20 / max(abs(step).max(), 1e-12))
        if abs(step).max() < 1e-7:
            break
    return at


def fit(documents: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> QualityModel | None:
    """Model of ``labels.quality`` from the labelled documents that aren't held out; None without both classes."""
    work = Workspace(documents.sparkSession)
    half = F.pmod(F.xxhash64(F.lit("dictionary"), "doc_id"), F.lit(1 << 20)) < int(FOR_DICTIONARIES * (1 << 20))
    rows = labelled_texts(documents, labels, "quality", rows_per_class, "quality").withColumn("for_dictionary", half)
    labelled, _ = work.write("labelled", rows)
    samples = _training_chunks(labelled.filter("for_dictionary")).toArrow().to_pandas()
    texts = {y: sorted(samples.chunk[samples.label == y]) for y in (0, 1)}
    if not texts[0] or not texts[1]:
        work.drop()
        return None
    order = np.random.default_rng(5)
    shuffled = {y: [t[k] for k in order.permutation(len(t))] for y, t in texts.items()}
    good, bad = _dictionary(shuffled[1]), _dictionary(shuffled[0])
    found = _differences(labelled.filter("NOT for_dictionary").select("label", "text"), good, bad)
    if found.label.nunique() < 2:
        found = _differences(labelled.select("label", "text"), good, bad)
    work.drop()
    share = labels.filter(F.col("quality").isin(0, 1) & ~held_out()).groupBy("quality").count().toArrow().to_pandas().set_index("quality")["count"]
    weight = found.label.map(share / found.groupby("label").size()).to_numpy()
    weights = _calibrated(100 * found[["mean", "worst"]].to_numpy(), found.label.to_numpy(float), weight / weight.mean())
    return QualityModel(good, bad, weights)


def _differences(texts: DataFrame, good: bytes, bad: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _Compressors(good, bad)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [both.differences(t or b"") for t in pc.cast(part.column(1), pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([f[k] for f in found], pa.float64()) for k in (0, 1))], names=["label", "mean", "worst"])

    return texts.mapInArrow(run, "label int, mean double, worst double").toArrow().to_pandas()


def score_quality(documents: DataFrame, model: QualityModel | None) -> DataFrame:
    """``documents`` with ``quality_score`` (0 to 1, higher is better) and the mean ``size_difference``."""
    shared = documents.sparkSession.sparkContext.broadcast(model and tuple(model))

    def make():
        model = shared.value and QualityModel(*shared.value)
        both = model and _Compressors(model.good, model.bad)

        def compute(texts: pa.Array) -> list[pa.Array]:
            if not model:
                return [pa.array(np.full(len(texts), 0.5)), pa.array(np.zeros(len(texts)))]
            found = np.array([both.differences(t or b"") for t in pc.cast(texts, pa.binary()).to_pylist()]).reshape(-1, 2)
            logit = 100 * found @ model.weights[:2] + model.weights[2]
            return [pa.array(1 / (1 + np.exp(-np.clip(logit, -40, 40)))), pa.array(found[:, 0])]

        return compute

    return add_columns(documents, "text", FIELDS, make)
