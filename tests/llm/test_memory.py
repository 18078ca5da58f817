"""Memory of a task's work on texts, which must not grow with the words or the texts that it holds at once."""

import tracemalloc

import numpy as np
import pyarrow as pa

from stopwise.llm import decontamination, language
from stopwise.llm.words import slices, split_words


def _peak(work):
    tracemalloc.start()
    try:
        kept = work()
        return tracemalloc.get_traced_memory()[1], kept
    finally:
        tracemalloc.stop()


def _model(seed=3):
    draw = np.random.default_rng(seed)
    return language.LanguageModel(
        ["a", "b"], draw.normal(size=(language.BUCKETS, 2)), np.zeros(0, np.uint64), np.zeros(0, np.int64), draw.normal(size=(3, 2)), np.zeros((2, 2))
    )


def test_emissions_of_many_words_take_little_more_than_the_result():
    model, words = _model(), [f"word{k:012d}" for k in range(100_000)]
    peak, found = _peak(lambda: model.emissions(words))
    assert peak < found.nbytes + (40 << 20)


def test_emissions_do_not_depend_on_the_parts(monkeypatch):
    model, words = _model(), [f"w{k}é" * (1 + k % 3) for k in range(100)]
    whole = model.emissions(words)
    monkeypatch.setattr(language, "WORDS_AT_A_TIME", 7)
    assert np.array_equal(model.emissions(words), whole)
    assert model.emissions([]).shape == (0, 2)


class _Documents:
    """Takes the place of a table: keeps the function that its tasks would run."""

    def __init__(self):
        self.sparkSession = self.sparkContext = self

    def broadcast(self, value):
        self.value = value
        return self

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_search_holds_a_small_slice_of_the_texts_at_once(spark, monkeypatch):
    item = " ".join(f"item{k}" for k in range(40))
    words = split_words(pa.array([item]))
    weights, sketch = np.ones(decontamination.BUCKETS), np.zeros((decontamination.BUCKETS, decontamination.SKETCH))
    basis = decontamination._latent_space(sketch, words, weights)
    items = decontamination._prepared([5], words, weights, basis)
    filler = " ".join(f"w{k % 5000}" for k in range(30_000))
    texts = [f"{filler} {item} {filler}"] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(range(20), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    sizes = []
    monkeypatch.setattr(decontamination, "split_words", lambda part: sizes.append(pa.compute.sum(pa.compute.binary_length(part)).as_py()) or split_words(part))
    run = decontamination._search(_Documents(), items, weights, basis)
    found = [r for out in run(iter([batch])) for r in out.to_pylist()]
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(k, 5) for k in range(20)]
    assert len(sizes) == len(list(slices(batch, "text", 1 << 20))) and max(sizes) < (1 << 20) + len(texts[0])


def test_latent_space_takes_few_times_the_sketch():
    words = split_words(pa.array([" ".join(f"item{k}" for k in range(40))]))
    draw = np.random.default_rng(5)
    sketch = draw.integers(-9, 10, (decontamination.BUCKETS, decontamination.SKETCH)).astype(float)
    peak, basis = _peak(lambda: decontamination._latent_space(sketch, words, np.ones(decontamination.BUCKETS)))
    assert peak < 4 * sketch.nbytes
    assert np.allclose(basis.T @ basis, np.eye(decontamination.RANK), atol=1e-4)
