"""Language of each word by a linear-chain conditional random field, and of each text from its words.

A word's features are its character n-grams with its boundaries, so that those at a boundary are its
affixes, and the language whose lexicon holds it; transitions between the languages of neighbouring
words are learned. The training rows are a bounded sample of labelled texts; spans of different languages are
spliced so that the transitions see switches. Forward-backward runs over whole texts, all texts of a
batch at a time, and gives each word a probability of each language; a text's score for a language is the mean
over its words with letters.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text if nothing is
labelled. Ties go to the language that sorts first. Languages are the values of ``lang`` seen in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.samples import bounded_sample, held_out
from stopwise.llm.words import add_columns, slices, split_words, word_hashes

#: Training texts of each language, at most (in expectation), and spans of SPAN words taken from each, evenly spaced.
TEXTS_PER_LANGUAGE = 600
SPANS_PER_TEXT = 4
SPAN = 64
#: Table of hashed n-grams, and their lengths with boundaries.
BUCKETS = 1 << 17
NGRAMS = (2, 3, 4)
#: A word belongs to the lexicon of a language with this share of its training occurrences, if there are so many.
LEXICON_SHARE = 0.9
LEXICON_COUNT = 5
ITERATIONS = 60
SEQUENCES_AT_A_TIME = 1024
WORDS_AT_A_TIME = 1 << 13
UNKNOWN = "und"

SPANS = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType())]))
FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_spans", SPANS)])


class LanguageModel(NamedTuple):
    languages: list[str]
    ngrams: np.ndarray  # bucket x language
    lexicon: np.ndarray  # sorted word hashes
    lexicon_of: np.ndarray  # language of each
    lexical: np.ndarray  # lexicon's language (last: none) x language
    transitions: np.ndarray  # language x language

    def emissions(self, vocabulary: list[str]) -> np.ndarray:
        """Log-potential of each language for each word, worked off in parts of the vocabulary: a word has many n-grams."""
        found = np.empty((len(vocabulary), len(self.languages)))
        for low in range(0, len(vocabulary), WORDS_AT_A_TIME):
            part = vocabulary[low : low + WORDS_AT_A_TIME]
            word, bucket, share = _ngrams(part)
            lexicon = _lexicon_of(part, self.lexicon, self.lexicon_of, len(self.languages))
            sums = [np.bincount(word, self.ngrams[bucket, k] * share, len(part)) for k in range(len(self.languages))]
            found[low : low + len(part)] = np.column_stack(sums) + self.lexical[lexicon]
        return found


def _ngrams(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, bucket and weight of every n-gram of every word."""
    characters = np.frombuffer(("\n" + "\n".join(vocabulary) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edge = characters == 10
    word_at = np.cumsum(edge) - 1  # a boundary belongs to the word after it
    words, buckets = [], []
    with np.errstate(over="ignore"):
        hashed = characters + np.uint64(1)
        inner = np.zeros(len(characters), bool)  # a boundary strictly inside the n-gram
        for n in range(2, max(NGRAMS) + 1):
            hashed = hashed[:-1] * np.uint64(0x100000001B3) + characters[n - 1 :]
            if n > 2:
                inner = inner[:-1] | edge[n - 2 : len(characters) - 1]
            else:
                inner = np.zeros(len(hashed), bool)
            if n in NGRAMS:
                at = np.flatnonzero(~inner)
                words.append(word_at[at])
                buckets.append(((hashed[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(BUCKETS))
    word = np.concatenate(words)
    return word, np.concatenate(buckets).astype(np.int64), (1 / np.maximum(np.bincount(word, minlength=len(vocabulary)), 1))[word]


def _lexicon_of(vocabulary: list[str], lexicon: np.ndarray, lexicon_of: np.ndarray, none: int) -> np.ndarray:
    if not len(lexicon):
        return np.full(len(vocabulary), none)
    hashes = word_hashes(vocabulary)
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return np.where(lexicon[at] == hashes, lexicon_of[at], none)


def _training_spans(texts: DataFrame) -> DataFrame:
    """``lang`` and up to SPANS_PER_TEXT spans of words of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = split_words(part.column(1))
                langs, spans, places = [], [], []
                for lang, start, end in zip(part.column(0).to_pylist(), words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
                    starts = np.linspace(start, max(start, end - SPAN), min(SPANS_PER_TEXT, -(-(end - start) // SPAN))).astype(int)
                    for s in starts:
                        langs.append(lang)
                        spans.append([words.vocabulary[c] for c in words.codes[s : min(s + SPAN, end)]])
                        places.append(xxhash.xxh64_intdigest(" ".join(spans[-1])) >> 1)
                columns = [pa.array(langs, pa.string()), pa.array(spans, pa.list_(pa.string())), pa.array(places, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "place"])

    return texts.select("lang", "text").mapInArrow(run, "lang string, words array<string>, place long")


def _potentials(log: np.ndarray) -> np.ndarray:
    return np.exp(log - log.max(axis=-1, keepdims=True))


def _spliced(labels: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and labels of sequences of SPAN words spliced from pieces of the spans, of which row ``i`` has ``codes[offsets[i]:offsets[i + 1]]``."""
    draw = np.random.default_rng(7)
    pieces = []
    for label, at, end in zip(labels.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        while at < end:
            size = int(draw.integers(4, SPAN))
            pieces.append((label, at, min(at + size, end)))
            at += size
    label, start, end = np.array(pieces, np.int64)[draw.permutation(len(pieces))].T
    sizes = end - start
    flat = codes[np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
    own = np.repeat(label, sizes).astype(np.int8)
    # The last sequence is filled up from the beginning.
    places = np.arange(-(-len(flat) // SPAN) * SPAN) % len(flat)
    return flat[places].reshape(-1, SPAN), own[places].reshape(-1, SPAN)


def fit(documents: DataFrame, texts_per_language: int = TEXTS_PER_LANGUAGE) -> LanguageModel | None:
    """Model learned from ``text`` and non-null ``lang`` of the documents that aren't held out; None without any."""
    sample = bounded_sample(documents.filter(~held_out()).select("doc_id", "text", "lang"), "lang", texts_per_language, "language")
    spans = _training_spans(sample).toArrow()
    spans = spans.filter(pc.greater(pc.list_value_length(spans.column("words")), 0))
    if not spans.num_rows:
        return None
    # In an order of their own, so that no partitioning changes the model; each word once, and codes for the rest.
    spans = spans.sort_by([("lang", "ascending"), ("place", "ascending")]).combine_chunks()
    words = spans.column("words").combine_chunks()
    encoded = words.flatten().dictionary_encode()
    names = spans.column("lang").to_pylist()
    languages = sorted(set(names))
    offsets = words.offsets.to_numpy().astype(np.int64)
    codes, labels = _spliced(np.array([languages.index(x) for x in names]), offsets - offsets[0], encoded.indices.to_numpy())
    vocabulary = encoded.dictionary.to_pylist()
    del spans, words, encoded
    size = len(languages)
    counts = np.zeros((len(vocabulary), size))
    np.add.at(counts, (codes.ravel(), labels.ravel()), 1)
    total = counts.sum(axis=1)
    member = (total >= LEXICON_COUNT) & (counts.max(axis=1) >= LEXICON_SHARE * total)
    hashes = word_hashes(vocabulary)[member]
    order = np.argsort(hashes)
    model = LanguageModel(languages, np.zeros((BUCKETS, size)), hashes[order], counts[member].argmax(axis=1)[order], np.zeros((size + 1, size)), np.zeros((size, size)))
    _train(model, vocabulary, codes, labels)
    return model


def _train(model: LanguageModel, vocabulary: list[str], codes: np.ndarray, labels: np.ndarray) -> None:
    """Conditional maximum likelihood by Adam over all sequences, worked off in slices so that only the n-gram table grows with them."""
    size = len(model.languages)
    word, bucket, share = (x.astype(t) for x, t in zip(_ngrams(vocabulary), (np.int32, np.int32, np.float32), strict=True))
    lexicon = _lexicon_of(vocabulary, model.lexicon, model.lexicon_of, size)
    parts = [model.ngrams, model.lexical, model.transitions]
    momentum = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    for step in range(1, ITERATIONS + 1):
        sums = [np.bincount(word, model.ngrams[bucket, k] * share, len(vocabulary)) for k in range(size)]
        node = _potentials(np.column_stack(sums) + model.lexical[lexicon])
        edge = _potentials(model.transitions.ravel()).reshape(size, size)
        by_word, by_edge = np.zeros((len(vocabulary), size)), np.zeros((size, size))
        for at in range(0, len(codes), SEQUENCES_AT_A_TIME):
            part = slice(at, at + SEQUENCES_AT_A_TIME)
            errors, steps = _errors(node[codes[part]], edge, labels[part])
            by_edge += steps
            own = codes[part].ravel()
            for k in range(size):
                by_word[:, k] += np.bincount(own, errors[:, k], len(vocabulary))
        by_bucket = np.column_stack([np.bincount(bucket, by_word[word, k] * share, BUCKETS) for k in range(size)])
        by_lexicon = np.zeros_like(model.lexical)
        np.add.at(by_lexicon, lexicon, by_word)
        scale = codes.size
        for part, (first, second), slope in zip(parts, momentum, (by_bucket, by_lexicon, by_edge), strict=True):
            slope = slope / scale - 1e-7 * part
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            part += 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)


def _errors(node: np.ndarray, edge: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels less marginals of each word, and seen less expected steps, of sequences of SPAN words."""
    size = len(edge)
    forward, backward = np.empty_like(node), np.empty_like(node)
    forward[:, 0] = node[:, 0] / node[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, SPAN):
        at = (forward[:, t - 1] @ edge) * node[:, t]
        forward[:, t] = at / at.sum(axis=1, keepdims=True)
    backward[:, -1] = 1
    for t in range(SPAN - 2, -1, -1):
        at = (node[:, t + 1] * backward[:, t + 1]) @ edge.T
        backward[:, t] = at / at.sum(axis=1, keepdims=True)
    marginal = forward * backward
    marginal /= marginal.sum(axis=2, keepdims=True)
    right = node[:, 1:] * backward[:, 1:]
    weight = 1 / np.einsum("sti,ij,stj->st", forward[:, :-1], edge, right)
    expected = np.einsum("st,sti,stj->ij", weight, forward[:, :-1], right) * edge
    truth = np.eye(size)[labels]
    seen = np.einsum("sti,stj->ij", truth[:, :-1], truth[:, 1:])
    return (truth - marginal).reshape(-1, size), seen - expected


def _posteriors(node: np.ndarray, edge: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of each language for each word; step t of all texts with more than t words is one operation."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    longest = int(lengths.max(initial=0))
    running = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
    first = np.concatenate(([0], np.cumsum(running)))
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = first[np.arange(len(row)) - offsets[row]] + rank[row]
    ordered = np.empty_like(node)
    ordered[place] = node
    # Each array holds a number for every word and language; a task's memory is that of those held at once.
    del node, row
    forward, backward = np.empty_like(ordered), np.empty_like(ordered)
    bounds = first.tolist()
    counts = running.tolist()
    for t in range(longest):
        at = ordered[bounds[t] : bounds[t + 1]]
        if t:
            at = (forward[bounds[t - 1] : bounds[t - 1] + counts[t]] @ edge) * at
        forward[bounds[t] : bounds[t + 1]] = at / at.sum(axis=1, keepdims=True)
    for t in range(longest - 1, -1, -1):
        at = backward[bounds[t] : bounds[t + 1]]
        more = counts[t + 1] if t + 1 < longest else 0
        at[more:] = 1
        if more:
            later = slice(bounds[t + 1], bounds[t + 2])
            message = (ordered[later] * backward[later]) @ edge.T
            at[:more] = message / message.sum(axis=1, keepdims=True)
    del ordered
    forward *= backward
    del backward
    forward /= forward.sum(axis=1, keepdims=True)
    return forward[place]


def identify_languages(documents: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``documents`` with ``lang_pred``, ``lang_score``, and ``lang_spans``, the runs of words of one language."""
    shared = documents.sparkSession.sparkContext.broadcast(model and tuple(model))
    span_type = pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())])

    def make():
        model = shared.value and LanguageModel(*shared.value)
        names = pa.array([*(model.languages if model else []), UNKNOWN], pa.string())

        def compute(texts: pa.Array) -> list[pa.Array]:
            size, rows = len(names) - 1, len(texts)
            words = split_words(texts)
            if not model or not len(words.codes):
                empty = pa.ListArray.from_arrays(pa.array(np.zeros(rows + 1), pa.int32()), pa.array([], span_type))
                return [pa.array([UNKNOWN] * rows), pa.array(np.zeros(rows)), empty]
            lettered = pc.match_substring_regex(pa.array(words.vocabulary), r"\p{L}").to_numpy(zero_copy_only=False)
            emissions = model.emissions(words.vocabulary) * lettered[:, None]
            node = np.maximum(_potentials(emissions).astype(np.float32), 1e-12)
            del emissions
            posterior = _posteriors(node[words.codes], np.maximum(_potentials(model.transitions.ravel()).reshape(size, size), 1e-12).astype(np.float32), words.offsets)
            row = words.row_of_word()
            counted = lettered[words.codes]
            sums = np.column_stack([np.bincount(row, posterior[:, k] * counted, rows) for k in range(size)])
            number = np.bincount(row, counted, rows)
            best = np.where(number > 0, sums.argmax(axis=1), size)
            score = np.where(number > 0, sums.max(axis=1) / np.maximum(number, 1), 0.0)
            label = posterior.argmax(axis=1)
            start = np.flatnonzero((np.diff(label, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
            end = np.append(start[1:], len(label)) - 1
            offsets = np.searchsorted(row[start], np.arange(rows + 1))
            spans = pa.StructArray.from_arrays(
                [names.take(pa.array(label[start])), pa.array(start - words.offsets[row[start]]), pa.array(end - words.offsets[row[start]])], fields=list(span_type)
            )
            return [names.take(pa.array(best)), pa.array(np.minimum(score, 1.0)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)]

        return compute

    return add_columns(documents, "text", FIELDS, make)
