"""Words of whole texts as NumPy arrays, and column-adding Arrow maps.

A word is a run of characters other than space and U+0009 to U+000D. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are worked on in slices of about so many bytes, so that a task's memory does not grow with its input.
SLICE_BYTES = 4 << 20


class Words(NamedTuple):
    """Row ``i`` has the words ``vocabulary[codes[offsets[i]:offsets[i + 1]]]``."""

    offsets: np.ndarray
    codes: np.ndarray
    vocabulary: list[str]

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def split_words(texts: pa.Array, lower: Callable[[pa.Array], pa.Array] = pc.utf8_lower) -> Words:
    """Lower-cased words of each text, each distinct word once in the vocabulary."""
    # take() copies: splitting reads a slice of a longer array wrongly.
    copied = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts))))
    lists = pc.ascii_split_whitespace(lower(pc.fill_null(copied, "")))
    flat = lists.flatten()
    present = pc.not_equal(pc.binary_length(flat), 0)
    before = np.concatenate(([0], np.cumsum(present.to_numpy(zero_copy_only=False))))
    starts = lists.offsets.to_numpy()
    encoded = flat.filter(present).dictionary_encode()
    # Several times as fast as to_pylist().
    vocabulary = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
    return Words(before[starts - starts[0]], encoded.indices.to_numpy(), vocabulary)


def word_hashes(vocabulary: list[str], seed: int = 0) -> np.ndarray:
    """64-bit hash of each word."""
    one = xxhash.xxh3_64_intdigest
    return np.fromiter((one(w, seed) for w in vocabulary), np.uint64, len(vocabulary))


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values over the whole range."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut so that each part has about ``size`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // size
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, end in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
        yield batch.slice(start, end - start)


def add_columns(
    data: DataFrame,
    text: str,
    fields: T.StructType,
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    size: int = SLICE_BYTES,
) -> DataFrame:
    """``data`` with the columns ``fields`` that ``make()(texts)`` computes from the column ``text``.

    Rows stay where they are. ``make`` runs once per task. Columns of ``data`` that have the name of a
    new column (in any case) are replaced.
    """
    taken = {f.name.lower() for f in fields}
    kept = [c for c in data.columns if c.lower() not in taken]
    at = kept.index(text)
    # Under plain names, as mapInArrow takes a dot in a name for a field of a struct.
    plain = [F.col(f"`{c.replace('`', '``')}`").alias(f"_{k}") for k, c in enumerate(kept)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        names = [*kept, *(f.name for f in fields)]
        for batch in batches:
            for part in slices(batch, batch.schema.names[at], size):
                yield pa.RecordBatch.from_arrays([*part.columns, *compute(part.column(at))], names=names)

    source = data.select(*plain)
    given = [T.StructField(c, f.dataType) for c, f in zip(kept, source.schema.fields, strict=True)]
    schema = T.StructType([*given, *fields.fields])
    return source.mapInArrow(run, schema)
