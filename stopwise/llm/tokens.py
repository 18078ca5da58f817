"""Token ids of whole texts by public tokenizers, as NumPy arrays.

A byte-level vocabulary is encoded with two libraries of like results. ``tiktoken`` merges by rank and is four times as fast; the ranks
are the ids, if the vocabulary numbers its merges in their order. Its pattern splits words by letters, digits and white space, and
which characters these are depends on a library's version of Unicode. So it only gets texts of characters that every version
classes alike; the others go to ``tokenizers``.

The vocabulary files reach the executors as broadcast bytes (a few MB each, however large the input).
"""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are encoded in slices of so many bytes.
SLICE_BYTES = 1 << 20
#: A character outside these ranges, or white space without end, sends a text to the slower library: ASCII, Latin, Greek, Cyrillic,
#: usual punctuation, Kana, the first CJK block and Hangul.
UNSETTLED = (
    "[^\\x00-\\x7f\\x{a1}-\\x{24f}\\x{391}-\\x{3a1}\\x{3a3}-\\x{3c9}\\x{410}-\\x{44f}\\x{2010}-\\x{2027}\\x{2030}-\\x{205e}"
    "\\x{3041}-\\x{3096}\\x{30a1}-\\x{30fa}\\x{4e00}-\\x{9fa5}\\x{ac00}-\\x{d7a3}]|[\\s\\x0b]{1000}"
)


class Ragged(NamedTuple):
    """Row ``i`` has ``values[offsets[i]:offsets[i + 1]]``."""

    offsets: np.ndarray
    values: np.ndarray


def ragged(lists: list[list[int]] | list[np.ndarray], kind: type = np.int32) -> Ragged:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
    if lists and isinstance(lists[0], np.ndarray):
        return Ragged(offsets, np.concatenate(lists).astype(kind))
    return Ragged(offsets, np.fromiter((v for x in lists for v in x), kind, offsets[-1]))


class ByteLevel:
    """A byte-level BPE vocabulary; ``special_as_text`` takes special strings in texts as plain text."""

    def __init__(self, vocabulary: bytes, special_as_text: bool) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self._exact = Tokenizer.from_str(vocabulary.decode())
        self._exact.encode_special_tokens = special_as_text
        told = json.loads(vocabulary)
        split, special = told["pre_tokenizer"] or {}, told["added_tokens"]
        if told["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True):
            raise ValueError("not a plain byte-level vocabulary")
        byte_of = byte_characters()
        ranks = {bytes(byte_of[c] for c in entry): k for entry, k in told["model"]["vocab"].items()}
        entries = {k: b for b, k in ranks.items()} | {t["id"]: t["content"].encode() for t in special}
        #: Bytes of each id.
        self.bytes = [entries.get(k, b"") for k in range(max(entries) + 1)]
        merged = [told["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in told["model"]["merges"]]
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in special)
        self._fast = None
        if plain and merged == sorted(merged):
            own = {} if special_as_text else {t["content"]: t["id"] for t in special}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=own)

    def __call__(self, texts: pa.Array) -> Ragged:
        """Ids of each text; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self._fast is None:
            slow = np.ones(len(texts), bool)
        else:
            slow = pc.match_substring_regex(texts, UNSETTLED).to_numpy(zero_copy_only=False)
        own = iter(self._exact.encode_batch_fast(texts.filter(pa.array(slow)).to_pylist(), add_special_tokens=False))
        return ragged([
            np.array(next(own).ids, np.int32) if s else self._fast.encode_to_numpy(t, allowed_special="all", disallowed_special=())
            for t, s in zip(texts.to_pylist(), slow, strict=True)
        ])


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Pieces:
    """A piece vocabulary of the library ``sentencepiece``, which adds a space before each text."""

    def __init__(self, vocabulary: bytes) -> None:
        import sentencepiece

        self._own = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
        pieces = [self._own.id_to_piece(k) for k in range(self._own.get_piece_size())]
        #: Bytes of each id.
        self.bytes = [bytes([int(p[3:-1], 16)]) if self._own.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]

    def __call__(self, texts: pa.Array) -> Ragged:
        """Ids of each text; null counts as empty."""
        return ragged(self._own.encode(pc.fill_null(texts, "").to_pylist(), num_threads=1))
