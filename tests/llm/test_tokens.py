"""Encoding, alignment and packing against plain versions on whole texts."""

import collections
import glob
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stopwise.llm import alignment, packing, tokens
from stopwise.sources.workspace import Workspace

FOLDER = "/root/testdata/sf0.001"
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    (1, None, 1),
    (2, "", 2),
    (3, " ", 3),
    (4, " \t\n", 4),
    (5, "the end<|endoftext|> of <s> it </s>", 5),
    (6, "same text\n\n  twice \n", 6),
    (6, "same text\n\n  twice \n", 7),
    (None, "a row without id, ﬁ Å 漢字 \U0001f600 x y　z", 8),
    (7, "▁ is a space for one of them", 9),
    (8, "nul \x00 and ﷐ marks", 10),
    (9, "long words " * 30000 + "x" * 5000, 11),
    (10, "a  b   c", 12),
]


@pytest.fixture(scope="module")
def encoders():
    with open(A_PATH, "rb") as a, open(B_PATH, "rb") as b:
        a, b = a.read(), b.read()
    plain = Tokenizer.from_file(A_PATH)
    plain.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    return tokens.ByteLevel(a, True), tokens.Pieces(b), plain, pieces


@pytest.fixture(scope="module")
def texts(spark):
    found = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    return [t for t in found if t] + [t for _, t, _ in ODD if t]


def rows_of(found):
    return [found.values[a:b].tolist() for a, b in zip(found.offsets[:-1], found.offsets[1:], strict=True)]


def same_ids(encoders, texts):
    byte_level, own_pieces, plain, pieces = encoders
    given = pa.array([" ", *texts], pa.string())[1:]
    assert rows_of(byte_level(given)) == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert rows_of(own_pieces(given)) == [pieces.encode(t or "") for t in texts]


def test_ids_are_those_of_the_libraries(encoders, texts):
    same_ids(encoders, [*texts, None, "", " " * 3000 + "x" + "\n" * 2000, "e\u0301 \u200b\u00ad \u0660\u0968 \U0001e900 \ua7ca"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab Z9.'sdt\t\n\r\x0b\x1c\x7f\x00\xa0\xad\xb2 \u180e\u2003\u3000\u2581\xe9\u6f22<|>") | st.characters(), max_size=30), min_size=1, max_size=4))
def test_any_text_has_the_ids_of_the_libraries(encoders, found):
    same_ids(encoders, [t for t in found if t.encode("utf-8", "ignore").decode() == t])


def test_special_strings(encoders):
    with open(A_PATH, "rb") as file:
        special = tokens.ByteLevel(file.read(), False)
    plain = Tokenizer.from_file(A_PATH)
    for text in ("a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|>\u200b y", "<|endoftext"):
        assert rows_of(special(pa.array([text]))) == [plain.encode(text, add_special_tokens=False).ids]


def test_galloping_agrees_with_a_plain_search():
    draw = np.random.default_rng(3)
    for _ in range(200):
        values = np.unique(draw.integers(0, 60, draw.integers(0, 40)))
        low = draw.integers(0, len(values) + 1, 25)
        high = np.array([draw.integers(a, len(values) + 1) for a in low])
        keys, start = draw.integers(-5, 70, 25), draw.integers(-3, 50, 25)
        found = alignment.galloping_ranks(keys, values, start, low, high)
        assert found.tolist() == [a + int(np.searchsorted(values[a:b], k)) for k, a, b in zip(keys, low, high, strict=True)]


def test_alignment_agrees_with_overlaps_of_all_pairs():
    draw = random.Random(5)
    rows, at = [], 0
    for _ in range(120):
        size = draw.choice([0, 1, 2, 7, 30])
        cuts = [sorted(draw.sample(range(1, size), draw.randint(0, size - 1)) + [size]) if size else [] for _ in "ab"]
        rows.append([[at + c for c in x] for x in cuts])
        at += size
    ends = [tokens.ragged([r[k] for r in rows], np.int64) for k in (0, 1)]
    found = alignment.align(*ends)
    flat_a, flat_b = ends[0].values.tolist(), ends[1].values.tolist()
    assert [flat_a[k] for k in found.a_common] == sorted(set(flat_a) & set(flat_b)) == [flat_b[k] for k in found.b_common]
    starts_b = [s for s, _ in _spans(rows, 1)]
    for k, (start, end) in enumerate(_spans(rows, 0)):
        overlapping = [j for j, (s, e) in enumerate(zip(starts_b, flat_b, strict=True)) if s < end and e > start]
        assert overlapping == list(range(found.b_first[k], found.b_last[k] + 1))


def _spans(rows, k):
    at, found = 0, []
    for r in rows:
        start = at
        for end in r[k]:
            found.append((start, end))
            start = end
        at = max(at, start)
    return found


def plain_alignment(rows):
    """Results of op11 from whole texts, token by token."""
    plain, pieces = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    plain.encode_special_tokens = True
    byte_of = tokens.byte_characters()
    entries = {k: bytes(byte_of[c] for c in t) for t, k in plain.get_vocab(with_added_tokens=False).items()}
    texts, count = [], collections.Counter()
    for _, text in rows:
        a = plain.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        parts_a = [entries[x] for x in a]
        parts_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(x) else p.replace("▁", " ").encode() for x, p in zip(b, map(pieces.id_to_piece, b), strict=True)]
        if not text or any(b"".join(p) != (" " + text).encode() for p in (parts_a, parts_b)):
            texts.append(([], [], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(p) for p in parts_a]), np.cumsum([len(p) for p in parts_b])
        links, j = [], 0
        for i, end in enumerate(ends_a):
            start = ends_a[i - 1] if i else 0
            while ends_b[j] <= start:
                j += 1
            m = j
            while m < len(b) and (ends_b[m - 1] if m else 0) < end:
                links.append((a[i], b[m]))
                m += 1
        count.update(links)
        texts.append((a, b, ends_a.tolist(), ends_b.tolist(), links))
    most = collections.Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    results = []
    for (doc_id, _), (a, b, ends_a, ends_b, links) in zip(rows, texts, strict=True):
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        results.append((doc_id, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), digest))
    return results


def test_alignment_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(60)
    odd = spark.createDataFrame([(k, t if len(t or "") < 1000 else "long words " * 400) for k, t, _ in ODD], docs.schema)
    both = docs.unionByName(odd)
    rows = [(r.doc_id, r.text) for r in both.collect()]
    found = alignment.alignment_statistics(both).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(plain_alignment(rows), key=repr)
    assert alignment.alignment_statistics(docs.limit(0)).count() == 0


def test_alignment_arrays_give_the_statistics(spark):
    docs = spark.createDataFrame([(k, t) for k, t, _ in ODD], "doc_id long, text string")
    counts = sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) for r in alignment.alignment_statistics(docs).collect()), key=repr)
    found = []
    for r in alignment.align_tokenizers(docs).collect():
        cuts = list(zip([0, *r.a_cuts], r.a_cuts, [0, *r.b_cuts], r.b_cuts, strict=False))
        text = ";".join(",".join(map(str, r.a_ids[a:b])) + "|" + ",".join(map(str, r.b_ids[c:d])) for a, b, c, d in cuts)
        links = sum(y - x + 1 for x, y in zip(r.b_first, r.b_last, strict=True))
        found.append((r.doc_id, len(r.a_ids), len(r.b_ids), len(cuts), links, hashlib.sha256(text.encode()).hexdigest() if cuts else ""))
    assert counts == sorted(found, key=repr)


def test_alignment_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, "one two", 5)], "doc_id long, text string, A_IDS long")
    row = alignment.align_tokenizers(docs.selectExpr("*", "1 AS `x.y`")).first()
    assert row.asDict().keys() == {"doc_id", "text", "x.y", "a_ids", "b_ids", "a_cuts", "b_cuts", "b_first", "b_last"}
    assert row.a_cuts[-1] == len(row.a_ids) and row.b_cuts[-1] == len(row.b_ids)


def plain_first_fit(lengths, capacity):
    bins, fill = [], []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        at = next((b for b in range(len(bins)) if fill[b] + lengths[k] <= capacity), len(bins))
        if at == len(bins):
            bins.append([])
            fill.append(0)
        bins[at].append(k)
        fill[at] += lengths[k]
    return bins


def test_first_fit_agrees_with_the_plain_version():
    draw = np.random.default_rng(2)
    for _ in range(100):
        lengths = draw.integers(1, draw.choice([5, 40, 100]), draw.integers(0, 60))
        assert packing.first_fit_decreasing(lengths, 99) == plain_first_fit(lengths.tolist(), 99)


def test_topping_up_keeps_every_token():
    draw = random.Random(8)
    for _ in range(100):
        lengths = np.array([draw.choice([33, 60, draw.randint(1, 63)]) for _ in range(draw.randint(0, 30))], int)
        bins = [[(k, 0, int(lengths[k])) for k in b] for b in packing.first_fit_decreasing(lengths, 64)]
        found = packing.topped_up(bins, 64, 3)
        sizes = [sum(p[2] for p in b) for b in found]
        assert all(61 <= s <= 64 or (s & (s - 1)) == 0 for s in sizes) and all(sizes)
        placed = collections.Counter((k, x) for b in found for k, start, n in b for x in range(start, start + n))
        assert placed == collections.Counter((k, x) for k, n in enumerate(lengths) for x in range(n))


def checked_packing(pieces, rows):
    """Every document's ids lie in exactly one piece each; sequences have no gaps and little padding."""
    plain = Tokenizer.from_file(A_PATH)
    wanted = collections.Counter()
    for doc_id, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        wanted[(doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    by_row = collections.defaultdict(list)
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        by_row[p.row].append(p)
        by_sequence[p.sequence_id].append(p)
        assert p.length == len(p.ids) > 0 and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    found = collections.Counter()
    for parts in by_row.values():
        parts.sort(key=lambda p: p.start)
        ids = [x for p in parts for x in p.ids]
        assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        found[(parts[0].doc_id, parts[0].doc_tokens, zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        assert len(ids) == parts[0].doc_tokens
    assert found == wanted
    sizes = []
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        sizes.append(sum(p.length for p in parts))
    padding = sum(0 if s & (s - 1) == 0 else packing.SEQUENCE - s for s in sizes)
    assert max(sizes) <= packing.SEQUENCE and padding <= 0.01 * sum(sizes)


def test_packing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    both = docs.unionByName(spark.createDataFrame([(k, t) for k, t, _ in ODD], docs.schema))
    checked_packing(packing.pack_documents(both).collect(), [(r.doc_id, r.text) for r in both.collect()])


def test_packing_of_like_documents_and_many_groups(spark):
    rows = [(k % 7, "word " * (1200 + k % 3)) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    checked_packing(packing.pack_documents(docs, group=20).collect(), rows)


def test_packing_of_odd_tables(spark):
    rows = [(None, None, "x"), (None, "", "y"), ("a", "one", "z")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, `row` string")
    pieces = packing.pack_documents(docs).collect()
    checked_packing(pieces, [r[:2] for r in rows])
    assert sorted(p.ids for p in pieces)[0] == [1]
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_alignment_never_gathers_the_counts_of_many_slices(spark, monkeypatch):
    # A slice a batch of texts, and a row group a slice.
    monkeypatch.setattr(alignment, "LINKS_OF_SLICE", 1)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 64)
    monkeypatch.setattr(alignment, "ROW_GROUPS", alignment.ROW_GROUPS | {"parquet.block.size": "1"})
    rows = [(k % 30, f"some words {k % 7} and a few more of them, näive {k}" if k % 5 else None) for k in range(40)] + [(None, "")]
    work = Workspace(spark)
    found = alignment.alignment_statistics(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), work=work)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain_alignment(rows), key=repr)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{work.root.removeprefix('file:')}/*-slices/*.parquet")]
    assert sum(f.num_rows for f in files) > 20
    assert all(f.row_group(k).num_rows <= 2 for f in files for k in range(f.num_row_groups))
