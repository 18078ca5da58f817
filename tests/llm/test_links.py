"""Near duplicates, benchmark leaks, licenses, neighbours and mixes against plain versions."""

import collections
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stopwise.llm import decontamination, licenses, mixing, near_duplicates, nearest
from stopwise.llm.components import connected_components
from stopwise.sources.workspace import Workspace

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_sets(rows, size):
    sets = {}
    for doc_id, text in rows:
        words = WORD.findall((text or "").encode().lower())
        sets[doc_id] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()}
    return sets


def plain_duplicates(rows, size):
    sets = plain_sets(rows, size)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {k: len(s) for k, s in sets.items()}, plain_components(sets, links)


def corpus(seed):
    """Copies, near copies at every distance, a passage in most documents, and short texts."""
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]

    def text(n):
        return [draw.choice(words) for _ in range(n)]

    passage = text(40)
    rows = []
    for _ in range(12):
        base = text(draw.choice([3, 6, 20, 60, 150, 400]))
        for _ in range(draw.randint(1, 6)):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 5, len(base) // 10])):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append(copy)
    rows += [passage + text(draw.randint(0, 60)) for _ in range(40)]
    rows += [["Upper", "CASE"], ["upper", "case"], [], ["é", "É"], ["É", "É"]]
    draw.shuffle(rows)
    return [(k + 1, draw.choice([" ", "\n", " \t"]).join(r)) for k, r in enumerate(rows)] + [(500, None), (501, " \n ")]


@pytest.mark.parametrize(("seed", "size"), [(1, 4), (2, 5)])
def test_near_duplicates_agree_with_all_pairs(spark, seed, size):
    rows = corpus(seed)
    documents = spark.createDataFrame([(*r, 0, 1) for r in rows], "doc_id long, text string, id int, n int").repartition(5)
    found = near_duplicates.near_duplicates(documents, size).collect()
    sizes, components = plain_duplicates(rows, size)
    assert {r.doc_id: r.n_shingles for r in found} == sizes
    assert {r.doc_id: r.component_id for r in found} == components


def test_a_large_group_of_copies_and_half_copies(spark):
    draw = random.Random(5)
    base = [f"b{k}" for k in range(150)]
    rows = [(k, " ".join(base)) for k in range(200)]
    for k in range(200, 320):
        copy = list(base)
        for _ in range(draw.randint(0, 20)):
            copy[draw.randrange(150)] = f"n{draw.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert {r.doc_id: r.component_id for r in found} == plain_duplicates(rows, 4)[1]


def test_parity_sketches_lose_no_link():
    draw = np.random.default_rng(3)
    for size in (1, 30, 300, 3000):
        values = draw.integers(0, 2**63, size * 2, dtype=np.uint64)
        for changed in (0, 1, size // 9, size):
            one, two = values[:size], values[changed : size + changed]
            unlike = near_duplicates._parities(one) ^ near_duplicates._parities(two)
            assert sum(int(w).bit_count() for w in unlike.view(np.uint64)) <= len(np.setxor1d(one, two))
    assert not near_duplicates._parities(values[:0]).any()


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "a b c d e f g"), (2, "A b c d e f g"), (3, None)]
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 3)]
    assert near_duplicates.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_long_chains(spark):
    draw = random.Random(2)
    names = draw.sample(range(10_000), 300)
    links = [(a, b) for a, b in zip(names[:200], names[1:200])] + [(draw.choice(names[200:]), draw.choice(names[200:])) for _ in range(60)]
    work = Workspace(spark)
    found = connected_components(work, "chain", spark.createDataFrame(links + links[:9], "a long, b long")).collect()
    expected = plain_components({n for link in links for n in link if link[0] != link[1]}, links)
    assert {r.node: r.component for r in found} == {n: c for n, c in expected.items() if any(n in link for link in links if link[0] != link[1])}


def test_common_subsequence_agrees_with_the_table():
    draw = random.Random(6)
    for _ in range(200):
        a = [draw.randrange(6) for _ in range(draw.randint(0, 12))]
        b = [draw.randrange(6) for _ in range(draw.randint(0, 30))]
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontamination.common_subsequence(a, b) == table[-1, -1]


def test_leaks(spark):
    draw = random.Random(7)
    words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(900)]

    def text(n):
        return [draw.choice(words) for _ in range(n)]

    items = [(k, text(draw.randint(15, 60))) for k in range(30)] + [(90, text(4))]
    rows, expected = [], set()
    for k in range(200):
        body = text(draw.randint(0, 300))
        if k % 4 == 0:
            item, passage = items[draw.randrange(30)]
            passage = list(passage)
            if k % 8 == 0:  # a paraphrase: words replaced, put in and left out
                for _ in range(len(passage) // 12):
                    passage[draw.randrange(len(passage))] = draw.choice(words)
                    passage.insert(draw.randrange(len(passage)), draw.choice(words))
            at = draw.randint(0, len(body))
            body[at:at] = passage
            expected.add((k, item))
        if k == 3:
            body += items[-1][1]
        rows.append((k, " ".join(body).title() + ".", 0.5))
    rows += [(300, None, 0.5), (301, "", 0.5)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, cosine double")
    benchmark = spark.createDataFrame([(k, " ".join(t)) for k, t in items] + [(91, None)], "item_id long, text string")
    found = decontamination.find_benchmark_items(documents, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    texts = {k: t.split() for k, t, _ in rows if t}
    assert all(0 <= r.first_word <= r.last_word < len(texts[r.doc_id]) for r in found)
    assert decontamination.find_benchmark_items(documents, benchmark.limit(0)).count() == 0
    assert decontamination.find_benchmark_items(documents.limit(0), benchmark).count() == 0


def test_short_leaks_at_every_offset(spark):
    draw = random.Random(12)
    usual = [f"usual{k}" for k in range(150)]
    items = [(n, draw.sample(usual, n)) for n in (8, 9, 10, 12, 14, 16, 18, 20, 22, 23, 24, 27, 31, 35)]

    def rare(n):
        return [f"rare{draw.randrange(10**9)}" for _ in range(n)]

    rows, expected = [], set()
    for n, words in items:
        for offset in range(12):
            for paraphrased in (False, True):
                passage = list(words)
                for k in draw.sample(range(n - 6), n // 5 if paraphrased else 0):
                    passage[k : k + 1] = rare(1)
                expected.add((len(rows), n))
                rows.append((len(rows), " ".join(rare(12 + offset) + passage + rare(40))))
    rows += [(len(rows) + k, " ".join(draw.choice(usual) for _ in range(60))) for k in range(40)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(t)) for k, t in items], "item_id long, text string")
    found = decontamination.find_benchmark_items(documents, benchmark).collect()
    assert expected <= {(r.doc_id, r.item_id) for r in found}
    planted = len(expected)
    assert all(r.doc_id < planted for r in found if r.item_id >= 12)


def test_short_leaks_among_heavier_words(spark):
    words = [f"usual{k}" for k in range(8)]
    heavy = [f"heavy{k}" for k in range(40)]
    split = decontamination.split_words(pa.array([" ".join(words), " ".join(heavy)]))
    bucket = (decontamination._hashes(split) % np.uint64(decontamination.BUCKETS)).astype(int)
    weights = np.ones(decontamination.BUCKETS)
    weights[bucket[8:]] = 6.0
    basis = np.random.default_rng(13).standard_normal((decontamination.BUCKETS, decontamination.RANK)).astype(np.float32)
    item = decontamination.split_words(pa.array([" ".join(words)]))
    items = decontamination._prepared([5], item, weights, basis)
    rows = [(k, " ".join(heavy[: 12 + k] + words + heavy[-16:])) for k in range(12)] + [(20, " ".join(heavy))]
    found = decontamination._search(spark.createDataFrame(rows, "doc_id long, text string"), items, weights, basis).collect()
    assert {r.doc_id for r in found} == set(range(12))


def plain_licenses(rows):
    def shingles(text):
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    found = {}
    for doc_id, text in rows:
        mine = shingles(text)
        for name, notice in licenses.NOTICES.items():
            share = len(mine & shingles(notice)) / len(shingles(notice))
            if share >= licenses.CONTAINED:
                found[doc_id, name] = round(share, 9)
    return found


def test_licenses_agree_with_all_pairs(spark):
    draw = random.Random(8)
    rows = [(500, None), (501, ""), (502, "MIT License")]
    for k in range(60):
        words = [f"word{draw.randrange(50)}" for _ in range(draw.randint(0, 200))]
        for _ in range(draw.randint(0, 2)):
            notice = draw.choice(list(licenses.NOTICES.values())).split()
            for _ in range(draw.choice([0, 0, 1, 3])):
                notice[draw.randrange(len(notice))] = "changed"
            at = draw.randint(0, len(words))
            words[at:at] = notice
        rows.append((k, " ".join(words).upper() if k % 5 == 0 else "\n".join(words)))
    documents = spark.createDataFrame([(*r, "x") for r in rows + rows[:10]], "doc_id long, text string, license string")
    found = licenses.find_licenses(documents, licenses.notices(spark)).collect()
    assert {(r.doc_id, r.license): round(r.containment, 9) for r in found} == plain_licenses(rows)
    assert len(found) == len(plain_licenses(rows))
    assert licenses.find_licenses(documents.limit(0), licenses.notices(spark)).count() == 0
    assert licenses.find_licenses(documents, licenses.notices(spark).limit(0)).count() == 0


def test_near_variants_of_licenses_are_told_apart(spark):
    start = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    end = " as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    texts = {
        "gpl-2.0": start + "General Public License" + end.format(2),
        "gpl-3.0": start + "General Public License" + end.format(3),
        "lgpl-3.0": start + "Lesser General Public License" + end.format(3),
        "agpl-3.0": start + "Affero General Public License" + end.format(3),
        "bsd-disclaimer": licenses.NOTICES.get("bsd-disclaimer", ""),
        "cc-by-nd-4.0": "This work is licensed under the Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "mit-licensed": "Some words. Licensed under the MIT License.",
        "cc-by-4.0-short": "The text is under CC BY 4.0 since 2020.",
    }
    names = list(texts)
    documents = spark.createDataFrame([(k, texts[n]) for k, n in enumerate(names)], "doc_id long, text string")
    best = {}
    for r in licenses.find_licenses(documents, licenses.notices(spark)).collect():
        best[r.doc_id] = max(best.get(r.doc_id, (0,)), (r.containment, r.license))
    assert {names[k]: (v, n) for k, (v, n) in best.items()} == {n: (1.0, n) for n in names}


def test_band_settings_keep_their_promise():
    assert 1 - (1 - licenses.LIKE**licenses.ROWS) ** licenses.BANDS > 0.999


def plain_neighbours(rows, k):
    valid = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    usual = collections.Counter(len(v) for _, v in valid).most_common(1)[0][0]
    valid = [(i, v) for i, v in valid if len(v) == usual]
    found = {}
    for q in {i for i, _ in valid if i % 100 == 0}:
        vector = next(v for i, v in valid if i == q)
        near = sorted((float(np.sqrt(((v - vector) ** 2).sum())), i) for i, v in valid if i != q)[:k]
        found[q] = [(i, round(d, 9)) for d, i in near]
    return found


def test_neighbours_are_exact_while_all_are_candidates(spark):
    draw = np.random.default_rng(9)
    rows = [(k, draw.integers(-3, 4, 6).astype(float).tolist()) for k in range(700)]
    rows += [(700 + k, [1.0, 2.0, 3.0, 1.0, 2.0, 3.0]) for k in range(400)]
    rows += [(2000, None), (2100, []), (2200, [0.0] * 6), (2300, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2400, [float("nan")] * 6), (2500, [1.0, 2.0]), (None, [1.0] * 6)]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    found = collections.defaultdict(list)
    for r in nearest.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, round(r.score, 9)))
        assert r.rank == len(found[r.query_id])
    assert found == plain_neighbours(rows, 10)


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [4.0])], schema)
    found = nearest.nearest_neighbours(three, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, 1.0), (2, 3.0)]
    assert nearest.nearest_neighbours(three.limit(0), F.col("vec_id") == 0).count() == 0


def test_cells_come_in_the_order_of_their_sums():
    draw = np.random.default_rng(10)
    for _ in range(30):
        first, second, sizes = draw.random(7), draw.random(5), draw.integers(0, 4, (7, 5))
        order = sorted(((first[i] + second[j], i * 5 + j) for i in range(7) for j in range(5) if sizes[i, j]))
        found = nearest.nearest_cells(first, second, sizes, 20)
        assert found == [c for _, c in order[: len(found)]]
        held = sizes.ravel()[found]
        assert held.sum() >= min(20, sizes.sum()) and held[:-1].sum() < 20


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = nearest.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0).collect()
    mine = collections.defaultdict(set)
    for r in found:
        mine[r.query_id].add(r.vec_id)
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    expected = plain_neighbours(rows, 10)
    assert sum(len(mine[q] & {i for i, _ in near}) for q, near in expected.items()) >= 0.9 * sum(map(len, expected.values()))


def test_neighbours_of_many_queries_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(nearest, "LEAST_CANDIDATES", 1 << 30)
    monkeypatch.setattr(nearest, "QUERIES_PER_GROUP", 7, raising=False)
    monkeypatch.setattr(nearest, "PAIRS_AT_ONCE", 50, raising=False)
    draw = np.random.default_rng(12)
    rows = [(k, (draw.normal(size=8) + 5 * (k % 4)).tolist()) for k in range(3000)]
    rows += [(3000 + k, [1.0] * 8) for k in range(1500)] + [(k, [2.0] * 8) for k in range(100, 110)]
    # Far from the origin a distance by a matrix product is off by more than the distances differ.
    rows += [(5000 + k, [1e7 + j * 1e-3 + k * 1e-4 for j in range(8)]) for k in range(200)]
    rows = [r for r in rows if r[0] != 100 or r[1] == [2.0] * 8]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    for r in nearest.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, round(r.score, 9)))
    assert found == plain_neighbours(rows, 10)


def test_only_cells_within_reach_are_compared():
    draw = np.random.default_rng(13)
    points, queries = draw.normal(size=(400, 6)), draw.normal(size=(30, 6))
    low, high = draw.normal(size=(5, 3)), draw.normal(size=(6, 3))
    first, second = nearest._nearest(points[:, :3], low), nearest._nearest(points[:, 3:], high)
    order = np.argsort(first, kind="stable")
    points, first, second, ids = points[order], first[order], second[order], np.arange(400)[order]
    sums = nearest._squares(queries[:, :3], low)[:, first] + nearest._squares(queries[:, 3:], high)[:, second]
    reaches = np.quantile(sums, 0.3, axis=1) + 1e-9
    found = nearest.nearest_of_group(ids, points, (first, second), np.full(30, -1), queries, reaches, (low, high), 4)
    for r in range(30):
        distance = np.sqrt(((points - queries[r]) ** 2).sum(axis=1))
        near = sorted((d, i) for d, i, s in zip(distance, ids, sums[r]) if s <= reaches[r])[:4]
        assert [(d, i) for d, i in zip(found.score[found.row == r], ids[found.place[found.row == r]])] == near


def test_groups_hold_cells_in_a_row():
    start, parts = nearest.groups_of_cells(np.array([3, 4, 2, 25, 1, 1, 9, 2]), 10)
    assert start.tolist() == [0, 0, 0, 1, 4, 4, 5, 5] and parts.tolist() == [1, 1, 1, 3, 1, 1, 1, 1]


def test_a_query_is_stored_once_and_not_with_its_cells(spark):
    draw = np.random.default_rng(14)
    rows = [(k, v) for k, v in enumerate(draw.normal(size=(6000, 8)).tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    work = Workspace(spark)
    assert nearest.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0, work=work).count() == 600
    [visits] = [t for t in os.listdir(work.root.removeprefix("file:")) if t.endswith("-visits")]
    assert spark.read.parquet(f"{work.root}/{visits}").count() == 60


def test_permutations_are_permutations(spark):
    for size in (1, 2, 3, 64, 1000):
        rows = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size), F.lit(3).cast("long"), 5).alias("p")).collect()
        assert sorted(r.p for r in rows) == list(range(size))
        assert size < 64 or [r.p for r in rows] != list(range(size))


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_names, targets = 1.5 * sum(sizes.values()), set(names), {}
    while open_names:
        total = sum(weight[s] for s in open_names)
        full = {s for s in open_names if left * weight[s] / total > 2 * sizes[s]}
        if not full:
            targets |= {s: left * weight[s] / total for s in open_names}
            break
        targets |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_names -= full
    return targets


def test_mix(spark):
    draw = random.Random(11)
    sources = ["b", "a", "é", "Z", "big", None, "empty"]
    rows = []
    for k in range(500):
        source = "big" if k % 3 == 0 else draw.choice(sources)
        n = 0 if source == "empty" else draw.choice([0, 1, 5, 200, 900])
        rows.append((k, None if k == 7 else " ".join(f"{k}.{j}" for j in range(n)), source, 1))
    rows += rows[20:25]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    mix = mixing.mix_sources(documents)
    found = mixing.documents_of_mix(mix).collect()
    assert len(found) == len(rows)
    words = {k: (t or "").split() for k, t, *_ in rows}
    sizes = collections.Counter()
    for k, _, source, _ in rows:
        sizes[source] += len(words[k])
    source_of = {k: s for k, _, s, _ in rows}
    targets = plain_targets(sizes)
    taken = collections.Counter()
    for r in found:
        source = source_of[r.doc_id]
        assert r.size == len(words[r.doc_id]) and r.source_size == sizes[source] and r.target == pytest.approx(targets[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= mixing.WORDS_PER_BLOCK for s in targets)
    again = mixing.documents_of_mix(mixing.mix_sources(documents.repartition(7))).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in found)
    places = mix.places.select("shard", "place").distinct().count()
    assert places == mix.sources.agg(F.sum("slots")).first()[0]


def test_texts_of_the_mix(spark):
    rows = [(k, " ".join(f"{k}.{j}" for j in range(50 * k)), "s" if k % 2 else None) for k in range(12)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.mix_sources(documents)
    counts = collections.Counter(w for r in mixing.texts_of_mix(mix, documents).collect() for w in r.words)
    by_document = collections.Counter()
    for word, times in counts.items():
        assert times <= 2
        by_document[int(word.split(".")[0])] += times
    assert {r.doc_id: r.taken for r in mixing.documents_of_mix(mix).collect() if r.taken} == dict(by_document)


def test_empty_mix(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.documents_of_mix(mixing.mix_sources(empty)).count() == 0


def test_latent_space_takes_in_every_block_of_every_document(spark):
    words = [f"word{k}" for k in range(6000)]
    rows = [(k if k % 7 else None, f"{w} shared") for k, w in enumerate(words)]
    weights, sketch = decontamination._statistics(spark.createDataFrame(rows, "doc_id long, text string"))
    split = decontamination.split_words(pa.array([*words, "shared"]))
    bucket = decontamination._buckets(decontamination._hashes(split))[split.codes]
    times = np.bincount(bucket, minlength=decontamination.BUCKETS)
    assert np.allclose(weights, np.log(6001 / (times + 1 + 5999 * (np.arange(len(times)) == bucket[-1]))) + 0.1)
    alone = bucket[(times[bucket] == 1) & (bucket != bucket[-1])]
    assert len(alone) > 5000 and (np.abs(sketch[alone]).sum(axis=1) == 1).all()
    again = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(3)
    assert (decontamination._statistics(again)[1] == sketch).all()
