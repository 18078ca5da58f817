"""WARC bundles: exact round trips."""

import pytest

from stopwise.llm import warc

PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (5, "http://a/5", "<p>one</p>"),
    (3, None, None),
    (4, "http://a/4", ""),
    (6, "http://a/é b", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 3),
    (7, "http://a/7", "long " * 400_000),
    (7, "http://a/7", "long " * 400_000),
    (None, "http://a/none", "<p>one</p>"),
    (None, "http://a/alone", "alone"),
]


@pytest.fixture(scope="module")
def archive(spark):
    rows = [(*p, "clash") for p in PAGES]
    return warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(3))


def test_records_come_back(archive):
    rows = sorted(warc.read_archive(archive).collect(), key=lambda r: (r.page_id or 0, r.url))
    kind = {(r.page_id, r.url): (r.record_type, r.refers_to) for r in rows}
    assert len(rows) == len(PAGES)
    assert kind[1, "http://a/1"] == kind[2, "http://a/2"] == kind[None, "http://a/none"] == ("revisit", 5)
    assert kind[3, ""] == ("revisit", 4)
    assert kind[5, "http://a/5"] == kind[4, "http://a/4"] == kind[7, "http://a/7"] == kind[None, "http://a/alone"] == ("response", None)
    texts = {p[0]: (p[2] or "").encode() for p in PAGES if p[0]}
    for r in rows:
        if r.page_id:
            assert r.payload_bytes == len(texts[r.page_id]) and r.payload_digest == warc.digest(texts[r.page_id])
        if r.record_type == "response" and r.page_id:
            assert bytes(r.payload) == texts[r.page_id]
    assert sum(r.page_id == 7 for r in rows) == 2


def test_single_records_are_cut_out(spark, archive):
    found = warc.read_records(archive, spark.createDataFrame([(6,), (7,), (99,)], "page_id long")).collect()
    assert sorted(r.page_id for r in found) == [6, 7, 7]
    assert {bytes(r.payload).decode() for r in found} == {PAGES[5][2], PAGES[6][2]}


def test_small_payloads_need_no_revisits(spark):
    pages = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string")
    kinds = {r.record_type for r in warc.read_archive(warc.write_archive(pages, min_revisit_bytes=11)).collect()}
    assert kinds == {"response"}


def test_seek_table():
    bundle = warc.Bundle()
    for k in range(50):
        bundle.add(k, warc.record(k, "u", b"x" * 20_000, None, False))
    data = bundle.finished()
    table = warc.seek_table(data)
    assert len(table) > 2 and table[0][0] == 0
    assert all(a[0] + a[1] == b[0] for a, b in zip(table[:-1], table[1:], strict=True))
    import zstandard

    whole = b"".join(zstandard.ZstdDecompressor().decompress(data[s : s + n]) for s, n, _ in table)
    assert [r[0] for r in warc.parse(whole)] == list(range(50))
    for page_id, frame, start, packed, offset, size in bundle.index:
        part = zstandard.ZstdDecompressor().decompress(data[start : start + packed])[offset : offset + size]
        assert [r[0] for r in warc.parse(part)] == [page_id] and table[frame][:2] == (start, packed)


def test_empty_table(spark):
    empty = warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read_archive(empty).count() == 0
