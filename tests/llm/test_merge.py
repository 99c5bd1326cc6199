"""The loser tree, front coding, and archives."""

import gzip
import io
import random

import pytest

from tallyboard.llm import merge, warc


def test_common():
    rng = random.Random(1)
    for _ in range(300):
        a = bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 90)))
        b = a[: rng.randrange(0, 90)] + bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 9)))
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert merge.common(a, b, 0) == merge.common(a, b, want // 2) == want


@pytest.mark.parametrize("runs", [0, 1, 2, 5, 13])
def test_merge_of_front_coded_runs(runs):
    rng = random.Random(runs)
    splitters = [b"abb", b"b"]
    pieces, everything = {}, []
    for r in range(runs):
        items = [(bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 12))), b"%d" % rng.randrange(9)) for _ in range(rng.randrange(0, 60))]
        everything += items
        for k, blob in merge.cut_run(list(items), splitters):
            pieces.setdefault(k, []).append(blob)
    out = []
    for k in sorted(pieces):
        last = None
        for key, shared, value in merge.merge(merge.decode(b) for b in pieces[k]):
            assert sum(key >= s for s in splitters) == k
            assert last is None or (key >= last and shared == merge.common(last, key, 0))
            last = key
            out.append((key, value))
    assert [k for k, _ in out] == sorted(k for k, _ in everything)
    assert sorted(out) == sorted(everything)


PAGES = [
    (1, "http://a.example.com/x", "<p>" + "same " * 30),
    (2, "http://b.example.com/y?q=1", "<p>" + "same " * 30),
    (3, "http://a.example.com/x", "short"),
    (4, None, "short"),
    (5, "https://user@Host.example.com:8080", None),
    (6, "ftp//odd\r\nvalue", "line\r\n\r\nWARC/1.1\r\n\r\nline " + "ü" * 200),
    (7, "http://c.example.com/", "line\r\n\r\nWARC/1.1\r\n\r\nline " + "ü" * 200),
    (7, "http://c.example.com/", "line\r\n\r\nWARC/1.1\r\n\r\nline " + "ü" * 200),
    (None, "http://a.example.com/x", "<p>" + "same " * 30),
    (8, "http://a.example.com/z", ""),
]


def test_archives(spark, odd):
    import hashlib

    pages = spark.createDataFrame([(*p, "extra", 1) for p in PAGES], "page_id long, url string, html string, first string, bytes int").repartition(2)
    path = warc.archive_folder(spark)
    rows = warc.archive_pages(pages, path).collect()
    assert len(rows) == len(PAGES)
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        same = [p for p, _, h in PAGES if h == html and p is not None]
        refers = min(same) if len(raw) >= 100 and page_id != min(same) else None
        found = {(r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows if r.page_id == page_id}
        assert found == {(len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if refers else "response", refers)}
    order = [(r.url_key, r.captured_at) for r in sorted(rows, key=lambda r: (r.range, r.place))]
    assert order == sorted(order, key=lambda x: (x[0].encode(), x[1]))
    records = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert records[6].payload.decode() == PAGES[5][2] and records[7].payload is None
    files = spark.read.format("binaryFile").load(path + "/part-*").collect()
    assert sum(1 for f in files for _ in warc.parse_records(gzip.GzipFile(fileobj=io.BytesIO(f.content)))) == len(PAGES)


def test_index_over_many_ranges(spark, odd):
    pages = spark.range(300).selectExpr("id page_id", "concat('http://h', id % 3, '.example.com/', id % 7) url", "cast(id as string) html")
    path = warc.archive_folder(spark)
    warc.write_archives(warc.plan_records(pages), path, most=40)
    rows = warc.index_captures(warc.read_archives(spark, path), range_captures=20).collect()
    order = [(r.url_key, r.captured_at, r.page_id) for r in sorted(rows, key=lambda r: (r.range, r.place))]
    assert len(order) == 300 and order == sorted(order) and len({r.range for r in rows}) > 3


def test_no_pages(spark, odd):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_pages(pages).count() == 0


def test_url_key():
    assert warc.url_key("http://WWW.Example.com:80/A?b=C#d") == "com,example,www)/a?b=c"
    assert warc.url_key("") == "" and warc.url_key("http://[::1") is not None
