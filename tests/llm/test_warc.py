import base64
import hashlib
import random

import pytest

from seriesforge.llm import warc
from seriesforge.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, slice int, file string, urlkey string"


@pytest.fixture(scope="module")
def pages(prose):
    r = random.Random(6)
    bodies = [None, "", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n", "é🙂 \x00\r", prose(1, 20_000), *[prose(i, 20) for i in range(10)]]
    urls = [None, "", "http://www.B.example.com:80/a?x=1#f", "https://a.example.com:8443", "not a url\r\nX: y", "http://[bad", "HTTP://B.example.com/A"]
    rows = [(i, r.choice(urls), r.choice(bodies)) for i in range(300)]
    rows += [rows[7], rows[7], (None, "http://b.example.com/", "same"), (None, "http://b.example.com/", "same"), (900, "http://b.example.com/", "same")]
    return rows


def table(spark, pages):
    return spark.createDataFrame([(*p, 1, "x", "y") for p in pages], SCHEMA).repartition(4)


@pytest.mark.parametrize("least", [0, 10])
def test_records_of_pages(spark, pages, least):
    digests = lambda html: base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    first = {}
    for page, _, html in pages:
        if page is not None and len((html or "").encode()) >= least:
            first[digests(html)] = min(first.get(digests(html), page), page)
    want = []
    for page, _, html in pages:
        d = digests(html)
        revisit = page is not None and d in first and first[d] != page
        want.append((page, len((html or "").encode()), d, "revisit" if revisit else "response", first[d] if revisit else None))
    found = warc.digest(warc.archive_and_index(table(spark, pages), least_bytes=least, slice_rows=40)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_index_is_ordered_over_all_slices(spark, pages):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(table(spark, pages), path, archive_bytes=20_000)
    runs = warc.capture_runs(spark, path).cache()
    assert runs.count() > 4
    rows = warc.merged_index(runs, slice_rows=40).orderBy("slice", "position").collect()
    assert len(rows) == len(pages) and len({r["slice"] for r in rows}) > 3
    keys = [warc._order(r.asDict()) for r in rows]
    assert keys == sorted(keys)
    for s in {r["slice"] for r in rows}:
        assert [r["position"] for r in rows if r["slice"] == s] == list(range(sum(r["slice"] == s for r in rows)))
    # Offsets lead back to the records.
    for r in rows[:20]:
        content = bytes(spark.read.format("binaryFile").load(r["file"]).first()["content"])
        (_, length, head, block), *_ = warc.records_of(content[r["offset"] : r["offset"] + r["length"]])
        assert length == r["length"] and block.endswith(b"\r\n\r\n" + block.split(b"\r\n\r\n", 1)[1])


def test_loser_tree():
    r = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(r.randrange(30) for _ in range(r.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


def test_url_keys():
    assert warc.url_key("http://www.B.example.com:80/A?x=1#f") == "com,example,b)/a?x=1"
    assert warc.url_key("https://b.example.com:8443") == "com,example,b:8443)/"
    assert warc.url_key("") == ")/"


def test_broken_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.records_of(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcdef\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.records_of(b"HTTP/1.1 200\r\n\r\n"))


def test_empty_table(spark, pages):
    assert warc.archive_and_index(table(spark, pages).limit(0)).count() == 0
