"""Archives written, indexed, looked up and read back, against the rows that went in."""

import gzip
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starmart.llm import warc

LONG, OTHER = "<p>ä\r\n\r\n</p>" * 100, "x" * 1000
ROWS = [
    (1, "http://www.example.org/a?b=1#top", LONG),
    (2, "https://EXAMPLE.org:443/a", LONG),
    (9, "http://b.example.org", LONG),
    (3, "http://b.example.org", "short"),
    (4, "http://b.example.org", "short"),
    (5, None, None),
    (6, "", ""),
    (7, "no scheme here\r\nWARC-Type: x", OTHER),
    (None, "http://c.net/", OTHER),
    (None, None, "y" * 1000),
    (None, None, "y" * 1000),
    (8, "http://日本.example/ü ü", "z" * 3_000_000),
    (8, "http://日本.example/ü ü", "z" * 3_000_000),
    (10, "http://d.net/", "x" * 999),
    (11, "http://d.net/", "x" * 999),
]


def frame(spark, rows, name="html"):
    kept = spark.createDataFrame(rows, f"page_id bigint, url string, {name} string")
    return kept.withColumns({"id": F.lit("x"), "digest": F.lit(0), "file": F.lit(1)})


def expected(rows):
    held = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000:
            held[payload] = max(held.get(payload, -1), -1 if page_id is None else page_id)
    out = Counter()
    for page_id, _, html in rows:
        payload = (html or "").encode()
        holder = held.get(payload, -1)
        refers_to = None if holder in (-1, page_id) else holder
        kind = "response" if refers_to is None else "revisit"
        out[page_id, len(payload), hashlib.sha1(payload).hexdigest(), kind, refers_to] += 1
    return out


def read_back(pages, index, folder):
    found = warc.read_records(warc.look_up(index, pages, "url", "page_id"), folder).collect()
    for r in found:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or hashlib.sha1(r.payload).hexdigest() == r.digest
    return Counter((r.id, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in found)


@pytest.mark.parametrize("lines", [1, 2, 2000])
def test_round_trip(spark, monkeypatch, lines):
    """However the captures fall into blocks, ranges and reads."""
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    monkeypatch.setattr(warc, "READ_BYTES", 100 * lines)
    pages = frame(spark, ROWS).repartition(3)
    index, folder = warc.archived(pages)
    assert index.captures == len(ROWS)
    assert read_back(pages, index, folder) == expected(ROWS)


def test_many_captures_of_one_url(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    monkeypatch.setattr(warc, "RANGE_LINES", 40)
    rows = [(i, "http://hot.org/" if i % 3 else f"http://h{i % 11}.org/{i}", f"p{i % 5}" * 600) for i in range(300)]
    rows += [(None, "http://hot.org/", "p0" * 600)] * 90
    pages = frame(spark, rows)
    index, folder = warc.archived(pages)
    assert len(index.ranges) > 4
    assert read_back(pages, index, folder) == expected(rows)
    other = spark.createDataFrame([("http://www.hot.org/",), ("http://none.org/",), (None,)], "url string")
    assert warc.look_up(index, other).count() == 0
    hot = warc.look_up(index, spark.createDataFrame([("https://HOT.org:443/#x",), ("http://hot.org",)], "url string")).collect()
    assert Counter(r.id for r in hot) == Counter(r[0] for r in rows if r[1] == "http://hot.org/")


def test_files_are_archives(spark):
    """Every archive is a run of gzip members, each one record as its header states."""
    pages = frame(spark, ROWS).coalesce(1)
    index, folder = warc.archived(pages)
    files, root = warc._files(folder)
    names = [f.path for f in files.get_file_info(warc.fs.FileSelector(root))]
    assert len(names) == 1
    with open(names[0], "rb") as file:
        data = gzip.decompress(file.read())
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: re") and data.count(b"WARC/1.1\r\n") == len(ROWS)


def test_empty(spark):
    pages = frame(spark, [])
    index, folder = warc.archived(pages)
    assert index.ranges == [] and read_back(pages, index, folder) == Counter()


def test_keys():
    assert warc.url_key("http://User@WWW.Example.com:80/A?b#c") == "com,example,www)/A?b"
    assert warc.url_key("https://example.com") == "com,example)/"
    assert warc.url_key(None) == "" and warc.url_key("a b\n") == "a%20b%0A"


def test_altered_payload_is_refused():
    raw = warc.record(1, "http://a.b/", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert warc.parsed(raw)[-1] == b"payload"
    with pytest.raises(ValueError):
        warc.parsed(raw.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"))
