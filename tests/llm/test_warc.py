"""Archives written, indexed, searched and read back."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tagloom.llm import warc
from tagloom.operators.sizing import staging_path

PAGES = [
    (1, "http://b.example.com/x?q=1#top", "<p>one</p>"),
    (2, "https://A.example.com/", "<p>two</p>"),
    (3, "http://b.example.com/x?q=1", "<p>one</p>"),
    (4, None, None),
    (5, "no host", ""),
    (6, "http://b.example.com/line\r\nbreak é%20", "é" * 50_000),
    (None, "http://c.org", "<p>one</p>"),
    (7, "", "<p>two</p>"),
]
SCHEMA = "page_id bigint, url string, html string"


def expected(rows, floor=0):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        target = first.get(html or "") if len(body) >= floor else None
        revisit = target is not None and target != page
        out.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=repr)


def read_back(pages, **options):
    _, index = warc.archive(pages, **options)
    keys = pages.select(warc.url_key(F.col("url")).alias("key"))
    rows = warc.read_records(warc.lookup(keys, index), with_payload=True)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "url").collect()


@pytest.mark.parametrize("floor", [0, 5])
def test_round_trip(spark, floor):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    rows = read_back(pages, min_payload=floor)
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == expected(PAGES, floor)
    texts = {p: (h or "").encode() for p, _, h in PAGES}
    urls = {p: u for p, u, _ in PAGES}
    for r in rows:
        assert r["url"] == urls[r["page_id"]]
        assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == texts[r["page_id"]]


def test_hot_key_over_many_blocks_and_keys_not_there(spark):
    rows = [(i, "http://hot.example.com/" if i % 3 else f"http://h{i}.example.com/", f"body {i}") for i in range(600)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(4)
    folder = staging_path(spark, "test_archives")
    captures = warc.write_archives(pages, f"{folder}/warc")
    index = warc.build_index(captures, f"{folder}/index", lines=16)
    assert index.agg(F.sum("lines")).first()[0] == 600
    keys = spark.createDataFrame([("com,example,hot)/",), ("com,example,h3)/",), ("com,example,zzz)/",), ("",), ("com,example,h3)/",)], "key string")
    found = warc.lookup(keys, index).groupBy("key").count().collect()
    assert {r["key"]: r["count"] for r in found} == {"com,example,hot)/": 400, "com,example,h3)/": 1}
    wide = warc.find_blocks(keys, index).filter("key = 'com,example,hot)/'").count()
    assert wide >= 400 // 16


def test_records_are_members_any_reader_can_open(spark):
    data = warc.record("http://x/é", 3, b"body", None)
    assert gzip.decompress(gzip.compress(data)).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert data.endswith(b"\r\n\r\nbody\r\n\r\n")
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"body", b"bodY"))


def test_keys(spark):
    df = spark.createDataFrame([("https://WWW.Example.com/A?b#c",), ("http://x",), ("plain",), (None,)], "url string")
    assert [r[0] for r in df.select(warc.url_key(F.col("url"))).collect()] == ["com,example,www)/A?b", "x)", "plain", ""]


def test_empty_and_repeated_rows(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    assert read_back(pages.limit(0)) == []
    twice = spark.createDataFrame([(1, "http://a/", "x"), (1, "http://a/", "x"), (2, "http://a/", "x")], SCHEMA)
    assert sorted(tuple(r)[3] for r in read_back(twice.withColumn("key", F.lit(1)))) == ["response", "response", "revisit"]


def members(folder):
    """All records of the archives in a folder, by any gzip reader."""
    from pathlib import Path

    for file in Path(folder.removeprefix("file:")).glob("warc-*"):
        for part in gzip.decompress(file.read_bytes()).split(b"WARC/1.1\r\n")[1:]:
            yield dict(line.split(": ", 1) for line in part.split(b"\r\n\r\n")[0].decode().split("\r\n"))


def test_addresses_and_names(spark):
    """Addresses keep their escapes; names of records are unique, and what a revisit names is there."""
    rows = [(1, "http://a.org/x%20y?q=a+b|c", "x"), (1, "http://a.org/x%20y", "x"), (2, "http://a.org/é z", "x"), (3, "u", "one"), (4, "u", "one"), (5, "u", "one"), (None, "u", "n"), (None, "u", "n")]
    folder = staging_path(spark, "test_names")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), folder)
    records = list(members(folder))
    names = [r["WARC-Record-ID"] for r in records]
    assert len(set(names)) == len(rows)
    assert {r["WARC-Target-URI"] for r in records} == {"http://a.org/x%20y?q=a+b|c", "http://a.org/x%20y", "http://a.org/%C3%A9%20z", "u"}
    targets = {r["X-Page-ID"]: r.get("WARC-Refers-To") for r in records if r["WARC-Type"] == "revisit"}
    home = next(r["WARC-Record-ID"] for r in records if r.get("X-Page-ID") == "3")
    assert targets == {"2": None, "4": home, "5": home}


def test_tasks_follow_the_bytes(spark, monkeypatch):
    rows = [(i, f"http://h{i % 5}.org/{i}", hashlib.sha256(str(i).encode()).hexdigest() * 40) for i in range(300)]
    captures, _ = warc.archive(spark.createDataFrame(rows, SCHEMA).repartition(2))
    size = captures.agg(F.sum("length")).first()[0]
    monkeypatch.setattr(warc, "RANGE", size // 7)
    found = warc.read_records(captures)
    assert 6 <= found.rdd.getNumPartitions() <= 8 and found.count() == 300


def test_very_long_payload(spark):
    pages = spark.createDataFrame([(1, "http://a/", "é" * 4_000_000)], SCHEMA)
    assert [r["payload_bytes"] for r in read_back(pages)] == [8_000_000]
