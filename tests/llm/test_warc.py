"""Archives: round trips, standard records, index lookups."""

import gzip
import hashlib
import re

import duckdb
import pyarrow as pa

from tierline.llm import warc

LONG = "<p>same payload</p>" * 20
PAGES = [
    (7, "http://www.b.example.com/x?q=1", LONG),
    (3, "http://b.example.com/", LONG),
    (9, "http://b.example.com/", LONG),
    (1, "https://a.example.org:8080/é\r\nX: y", "short"),
    (2, "no host", "short"),
    (4, None, None),
    (5, "", ""),
    (6, "http://[broken", "é😀" * 60),
    (8, "http://c.example/", "z" * 300_000),
    (12, "http://b.example.com/", "\r\n\r\nHTTP/1.1 Content-Length: 3\r\n\r\n" * 9),
    (None, "http://n.example/", "<b>no id</b>" * 20),
    (None, "http://n.example/", "<b>no id</b>" * 20),
    (13, "http://r.example/", "<i>twice</i>" * 30),
    (13, "http://r.example/", "<i>twice</i>" * 30),
]


def frame(spark, pages):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in pages], "page_id long, url string, html string, key string, size int")


def through(df):
    archive = warc.write(df)
    return warc.records(warc.lookup(df, archive), archive).collect(), archive


def test_round_trip_equals_the_sql_form(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_ENTRIES", 2)
    pages = [p for p in PAGES if p[0] is not None and p[0] != 13]
    rows, _ = through(frame(spark, pages).repartition(3))
    connection = duckdb.connect()
    connection.register("pages", pa.Table.from_pylist([{"page_id": i, "html": h} for i, _, h in pages]))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    wanted = connection.execute(f"SELECT {', '.join(names)} FROM ({warc.ORACLE_SQL})").fetchall()
    assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(wanted)
    for r in rows:
        html = next(h for i, _, h in pages if i == r.page_id) or ""
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == html.encode()


def test_null_ids_and_repeated_rows(spark):
    rows, _ = through(frame(spark, PAGES[-4:]))
    assert sorted(((r.page_id, r.record_type, r.refers_to) for r in rows), key=repr) == [
        (13, "response", None),
        (13, "revisit", 13),
        (None, "response", None),
        (None, "revisit", None),
    ]
    assert len({r.payload_digest for r in rows}) == 2
    assert through(frame(spark, []))[0] == []


def test_lookup_finds_all_captures_of_an_address_and_no_others(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_ENTRIES", 3)
    pages = [(i, f"http://h{i % 50}.example/p{i % 7}" if i % 3 else "http://hot.example/", f"page {i}") for i in range(300)]
    archive = warc.write(frame(spark, pages).repartition(5))
    asked = spark.createDataFrame([("http://hot.example/",), ("http://hot.example/",), ("http://h4.example/p4",), ("http://none.example/",)], "url string")
    rows = warc.records(warc.lookup(asked, archive), archive).collect()
    wanted = [i for i, u, _ in pages if u in ("http://hot.example/", "http://h4.example/p4")]
    assert sorted(r.page_id for r in rows) == sorted(wanted)


def test_records_are_standard(spark):
    _, archive = through(frame(spark, PAGES[:3]).coalesce(1))
    [name] = {r.file for r in spark.read.parquet(f"{archive.folder}/captures").collect()}
    with gzip.open(f"{archive.folder}/{name}") as source:
        raw = source.read()
    heads = re.findall(rb"WARC/1\.1\r\n(.*?)\r\n\r\n", raw, re.S)
    assert len(heads) == 3 and raw.count(LONG.encode()) == 1
    assert sum(b"WARC-Type: revisit" in h and b"WARC-Refers-To: <urn:page:3:" in h for h in heads) == 2
    assert hashlib.sha256(LONG.encode()).hexdigest().encode() in heads[0]


def test_keys_put_a_domain_together():
    assert warc.url_key("http://User@WWW.Example.com:81/A?b") == "com,example,www:81)/A?b"
    assert [warc.url_key(u) for u in (None, "", "x y", "http://[a", "http://a:b/")] == ["", "", "x y", "http://[a", "http://a:b/"]
