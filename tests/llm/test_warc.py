import base64
import gzip
import hashlib
from collections import Counter

import duckdb

from arpent.llm import warc
from arpent.llm._shared import fresh_path


def brute(rows):
    keeper = {}
    for page, _, html in rows:
        p = (html or "").encode()
        keeper[p] = max(keeper.get(p, page if page is not None else -1), page if page is not None else -1)
    out = []
    for page, _, html in rows:
        p = (html or "").encode()
        own = page is None and keeper[p] == -1 or page == keeper[p]
        out.append((page, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if own else "revisit", None if own else keeper[p]))
    return Counter(out)


def test_query(spark, sf_dir):
    got = Counter(map(tuple, warc.op5_warc(spark, sf_dir).collect()))
    assert got == brute(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect())


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf_dir}/pages.parquet')")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = con.execute(f"SELECT {','.join(cols)} FROM ({warc.ORACLES['op5_warc']})").fetchall()
    assert Counter(want) == Counter(map(tuple, warc.op5_warc(spark, sf_dir).select(*cols).collect()))


ODD = [
    (1, "http://a.example/x", "<p>same</p>"), (5, "http://a.example/x", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "http://b.example/\r\nX: y z", None),
    (6, "http://b.example:8080/?q=1#f", ""), (7, "not a url [", "WARC/1.1\r\n\r\nHTTP/1.1\r\n\r\n\x00"), (8, "https://www.É.example/é", "é" * 70000), (None, "http://c.example/", "<p>other</p>"),
    (9, "http://a.example/x", "<p>twice</p>"), (9, "http://a.example/x", "<p>twice</p>"),
]


def test_odd_pages_small_blocks_and_none(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    df = spark.createDataFrame([(*r, 1) for r in ODD], "page_id long, url string, html string, _sha int")
    assert Counter(map(tuple, warc.archive_round_trip(df).collect())) == brute(ODD)
    monkeypatch.setattr(warc, "DIRECTORY", 2)
    monkeypatch.setattr(warc, "READ", 7)
    assert Counter(map(tuple, warc.archive_round_trip(df).collect())) == brute(ODD)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_archives_are_plain_gzip(spark):
    df = spark.createDataFrame(ODD[:4], "page_id long, url string, html string").coalesce(1)
    path = fresh_path(spark, "w")
    warc.write_archives(df, path)
    (file,) = warc.archive_files(spark, path).collect()
    assert gzip.decompress(bytes(file["content"])).count(b"WARC/1.1\r\nWARC-Type") == 4


def test_url_keys():
    assert warc.url_key("https://www.Blog.example.com/a?b=1#c") == "com,example,blog)/a?b=1"
    assert warc.url_key("http://x.example:8080") == "example,x:8080)/"
