"""WARC archives with a two-level capture index: sorted URL keys in compressed blocks under a sparse directory."""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arpent.llm._shared import fresh_path, read, saved, small

#: Captures of an index block.
BLOCK_LINES = 1000

#: Entries of the directory that the driver and every task hold, at most about; bytes that are read at once.
DIRECTORY, READ = 200_000, 1 << 20

#: Bytes of records that a task reads by range, about.
RANGES = 1 << 24

#: Stands between the gzip members of an archive: readers skip zero bytes there.
PAD = b"\0"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host reversed and without www, then path and query: com,example,blog)/en/1?q=2."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return (url or "").lower()
    host = re.sub(r"^www\d*\.", "", host.lower())
    port_text = f":{port}" if port and port not in (80, 443) else ""
    key = ",".join(reversed(host.split("."))) + port_text + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", key)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit of the page refers_to: its HTTP header stays, its payload does not."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if refers_to is None else http
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """A record's header fields, its HTTP header and its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, http, payload


def page_of(field: str) -> int | None:
    name = field.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "None" else int(name)


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, raw record) of the gzip members of an archive, read on piece by piece."""
    at, held = 0, b""
    while True:
        held = held.lstrip(PAD) if held.strip(PAD) or not held else b""
        d, out, size = zlib.decompressobj(31), [], 0
        while not d.eof:
            if not held:
                held = stream.read(READ)
                if not held:
                    return
                if not size:
                    at = stream.tell() - len(held.lstrip(PAD))
                    held = held.lstrip(PAD)
                    continue
            elif not size:
                at = stream.tell() - len(held)
            out.append(d.decompress(held))
            size += len(held) - len(d.unused_data)
            held = d.unused_data
        yield at, size, b"".join(out)


def opened(uri: str):
    """A file that pyarrow can seek in: local, HDFS or object storage."""
    fs, path = FileSystem.from_uri(re.sub(r"^(\w+):/(?!/)", r"\1:///", uri))
    return fs.open_input_file(path)


def squeeze(raw: bytes, level: int = 1) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


def write_archives(pages: DataFrame, path: str) -> None:
    """One WARC file of a gzip member per record for each partition of pages, in the folder.

    Of pages with equal payloads the one of the largest page_id is the response. The text writer writes the bytes as they
    are, so the folder may be on any file system that Spark writes to.
    """
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("_sha", F.sha1("html"))
    firsts = keyed.groupBy("_sha").agg(F.max("page_id").alias("_keeper"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    firsts = small(saved(firsts, "payload-keepers"))

    def run(batches):
        for b in batches:
            out = []
            for page, url, html, keeper in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                out.append(squeeze(record(page, url, html.encode(), None if keeper is None or keeper == page else keeper)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    rows = keyed.join(firsts, "_sha", "left").select("page_id", "url", "html", "_keeper")
    rows.mapInArrow(run, "member binary").select(F.col("member").cast("string")).write.option("lineSep", PAD.decode()).text(path)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), "content")


def captures(spark: SparkSession, path: str) -> DataFrame:
    """(key, page_id, file, offset, length): one capture for each record, found by reading the archives through."""
    names = ["key", "page_id", "file", "offset", "length"]

    def run(batches):
        for b in batches:
            for file in b.column(0).to_pylist():
                rows: list[tuple] = []
                with opened(file) as stream:
                    for offset, length, raw in members(stream):
                        fields, _, _ = parse(raw)
                        rows.append((url_key(fields["WARC-Target-URI"]), page_of(fields["WARC-Record-ID"]), file, offset, length))
                        if len(rows) == 10_000:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    def batch(rows):
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return files.mapInArrow(run, "key string, page_id long, file string, offset long, length long")


def index_blocks(found: DataFrame) -> DataFrame:
    """(first, last, block, lines): captures sorted by (key, page), BLOCK_LINES to a compressed block.

    first and last are the sort keys that bound a block; block is its name.
    """
    line = F.concat_ws("\t", F.col("key"), F.coalesce(F.lpad(F.col("page_id").cast("string"), 20, "0"), F.lit("-")))
    ordered = found.withColumn("entry", line).repartitionByRange("entry").sortWithinPartitions("entry", "file", "offset")

    def run(batches):
        held: list[tuple] = []

        def block(lines):
            text = "\n".join("\t".join(map(str, x)) for x in lines).encode()
            first, last = lines[0][0], lines[-1][0]
            name = hashlib.sha1(first.encode() + text).hexdigest()
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (first, last, name)] + [pa.array([squeeze(text, 6)], pa.binary())], ["first", "last", "block", "lines"])

        for b in batches:
            held += zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)
            while len(held) >= BLOCK_LINES:
                yield block(held[:BLOCK_LINES])
                held = held[BLOCK_LINES:]
        if held:
            yield block(held)

    return ordered.select("entry", "file", "offset", "length").mapInArrow(run, "first string, last string, block string, lines binary")


def look_up(wanted: DataFrame, blocks: DataFrame) -> DataFrame:
    """(entry, file, offset, length) of the captures of wanted entries: directory, then block, then line, by binary search.

    The directory has the first entry of every block, or of one in so many that it keeps to about DIRECTORY entries; the
    blocks from one directory entry to the next are a group. Entries and blocks meet by group.
    """
    spark = wanted.sparkSession
    step = max(1, -(-blocks.count() // DIRECTORY))
    kept = blocks.where(F.pmod(F.xxhash64("block"), F.lit(step)) == 0).select("first").union(blocks.agg(F.min("first")).where("`min(first)` IS NOT NULL")).distinct()
    held = spark.sparkContext.broadcast(sorted(r["first"] for r in kept.collect()))

    def locate(batches):
        firsts = held.value
        for b in batches:
            groups, keys = [], []
            for entry in b.column(0).to_pylist():
                at = bisect.bisect_right(firsts, entry) - 1
                if at >= 0:
                    groups.append(at)
                    keys.append(entry)
                if at > 0 and firsts[at] == entry:  # equal entries may begin in the group before
                    groups.append(at - 1)
                    keys.append(entry)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(groups, pa.int32())], ["entry", "group"])

    def grouped(batches):
        for b in batches:
            at = [bisect.bisect_right(held.value, x) - 1 for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], ["first", "last", "lines", "group"])

    def search(entries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        rows = []
        wanted = sorted(set(entries["entry"]))
        for first, last, text in zip(block["first"], block["last"], block["lines"], strict=True):
            inside = wanted[bisect.bisect_left(wanted, first) : bisect.bisect_right(wanted, last)]
            lines = gzip.decompress(text).decode().split("\n") if inside else []
            for entry in inside:
                at = bisect.bisect_left(lines, entry + "\t")
                while at < len(lines) and lines[at].startswith(entry + "\t"):
                    _, file, offset, length = lines[at].rsplit("\t", 3)
                    rows.append((entry, file, int(offset), int(length)))
                    at += 1
        return pd.DataFrame(rows, columns=["entry", "file", "offset", "length"])

    places = wanted.mapInArrow(locate, "entry string, group int")
    dealt = blocks.select("first", "last", "lines").mapInArrow(grouped, "first string, last string, lines binary, group int")
    return places.groupBy("group").cogroup(dealt.groupBy("group")).applyInPandas(search, "entry string, file string, offset long, length long")


def read_ranges(places: DataFrame) -> DataFrame:
    """The records at (file, offset, length), each read by itself from its range; ranges of a file are read in order.

    A task reads about RANGES bytes, as the rows that say what to read are far smaller than what is read.
    """
    parts = max(1, -(-(places.agg(F.sum("length")).first()[0] or 0) // RANGES))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches):
        name, stream = None, None
        try:
            for b in batches:
                rows = []
                for file, offset, length in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                    if file != name:
                        if stream is not None:
                            stream.close()
                        name, stream = file, opened(file)
                    fields, http, payload = parse(gzip.decompress(stream.read_at(length, offset)))
                    whole = fields["WARC-Type"] == "response"
                    size = len(payload) if whole else int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = digest_of(payload) if whole else fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    rows.append((page_of(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], None if whole else page_of(fields["WARC-Refers-To"])))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                columns = zip(*rows, strict=True) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        finally:
            if stream is not None:
                stream.close()

    dealt = places.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.select("file", "offset", "length").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages as WARC archives, indexes them, and reads every capture back through the index.

    Null html is an empty payload; equal payloads are one response and its revisits; repeated rows are records each, and
    those of the largest page_id are all responses. A null url gets the page's own name, a null page_id none.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "archives")
    write_archives(pages, path)
    found = saved(captures(spark, path), "captures")
    blocks = saved(index_blocks(found), "index-blocks")
    entry = F.concat_ws("\t", F.col("key"), F.coalesce(F.lpad(F.col("page_id").cast("string"), 20, "0"), F.lit("-")))
    wanted = found.select(entry.alias("entry")).distinct()
    return read_ranges(saved(look_up(wanted, blocks), "places"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read(spark, sf_dir, "pages"))


QUERIES = {"op5_warc": op5_warc}

#: Five hexadecimal digits of the digest make four characters of base 32.
_LETTERS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(sha, {5 * i + 1}, 5) AS BIGINT) >> {s}) & 31 AS INTEGER) + 1, 1)" for i in range(8) for s in (15, 10, 5, 0))

ORACLES = {
    "op5_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS keeper FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_LETTERS} AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM k
"""
}
