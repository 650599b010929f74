import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from arpent.llm import sharding
from arpent.llm._shared import components, numbered


def check(rows, docs, shards=16):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = sharding.op2_kd_sharding(spark, sf).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, docs)
    held = Counter()
    for r in rows:
        held[r["shard"]] += r["size"]
    mean = sum(held.values()) / 16
    assert len(held) == 16 and max(held.values()) < 1.1 * mean and min(held.values()) > 0.9 * mean


def test_odd_rows_and_no_rows(odd, no_docs):
    check(sharding.shard_documents(odd.withColumn("shard", F.lit("x"))).collect(), odd.select("doc_id", "text").collect())
    assert sharding.shard_documents(no_docs).count() == 0


def test_target_bytes_set_the_number_of_leaves(spark):
    rows = spark.range(1000).select(F.col("id"), F.lit(10).cast("long").alias("size"), (F.col("id") % 7).cast("double").alias("a"), F.rand(1).alias("b"), F.xxhash64("id").alias("tie"))
    out = sharding.kd_shards(sharding.saved(rows, "t"), ["a", "b"], "size", "tie", target_bytes=2000).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(out) == 5 and all(1900 <= r["s"] <= 2100 for r in out)


def test_numbers_are_gapless_and_ordered(spark):
    df = spark.range(500).select((F.col("id") % 3).cast("int").alias("g"), F.xxhash64("id").alias("k"))
    got = numbered(df, "g", ["k"], "n").collect()
    for g in range(3):
        rows = sorted((r["k"], r["n"]) for r in got if r["g"] == g)
        assert [n for _, n in rows] == list(range(len(rows)))


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 230)] + [(-5, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in [7, *range(200, 230)]} == {-5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
