"""Sharding by a k-d tree: nodes split at distributed weighted medians along their widest metadata dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arpent.llm._shared import numbered, read, saved, utf8_size

#: Buckets of each of the three histograms that find a median: of values, within one bucket of values, of a row hash.
BUCKETS = 4096


def dimensions() -> dict[str, Column]:
    """The metadata dimensions of documents as numbers: categories lie where their hash falls, nulls lie at 0."""
    return {
        "source": F.crc32(F.coalesce(F.col("source"), F.lit(""))).cast("double"),
        "length": F.log1p(F.greatest(F.coalesce(F.col("n_chars"), F.lit(0)), F.lit(0)).cast("double")),
        "lang": F.crc32(F.coalesce(F.col("lang"), F.lit(""))).cast("double"),
        "id": F.coalesce(F.col("doc_id"), F.lit(0)).cast("double"),
    }


def kd_shards(rows: DataFrame, axes: list[str], size: str, tie: str, *, target_bytes: float | None = None, leaves: int | None = None) -> DataFrame:
    """Adds shard (int, from 0): the leaf of a k-d tree that a row falls in; leaves have sizes near the target.

    A node of k target sizes is cut at floor(k/2)/k of its weight along the axis on which it is widest, measured against
    the whole table's extent. A cut is found by three sums by bucket (values, values within one bucket, row hashes), so
    ties on the axis are shared out by the hash in `tie` and one row's size bounds the error. Only one row per node
    is gathered for a cut. Give a saved table without nulls in these columns. An empty table gives no rows.
    """
    total = rows.agg(F.sum(size)).first()[0] or 0
    k = leaves or max(1, round(total / target_bytes))
    widths = rows.agg(*[F.max(a) - F.min(a) for a in axes]).first()
    extents = [float(w or 0) or 1.0 for w in widths]
    now, most = rows.withColumn("shard", F.lit(0)).withColumn("_k", F.lit(k)), k
    while most > 1:
        now, most = _halve(now, axes, extents, size, tie), (most + 1) // 2
    return now.drop("_k")


def _halve(now: DataFrame, axes: list[str], extents: list[float], size: str, tie: str) -> DataFrame:
    """One level: every node of more than one target size is cut in two."""
    open_ = now.where("_k > 1")
    wide = F.array(*[(F.max(a) - F.min(a)) / F.lit(w) for a, w in zip(axes, extents, strict=True)])
    nodes = open_.groupBy("shard", "_k").agg(F.sum(size).alias("_all"), wide.alias("_wide"), F.array(*[F.min(a) for a in axes]).alias("_lows"), F.array(*[F.max(a) for a in axes]).alias("_highs"))
    axis = F.array_position("_wide", F.array_max("_wide")).cast("int")
    nodes = nodes.withColumn("_axis", axis).select(
        "shard", "_axis", F.element_at("_lows", F.col("_axis")).alias("_low"), F.element_at("_highs", F.col("_axis")).alias("_high"),
        (F.col("_all") * F.floor(F.col("_k") / 2) / F.col("_k")).alias("_goal"),
    )
    cuts = saved(nodes, "kd-nodes")

    def placed(df: DataFrame, cuts: DataFrame) -> DataFrame:
        value = F.element_at(F.array(*axes), F.col("_axis"))
        fine = F.when(F.col("_high") > F.col("_low"), (value - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(0.0) * BUCKETS
        df = df.join(F.broadcast(cuts), "shard", "left").withColumn("_fine", fine)  # one row per node
        df = df.withColumn("_b1", F.least(F.lit(BUCKETS - 1), F.floor("_fine")))
        return df.withColumn("_b2", F.least(F.lit(BUCKETS - 1), F.floor((F.col("_fine") - F.col("_b1")) * BUCKETS))).withColumn("_b3", F.pmod(tie, F.lit(BUCKETS)))

    for i, held in ((1, "true"), (2, "_b1 = _c1"), (3, "_b1 = _c1 AND _b2 = _c2")):
        sums = placed(open_, cuts).where(held).groupBy("shard", f"_b{i}").agg(F.sum(size).alias("_s"))
        upto = Window.partitionBy("shard").orderBy(f"_b{i}")
        sums = sums.withColumn("_upto", F.sum("_s").over(upto)).join(F.broadcast(cuts), "shard")
        found = sums.where("_upto >= _goal").groupBy("shard").agg(F.min(F.struct(f"_b{i}", F.col("_upto"), F.col("_s"))).alias("_x"))
        cuts = cuts.join(F.broadcast(found), "shard").withColumn(f"_c{i}", F.col(f"_x._b{i}"))
        if i == 3:  # the bucket goes to the side that its weight fits better
            cuts = cuts.withColumn("_c3", F.col("_c3") + (F.col("_x._upto") - F.col("_goal") <= F.col("_x._s") / 2).cast("int"))
        else:
            cuts = cuts.withColumn("_goal", F.col("_goal") - (F.col("_x._upto") - F.col("_x._s")))
        cuts = saved(cuts.drop("_x"), "kd-cuts")
    right = F.struct("_b1", "_b2", "_b3") >= F.struct("_c1", "_c2", "_c3")
    half = F.floor(F.col("_k") / 2).cast("int")
    moved = placed(now, cuts).withColumn("_right", F.coalesce(right, F.lit(False)) & (F.col("_k") > 1))
    moved = moved.withColumn("shard", F.when(F.col("_right"), F.col("shard") + half).otherwise(F.col("shard")))
    return moved.withColumn("_k", F.when(F.col("_right"), F.col("_k") - half).when(F.col("_k") > 1, half).otherwise(F.col("_k"))).select(*now.columns)


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """documents in k-d tree shards of near equal bytes: the contract's columns of op2.

    Null text: size 1, checksum of no bytes. Null metadata lie at 0 of their axis. Rows alike in id and text share a tie
    hash and go together. The method keeps no group of equal texts together, as a hot group would unbalance the shards.
    """
    axes = dimensions()
    rows = docs.select(
        "doc_id", (utf8_size() + 1).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), *[c.alias(f"_{a}") for a, c in axes.items()]
    ).withColumn("_tie", F.xxhash64("doc_id", "text_crc32", "size"))
    placed = kd_shards(saved(rows, "kd-rows"), [f"_{a}" for a in axes], "size", "_tie", leaves=shards)
    placed = placed.select("doc_id", "size", "text_crc32", "shard", "_tie")
    out = numbered(placed, "shard", ["_tie", "doc_id", "size"], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"))


QUERIES = {"op2_kd_sharding": op2_kd_sharding}
ORACLES: dict[str, str] = {}
