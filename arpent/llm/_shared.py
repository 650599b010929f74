"""Helpers of the training-data operators: tables in the shared folder, exact row numbers, components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tables of at most this many narrow rows may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 400_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only where it is unset (tests) a new temporary one, which is then set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="spark-arpent-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Writes df once as Parquet in the shared folder and reads it again: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it is counted to have few rows; else df, for a shuffled join. Give it saved tables."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def numbered(df: DataFrame, group: str, order: list[str], name: str = "rank") -> DataFrame:
    """Adds the number of each row within its group, gapless from 0, in the given order, without gathering a group.

    Rows are range-partitioned by (group, order), numbered along each partition, saved, and moved on by the counts of
    the partitions before. Those counts have one row per partition and group that meet: partitions + groups at most.
    group is an integer column without nulls. Rows alike in group and order get numbers in any order.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_local", T.LongType())])

    def along(batches):
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            g = pdf[group].to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1])
            local = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
            if last is not None and g[0] == last:
                local[: starts[1] if len(starts) > 1 else len(g)] += seen
            last, seen = g[-1], int(local[-1]) + 1
            yield pdf.assign(_part=np.int32(part), _local=local)

    rows = saved(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).mapInPandas(along, schema), name)
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_part", group).agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(small(saved(offsets, "offsets")), ["_part", group]).withColumn(name, F.col("_local") + F.col("_before")).drop("_part", "_local", "_before")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that links reach, for each node of edges (a, b), which are longs.

    Large-star and small-star steps by turns; each step is one grouped minimum and one join, saved, until none changes.
    Minima of few edges are broadcast; steps make no more edges than there were.
    """
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(now)
    hint = F.broadcast if 2 * mark[0] <= BROADCAST_ROWS else lambda df: df
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(hint(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = saved(large.where("a <> b").distinct(), "links")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        stars = down.join(hint(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        new = saved(stars.where("a <> b").distinct().select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
        before, now, mark = mark, new, _mark(new)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b"), F.col("b")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free hash of the edges."""
    x = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(x)


def utf8_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
