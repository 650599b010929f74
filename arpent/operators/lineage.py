"""Checkpoints for loops, and places for tables between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one is set where it is unset, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="spark-arpent-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read again. Unlike a checkpoint it also forgets what the optimiser has
    inferred about the rows, which grows from round to round in loops of joins."""
    path = fresh_path(df.sparkSession, "step")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
