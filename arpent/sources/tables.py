"""CSV, text and JDBC tables, label reallocation tables and matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv_table(spark: SparkSession, path: str, schema: str, delimiter: str = ",") -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, sep=delimiter)


def write_csv_table(df: DataFrame, path: str, delimiter: str = ",") -> None:
    df.write.mode("overwrite").csv(path, header=True, sep=delimiter)


def read_jdbc_layer(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.jdbc(url, table, properties=options)


def write_jdbc_layer(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.jdbc(url, table, mode="append", properties=options)


def reallocation_table(rows: DataFrame) -> DataFrame:
    """(class, action, target, n) from text rows class;target[;n]: -1 deletes, -2 splits in n parts (3 unless given), A and
    D are left out, any other target relabels."""
    part = F.split("value", ";")
    get = lambda i: F.trim(F.try_element_at(part, F.lit(i)))
    t = rows.select(get(1).try_cast("int").alias("class"), get(2).alias("_t"), get(3).try_cast("int").alias("_n")).where("class IS NOT NULL AND _t NOT IN ('A', 'D')")
    action = F.when(F.col("_t") == "-1", "delete").when(F.col("_t") == "-2", "split").otherwise("relabel")
    return t.select("class", action.alias("action"), F.when(action == "relabel", F.col("_t").try_cast("int")).alias("target"), F.when(action == "split", F.coalesce("_n", F.lit(3))).alias("n"))


def confusion_from_text(lines: DataFrame) -> DataFrame:
    """(ref, prod, n) from numbered lines (no, value): reference labels, produced labels, then rows of counts."""
    labels = lambda no, name: lines.where(F.col("no") == no).select(F.posexplode(F.split(F.regexp_replace("value", "^.*:", ""), ",")).alias("i", name))
    cells = lines.where("no >= 2 AND trim(value) <> ''").select((F.col("no") - 2).alias("r"), F.posexplode(F.split("value", ",")).alias("c", "n"))
    refs = labels(0, "ref").withColumnRenamed("i", "r")
    prods = labels(1, "prod").withColumnRenamed("i", "c")
    out = cells.join(F.broadcast(refs), "r").join(F.broadcast(prods), "c")  # a row for each class
    return out.select(F.trim("ref").cast("int").alias("ref"), F.trim("prod").cast("int").alias("prod"), F.trim("n").cast("double").alias("n"))


def centroids_from_text(lines: DataFrame) -> DataFrame:
    """(macro, micro, dim, value) from lines of (macro, value): micro label, then its centroid."""
    part = F.split(F.trim("value"), "[ ,;]+")
    return lines.select("macro", F.element_at(part, 1).cast("int").alias("micro"), F.posexplode(F.slice(part, F.lit(2), F.greatest(F.size(part) - 1, F.lit(0)))).alias("dim", "_v")).select("macro", "micro", "dim", F.col("_v").cast("double").alias("value"))


def quality_report(matrix_indicators: DataFrame, indicators: list[str]) -> DataFrame:
    """One row per indicator, one column per class."""
    long = matrix_indicators.unpivot(["cls"], indicators, "indicator", "value")
    return long.groupBy("indicator").pivot("cls").agg(F.first("value"))


def partition_by_attribute(df: DataFrame, field: str, path: str) -> None:
    df.write.mode("overwrite").partitionBy(field).parquet(path)
