"""Map quality: confusion matrices in long form and indicators from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion_matrix(df: DataFrame, ref: str, prod: str, nodata: int = 0, by: list[str] | None = None) -> DataFrame:
    """(ref, prod, n) for every reference class and every class seen, absent pairs 0; nodata is left out."""
    by = by or []
    counts = df.where((F.col(ref) != nodata) & (F.col(prod) != nodata)).groupBy(*by, F.col(ref).alias("ref"), F.col(prod).alias("prod")).agg(F.count("*").alias("n"))
    refs = counts.select("ref").distinct()
    classes = refs.union(counts.select("prod")).distinct().withColumnRenamed("ref", "prod")
    grid = refs.join(F.broadcast(classes))  # classes are few
    grid = counts.select(*by).distinct().join(F.broadcast(grid)) if by else grid
    return grid.join(counts, [*by, "ref", "prod"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def class_indicators(matrix: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per class: precision, recall, f, performance TP/(TP+FP+FN), fp_rate, fn_rate (1 when empty) and quantity rate.

    fp_rate is FP over the pixels of other classes in the reference; fn_rate is FN over those of the class.
    """
    by = by or []
    rows = matrix.groupBy(*by, F.col("ref").alias("cls")).agg(F.sum("n").alias("row_n"), F.sum(F.when(F.col("ref") == F.col("prod"), F.col("n")).otherwise(0)).alias("tp"))
    cols = matrix.groupBy(*by, F.col("prod").alias("cls")).agg(F.sum("n").alias("col_n"))
    m = rows.join(cols, [*by, "cls"]).withColumn("fp", F.col("col_n") - F.col("tp")).withColumn("fn", F.col("row_n") - F.col("tp"))
    m = m.withColumn("all_n", F.sum("row_n").over(Window.partitionBy(*(by or [F.lit(1)]))))  # a row for each class
    safe = lambda a, b, empty: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(float(empty)))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = m.withColumns({"precision": safe(tp, tp + fp, 0), "recall": safe(tp, tp + fn, 0), "performance": safe(tp, tp + fp + fn, 0), "fp_rate": safe(fp, F.nullif(F.col("all_n") - F.col("row_n"), F.lit(0)), 1), "fn_rate": safe(fn, tp + fn, 1), "quantity_rate": safe(tp + fp, tp + fn, 0)})
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f", safe(2 * p * r, p + r, 0))


def overall_indicators(matrix: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Overall accuracy, weighted f and performance, and kappa."""
    by = by or []
    c = class_indicators(matrix, by)
    n, w = F.max("all_n"), F.col("row_n")
    union = F.col("tp") + F.col("fp") + F.col("fn")
    out = c.groupBy(*by).agg(
        (F.sum("tp") / n).alias("accuracy"), (F.sum(F.col("f") * w) / n).alias("f"), F.try_divide(F.sum(F.col("performance") * union), F.sum(union)).alias("performance"),
        (F.sum(w * F.col("col_n")) / (n * n)).alias("_chance"),
    )
    return out.withColumn("kappa", F.try_divide(F.col("accuracy") - F.col("_chance"), 1 - F.col("_chance"))).drop("_chance")


def grid_quality(px: DataFrame, ref: str, prod: str, cell: int) -> DataFrame:
    """Overall indicators for each cell of a grid."""
    celled = px.withColumn("gx", F.floor(F.col("c") / cell)).withColumn("gy", F.floor(F.col("r") / cell))
    return overall_indicators(confusion_matrix(celled, ref, prod, by=["gx", "gy"]), ["gx", "gy"])


def surface_accuracy(points: DataFrame, tolerance: float, low: float, high: float) -> DataFrame:
    """Of points with z and a sampled value within [low, high]: difference, and whether it is within the tolerance."""
    held = points.where(F.col("z").isNotNull() & F.col("value").between(low, high))
    return held.withColumn("difference", F.col("z") - F.col("value")).withColumn("within", F.abs(F.col("z") - F.col("value")) <= tolerance)
