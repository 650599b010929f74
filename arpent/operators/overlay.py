"""Overlay of boxes: differences, priority and splitting. The join cuts the candidates; a NumPy kernel works on one feature."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arpent.operators.joins import BOX, box_join


def pieces_outside(box: tuple, covers: np.ndarray) -> list[tuple[float, float, float, float]]:
    """Disjoint boxes that make up a box less the union of others: cells between all edges, joined along x."""
    x0, y0, x1, y1 = box
    xs = np.unique(np.clip(np.concatenate([[x0, x1], covers[:, 0], covers[:, 2]]), x0, x1))
    ys = np.unique(np.clip(np.concatenate([[y0, y1], covers[:, 1], covers[:, 3]]), y0, y1))
    out = []
    for a, b in zip(ys[:-1], ys[1:], strict=True):
        row = covers[(covers[:, 1] <= a) & (covers[:, 3] >= b)]
        free = np.array([not ((row[:, 0] <= u) & (row[:, 2] >= v)).any() for u, v in zip(xs[:-1], xs[1:], strict=True)])
        edges = np.diff(np.concatenate([[0], free.astype(np.int8), [0]]))
        out += [(float(xs[i]), float(a), float(xs[j]), float(b)) for i, j in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)]
    return out


def difference_overlay(a: DataFrame, b: DataFrame, size: float, key: str = "fid", where: str | None = None) -> DataFrame:
    """(key, xmin, ymin, xmax, ymax): pieces of each box of a outside the union of b's; where limits the pairs.

    Boxes that meet none pass by untouched. A group is one feature with those that meet it.
    """
    pairs = box_join(a.select(key, *BOX), b.select(key, *BOX), size)
    pairs = pairs.where(where) if where else pairs

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        own = tuple(pdf[[f"a_{c}" for c in BOX]].iloc[0])
        found = pieces_outside(own, pdf[[f"b_{c}" for c in BOX]].to_numpy(float))
        return pd.DataFrame([(pdf[f"a_{key}"].iloc[0], *f) for f in found], columns=[key, *BOX])

    met = pairs.groupBy(f"a_{key}").applyInPandas(cut, f"{key} {a.schema[key].dataType.simpleString()}, xmin double, ymin double, xmax double, ymax double")
    return met.unionByName(a.select(key, *BOX).join(pairs.select(F.col(f"a_{key}").alias(key)).distinct(), key, "left_anti"))


def priority_remove_overlaps(df: DataFrame, size: float, least: float = 0.0, key: str = "fid") -> DataFrame:
    """Pieces of each box outside those of later keys; features left with no more than `least` area go."""
    out = difference_overlay(df, df, size, key, f"b_{key} > a_{key}").withColumn("_s", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")))
    total = out.groupBy(key).agg(F.sum("_s").alias("_t")).where(F.col("_t") > least).select(key)
    return out.join(total, key, "left_semi").drop("_s")


def subdivide(df: DataFrame, size: float) -> DataFrame:
    """Boxes cut at the lines of a grid, so that no piece is larger than a cell."""
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.greatest(F.floor(F.col(a) / size), F.ceil(F.col(b) / size) - 1)))
    t = df.withColumn("_i", span("xmin", "xmax")).withColumn("_j", span("ymin", "ymax"))
    return t.withColumns({"xmin": F.greatest("xmin", F.col("_i") * size), "xmax": F.least("xmax", (F.col("_i") + 1) * size), "ymin": F.greatest("ymin", F.col("_j") * size), "ymax": F.least("ymax", (F.col("_j") + 1) * size)}).drop("_i", "_j")


def split_by_vertical_lines(df: DataFrame, lines: DataFrame, size: float, key: str = "fid") -> DataFrame:
    """(key, k, box): boxes cut by the vertical lines (x, y1, y2) that cross them from bottom to top."""
    cut = lines.select(F.monotonically_increasing_id().alias("fid"), F.col("x").alias("xmin"), F.least("y1", "y2").alias("ymin"), F.col("x").alias("xmax"), F.greatest("y1", "y2").alias("ymax"))
    pairs = box_join(df.select(key, *BOX), cut, size, closed=True).where("b_xmin > a_xmin AND b_xmin < a_xmax AND b_ymin <= a_ymin AND b_ymax >= a_ymax")
    at = pairs.groupBy(F.col(f"a_{key}").alias(key)).agg(F.collect_set("b_xmin").alias("_x"))
    out = df.select(key, *BOX).join(at, key, "left").withColumn("_e", F.array_sort(F.concat(F.array("xmin", "xmax"), F.coalesce("_x", F.array().cast("array<double>")))))
    out = out.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("_e") - 1)))
    return out.select(key, "k", F.element_at("_e", F.col("k")).alias("xmin"), "ymin", F.element_at("_e", F.col("k") + 1).alias("xmax"), "ymax")
