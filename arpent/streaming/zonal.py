"""Zonal aggregates of a stream of located observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arpent.operators.joins import points_in_boxes


def windowed_zonal_stats(observations: DataFrame, zones: DataFrame, value: str, ts: str, every: str, late: str, size: float, key: str = "fid") -> DataFrame:
    """(window, zone, n, mean, least, most) of observations (x, y, value, ts), for each zone and time window.

    Observations meet the zones' cells in a stream-static join, so a late or replayed row is treated as any other;
    windows close when the watermark passes. It also runs on a batch.
    """
    seen = observations.select("x", "y", F.col(value).alias("value"), F.col(ts).alias("ts")).withWatermark("ts", late)
    held = points_in_boxes(seen, zones.select(key, "xmin", "ymin", "xmax", "ymax"), size)
    return held.groupBy(F.window("p_ts", every).alias("window"), F.col(f"b_{key}").alias(key)).agg(
        F.count("*").alias("n"), F.avg("p_value").alias("mean"), F.min("p_value").alias("least"), F.max("p_value").alias("most")
    )
