"""Aggregates of pixels by zone, and other summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arpent.functions.geometry import contains
from arpent.operators.joins import intersection_overlay, points_in_boxes

#: Statistics of a zone's valid pixels, by name.
STATS = {
    "count": lambda v: F.count(v),
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "sum": F.sum,
    "std": F.stddev_pop,
    "median": lambda v: F.percentile(v, 0.5),
    "unique": F.count_distinct,
    "range": lambda v: F.max(v) - F.min(v),
}


def pixels_of(zones: DataFrame, px: DataFrame, band: str, size: float, key: str = "fid") -> DataFrame:
    """(zone key, value) of the pixels whose centre lies in the zone: its box, or its `rings` where it has them."""
    shape = ["rings"] if "rings" in zones.columns else []
    hit = points_in_boxes(px.select("x", "y", F.col(band).alias("value")), zones.select(key, "xmin", "ymin", "xmax", "ymax", *shape), size)
    if shape:
        hit = hit.where(contains(F.col("b_rings"), F.col("p_x"), F.col("p_y")))
    return hit.select(F.col(f"b_{key}").alias(key), F.col("p_value").alias("value"))


def zonal_stats(zones: DataFrame, px: DataFrame, band: str, stats: tuple[str, ...] = ("count", "min", "max", "mean"), size: float = 25.0, nodata: float | None = None, key: str = "fid") -> DataFrame:
    """zones with statistics of their pixels. A zone without valid pixels has count 0 and nulls.

    Sums are taken per map task before rows move. majority and minority take the smallest value of ties; percentile_q is
    interpolated; nodata counts the zone's nodata pixels.
    """
    held = pixels_of(zones, px, band, size, key)
    valid = F.col("value") if nodata is None else F.when(F.col("value") != nodata, F.col("value"))
    held = held.withColumn("value", valid)
    aggs = []
    for s in stats:
        if s in STATS:
            aggs.append(STATS[s]("value").alias(s))
        elif s.startswith("percentile_"):
            aggs.append(F.percentile("value", float(s.removeprefix("percentile_")) / 100).alias(s))
        elif s == "nodata":
            aggs.append(F.count(F.when(F.col("value").isNull(), 1)).alias(s))
    out = zones.join(held.groupBy(key).agg(*(aggs or [F.count("value").alias("_n")])).drop("_n"), key, "left")
    for s in {"majority", "minority"} & set(stats):
        counts = held.where("value IS NOT NULL").groupBy(key, "value").count()
        n = F.col("count") if s == "minority" else -F.col("count")
        out = out.join(counts.groupBy(key).agg(F.min(F.struct(n.alias("n"), "value"))["value"].alias(s)), key, "left")
    zero = [c for c in ("count", "unique", "nodata") if c in stats]
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})


def zonal_shares(zones: DataFrame, px: DataFrame, band: str, labels: dict[int, str], size: float = 25.0, key: str = "fid", pixel_area: float = 1.0, areas: bool = False) -> DataFrame:
    """zones with the share (%) of each label among their pixels, absent ones 0; codes of one label are summed."""
    held = pixels_of(zones, px, band, size, key)
    names = list(dict.fromkeys(labels.values()))
    n = {m: F.count(F.when(F.col("value").isin([k for k, v in labels.items() if v == m]), 1)) for m in names}
    columns = [F.coalesce(F.try_divide(100.0 * n[m], F.count("value")), F.lit(0.0)).alias(m) for m in names]
    columns += [(n[m] * pixel_area).alias(f"S_{m}") for m in names] if areas else []
    out = zones.join(held.groupBy(key).agg(*columns), key, "left")
    return out.withColumns({m: F.coalesce(m, F.lit(0.0)) for m in names + [f"S_{m}" for m in names if areas]})


def zonal_stats_area_weighted(zones: DataFrame, px: DataFrame, band: str, size: float = 25.0, half: float = 0.5, key: str = "fid") -> DataFrame:
    """(zone, value, area, share): overlap area of pixel squares and zone for each value, and % of the zone's area."""
    cells = px.select(F.col(band).alias("value"), (F.col("x") - half).alias("xmin"), (F.col("y") - half).alias("ymin"), (F.col("x") + half).alias("xmax"), (F.col("y") + half).alias("ymax"))
    pieces = intersection_overlay(zones.select(key, "xmin", "ymin", "xmax", "ymax"), cells, size)
    whole = (F.col("a_xmax") - F.col("a_xmin")) * (F.col("a_ymax") - F.col("a_ymin"))
    return pieces.groupBy(F.col(f"a_{key}").alias(key), F.col("b_value").alias("value")).agg(F.sum("area").alias("area"), (100 * F.sum("area") / F.first(whole)).alias("share"))


def band_statistics(px: DataFrame, bands: list[str], nodata: float | None = None) -> DataFrame:
    """One row of (min, max, mean, std) per band."""
    v = {b: F.col(b) if nodata is None else F.when(F.col(b) != nodata, F.col(b)) for b in bands}
    wide = px.agg(*[f(v[b]).alias(f"{b}_{n}") for b in bands for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_pop))])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(b).alias("band"), *[F.col(f"{b}_{n}").alias(n) for n in ("min", "max", "mean", "std")]) for b in bands])))


def histogram(df: DataFrame, column: str, low: float, high: float, buckets: int) -> DataFrame:
    """(bucket, n) for buckets 1..n of equal width; 0 and n + 1 hold what lies outside."""
    return df.groupBy(F.width_bucket(column, F.lit(float(low)), F.lit(float(high)), F.lit(buckets)).cast("int").alias("bucket")).agg(F.count("*").alias("n"))


def allocate_by_weight(totals: DataFrame, pieces: DataFrame, src: str, dst: str, weight: str, total: str) -> DataFrame:
    """Totals by source spread over pieces in proportion to their weight, then summed by destination."""
    part = F.try_divide(F.col(weight), F.sum(weight).over(Window.partitionBy(src)))
    return pieces.withColumn("_part", part).join(totals, src).groupBy(dst).agg(F.sum(F.col("_part") * F.col(total)).alias("allocated"))


def volume_weighted_height(volume: Column, height: Column) -> Column:
    return F.try_divide(F.sum(volume * height), F.sum(volume))


def class_point_statistics(df: DataFrame, cls: str, bands: list[str]) -> DataFrame:
    """(class, band, n, mean, std) in long form, population std."""
    long = df.unpivot([cls], bands, "band", "value")
    return long.groupBy(cls, "band").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def mean_area_per_macro(df: DataFrame, micro: str, area: str) -> DataFrame:
    """Micro labels floored to 100: total area over the number of micro classes."""
    return df.groupBy((F.floor(F.col(micro) / 100) * 100).cast("int").alias("macro")).agg((F.sum(area) / F.count_distinct(micro)).alias("mean_area"))


def checksum_area(a: DataFrame, b: DataFrame, area: str, delta: float = 1.0) -> DataFrame:
    """(area_a, area_b, same): total areas and whether they differ by at most delta."""
    x, y = a.agg(F.sum(area).alias("area_a")), b.agg(F.sum(area).alias("area_b"))
    return x.join(F.broadcast(y)).withColumn("same", F.abs(F.col("area_a") - F.col("area_b")) <= delta)


def rare_classes(px: DataFrame, cls: str, percent: float) -> DataFrame:
    """(class, n) of classes with fewer pixels than percent of the mean class size."""
    counts = px.groupBy(cls).agg(F.count("*").alias("n"))
    mean = counts.agg(F.avg("n").alias("_m"))
    return counts.join(F.broadcast(mean)).where(F.col("n") < F.col("_m") * percent / 100).drop("_m")


def dominance(zones: DataFrame, px: DataFrame, band: str, size: float = 25.0, key: str = "fid") -> DataFrame:
    """Mean over zones of the share of the most frequent value, pixels over pixels."""
    counts = pixels_of(zones, px, band, size, key).groupBy(key, "value").count()
    per = counts.groupBy(key).agg((F.max("count") / F.sum("count")).alias("share"))
    return per.agg(F.avg("share").alias("dominance"))


def nodata_tile_filter(px: DataFrame, band: str, tile: int, nodata: float, percent: float) -> DataFrame:
    """(tx, ty, n, n_nodata) of tiles whose nodata stays under percent of their pixels."""
    t = px.groupBy(F.floor(F.col("c") / tile).alias("tx"), F.floor(F.col("r") / tile).alias("ty")).agg(F.count("*").alias("n"), F.count(F.when(F.col(band) == nodata, 1)).alias("n_nodata"))
    return t.where(100.0 * F.col("n_nodata") < percent * F.col("n"))


def region_labels(df: DataFrame, region: str, value: str, classes: list[int]) -> DataFrame:
    """(region, label): rounded mean, kept only where it is a real class and not 0."""
    return df.groupBy(region).agg(F.rint(F.avg(value)).cast("int").alias("label")).where(F.col("label").isin(classes) & (F.col("label") != 0))
