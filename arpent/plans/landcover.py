"""Land-cover composition, checks and post-processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arpent.operators import joins as jn
from arpent.operators import zonal as zo
from arpent.operators.tables import apply_rules, cast_columns, correct_percent_rounding


def land_cover_indicators(zones: DataFrame, px: DataFrame, cls: str, height: str, groups: dict[int, str]) -> DataFrame:
    """Shares of the groups built, mineral, bare, water, high and low; veg, share of high in veg, mean and greatest height
    of vegetation, and veg_class: 1 below one metre, 2 below five, 3 from five on."""
    out = zo.zonal_shares(zones, px, cls, groups)
    green = [k for k, v in groups.items() if v in ("high", "low")]
    tall = zo.zonal_stats(zones.select("fid", *jn.BOX), px.where(F.col(cls).isin(green)), height, ("mean", "max")).select("fid", F.coalesce("mean", F.lit(0.0)).alias("veg_mean"), F.coalesce("max", F.lit(0.0)).alias("veg_max"))
    out = out.join(tall, "fid").withColumn("veg", F.col("high") + F.col("low")).withColumn("high_share", 100 * F.col("high") / (F.col("high") + F.col("low") + 1e-7))
    return out.withColumn("veg_class", apply_rules(F.lit(3), [(F.col("veg_mean") < 1, 1), (F.col("veg_mean") < 5, 2)]))


def verify_product(df: DataFrame, percents: list[str], rest: str) -> DataFrame:
    """Percent columns rounded to small integers, the rest column closed to 100, and `total` for a check."""
    out = correct_percent_rounding(cast_columns(df, dict.fromkeys(percents, "smallint"), tuple(percents)), percents, rest)
    return out.withColumn("total", sum((F.col(c) for c in percents), F.col(rest)))


def post_process(px: DataFrame, cls: str, rules: list[tuple[Column, int, int | None]]) -> DataFrame:
    """Rules one after another: under a mask, replace all, or one class, by a new class."""
    out = px
    for mask, new, only in rules:
        hit = mask if only is None else mask & (F.col(cls) == only)
        out = out.withColumn(cls, F.when(hit, F.lit(new)).otherwise(F.col(cls)))
    return out


def heights_with_buildings(px: DataFrame, height: str, buildings: DataFrame, size: float, threshold: float) -> DataFrame:
    """px with `height_`: the building's height where it differs from the raster's mean over it by more than a threshold."""
    seen = zo.zonal_stats(buildings, px, height, ("mean",), size=size).where(F.abs(F.col("hauteur") - F.col("mean")) > threshold)
    burned = jn.rasterize(seen, px, size, "hauteur", -1)
    return burned.withColumn("height_", F.when(F.col("burned") >= 0, F.col("burned")).otherwise(F.col(height))).drop("burned")


def overlay_classes(px: DataFrame, layers: list[tuple[DataFrame, int]], size: float) -> DataFrame:
    """px with `cover`: the class of the first layer, in list order, whose boxes hold the pixel, else 0."""
    out = px.withColumn("cover", F.lit(0))
    for boxes, cls in layers:
        hit = jn.points_in_boxes(px.select("pid", "x", "y"), boxes, size).select(F.col("p_pid").alias("pid")).distinct().withColumn("_h", F.lit(1))
        out = out.join(hit, "pid", "left").withColumn("cover", F.when((F.col("cover") == 0) & (F.col("_h") == 1), cls).otherwise(F.col("cover"))).drop("_h")
    return out


def regional_crossing(zones: DataFrame, px: DataFrame, cover: dict[int, str], date: str, source: str, labels: dict[int, str], cls: str = "cls") -> DataFrame:
    """Three zonal passes joined by id: cover shares, majority date, majority source with its label."""
    z = zones.select("fid", *jn.BOX)
    shares = zo.zonal_shares(z, px, cls, cover).select("fid", *dict.fromkeys(cover.values()))
    dates = zo.zonal_stats(z, px, date, ("majority",)).select("fid", F.col("majority").alias("update"))
    sources = zo.zonal_stats(z, px, source, ("majority",)).select("fid", F.col("majority").alias("_s"))
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in labels.items():
        label = label.when(F.col("_s") == k, v)
    return shares.join(dates, "fid").join(sources, "fid").withColumn("source", label).drop("_s")


def climate_inputs(zones: DataFrame, buildings: DataFrame, codes: list[int], least_area: float, study: tuple[float, float, float, float], pad: float, size: float) -> tuple[DataFrame, DataFrame]:
    """Zones of the codes, clipped to the study box, over an area, numbered anew; buildings that meet the padded box."""
    x0, y0, x1, y1 = study
    z = zones.where(F.col("zoning").isin(codes)).withColumns({"xmin": F.greatest("xmin", F.lit(float(x0))), "ymin": F.greatest("ymin", F.lit(float(y0))), "xmax": F.least("xmax", F.lit(float(x1))), "ymax": F.least("ymax", F.lit(float(y1)))})
    z = z.where((F.col("xmax") > F.col("xmin")) & (F.col("ymax") > F.col("ymin"))).where((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")) >= least_area)
    names = {c: c for c in buildings.columns}
    return z, jn.filter_and_rename(buildings, study, names, pad)


def buildable_plots(plots: DataFrame, free_least: float, built_least: float) -> DataFrame:
    """Plots with `buildable`: by zoning type, size rules for free and built plots, and the flood plan's majority.

    plots: area, built (share %), zone ('U', 'AU', ...), red and blue (shares % of the flood plan).
    """
    big = F.when(F.col("built") > 0, F.col("area") >= built_least).otherwise(F.col("area") >= free_least)
    flood = F.when(F.col("red") > 50, "red").when(F.col("blue") > 50, "blue").otherwise("other")
    out = plots.withColumn("flood", flood)
    return out.withColumn("buildable", F.when(F.col("flood") == "red", "no").when(~F.col("zone").isin("U", "AU"), "no").when(~big, "no").when(F.col("flood") == "blue", "with conditions").otherwise("yes"))


def frontal_area(lines: DataFrame, buildings: DataFrame, zones: DataFrame, size: float, spacing: float) -> DataFrame:
    """(fid, far): along lines at a spacing, each piece stands for spacing x the greatest height that it meets; over the
    zone's area. lines are thin boxes with an id."""
    met = jn.box_join(lines, buildings, size, closed=True).groupBy(F.col("a_fid").alias("line")).agg(F.max("b_hauteur").alias("h"))
    pieces = lines.join(met, lines["fid"] == met["line"]).select(lines["fid"], *[lines[c] for c in jn.BOX], "h")
    in_zone = jn.box_join(zones, pieces, size, closed=True).where("b_xmin >= a_xmin AND b_xmax <= a_xmax AND b_ymin >= a_ymin AND b_ymax <= a_ymax")
    whole = (F.col("a_xmax") - F.col("a_xmin")) * (F.col("a_ymax") - F.col("a_ymin"))
    return in_zone.groupBy(F.col("a_fid").alias("fid")).agg((F.sum(F.col("b_h") * spacing) / F.first(whole)).alias("far"))


def segmentation_score(df: DataFrame, targets: dict[str, tuple[float, float]]) -> DataFrame:
    """Weighted squared relative error of measures against (target, weight)."""
    error = sum((w * F.pow((F.col(c) - t) / t, F.lit(2)) for c, (t, w) in targets.items()), F.lit(0.0))
    return df.withColumn("score", error)
