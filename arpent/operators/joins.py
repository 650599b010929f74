"""Spatial joins: both sides are put on a grid of cells, equal cells meet, and the exact predicate decides.

Boxes are (xmin, ymin, xmax, ymax) columns. A pair of boxes is emitted only in the cell that holds the lower left corner of
their overlap, so no distinct step follows. Cells are hashed, so a crowded cell is a skewed key that adaptive joins split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arpent.operators.lineage import settle

BOX = ("xmin", "ymin", "xmax", "ymax")


def on_cells(df: DataFrame, size: float, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> DataFrame:
    """A row for each cell (_cx, _cy) that a box meets."""
    span = lambda a, b: F.sequence(F.floor(a / size), F.floor(b / size))
    return df.withColumn("_cx", F.explode(span(xmin, xmax))).withColumn("_cy", F.explode(span(ymin, ymax)))


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def box_join(a: DataFrame, b: DataFrame, size: float, pad: float = 0.0, closed: bool = False) -> DataFrame:
    """Pairs whose boxes overlap (or touch, if closed), a's grown by pad; columns are prefixed a_ and b_."""
    a, b = _named(a, "a"), _named(b, "b")
    ax, ay, au, av = F.col("a_xmin") - pad, F.col("a_ymin") - pad, F.col("a_xmax") + pad, F.col("a_ymax") + pad
    bx, by, bu, bv = (F.col(f"b_{c}") for c in BOX)
    left, right = on_cells(a, size, ax, ay, au, av), on_cells(b, size, bx, by, bu, bv)
    meets = (ax <= bu) & (bx <= au) & (ay <= bv) & (by <= av) if closed else (ax < bu) & (bx < au) & (ay < bv) & (by < av)
    corner = (F.floor(F.greatest(ax, bx) / size) == F.col("_cx")) & (F.floor(F.greatest(ay, by) / size) == F.col("_cy"))
    return left.join(right, ["_cx", "_cy"]).where(meets & corner).drop("_cx", "_cy")


def overlap_area() -> Column:
    """Area shared by the boxes of a pair from box_join."""
    w = F.least("a_xmax", "b_xmax") - F.greatest("a_xmin", "b_xmin")
    h = F.least("a_ymax", "b_ymax") - F.greatest("a_ymin", "b_ymin")
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def intersection_overlay(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """One row per meeting pair with the box and area of the intersection."""
    pairs = box_join(a, b, size)
    box = {"xmin": F.greatest("a_xmin", "b_xmin"), "ymin": F.greatest("a_ymin", "b_ymin"), "xmax": F.least("a_xmax", "b_xmax"), "ymax": F.least("a_ymax", "b_ymax")}
    return pairs.withColumns(box | {"area": overlap_area()})


def points_in_boxes(points: DataFrame, boxes: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """(p_*, b_*) where a point lies in a half-open box [min, max)."""
    p = _named(points, "p")
    p = p.withColumn("_cx", F.floor(F.col(f"p_{x}") / size)).withColumn("_cy", F.floor(F.col(f"p_{y}") / size))
    b = _named(boxes, "b")
    b = on_cells(b, size, *(F.col(f"b_{c}") for c in BOX))
    inside = (F.col(f"p_{x}") >= F.col("b_xmin")) & (F.col(f"p_{x}") < F.col("b_xmax")) & (F.col(f"p_{y}") >= F.col("b_ymin")) & (F.col(f"p_{y}") < F.col("b_ymax"))
    return p.join(b, ["_cx", "_cy"]).where(inside).drop("_cx", "_cy")


def holding(boxes: DataFrame, points: DataFrame, size: float, key: str = "fid") -> DataFrame:
    """Boxes that hold a point or more."""
    ids = points_in_boxes(points, boxes, size).select(F.col(f"b_{key}").alias(key)).distinct()
    return boxes.join(ids, key, "left_semi")


def delete_meeting(a: DataFrame, b: DataFrame, size: float, key: str = "fid") -> tuple[DataFrame, DataFrame]:
    """Both layers without the features that meet one of the other layer."""
    pairs = box_join(a, b, size)
    return (
        a.join(pairs.select(F.col(f"a_{key}").alias(key)).distinct(), key, "left_anti"),
        b.join(pairs.select(F.col(f"b_{key}").alias(key)).distinct(), key, "left_anti"),
    )


def box_distance() -> Column:
    """Least distance of the boxes of a pair."""
    dx = F.greatest(F.col("a_xmin") - F.col("b_xmax"), F.col("b_xmin") - F.col("a_xmax"), F.lit(0.0))
    dy = F.greatest(F.col("a_ymin") - F.col("b_ymax"), F.col("b_ymin") - F.col("a_ymax"), F.lit(0.0))
    return F.sqrt(dx * dx + dy * dy)


def within_distance(a: DataFrame, b: DataFrame, d: float, size: float) -> DataFrame:
    return box_join(a, b, size, pad=d, closed=True).withColumn("distance", box_distance()).where(F.col("distance") <= d)


def segment_distance(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a point from a segment."""
    dx, dy = x2 - x1, y2 - y1
    along = F.coalesce(F.try_divide((x - x1) * dx + (y - y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), along))
    return F.hypot(x - (x1 + t * dx), y - (y1 + t * dy))


def nearest_segment(points: DataFrame, segments: DataFrame, size: float, reach: float | None = None) -> DataFrame:
    """points with the distance to the nearest segment (x1, y1, x2, y2), up to reach.

    Segments are put in the cells of their box grown by reach; a point meets those of its own cell. Without reach, cells
    and reach start at size and double for the points that have found none, until every point has its segment.
    """
    d = segment_distance(F.col("x"), F.col("y"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    keys = points.columns
    if reach is None:
        if segments.isEmpty():
            return points.withColumn("distance", F.lit(None).cast("double"))
        done, open_ = [], settle(points)
        while not open_.isEmpty():
            near = settle(nearest_segment(open_, segments, size, size))
            done.append(near.where("distance IS NOT NULL"))
            open_, size = near.where("distance IS NULL").drop("distance"), 2 * size
        return reduce(lambda a, b: a.unionByName(b), done) if done else points.withColumn("distance", F.lit(None).cast("double"))
    lo, hi = (lambda a, b: F.least(a, b) - reach), (lambda a, b: F.greatest(a, b) + reach)
    cells = on_cells(segments, size, lo("x1", "x2"), lo("y1", "y2"), hi("x1", "x2"), hi("y1", "y2"))
    p = points.withColumn("_cx", F.floor(F.col("x") / size)).withColumn("_cy", F.floor(F.col("y") / size))
    found = p.join(cells, ["_cx", "_cy"]).withColumn("_d", d).where(F.col("_d") <= reach)
    best = found.groupBy(*keys).agg(F.min("_d").alias("distance"))
    return points.join(best, keys, "left")


def fill_missing(all_: DataFrame, present: DataFrame, key: str, defaults: dict[str, float]) -> DataFrame:
    """Rows of all_ with the columns of present; keys without a match get the defaults."""
    return all_.join(present, key, "left").withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def left_join_chain(base: DataFrame, tables: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """Successive left joins on the key, then the first row of each key."""
    out = reduce(lambda a, b: a.join(b, key, "left"), tables, base)
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return out.withColumn("_n", rank).where("_n = 1").drop("_n")


def filter_and_rename(layer: DataFrame, roi: tuple[float, float, float, float], names: dict[str, str], pad: float = 0.0) -> DataFrame:
    """Rows that meet one padded study box, with chosen columns renamed."""
    x0, y0, x1, y1 = roi
    hit = (F.col("xmin") <= x1 + pad) & (F.col("xmax") >= x0 - pad) & (F.col("ymin") <= y1 + pad) & (F.col("ymax") >= y0 - pad)
    return layer.where(hit).select([F.col(a).alias(b) for a, b in names.items()])


def contained_in(df: DataFrame, size: float, key: str = "fid") -> DataFrame:
    """Each box with the smallest other box that covers it, then the lowest id; null where none does."""
    pairs = box_join(df, df, size).where(f"a_{key} <> b_{key} AND b_xmin <= a_xmin AND b_ymin <= a_ymin AND b_xmax >= a_xmax AND b_ymax >= a_ymax")
    area = (F.col("b_xmax") - F.col("b_xmin")) * (F.col("b_ymax") - F.col("b_ymin"))
    best = pairs.groupBy(F.col(f"a_{key}").alias(key)).agg(F.min(F.struct(area.alias("s"), F.col(f"b_{key}").alias("k")))["k"].alias("within"))
    return df.join(best, key, "left")


def touching(df: DataFrame, size: float, tolerance: float = 1e-3, key: str = "fid") -> DataFrame:
    """(a, b, border): shared area of boxes grown by the tolerance, with rank by border for each a."""
    pairs = box_join(df, df, size, pad=tolerance).where(f"a_{key} <> b_{key}")
    w = F.least(F.col("a_xmax") + tolerance, F.col("b_xmax")) - F.greatest(F.col("a_xmin") - tolerance, F.col("b_xmin"))
    h = F.least(F.col("a_ymax") + tolerance, F.col("b_ymax")) - F.greatest(F.col("a_ymin") - tolerance, F.col("b_ymin"))
    out = pairs.select(F.col(f"a_{key}").alias("a"), F.col(f"b_{key}").alias("b"), (w * h).alias("border"))
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("border"), "b")))


def cross_distance(centroids: DataFrame, key: str = "micro", group: str = "macro", vector: str = "v") -> DataFrame:
    """For each class the nearest and second nearest class of another group. Classes are few: one row each."""
    a = centroids.select(F.col(key).alias("a"), F.col(group).alias("ga"), F.col(vector).alias("va"))
    b = centroids.select(F.col(key).alias("b"), F.col(group).alias("gb"), F.col(vector).alias("vb"))
    d = F.sqrt(F.aggregate(F.zip_with("va", "vb", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    pairs = a.join(F.broadcast(b), F.col("ga") != F.col("gb")).select("a", "b", d.alias("distance"))
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy("distance", "b"))).where("rank <= 2")


def sample_nearest(points: DataFrame, px: DataFrame, band: str, x0: float, y0: float, size: float = 1.0) -> DataFrame:
    """points with the band's value in the pixel that holds them; null outside."""
    at = points.withColumn("r", F.floor((F.lit(y0) - F.col("y")) / size)).withColumn("c", F.floor((F.col("x") - x0) / size))
    return at.join(px.select("r", "c", F.col(band).alias("value")), ["r", "c"], "left")


def filter_points_by_raster_range(points: DataFrame, px: DataFrame, ranges: dict[str, tuple[float, float]], x0: float, y0: float, size: float = 1.0, z: str = "z") -> DataFrame:
    """Points with a z whose pixel has each band within its range, ends included."""
    at = points.where(F.col(z).isNotNull()).withColumn("r", F.floor((F.lit(y0) - F.col("y")) / size)).withColumn("c", F.floor((F.col("x") - x0) / size))
    held = px.select("r", "c", *[F.col(b).alias(f"_{b}") for b in ranges]).where(reduce(lambda a, b: a & b, [F.col(f"_{b}").between(lo, hi) for b, (lo, hi) in ranges.items()]))
    return at.join(held, ["r", "c"]).select(*points.columns)


def sample_bilinear(points: DataFrame, px: DataFrame, band: str, x0: float, y0: float, size: float = 1.0, key: str = "fid") -> DataFrame:
    """points with the bilinear value of the four pixel centres around; the nearest pixel where one is missing."""
    u, v = (F.col("x") - x0) / size - 0.5, (F.lit(y0) - F.col("y")) / size - 0.5
    p = points.withColumn("_r", F.floor(v)).withColumn("_c", F.floor(u)).withColumn("_fr", v - F.floor(v)).withColumn("_fc", u - F.floor(u))
    four = F.array(*[F.struct((F.col("_r") + i).alias("r"), (F.col("_c") + j).alias("c"), ((F.col("_fr") if i else 1 - F.col("_fr")) * (F.col("_fc") if j else 1 - F.col("_fc"))).alias("w")) for i in (0, 1) for j in (0, 1)])
    spread = p.select(key, F.inline(four))
    met = spread.join(px.select("r", "c", F.col(band).alias("_v")), ["r", "c"])
    value = met.groupBy(key).agg(F.when(F.count("*") == 4, F.sum(F.col("w") * F.col("_v"))).alias("_b"))
    near = sample_nearest(points, px, band, x0, y0, size).drop("r", "c")
    return near.join(value, key, "left").withColumn("value", F.coalesce("_b", "value")).drop("_b")


def rasterize(boxes: DataFrame, px: DataFrame, size: float, value: str = "fid", background: float = 0) -> DataFrame:
    """px with `burned`: the value of the last box (by fid) whose area holds the pixel's centre, else the background."""
    hit = points_in_boxes(px.select("pid", "x", "y"), boxes, size)
    last = hit.groupBy(F.col("p_pid").alias("pid")).agg(F.max_by(f"b_{value}", "b_fid").alias("burned"))
    return px.join(last, "pid", "left").withColumn("burned", F.coalesce("burned", F.lit(background)))


def cut_grid(px: DataFrame, tile: int, margin: int) -> DataFrame:
    """Pixels by tile (tx, ty), each tile with a margin of its neighbours' pixels."""
    span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - margin) / tile), F.floor((F.col(c) + margin) / tile)))
    return px.withColumn("tx", span("c")).withColumn("ty", span("r")).where("tx >= 0 AND ty >= 0")


def superimpose(px: DataFrame, band: str, factor: int) -> DataFrame:
    """Nearest-neighbour resampling onto a lattice of pixels `factor` times as large: the value at their centre."""
    half = factor // 2
    held = px.where((F.col("r") % factor == half) & (F.col("c") % factor == half))
    return held.select((F.col("r") / factor).cast("long").alias("r"), (F.col("c") / factor).cast("long").alias("c"), F.col(band).alias("value"))


def mosaic(scenes: list[DataFrame], band: str, nodata: float = 0) -> DataFrame:
    """One value per pixel: the first scene, in list order, whose value is valid."""
    every = reduce(lambda a, b: a.unionByName(b), [s.select("r", "c", F.col(band).alias("v"), F.lit(i).alias("o")) for i, s in enumerate(scenes)])
    return every.groupBy("r", "c").agg(F.coalesce(F.min(F.when(F.col("v") != nodata, F.struct("o", "v")))["v"], F.lit(nodata)).alias("value"))


def stack_indicators(base: DataFrame, layers: dict[str, tuple[DataFrame, str]], key: str = "fid") -> DataFrame:
    """base with one renamed column for each layer, matched by id; a missing id gives 0."""
    out = base
    for name, (df, c) in layers.items():
        out = out.join(df.select(key, F.col(c).cast("double").alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
    return out
