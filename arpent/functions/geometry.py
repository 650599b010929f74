"""Geometry as Columns: a ring is array<struct<x, y>> whose last point is its first, a polygon an array of rings, the first
the outer one. Measures stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"


def box_polygon(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(p(xmin, ymin), p(xmax, ymin), p(xmax, ymax), p(xmin, ymax), p(xmin, ymin)))


def segments(ring: Column) -> Column:
    """Array of (p, q): neighbouring points of a ring or line."""
    n = F.size(ring)
    return F.when(n > 1, F.zip_with(F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))).otherwise(F.array().cast(f"array<struct<p:{POINT},q:{POINT}>>"))


def _sum(items: Column, f) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda s, x: s + f(x))


def _cross(s: Column) -> Column:
    return s["p"]["x"] * s["q"]["y"] - s["q"]["x"] * s["p"]["y"]


def ring_area(ring: Column) -> Column:
    """Signed: positive against the clock."""
    return _sum(segments(ring), _cross) / 2


def length(line: Column) -> Column:
    return _sum(segments(line), lambda s: F.hypot(s["q"]["x"] - s["p"]["x"], s["q"]["y"] - s["p"]["y"]))


def area(polygon: Column) -> Column:
    """Outer ring less holes."""
    whole = F.abs(ring_area(F.element_at(polygon, 1)))
    return whole - F.aggregate(F.slice(polygon, 2, F.size(polygon)), F.lit(0.0), lambda s, r: s + F.abs(ring_area(r)))


def perimeter(polygon: Column) -> Column:
    return F.aggregate(polygon, F.lit(0.0), lambda s, r: s + length(r))


def centroid(ring: Column) -> Column:
    """Of the outer ring; null without area."""
    s, a = segments(ring), ring_area(ring) * 6
    x = F.try_divide(_sum(s, lambda g: (g["p"]["x"] + g["q"]["x"]) * _cross(g)), a)
    y = F.try_divide(_sum(s, lambda g: (g["p"]["y"] + g["q"]["y"]) * _cross(g)), a)
    return F.struct(x.alias("x"), y.alias("y"))


def compactness(polygon: Column) -> Column:
    """4 pi A / P^2."""
    p = perimeter(polygon)
    return F.try_divide(4 * F.pi() * area(polygon), p * p)


def contains(polygon: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over all rings; a point on a lower or left edge is inside."""
    crosses = lambda s: ((s["p"]["y"] > y) != (s["q"]["y"] > y)) & (x < (s["q"]["x"] - s["p"]["x"]) * (y - s["p"]["y"]) / F.nullif(s["q"]["y"] - s["p"]["y"], F.lit(0.0)) + s["p"]["x"])
    hits = F.aggregate(F.flatten(F.transform(polygon, segments)), F.lit(0), lambda n, s: n + F.when(crosses(s), 1).otherwise(0))
    return hits % 2 == 1


def point_distance(polygon: Column, x: Column, y: Column) -> Column:
    """Distance of a point from a polygon, 0 inside."""

    def apart(s: Column) -> Column:
        dx, dy = s["q"]["x"] - s["p"]["x"], s["q"]["y"] - s["p"]["y"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide((x - s["p"]["x"]) * dx + (y - s["p"]["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))))
        return F.hypot(x - s["p"]["x"] - t * dx, y - s["p"]["y"] - t * dy)

    return F.when(contains(polygon, x, y), 0.0).otherwise(F.array_min(F.transform(F.flatten(F.transform(polygon, segments)), apart)))


def remove_small_rings(polygon: Column, least: float = 500) -> Column:
    """Holes under an area go; the outer ring stays."""
    holes = F.filter(F.slice(polygon, 2, F.size(polygon)), lambda r: F.abs(ring_area(r)) >= least)
    return F.concat(F.slice(polygon, 1, 1), holes)


def clean_rings(polygon: Column) -> Column:
    return F.slice(polygon, 1, 1)


def direction(line: Column) -> tuple[Column, Column, Column, Column]:
    """End points in canonical order: smaller x, then smaller y, first."""
    a, b = F.element_at(line, 1), F.element_at(line, -1)
    first = (a["x"] < b["x"]) | ((a["x"] == b["x"]) & (a["y"] <= b["y"]))
    return tuple(F.when(first, u).otherwise(v) for u, v in ((a["x"], b["x"]), (a["y"], b["y"]), (b["x"], a["x"]), (b["y"], a["y"])))


def along(x1: Column, y1: Column, x2: Column, y2: Column, d: Column) -> tuple[Column, Column]:
    """Point at a distance from the first end, on the segment's line."""
    n = F.hypot(x2 - x1, y2 - y1)
    t = F.coalesce(F.try_divide(d, n), F.lit(0.0))
    return x1 + t * (x2 - x1), y1 + t * (y2 - y1)


def extend_segment(x1: Column, y1: Column, x2: Column, y2: Column, d: float) -> list[Column]:
    """Both ends moved outwards by d; inwards for negative d, at most to the middle."""
    n = F.hypot(x2 - x1, y2 - y1)
    k = F.greatest(F.lit(float(d)), -n / 2)
    return [*along(x1, y1, x2, y2, -k), *along(x1, y1, x2, y2, n + k)]


def offset_segment(x1: Column, y1: Column, x2: Column, y2: Column, d: float) -> list[Column]:
    """The segment moved by d to its left, to its right for negative d."""
    n = F.hypot(x2 - x1, y2 - y1)
    ux, uy = F.coalesce(F.try_divide(-(y2 - y1), n), F.lit(0.0)) * d, F.coalesce(F.try_divide(x2 - x1, n), F.lit(0.0)) * d
    return [x1 + ux, y1 + uy, x2 + ux, y2 + uy]


def perpendicular(x1: Column, y1: Column, x2: Column, y2: Column, d: float) -> list[Column]:
    """Ends, left then right, of the line across the segment's middle, d long on either side."""
    n = F.hypot(x2 - x1, y2 - y1)
    ux, uy = F.coalesce(F.try_divide(-(y2 - y1), n), F.lit(0.0)) * d, F.coalesce(F.try_divide(x2 - x1, n), F.lit(0.0)) * d
    mx, my = (x1 + x2) / 2, (y1 + y2) / 2
    return [mx + ux, my + uy, mx - ux, my - uy]


def points_along(df: DataFrame, most: float) -> DataFrame:
    """Points of segments (x1, y1, x2, y2) spaced at most `most` apart, ends included: k, x, y."""
    n = F.greatest(F.lit(1), F.ceil(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) / most)).cast("int")
    out = df.withColumn("_n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("_n"))))
    t = F.col("k") / F.col("_n")
    return out.withColumn("x", F.col("x1") + t * (F.col("x2") - F.col("x1"))).withColumn("y", F.col("y1") + t * (F.col("y2") - F.col("y1"))).drop("_n")


def split_segments(df: DataFrame, most: float) -> DataFrame:
    """Segments cut to equal pieces of at most a length: k, x1, y1, x2, y2."""
    n = F.greatest(F.lit(1), F.ceil(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) / most)).cast("int")
    out = df.withColumn("_n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    at = lambda i, a, b: F.col(a) + (F.col("k") + i) / F.col("_n") * (F.col(b) - F.col(a))
    return out.select(*[c for c in df.columns if c not in ("x1", "y1", "x2", "y2")], "k", at(0, "x1", "x2").alias("x1"), at(0, "y1", "y2").alias("y1"), at(1, "x1", "x2").alias("x2"), at(1, "y1", "y2").alias("y2"))


def chaikin(line: Column) -> Column:
    """One round of corner cutting: each segment gives its quarter points."""
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    quarter = lambda s, a: p(s["p"]["x"] * (1 - a) + s["q"]["x"] * a, s["p"]["y"] * (1 - a) + s["q"]["y"] * a)
    return F.flatten(F.transform(segments(line), lambda s: F.array(quarter(s, 0.25), quarter(s, 0.75))))


def grid(extents: DataFrame, dx: float, dy: float) -> DataFrame:
    """Cells from the top left of each row's box, the last ones clipped; row-major id and name l{r}c{c}."""
    n = lambda a, b, d: F.greatest(F.lit(1), F.ceil((F.col(b) - F.col(a)) / d)).cast("int")
    g = extents.withColumn("_nx", n("xmin", "xmax", dx)).withColumn("l", F.explode(F.sequence(F.lit(0), n("ymin", "ymax", dy) - 1))).withColumn("c", F.explode(F.sequence(F.lit(0), F.col("_nx") - 1)))
    x0, y1 = F.col("xmin") + F.col("c") * dx, F.col("ymax") - F.col("l") * dy
    return g.select(
        *[c for c in extents.columns if c not in ("xmin", "ymin", "xmax", "ymax")], (F.col("l") * F.col("_nx") + F.col("c")).alias("id"), F.concat(F.lit("l"), "l", F.lit("c"), "c").alias("name"),
        x0.alias("xmin"), F.greatest("ymin", y1 - dy).alias("ymin"), F.least("xmax", x0 + dx).alias("xmax"), y1.alias("ymax"),
    )


def snap_vertices(polygon: Column, x0: Column, size: float, tolerance: float = 1e-6) -> Column:
    """Vertices whose x equals an extent value move to that value rounded to the lattice."""
    fixed = F.round(x0 / size) * size
    return F.transform(polygon, lambda r: F.transform(r, lambda p: F.struct(F.when(F.abs(p["x"] - x0) < tolerance, fixed).otherwise(p["x"]).alias("x"), p["y"].alias("y"))))
