"""Polygons with any number of corners and holes: features, pairs and overlays.

A layer carries `rings` (array of rings of points x, y; the first is the outer one) beside its box. Boxes find the
candidates by joins.box_join; kernels in NumPy decide and cut, many features or pairs at a time in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arpent.functions import batches, shapes
from arpent.functions import geometry as ge
from arpent.operators.joins import BOX, box_join, points_in_boxes

RINGS = "array<array<struct<x:double,y:double>>>"
PARTS = f"array<{RINGS}>"

_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_RINGS = pa.list_(pa.list_(_POINT))
_PARTS = pa.list_(_RINGS)


def _read(value) -> shapes.Rings:
    return [np.array([(p["x"], p["y"]) for p in ring], float) for ring in value or []]


def _write(rings: shapes.Rings) -> list:
    return [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]


def _measure(f):
    """A double from the rings of one or two features; f takes the columns of those that have both."""

    @F.arrow_udf("double")
    def two(a: pa.Array, b: pa.Array) -> pa.Array:
        held = np.flatnonzero((pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False) > 0) & (pc.fill_null(pc.list_value_length(b), 0).to_numpy(zero_copy_only=False) > 0))
        out, has = np.zeros(len(a)), np.zeros(len(a), bool)
        out[held], has[held] = f(a.take(pa.array(held)), b.take(pa.array(held))), True
        return pa.array(out, pa.float64(), mask=~has)

    return two


def _shape(f):
    """Polygons from the rings of a feature and a number, one at a time."""

    @F.arrow_udf(PARTS)
    def made(a: pa.Array, d: pa.Array) -> pa.Array:
        return pa.array([[_write(p) for p in f(_read(x), k)] if x else [] for x, k in zip(a.to_pylist(), d.to_pylist(), strict=True)], _PARTS)

    return made


def _pair(keep):
    """Polygons from the rings of two features, where keep holds."""

    @F.arrow_udf(PARTS)
    def made(a: pa.Array, b: pa.Array) -> pa.Array:
        return batches.combined(a, b, keep)

    return made


def with_box(df: DataFrame, rings: str = "rings") -> DataFrame:
    """df with the box of its rings."""
    points = F.flatten(F.col(rings))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return df.withColumns({"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)})


def parts_area(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda s, p: s + ge.area(p))


def explode_parts(df: DataFrame, parts: str, name: str = "rings") -> DataFrame:
    """A row for each polygon of df's `parts`, with its number and its box."""
    keep = [c for c in df.columns if c not in (parts, name, *BOX)]
    return with_box(df.select(*keep, F.posexplode(parts).alias("part", name)), name)


# --- one feature -----------------------------------------------------------------------------------------------------


def buffered(rings: Column, d: Column | float, default: float = 1.0, quarter: int = 8) -> Column:
    """All within d of a polygon, as polygons; what lies deeper than -d for negative d; the default where d is 0 or null."""
    d = d if isinstance(d, Column) else F.lit(float(d))

    @F.arrow_udf(PARTS)
    def made(a: pa.Array, by: pa.Array) -> pa.Array:
        return batches.buffered(a, by.to_numpy(zero_copy_only=False), quarter)

    return made(rings, F.coalesce(F.nullif(d.cast("double"), F.lit(0.0)), F.lit(float(default))))


def simplified(rings: Column, tolerance: float) -> Column:
    return _shape(lambda r, k: [[shapes.simplify(x, k) for x in r]])(rings, F.lit(float(tolerance)))[0]


def convex_hull(rings: Column) -> Column:
    return _shape(lambda r, _: [[shapes.hull(np.concatenate(r))]])(rings, F.lit(0.0))[0]


def outer_contour(rings: Column) -> Column:
    return ge.clean_rings(rings)


def made_valid(rings: Column) -> Column:
    """Simple polygons that cover what the even-odd rule calls inside."""

    @F.arrow_udf(PARTS)
    def made(a: pa.Array) -> pa.Array:
        return batches.valid(a)

    return made(rings)


def is_valid(rings: Column) -> Column:
    """Closed rings of four points or more whose area by corners is the area inside: no ring crosses itself or another."""
    closed = F.forall(rings, lambda r: (F.size(r) >= 4) & (F.element_at(r, 1) == F.element_at(r, -1)))
    return closed & (F.abs(parts_area(made_valid(rings)) - ge.area(rings)) <= 1e-9 * F.greatest(F.lit(1.0), ge.area(rings)))


# --- pairs -----------------------------------------------------------------------------------------------------------


def meeting(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """Pairs of polygons that share an area, which is added; columns are prefixed a_ and b_."""
    pairs = box_join(with_box(a), with_box(b), size)
    return pairs.withColumn("area", _measure(batches.overlaps)(F.col("a_rings"), F.col("b_rings"))).where("area > 1e-9")


def intersection(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """meeting with the shared polygons as `parts`."""
    return meeting(a, b, size).withColumn("parts", _pair(lambda p, q: p & q)(F.col("a_rings"), F.col("b_rings")))


def difference(a: DataFrame, b: DataFrame, size: float, key: str = "fid", where: str | None = None) -> DataFrame:
    """a's key with `parts`: each polygon of a outside all of b's; where limits the pairs. A group is one feature of a with
    those that meet it. Features that nothing is left of have no parts."""
    pairs = meeting(a.select(key, "rings"), b.select(key, "rings"), size)
    pairs = pairs.where(where) if where else pairs
    met = pairs.groupBy(F.col(f"a_{key}").alias(key)).agg(F.collect_list("b_rings").alias("_b"))

    @F.arrow_udf(PARTS)
    def left(own: pa.Array, others: pa.Array) -> pa.Array:
        return batches.outside(own, others)

    return a.select(key, "rings").join(met, key, "left").select(key, left("rings", "_b").alias("parts"))


def remove_overlaps(df: DataFrame, size: float, least: float = 0.0, key: str = "fid") -> DataFrame:
    """Each polygon outside those of later keys, of more than `least` area."""
    return difference(df, df, size, key, f"b_{key} > a_{key}").where(parts_area(F.col("parts")) > least)


def delete_meeting_polygons(a: DataFrame, b: DataFrame, size: float, key: str = "fid") -> tuple[DataFrame, DataFrame]:
    """Both layers without the polygons that share an area with one of the other layer."""
    pairs = meeting(a.select(key, "rings"), b.select(key, "rings"), size)
    return tuple(df.join(pairs.select(F.col(f"{s}_{key}").alias(key)).distinct(), key, "left_anti") for df, s in ((a, "a"), (b, "b")))


def polygons_within(a: DataFrame, b: DataFrame, d: float, size: float) -> DataFrame:
    """Pairs of polygons at most d apart, with their distance."""
    pairs = box_join(with_box(a), with_box(b), size, pad=d, closed=True)
    return pairs.withColumn("distance", _measure(batches.distances)(F.col("a_rings"), F.col("b_rings"))).where(F.col("distance") <= d)


def polygons_containing(polygons: DataFrame, points: DataFrame, size: float, key: str = "fid") -> DataFrame:
    """Polygons that hold a point (x, y) or more."""
    ids = points_in_polygons(points, polygons, size).select(F.col(f"b_{key}").alias(key)).distinct()
    return polygons.join(ids, key, "left_semi")


def polygons_met_by_lines(polygons: DataFrame, segments: DataFrame, size: float, key: str = "fid") -> DataFrame:
    """Polygons that a segment (x1, y1, x2, y2) or more of a layer of lines lies in, ends in or crosses; JVM-side."""
    seg = segments.select("x1", "y1", "x2", "y2", F.least("x1", "x2").alias("xmin"), F.least("y1", "y2").alias("ymin"), F.greatest("x1", "x2").alias("xmax"), F.greatest("y1", "y2").alias("ymax"))
    pairs = box_join(with_box(polygons.select(key, "rings")), seg, size, closed=True)
    x1, y1, x2, y2 = (F.col(f"b_{c}") for c in ("x1", "y1", "x2", "y2"))
    turn = lambda ax, ay, bx, by, cx, cy: F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))
    crosses = lambda s: (turn(x1, y1, x2, y2, s["p"]["x"], s["p"]["y"]) * turn(x1, y1, x2, y2, s["q"]["x"], s["q"]["y"]) < 0) & (turn(s["p"]["x"], s["p"]["y"], s["q"]["x"], s["q"]["y"], x1, y1) * turn(s["p"]["x"], s["p"]["y"], s["q"]["x"], s["q"]["y"], x2, y2) < 0)
    met = ge.contains(F.col("a_rings"), x1, y1) | ge.contains(F.col("a_rings"), x2, y2) | F.exists(F.flatten(F.transform("a_rings", ge.segments)), crosses)
    return polygons.join(pairs.where(met).select(F.col(f"a_{key}").alias(key)).distinct(), key, "left_semi")


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """(p_*, b_*) where a point lies in a polygon by the even-odd rule; JVM-side."""
    return points_in_boxes(points, with_box(polygons), size, x, y).where(ge.contains(F.col("b_rings"), F.col(f"p_{x}"), F.col(f"p_{y}")))


def covered_by(df: DataFrame, size: float, key: str = "fid") -> DataFrame:
    """(key, within): the smallest other polygon that covers each one, then the lowest id; null where none does."""
    pairs = meeting(df.select(key, "rings"), df.select(key, "rings"), size).where(f"a_{key} <> b_{key}").where(F.abs(F.col("area") - ge.area(F.col("a_rings"))) <= 1e-9)
    best = pairs.groupBy(F.col(f"a_{key}").alias(key)).agg(F.min(F.struct(ge.area(F.col("b_rings")).alias("s"), F.col(f"b_{key}").alias("k")))["k"].alias("within"))
    return df.select(key).join(best, key, "left")


def shared_borders(df: DataFrame, size: float, key: str = "fid", tolerance: float = 1e-6) -> DataFrame:
    """(a, b, length): pairs of polygons with edges along one another, both ways."""

    def lengths(a: pa.Array, b: pa.Array) -> list[float]:
        return [shapes.border(_read(x), _read(y), tolerance) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)]

    pairs = box_join(with_box(df.select(key, "rings")), with_box(df.select(key, "rings")), size, pad=tolerance, closed=True).where(f"a_{key} <> b_{key}")
    out = pairs.select(F.col(f"a_{key}").alias("a"), F.col(f"b_{key}").alias("b"), _measure(lengths)(F.col("a_rings"), F.col("b_rings")).alias("length"))
    return out.where(F.col("length") > tolerance)


def dissolve(df: DataFrame, by: str, size: float) -> DataFrame:
    """(by, _cx, _cy, parts): the union of each group's polygons, cell by cell of a grid, so that a group of any size is
    never in one task; pieces end at the lines of the grid."""
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))
    cells = with_box(df.select(by, "rings")).withColumn("_cx", span("xmin", "xmax")).withColumn("_cy", span("ymin", "ymax"))
    cell = ge.box_polygon(F.col("_cx") * size, F.col("_cy") * size, (F.col("_cx") + 1) * size, (F.col("_cy") + 1) * size)
    inside = cells.select(by, "_cx", "_cy", _pair(lambda p, q: p & q)(F.col("rings"), cell).alias("_p")).where(F.size("_p") > 0)

    @F.arrow_udf(PARTS)
    def joined(lists: pa.Array) -> pa.Array:
        return batches.united(lists, 4)

    return inside.groupBy(by, "_cx", "_cy").agg(F.collect_list("_p").alias("_l")).select(by, "_cx", "_cy", joined("_l").alias("parts"))


def split_each(df: DataFrame, line: tuple[str, str, str, str], reach: float = 1e6) -> DataFrame:
    """df with `parts`: each polygon cut along the straight line through two points of its own."""
    p, q = [F.col(c) for c in line[:2]], [F.col(c) for c in line[2:]]
    n = F.hypot(q[0] - p[0], q[1] - p[1])
    u = [(b - a) / n * reach for a, b in zip(p, q, strict=True)]
    at = lambda i, j: F.struct((p[0] + i * u[0] - j * u[1]).alias("x"), (p[1] + i * u[1] + j * u[0]).alias("y"))
    half = F.array(F.array(at(-1, 0), at(1, 0), at(1, 1), at(-1, 1), at(-1, 0)))
    left = _pair(lambda a, b: a & b)(F.col("rings"), half)
    right = _pair(lambda a, b: a & ~b)(F.col("rings"), half)
    return df.withColumn("parts", F.concat(left, right))
