"""Planar graphs of polygons and lines: crossings become nodes, pieces between nodes become edges, faces are polygons again.

Segments meet by an equi-join on their feature and the cells of a grid; crossings, cuts and the choice of pieces are columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arpent.functions import geometry as ge
from arpent.operators.joins import box_join, on_cells
from arpent.operators.lineage import stored
from arpent.operators.outlines import ENDS, joined_up, polygons_of
from arpent.operators.polygons import with_box

#: Decimal places to which corners and crossings are rounded, so that equal places have equal coordinates.
PLACES = 9


def _place(x: Column) -> Column:
    return F.round(x, PLACES) + 0.0


def line_pieces(lines: DataFrame, line: str = "line", key: str = "lid") -> DataFrame:
    """(key, x1, y1, x2, y2): the segments of lines (arrays of points)."""
    s = F.inline(F.transform(ge.segments(F.col(line)), lambda s: F.struct(s["p"]["x"].alias("x1"), s["p"]["y"].alias("y1"), s["q"]["x"].alias("x2"), s["q"]["y"].alias("y2"))))
    return lines.select(key, s)


def _boxed(df: DataFrame) -> DataFrame:
    return df.withColumns({"xmin": F.least("x1", "x2"), "ymin": F.least("y1", "y2"), "xmax": F.greatest("x1", "x2"), "ymax": F.greatest("y1", "y2")})


def noded(segments: DataFrame, size: float, g: str = "g") -> DataFrame:
    """(sid, x1, y1, x2, y2): segments (sid, g, x1, y1, x2, y2) cut wherever one of the same g crosses or touches them.

    Pieces keep their direction. Segments along one another are cut at each other's ends, so shared stretches are equal
    pieces. size: width of the grid's cells in which segments meet.
    """
    s = _boxed(segments)
    cells = on_cells(s, size, *[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")])
    a, b = (cells.select(*[F.col(c).alias(f"{k}_{c}") for c in ("sid", *ENDS, "xmin", "ymin", "xmax", "ymax")], F.col(g).alias("_g"), "_cx", "_cy") for k in "ab")
    reach = 10.0**-PLACES
    meet = (F.col("a_xmin") <= F.col("b_xmax") + reach) & (F.col("b_xmin") <= F.col("a_xmax") + reach) & (F.col("a_ymin") <= F.col("b_ymax") + reach) & (F.col("b_ymin") <= F.col("a_ymax") + reach)
    pairs = a.join(b, ["_g", "_cx", "_cy"]).where(meet & (F.col("a_sid") < F.col("b_sid")))
    ax, ay, bx, by = (F.col(f"{k}_{c}2") - F.col(f"{k}_{c}1") for k in "ab" for c in "xy")
    ox, oy = F.col("b_x1") - F.col("a_x1"), F.col("b_y1") - F.col("a_y1")
    det = ax * by - ay * bx
    flat = F.abs(det) <= 1e-12 * F.hypot(ax, ay) * F.hypot(bx, by)
    t, u = (ox * by - oy * bx) / F.when(flat, None).otherwise(det), (ox * ay - oy * ax) / F.when(flat, None).otherwise(det)
    slack_a, slack_b = reach / F.hypot(ax, ay), reach / F.hypot(bx, by)
    cross = (t >= -slack_a) & (t <= 1 + slack_a) & (u >= -slack_b) & (u <= 1 + slack_b)
    near_end = lambda v, slack, k, c: F.when(v <= slack, F.col(f"{k}_{c}1")).when(v >= 1 - slack, F.col(f"{k}_{c}2"))
    at = [F.coalesce(near_end(u, slack_b, "b", c), near_end(t, slack_a, "a", c), F.col(f"a_{c}1") + t * d) for c, d in (("x", ax), ("y", ay))]
    point = lambda sid, x, y: F.struct(F.col(sid).alias("sid"), _place(x).alias("x"), _place(y).alias("y"))
    off = F.abs(ox * ay - oy * ax) <= reach * F.hypot(ax, ay)
    ends = F.array(*[point(own, F.col(f"{other}_x{k}"), F.col(f"{other}_y{k}")) for own, other in (("a_sid", "b"), ("b_sid", "a")) for k in (1, 2)])
    none = F.array().cast("array<struct<sid:bigint,x:double,y:double>>")
    found = F.when(flat & off, ends).when(~flat & cross, F.array(point("a_sid", *at), point("b_sid", *at))).otherwise(none)
    cuts = pairs.select(F.inline(found)).groupBy("sid").agg(F.collect_set(F.struct("x", "y")).alias("_cuts"))  # the cuts of one segment
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    along = lambda p: ((p["x"] - F.col("x1")) * dx + (p["y"] - F.col("y1")) * dy) / (dx * dx + dy * dy)
    inner = F.filter(F.coalesce("_cuts", F.array().cast("array<struct<x:double,y:double>>")), lambda p: (along(p) > 0) & (along(p) < 1))
    end = lambda k, v: F.struct(F.lit(v).alias("t"), _place(F.col(f"x{k}")).alias("x"), _place(F.col(f"y{k}")).alias("y"))
    stops = F.array_sort(F.concat(F.array(end(1, 0.0)), F.transform(inner, lambda p: F.struct(along(p).alias("t"), p["x"].alias("x"), p["y"].alias("y"))), F.array(end(2, 1.0))))
    held = segments.join(cuts, "sid", "left").withColumn("_s", stops)
    n = F.size("_s") - 1
    piece = F.zip_with(F.slice("_s", F.lit(1), n), F.slice("_s", F.lit(2), n), lambda p, q: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")))
    return held.select("sid", F.inline(piece)).where("x1 <> x2 OR y1 <> y2")


def split_by_polylines(df: DataFrame, lines: DataFrame, size: float, key: str = "fid", tile: float | None = None) -> DataFrame:
    """(key, rid, rings, area): polygons cut along lines (array of points `line`); others stay as one.

    The pieces of the lines inside a polygon and its own edges make a planar graph whose faces are traced. A line that ends
    inside a polygon cuts only as far as it closes a face with others; one along the polygon's edge cuts nothing. A closed
    line inside makes a face and a hole. Polygons that nothing is left of by rounding go.
    """
    tile = tile or 8 * size
    ring = lambda r, i: F.when((ge.ring_area(r) > 0) == (i == 0), r).otherwise(F.reverse(r))
    whole = with_box(df.select(F.col(key).alias("g"), F.transform("rings", ring).alias("rings")))
    segs = _boxed(line_pieces(lines.withColumn("_l", F.lit(0)), key="_l"))
    met = stored(box_join(whole.select("g", "xmin", "ymin", "xmax", "ymax"), segs, size, closed=True).select(F.col("a_g").alias("g"), *[F.col(f"b_{c}").alias(c) for c in ENDS]).distinct())
    edges = whole.join(met.select("g").distinct(), "g", "left_semi").select("g", F.inline(F.flatten(F.transform("rings", lambda r: F.transform(ge.segments(r), lambda s: F.struct(s["p"]["x"].alias("x1"), s["p"]["y"].alias("y1"), s["q"]["x"].alias("x2"), s["q"]["y"].alias("y2")))))), F.lit(True).alias("own"))
    every = stored(edges.unionByName(met.withColumn("own", F.lit(False))).withColumn("sid", F.monotonically_increasing_id()))
    pieces = stored(noded(every, size).join(every.select("sid", "g", "own"), "sid").drop("sid"))
    rim = pieces.where("own").drop("own").distinct()
    turned = F.when((F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") < F.col("y2"))), True).otherwise(False)
    way = lambda df: df.select("g", *[F.when(turned, F.col(c)).otherwise(F.col(o)).alias(c) for c, o in zip(ENDS, ("x2", "y2", "x1", "y1"), strict=True)]).distinct()
    inner = way(pieces.where("NOT own")).join(way(rim), ["g", *ENDS], "left_anti")
    inside = inner.join(whole.select("g", "rings"), "g").where(ge.contains(F.col("rings"), (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2)).select("g", *ENDS)
    graph = rim.select("g", *ENDS).union(inside).union(inside.select("g", "x2", "y2", "x1", "y1")).withColumn("stop", F.lit(False))
    faces = polygons_of(joined_up(graph, tile), tile)
    rest = whole.join(met.select("g").distinct(), "g", "left_anti").select("g", F.lit(None).cast("long").alias("rid"), "rings", ge.area(F.col("rings")).alias("area"))
    return faces.unionByName(rest).withColumnRenamed("g", key)
