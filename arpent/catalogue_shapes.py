"""Registered queries of polygons that aren't boxes: each box without its upper right quarter, whose areas SQL can add up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arpent.catalogue import CELL, query, r6
from arpent.functions import geometry as ge
from arpent.operators import outlines as ou
from arpent.operators import polygons as po
from arpent.operators.joins import BOX

_MID = "(xmin + xmax) / 2", "(ymin + ymax) / 2"


def ell(df: DataFrame, *keep: str) -> DataFrame:
    """(keep, rings): L-shaped polygons."""
    xm, ym = (F.expr(m) for m in _MID)
    p = lambda x, y: F.struct((F.col(x) if isinstance(x, str) else x).alias("x"), (F.col(y) if isinstance(y, str) else y).alias("y"))
    ring = F.array(p("xmin", "ymin"), p("xmax", "ymin"), p("xmax", ym), p(xm, ym), p(xm, "ymax"), p("xmin", "ymax"), p("xmin", "ymin"))
    return df.select(*keep, F.array(ring).alias("rings"))


def boxes(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, ge.box_polygon(*[F.col(c) for c in BOX]).alias("rings"))


def _part(a: tuple, b: tuple) -> str:
    """Area that two boxes share."""
    return f"greatest(least({a[2]}, {b[2]}) - greatest({a[0]}, {b[0]}), 0.0) * greatest(least({a[3]}, {b[3]}) - greatest({a[1]}, {b[1]}), 0.0)"


def _box(t: str) -> tuple:
    return f"{t}.xmin", f"{t}.ymin", f"{t}.xmax", f"{t}.ymax"


def _quarter(t: str) -> tuple:
    return f"({t}.xmin + {t}.xmax) / 2", f"({t}.ymin + {t}.ymax) / 2", f"{t}.xmax", f"{t}.ymax"


#: L of a with the box of b, and L of a with L of b.
_EB = f"({_part(_box('a'), _box('b'))} - {_part(_quarter('a'), _box('b'))})"
_EE = f"({_EB} - ({_part(_box('a'), _quarter('b'))} - {_part(_quarter('a'), _quarter('b'))}))"
_ARC = "16 * sin(pi() / 16)"


@query("geo_buffer", f"SELECT fid, round((xmax - xmin) * (ymax - ymin) * 0.75 + 2 * (xmax - xmin + ymax - ymin) * 1.5 - 2.25 + 1.25 * {_ARC} * 2.25, 4) AS area, 1 AS parts FROM zone_ov WHERE xmax - xmin > 3 AND ymax - ymin > 3")
def _(t):
    z = ell(t("zone_ov").where("xmax - xmin > 3 AND ymax - ymin > 3"), "fid").withColumn("p", po.buffered(F.col("rings"), 1.5))
    return z.select("fid", F.round(po.parts_area(F.col("p")), 4).alias("area"), F.size("p").alias("parts"))


@query("geo_buffer_by_column", f"SELECT fid, round((xmax - xmin) * (ymax - ymin) + 2 * (xmax - xmin + ymax - ymin) * d + {_ARC} * d * d, 4) AS area FROM (SELECT *, CASE WHEN zoning % 4 = 0 THEN 2.0 ELSE zoning % 4 * 0.5 END AS d FROM zone_ov)")
def _(t):
    z = boxes(t("zone_ov"), "fid", (F.col("zoning") % 4 * 0.5).alias("d"))
    return z.select("fid", F.round(po.parts_area(po.buffered(F.col("rings"), F.col("d"), default=2.0)), 4).alias("area"))


@query("geo_erode", "SELECT fid, round(CASE WHEN xmax - xmin > 3 AND ymax - ymin > 3 THEN (xmax - xmin - 3) * (ymax - ymin - 3) ELSE 0.0 END, 6) AS area FROM zone_ov")
def _(t):
    return boxes(t("zone_ov"), "fid").select("fid", F.round(po.parts_area(po.buffered(F.col("rings"), -1.5)), 6).alias("area"))


@query("geo_simplify", "SELECT fid, 7 AS points, round((xmax - xmin) * (ymax - ymin) * 0.75, 6) AS area FROM zone_ov")
def _(t):
    """L shapes with a point in the middle of each edge, moved by less than the tolerance."""
    ring = F.element_at("rings", 1)
    dense = F.concat(F.flatten(F.transform(ge.segments(ring), lambda s: F.array(s["p"], F.struct(((s["p"]["x"] + s["q"]["x"]) / 2 + 0.01).alias("x"), ((s["p"]["y"] + s["q"]["y"]) / 2 - 0.01).alias("y"))))), F.slice(ring, 1, 1))
    p = ell(t("zone_ov"), "fid").select("fid", po.simplified(F.array(dense), 0.05).alias("p"))
    return p.select("fid", F.size(F.element_at("p", 1)).alias("points"), F.round(ge.area(F.col("p")), 6).alias("area"))


@query("geo_hull", "SELECT fid, 6 AS points, round((xmax - xmin) * (ymax - ymin) * 0.875, 6) AS area, 7 AS contour FROM zone_ov")
def _(t):
    p = ell(t("zone_ov"), "fid").select("fid", "rings", po.convex_hull(F.col("rings")).alias("p"))
    return p.select("fid", F.size(F.element_at("p", 1)).alias("points"), F.round(ge.area(F.col("p")), 6).alias("area"), F.size(F.element_at(po.outer_contour(F.col("rings")), 1)).alias("contour"))


@query("geo_make_valid", "SELECT fid, fid % 2 = 1 AS valid, CASE WHEN fid % 2 = 0 THEN 2 ELSE 1 END AS parts, round((xmax - xmin) * (ymax - ymin) / CASE WHEN fid % 2 = 0 THEN 2 ELSE 1 END, 6) AS area FROM bld")
def _(t):
    """Every other box with two corners exchanged, so that its ring crosses itself."""
    ring = F.element_at("rings", 1)
    bow = F.array(F.element_at(ring, 1), F.element_at(ring, 3), F.element_at(ring, 2), F.element_at(ring, 4), F.element_at(ring, 1))
    p = boxes(t("bld"), "fid").select("fid", F.array(F.when(F.col("fid") % 2 == 0, bow).otherwise(ring)).alias("rings"))
    p = p.select("fid", po.is_valid(F.col("rings")).alias("valid"), po.made_valid(F.col("rings")).alias("p"))
    return p.select("fid", "valid", F.size("p").alias("parts"), F.round(po.parts_area(F.col("p")), 6).alias("area"))


@query("geo_perpendiculars", "SELECT seg, round((x1 + x2) / 2 - (y2 - y1) / sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) * 4, 6) AS lx, round((y1 + y2) / 2 + (x2 - x1) / sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) * 4, 6) AS ly, round((x1 + x2) / 2 + (y2 - y1) / sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) * 4, 6) AS rx, round((y1 + y2) / 2 - (x2 - x1) / sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) * 4, 6) AS ry FROM coast")
def _(t):
    p = ge.perpendicular(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], 4.0)
    return t("coast").select("seg", *[F.round(c, 6).alias(n) for c, n in zip(p, ("lx", "ly", "rx", "ry"), strict=True)])


@query("geo_reduce_lines", "SELECT seg, round(x1 + (x2 - x1) / sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2), 6) AS x1, round(y2 - (y2 - y1) / sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2), 6) AS y2 FROM coast")
def _(t):
    e = ge.extend_segment(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], -1)
    return t("coast").select("seg", F.round(e[0], 6).alias("x1"), F.round(e[3], 6).alias("y2"))


@query("geo_snap_vertices", "SELECT fid, round(xmin / 0.5) * 0.5 AS x, xmax AS x2 FROM bld")
def _(t):
    """The left edge of each building to a lattice of half a unit."""
    p = boxes(t("bld"), "fid", "xmin").select("fid", ge.snap_vertices(F.col("rings"), F.col("xmin"), 0.5).alias("p"))
    return p.select("fid", F.element_at(F.element_at("p", 1), 1)["x"].alias("x"), F.element_at(F.element_at("p", 1), 2)["x"].alias("x2"))


@query("jn_polygon_intersection", f"SELECT a.fid AS a, b.fid AS b, round({_EB}, 5) AS area, round({_EB}, 5) AS pieces FROM zone_ov a JOIN zone b ON {_EB} > 1e-9")
def _(t):
    p = po.intersection(ell(t("zone_ov"), "fid"), boxes(t("zone"), "fid"), CELL)
    return p.select(F.col("a_fid").alias("a"), F.col("b_fid").alias("b"), F.round("area", 5).alias("area"), F.round(po.parts_area(F.col("parts")), 5).alias("pieces"))


@query("jn_polygon_meeting", f"SELECT a.fid AS a, b.fid AS b, round({_EE}, 5) AS area FROM zone_ov a JOIN bld b ON {_EE} > 1e-9")
def _(t):
    p = po.meeting(ell(t("zone_ov"), "fid"), ell(t("bld"), "fid"), CELL)
    return p.select(F.col("a_fid").alias("a"), F.col("b_fid").alias("b"), F.round("area", 5).alias("area"))


@query("jn_polygon_difference", f"SELECT a.fid, round((a.xmax - a.xmin) * (a.ymax - a.ymin) * 0.75 - coalesce(sum(greatest({_EB}, 0)), 0), 5) AS area FROM zone_ov a LEFT JOIN zone b ON b.fid % 2 = 0 GROUP BY a.fid, a.xmin, a.xmax, a.ymin, a.ymax")
def _(t):
    p = po.difference(ell(t("zone_ov"), "fid"), boxes(t("zone").where("fid % 2 = 0"), "fid"), CELL)
    return p.select("fid", F.round(po.parts_area(F.col("parts")), 5).alias("area"))


@query("jn_polygon_delete_intersecting", f"SELECT 'zone' AS layer, a.fid FROM zone_ov a WHERE NOT EXISTS (SELECT 1 FROM bld b WHERE {_EE} > 1e-9) UNION ALL SELECT 'bld', b.fid FROM bld b WHERE NOT EXISTS (SELECT 1 FROM zone_ov a WHERE {_EE} > 1e-9)")
def _(t):
    a, b = po.delete_meeting_polygons(ell(t("zone_ov"), "fid"), ell(t("bld"), "fid"), CELL)
    return a.select(F.lit("zone").alias("layer"), "fid").union(b.select(F.lit("bld"), "fid"))


_GAPS = "greatest(a.xmin - b.xmax, b.xmin - a.xmax, 0.0)", "greatest(a.ymin - b.ymax, b.ymin - a.ymax, 0.0)"


@query("jn_polygons_within_distance", f"SELECT a.fid AS a, b.fid AS b, round(sqrt({_GAPS[0]} ** 2 + {_GAPS[1]} ** 2), 6) AS distance FROM zone_ov a JOIN bld b ON sqrt({_GAPS[0]} ** 2 + {_GAPS[1]} ** 2) <= 2.5")
def _(t):
    p = po.polygons_within(boxes(t("zone_ov"), "fid"), boxes(t("bld"), "fid"), 2.5, CELL)
    return p.select(F.col("a_fid").alias("a"), F.col("b_fid").alias("b"), *r6("distance"))


_IN_ELL = f"x >= xmin AND x < xmax AND y >= ymin AND y < ymax AND NOT (x >= {_MID[0]} AND y >= {_MID[1]})"


@query("jn_points_in_polygons", f"SELECT zone_ov.fid, count(*) AS n FROM zone_ov JOIN pt ON {_IN_ELL} GROUP BY zone_ov.fid")
def _(t):
    return po.points_in_polygons(t("pt"), ell(t("zone_ov"), "fid"), CELL).groupBy(F.col("b_fid").alias("fid")).agg(F.count("*").alias("n"))


@query("jn_polygons_containing", f"SELECT fid FROM zone_ov WHERE EXISTS (SELECT 1 FROM pt WHERE pt.z > 5000 AND {_IN_ELL})")
def _(t):
    return po.polygons_containing(ell(t("zone_ov"), "fid"), t("pt").where("z > 5000"), CELL).select("fid")


@query("jn_polygons_met_by_lines", "SELECT fid FROM zone_ov WHERE EXISTS (SELECT 1 FROM bld b WHERE b.ymin > zone_ov.ymin AND b.ymin < zone_ov.ymax AND b.xmin < CASE WHEN b.ymin < (zone_ov.ymin + zone_ov.ymax) / 2 THEN zone_ov.xmax ELSE (zone_ov.xmin + zone_ov.xmax) / 2 END AND b.xmax > zone_ov.xmin)")
def _(t):
    """L shapes that the lower side of a building, moved off their edges, lies in, ends in or crosses."""
    lines = t("bld").select(F.col("xmin").alias("x1"), F.col("ymin").alias("y1"), F.col("xmax").alias("x2"), F.col("ymin").alias("y2"))
    return po.polygons_met_by_lines(ell(t("zone_ov"), "fid"), lines, CELL).select("fid")


@query("jn_polygon_covered_by", "SELECT a.fid, (SELECT b.fid FROM zone_ov b WHERE b.fid <> a.fid AND b.xmin <= a.xmin AND b.ymin <= a.ymin AND b.xmax >= a.xmax AND b.ymax >= a.ymax ORDER BY (b.xmax - b.xmin) * (b.ymax - b.ymin), b.fid LIMIT 1) AS within FROM zone_ov a")
def _(t):
    return po.covered_by(boxes(t("zone_ov"), "fid"), CELL)


@query("jn_shared_borders", "SELECT a.fid AS a, b.fid AS b, CASE WHEN a.xmax = b.xmin OR b.xmax = a.xmin THEN least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin) ELSE least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin) END AS length FROM zone a JOIN zone b ON a.fid <> b.fid AND (((a.xmax = b.xmin OR b.xmax = a.xmin) AND least(a.ymax, b.ymax) > greatest(a.ymin, b.ymin)) OR ((a.ymax = b.ymin OR b.ymax = a.ymin) AND least(a.xmax, b.xmax) > greatest(a.xmin, b.xmin)))")
def _(t):
    return po.shared_borders(boxes(t("zone"), "fid"), CELL)


@query("jn_split_polygons", "SELECT fid, 2 AS parts, round((xmax - xmin) * (ymax - ymin) * 0.75, 5) AS area FROM zone_ov")
def _(t):
    """Each L cut along a slanted line through its lower left quarter."""
    z = t("zone_ov")
    line = z.select(F.col("xmin").alias("x1"), (F.col("ymin") + (F.col("ymax") - F.col("ymin")) / 4).alias("y1"), F.col("xmax").alias("x2"), (F.col("ymin") + (F.col("ymax") - F.col("ymin")) / 3).alias("y2"), "fid")
    own = ell(z, "fid").join(line, "fid")
    parts = po.split_each(own, ("x1", "y1", "x2", "y2"))
    return parts.select("fid", F.size("parts").alias("parts"), F.round(po.parts_area(F.col("parts")), 5).alias("area"))


@query("jn_rasterize_polygons", f"SELECT pid, coalesce((SELECT max(fid) FROM zone_ov WHERE {_IN_ELL}), 0) AS burned FROM px")
def _(t):
    px = t("px").select("pid", "x", "y")
    last = po.points_in_polygons(px, ell(t("zone_ov"), "fid"), CELL).groupBy(F.col("p_pid").alias("pid")).agg(F.max("b_fid").alias("burned"))
    return px.select("pid").join(last, "pid", "left").select("pid", F.coalesce("burned", F.lit(0)).alias("burned"))


@query("ag_zonal_stats_polygons", f"WITH v AS (SELECT fid, red FROM zone_ov JOIN px ON {_IN_ELL}), s AS (SELECT fid, count(*) AS n, round(avg(red), 6) AS mean, max(red) AS most FROM v GROUP BY fid) SELECT fid, coalesce(n, 0) AS count, mean, most AS max FROM zone_ov LEFT JOIN s USING (fid)")
def _(t):
    from arpent.operators.zonal import zonal_stats

    z = po.with_box(ell(t("zone_ov"), "fid"))
    return zonal_stats(z, t("px"), "red", ("count", "mean", "max")).select("fid", "count", *r6("mean"), "max")


@query("ag_dissolve_polygons", "SELECT fid % 5 AS kind, round(sum((xmax - xmin) * (ymax - ymin)), 5) AS area FROM zone GROUP BY 1")
def _(t):
    """Zones drawn twice, once as they are and once as L shapes: a union counts each place once."""
    z = t("zone").withColumn("kind", F.col("fid") % 5)
    twice = boxes(z, "kind").unionByName(ell(z, "kind"))
    return po.dissolve(twice, "kind", 10.0).groupBy("kind").agg(F.round(F.sum(po.parts_area(F.col("parts"))), 5).alias("area"))


@query("wn_remove_overlaps_polygons", "SELECT a.fid, round((a.xmax - a.xmin) * (a.ymax - a.ymin) * CASE WHEN a.k = 0 THEN 0.25 ELSE 0.75 END, 5) AS area FROM (SELECT zone.*, k FROM zone, range(0, 2) r(k)) a")
def _(t):
    """Each zone as a box and, later, as an L: the box keeps the quarter."""
    z = t("zone")
    two = boxes(z, (F.col("fid") * 2).alias("id")).unionByName(ell(z, (F.col("fid") * 2 + 1).alias("id")))
    p = po.remove_overlaps(two, CELL, key="id")
    return p.select(F.floor(F.col("id") / 2).alias("fid"), F.round(po.parts_area(F.col("parts")), 5).alias("area"))


_CC_RINGS = """WITH RECURSIVE e AS (SELECT p.pid AS a, q.pid AS b FROM px p JOIN px q ON p.cls = q.cls AND abs(p.r - q.r) + abs(p.c - q.c) = 1),
w(pid, root) AS (SELECT pid, pid FROM px UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.pid WHERE w.root < e.b), l AS (SELECT pid, min(root) AS region FROM w GROUP BY pid),
g AS (SELECT region, r, c FROM l JOIN px USING (pid)), s AS (SELECT a.region, count(*) AS inner_ FROM g a JOIN g b ON a.region = b.region AND abs(a.r - b.r) + abs(a.c - b.c) = 1 GROUP BY a.region)
SELECT region, CAST(count(*) AS DOUBLE) AS area, CAST(4 * count(*) - coalesce(min(inner_), 0) AS DOUBLE) AS outline FROM g LEFT JOIN s USING (region) GROUP BY region"""


@query("cc_polygonize_rings", _CC_RINGS.replace("WITH RECURSIVE", "WITH", 1))
def _(t):
    from arpent.operators.lineage import settle
    from arpent.operators.regions import connected_components

    reg = settle(connected_components(t("px").select("pid", "r", "c", "x", "y", "cls"), "cls"))
    p = ou.region_outlines(reg, "region", tile=64.0)
    return p.select("region", F.round("area", 6).alias("area"), F.round(ge.perimeter(F.col("rings")), 6).alias("outline"))
