"""Registered queries of outlines: dissolves, coverages, planar graphs, offsets and rings of lines, and the coast as a line."""

from __future__ import annotations

from pyspark.sql import functions as F

from arpent.catalogue import CELL, query, r6
from arpent.catalogue_more import _recursive
from arpent.catalogue_shapes import boxes, ell
from arpent.functions import geometry as ge
from arpent.operators import coast as co
from arpent.operators import noding as nd
from arpent.operators import outlines as ou
from arpent.operators.lineage import settle
from arpent.operators.regions import connected_components


def _total(df, *by):
    return df.groupBy(*by).agg(F.round(F.sum("area"), 5).alias("area"), F.round(F.sum(ge.perimeter(F.col("rings"))), 5).alias("outline"), F.count("*").alias("parts"))


@query("ag_dissolve_whole", "SELECT fid % 5 AS kind, round(sum((xmax - xmin) * (ymax - ymin)), 5) AS area, round(2 * (max(xmax) - min(xmin) + max(ymax) - min(ymin)), 5) AS outline, 1 AS parts FROM zone GROUP BY 1")
def _(t):
    """Zones of a column of the grid, drawn twice, as boxes and as L shapes: one feature a kind."""
    z = t("zone").withColumn("kind", F.col("fid") % 5)
    return _total(ou.dissolve_whole(boxes(z, "kind").unionByName(ell(z, "kind")), "kind", 10.0), "kind")


@query("ag_dissolve_overlapping", """WITH u AS (SELECT DISTINCT zoning, CAST(xmin AS BIGINT) + i AS x, CAST(ymin AS BIGINT) + j AS y FROM zone_ov, range(0, 20) a(i), range(0, 12) b(j) WHERE xmin + i < xmax AND ymin + j < ymax),
n AS (SELECT u.zoning, count(*) AS k FROM u JOIN u v ON u.zoning = v.zoning AND abs(u.x - v.x) + abs(u.y - v.y) = 1 GROUP BY u.zoning)
SELECT zoning, CAST(count(*) AS DOUBLE) AS area, CAST(4 * count(*) - coalesce(min(k), 0) AS DOUBLE) AS outline FROM u LEFT JOIN n USING (zoning) GROUP BY zoning""")
def _(t):
    return _total(ou.dissolve_whole(boxes(t("zone_ov"), "zoning"), "zoning", 16.0), "zoning").drop("parts")


def _regions(t):
    return settle(connected_components(t("px").select("pid", "r", "c", "x", "y", "cls"), "cls").select("r", "c", "x", "y", "region"))


@query("cc_coverage_exact", _recursive("""WITH RECURSIVE e AS (SELECT p.pid AS a, q.pid AS b FROM px p JOIN px q ON p.cls = q.cls AND abs(p.r - q.r) + abs(p.c - q.c) = 1),
w(pid, root) AS (SELECT pid, pid FROM px UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.pid WHERE w.root < e.b) SELECT region, CAST(count(*) AS DOUBLE) AS area FROM (SELECT pid, min(root) AS region FROM w GROUP BY pid) GROUP BY region"""))
def _(t):
    """Arcs between nodes, each once for both sides, simplified by no tolerance and put together again."""
    made = ou.simplify_coverage(ou.pixel_borders(_regions(t), "region"), 0.0, 64.0)
    return made.groupBy("region").agg(F.round(F.sum("area"), 6).alias("area"))


@query("cc_coverage_simplified", "SELECT CAST(count(*) AS DOUBLE) AS area, TRUE AS fewer FROM px")
def _(t):
    """Areas of a coverage of coarse regions after simplification add up to the raster, with fewer corners than before."""
    px = t("px").select("r", "c", "x", "y", (F.floor(F.col("r") / 9 + F.col("c") % 7 / 7) * 20 + F.floor(F.col("c") / 11 + F.col("r") % 5 / 5)).alias("region"))
    borders = settle(ou.pixel_borders(px, "region"))
    corners = lambda df: df.agg(F.sum(F.aggregate("rings", F.lit(0), lambda s, r: s + F.size(r))).alias("n"), F.sum("area").alias("area"))
    before, after = corners(ou.rebuilt(ou.arcs(borders, 64.0), 64.0)), corners(ou.simplify_coverage(borders, 1.2, 64.0, outer=False))
    return after.crossJoin(before.select(F.col("n").alias("m"))).select(F.round("area", 6).alias("area"), (F.col("n") < F.col("m")).alias("fewer"))  # one row each


@query("cc_coverage_polygons", "SELECT fid, round((xmax - xmin) * (ymax - ymin), 6) AS area FROM zone")
def _(t):
    """Zones as a coverage of polygons: borders from equal edges, arcs, polygons again, and the source that covers most of each."""
    z = boxes(t("zone"), "fid")
    made = ou.simplify_coverage(ou.polygon_borders(z), 0.5, 64.0)
    return ou.with_source(made, z, CELL).select("fid", *r6("area"))


@query("jn_split_by_polylines", """SELECT fid, round((xmax - xmin) / 2 * (ymax - ymin) * 0.75, 5) AS area, round(2 * ((xmax - xmin) / 2 + (ymax - ymin) * 0.75), 5) AS outline FROM zone
UNION ALL SELECT fid, round((xmax - xmin) * (ymax - ymin) - (xmax - xmin) / 2 * (ymax - ymin) * 0.75, 5), round(2 * (xmax - xmin + ymax - ymin), 5) FROM zone""")
def _(t):
    """Each zone cut by a bent line across it, and left whole by one that ends inside and by one along its edge."""
    z = t("zone")
    p = lambda x, y: F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y"))
    bent = z.select("fid", F.array(p("xmin - 0.01", "ymin + (ymax - ymin) / 4"), p("(xmin + xmax) / 2", "ymin + (ymax - ymin) / 4"), p("(xmin + xmax) / 2", "ymax + 0.01")).alias("line"))
    loose = z.select("fid", F.array(p("xmax + 0.01", "(ymin + ymax) / 2"), p("xmax - 3", "(ymin + ymax) / 2"), p("xmax - 4", "(ymin + ymax) / 2 - 0.2")).alias("line"))
    along = z.select("fid", F.array(p("xmin + 1", "ymin"), p("xmin + 5", "ymin")).alias("line"))
    made = nd.split_by_polylines(boxes(z, "fid"), bent.unionByName(loose).unionByName(along).select("line"), CELL)
    return made.select("fid", F.round("area", 5).alias("area"), F.round(ge.perimeter(F.col("rings")), 5).alias("outline"))


#: Lines of three points from neighbouring segments of the coast, with the angle between them.
_BENT = """WITH b AS (SELECT a.seg, a.x1, a.y1, a.x2, a.y2, b.x2 AS x3, b.y2 AS y3 FROM coast a JOIN coast b ON b.seg = a.seg + 1),
m AS (SELECT *, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) + sqrt((x3 - x2) ** 2 + (y3 - y2) ** 2) AS len, atan2((x2 - x1) * (y3 - y2) - (y2 - y1) * (x3 - x2), (x2 - x1) * (x3 - x2) + (y2 - y1) * (y3 - y2)) AS turn FROM b),
k AS (SELECT *, greatest(1, ceil(abs(turn) / (pi() / 16) - 1e-9)) AS n FROM m)"""


def _bent(t):
    a, b = t("coast"), t("coast").select((F.col("seg") - 1).alias("seg"), F.col("x2").alias("x3"), F.col("y2").alias("y3"))
    p = lambda k: F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"))
    return a.join(b, "seg").select("seg", F.array(p(1), p(2), p(3)).alias("line"))


@query("geo_offset_curve", f"{_BENT} SELECT seg, round(CASE WHEN turn > 0 THEN len - 2 * tan(turn / 2) ELSE len + 2 * n * sin(-turn / 2 / n) END, 5) AS leftward, round(CASE WHEN turn < 0 THEN len - 2 * 0.5 * tan(-turn / 2) ELSE len + 2 * 0.5 * n * sin(turn / 2 / n) END, 5) AS rightward FROM k")
def _(t):
    """Lengths of the curves 1 to the left and 0.5 to the right."""
    of = lambda d, name: co.offset_curves(_bent(t), d, 8.0, "seg").select("seg", F.round(ge.length(F.col("points")), 5).alias(name))
    return of(1.0, "leftward").join(of(-0.5, "rightward"), "seg")


@query("geo_side_buffer", f"{_BENT} SELECT seg, round(len + CASE WHEN turn > 0 THEN -tan(turn / 2) ELSE n * sin(-turn / n) / 2 END, 5) AS area FROM k")
def _(t):
    return co.side_buffer(_bent(t), 1.0, 8.0, key="seg").groupBy("seg").agg(F.round(F.sum("area"), 5).alias("area"))


_DISK = "16 * sin(pi() / 16)"


@query("geo_joint_buffer", f"SELECT fid % 5 AS kind, round((max(xmax) - min(xmin)) * (max(ymax) - min(ymin)) + 2 * 1.5 * (max(xmax) - min(xmin) + max(ymax) - min(ymin)) + {_DISK} * 2.25, 4) AS area, 1 AS parts FROM zone GROUP BY 1")
def _(t):
    """Zones of a column united and grown by 1.5."""
    z = boxes(t("zone").withColumn("kind", F.col("fid") % 5), "kind")
    return co.joint_buffer(z, 1.5, 12.0, "kind").groupBy("kind").agg(F.round(F.sum("area"), 4).alias("area"), F.count("*").alias("parts"))


@query("geo_joint_erode", "SELECT fid % 5 AS kind, round((max(xmax) - min(xmin) - 3) * (max(ymax) - min(ymin) - 3), 4) AS area FROM zone GROUP BY 1")
def _(t):
    """What lies deeper than 1.5 in the zones of a column, whose inner borders do not count."""
    z = boxes(t("zone").withColumn("kind", F.col("fid") % 5), "kind")
    return co.joint_buffer(z, -1.5, 12.0, "kind").groupBy("kind").agg(F.round(F.sum("area"), 4).alias("area"))


@query("set_ring_zones", f"SELECT seg, CAST(k AS INTEGER) AS ring, round(2 * sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) * 2 + {_DISK} * 4 * (2 * k - 1), 4) AS area, CASE WHEN k = 1 THEN 1 ELSE 2 END AS rings FROM coast, range(1, 4) r(k)")
def _(t):
    """Three rings of width 2 around each segment of the coast: a polygon each, with a hole from the second on."""
    made = co.ring_zones(t("coast"), 2.0, 3, 12.0, "seg")
    return made.select("seg", "ring", F.round("area", 4).alias("area"), F.size("rings").alias("rings"))


#: Sea pixels of regions that hold a point.
_SEA = """b AS (SELECT pid, r, c, x, y, (nir < 128)::INT AS sea FROM px), e AS (SELECT p.pid AS a, q.pid AS b FROM b p JOIN b q ON p.sea = 1 AND q.sea = 1 AND abs(p.r - q.r) + abs(p.c - q.c) = 1),
w(pid, root) AS (SELECT pid, pid FROM b WHERE sea = 1 UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.pid WHERE w.root < e.b), l AS (SELECT pid, min(root) AS region FROM w GROUP BY pid),
s AS (SELECT DISTINCT l.region FROM pt, grid_meta JOIN b ON b.c = floor(pt.x) AND b.r = h - 1 - floor(pt.y) JOIN l USING (pid)), g AS (SELECT region, b.* FROM l JOIN s USING (region) JOIN b USING (pid))"""


def _seeds(t):
    h = t("grid_meta").select("h")
    return t("pt").crossJoin(F.broadcast(h)).select((F.col("h") - 1 - F.floor("y")).alias("r"), F.floor("x").alias("c"))  # grid_meta has one row


@query("dm_sea_regions", _recursive(f"WITH RECURSIVE {_SEA} SELECT region, count(*) AS pixels FROM g GROUP BY region"))
def _(t):
    """Sea regions by a threshold that hold a sea point, by the pixel in which it lies."""
    px = t("px").select("pid", "r", "c", "x", "y", (F.col("nir") < 128).cast("int").alias("sea"))
    return co.sea_regions(px, "sea", _seeds(t)).groupBy("region").agg(F.count("*").alias("pixels"))


@query("dm_coastline", _recursive(f"""WITH RECURSIVE {_SEA}, o AS (SELECT g.x, g.y, d.i, d.j FROM g CROSS JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) d(i, j) LEFT JOIN g n ON n.r = g.r + d.i AND n.c = g.c + d.j WHERE n.pid IS NULL),
k AS (SELECT x + j * 0.5 AS mx, y - i * 0.5 AS my, i FROM o), q AS (SELECT CASE WHEN i = 0 THEN CASE WHEN mx > 1.5 AND mx < w - 1.5 THEN greatest(0, least(my + 0.5, h - 1.5) - greatest(my - 0.5, 1.5)) ELSE 0 END ELSE CASE WHEN my > 1.5 AND my < h - 1.5 THEN greatest(0, least(mx + 0.5, w - 1.5) - greatest(mx - 0.5, 1.5)) ELSE 0 END END AS len FROM k, grid_meta)
SELECT round(sum(len), 4) AS length FROM q"""))
def _(t):
    """The sea's border as joined lines, without what lies near the picture's edge."""
    px = t("px").select("pid", "r", "c", "x", "y", (F.col("nir") < 128).cast("int").alias("sea"), F.lit(1).alias("valid"))
    return co.coastline(px, "sea", _seeds(t), "valid", close=0, rim=1.5).agg(F.round(F.sum("length"), 4).alias("length"))


_NEAREST = """WITH d AS (SELECT pt.fid, seg, x2 - x1 AS dx, y2 - y1 AS dy, x - x1 AS ex, y - y1 AS ey, greatest(0, least(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2))) AS t FROM pt CROSS JOIN coast),
n AS (SELECT fid, round(sqrt((ex - t * dx) ** 2 + (ey - t * dy) ** 2), 9) AS distance, CASE WHEN dx * ey - dy * ex > 0 THEN 1 ELSE -1 END AS side FROM d QUALIFY row_number() OVER (PARTITION BY fid ORDER BY distance, seg) = 1)"""


@query("dm_side_of_coast", f"{_NEAREST} SELECT fid, side FROM n")
def _(t):
    return co.side_and_distance(t("pt").select("fid", "x", "y"), t("coast"), CELL).select("fid", "side")


@query("dm_signed_distance_rings", f"{_NEAREST} SELECT fid, side * CAST(greatest(1, ceil(distance / 3)) AS INTEGER) AS ring FROM n WHERE greatest(1, ceil(distance / 3)) <= 5")
def _(t):
    from arpent.operators.tables import ring_index

    near = co.side_and_distance(t("pt").select("fid", "x", "y"), t("coast"), CELL)
    return near.select("fid", (F.col("side") * ring_index(F.col("distance"), 3, 5)).alias("ring")).where("ring IS NOT NULL")
