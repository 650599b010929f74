"""Registered queries of sources, filters, lines, segments, samples and learners."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arpent.catalogue import _AREA, _IN, _MEET, _SEG_D, CELL, query, r6
from arpent.functions import geometry as ge
from arpent.operators import joins as jn
from arpent.operators import learning as le
from arpent.operators import lines as ln
from arpent.operators import segments as sg
from arpent.operators.lineage import fresh_path
from arpent.plans import urban
from arpent.sources import layers as ly
from arpent.sources import tables as st

# --- sources and filters ---------------------------------------------------------------------------------------------


@query("src_feature_lines", "SELECT fid, nature, round(hauteur, 6) AS hauteur, 'Point' AS geometry_type, xmin AS x, ymin AS y FROM bld")
def _(t):
    b = t("bld")
    path = fresh_path(b.sparkSession, "features")
    ly.write_features(b, path, "Point", F.array("xmin", "ymin"), ["nature", "hauteur"])
    f = ly.read_feature_lines(b.sparkSession, path, "nature: string, hauteur: double", "array<double>")
    return f.select("fid", "nature", *r6("hauteur"), "geometry_type", F.col("coordinates")[0].alias("x"), F.col("coordinates")[1].alias("y"))


@query("src_csv_table", "SELECT fid, nature, hauteur FROM bld")
def _(t):
    b = t("bld").select("fid", "nature", "hauteur")
    path = fresh_path(b.sparkSession, "csv")
    st.write_csv_table(b, path, ";")
    return st.read_csv_table(b.sparkSession, path, "fid long, nature string, hauteur double", ";")


@query("src_partition_by_attribute", "SELECT nature, count(*) AS n, max(fid) AS last FROM bld GROUP BY nature")
def _(t):
    b = t("bld").select("fid", "nature")
    path = fresh_path(b.sparkSession, "parts")
    st.partition_by_attribute(b, "nature", path)
    return b.sparkSession.read.parquet(path).groupBy("nature").agg(F.count("*").alias("n"), F.max("fid").alias("last"))


@query("src_confusion_text", "SELECT CAST(n_nationkey AS INTEGER) AS ref, CAST(p AS INTEGER) AS prod, CAST(n_nationkey * 3 + p AS DOUBLE) AS n FROM nation, range(0, 4) r(p)")
def _(t):
    """Matrix lines written from nation: labels, then a row of counts for each."""
    k = F.col("n_nationkey")
    row = t("nation").select((k + 2).alias("no"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda p: (k * 3 + p).cast("string")), ",").alias("value"))
    head = t("nation").agg(F.array_join(F.transform(F.array_sort(F.collect_list("n_nationkey")), lambda x: x.cast("string")), ",").alias("l"))
    lines = row.unionByName(head.select(F.lit(0).cast("long").alias("no"), F.concat(F.lit("ref:"), "l").alias("value"))).unionByName(head.select(F.lit(1).cast("long").alias("no"), F.lit("prod:0,1,2,3").alias("value")))
    return st.confusion_from_text(lines).select("ref", "prod", "n")


@query("src_centroids_text", "SELECT n_regionkey AS macro, CAST(n_nationkey AS INTEGER) AS micro, CAST(d AS INTEGER) AS dim, CAST(n_nationkey * 2 + d AS DOUBLE) AS value FROM nation, range(0, 3) r(d)")
def _(t):
    k = F.col("n_nationkey")
    return st.centroids_from_text(t("nation").select(F.col("n_regionkey").alias("macro"), F.concat_ws(" ", k, k * 2, k * 2 + 1, k * 2 + 2).alias("value")))


@query("src_features_from_rows", "SELECT fid, CAST(k AS INTEGER) AS k, CASE WHEN k IN (0, 3) THEN xmin ELSE xmax END AS x, CASE WHEN k < 2 THEN ymin ELSE ymax END AS y FROM bld, range(0, 4) r(k)")
def _(t):
    p = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    rows = t("bld").withColumn("corners", F.array(p("xmin", "ymin"), p("xmax", "ymin"), p("xmax", "ymax"), p("xmin", "ymax")))
    return ly.points_from_layer(ly.features_from_rows(rows, "corners", {"fid": "fid"}), ["fid"]).select("fid", "k", "x", "y")


@query("flt_geometry_type", "SELECT fid FROM bld WHERE fid % 3 = 0 AND fid % 5 <> 0")
def _(t):
    k = F.col("fid")
    rings = F.when(k % 5 != 0, ge.box_polygon(*[F.col(c) for c in jn.BOX]))
    return ly.filter_geometry_type(t("bld").select("fid", F.when(k % 3 == 0, "Polygon").when(k % 3 == 1, "LineString").alias("geometry_type"), rings.alias("rings")), "Polygon").select("fid")


@query("flt_points_by_raster_range", "SELECT fid FROM pt JOIN px ON c = floor(pt.x) AND r = floor((SELECT h FROM grid_meta) - pt.y) WHERE red BETWEEN 50 AND 150 AND nir BETWEEN 20 AND 200 AND z IS NOT NULL")
def _(t):
    p = t("pt").join(F.broadcast(t("grid_meta").select("h"))).withColumn("y", -(F.col("h") - F.col("y")))
    return jn.filter_points_by_raster_range(p.select("fid", "x", "y", "z"), t("px"), {"red": (50, 150), "nir": (20, 200)}, 0, 0).select("fid")


# --- lines -----------------------------------------------------------------------------------------------------------


def _turned(t) -> DataFrame:
    """The coast with every other segment the other way round, and without one in the middle."""
    odd = F.col("seg") % 2 == 1
    way = lambda a, b: F.when(odd, F.col(b)).otherwise(F.col(a))
    return t("coast").where("seg <> 12").select("seg", way("x1", "x2").alias("x1"), way("y1", "y2").alias("y1"), way("x2", "x1").alias("x2"), way("y2", "y1").alias("y2"))


@query("cc_merge_connected_lines", "SELECT CASE WHEN seg < 12 THEN 0 ELSE 13 END AS chain, count(*) AS segments, count(*) + 1 AS points, round(sum(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)), 5) AS length FROM coast WHERE seg <> 12 GROUP BY 1")
def _(t):
    out = ln.merge_connected_lines(_turned(t))
    return out.select("chain", "segments", F.size("line").cast("long").alias("points"), F.round(ge.length(F.col("line")), 5).alias("length"))


@query("dm_merge_coastlines", "SELECT CASE WHEN seg < 12 THEN 0 ELSE 13 END AS chain, count(*) AS segments, 2 * count(*) AS points FROM coast WHERE seg <> 12 GROUP BY 1")
def _(t):
    return ln.smooth_coast(_turned(t)).select("chain", "segments", F.size("line").cast("long").alias("points"))


_REFS = "(SELECT DISTINCT CAST((n_nationkey * 9) % 125 AS DOUBLE) AS x FROM nation)"


@query("cc_extend_to_reference", f"SELECT fid AS seg, coalesce((SELECT max(x) FROM {_REFS} WHERE x BETWEEN xmin - 3 AND xmin), xmin) AS x1, coalesce((SELECT min(x) FROM {_REFS} WHERE x BETWEEN xmax AND xmax + 3), xmax) AS x2, round((ymin + ymax) / 2, 6) AS y FROM bld")
def _(t):
    y = (F.col("ymin") + F.col("ymax")) / 2
    stubs = t("bld").select(F.col("fid").alias("seg"), F.col("xmin").alias("x1"), y.alias("y1"), F.col("xmax").alias("x2"), y.alias("y2"))
    x = ((F.col("n_nationkey") * 9) % 125).cast("double")
    h = F.broadcast(t("grid_meta").select("h"))  # one row
    refs = t("nation").crossJoin(h).select(F.col("n_nationkey").alias("fid"), x.alias("x1"), F.lit(-20.0).alias("y1"), x.alias("x2"), (F.col("h") + 20.0).alias("y2"))
    return ln.extend_to_reference(stubs, refs, 3.0, CELL).select("seg", F.round("x1", 6).alias("x1"), F.round("x2", 6).alias("x2"), F.round("y1", 6).alias("y"))


@query("dm_road_skeleton", None)
def _(t):
    """Building axes as roads, the coast as skeleton."""
    y = (F.col("ymin") + F.col("ymax")) / 2
    roads = t("bld").select(F.col("fid").alias("seg"), F.col("xmin").alias("x1"), y.alias("y1"), F.col("xmax").alias("x2"), y.alias("y2"), F.col("hauteur").alias("rank"), F.col("nature").alias("kind"))
    return ln.clean_skeleton(roads, t("coast"), 10, ["none"], 5.0, CELL, 2)


def _slab(p: str, u: str, a: str, b: str) -> tuple[str, str]:
    """Where a line p + t u enters and leaves [a, b]."""
    return (f"(CASE WHEN {u} = 0 THEN CASE WHEN {p} BETWEEN {a} AND {b} THEN -1e18 ELSE 1e18 END ELSE least(({a} - {p}) / nullif({u}, 0), ({b} - {p}) / nullif({u}, 0)) END)", f"(CASE WHEN {u} = 0 THEN CASE WHEN {p} BETWEEN {a} AND {b} THEN 1e18 ELSE -1e18 END ELSE greatest(({a} - {p}) / nullif({u}, 0), ({b} - {p}) / nullif({u}, 0)) END)")


_SX, _SY = _slab("x1", "(x2 - x1)", "xmin", "xmax"), _slab("y1", "(y2 - y1)", "ymin", "ymax")


@query("cc_tag_road_polygons", f"""WITH p AS (SELECT *, (xmin + xmax) / 2 AS x, (ymin + ymax) / 2 AS y FROM bld), q AS (SELECT fid, seg, {_SEG_D} AS d, (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) > 0 AS l, greatest({_SX[0]}, {_SY[0]}, 0.0) <= least({_SX[1]}, {_SY[1]}, 1.0) AS o FROM p CROSS JOIN coast),
s AS (SELECT fid, max(o::INT) AS o, arg_min(l, (d, seg)) FILTER (o OR d <= 6) AS l FROM q WHERE o OR d <= 6 GROUP BY fid) SELECT bld.fid, CASE WHEN o = 1 THEN 'on' WHEN l THEN 'left' WHEN NOT l THEN 'right' END AS side FROM bld LEFT JOIN s USING (fid)""")
def _(t):
    return ln.tag_by_line(t("bld"), t("coast"), CELL, 6.0).select("fid", "side")


@query("jn_combine_segmentations", f"SELECT a.fid AS a, b.fid AS b, round({_AREA}, 6) AS area FROM zone_ov a JOIN zone b ON {_MEET}")
def _(t):
    return urban.combine_segmentations(t("zone_ov").select("fid", *jn.BOX), t("zone").select("fid", *jn.BOX), CELL).select("a", "b", *r6("area"))


_RX, _RY = _slab("px", "ux", "xmin", "xmax"), _slab("py", "uy", "ymin", "ymax")


@query("dm_aspect_ratio", f"""WITH s AS (SELECT *, CAST(greatest(1, ceil(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) / 2.5)) AS INTEGER) AS n FROM coast),
g AS (SELECT seg * 100 + k AS seg, x1 + k / n * (x2 - x1) AS x1, y1 + k / n * (y2 - y1) AS y1, x1 + (k + 1) / n * (x2 - x1) AS x2, y1 + (k + 1) / n * (y2 - y1) AS y2 FROM s, range(0, 100) r(k) WHERE k < n),
m AS (SELECT seg, x1 AS px, y1 AS py, -(y2 - y1) / sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS ax, (x2 - x1) / sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS ay FROM g WHERE sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) >= 1.25),
w AS (SELECT seg, px, py, 1 AS side, ax AS ux, ay AS uy FROM m UNION ALL SELECT seg, px, py, 2, -ax, -ay FROM m),
h AS (SELECT seg, side, px, py, hauteur, fid, greatest({_RX[0]}, {_RY[0]}, 0.0) AS t, least({_RX[1]}, {_RY[1]}) AS o FROM w CROSS JOIN bld),
b AS (SELECT seg, side, px, py, min(t) AS t, arg_min(hauteur, (t, fid)) AS hh FROM h WHERE t <= o AND t <= 12 GROUP BY seg, side, px, py),
a AS (SELECT seg, px AS x, py AS y, CASE WHEN sum(t) > 0 THEN sum(hh) / 2 / sum(t) END AS ratio FROM b GROUP BY seg, px, py HAVING count(*) = 2),
z AS (SELECT zone.fid, avg(ratio) AS aspect FROM zone JOIN a ON ratio > 0 AND sqrt(greatest(xmin - x, x - xmax, 0) ** 2 + greatest(ymin - y, y - ymax, 0) ** 2) <= 3 GROUP BY zone.fid) SELECT zone.fid, round(coalesce(aspect, 0), 6) AS aspect FROM zone LEFT JOIN z USING (fid)""")
def _(t):
    roads = ge.split_segments(t("coast"), 2.5).withColumn("seg", F.col("seg") * 100 + F.col("k"))
    zones = t("zone").select("fid", ge.box_polygon(*[F.col(c) for c in jn.BOX]).alias("rings"))
    return urban.aspect_ratio(roads, t("bld"), zones, 12.0, CELL, 2.5, 3.0).select("fid", *r6("aspect"))


# --- segments --------------------------------------------------------------------------------------------------------


@query("wn_fill_holes_longest_border", """WITH t AS (SELECT a.fid AS a, b.fid AS b, round((least(a.xmax + 0.001, b.xmax) - greatest(a.xmin - 0.001, b.xmin)) * (least(a.ymax + 0.001, b.ymax) - greatest(a.ymin - 0.001, b.ymin)), 6) AS l, b.zoning FROM zone_ov a JOIN zone_ov b ON a.fid <> b.fid AND a.xmin - 0.001 < b.xmax AND b.xmin < a.xmax + 0.001 AND a.ymin - 0.001 < b.ymax AND b.ymin < a.ymax + 0.001 WHERE a.fid % 4 = 0 AND b.fid % 4 <> 0),
n AS (SELECT a, arg_min(zoning, (-l, b)) AS z FROM t GROUP BY a) SELECT fid, CASE WHEN fid % 4 = 0 THEN z ELSE zoning END AS zoning FROM zone_ov LEFT JOIN n ON a = fid""")
def _(t):
    z = t("zone_ov")
    contacts = jn.touching(z, CELL).select("a", "b", F.round("border", 6).alias("length"))
    holes = z.withColumn("zoning", F.when(F.col("fid") % 4 != 0, F.col("zoning")))
    return sg.fill_by_longest_border(holes, contacts, "zoning").select("fid", "zoning")


@query("cc_simplify_coverage", """WITH s AS (SELECT p.cls AS a, q.cls AS b FROM px p LEFT JOIN px q ON q.r = p.r AND q.c = p.c + 1 UNION ALL SELECT p.cls, q.cls FROM px p LEFT JOIN px q ON q.r = p.r AND q.c = p.c - 1 UNION ALL SELECT p.cls, q.cls FROM px p LEFT JOIN px q ON q.r = p.r + 1 AND q.c = p.c UNION ALL SELECT p.cls, q.cls FROM px p LEFT JOIN px q ON q.r = p.r - 1 AND q.c = p.c)
SELECT a, b, CAST(count(*) AS DOUBLE) AS length FROM s WHERE b IS NULL OR a < b GROUP BY a, b""")
def _(t):
    e = sg.simplify_coverage(t("px").select("r", "c", "cls"), "cls")
    return e.groupBy("a", "b").agg(F.sum(F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1"))).cast("double").alias("length"))


@query("cc_superpixels", None)
def _(t):
    return sg.superpixels(t("px").select("pid", "r", "c", "red", "nir"), ["red", "nir"], 10, 20.0, 3).select("pid", "superpixel")


_STATE = "s AS (SELECT fid AS g, (xmax - xmin) * (ymax - ymin) AS size, zoning % 7 / 7.0 AS f, zoning % 3 AS cls FROM zone_ov), k AS (SELECT a.fid AS a, b.fid AS b, greatest(least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin), least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)) AS length FROM zone_ov a JOIN zone_ov b ON a.fid <> b.fid AND a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax)"


@query("cc_merge_round", f"""WITH {_STATE}, o AS (SELECT *, CASE WHEN cls = 1 THEN 60 ELSE 90 END AS most FROM s), c AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY a ORDER BY length DESC, b) <= 4),
p AS (SELECT c.a, c.b, sqrt((x.f - y.f) ** 2) AS d FROM c JOIN o x ON x.g = c.a AND x.size <= x.most JOIN s y ON y.g = c.b WHERE x.size <= 30 OR (sqrt((x.f - y.f) ** 2) < 0.3 AND x.size + y.size <= 2.5 * x.most)),
w AS (SELECT DISTINCT least(a, b) AS lo, greatest(a, b) AS hi, d FROM p QUALIFY row_number() OVER (PARTITION BY a ORDER BY d, b) = 1), e AS (SELECT lo AS g, * FROM w UNION ALL SELECT hi, * FROM w), q AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY g ORDER BY d, lo, hi) = 1)
SELECT lo, hi FROM q GROUP BY lo, hi HAVING count(*) = 2""")
def _(t):
    """Pairs of a round among overlapping zones, class 1 as urban."""
    z = t("zone_ov")
    state = z.select(F.col("fid").alias("g"), ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("size"), F.array(F.col("zoning") % 7 / 7.0).alias("features"), (F.col("zoning") % 3).alias("cls"))
    pairs = jn.box_join(z.select("fid", *jn.BOX), z.select("fid", *jn.BOX), CELL).where("a_fid <> b_fid")
    length = F.greatest(F.least("a_xmax", "b_xmax") - F.greatest("a_xmin", "b_xmin"), F.least("a_ymax", "b_ymax") - F.greatest("a_ymin", "b_ymin"))
    border = pairs.select(F.col("a_fid").alias("a"), F.col("b_fid").alias("b"), length.alias("length"))
    return sg.merge_round(state, border, 30, 60, 90, (1,), 0.3, 2.5, 4)


@query("cc_merge_similar_polygons", None)
def _(t):
    z = t("zone_ov").withColumn("size", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")))
    regions = z.select(F.col("fid").alias("node"), F.col("size").cast("double").alias("size"), F.array((F.col("zoning") / 25).cast("double"), ((F.col("fid") % 7) / 7).cast("double")).alias("features"))
    contacts = jn.touching(z.select("fid", *jn.BOX), CELL).where("a < b").select("a", "b", F.col("border").alias("length"))
    return sg.merge_similar(regions, contacts, 60.0, 200.0)


@query("cc_segment_by_similarity", None)
def _(t):
    px = t("px").select("pid", "r", "c", (F.col("red") / 256).alias("red"), (F.col("nir") / 256).alias("nir"))
    return sg.segment_by_similarity(px, ["red", "nir"], 10, 0.3, 40, 300, 0.2).select("pid", "segment")


@query("dm_urban_segmentation", None)
def _(t):
    px = t("px").select("pid", "r", "c", "x", "y", (F.col("red") / 256).alias("red"), (F.col("nir") / 256).alias("nir"))
    return urban.urban_segments(px, t("coast"), ["red", "nir"], 10, 0.3, 40, 300, 0.2, CELL, 8.0)


# --- samples, structures, crowns -------------------------------------------------------------------------------------


@query("dm_macro_samples", f"""WITH b AS (SELECT DISTINCT pid FROM px JOIN (SELECT xmin - 0.5 AS xmin, ymin - 0.5 AS ymin, xmax + 0.5 AS xmax, ymax + 0.5 AS ymax FROM bld) ON {_IN}), z AS (SELECT DISTINCT pid FROM px JOIN (SELECT xmin + 1 AS xmin, ymin + 1 AS ymin, xmax - 1 AS xmax, ymax - 1 AS ymax FROM zone_ov) ON {_IN} AND xmax > xmin AND ymax > ymin)
SELECT pid, CASE WHEN b.pid IS NULL THEN 12000 ELSE 11000 END AS macro FROM b FULL JOIN z USING (pid) WHERE b.pid IS NULL OR z.pid IS NULL""")
def _(t):
    return urban.macro_samples(t("px"), [(t("bld"), 11000, 0.5), (t("zone_ov"), 12000, -1.0)], CELL).select("pid", "macro")


@query("dm_clean_merge_samples", "SELECT 11000 AS macro, fid, round((xmax - xmin - 1) * (ymax - ymin - 1), 6) AS area FROM bld WHERE xmax - xmin > 1 AND ymax - ymin > 1 AND round((xmax - xmin - 1) * (ymax - ymin - 1), 6) >= 1.3 UNION ALL SELECT 12000, fid, (xmax - xmin - 4) * (ymax - ymin - 4) FROM zone_ov WHERE xmax - xmin > 4 AND ymax - ymin > 4 AND (xmax - xmin - 4) * (ymax - ymin - 4) >= 20")
def _(t):
    out = urban.clean_merge_samples({11000: (t("bld"), 0.5, 1.3), 12000: (t("zone_ov"), 2.0, 20.0)})
    return out.select("macro", "fid", F.round((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")), 6).alias("area"))


@query("dm_coastal_structures_by_rest", "SELECT fid, (xmax - xmin) * (ymax - ymin) AS area FROM zone_ov WHERE xmax - xmin <= 8 OR ymax - ymin <= 8")
def _(t):
    return urban.structures_by_rest(t("zone_ov"), 4.0, 1.0)


_EDGE = "WITH n AS (SELECT p.pid, p.r, p.c, q.nir AS v, q.r - p.r AS dr, q.c - p.c AS dc FROM px p JOIN px q ON abs(q.r - p.r) <= 1 AND abs(q.c - p.c) <= 1), m AS (SELECT pid, r, c FROM n GROUP BY pid, r, c HAVING count(*) = 9 AND sqrt(sum(v * dc * (2 - abs(dr))) ** 2 + sum(v * dr * (2 - abs(dc))) ** 2) > 500)"


@query("dm_coastal_structures_by_edges", f"""{_EDGE}, e AS (SELECT p.pid AS a, q.pid AS b FROM m p JOIN m q ON abs(p.r - q.r) + abs(p.c - q.c) = 1),
w(pid, root) AS (SELECT pid, pid FROM m UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.pid WHERE w.root < e.b), l AS (SELECT pid, min(root) AS region FROM w GROUP BY pid) SELECT region, count(*) AS pixels FROM l GROUP BY region HAVING count(*) >= 5""")
def _(t):
    return urban.structures_by_edges(t("px").select("pid", "r", "c", "nir"), "nir", 500.0, 5)


@query("dm_tree_crowns", """WITH h AS (SELECT pid, r, c, x, y, CAST(hgt AS DOUBLE) AS hgt FROM px JOIN height_px USING (pid) WHERE nir / (nir + red + 1) > 0.5 AND hgt > 100), e AS (SELECT p.pid AS a, q.pid AS b FROM h p JOIN h q ON abs(p.r - q.r) + abs(p.c - q.c) = 1),
w(pid, root) AS (SELECT pid, pid FROM h UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.pid WHERE w.root < e.b), l AS (SELECT pid, min(root) AS region FROM w GROUP BY pid),
t AS (SELECT region, count(*) AS pixels, max(hgt) AS top, arg_max(x, (hgt, -pid)) AS x, arg_max(y, (hgt, -pid)) AS y FROM l JOIN h USING (pid) GROUP BY region), f AS (SELECT p.region AS a, q.region AS b FROM t p JOIN t q ON p.region <> q.region AND sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2) <= 3 AND abs(p.top - q.top) <= 20),
v(region, root) AS (SELECT region, region FROM t UNION SELECT f.b, v.root FROM v JOIN f ON f.a = v.region WHERE v.root < f.b), u AS (SELECT region, min(root) AS crown FROM v GROUP BY region) SELECT region, pixels, top, crown FROM t JOIN u USING (region)""")
def _(t):
    h = t("px").join(t("height_px").withColumn("hgt", F.col("hgt").cast("double")), "pid").select("pid", "r", "c", "x", "y", "hgt", (F.col("nir") / (F.col("nir") + F.col("red") + 1)).alias("green"))
    return urban.tree_crowns(h, "green", "hgt", 0.5, 100, 10.0, 3.0, 20.0).select("region", "pixels", "top", "crown")


# --- learning --------------------------------------------------------------------------------------------------------

_Z = NormalDist().inv_cdf(1 - 0.05 / 5 / 2)


@query("ml_sample_size", f"WITH c AS (SELECT cls, count(*) / sum(count(*)) OVER () AS share FROM px GROUP BY cls) SELECT cls, round(share, 6) AS share, CAST(ceil({_Z!r} * {_Z!r} * share * (1 - share) / 0.0025) AS BIGINT) AS n FROM c")
def _(t):
    return le.sample_sizes(t("px"), "cls", 0.05, 0.05).select("cls", *r6("share"), "n")


@query("ml_subsample_class", None)
def _(t):
    return le.split_class(t("px").select("pid", "cls", "red", "nir"), "cls", 300, 3, ["red", "nir"], 10).select("pid", "cls")


@query("ml_svm", None)
def _(t):
    px = t("px").select("pid", "red", "green", "nir", (F.col("nir") > 128).cast("int").alias("y"))
    return le.train_and_classify(le.sample_per_class(px, "y", 10), px, ["red", "green", "nir"], "y", "svm").select("pid", "y", "predicted")


@query("ml_suspicious_classes", """WITH a AS (SELECT n_nationkey AS cls, n_nationkey * 3 % 17 AS area, CASE WHEN n_nationkey % 4 <> 0 THEN n_nationkey * 7 % 11 / 10.0 END AS p, (n_nationkey + 1) % 25 AS target FROM nation)
SELECT cls, CASE WHEN p IS NULL OR area < 4 THEN 'delete' WHEN p < 0.5 THEN 'relabel' ELSE 'keep' END AS action, CASE WHEN p IS NOT NULL AND area >= 4 AND p < 0.5 THEN target END AS target FROM a""")
def _(t):
    k = F.col("n_nationkey")
    n = t("nation")
    areas = n.select(k.alias("cls"), (k * 3 % 17).alias("area"))
    indicators = n.where(k % 4 != 0).select(k.alias("cls"), (k * 7 % 11 / 10).alias("performance"))
    nearest = n.select(k.alias("a"), ((k + 1) % 25).alias("b"), F.lit(1.0).alias("distance"))
    return le.suspicious_classes(indicators, nearest, areas, 0.5, 4)


@query("ml_tile_inference", "SELECT CAST(c // 25 AS BIGINT) AS tx, CAST(r // 25 AS BIGINT) AS ty, avg(red) > 127 AS bright FROM px GROUP BY ALL")
def _(t):
    tiles = ly.pixels_to_tiles(t("px"), "red", 25)

    def predict(frames):
        for f in frames:
            mean = [float(np.nanmean(np.array(d, float))) for d in f["data"]]
            yield pd.DataFrame({"tx": f["tx"], "ty": f["ty"], "bright": [m > 127 for m in mean]})

    return le.tile_inference(tiles, predict, "tx long, ty long, bright boolean")


@query("ml_classify_objects", None)
def _(t):
    b = t("bld").select("fid", (F.col("xmax") - F.col("xmin")).alias("w"), (F.col("ymax") - F.col("ymin")).alias("d"), "hauteur", (F.col("hauteur") > 25).cast("int").alias("label"))
    return le.classify_objects(b, ["w", "d", "hauteur"], "label", F.col("fid") % 5 == 0, trees=10).select("fid", "label", "predicted")


@query("ml_threshold_of_counts", """WITH h AS (SELECT event_type, CAST(least(24, floor(value / 40)) AS BIGINT) AS k, count(*) AS n FROM events WHERE value >= 0 GROUP BY 1, 2), f AS (SELECT t.event_type, r.k, coalesce(h.n, 0) AS n FROM (SELECT DISTINCT event_type FROM events) t CROSS JOIN range(0, 25) r(k) LEFT JOIN h ON h.event_type = t.event_type AND h.k = r.k),
m AS (SELECT *, lag(n) OVER w AS b, lead(n) OVER w AS a FROM f WINDOW w AS (PARTITION BY event_type ORDER BY k)), l AS (SELECT event_type, k, row_number() OVER (PARTITION BY event_type ORDER BY k) AS i FROM m WHERE n < b AND n < a)
SELECT event_type, max(k) FILTER (i = 1) * 40.0 AS lower, coalesce(max(k) FILTER (i = 2), max(k) FILTER (i = 1)) * 40.0 + 20 AS centre FROM l GROUP BY event_type""")
def _(t):
    """The choice of the minimum, on 25 classes of equal width."""
    e = t("events").where("value >= 0").select("event_type", F.least(F.lit(24), F.floor(F.col("value") / 40)).cast("long").alias("k"))
    every = t("events").select("event_type").distinct().select("event_type", F.explode(F.sequence(F.lit(0), F.lit(24)).cast("array<long>")).alias("k"))
    n = every.join(e.groupBy("event_type", "k").agg(F.count("*").alias("n")), ["event_type", "k"], "left")
    lists = n.groupBy("event_type").agg(F.array_sort(F.collect_list(F.struct("k", F.coalesce("n", F.lit(0)).alias("n")))).alias("l"))  # 25 classes
    centre, lower = le.threshold_of_counts(F.transform("l", lambda x: x["n"]), F.transform("l", lambda x: x["k"] * 40.0))
    return lists.select("event_type", lower.alias("lower"), centre.alias("centre")).where("lower IS NOT NULL")


@query("ml_natural_breaks_threshold", None)
def _(t):
    return le.natural_breaks_threshold(t("events").select("event_type", "value"), "event_type", "value", range(20, 23))


_TREE = [{"hre": [-1, 15, [{"bur": [-1, 30, "6"]}, {"bur": [30, 101, "3"]}]]}, {"hre": [15, 61, [{"bur": [-1, 40, "5"]}, {"bur": [40, 101, "2"]}]]}]


@query("dm_lcz_random_forest", None)
def _(t):
    from arpent.catalogue import _climate

    return urban.forest_zones(_climate(t), _TREE, ["hre", "bur"], 2000, 20).select("id", "lcz", "lcz_rf")
