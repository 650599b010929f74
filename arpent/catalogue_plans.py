"""Registered queries of overlays and composed indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from arpent.catalogue import _AREA, _IN, _MEET, CELL, r6, query
from arpent.catalogue_more import _sieved
from arpent.functions import geometry as ge
from arpent.operators import focal as fo
from arpent.operators import joins as jn
from arpent.operators import overlay as ov
from arpent.operators import zonal as zo
from arpent.plans import climate
from arpent.plans import landcover as lc

#: Unit squares of each box, whose corners are whole numbers.
_UNIT = "SELECT fid, i, unnest(range(CAST(ymin AS BIGINT), CAST(ymax AS BIGINT))) AS j FROM (SELECT *, unnest(range(CAST(xmin AS BIGINT), CAST(xmax AS BIGINT))) AS i FROM zone_ov)"


@query("jn_difference_overlay", f"WITH u AS ({_UNIT}) SELECT fid, CAST(count(*) AS DOUBLE) AS area FROM u WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.fid % 3 = 0 AND b.i = u.i AND b.j = u.j) AND fid % 3 <> 0 GROUP BY fid")
def _(t):
    z = t("zone_ov")
    out = ov.difference_overlay(z.where("fid % 3 <> 0"), z.where("fid % 3 = 0"), CELL)
    return out.groupBy("fid").agg(F.sum((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area"))


@query("wn_priority_remove_overlaps", f"WITH u AS ({_UNIT}) SELECT fid, CAST(count(*) AS DOUBLE) AS area FROM u WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.fid > u.fid AND b.i = u.i AND b.j = u.j) GROUP BY fid HAVING count(*) > 4")
def _(t):
    out = ov.priority_remove_overlaps(t("zone_ov"), CELL, 4)
    return out.groupBy("fid").agg(F.sum((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area"))


@query("geo_subdivide", "SELECT fid, count(*) AS pieces, sum((least(xmax, i * 10 + 10) - greatest(xmin, i * 10)) * (least(ymax, j * 10 + 10) - greatest(ymin, j * 10))) AS area FROM (SELECT *, unnest(range(CAST(floor(ymin / 10) AS BIGINT), CAST(ceil(ymax / 10) AS BIGINT))) AS j FROM (SELECT *, unnest(range(CAST(floor(xmin / 10) AS BIGINT), CAST(ceil(xmax / 10) AS BIGINT))) AS i FROM zone_ov)) GROUP BY fid")
def _(t):
    p = ov.subdivide(t("zone_ov"), 10.0)
    return p.groupBy("fid").agg(F.count("*").alias("pieces"), F.sum((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area"))


@query("jn_split_polygons_by_lines", "SELECT fid, 1 + (SELECT count(*) FROM (SELECT DISTINCT (n_nationkey * 9) % 125 AS x FROM nation) l WHERE x > xmin AND x < xmax) AS pieces FROM zone_ov")
def _(t):
    """Lines from below the grid to above it, whatever its height."""
    h = F.broadcast(t("grid_meta").select("h"))  # one row
    lines = t("nation").crossJoin(h).select(((F.col("n_nationkey") * 9) % 125).cast("double").alias("x"), F.lit(-20.0).alias("y1"), (F.col("h") + 20.0).alias("y2")).distinct()
    return ov.split_by_vertical_lines(t("zone_ov"), lines, CELL).groupBy("fid").agg(F.count("*").alias("pieces"))


@query("wn_order_by_limit", "SELECT fid, hauteur FROM bld ORDER BY hauteur DESC, fid LIMIT 50")
def _(t):
    return t("bld").select("fid", "hauteur").orderBy(F.desc("hauteur"), "fid").limit(50)


@query("geo_bbox_polygon", "SELECT fid, 4 AS lines, round(2 * (xmax - xmin + ymax - ymin), 6) AS outline FROM bld")
def _(t):
    p = t("bld").select("fid", ge.box_polygon(*[F.col(c) for c in jn.BOX]).alias("p"))
    return p.select("fid", F.size(ge.segments(F.element_at("p", 1))).alias("lines"), F.round(ge.perimeter(F.col("p")), 6).alias("outline"))


@query("ag_frontal_area", f"""WITH l AS (SELECT z.fid * 10 + k AS fid, z.xmin + 2 + 4 * k AS x, z.ymin, z.ymax FROM zone z, range(0, 5) r(k)), h AS (SELECT l.fid, max(b.hauteur) AS h FROM l JOIN bld b ON b.xmin <= x AND b.xmax >= x AND b.ymin <= l.ymax AND b.ymax >= l.ymin GROUP BY l.fid)
SELECT fid // 10 AS fid, round(sum(h * 4.0) / (SELECT first((xmax - xmin) * (ymax - ymin)) FROM zone), 6) AS far FROM h GROUP BY 1""")
def _(t):
    z = t("zone")
    x = F.col("xmin") + 2 + 4 * F.col("k")
    lines = z.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4)))).select((F.col("fid") * 10 + F.col("k")).alias("fid"), x.alias("xmin"), "ymin", x.alias("xmax"), "ymax")
    return lc.frontal_area(lines, t("bld"), z, CELL, 4.0).select("fid", *r6("far"))


@query("ag_segmentation_score", "SELECT fid, round(0.5 * ((xmax - xmin - 10) / 10) ** 2 + 2 * ((ymax - ymin - 5) / 5) ** 2, 6) AS score FROM zone_ov")
def _(t):
    df = t("zone_ov").select("fid", (F.col("xmax") - F.col("xmin")).alias("w"), (F.col("ymax") - F.col("ymin")).alias("h"))
    return lc.segmentation_score(df, {"w": (10.0, 0.5), "h": (5.0, 2.0)}).select("fid", *r6("score"))


@query("dm_land_cover_indicators", f"""WITH p AS (SELECT pid, x, y, cls, CAST(hgt AS DOUBLE) / 40 AS h FROM px JOIN height_px USING (pid)), s AS (SELECT fid, 100.0 * count(*) FILTER (cls = 100) / count(*) AS built, 100.0 * count(*) FILTER (cls = 200) / count(*) AS water, 100.0 * count(*) FILTER (cls = 300) / count(*) AS high,
 100.0 * count(*) FILTER (cls = 400) / count(*) AS low, avg(h) FILTER (cls IN (300, 400)) AS m, max(h) FILTER (cls IN (300, 400)) AS g FROM zone JOIN p ON {_IN} GROUP BY fid)
SELECT zone.fid, round(coalesce(built, 0), 6) AS built, round(coalesce(high + low, 0), 6) AS veg, round(100 * coalesce(high, 0) / (coalesce(high + low, 0) + 1e-7), 4) AS high_share, round(coalesce(m, 0), 6) AS veg_mean, round(coalesce(g, 0), 6) AS veg_max, CASE WHEN coalesce(m, 0) < 1 THEN 1 WHEN m < 5 THEN 2 ELSE 3 END AS veg_class FROM zone LEFT JOIN s USING (fid)""")
def _(t):
    px = t("px").join(t("height_px").select("pid", (F.col("hgt").cast("double") / 40).alias("h")), "pid")
    out = lc.land_cover_indicators(t("zone").select("fid", *jn.BOX), px, "cls", "h", {100: "built", 200: "water", 300: "high", 400: "low"})
    return out.select("fid", *r6("built", "veg"), F.round("high_share", 4).alias("high_share"), *r6("veg_mean", "veg_max"), "veg_class")


@query("dm_verify_product", """WITH p AS (SELECT pid, CAST(round(red / 256 * 60, 0) AS SMALLINT) AS a, CAST(round(green / 256 * 50, 0) AS SMALLINT) AS b FROM px)
SELECT pid, CASE WHEN a + b = 101 AND a >= b THEN a - 1 ELSE a END AS a, CASE WHEN a + b = 101 AND b > a THEN b - 1 ELSE b END AS b, CASE WHEN a + b = 101 THEN 0 ELSE 100 - a - b END AS rest, 100 AS total FROM p""")
def _(t):
    p = t("px").select("pid", (F.col("red") / 256 * 60).alias("a"), (F.col("green") / 256 * 50).alias("b"))
    return lc.verify_product(p, ["a", "b"], "rest").select("pid", "a", "b", "rest", "total")


@query("dm_post_process_raster", "SELECT pid, CASE WHEN nir > 200 AND (CASE WHEN red > 128 THEN 500 ELSE cls END) = 500 THEN 600 WHEN red > 128 THEN 500 ELSE cls END AS cls FROM px")
def _(t):
    return lc.post_process(t("px").select("pid", "red", "nir", "cls"), "cls", [(F.col("red") > 128, 500, None), (F.col("nir") > 200, 600, 500)]).select("pid", "cls")


@query("dm_height_with_buildings", f"""WITH m AS (SELECT b.fid, b.hauteur, b.xmin, b.ymin, b.xmax, b.ymax, avg(nir) AS m FROM bld b JOIN px ON {_IN} GROUP BY ALL), k AS (SELECT * FROM m WHERE abs(hauteur - m) > 100)
SELECT pid, coalesce((SELECT arg_max(hauteur, fid) FROM k WHERE {_IN}), nir) AS height_ FROM px""")
def _(t):
    return lc.heights_with_buildings(t("px"), "nir", t("bld").select("fid", "hauteur", *jn.BOX), CELL, 100.0).select("pid", "height_")


@query("dm_overlay_external_classes", f"SELECT pid, CASE WHEN EXISTS (SELECT 1 FROM zone_ov WHERE zoning < 5 AND {_IN}) THEN 11000 WHEN EXISTS (SELECT 1 FROM bld WHERE {_IN}) THEN 12000 ELSE 0 END AS cover FROM px")
def _(t):
    return lc.overlay_classes(t("px").select("pid", "x", "y"), [(t("zone_ov").where("zoning < 5"), 11000), (t("bld"), 12000)], CELL).select("pid", "cover")


@query("dm_regional_crossing", f"""WITH v AS (SELECT fid, cls, ref, CAST(red AS INTEGER) % 3 AS d FROM zone JOIN px ON {_IN}), s AS (SELECT fid, 100.0 * count(*) FILTER (cls = 100) / count(*) AS built FROM v GROUP BY fid),
a AS (SELECT fid, arg_min(d, (-k, d)) AS u FROM (SELECT fid, d, count(*) AS k FROM v GROUP BY fid, d) GROUP BY fid), b AS (SELECT fid, arg_min(ref, (-k, ref)) AS r FROM (SELECT fid, ref, count(*) AS k FROM v GROUP BY fid, ref) GROUP BY fid)
SELECT zone.fid, round(coalesce(built, 0), 6) AS built, u AS "update", CASE r WHEN 100 THEN 'image' WHEN 200 THEN 'map' END AS source FROM zone LEFT JOIN s USING (fid) LEFT JOIN a USING (fid) LEFT JOIN b USING (fid)""")
def _(t):
    px = t("px").withColumn("d", F.col("red").cast("int") % 3)
    return lc.regional_crossing(t("zone"), px, {100: "built"}, "d", "ref", {100: "image", 200: "map"}).select("fid", *r6("built"), "update", "source")


@query("dm_prepare_climate_inputs", """WITH z AS (SELECT fid, greatest(xmin, 20.0) AS xmin, greatest(ymin, 2.0) AS ymin, least(xmax, 90.0) AS xmax, least(ymax, 9.0) AS ymax FROM zone_ov WHERE zoning IN (1, 3, 5, 7, 9, 11))
SELECT 'zone' AS layer, fid, round((xmax - xmin) * (ymax - ymin), 6) AS area FROM z WHERE xmax > xmin AND ymax > ymin AND (xmax - xmin) * (ymax - ymin) >= 12 UNION ALL SELECT 'bld', fid, round((xmax - xmin) * (ymax - ymin), 6) FROM bld WHERE xmin <= 95 AND xmax >= 15 AND ymin <= 14 AND ymax >= -3""")
def _(t):
    z, b = lc.climate_inputs(t("zone_ov"), t("bld").select("fid", *jn.BOX), [1, 3, 5, 7, 9, 11], 12, (20, 2, 90, 9), 5, CELL)
    area = F.round((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")), 6).alias("area")
    return z.select(F.lit("zone").alias("layer"), "fid", area).union(b.select(F.lit("bld"), "fid", area))


@query("dm_buildable_plots", """WITH p AS (SELECT fid, (xmax - xmin) * (ymax - ymin) AS area, fid % 3 AS built, CASE fid % 4 WHEN 0 THEN 'U' WHEN 1 THEN 'AU' ELSE 'N' END AS zone, fid % 101 AS red, fid * 7 % 101 AS blue FROM bld)
SELECT fid, CASE WHEN red > 50 THEN 'no' WHEN zone = 'N' THEN 'no' WHEN area < CASE WHEN built > 0 THEN 6 ELSE 3 END THEN 'no' WHEN blue > 50 THEN 'with conditions' ELSE 'yes' END AS buildable FROM p""")
def _(t):
    k = F.col("fid")
    p = t("bld").select(k, ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area"), (k % 3).alias("built"), F.when(k % 4 == 0, "U").when(k % 4 == 1, "AU").otherwise("N").alias("zone"), (k % 101).alias("red"), (k * 7 % 101).alias("blue"))
    return lc.buildable_plots(p, 3, 6).select("fid", "buildable")


@query("dm_ucz_indicators", f"""WITH s AS (SELECT a.fid, sum({_AREA}) AS built, sum(b.hauteur * 2 * (b.xmax - b.xmin + b.ymax - b.ymin)) AS facade, first((a.xmax - a.xmin) * (a.ymax - a.ymin)) AS whole FROM zone_ov a JOIN bld b ON {_MEET} GROUP BY a.fid)
SELECT fid, round(0.5 * facade / (greatest(whole - built, 0) + 0.0001), 3) AS ra FROM s WHERE whole - built > 1""")
def _(t):
    p = jn.intersection_overlay(t("zone_ov"), t("bld"), CELL)
    per = 2 * (F.col("b_xmax") - F.col("b_xmin") + F.col("b_ymax") - F.col("b_ymin"))
    whole = (F.col("a_xmax") - F.col("a_xmin")) * (F.col("a_ymax") - F.col("a_ymin"))
    s = p.groupBy(F.col("a_fid").alias("fid")).agg(F.sum("area").alias("built"), F.sum(F.col("b_hauteur") * per).alias("facade"), F.first(whole).alias("whole"))
    s = s.where("whole - built > 1")
    return s.select("fid", F.round(climate.facade_ratio(F.col("facade"), F.greatest(F.col("whole") - F.col("built"), F.lit(0.0))), 3).alias("ra"))


@query("dm_sky_view_indicator", f"""WITH h AS (SELECT pid, r, c, hgt FROM px JOIN height_px USING (pid)), k AS (SELECT * FROM (VALUES (0, 0, 1), (1, 1, 0), (2, 0, -1), (3, -1, 0)) v(k, dr, dc)), s AS (SELECT * FROM k, range(1, 3) t(s)),
a AS (SELECT h.pid, s.k, max(atan(greatest(0.0, coalesce(q.hgt - h.hgt, 0)) / s.s)) AS a FROM h CROSS JOIN s LEFT JOIN h q ON q.r = h.r + s.dr * s.s AND q.c = h.c + s.dc * s.s GROUP BY h.pid, s.k), v AS (SELECT pid, avg(cos(a) * cos(a)) AS svf FROM a GROUP BY pid),
m AS (SELECT fid, avg(svf) AS mean FROM zone JOIN px ON {_IN} JOIN v USING (pid) GROUP BY fid) SELECT zone.fid, round(mean, 6) AS mean FROM zone LEFT JOIN m USING (fid)""")
def _(t):
    h = t("px").select("pid", "r", "c", "x", "y").join(t("height_px").withColumn("hgt", F.col("hgt").cast("double")), "pid")
    return zo.zonal_stats(t("zone"), fo.sky_view_factor(h, "hgt", 2, 4), "svf", ("mean",)).select("fid", *r6("mean"))


@query("dm_flood_depth_classes", f"WITH d AS (SELECT pid, 60 + x / 10 - hgt AS d FROM px JOIN height_px USING (pid)) SELECT pid, CASE WHEN d >= 40 THEN 3 WHEN d >= 20 THEN 2 WHEN d >= 0 THEN 1 ELSE 0 END AS depth FROM d")
def _(t):
    from arpent.operators.algebra import height_classes

    px = t("px").join(t("height_px").withColumn("hgt", F.col("hgt").cast("double")), "pid")
    return px.select("pid", height_classes(60 + F.col("x") / 10 - F.col("hgt"), [0, 20, 40]).alias("depth"))


@query("dm_parametric_study", " UNION ALL ".join(f"SELECT {k} AS threshold, count(*) AS n, round(avg(nir), 6) AS mean FROM px WHERE red > {k} HAVING count(*) > 0" for k in (50, 100, 150)))
def _(t):
    px = t("px")
    grid = px.sparkSession.createDataFrame([(50,), (100,), (150,)], "threshold int")
    return px.join(F.broadcast(grid), F.col("red") > F.col("threshold")).groupBy("threshold").agg(F.count("*").alias("n"), F.round(F.avg("nir"), 6).alias("mean"))


@query("dm_coastline_threshold", f"""WITH b AS (SELECT pid, r, c, x, y, (nir < 128)::INT AS sea FROM px), e AS (SELECT p.pid AS a, q.pid AS b FROM b p JOIN b q ON p.sea = 1 AND q.sea = 1 AND abs(p.r - q.r) + abs(p.c - q.c) = 1),
w(pid, root) AS (SELECT pid, pid FROM b WHERE sea = 1 UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.pid WHERE w.root < e.b), l AS (SELECT pid, min(root) AS region FROM w GROUP BY pid),
s AS (SELECT DISTINCT l.region FROM pt, grid_meta JOIN b ON b.c = floor(pt.x) AND b.r = h - 1 - floor(pt.y) JOIN l USING (pid))
SELECT region AS fid, count(*) AS pixels, min(x) - 0.5 AS xmin, min(y) - 0.5 AS ymin, max(x) + 0.5 AS xmax, max(y) + 0.5 AS ymax FROM l JOIN s USING (region) JOIN b USING (pid) GROUP BY region""")
def _(t):
    """Sea regions by a threshold that hold a sea point in one of their pixels, with their boxes."""
    from arpent.operators.coast import sea_regions

    h = t("grid_meta").select("h")
    seeds = t("pt").crossJoin(F.broadcast(h)).select((F.col("h") - 1 - F.floor("y")).alias("r"), F.floor("x").alias("c"))  # grid_meta has one row
    sea = sea_regions(t("px").select("pid", "r", "c", "x", "y", (F.col("nir") < 128).cast("int").alias("sea")), "sea", seeds)
    return sea.groupBy(F.col("region").alias("fid")).agg(F.count("*").alias("pixels"), (F.min("x") - 0.5).alias("xmin"), (F.min("y") - 0.5).alias("ymin"), (F.max("x") + 0.5).alias("xmax"), (F.max("y") + 0.5).alias("ymax"))


@query("dm_vectorise_land_cover", f"""WITH rc AS (SELECT pid, r, c, CASE cls WHEN 200 THEN 100 WHEN 500 THEN 400 ELSE cls END AS cls FROM px), {_sieved("rc")[15:]},
e4 AS (SELECT p.pid AS a, q.pid AS b FROM sv p JOIN sv q ON p.cls = q.cls AND abs(p.r - q.r) + abs(p.c - q.c) = 1),
w4(pid, root) AS (SELECT pid, pid FROM sv UNION SELECT e4.b, w4.root FROM w4 JOIN e4 ON e4.a = w4.pid WHERE w4.root < e4.b), l4 AS (SELECT pid, min(root) AS region FROM w4 GROUP BY pid),
s4 AS (SELECT p.cls, count(*) AS inner_ FROM e4 JOIN sv p ON p.pid = e4.a GROUP BY p.cls)
SELECT cls AS value, count(DISTINCT region) AS regions, count(*) AS pixels, 4 * count(*) - coalesce(min(inner_), 0) AS perimeter FROM sv JOIN l4 USING (pid) LEFT JOIN s4 USING (cls) GROUP BY cls""")
def _(t):
    """Reclass, sieve by a minimum unit, regions, and their dissolve by class."""
    from arpent.operators.algebra import reclass
    from arpent.operators.regions import polygonize, sieve

    px = t("px").select("pid", "r", "c", "x", "y", reclass(F.col("cls"), {200: 100, 500: 400}).alias("cls"))
    return polygonize(sieve(px, "cls", 3), "cls").groupBy("value").agg(F.count("*").alias("regions"), F.sum("pixels").alias("pixels"), F.sum("perimeter").alias("perimeter"))
