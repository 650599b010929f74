"""Registered queries of geometry, sources, focal, region and learning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from arpent.catalogue import CELL, INDEX_SQL, r6, query
from arpent.functions import geometry as ge
from arpent.operators import focal as fo
from arpent.operators import learning as le
from arpent.operators import regions as rg
from arpent.operators import textures as tx
from arpent.operators.joins import BOX
from arpent.sources import layers as ly
from arpent.sources import tables as st

def _box():
    return [F.col(c) for c in BOX]


# --- geometry --------------------------------------------------------------------------------------------------------


@query("geo_measures", """SELECT fid, round((xmax - xmin) * (ymax - ymin), 6) AS area, round(2 * (xmax - xmin + ymax - ymin), 6) AS perimeter, round((xmin + xmax) / 2, 4) AS cx, round((ymin + ymax) / 2, 4) AS cy,
  round(4 * pi() * (xmax - xmin) * (ymax - ymin) / (4 * (xmax - xmin + ymax - ymin) * (xmax - xmin + ymax - ymin)), 6) AS compactness FROM bld""")
def _(t):
    p = t("bld").select("fid", ge.box_polygon(*_box()).alias("p"))
    c = ge.centroid(F.element_at("p", 1))
    return p.select("fid", F.round(ge.area(F.col("p")), 6).alias("area"), F.round(ge.perimeter(F.col("p")), 6).alias("perimeter"), F.round(c["x"], 4).alias("cx"), F.round(c["y"], 4).alias("cy"), F.round(ge.compactness(F.col("p")), 6).alias("compactness"))


@query("geo_holes", "SELECT fid, round((xmax - xmin) * (ymax - ymin) - 0.25, 6) AS with_hole, round((xmax - xmin) * (ymax - ymin), 6) AS without, 2 AS rings, 1 AS kept FROM bld")
def _(t):
    inner = ge.box_polygon(F.col("xmin") + 0.1, F.col("ymin") + 0.1, F.col("xmin") + 0.6, F.col("ymin") + 0.6)
    p = t("bld").select("fid", F.concat(ge.box_polygon(*_box()), inner).alias("p"))
    whole = ge.remove_small_rings(F.col("p"), 1.0)
    return p.select("fid", F.round(ge.area(F.col("p")), 6).alias("with_hole"), F.round(ge.area(whole), 6).alias("without"), F.size("p").alias("rings"), F.size(ge.clean_rings(F.col("p"))).alias("kept"))


@query("geo_contains", "SELECT zone.fid AS zone, count(*) AS n FROM zone JOIN pt ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax GROUP BY zone.fid")
def _(t):
    z = F.broadcast(t("zone").select(F.col("fid").alias("zone"), ge.box_polygon(*_box()).alias("p"), *BOX))
    near = (F.col("x") >= F.col("xmin")) & (F.col("x") <= F.col("xmax")) & (F.col("y") >= F.col("ymin")) & (F.col("y") <= F.col("ymax"))
    return t("pt").join(z, near).where(ge.contains(F.col("p"), F.col("x"), F.col("y"))).groupBy("zone").agg(F.count("*").alias("n"))


@query("geo_segments", """SELECT seg, round(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 6) AS len, round(x1 - (x2 - x1) / sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) * 2, 6) AS ex1, round(y2 + (y2 - y1) / sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) * 2, 6) AS ey2,
  round(x1 - (y2 - y1) / sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) * 3, 6) AS ox1, round(y1 + (x2 - x1) / sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) * 3, 6) AS oy1 FROM coast""")
def _(t):
    e = ge.extend_segment(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], 2)
    o = ge.offset_segment(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], 3)
    line = F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))
    return t("coast").select("seg", F.round(ge.length(line), 6).alias("len"), F.round(e[0], 6).alias("ex1"), F.round(e[3], 6).alias("ey2"), F.round(o[0], 6).alias("ox1"), F.round(o[1], 6).alias("oy1"))


_NS = "CAST(greatest(1, ceil(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) / 2.5)) AS INTEGER)"


@query("geo_points_along", f"WITH s AS (SELECT *, {_NS} AS n FROM coast) SELECT seg, CAST(k AS INTEGER) AS k, round(x1 + k / n * (x2 - x1), 6) AS x, round(y1 + k / n * (y2 - y1), 6) AS y FROM s, range(0, 100) r(k) WHERE k <= n")
def _(t):
    return ge.points_along(t("coast"), 2.5).select("seg", "k", *r6("x", "y"))


@query("geo_split_lines", f"WITH s AS (SELECT *, {_NS} AS n FROM coast) SELECT seg, CAST(k AS INTEGER) AS k, round(x1 + k / n * (x2 - x1), 6) AS x1, round(y1 + (k + 1) / n * (y2 - y1), 6) AS y2 FROM s, range(0, 100) r(k) WHERE k < n")
def _(t):
    return ge.split_segments(t("coast"), 2.5).select("seg", "k", *r6("x1", "y2"))


@query("geo_smooth", "SELECT seg, 2 AS n, round(x1 * 0.75 + x2 * 0.25, 6) AS x, round(y1 * 0.25 + y2 * 0.75, 6) AS y FROM coast")
def _(t):
    line = F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))
    s = ge.chaikin(line)
    return t("coast").select("seg", F.size(s).alias("n"), F.round(F.element_at(s, 1)["x"], 6).alias("x"), F.round(F.element_at(s, -1)["y"], 6).alias("y"))


@query("geo_grid", """WITH g AS (SELECT fid, xmin, ymin, xmax, ymax, CAST(ceil((xmax - xmin) / 4) AS INTEGER) AS nx, CAST(ceil((ymax - ymin) / 3) AS INTEGER) AS ny FROM zone_ov)
SELECT fid, CAST(l * nx + c AS INTEGER) AS id, 'l' || l || 'c' || c AS name, xmin + c * 4 AS x0, greatest(ymin, ymax - l * 3 - 3) AS y0, least(xmax, xmin + c * 4 + 4) AS x1 FROM g, range(0, 20) a(l), range(0, 20) b(c) WHERE l < ny AND c < nx""")
def _(t):
    return ge.grid(t("zone_ov").select("fid", *BOX), 4, 3).select("fid", "id", "name", F.col("xmin").alias("x0"), F.col("ymin").alias("y0"), F.col("xmax").alias("x1"))


@query("geo_normalise_direction", "SELECT DISTINCT least(x1, x2) AS x1, greatest(x1, x2) AS x2 FROM coast")
def _(t):
    both = t("coast").select("x1", "y1", "x2", "y2").union(t("coast").select("x2", "y2", "x1", "y1"))
    line = F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))
    d = ge.direction(line)
    return both.select(d[0].alias("x1"), d[1].alias("y1"), d[2].alias("x2"), d[3].alias("y2")).distinct().select("x1", "x2").distinct()


@query("geo_explode_collect", "SELECT nature, count(*) AS parts, 5 * count(*) AS points FROM bld GROUP BY nature")
def _(t):
    lot = F.floor(F.col("fid") / 500).alias("lot")  # a kind is collected in lots of bounded size
    multi = t("bld").groupBy("nature", lot).agg(F.collect_list(ge.box_polygon(*_box())).alias("m"))
    return multi.select("nature", F.posexplode("m")).groupBy("nature").agg(F.count("*").alias("parts"), F.sum(F.size(F.element_at("col", 1))).alias("points"))


# --- sources ---------------------------------------------------------------------------------------------------------


@query("src_raster_metadata", "SELECT max(r) - min(r) + 1 AS rows, max(c) - min(c) + 1 AS columns, (max(x) - min(x)) / (max(c) - min(c)) AS pixel_size, min(x) - (max(x) - min(x)) / (max(c) - min(c)) / 2 AS xmin, max(x) + (max(x) - min(x)) / (max(c) - min(c)) / 2 AS xmax, min(y) - (max(x) - min(x)) / (max(c) - min(c)) / 2 AS ymin, max(y) + (max(x) - min(x)) / (max(c) - min(c)) / 2 AS ymax, 6 AS bands, 'double' AS dtype, CAST(0 AS DOUBLE) AS nodata FROM (SELECT r, 2 * x AS x, 2 * y AS y, c FROM px)")
def _(t):
    px = t("px").withColumn("x", 2 * F.col("x")).withColumn("y", 2 * F.col("y"))
    return ly.raster_metadata(px, ["red", "green", "blue", "nir", "swir1", "swir2"], nodata=0)


@query("src_vector_metadata", "SELECT count(*) AS features, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax, 'Polygon' AS geometry, 'fid:bigint,nature:string,hauteur:double' AS fields FROM bld")
def _(t):
    return ly.vector_metadata(t("bld"))


@query("src_tiles_round_trip", "SELECT r, c, CAST(red AS FLOAT) AS value FROM px WHERE r < (SELECT h // 4 * 4 FROM grid_meta) AND c < 124")
def _(t):
    tiles = ly.pixels_to_tiles(t("px").where("c < 124"), "red", 4).where("NOT exists(data, v -> v IS NULL)").withColumn("scene", F.lit("a"))
    return ly.tiles_to_pixels(tiles, 4).select("r", "c", "value")


@query("src_tiles_round_trip_all", "SELECT r, c, CAST(red AS FLOAT) AS value FROM px")
def _(t):
    tiles = ly.pixels_to_tiles(t("px"), "red", 4).withColumn("scene", F.lit("a"))
    return ly.tiles_to_pixels(tiles, 4, absent=False).select("r", "c", "value")


@query("src_scene_footprints", "SELECT sid, CAST(strptime(substr(name, 5, 8), '%Y%m%d') AS DATE) AS date, strftime(make_timestamp(CAST(substr(name, 14, 9) AS BIGINT) * 1000), '%H:%M:%S') AS time, string_split(name, '_')[3] AS folder FROM scene")
def _(t):
    d, h, f = ly.scene_dates(F.col("name"))
    return t("scene").select("sid", d.alias("date"), h.alias("time"), f.alias("folder"))


@query("src_select_scenes", "SELECT CAST(strptime(substr(name, 5, 8), '%Y%m%d') AS DATE) AS date, count(*) AS n, min(sid % 100) AS xmin, max(sid % 100 + 10) AS xmax FROM scene WHERE sid % 100 <= 60 AND sid % 100 + 10 >= 20 GROUP BY 1")
def _(t):
    s = t("scene").select(ly.scene_dates(F.col("name"))[0].alias("date"), (F.col("sid") % 100).alias("xmin"), F.lit(0).alias("ymin"), (F.col("sid") % 100 + 10).alias("xmax"), F.lit(1).alias("ymax"))
    return ly.select_scenes(s, (20, 0, 60, 1)).select("date", "n", "xmin", "xmax")


@query("src_select_tiles", "SELECT fid, lpad(CAST(tx AS VARCHAR), greatest(4, length(CAST(tx AS VARCHAR)))::INT, '0') || '_' || lpad(CAST(ty AS VARCHAR), greatest(4, length(CAST(ty AS VARCHAR)))::INT, '0') AS tile FROM (SELECT *, unnest(range(CAST(floor(ymin / 4) AS BIGINT), CAST(ceil(ymax / 4) AS BIGINT))) AS ty FROM (SELECT *, unnest(range(CAST(floor(xmin / 4) AS BIGINT), CAST(ceil(xmax / 4) AS BIGINT))) AS tx FROM zone_ov))")
def _(t):
    return ly.select_tiles(t("zone_ov"), 4.0, 4.0).select("fid", "tile")


@query("src_detection_annotations", """WITH p AS (SELECT a.fid AS tile, b.fid, b.xmin - a.xmin AS x0, b.xmax - a.xmin AS x1, a.ymax - b.ymax AS y0, a.ymax - b.ymin AS y1 FROM zone a JOIN bld b ON a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax),
q AS (SELECT tile, fid, least(100, greatest(0, CAST(round(x0 * 4) AS INTEGER))) AS x0, least(100, greatest(0, CAST(round(x1 * 4) AS INTEGER))) AS x1, least(100, greatest(0, CAST(round(y0 * 4) AS INTEGER))) AS y0, least(100, greatest(0, CAST(round(y1 * 4) AS INTEGER))) AS y1 FROM p)
SELECT *, (x1 - x0) * (y1 - y0) AS area FROM q""")
def _(t):
    return ly.detection_boxes(t("zone").withColumnRenamed("fid", "tile"), t("bld"), 25.0, 100)


@query("src_reallocation_table", """SELECT CAST(n_nationkey AS INTEGER) AS class, CASE n_nationkey % 4 WHEN 0 THEN 'delete' WHEN 1 THEN 'split' ELSE 'relabel' END AS action, CASE WHEN n_nationkey % 4 = 2 THEN CAST(n_regionkey AS INTEGER) END AS target,
  CASE WHEN n_nationkey % 4 = 1 THEN CASE WHEN n_nationkey % 8 = 1 THEN 5 ELSE 3 END END AS n FROM nation WHERE n_nationkey % 4 <> 3""")
def _(t):
    k = F.col("n_nationkey")
    text = F.concat_ws(";", k, F.when(k % 4 == 0, "-1").when(k % 4 == 1, "-2").when(k % 4 == 2, F.col("n_regionkey").cast("string")).otherwise("A"), F.when(k % 8 == 1, "5"))
    return st.reallocation_table(t("nation").select(text.alias("value")))


@query("src_quality_report", "SELECT 'n' AS indicator, count(*) FILTER (cls = 100) * 1.0::DOUBLE AS \"100\", count(*) FILTER (cls = 200) * 1.0::DOUBLE AS \"200\" FROM px UNION ALL SELECT 'red', sum(red) FILTER (cls = 100), sum(red) FILTER (cls = 200) FROM px")
def _(t):
    m = t("px").where("cls IN (100, 200)").groupBy("cls").agg(F.count("*").cast("double").alias("n"), F.sum("red").alias("red"))
    return st.quality_report(m, ["n", "red"])


# --- focal -----------------------------------------------------------------------------------------------------------

#: Each pixel with its neighbours in a square, by equal row and column.
_NB = "p.pid, n.{v} AS v, o.i AS dr, o.j AS dc FROM px p CROSS JOIN (SELECT i, j FROM range(-{k}, {k} + 1) a(i), range(-{k}, {k} + 1) b(j)) o JOIN px n ON n.r = p.r + o.i AND n.c = p.c + o.j"


@query("foc_majority_filter", f"WITH n AS (SELECT {_NB.format(v='cls', k=1)} WHERE (n.r - p.r) * (n.r - p.r) + (n.c - p.c) * (n.c - p.c) <= 1), m AS (SELECT pid, v, count(*) AS k, max((dr = 0 AND dc = 0)::INT) AS own FROM n GROUP BY pid, v) SELECT pid, arg_min(v, (-k, -own, v)) AS majority FROM m GROUP BY pid")
def _(t):
    return fo.majority_filter(t("px").select("pid", "r", "c", "cls"), "cls", 1).select("pid", "majority")


@query("foc_morphology", f"WITH b AS (SELECT pid, r, c, (red > 60)::INT AS m FROM px), n AS (SELECT {_NB.format(v='m', k=1).replace('px ', 'b ')} WHERE abs(n.r - p.r) + abs(n.c - p.c) <= 1) SELECT pid, min(v) AS eroded, max(v) AS dilated FROM n GROUP BY pid")
def _(t):
    m = t("px").select("pid", "r", "c", (F.col("red") > 60).cast("int").alias("m"))
    return fo.dilate(fo.erode(m, "m", 1, "eroded"), "m", 1, "dilated").select("pid", "eroded", "dilated")


@query("foc_opening", f"""WITH b AS (SELECT pid, r, c, (red > 60)::INT AS m FROM px), e AS (SELECT pid, min(v) AS m FROM (SELECT {_NB.format(v='m', k=1).replace('px ', 'b ')} WHERE abs(n.r - p.r) + abs(n.c - p.c) <= 1) GROUP BY pid),
f AS (SELECT b.pid, b.r, b.c, e.m FROM b JOIN e USING (pid)) SELECT pid, max(v) AS opened FROM (SELECT {_NB.format(v='m', k=1).replace('px ', 'f ')} WHERE abs(n.r - p.r) + abs(n.c - p.c) <= 1) GROUP BY pid""")
def _(t):
    m = t("px").select("pid", "r", "c", (F.col("red") > 60).cast("int").alias("m"))
    return fo.opening(m, "m", 1, "opened").select("pid", "opened")


@query("foc_edge_extraction", f"WITH n AS (SELECT {_NB.format(v='nir', k=1)}) SELECT pid, round(CASE WHEN count(*) = 9 THEN sqrt(sum(v * dc * (2 - abs(dr))) ** 2 + sum(v * dr * (2 - abs(dc))) ** 2) END, 5) AS gradient FROM n GROUP BY pid")
def _(t):
    return fo.sobel(t("px").select("pid", "r", "c", "nir"), "nir").select("pid", F.round("gradient", 5).alias("gradient"))


@query("foc_fill_holes", f"""WITH z AS (SELECT pid, r, c, CASE WHEN red < 60 THEN 0 ELSE cls END AS k FROM px), n AS (SELECT {_NB.format(v='k', k=1).replace('px ', 'z ')} WHERE abs(n.r - p.r) + abs(n.c - p.c) <= 1), m AS (SELECT pid, v, count(*) AS k, max((dr = 0 AND dc = 0)::INT) AS own FROM n GROUP BY pid, v),
s AS (SELECT pid, arg_min(v, (-k, -own, v)) AS j FROM m GROUP BY pid) SELECT pid, CASE WHEN k <> 0 THEN k WHEN j <> 0 THEN j ELSE 900 END AS filled FROM z JOIN s USING (pid)""")
def _(t):
    z = t("px").select("pid", "r", "c", F.when(F.col("red") < 60, 0).otherwise(F.col("cls")).alias("k"))
    return fo.fill_holes_by_majority(z, "k", 1, 900).select("pid", "filled")


@query("foc_local_mean_variance", f"WITH n AS (SELECT {_NB.format(v='red', k=1)}) SELECT pid, round(avg(v), 6) AS mean, round(var_pop(v), 4) AS variance FROM n GROUP BY pid")
def _(t):
    return fo.local_mean_variance(t("px").select("pid", "r", "c", "red"), "red", 1).select("pid", *r6("mean"), F.round("variance", 4).alias("variance"))


@query("foc_pansharpen_ratio", f"WITH n AS (SELECT {_NB.format(v='nir', k=1)}), m AS (SELECT pid, avg(v) AS a FROM n GROUP BY pid) SELECT pid, round(red * nir / nullif(a, 0), 6) AS sharp FROM px JOIN m USING (pid)")
def _(t):
    return fo.ratio_sharpen(t("px").select("pid", "r", "c", "red", "nir"), "nir", "red", 1).select("pid", *r6("sharp"))


@query("foc_texture", f"""WITH g AS (SELECT pid, r, c, CAST(least(7, floor(red / 256 * 8)) AS INTEGER) AS a FROM px), q AS (SELECT g.pid, g.r, g.c, g.a * 8 + h.a AS k FROM g JOIN g h ON h.r = g.r AND h.c = g.c + 1),
n AS (SELECT p.r, p.c, n.k AS v FROM q p JOIN q n ON n.r BETWEEN p.r - 1 AND p.r + 1 AND n.c BETWEEN p.c - 1 AND p.c + 1 UNION ALL SELECT g.r, g.c, n.k FROM g JOIN q n ON n.r BETWEEN g.r - 1 AND g.r + 1 AND n.c BETWEEN g.c - 1 AND g.c + 1 WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.pid = g.pid)),
s AS (SELECT r, c, v, count(*) AS k FROM n GROUP BY r, c, v), w AS (SELECT *, k / sum(k) OVER (PARTITION BY r, c)::DOUBLE AS p, v // 8 AS i, v % 8 AS j FROM s)
SELECT r, c, round(sum(p * p), 6) AS energy, round(-sum(p * ln(p)), 6) AS entropy, round(sum((i - j) * (i - j) * p), 6) AS inertia, round(sum(p / (1 + (i - j) * (i - j))), 6) AS idm FROM w GROUP BY r, c""")
def _(t):
    return tx.cooccurrence(t("px").select("r", "c", "red"), "red", 8, 0, 256, 1).select("r", "c", *r6("energy", "entropy", "inertia", "idm"))


@query("foc_shadow_mask", "SELECT p.pid, coalesce(max((q.hgt - p.hgt > (q.c - p.c) * tan(radians(60)))::INT), 0) AS shadow FROM (SELECT * FROM px JOIN height_px USING (pid)) p LEFT JOIN (SELECT * FROM px JOIN height_px USING (pid)) q ON q.r = p.r AND q.c BETWEEN p.c + 1 AND p.c + 4 GROUP BY p.pid")
def _(t):
    h = t("px").select("pid", "r", "c").join(t("height_px").withColumn("hgt", F.col("hgt").cast("double")), "pid")
    return fo.shadow_mask(h, "hgt", 90, 60, 4).select("pid", "shadow")


@query("foc_shadow_mask_all", "SELECT p.pid, coalesce(max((q.hgt - p.hgt > (q.c - p.c) * tan(radians(60)))::INT), 0) AS shadow FROM (SELECT * FROM px JOIN height_px USING (pid)) p LEFT JOIN (SELECT * FROM px JOIN height_px USING (pid)) q ON q.r = p.r AND q.c > p.c GROUP BY p.pid")
def _(t):
    h = t("px").select("pid", "r", "c").join(t("height_px").withColumn("hgt", F.col("hgt").cast("double")), "pid")
    return fo.shadow_mask(h, "hgt", 90, 60).select("pid", "shadow")


@query("foc_sky_view_factor_all", """WITH h AS (SELECT pid, r, c, hgt FROM px JOIN height_px USING (pid)), k AS (SELECT * FROM (VALUES (0, 0, 1), (1, 1, 0), (2, 0, -1), (3, -1, 0)) v(k, dr, dc)),
p AS (SELECT h.pid, k.k, (q.hgt - h.hgt) / greatest(abs(q.r - h.r), abs(q.c - h.c)) AS s FROM h CROSS JOIN k JOIN h q ON sign(q.r - h.r) = k.dr AND sign(q.c - h.c) = k.dc),
a AS (SELECT h.pid, k.k, atan(greatest(0.0, coalesce(max(p.s), 0))) AS a FROM h CROSS JOIN k LEFT JOIN p ON p.pid = h.pid AND p.k = k.k GROUP BY h.pid, k.k)
SELECT pid, round(avg(cos(a) * cos(a)), 6) AS svf FROM a GROUP BY pid""")
def _(t):
    h = t("px").select("pid", "r", "c").join(t("height_px").withColumn("hgt", F.col("hgt").cast("double")), "pid")
    return fo.sky_view_factor(h, "hgt", directions=4).select("pid", *r6("svf"))


@query("foc_sky_view_factor", """WITH h AS (SELECT pid, r, c, hgt FROM px JOIN height_px USING (pid)), k AS (SELECT * FROM (VALUES (0, 0, 1), (1, 1, 0), (2, 0, -1), (3, -1, 0)) v(k, dr, dc)), s AS (SELECT * FROM k, range(1, 4) t(s)),
a AS (SELECT h.pid, s.k, max(atan(greatest(0.0, coalesce(q.hgt - h.hgt, 0)) / s.s)) AS a FROM h CROSS JOIN s LEFT JOIN h q ON q.r = h.r + s.dr * s.s AND q.c = h.c + s.dc * s.s GROUP BY h.pid, s.k)
SELECT pid, round(avg(cos(a) * cos(a)), 6) AS svf FROM a GROUP BY pid""")
def _(t):
    h = t("px").select("pid", "r", "c").join(t("height_px").withColumn("hgt", F.col("hgt").cast("double")), "pid")
    return fo.sky_view_factor(h, "hgt", 3, 4).select("pid", *r6("svf"))


@query("foc_interpolate", """WITH p AS (SELECT px.pid, pt.fid, CAST(pt.z AS DOUBLE) AS z, sqrt((px.x - pt.x) * (px.x - pt.x) + (px.y - pt.y) * (px.y - pt.y)) AS d FROM px CROSS JOIN pt),
n AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY pid ORDER BY d, fid) <= 4), l AS (SELECT pid, list(1 / greatest(d, 1e-9) * z ORDER BY d, fid) AS v, list(1 / greatest(d, 1e-9) ORDER BY d, fid) AS w FROM n GROUP BY pid)
SELECT pid, round(list_reduce(v, lambda a, b: a + b) / list_reduce(w, lambda a, b: a + b), 4) AS value FROM l""")
def _(t):
    return fo.interpolate_from_points(t("px"), t("pt").withColumn("z", F.col("z").cast("double")), 5.0).select("pid", F.round("value", 4).alias("value"))


# --- regions ---------------------------------------------------------------------------------------------------------

_CC = """WITH RECURSIVE e AS (SELECT p.pid AS a, q.pid AS b FROM px p JOIN px q ON p.cls = q.cls AND abs(p.r - q.r) + abs(p.c - q.c) = 1),
w(pid, root) AS (SELECT pid, pid FROM px UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.pid WHERE w.root < e.b), l AS (SELECT pid, min(root) AS region FROM w GROUP BY pid)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH RECURSIVE", "WITH", 1)


@query("cc_connected_components", _recursive(f"{_CC} SELECT pid, region FROM l"))
def _(t):
    return rg.connected_components(t("px").select("pid", "r", "c", "cls"), "cls").select("pid", "region")


@query("cc_polygonize", _recursive(f"""{_CC}, g AS (SELECT region, cls, r, c, x, y FROM l JOIN px USING (pid)), s AS (SELECT a.region, count(*) AS inner_ FROM g a JOIN g b ON a.region = b.region AND abs(a.r - b.r) + abs(a.c - b.c) = 1 GROUP BY a.region)
SELECT region, min(cls) AS value, count(*) AS pixels, min(x) - 0.5 AS xmin, max(x) + 0.5 AS xmax, 4 * count(*) - coalesce(min(inner_), 0) AS perimeter FROM g LEFT JOIN s USING (region) GROUP BY region"""))
def _(t):
    return rg.polygonize(t("px"), "cls").select("region", "value", "pixels", "xmin", "xmax", "perimeter")


@query("cc_group_touching", _recursive("""WITH RECURSIVE e AS (SELECT a.fid AS a, b.fid AS b FROM zone_ov a JOIN zone_ov b ON a.fid <> b.fid AND a.xmin - 0.001 < b.xmax AND b.xmin < a.xmax + 0.001 AND a.ymin - 0.001 < b.ymax AND b.ymin < a.ymax + 0.001),
w(fid, root) AS (SELECT fid, fid FROM zone_ov UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.fid WHERE w.root < e.b) SELECT fid, min(root) AS "group" FROM w GROUP BY fid"""))
def _(t):
    return rg.group_touching(t("zone_ov"), CELL).select("fid", "group")


@query("cc_link_tree_tops", _recursive("""WITH RECURSIVE e AS (SELECT a.fid AS a, b.fid AS b FROM pt a JOIN pt b ON a.fid <> b.fid AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 3 AND abs(a.z - b.z) <= 800),
w(fid, root) AS (SELECT fid, fid FROM pt UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.fid WHERE w.root < e.b) SELECT fid, min(root) AS "group" FROM w GROUP BY fid"""))
def _(t):
    return rg.link_tops(t("pt").withColumn("h", F.col("z").cast("double")), 10.0, 3, 800)


def _sieved(source: str) -> str:
    """CTEs up to `sv` (pid, r, c, cls): 8-connected regions of under 3 pixels of a source take the class of their largest neighbour."""
    return f"""WITH RECURSIVE e AS (SELECT p.pid AS a, q.pid AS b FROM {source} p JOIN {source} q ON p.cls = q.cls AND p.pid <> q.pid AND abs(p.r - q.r) <= 1 AND abs(p.c - q.c) <= 1),
w(pid, root) AS (SELECT pid, pid FROM {source} UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.pid WHERE w.root < e.b), l AS (SELECT pid, min(root) AS region FROM w GROUP BY pid),
g AS (SELECT region, pid, r, c, cls FROM l JOIN {source} USING (pid)), z AS (SELECT region, count(*) AS n, min(cls) AS v FROM g GROUP BY region),
m AS (SELECT DISTINCT a.region, b.region AS other FROM g a JOIN z ON z.region = a.region AND z.n < 3 CROSS JOIN range(-1, 2) t(d) JOIN g b ON b.r = a.r + t.d AND abs(a.c - b.c) <= 1 AND a.region <> b.region),
k AS (SELECT m.region, z.v FROM m JOIN z ON z.region = m.other QUALIFY row_number() OVER (PARTITION BY m.region ORDER BY z.n DESC, m.other) = 1),
sv AS (SELECT pid, r, c, coalesce(k.v, cls) AS cls FROM g LEFT JOIN k USING (region))"""


@query("cc_sieve", _recursive(f"{_sieved('px')} SELECT pid, cls FROM sv"))
def _(t):
    return rg.sieve(t("px").select("pid", "r", "c", "cls"), "cls", 3).select("pid", "cls")


@query("cc_prune_dangling_lines", "SELECT seg FROM coast WHERE seg BETWEEN (SELECT min(seg) + 3 FROM coast) AND (SELECT max(seg) - 3 FROM coast)")
def _(t):
    return rg.prune_dangling(t("coast"), 3).select("seg")


@query("cc_merge_small_polygons", None)
def _(t):
    from arpent.operators.joins import touching

    z = t("zone_ov")
    regions = z.select(F.col("fid").alias("node"), ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("size"))
    contacts = touching(z, CELL).where("a < b").select("a", "b", F.col("border").alias("length"))
    return rg.merge_small(regions, contacts, 60.0)


# --- sampling and learning -------------------------------------------------------------------------------------------


@query("ml_sample_points_per_class", "WITH n AS (SELECT cls, count(*) AS n FROM px GROUP BY cls) SELECT cls, CAST(ceil(n * 10 / 100.0) AS BIGINT) AS tenth, greatest(CAST(ceil(n * 10 / 100.0) AS BIGINT), (SELECT min(n) FROM n)) AS floored FROM n")
def _(t):
    a = le.sample_per_class(t("px"), "cls", 10).groupBy("cls").agg(F.count("*").alias("tenth"))
    return a.join(le.sample_per_class(t("px"), "cls", 10, floor=True).groupBy("cls").agg(F.count("*").alias("floored")), "cls")


@query("ml_random_points", None)
def _(t):
    return le.random_points(t("px"), 200, 7, ("cls", 200)).select("pid", "x", "y", "cls")


@query("ml_kmeans", None)
def _(t):
    return le.kmeans_labels(t("px").where("cls = 200").select("pid", "red", "green", "nir"), ["red", "green", "nir"], 4, 200)[0].select("pid", "micro")


@query("ml_random_forest", None)
def _(t):
    px = t("px").select("pid", "red", "green", "nir", (F.col("nir") > 128).cast("int").alias("y"))
    return le.train_and_classify(le.sample_per_class(px, "y", 10), px, ["red", "green", "nir"], "y", trees=10).select("pid", "y", "predicted", "confidence")


@query("ml_reduce_dimensions", None)
def _(t):
    return le.reduce_dimensions(t("px").select("pid", "red", "green", "nir", "swir1"), ["red", "green", "nir", "swir1"], 2).select("pid", "components")


@query("ml_stack_channels", "SELECT pid, red, hgt FROM px JOIN height_px USING (pid)")
def _(t):
    return t("px").select("pid", "red").join(t("height_px"), "pid")


@query("ml_natural_breaks", None)
def _(t):
    return le.natural_breaks(t("events").select("event_type", "value"), "event_type", "value", 5).drop("counts")


@query("ml_split_train_validation", "SELECT NULL::BOOLEAN AS empty, 0::BIGINT AS n WHERE false UNION ALL SELECT red < 100 AS empty, CASE WHEN red < 100 THEN CAST(least(count(*), floor((SELECT count(*) FROM px WHERE red >= 100) * 0.2)) AS BIGINT) ELSE count(*) END FROM px GROUP BY 1")
def _(t):
    px = t("px").select("pid", (F.col("red") < 100).alias("empty"))
    return le.split_train_validation(px, "pid", "empty", 70, 20).groupBy("empty").agg(F.count("*").alias("n"))


@query("dm_building_change", f"""WITH m AS (SELECT pid, r, c, (abs(nir - swir1) > 40 AND {INDEX_SQL['ndvi']} < 0.3)::INT AS m FROM px), e AS (SELECT pid, min(v) AS m FROM (SELECT {_NB.format(v='m', k=1).replace('px ', 'm ')} WHERE abs(n.r - p.r) + abs(n.c - p.c) <= 1) GROUP BY pid),
f AS (SELECT m.pid, m.r, m.c, e.m FROM m JOIN e USING (pid)) SELECT pid, max(v) AS changed FROM (SELECT {_NB.format(v='m', k=1).replace('px ', 'f ')} WHERE abs(n.r - p.r) + abs(n.c - p.c) <= 1) GROUP BY pid""")
def _(t):
    from arpent.catalogue import CHANNELS
    from arpent.functions.indices import index

    m = ((F.abs(F.col("nir") - F.col("swir1")) > 40) & (index("ndvi", CHANNELS) < 0.3)).cast("int")
    return fo.opening(t("px").select("pid", "r", "c", m.alias("m")), "m", 1, "changed").select("pid", "changed")
