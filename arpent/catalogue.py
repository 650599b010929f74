"""Registered queries of the library's own operators, each with the same statement in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arpent.fixtures import oracle, table
from arpent.functions import indices as ix
from arpent.functions import scalars as sc
from arpent.operators import algebra as al
from arpent.operators import joins as jn
from arpent.operators import quality as qu
from arpent.operators import tables as tb
from arpent.operators import zonal as zo
from arpent.plans import climate, risk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Bands of the test image that stand in for channels it lacks.
CHANNELS = {"red": "red", "green": "green", "blue": "blue", "nir": "nir", "swir1": "swir1", "swir2": "swir2", "mir": "swir2", "rededge": "swir1"}
CELL = 25.0


def query(name: str, sql: str | None):
    """Registers f(t), where t(name) gives a table."""

    def register(f):
        QUERIES[name] = lambda spark, sf_dir: f(lambda n: table(spark, sf_dir, n))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return f

    return register


def r6(*columns: str) -> list:
    """Columns rounded to six places under their own names."""
    return [F.round(F.col(c), 6).alias(c) for c in columns]


# --- spectral indices ------------------------------------------------------------------------------------------------


def _nd(a: str, b: str, guard: str) -> str:
    return f"CASE WHEN {a} = {b} THEN CASE WHEN {guard} = 0 THEN 0.0 ELSE 1e-7 END ELSE ({a} - {b}) / ({a} + {b} + 1e-7) END"


def _md(a: str, b: str, e: str) -> str:
    return f"CASE WHEN {a} = 0 AND {b} = 0 AND {e} = 0 THEN 0.0 WHEN {a} - {b} + {e} = 0 THEN 1e-7 ELSE ({a} - {b} + {e}) / ({a} + {b} + {e} + 1e-7) END"


_ETA = "((2 * (nir * nir - red * red) + 1.5 * nir + 0.5 * red) / nullif(nir + red + 0.5, 0))"
_HUE = "(CASE WHEN 2 * red - green - blue = 0 AND green = blue THEN 0.0 ELSE degrees(atan2(sqrt(3.0) * (green - blue), 2 * red - green - blue)) + CASE WHEN green < blue THEN 360.0 ELSE 0.0 END END)"
_INT = "((red + green + blue) / 3)"
INDEX_SQL = {
    "ndvi": _nd("nir", "red", "nir"), "ndvi_mod": _md("nir", "red", "swir1"), "ndwi": _nd("nir", "swir2", "nir"), "mndwi": _nd("green", "swir1", "swir1"), "ndmi": _nd("nir", "swir1", "swir1"),
    "tndvi": "CASE WHEN nir = 0 AND red = 0 THEN 0.0 ELSE sqrt(greatest((nir - red) / (nir + red + 1e-7) + 0.5, CASE WHEN (nir - red) / (nir + red + 1e-7) + 0.5 < 0 THEN 'NaN'::DOUBLE ELSE 0 END)) END",
    "pndvi": "CASE WHEN nir = 0 AND green = 0 AND red = 0 AND blue = 0 THEN 0.0 WHEN nir - green - red - blue = 0 THEN 1e-7 ELSE (nir - green - red - blue) / (nir + green + red + blue + 1e-7) END",
    "ndwi2": "CASE WHEN nir = green THEN CASE WHEN nir = 0 THEN 0.0 ELSE 1e-7 END ELSE (green - nir) / (green + nir + 1e-7) END", "ndwi2_mod": _md("green", "nir", "swir1"),
    "isu": "CASE WHEN red = 0 THEN 0.0 ELSE 75 * (red / nullif(nir, 0) + 1e-7) END",
    "gemi": f"CASE WHEN nir = 0 AND red = 0 THEN 0.0 ELSE {_ETA} * (1 - 0.25 * {_ETA}) - (red - 0.125) / nullif(1 - red, 0) END",
    "bsi": "CASE WHEN red = 0 AND blue = 0 AND nir = 0 AND swir1 = 0 THEN 0.0 ELSE ((swir1 + red) - (nir + blue)) / ((swir1 + red) + (nir + blue) + 1e-7) END",
    "ndbi": _nd("swir2", "nir", "swir2"),
    "nbi": "CASE WHEN swir2 = 0 AND nir = 0 AND red = 0 THEN 0.0 WHEN red <> swir2 AND (red = 0 OR swir2 = 0) THEN 1e-7 ELSE red * swir2 / (nir + 1e-7) END",
    "redness": "CASE WHEN green = 0 AND blue = 0 AND red = 0 THEN 0.0 WHEN red = 0 THEN 1e-7 ELSE red * red / (1e-7 + blue + green * green * green) END",
    "ci": _nd("red", "green", "red"), "bi": "sqrt(nir * nir + red * red)", "bi2": "sqrt((nir * nir + red * red + green * green) / 3)",
    "c3": "CASE WHEN blue = 0 THEN 0.0 ELSE atan(blue / (greatest(red, green) + 1e-7)) END",
    "exg": "CASE WHEN green - red - blue = 0 THEN 0.0 ELSE 2 * (green - red - blue) / (red + green + blue + 1e-7) END",
    "luminance": "CASE WHEN red = 0 AND green = 0 AND blue = 0 THEN 0.0 ELSE (red + green + blue) / 3 END",
    "msavi2": "CASE WHEN nir = 0 AND red = 0 THEN 1e-7 ELSE (2 * nir + 1 - CASE WHEN (2 * nir + 1) * (2 * nir + 1) - 8 * (nir - red) >= 0 THEN sqrt(greatest(0, (2 * nir + 1) * (2 * nir + 1) - 8 * (nir - red))) END + 1e-7) / 2 END",
    "sipi": "CASE WHEN nir = red OR (nir = blue AND nir = 0) THEN 1e-7 ELSE (nir - blue) / (nir - red + 1e-7) END",
    "hue": _HUE, "intensity": _INT, "saturation": "CASE WHEN red + green + blue = 0 THEN 0.0 ELSE 1 - 3 * least(red, green, blue) / nullif(red + green + blue, 0) END",
    "isi": f"CASE WHEN {_HUE} = -{_INT} AND {_INT} = 0 THEN 0.001 ELSE (({_HUE} - {_INT}) / nullif({_HUE} + {_INT}, 0) + (1 - nir)) / nullif(({_HUE} - {_INT}) / nullif({_HUE} + {_INT}, 0) + (1 + nir), 0) END",
    "vssi": "2 * green - 5 * (red + nir)", "blue_index": "CASE WHEN blue = 0 THEN 0.0 ELSE blue / (red + green + blue) + 1e-7 END",
    "scowi": "blue + 2 * green - 2.4 * nir", "scowi_swir": "blue + 2 * (green - nir) - 0.75 * swir1 - 0.5 * swir2",
}


def _index_query(name: str) -> None:
    query(f"idx_{name}", f"SELECT pid, round({INDEX_SQL[name]}, 6) AS value FROM px")(
        lambda t: t("px").select("pid", F.round(ix.index(name, CHANNELS), 6).alias("value"))
    )


for _name in ix.INDICES:
    _index_query(_name)


@query("idx_compute_indices", f"SELECT pid, round({INDEX_SQL['ndvi']}, 6) AS ndvi, round({INDEX_SQL['ndwi2']}, 6) AS ndwi2, round({INDEX_SQL['exg']}, 6) AS exg FROM px")
def _(t):
    return ix.compute_indices(t("px"), ["ndvi", "ndwi2", "exg"], CHANNELS).select("pid", *r6("ndvi", "ndwi2", "exg"))


# --- band maths ------------------------------------------------------------------------------------------------------


@query("bm_raster_calculator", "SELECT pid, red + hgt * 2 AS value FROM px JOIN height_px USING (pid)")
def _(t):
    return al.raster_calculator({"a": (t("px"), "red"), "b": (t("height_px"), "hgt")}, "a + b * 2")


@query("bm_surface_height", "SELECT pid, nir + hgt AS value FROM px JOIN height_px USING (pid)")
def _(t):
    return al.align({"a": (t("px"), "nir"), "b": (t("height_px"), "hgt")}).select("pid", al.surface_height(F.col("a"), F.col("b")).alias("value"))


@query("bm_masks", "SELECT pid, (nir > 100)::INT AS above, (nir <= 100)::INT AS below, (red BETWEEN 50 AND 150)::INT AS inside, (red <> 0 AND green <> 0 AND blue <> 0)::INT AS valid FROM px")
def _(t):
    nir, bands = F.col("nir"), [F.col(b) for b in ("red", "green", "blue")]
    return t("px").select("pid", al.binary_mask(nir, 100).alias("above"), al.binary_mask(nir, 100, False).alias("below"), al.range_mask(F.col("red"), 50, 150).alias("inside"), al.valid_mask(bands, 0).alias("valid"))


@query("bm_apply_masks", "SELECT pid, CASE WHEN cls = 100 THEN red ELSE 0 END AS held, (red <> 0 OR green <> 0)::INT AS either, CASE WHEN cls = 200 THEN abs(red - green) ELSE 0.0 END AS difference FROM px")
def _(t):
    red, green, is_ = F.col("red"), F.col("green"), lambda c: (F.col("cls") == c).cast("int")
    return t("px").select("pid", al.mask_and(red, is_(100)).alias("held"), al.mask_or(red, green).alias("either"), al.masked_difference(red, green, is_(200)).alias("difference"))


@query("bm_merge_first_nonzero", "SELECT pid, coalesce(nullif(CASE WHEN cls = 100 THEN 0 ELSE cls END, 0), nullif(ref, 100), 0) AS value FROM px")
def _(t):
    layers = [F.when(F.col("cls") == 100, 0).otherwise(F.col("cls")), F.when(F.col("ref") == 100, 0).otherwise(F.col("ref"))]
    return t("px").select("pid", al.first_valid(layers).alias("value"))


@query("bm_overlay_first_valid", "SELECT pid, coalesce(nullif(cls, 300), nullif(ref, 300), 300) AS value FROM px")
def _(t):
    return t("px").select("pid", al.first_valid([F.col("cls"), F.col("ref")], 300).alias("value"))


@query("bm_drop_overlapping_masks", "WITH m AS (SELECT pid, (red > 128)::INT AS a, (green > 128)::INT AS b FROM px) SELECT pid, CASE WHEN a + b > 1 THEN 0 ELSE a END AS a, CASE WHEN a + b > 1 THEN 0 ELSE b END AS b FROM m")
def _(t):
    a, b = al.drop_overlaps([al.binary_mask(F.col("red"), 128), al.binary_mask(F.col("green"), 128)])
    return t("px").select("pid", a.alias("a"), b.alias("b"))


@query("bm_reclass", "SELECT pid, CASE cls WHEN 100 THEN 11000 WHEN 200 THEN 12000 WHEN 300 THEN 22000 ELSE cls END AS value FROM px")
def _(t):
    return t("px").select("pid", al.reclass(F.col("cls"), {100: 11000, 200: 12000, 300: 22000}).alias("value"))


@query("bm_fuse_micro_to_macro", "SELECT pid, CAST(round_even((cls + red) / 100, 0) * 100 AS INTEGER) AS value FROM px")
def _(t):
    return t("px").select("pid", al.fuse_to_macro(F.col("cls") + F.col("red")).alias("value"))


@query("bm_minmax_normalise", "SELECT pid, round((red - min(red) OVER ()) / nullif(max(red) OVER () - min(red) OVER (), 0), 6) AS red, round((nir - min(nir) OVER ()) / nullif(max(nir) OVER () - min(nir) OVER (), 0), 6) AS nir FROM px")
def _(t):
    return al.minmax_normalise(t("px").select("pid", "red", "nir"), ["red", "nir"]).select("pid", *r6("red", "nir"))


@query("bm_height_model", "SELECT pid, CASE WHEN nir >= 9999 OR hgt >= 9999 THEN -1.0 WHEN nir < hgt THEN 0.0 ELSE nir - hgt END AS value FROM px JOIN height_px USING (pid)")
def _(t):
    return al.align({"a": (t("px"), "nir"), "b": (t("height_px"), "hgt")}).select("pid", al.height_model(F.col("a"), F.col("b")).alias("value"))


@query("bm_height_classes", "SELECT pid, CASE WHEN hgt >= 150 THEN 3 WHEN hgt >= 75 THEN 2 WHEN hgt >= 25 THEN 1 ELSE 0 END AS value FROM height_px")
def _(t):
    return t("height_px").select("pid", al.height_classes(F.col("hgt"), [75, 25, 150]).alias("value"))


@query("bm_replace_under_mask", "SELECT pid, CASE WHEN red > 128 AND cls = 200 THEN 900 ELSE cls END AS one, CASE WHEN red > 128 THEN 900 ELSE cls END AS every FROM px")
def _(t):
    m = al.binary_mask(F.col("red"), 128)
    return t("px").select("pid", al.replace_under_mask(F.col("cls"), m, 900, 200).alias("one"), al.replace_under_mask(F.col("cls"), m, 900).alias("every"))


@query("bm_layer_threshold", "SELECT pid, (cls = 100 AND nir BETWEEN 50 AND 200)::INT AS both_, (cls = 100 OR nir BETWEEN 50 AND 200)::INT AS either FROM px")
def _(t):
    s = (F.col("cls") == 100).cast("int")
    return t("px").select("pid", al.layer_threshold(s, F.col("nir"), 50, 200).alias("both_"), al.layer_threshold(s, F.col("nir"), 50, 200, "or").alias("either"))


@query("bm_argmax_class", "SELECT pid, CASE WHEN red >= green AND red >= blue THEN 0 WHEN green >= blue THEN 1 ELSE 2 END AS cls, greatest(red, green, blue) AS confidence, CASE WHEN green >= blue THEN 1 ELSE 2 END AS foreground FROM px")
def _(t):
    scores = F.array("red", "green", "blue")
    (c, v), (fg, _) = al.argmax_class(scores), al.argmax_class(scores, skip_background=True)
    return t("px").select("pid", c.alias("cls"), v.alias("confidence"), fg.alias("foreground"))


@query("bm_affine_coords", "SELECT pid, x, y, floor(x / 10) * 10 AS x0, floor(y / 10) * 10 AS y0, ceil(x / 10) * 10 AS x1, ceil(y / 10) * 10 AS y1 FROM px")
def _(t):
    px, h = t("px"), t("grid_meta").select("h")
    x, y = al.pixel_centres(F.col("r"), F.col("c"), 0, 0)
    snapped = al.snap_extent(F.col("x"), F.col("y"), F.col("x"), F.col("y"), 10.0)
    out = px.select("pid", "r", "c").join(F.broadcast(h)).withColumn("x", x).withColumn("y", F.col("h") + y)
    return out.select("pid", "x", "y", *[v.alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), snapped, strict=True)])


@query("bm_apply_palette", "WITH lut AS (SELECT DISTINCT n_regionkey AS k FROM nation WHERE n_regionkey BETWEEN 1 AND 4) SELECT pid, CAST(coalesce(k * 10, 0) AS BIGINT) AS red_, CAST(coalesce(k * 20, 0) AS BIGINT) AS green_, CAST(coalesce(k * 30, 0) AS BIGINT) AS blue_ FROM px LEFT JOIN lut ON cls = k * 100")
def _(t):
    k = F.col("n_regionkey").cast("long")
    lut = t("nation").where("n_regionkey BETWEEN 1 AND 4").select((k * 100).cast("int").alias("k"), *[(k * m).alias(f"c{m}") for m in (10, 20, 30)]).distinct()
    return al.apply_palette(t("px").select("pid", "cls"), lut, "cls").select("pid", F.col("out_1").alias("red_"), F.col("out_2").alias("green_"), F.col("out_3").alias("blue_"))


@query("bm_footprint_mask", "SELECT pid, (red + green + blue <> 0)::INT AS three, (nir <> 0)::INT AS one FROM px")
def _(t):
    return t("px").select("pid", al.footprint([F.col("red"), F.col("green"), F.col("blue")], 0).alias("three"), al.footprint([F.col("nir")], 0).alias("one"))


# --- filters, attributes, scalars ------------------------------------------------------------------------------------


@query("flt_filter_select", "SELECT fid, nature FROM bld WHERE hauteur > 20 AND nature LIKE '%ECONOMY%'")
def _(t):
    return tb.filter_select(t("bld"), ["fid", "nature"], "hauteur > 20 AND nature LIKE '%ECONOMY%'")


@query("flt_min_area", "SELECT nature, round(sum((xmax - xmin) * (ymax - ymin)), 6) AS area FROM bld WHERE (xmax - xmin) * (ymax - ymin) >= 4 GROUP BY nature")
def _(t):
    return tb.filter_min_area(t("bld"), (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")), 4, "nature")[1].select("nature", *r6("area"))


@query("flt_delete_classes", "SELECT pid, cls FROM px WHERE cls NOT IN (100, 300)")
def _(t):
    return tb.delete_classes(t("px").select("pid", "cls"), "cls", [100, 300])


@query("flt_reallocate_classes", "SELECT pid, CASE cls WHEN 100 THEN 150 ELSE cls END AS cls FROM px WHERE cls <> 200")
def _(t):
    px = t("px").select("pid", "cls")
    return tb.reallocate_classes(px, px.sparkSession.createDataFrame([(100, "relabel", 150), (200, "delete", None)], "class int, action string, target int"), "cls").select("pid", "cls")


@query("col_edit_fields", "SELECT fid, nature AS kind, 'map' AS origin, CAST(row_number() OVER (PARTITION BY nature ORDER BY fid) AS INTEGER) AS idx FROM bld")
def _(t):
    out = tb.edit_fields(t("bld").select("fid", "nature", "hauteur"), {"origin": "map"}, {"nature": "kind"}, ("hauteur",))
    return tb.row_index(out, ["fid"], ["kind"])


@query("col_update_by_key", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 7 = 0 THEN -1.5 END, CAST(c_acctbal AS DOUBLE)) AS c_acctbal FROM customer")
def _(t):
    c = t("customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    return tb.update_by_key(c, c.where("c_custkey % 7 = 0").select("c_custkey", F.lit(-1.5).alias("c_acctbal")), "c_custkey")


@query("col_cast_columns", "SELECT pid, CAST(red / 7 AS DECIMAL(12,2)) AS red, CAST(round(nir / 7, 0) AS SMALLINT) AS nir FROM px")
def _(t):
    px = t("px").select("pid", (F.col("red") / 7).alias("red"), (F.col("nir") / 7).alias("nir"))
    return tb.cast_columns(px, {"red": "decimal(12,2)", "nir": "smallint"}, ("nir",))


@query("str_labels", "SELECT p_partkey, regexp_replace(p_name, '[^A-Za-z0-9_]', '_', 'g') AS label, substr(p_name, 1, 10) AS short, trim(regexp_replace(p_type, ' +', ' ', 'g')) AS clean, regexp_replace(p_name || '.tif', '\\.[^.]*$', '.shp') AS renamed FROM part")
def _(t):
    n = F.col("p_name")
    return t("part").select("p_partkey", sc.normalise_label(n).alias("label"), sc.truncate_name(n).alias("short"), sc.clean_spaces(F.col("p_type")).alias("clean"), sc.replace_suffix(F.concat(n, F.lit(".tif")), ".shp").alias("renamed"))


@query("str_label_from_history", "SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN substr(n_name, 1, 1) WHEN 1 THEN '0' END AS label FROM nation")
def _(t):
    h = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("LCZ "), F.substring("n_name", 1, 1), F.lit("_0161"))).when(F.col("n_nationkey") % 3 == 1, F.col("n_name"))
    return t("nation").select("n_nationkey", sc.label_from_history(h).alias("label"))


@query("mth_moments", "SELECT event_type, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance, round(stddev_pop(value), 6) AS std FROM events GROUP BY event_type")
def _(t):
    return t("events").groupBy("event_type").agg(F.avg("value").alias("mean"), F.var_pop("value").alias("variance"), F.stddev_pop("value").alias("std")).select("event_type", *r6("mean", "variance", "std"))


@query("mth_euclidean_distance", "SELECT pid, round(sqrt((red - nir) * (red - nir) + (green - swir1) * (green - swir1)), 6) AS d, -1.0::DOUBLE AS unequal FROM px")
def _(t):
    return t("px").select("pid", F.round(sc.euclidean_distance(F.array("red", "green"), F.array("nir", "swir1")), 6).alias("d"), sc.euclidean_distance(F.array("red"), F.array("nir", "swir1")).alias("unequal"))


@query("mth_arg_extremes", "SELECT pid, CASE WHEN red <= green AND red <= blue THEN 0 WHEN green <= blue THEN 1 ELSE 2 END AS arg_min, CASE WHEN red >= green AND red >= blue THEN 0 WHEN green >= blue THEN 1 ELSE 2 END AS arg_max FROM px WHERE red <> -1")
def _(t):
    v = F.array("red", "green", "blue")
    return t("px").select("pid", sc.arg_min_except(v, [-1.0]).alias("arg_min"), sc.arg_max(v).alias("arg_max"))


@query("mth_standardise", "SELECT pid, round((red - avg(red) OVER ()) / stddev_pop(red) OVER (), 6) AS z FROM px")
def _(t):
    px = t("px").select("pid", "red")
    m = px.agg(F.avg("red").alias("m"), F.stddev_pop("red").alias("s"))
    return px.join(F.broadcast(m)).select("pid", F.round((F.col("red") - F.col("m")) / F.col("s"), 6).alias("z"))


@query("mth_centroid", "SELECT label, i AS dim, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS value FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY label, i")
def _(t):
    long = t("embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    return long.groupBy("label", (F.col("i") + 1).cast("long").alias("dim")).agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("value"))


# --- joins -----------------------------------------------------------------------------------------------------------

_MEET = "a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax"
_AREA = "(least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * (least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin))"
_IN = "x >= xmin AND x < xmax AND y >= ymin AND y < ymax"


@query("jn_join_on_id", "SELECT pid, cls, hgt FROM px JOIN height_px USING (pid)")
def _(t):
    return t("px").select("pid", "cls").join(t("height_px"), "pid")


@query("jn_spatial_join_intersects", f"SELECT DISTINCT a.fid AS zone, b.nature AS nature FROM zone_ov a JOIN bld b ON {_MEET}")
def _(t):
    return jn.box_join(t("zone_ov"), t("bld"), CELL).select(F.col("a_fid").alias("zone"), F.col("b_nature").alias("nature")).distinct()


@query("jn_intersection_overlay", f"SELECT a.fid AS zone, b.fid AS bld, round({_AREA}, 6) AS area FROM zone a JOIN bld b ON {_MEET}")
def _(t):
    return jn.intersection_overlay(t("zone"), t("bld"), CELL).select(F.col("a_fid").alias("zone"), F.col("b_fid").alias("bld"), *r6("area"))


@query("jn_polygons_containing", f"SELECT fid, zoning FROM zone_ov WHERE EXISTS (SELECT 1 FROM pt WHERE {_IN})")
def _(t):
    return jn.holding(t("zone_ov"), t("pt"), CELL).select("fid", "zoning")


@query("jn_delete_intersecting", f"SELECT 'zone' AS layer, a.fid FROM zone_ov a WHERE NOT EXISTS (SELECT 1 FROM bld b WHERE {_MEET}) UNION ALL SELECT 'bld', b.fid FROM bld b WHERE NOT EXISTS (SELECT 1 FROM zone_ov a WHERE {_MEET})")
def _(t):
    a, b = jn.delete_meeting(t("zone_ov"), t("bld"), CELL)
    return a.select(F.lit("zone").alias("layer"), "fid").union(b.select(F.lit("bld"), "fid"))


_GAP = "greatest(a.xmin - b.xmax, b.xmin - a.xmax, 0.0)", "greatest(a.ymin - b.ymax, b.ymin - a.ymax, 0.0)"


@query("jn_within_distance", f"SELECT a.fid AS zone, b.fid AS bld, round(sqrt({_GAP[0]} * {_GAP[0]} + {_GAP[1]} * {_GAP[1]}), 6) AS distance FROM zone_ov a JOIN bld b ON sqrt({_GAP[0]} * {_GAP[0]} + {_GAP[1]} * {_GAP[1]}) <= 2.5")
def _(t):
    return jn.within_distance(t("zone_ov"), t("bld"), 2.5, CELL).select(F.col("a_fid").alias("zone"), F.col("b_fid").alias("bld"), *r6("distance"))


_SEG_T = "least(1.0, greatest(0.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))))"
_SEG_D = f"sqrt((x - (x1 + {_SEG_T} * (x2 - x1))) * (x - (x1 + {_SEG_T} * (x2 - x1))) + (y - (y1 + {_SEG_T} * (y2 - y1))) * (y - (y1 + {_SEG_T} * (y2 - y1))))"


@query("jn_nearest_distance", f"SELECT fid, round(min({_SEG_D}), 6) AS distance FROM pt CROSS JOIN coast GROUP BY fid")
def _(t):
    return jn.nearest_segment(t("pt").select("fid", "x", "y"), t("coast"), CELL).select("fid", *r6("distance"))


@query("jn_nearest_distance_within_reach", f"SELECT fid, round(min(CASE WHEN {_SEG_D} <= 8 THEN {_SEG_D} END), 6) AS distance FROM pt CROSS JOIN coast GROUP BY fid")
def _(t):
    return jn.nearest_segment(t("pt").select("fid", "x", "y"), t("coast"), CELL, reach=8.0).select("fid", *r6("distance"))


@query("jn_not_in_fill", f"WITH n AS (SELECT z.fid, count(*) AS n FROM zone_ov z JOIN pt ON {_IN} GROUP BY z.fid) SELECT fid, coalesce(n, 0) AS n FROM zone_ov LEFT JOIN n USING (fid)")
def _(t):
    n = jn.points_in_boxes(t("pt"), t("zone_ov"), CELL).groupBy(F.col("b_fid").alias("fid")).agg(F.count("*").alias("n"))
    return jn.fill_missing(t("zone_ov").select("fid"), n, "fid", {"n": 0})


@query("jn_left_join_chain", "SELECT c_custkey, o_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey NULLS FIRST, l_linenumber NULLS FIRST) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN (SELECT l_orderkey, l_linenumber FROM lineitem) ON l_orderkey = o_orderkey) WHERE n = 1")
def _(t):
    lines = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    orders = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey").join(lines, "o_orderkey", "left")
    return jn.left_join_chain(t("customer").select("c_custkey"), [orders], "c_custkey", ["o_orderkey", "l_linenumber"])


@query("jn_spatial_filter_export", "SELECT fid AS id, hauteur AS height FROM bld WHERE xmin <= 42 AND xmax >= 18 AND ymin <= 7 AND ymax >= 1")
def _(t):
    return jn.filter_and_rename(t("bld"), (20, 3, 40, 5), {"fid": "id", "hauteur": "height"}, pad=2)


@query("jn_contained_in", "SELECT a.fid, (SELECT b.fid FROM zone_ov b WHERE b.fid <> a.fid AND b.xmin <= a.xmin AND b.ymin <= a.ymin AND b.xmax >= a.xmax AND b.ymax >= a.ymax ORDER BY (b.xmax - b.xmin) * (b.ymax - b.ymin), b.fid LIMIT 1) AS within FROM zone_ov a")
def _(t):
    return jn.contained_in(t("zone_ov"), CELL).select("fid", "within")


@query("jn_touching_neighbours", """SELECT a.fid AS a, b.fid AS b, round((least(a.xmax + 0.001, b.xmax) - greatest(a.xmin - 0.001, b.xmin)) * (least(a.ymax + 0.001, b.ymax) - greatest(a.ymin - 0.001, b.ymin)), 6) AS border,
  CAST(row_number() OVER (PARTITION BY a.fid ORDER BY (least(a.xmax + 0.001, b.xmax) - greatest(a.xmin - 0.001, b.xmin)) * (least(a.ymax + 0.001, b.ymax) - greatest(a.ymin - 0.001, b.ymin)) DESC, b.fid) AS INTEGER) AS rank
  FROM zone_ov a JOIN zone_ov b ON a.fid <> b.fid AND a.xmin - 0.001 < b.xmax AND b.xmin < a.xmax + 0.001 AND a.ymin - 0.001 < b.ymax AND b.ymin < a.ymax + 0.001""")
def _(t):
    return jn.touching(t("zone_ov"), CELL).select("a", "b", *r6("border"), "rank")


@query("jn_cross_distance", """WITH m AS (SELECT cls * 10 + ref AS micro, cls AS macro, avg(red) AS r, avg(nir) AS n FROM px GROUP BY cls, ref),
p AS (SELECT a.micro AS a, b.micro AS b, sqrt((a.r - b.r) * (a.r - b.r) + (a.n - b.n) * (a.n - b.n)) AS distance FROM m a JOIN m b ON a.macro <> b.macro)
SELECT a, b, round(distance, 6) AS distance, CAST(row_number() OVER (PARTITION BY a ORDER BY distance, b) AS INTEGER) AS rank FROM p QUALIFY rank <= 2""")
def _(t):
    m = t("px").groupBy("cls", "ref").agg(F.avg("red").alias("r"), F.avg("nir").alias("n"))
    c = m.select((F.col("cls") * 10 + F.col("ref")).alias("micro"), F.col("cls").alias("macro"), F.array("r", "n").alias("v"))
    return jn.cross_distance(c).select("a", "b", *r6("distance"), "rank")


@query("jn_sample_nearest", "SELECT fid, red AS value FROM pt LEFT JOIN px ON c = floor(pt.x) AND r = floor((SELECT h FROM grid_meta) - pt.y)")
def _(t):
    p = t("pt").join(F.broadcast(t("grid_meta").select("h"))).withColumn("y", -(F.col("h") - F.col("y")))
    return jn.sample_nearest(p.select("fid", "x", "y"), t("px"), "red", 0, 0).select("fid", "value")


@query("jn_sample_bilinear", """WITH p AS (SELECT fid, x - 0.5 AS u, (SELECT h FROM grid_meta) - y - 0.5 AS v, floor(x) AS nc, floor((SELECT h FROM grid_meta) - y) AS nr FROM pt),
s AS (SELECT fid, count(*) AS k, sum((1 - abs(u - c)) * (1 - abs(v - r)) * red) AS b FROM p JOIN px ON c IN (floor(u), floor(u) + 1) AND r IN (floor(v), floor(v) + 1) GROUP BY fid)
SELECT p.fid, round(coalesce(CASE WHEN k = 4 THEN b END, red), 6) AS value FROM p LEFT JOIN s USING (fid) LEFT JOIN px ON c = nc AND r = nr""")
def _(t):
    p = t("pt").join(F.broadcast(t("grid_meta").select("h"))).withColumn("y", -(F.col("h") - F.col("y")))
    return jn.sample_bilinear(p.select("fid", "x", "y"), t("px"), "red", 0, 0).select("fid", *r6("value"))


@query("jn_rasterize", f"SELECT pid, coalesce((SELECT max(fid) FROM zone_ov WHERE {_IN}), 0) AS burned FROM px")
def _(t):
    return jn.rasterize(t("zone_ov"), t("px"), CELL).select("pid", "burned")


@query("jn_clip_raster", f"SELECT fid, pid FROM zone_ov JOIN px ON {_IN}")
def _(t):
    return jn.points_in_boxes(t("px").select("pid", "x", "y"), t("zone_ov"), CELL).select(F.col("b_fid").alias("fid"), F.col("p_pid").alias("pid"))


@query("jn_cut_grid", "SELECT tx, ty, count(*) AS n FROM (SELECT *, unnest(range(CAST(greatest(0, ceil((r - 21) / 20)) AS BIGINT), CAST(floor((r + 2) / 20) AS BIGINT) + 1)) AS ty FROM (SELECT r, unnest(range(CAST(greatest(0, ceil((c - 21) / 20)) AS BIGINT), CAST(floor((c + 2) / 20) AS BIGINT) + 1)) AS tx FROM px)) GROUP BY tx, ty")
def _(t):
    return jn.cut_grid(t("px"), 20, 2).groupBy("tx", "ty").agg(F.count("*").alias("n"))


@query("jn_superimpose", "SELECT r // 5 AS r, c // 5 AS c, red AS value FROM px WHERE r % 5 = 2 AND c % 5 = 2")
def _(t):
    return jn.superimpose(t("px"), "red", 5)


@query("jn_mosaic", "SELECT r, c, CASE WHEN red <> 0 AND c < 80 THEN red WHEN green <> 0 AND c > 40 THEN green ELSE 0.0 END AS value FROM px WHERE c < 80 OR c > 40")
def _(t):
    px = t("px")
    a, b = px.where("c < 80").select("r", "c", F.col("red").alias("v")), px.where("c > 40").select("r", "c", F.col("green").alias("v"))
    return jn.mosaic([a, b], "v").select("r", "c", F.col("value").cast("double").alias("value"))


@query("jn_stack_indicators", "SELECT z.fid, coalesce(CASE WHEN z.fid % 2 = 0 THEN z.xmin END, 0.0) AS hre, coalesce(CASE WHEN z.fid % 3 = 0 THEN z.ymin END, 0.0) AS bsf FROM zone z")
def _(t):
    z = t("zone")
    return jn.stack_indicators(z.select("fid"), {"hre": (z.where("fid % 2 = 0"), "xmin"), "bsf": (z.where("fid % 3 = 0"), "ymin")})


# --- aggregates ------------------------------------------------------------------------------------------------------


@query("ag_zonal_stats", f"""WITH v AS (SELECT fid, red AS v FROM zone JOIN px ON {_IN}),
m AS (SELECT fid, v, count(*) AS k FROM v GROUP BY fid, v),
t AS (SELECT fid, arg_min(v, (-k, v)) AS majority, arg_min(v, (k, v)) AS minority FROM m GROUP BY fid),
s AS (SELECT fid, count(*) AS count, min(v) AS min, max(v) AS max, avg(v) AS mean, sum(v) AS sum, stddev_pop(v) AS std, quantile_cont(v, 0.5) AS median, count(DISTINCT v) AS "unique", max(v) - min(v) AS range, quantile_cont(v, 0.9) AS percentile_90 FROM v GROUP BY fid)
SELECT zone.fid, coalesce(count, 0) AS count, min, max, round(mean, 6) AS mean, sum, round(std, 6) AS std, median, coalesce("unique", 0) AS "unique", range, round(percentile_90, 6) AS percentile_90, majority, minority FROM zone LEFT JOIN s USING (fid) LEFT JOIN t USING (fid)""")
def _(t):
    stats = ("count", "min", "max", "mean", "sum", "std", "median", "unique", "range", "percentile_90", "majority", "minority")
    out = zo.zonal_stats(t("zone"), t("px"), "red", stats)
    return out.select("fid", *[F.round(c, 6).alias(c) if c in ("mean", "std", "percentile_90") else c for c in stats])


@query("ag_zonal_categories", f"""WITH v AS (SELECT fid, count(*) AS n, count(*) FILTER (cls IN (100, 200)) AS a, count(*) FILTER (cls = 300) AS b, count(*) FILTER (cls = 999) AS z FROM zone JOIN px ON {_IN} GROUP BY fid)
SELECT zone.fid, round(coalesce(100.0 * a / n, 0), 6) AS built, round(coalesce(100.0 * b / n, 0), 6) AS water, round(coalesce(100.0 * z / n, 0), 6) AS other, round(coalesce(a * 4.0, 0), 6) AS "S_built" FROM zone LEFT JOIN v USING (fid)""")
def _(t):
    out = zo.zonal_shares(t("zone"), t("px"), "cls", {100: "built", 200: "built", 300: "water", 999: "other"}, pixel_area=4.0, areas=True)
    return out.select("fid", *r6("built", "water", "other", "S_built"))


@query("ag_zonal_area_weighted", """WITH p AS (SELECT fid, cls AS value, (least(xmax, x + 0.5) - greatest(xmin, x - 0.5)) * (least(ymax, y + 0.5) - greatest(ymin, y - 0.5)) AS area, (xmax - xmin) * (ymax - ymin) AS whole
  FROM (SELECT fid, xmin + 0.25 AS xmin, ymin + 0.25 AS ymin, xmax + 0.25 AS xmax, ymax + 0.25 AS ymax FROM zone_ov) JOIN px ON xmin < x + 0.5 AND xmax > x - 0.5 AND ymin < y + 0.5 AND ymax > y - 0.5)
SELECT fid, value, round(sum(area), 6) AS area, round(100 * sum(area) / first(whole), 6) AS share FROM p GROUP BY fid, value""")
def _(t):
    moved = t("zone_ov").select("fid", *[(F.col(c) + 0.25).alias(c) for c in jn.BOX])
    return zo.zonal_stats_area_weighted(moved, t("px"), "cls").select("fid", "value", *r6("area", "share"))


@query("ag_majority_relabel", f"WITH m AS (SELECT fid, cls, count(*) AS k FROM zone JOIN px ON {_IN} GROUP BY fid, cls) SELECT zone.fid, label FROM zone LEFT JOIN (SELECT fid, arg_min(cls, (-k, cls)) AS label FROM m GROUP BY fid) USING (fid)")
def _(t):
    return zo.zonal_stats(t("zone"), t("px"), "cls", ("majority",)).select("fid", F.col("majority").alias("label"))


@query("ag_band_statistics", " UNION ALL ".join(f"SELECT '{b}' AS band, min({b}) AS min, max({b}) AS max, round(avg({b}), 6) AS mean, round(stddev_pop({b}), 6) AS std FROM px WHERE {b} <> 0" for b in ("red", "green", "nir")))
def _(t):
    return zo.band_statistics(t("px"), ["red", "green", "nir"], nodata=0).select("band", "min", "max", *r6("mean", "std"))


@query("ag_unique_values", "SELECT cls, count(*) AS n FROM px GROUP BY cls")
def _(t):
    return t("px").groupBy("cls").agg(F.count("*").alias("n"))


@query("ag_histogram", "SELECT CAST(CASE WHEN value < 0 THEN 0 WHEN value >= 100 THEN 21 ELSE floor(value / 5) + 1 END AS INTEGER) AS bucket, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return zo.histogram(t("events"), "value", 0, 100, 20)


@query("ag_dissolve_boxes", "SELECT zoning, count(*) AS parts, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM zone_ov GROUP BY zoning")
def _(t):
    return t("zone_ov").groupBy("zoning").agg(F.count("*").alias("parts"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


@query("ag_mean_area_per_macro", "SELECT CAST(floor((cls + ref / 10) / 100) * 100 AS INTEGER) AS macro, round(sum(red) / count(DISTINCT cls + ref / 10), 6) AS mean_area FROM px GROUP BY 1")
def _(t):
    px = t("px").withColumn("micro", F.col("cls") + F.col("ref") / 10)
    return zo.mean_area_per_macro(px, "micro", "red").select("macro", *r6("mean_area"))


@query("ag_class_point_statistics", " UNION ALL ".join(f"SELECT cls, '{b}' AS band, count({b}) AS n, round(avg({b}), 6) AS mean, round(stddev_pop({b}), 6) AS std FROM px GROUP BY cls" for b in ("red", "nir")))
def _(t):
    return zo.class_point_statistics(t("px"), "cls", ["red", "nir"]).select("cls", "band", "n", *r6("mean", "std"))


@query("ag_allocate_by_weight", "WITH s AS (SELECT src, sum(w) AS tw FROM alloc GROUP BY src) SELECT dst, round(sum(w / nullif(tw, 0) * c_acctbal), 4) AS allocated FROM alloc JOIN s USING (src) JOIN customer ON c_custkey = src GROUP BY dst")
def _(t):
    totals = t("customer").select(F.col("c_custkey").alias("src"), F.col("c_acctbal").cast("double").alias("total"))
    return zo.allocate_by_weight(totals, t("alloc"), "src", "dst", "w", "total").select("dst", F.round("allocated", 4).alias("allocated"))


@query("ag_volume_weighted_height", f"""WITH p AS (SELECT a.fid, {_AREA} AS area, b.hauteur AS h, (a.xmax - a.xmin) * (a.ymax - a.ymin) AS whole FROM zone a JOIN bld b ON {_MEET})
SELECT fid, round(sum(area * h * h) / nullif(sum(area * h), 0), 6) AS height, round(sum(area) / first(whole), 6) AS plan_ratio FROM p GROUP BY fid""")
def _(t):
    p = jn.intersection_overlay(t("zone"), t("bld"), CELL)
    whole = (F.col("a_xmax") - F.col("a_xmin")) * (F.col("a_ymax") - F.col("a_ymin"))
    h = F.col("b_hauteur")
    return p.groupBy(F.col("a_fid").alias("fid")).agg(F.round(zo.volume_weighted_height(F.col("area") * h, h), 6).alias("height"), F.round(F.sum("area") / F.first(whole), 6).alias("plan_ratio"))


@query("ag_checksum_area", "SELECT round(sum((xmax - xmin) * (ymax - ymin)), 6) AS area_a, round(sum((xmax - xmin) * (ymax - ymin)) + 0.5, 6) AS area_b, true AS same FROM zone")
def _(t):
    z = t("zone").select(((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("s"))
    other = z.union(z.agg(F.lit(0.5)))
    return zo.checksum_area(z, other, "s").select(*r6("area_a", "area_b"), "same")


_CONF = """WITH c AS (SELECT ref, cls AS prod, count(*) AS n FROM px GROUP BY ref, cls), k AS (SELECT DISTINCT ref AS cls FROM c UNION SELECT DISTINCT prod FROM c),
m AS (SELECT r.ref, k.cls AS prod, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT ref FROM c) r CROSS JOIN k LEFT JOIN c ON c.ref = r.ref AND c.prod = k.cls),
i AS (SELECT a.cls, a.rn AS row_n, a.tp, b.cn AS col_n FROM (SELECT ref AS cls, sum(n)::BIGINT AS rn, (sum(n) FILTER (ref = prod))::BIGINT AS tp FROM m GROUP BY ref) a JOIN (SELECT prod AS cls, sum(n)::BIGINT AS cn FROM m GROUP BY prod) b USING (cls)),
q AS (SELECT *, coalesce(tp / nullif(col_n, 0)::DOUBLE, 0) AS p, coalesce(tp / nullif(row_n, 0)::DOUBLE, 0) AS rc, coalesce(tp / nullif(row_n + col_n - tp, 0)::DOUBLE, 0) AS perf FROM i)"""


@query("ag_confusion_matrix", f"{_CONF} SELECT ref, prod, n FROM m")
def _(t):
    return qu.confusion_matrix(t("px"), "ref", "cls")


@query("ag_class_indicators", f"{_CONF} SELECT cls, round(p, 6) AS precision, round(rc, 6) AS recall, round(coalesce(2 * p * rc / nullif(p + rc, 0), 0), 6) AS f, round(perf, 6) AS performance, round(coalesce((col_n - tp) / nullif((SELECT sum(n) FROM m) - row_n, 0)::DOUBLE, 1), 6) AS fp_rate, round(coalesce((row_n - tp) / nullif(row_n, 0)::DOUBLE, 1), 6) AS fn_rate, round(coalesce(col_n / nullif(row_n, 0)::DOUBLE, 0), 6) AS quantity_rate FROM q")
def _(t):
    names = ("precision", "recall", "f", "performance", "fp_rate", "fn_rate", "quantity_rate")
    return qu.class_indicators(qu.confusion_matrix(t("px"), "ref", "cls")).select("cls", *r6(*names))


_OVERALL = "round(sum(tp) / sum(row_n)::DOUBLE, 6) AS accuracy, round(sum(coalesce(2 * p * rc / nullif(p + rc, 0), 0) * row_n) / sum(row_n), 6) AS f, round(sum(perf * (row_n + col_n - tp)) / nullif(sum(row_n + col_n - tp), 0), 6) AS performance, round((sum(tp) / sum(row_n)::DOUBLE - sum(row_n * col_n) / (sum(row_n)::DOUBLE * sum(row_n))) / (1 - sum(row_n * col_n) / (sum(row_n)::DOUBLE * sum(row_n))), 6) AS kappa"


@query("ag_overall_indicators", f"{_CONF} SELECT {_OVERALL} FROM q")
def _(t):
    return qu.overall_indicators(qu.confusion_matrix(t("px"), "ref", "cls")).select(*r6("accuracy", "f", "performance", "kappa"))


@query("ag_dominance", f"WITH m AS (SELECT fid, cls, count(*) AS k FROM zone JOIN px ON {_IN} GROUP BY fid, cls) SELECT round(avg(s), 6) AS dominance FROM (SELECT max(k) / sum(k)::DOUBLE AS s FROM m GROUP BY fid)")
def _(t):
    return zo.dominance(t("zone"), t("px"), "cls").select(*r6("dominance"))


@query("ag_nodata_tile_filter", "SELECT c // 10 AS tx, r // 10 AS ty, count(*) AS n, count(*) FILTER (cls = 100) AS n_nodata FROM px GROUP BY 1, 2 HAVING 100.0 * count(*) FILTER (cls = 100) < 20 * count(*)")
def _(t):
    return zo.nodata_tile_filter(t("px"), "cls", 10, 100, 20)


@query("ag_evolution_summary", "SELECT round(min(z), 6) AS min, round(max(z), 6) AS max, round(avg(z), 6) AS mean, round(stddev_pop(z), 6) AS std FROM pt")
def _(t):
    return zo.band_statistics(t("pt").withColumn("z", F.col("z").cast("double")), ["z"]).select(*r6("min", "max", "mean", "std"))


@query("ag_region_labels", "SELECT r, CAST(round_even(avg(cls / 100.0), 0) AS INTEGER) AS label FROM px GROUP BY r HAVING round_even(avg(cls / 100.0), 0) IN (1, 3)")
def _(t):
    return zo.region_labels(t("px").withColumn("v", F.col("cls") / 100.0), "r", "v", [0, 1, 3])


@query("ag_scalar_queries", "SELECT max(hauteur) AS tallest, count(*) AS n FROM bld WHERE nature LIKE 'STANDARD%'")
def _(t):
    return t("bld").where("nature LIKE 'STANDARD%'").agg(F.max("hauteur").alias("tallest"), F.count("*").alias("n"))


@query("ag_rare_classes", "WITH k AS (SELECT cls * 1000 + CAST(red AS INTEGER) AS k, count(*) AS n FROM px GROUP BY 1) SELECT k, n FROM k WHERE n < (SELECT avg(n) FROM k) * 0.6")
def _(t):
    return zo.rare_classes(t("px").withColumn("k", F.col("cls") * 1000 + F.col("red").cast("int")), "k", 60)


# --- windows, rules, sets --------------------------------------------------------------------------------------------


@query("wn_distinct_on", "SELECT nature, fid FROM bld QUALIFY row_number() OVER (PARTITION BY nature ORDER BY hauteur DESC, fid) = 1")
def _(t):
    return tb.distinct_on(t("bld"), ["nature"], [F.desc("hauteur"), "fid"]).select("nature", "fid")


@query("wn_top2_by_area", "SELECT nature, fid, CAST(row_number() OVER (PARTITION BY nature ORDER BY (xmax - xmin) * (ymax - ymin) DESC, fid) AS INTEGER) AS rank FROM bld QUALIFY rank <= 2")
def _(t):
    return tb.largest(t("bld").withColumn("s", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))), "nature", "s", 2, "fid").select("nature", "fid", "rank")


@query("wn_ordered_updates", "WITH a AS (SELECT pid, CASE WHEN red > 100 THEN 'x' ELSE 'none' END AS s, nir FROM px), b AS (SELECT pid, nir, CASE WHEN s = 'none' AND nir > 50 THEN 'y' ELSE s END AS s FROM a) SELECT pid, CASE WHEN s = 'y' AND nir > 200 THEN 'z' ELSE s END AS s FROM b")
def _(t):
    return tb.ordered_updates(t("px").withColumn("s", F.lit("none")), "s", [("red > 100", "x"), ("s = 'none' AND nir > 50", "y"), ("s = 'y' AND nir > 200", "z")]).select("pid", "s")


@query("wn_correct_percent_rounding", """WITH p AS (SELECT pid, CAST(red AS INTEGER) % 50 AS a, CAST(green AS INTEGER) % 30 AS b, 101 - CAST(red AS INTEGER) % 50 - CAST(green AS INTEGER) % 30 - pid % 2 AS c FROM px)
SELECT pid, CASE WHEN a + b + c = 101 AND a = greatest(a, b, c) THEN a - 1 ELSE a END AS a, CASE WHEN a + b + c = 101 AND b = greatest(a, b, c) AND a <> greatest(a, b, c) THEN b - 1 ELSE b END AS b,
  CASE WHEN a + b + c = 101 AND c = greatest(a, b, c) AND a <> c AND b <> c THEN c - 1 ELSE c END AS c, CASE WHEN a + b + c = 101 THEN 0 ELSE 100 - a - b - c END AS rest FROM p""")
def _(t):
    a, b = F.col("red").cast("int") % 50, F.col("green").cast("int") % 30
    p = t("px").select("pid", a.alias("a"), b.alias("b"), (101 - a - b - F.col("pid") % 2).alias("c"))
    return tb.correct_percent_rounding(p, ["a", "b", "c"], "rest").select("pid", "a", "b", "c", "rest")


@query("wn_minmax_scale", "SELECT event_id, round((value - min(value) OVER ()) / nullif(max(value) OVER () - min(value) OVER (), 0), 6) AS n_value FROM events")
def _(t):
    return tb.minmax_scale(t("events").select("event_id", "value"), ["value"]).select("event_id", *r6("n_value"))


@query("wn_set_neighbour_label", """WITH j AS (SELECT a.fid, max(b.zoning) AS z FROM zone_ov a JOIN zone_ov b ON a.fid <> b.fid AND a.xmin - 0.001 < b.xmax AND b.xmin < a.xmax + 0.001 AND a.ymin - 0.001 < b.ymax AND b.ymin < a.ymax + 0.001 GROUP BY a.fid)
SELECT o.fid, CASE WHEN zoning IN (1, 2, 3) THEN coalesce(z, zoning) ELSE zoning END AS zoning FROM zone_ov o LEFT JOIN j USING (fid)""")
def _(t):
    z = t("zone_ov")
    best = jn.box_join(z, z, CELL, pad=1e-3).where("a_fid <> b_fid").groupBy(F.col("a_fid").alias("fid")).agg(F.max("b_zoning").alias("z"))
    return z.join(best, "fid", "left").select("fid", F.when(F.col("zoning").isin(1, 2, 3), F.coalesce("z", "zoning")).otherwise(F.col("zoning")).alias("zoning"))


@query("set_merge_layers", "SELECT 'zone' AS layer, fid, name, NULL AS zoning FROM zone UNION ALL SELECT 'other', fid, NULL, zoning FROM zone_ov")
def _(t):
    return tb.merge_layers({"zone": t("zone").select("fid", "name"), "other": t("zone_ov").select("fid", "zoning")}, "layer").select("layer", "fid", "name", "zoning")


@query("set_union_distinct", "SELECT cls AS k FROM px UNION SELECT ref FROM px")
def _(t):
    return tb.union_distinct(t("px").select(F.col("cls").alias("k")), t("px").select("ref"))


@query("set_distinct_rows", "SELECT DISTINCT cls, ref FROM px")
def _(t):
    return t("px").select("cls", "ref").dropDuplicates()


@query("set_multi_ring", f"WITH d AS (SELECT fid, min({_SEG_D}) AS d FROM pt CROSS JOIN coast GROUP BY fid) SELECT fid, CASE WHEN greatest(1, ceil(d / 2)) <= 4 THEN CAST(greatest(1, ceil(d / 2)) AS INTEGER) END AS ring FROM d")
def _(t):
    d = jn.nearest_segment(t("pt").select("fid", "x", "y"), t("coast"), CELL)
    return d.select("fid", tb.ring_index(F.col("distance"), 2, 4).alias("ring"))


@query("set_delete_rows", "SELECT fid FROM bld WHERE NOT (hauteur < 10 OR nature LIKE 'SMALL%')")
def _(t):
    return tb.delete_rows(t("bld"), "hauteur < 10 OR nature LIKE 'SMALL%'").select("fid")


# --- composed indicators ---------------------------------------------------------------------------------------------

_CLIMATE = """SELECT event_id AS id, CAST(event_id * 7 % 60 AS DOUBLE) AS hre, CAST(event_id * 13 % 1500 AS DOUBLE) AS are, CAST(event_id * 3 % 80 AS DOUBLE) AS bur, CAST(event_id * 5 % 45 AS DOUBLE) AS ror,
  CAST(event_id * 11 % 40 AS DOUBLE) AS bsr, CAST(event_id * 17 % 30 AS DOUBLE) AS war, CAST(event_id * 19 % 70 AS DOUBLE) AS ver, CAST(event_id * 23 % 100 AS DOUBLE) AS vhr FROM events"""


def _climate(t) -> DataFrame:
    e = F.col("event_id")
    spec = {"hre": (7, 60), "are": (13, 1500), "bur": (3, 80), "ror": (5, 45), "bsr": (11, 40), "war": (17, 30), "ver": (19, 70), "vhr": (23, 100)}
    return t("events").select(e.alias("id"), *[(e * a % b).cast("double").alias(n) for n, (a, b) in spec.items()])


@query("dm_lcz_operational", f"""WITH e AS ({_CLIMATE}), g AS (SELECT *, bur > 40 AND bur + ror > 70 AS compact, CASE WHEN bur > 10 THEN 'urban' WHEN bur + ror + bsr + war + ver <= 50 THEN 'low_ocs' ELSE 'natural' END AS g FROM e),
l AS (SELECT id, CASE WHEN g = 'low_ocs' THEN g WHEN g = 'urban' THEN CASE WHEN bur > 60 AND bsr > ror + war + ver THEN '7' WHEN hre <= 21 AND bur + ror > 40 AND are > 700 THEN '8' WHEN bur <= 20 AND hre <= 9 THEN '9'
  WHEN hre <= 9 THEN CASE WHEN compact THEN '3' ELSE '6' END WHEN hre <= 30 THEN CASE WHEN compact THEN '2' ELSE '5' END ELSE CASE WHEN compact THEN '1' ELSE '4' END END
  WHEN ver >= ror AND ver >= bsr AND ver >= war THEN CASE WHEN vhr > 50 THEN 'A' WHEN vhr > 25 THEN 'B' WHEN vhr > 10 THEN 'C' ELSE 'D' END WHEN ror >= bsr AND ror >= war AND ror >= ver THEN 'E' WHEN bsr >= ror AND bsr >= war AND bsr >= ver THEN 'F' ELSE 'G' END AS lcz FROM g)
SELECT id, lcz, CASE WHEN lcz BETWEEN '1' AND '9' THEN CAST(ascii(lcz) - 48 AS INTEGER) WHEN lcz BETWEEN 'A' AND 'G' AND len(lcz) = 1 THEN CAST(ascii(lcz) - 54 AS INTEGER) END AS lcz_int FROM l""")
def _(t):
    return climate.operational_zones(_climate(t)).select("id", "lcz", "lcz_int")


_TREE = [{"hre": [-1, 10, [{"bur": [-1, 30, "LCZ 6_1"]}, {"bur": [60, 30, "LCZ 3_1"]}]]}, {"hre": [10, 10, "never"]}, {"hre": ["low", "high", [{"vhr": [50, 50, "LCZ A_1"]}, {"vhr": [20, 60, "LCZ B_1"]}]]}]


@query("dm_lcz_tree", f"""WITH e AS ({_CLIMATE}) SELECT id, CASE WHEN id % 4 = 0 THEN 'LCZ E_0' WHEN id % 4 = 1 THEN NULL
  WHEN hre > -1 AND hre <= 10 THEN CASE WHEN bur > -1 AND bur <= 30 THEN 'LCZ 6_1' WHEN bur <= 30 OR bur > 60 THEN 'LCZ 3_1' END WHEN hre > 10 AND hre <= 40 THEN CASE WHEN vhr = 50 THEN 'LCZ A_1' WHEN vhr > 20 AND vhr <= 60 THEN 'LCZ B_1' END END AS history FROM e""")
def _(t):
    df = _climate(t).withColumn("use", (F.col("id") % 4).cast("string"))
    return climate.classify_zones(df, {"2": _TREE, "3": _TREE}, "use", {"0": "LCZ E_0"}, {"low": 10, "high": 40}).select("id", "history")


_UCZ = "WITH u AS (SELECT event_id AS id, CAST(event_id * 7 % 101 AS DOUBLE) AS si, (event_id * 13 % 300) / 100.0::DOUBLE AS ra, CAST(event_id % 8 + 1 AS BIGINT) AS rug FROM events)"


def _ucz(t) -> DataFrame:
    e = F.col("event_id")
    return t("events").select(e.alias("id"), (e * 7 % 101).cast("double").alias("si"), ((e * 13 % 300) / 100.0).alias("ra"), (e % 8 + 1).alias("rug"))


_FIRST = """WHEN si < 10 AND ra >= 0.05{7} THEN 7 WHEN si < 40 AND ra >= 0.1 AND ra < 0.5{6} THEN 6 WHEN si >= 35 AND si < 65 AND ra >= 0.2 AND ra < 0.6{5} THEN 5 WHEN si >= 70 AND si < 95 AND ra >= 0.05 AND ra < 0.2{4} THEN 4
  WHEN si >= 70 AND si < 85 AND ra >= 0.5 AND ra < 1.5{3} THEN 3 WHEN si >= 85 AND ra >= 1 AND ra < 2.5{2} THEN 2 WHEN si >= 90 AND ra >= 2{1} THEN 1"""
_SECOND = """WHEN si < 15 AND ra < 0.2 THEN 7 WHEN si >= 15 AND si < 30 AND ra < 0.6 THEN 6 WHEN si >= 30 AND si < 60 AND ra < 0.6 THEN 5 WHEN si >= 60 AND ra < 0.2 THEN 4
  WHEN si >= 60 AND si < 75 AND ra >= 0.2 AND ra < 2 THEN 3 WHEN si >= 75 AND ra >= 0.6 THEN 2 WHEN si >= 80 AND ra >= 1.5 THEN 1"""
_PLAIN = _FIRST.format(*[""] * 8)
_ROUGH = _FIRST.format("", " AND rug = 8", " AND rug = 7", " AND rug = 7", " AND rug = 5", " AND rug = 6", " AND rug = 5", " AND rug = 4")
_HIER = "CASE WHEN si >= 10 AND si < 35 THEN 6 WHEN si >= 35 AND si < 65 THEN 5 WHEN si >= 65 THEN CASE WHEN ra >= 0.5 AND ra < 1.5 THEN 3 WHEN ra >= 1.5 AND ra < 2.5 THEN 2 WHEN ra >= 2.5 THEN 1 ELSE 4 END ELSE 7 END"
for _n, _m, _r, _sql in (
    ("combination", "combination", False, f"{_UCZ} SELECT id, CASE {_PLAIN} {_SECOND} ELSE 0 END AS ucz FROM u"), ("combination_roughness", "combination", True, f"{_UCZ} SELECT id, CASE {_ROUGH} {_SECOND} ELSE 0 END AS ucz FROM u"),
    ("combination_disjoint", "combination_disjoint", False, f"{_UCZ} SELECT id, CASE {_SECOND} ELSE 0 END AS ucz FROM u"),
    ("hierarchy", "hierarchy", False, f"{_UCZ} SELECT id, {_HIER} AS ucz FROM u"),
    ("hierarchy_roughness", "hierarchy", True, f"{_UCZ}, h AS (SELECT id, rug, {_HIER} AS z FROM u), g AS (SELECT id, rug, CASE WHEN z = 6 AND rug = 6 THEN 5 ELSE z END AS z FROM h) SELECT id, CASE WHEN z = 5 AND rug = 5 THEN 6 ELSE z END AS ucz FROM g"),
):
    query(f"dm_ucz_{_n}", _sql)(lambda t, m=_m, r=_r: climate.urban_zones(_ucz(t), m, r).select("id", "ucz"))


@query("dm_fractions", f"SELECT zone.fid, round(coalesce(b, 0), 6) AS built FROM zone LEFT JOIN (SELECT fid, 100.0 * count(*) FILTER (cls IN (100, 200)) / count(*) AS b FROM zone JOIN px ON {_IN} GROUP BY fid) USING (fid)")
def _(t):
    return zo.zonal_shares(t("zone"), t("px"), "cls", {100: "built", 200: "built"}).select("fid", *r6("built"))


@query("dm_roughness_height", f"WITH p AS (SELECT a.fid, avg(b.hauteur) AS h, avg({_AREA}) AS s FROM zone a JOIN bld b ON {_MEET} GROUP BY a.fid) SELECT fid, round(coalesce(h, 0), 6) AS mean_h, round(coalesce(s, 0), 6) AS mean_a FROM zone LEFT JOIN p USING (fid)")
def _(t):
    p = jn.intersection_overlay(t("zone"), t("bld"), CELL).groupBy(F.col("a_fid").alias("fid")).agg(F.avg("b_hauteur").alias("mean_h"), F.avg("area").alias("mean_a"))
    return jn.fill_missing(t("zone").select("fid"), p, "fid", {"mean_h": 0.0, "mean_a": 0.0}).select("fid", *r6("mean_h", "mean_a"))


@query("dm_terrain_roughness_length", """WITH p AS (SELECT fid, hauteur AS h, hauteur * 0.3 AS zd, (fid % 5) / 10.0::DOUBLE AS far FROM bld), z AS (SELECT fid, CASE WHEN far = 0 THEN 0.0 ELSE (h - zd) * exp(-sqrt(0.4 / far)) END AS z0 FROM p)
SELECT fid, round(z0, 6) AS z0, 1 + (z0 >= 0.0025)::INT + (z0 >= 0.0175)::INT + (z0 >= 0.065)::INT + (z0 >= 0.175)::INT + (z0 >= 0.375)::INT + (z0 >= 0.75)::INT + (z0 >= 1.5)::INT AS cls FROM z""")
def _(t):
    z = t("bld").select("fid", climate.roughness_length(F.col("hauteur"), F.col("hauteur") * 0.3, (F.col("fid") % 5) / 10.0).alias("z0"))
    return z.select("fid", *r6("z0"), climate.roughness_class(F.col("z0")).alias("cls"))


def _strokes(z: DataFrame) -> list[DataFrame]:
    """Five lines from south to north and five from west to east in each zone, as boxes without width."""
    k = z.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("id", F.col("fid") * 10 + F.col("k"))
    x = F.col("xmin") + 2 + 4 * F.col("k")
    y = F.col("ymin") + (F.col("ymax") - F.col("ymin")) * (2 * F.col("k") + 1) / 10
    return [k.select(F.col("id").alias("fid"), x.alias("xmin"), "ymin", x.alias("xmax"), "ymax"), k.select(F.col("id").alias("fid"), "xmin", y.alias("ymin"), "xmax", y.alias("ymax"))]


@query("dm_terrain_roughness", f"""WITH p AS (SELECT a.fid, {_AREA} AS area, b.hauteur AS h FROM zone a JOIN bld b ON {_MEET}), b1 AS (SELECT fid, sum(area * h * h) / sum(area * h) AS h, sum(area) AS s FROM p GROUP BY fid),
l1 AS (SELECT z.fid, k, max(hauteur) AS h FROM zone z CROSS JOIN range(0, 5) r(k) JOIN bld b ON b.xmin <= z.xmin + 2 + 4 * k AND b.xmax >= z.xmin + 2 + 4 * k AND b.ymin <= z.ymax AND b.ymax >= z.ymin GROUP BY z.fid, k),
l2 AS (SELECT z.fid, k, max(hauteur) AS h FROM zone z CROSS JOIN range(0, 5) r(k) JOIN bld b ON b.ymin <= z.ymin + (z.ymax - z.ymin) * (2 * k + 1) / 10 AND b.ymax >= z.ymin + (z.ymax - z.ymin) * (2 * k + 1) / 10 AND b.xmin <= z.xmax AND b.xmax >= z.xmin GROUP BY z.fid, k),
f1 AS (SELECT fid, sum(h * 4) AS f FROM l1 GROUP BY fid), f2 AS (SELECT fid, sum(h * 4) AS f FROM l2 GROUP BY fid),
q AS (SELECT z.fid, coalesce(b1.h, 0) AS h, coalesce(s / w, 0) AS par, coalesce(f1.f / w, 0) AS fa, coalesce(f2.f / w, 0) AS fb FROM (SELECT fid, (xmax - xmin) * (ymax - ymin) AS w FROM zone) z LEFT JOIN b1 USING (fid) LEFT JOIN f1 USING (fid) LEFT JOIN f2 USING (fid)),
e AS (SELECT *, h * pow(par, 0.6) AS zd FROM q), g AS (SELECT *, (CASE WHEN fa = 0 THEN 0 ELSE (h - zd) * exp(-sqrt(0.4 / fa)) END + CASE WHEN fb = 0 THEN 0 ELSE (h - zd) * exp(-sqrt(0.4 / fb)) END) / 2 AS z0 FROM e)
SELECT fid, round(h, 6) AS h, round(par, 6) AS par, round(zd, 6) AS zd, round((fa + fb) / 2, 6) AS far, round(z0, 6) AS z0, CASE WHEN z0 < 0.0025 THEN 1 WHEN z0 < 0.0175 THEN 2 WHEN z0 < 0.065 THEN 3 WHEN z0 < 0.175 THEN 4 WHEN z0 < 0.375 THEN 5 WHEN z0 < 0.75 THEN 6 WHEN z0 < 1.5 THEN 7 ELSE 8 END AS cls FROM g""")
def _(t):
    out = climate.terrain_roughness(t("zone"), t("bld"), _strokes(t("zone")), CELL, 4.0)
    return out.select("fid", *r6("h", "par", "zd", "far", "z0"), "cls")


_POP = f"""WITH p AS (SELECT a.fid AS src, b.fid AS fid, a.xmax - a.xmin AS pop, {_AREA} * b.hauteur / 3 AS s FROM zone_ov a JOIN bld b ON {_MEET}), w AS (SELECT src, greatest(sum(s), 1e-6) AS w FROM p GROUP BY src),
q AS (SELECT fid, sum(pop * s / w) AS population FROM p JOIN w USING (src) GROUP BY fid)"""


def _population(t) -> DataFrame:
    squares = t("zone_ov").withColumn("pop", F.col("xmax") - F.col("xmin"))
    return risk.population_by_building(squares, t("bld"), "pop", CELL)


@query("dm_population_by_building", f"{_POP} SELECT fid, round(population, 6) AS population FROM q")
def _(t):
    return _population(t).select("fid", *r6("population"))


@query("dm_population_by_zone", f"{_POP}, b AS (SELECT * FROM bld JOIN q USING (fid)) SELECT a.fid, round(sum(population * {_AREA} / ((b.xmax - b.xmin) * (b.ymax - b.ymin))), 5) AS population FROM zone a JOIN b ON {_MEET} GROUP BY a.fid")
def _(t):
    return risk.population_by_zone(t("zone"), t("bld").join(_population(t), "fid"), "population", CELL).select("fid", F.round("population", 5).alias("population"))


@query("dm_vulnerability", """WITH s AS (SELECT n_nationkey AS fid, CAST(n_nationkey * 7 % 11 AS DOUBLE) AS pop, CAST(n_nationkey * 5 % 13 AS DOUBLE) AS old, CAST(n_nationkey * 3 % 7 AS DOUBLE) AS poor FROM nation),
n AS (SELECT fid, pop / max(pop) OVER () AS a, old / max(old) OVER () AS b, poor / max(poor) OVER () AS c FROM s),
i AS (SELECT fid, a AS st, (a + b - min(a + b) OVER ()) / (max(a + b) OVER () - min(a + b) OVER ()) AS he, (b + c - min(b + c) OVER ()) / (max(b + c) OVER () - min(b + c) OVER ()) AS so FROM n)
SELECT fid, round(st, 6) AS i_stakes, round(he, 6) AS i_health, round(so, 6) AS i_social, round((he + so - min(he + so) OVER ()) / (max(he + so) OVER () - min(he + so) OVER ()), 6) AS i_overall FROM i""")
def _(t):
    k = F.col("n_nationkey")
    s = t("nation").select(k.alias("fid"), (k * 7 % 11).cast("double").alias("pop"), (k * 5 % 13).cast("double").alias("old"), (k * 3 % 7).cast("double").alias("poor"))
    return risk.vulnerability(s, ["pop"], ["pop", "old"], ["old", "poor"]).select("fid", *r6("i_stakes", "i_health", "i_social", "i_overall"))


@query("dm_land_cover_change", f"""WITH s AS (SELECT fid, 100.0 * count(*) FILTER (ref = 100) / count(*) AS a, 100.0 * count(*) FILTER (cls = 100) / count(*) AS b, 1.0 * count(*) FILTER (ref = 100) AS sa, 1.0 * count(*) FILTER (cls = 100) AS sb FROM zone JOIN px ON {_IN} GROUP BY fid)
SELECT zone.fid, round(coalesce(b - a, 0), 6) AS rate, CASE WHEN b - a <= -2 AND sb - sa <= -3 THEN 'negative' WHEN b - a >= 2 AND sb - sa >= 3 THEN 'positive' ELSE 'none' END AS flag FROM zone LEFT JOIN s USING (fid)""")
def _(t):
    z, px = t("zone").select("fid", *jn.BOX), t("px")
    a = zo.zonal_shares(z, px, "ref", {100: "a"}, areas=True).select("fid", "a", "S_a")
    b = zo.zonal_shares(z, px, "cls", {100: "b"}, areas=True).select("fid", "b", "S_b")
    return a.join(b, "fid").select("fid", F.round(F.col("b") - F.col("a"), 6).alias("rate"), risk.change_flags(F.col("a"), F.col("b"), F.col("S_a"), F.col("S_b"), 2, 3).alias("flag"))


_CELLQ = _CONF.replace("FROM px GROUP BY ref, cls", "FROM px GROUP BY ref, cls")


@query("dm_grid_quality", "SELECT c // 25 AS gx, r // 4 AS gy, round(count(*) FILTER (ref = cls) / count(*)::DOUBLE, 6) AS accuracy FROM px GROUP BY 1, 2")
def _(t):
    px = t("px").withColumn("r", F.floor(F.col("r") * 25 / 4))
    return qu.grid_quality(px, "ref", "cls", 25).select("gx", "gy", *r6("accuracy"))


@query("dm_surface_accuracy", "SELECT fid, round(z - red, 6) AS difference, abs(z - red) <= 500 AS within FROM pt JOIN px ON c = floor(pt.x) AND r = floor((SELECT h FROM grid_meta) - pt.y) WHERE red BETWEEN 10 AND 200")
def _(t):
    p = t("pt").join(F.broadcast(t("grid_meta").select("h"))).select("fid", F.col("z").cast("double").alias("z"), "x", (F.col("y") - F.col("h")).alias("y"))
    return qu.surface_accuracy(jn.sample_nearest(p, t("px"), "red", 0, 0), 500, 10, 200).select("fid", *r6("difference"), "within")


@query("dm_detected_tree_filter", f"WITH n AS (SELECT fid, avg({INDEX_SQL['ndvi']}) AS v FROM zone_ov JOIN px ON {_IN} GROUP BY fid) SELECT fid, round(v, 6) AS ndvi FROM n WHERE v > 0.02")
def _(t):
    px = t("px").withColumn("v", ix.index("ndvi", CHANNELS))
    return zo.zonal_stats(t("zone_ov"), px, "v", ("mean",)).where("mean > 0.02").select("fid", F.round("mean", 6).alias("ndvi"))


@query("flagship_zone_climate", f"""WITH v AS (SELECT fid, cls, red FROM zone JOIN px ON {_IN}), m AS (SELECT fid, cls, count(*) AS k FROM v GROUP BY fid, cls), t AS (SELECT fid, arg_min(cls, (-k, cls)) AS majority FROM m GROUP BY fid),
s AS (SELECT fid, avg(red) AS mean, 100.0 * count(*) FILTER (cls = 100) / count(*) AS built, 100.0 * count(*) FILTER (cls = 300) / count(*) AS water FROM v GROUP BY fid)
SELECT zone.fid, round(coalesce(mean, 0), 6) AS mean, coalesce(majority, 0) AS majority, round(coalesce(built, 0), 6) AS built, round(coalesce(water, 0), 6) AS water, CASE WHEN coalesce(built, 0) > 20 THEN 'urban' WHEN coalesce(water, 0) > 19 THEN 'water' ELSE 'natural' END AS zone_class FROM zone LEFT JOIN s USING (fid) LEFT JOIN t USING (fid)""")
def flagship(t):
    z, px = t("zone").select("fid", *jn.BOX), t("px")
    stats = zo.zonal_stats(z, px.withColumn("cls_", F.col("cls")), "red", ("mean",))
    major = zo.zonal_stats(z, px, "cls", ("majority",)).select("fid", "majority")
    shares = zo.zonal_shares(z, px, "cls", {100: "built", 300: "water"}).select("fid", "built", "water")
    out = jn.fill_missing(stats.join(major, "fid").join(shares, "fid"), z.select("fid").limit(0), "fid", {"mean": 0.0, "majority": 0})
    out = tb.ordered_updates(out.withColumn("zone_class", F.lit("natural")), "zone_class", [("built > 20", "urban"), ("zone_class = 'natural' AND water > 19", "water")])
    return out.select("fid", *r6("mean"), "majority", *r6("built", "water"), "zone_class")
