"""Edge cases of operators, by hand."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from arpent.functions import geometry as ge
from arpent.functions import indices as ix
from arpent.operators import focal as fo
from arpent.operators import joins as jn
from arpent.operators import learning as le
from arpent.operators import overlay as ov
from arpent.operators import regions as rg
from arpent.operators import tables as tb
from arpent.operators import zonal as zo
from arpent.plans import climate
from arpent.sources import layers as ly
from arpent.sources import tables as st


def polygon(*rings):
    return [[(float(x), float(y)) for x, y in r] for r in rings]


def test_polygon_measures(spark):
    square, hole = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
    rows = [(1, polygon(square)), (2, polygon(square, hole)), (3, polygon([(0, 0), (4, 0), (0, 4), (0, 0)]))]
    df = spark.createDataFrame(rows, "id int, p array<array<struct<x:double,y:double>>>")
    p = F.col("p")
    inside = ge.contains(p, F.lit(1.5), F.lit(1.5))
    got = df.select("id", ge.area(p), ge.perimeter(p), inside, F.size(ge.remove_small_rings(p, 2)), ge.centroid(F.element_at(p, 1))["x"]).orderBy("id").collect()
    assert [tuple(r)[1] for r in got] == [16, 15, 8]
    assert [r[3] for r in got] == [True, False, True] and [r[4] for r in got] == [1, 1, 1]
    assert got[1][2] == 20 and abs(got[2][5] - 4 / 3) < 1e-9


def test_missing_channel_fails_early():
    with pytest.raises(KeyError):
        ix.index("ndvi", {"nir": "nir"})


def test_zone_without_pixels_and_majority_tie(spark):
    px = spark.createDataFrame([(0.5, 0.5, 2.0), (1.5, 0.5, 1.0), (0.5, 1.5, 9.0)], "x double, y double, v double")
    zones = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 1.0), (2, 10.0, 10.0, 12.0, 12.0), (3, 0.0, 0.0, 1.0, 2.0)], "fid int, xmin double, ymin double, xmax double, ymax double")
    got = {r["fid"]: r for r in zo.zonal_stats(zones, px, "v", ("count", "min", "majority", "nodata"), nodata=9.0).collect()}
    assert (got[1]["count"], got[1]["majority"]) == (2, 1.0)
    assert (got[2]["count"], got[2]["min"], got[2]["majority"]) == (0, None, None)
    assert (got[3]["count"], got[3]["nodata"]) == (1, 1)


def test_difference_covers_and_splits(spark):
    assert ov.pieces_outside((0, 0, 4, 4), np.array([[1.0, 1.0, 2.0, 2.0]])) == [(0.0, 0.0, 4.0, 1.0), (0.0, 1.0, 1.0, 2.0), (2.0, 1.0, 4.0, 2.0), (0.0, 2.0, 4.0, 4.0)]
    assert ov.pieces_outside((0, 0, 1, 1), np.array([[-1.0, -1.0, 2.0, 2.0]])) == []


def test_components_of_a_long_chain(spark):
    n = 300
    nodes = spark.range(n).select(F.col("id").alias("node"))
    edges = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = rg.label_components(nodes, edges).agg(F.max("label"), F.count("*")).first()
    assert tuple(out) == (0, n)


def test_sieve_takes_the_largest_neighbour(spark):
    grid = [(r * 5 + c, r, c, 2 if (r, c) == (2, 2) else (1 if c < 3 else 3)) for r in range(5) for c in range(5)]
    out = rg.sieve(spark.createDataFrame(grid, "pid long, r long, c long, v int"), "v", 2)
    assert {r["v"] for r in out.where("pid = 12").collect()} == {1}


def test_tree_intervals(spark):
    tree = [{"a": [0, 10, [{"b": [5, 5, "equal"]}]]}, {"a": [0, 20, "late"]}, {"a": [50, 30, "wrapped"]}, {"a": ["unknown", 40, "zero"]}]
    df = spark.createDataFrame([(1, 5.0, 5.0), (2, 5.0, 6.0), (3, 15.0, 0.0), (4, 60.0, 0.0), (5, 35.0, 0.0), (6, 25.0, 0.0)], "id int, a double, b double")
    got = {r[0]: r[1] for r in df.select("id", climate.compile_tree(tree)).collect()}
    assert got == {1: "equal", 2: None, 3: "late", 4: "wrapped", 5: "zero", 6: "wrapped"}


def test_short_names_must_stay_distinct(spark):
    df = spark.createDataFrame([(1, 2)], "abcdefghij1 int, abcdefghij2 int")
    with pytest.raises(ValueError):
        tb.short_names(df.schema)


def test_natural_breaks_and_sample_size():
    starts, fit = le.fisher_jenks([1, 2, 3, 100, 101, 102, 200, 201], [1] * 8, 3)
    assert starts == [0, 3, 6] and fit > 0.999
    assert le.sample_size(10, 0.5, 0.05, 0.05) == 788


def test_scene_names(spark):
    df = spark.createDataFrame([("IMG_19981003T000000500_7",), ("IMG_bad_8",), ("x",)], "name string")
    d, t, f = ly.scene_dates(F.col("name"))
    got = [tuple(map(str, r)) for r in df.select(d, t, f).collect()]
    assert got == [("1998-10-03", "00:00:00", "7"), ("1900-01-01", "00:00:00", "8"), ("1900-01-01", "00:00:00", "x")]


def test_text_tables(spark, tmp_path):
    lines = spark.createDataFrame([(0, "#Reference labels (rows):100,200"), (1, "#Produced labels (columns):100,300"), (2, "5,1"), (3, "0,7")], "no int, value string")
    got = sorted(map(tuple, st.confusion_from_text(lines).collect()))
    assert got == [(100, 100, 5.0), (100, 300, 1.0), (200, 100, 0.0), (200, 300, 7.0)]
    c = st.centroids_from_text(spark.createDataFrame([(100, "101 1.5 2.5")], "macro int, value string"))
    assert sorted(map(tuple, c.collect())) == [(100, 101, 0, 1.5), (100, 101, 1, 2.5)]
    st.write_csv_table(spark.createDataFrame([(1, "a;b")], "id int, t string"), f"{tmp_path}/c", ";")
    assert [tuple(r) for r in st.read_csv_table(spark, f"{tmp_path}/c", "id int, t string", ";").collect()] == [(1, "a;b")]
    (tmp_path / "f.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","id":"7","properties":{"n":"x"},"geometry":{"type":"Point","coordinates":[1,2]}},{"type":"Feature","properties":{},"geometry":{"type":"Point","coordinates":[3,4]}}]}')
    assert [(r["fid"], r["geometry_type"]) for r in ly.read_features(spark, str(tmp_path / "f.json")).collect()] == [(7, "Point"), (1, "Point")]
    st.partition_by_attribute(spark.createDataFrame([(1, "u"), (2, "v")], "id int, k string"), "k", f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").where("k = 'u'").count() == 1


def test_box_pairs_come_once(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 100.0)], "fid int, xmin double, ymin double, xmax double, ymax double")
    assert jn.box_join(a, a, 7.0).count() == 1
    none = a.limit(0)
    assert jn.box_join(a, none, 7.0).count() == 0 and ov.difference_overlay(a, none, 7.0).count() == 1


def test_incomplete_tiles_keep_places(spark):
    grid = [(r, c, float(10 * r + c)) for r in range(6) for c in range(5) if (r, c) != (1, 2)]  # 5 = one column over a tile
    tiles = ly.pixels_to_tiles(spark.createDataFrame(grid, "r long, c long, v double"), "v", 4)
    assert {len(t["data"]) for t in tiles.collect()} == {16}
    back = ly.tiles_to_pixels(tiles.withColumn("scene", F.lit("a")), 4, absent=False).select("r", "c", "value")
    assert sorted(map(tuple, back.collect())) == grid


def test_shadows_and_horizons_reach_over_the_raster(spark):
    px = spark.createDataFrame([(r, c, 100.0 if (r, c) == (0, 19) else 0.0) for r in range(20) for c in range(20)], "r long, c long, h double")
    dark = lambda azimuth, elevation: {(x["r"], x["c"]) for x in fo.shadow_mask(px, "h", azimuth, elevation).where("shadow = 1").collect()}
    assert dark(90, 60) == {(0, c) for c in range(19)} and dark(0, 60) == {(r, 19) for r in range(1, 20)}
    assert dark(90, 85) == {(0, c) for c in range(11, 19)}  # 100 / tan(85 degrees) = 8.7 pixels
    assert (19, 0) in dark(45, 60)
    low = fo.sky_view_factor(px, "h", directions=4).where("r = 0 AND c = 0").first()["svf"]
    assert abs(low - (3 + 1 / (1 + (100 / 19) ** 2)) / 4) < 1e-9
