"""Edges joined up, regions, coverages and dissolves, against kernels that take all in one and against areas that must add up."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from arpent.functions import geometry as ge
from arpent.functions import shapes
from arpent.operators import outlines as ou
from arpent.operators.polygons import RINGS


def rings_of(row):
    return [np.array([(p["x"], p["y"]) for p in r]) for r in row["rings"]]


def area(rings):
    return abs(shapes.ring_area(rings[0])) - sum(abs(shapes.ring_area(r)) for r in rings[1:])


def length(rings):
    return sum(float(np.hypot(*np.diff(r, axis=0).T).sum()) for r in rings)


@pytest.mark.parametrize("tile", [1.5, 3.0, 100.0])
def test_lines_join_over_any_tiles(spark, tile):
    """Rings, an open line, a touch of two rings at a corner, and a stop."""
    square = lambda x, y, n: [(x, y, x + n, y), (x + n, y, x + n, y + n), (x + n, y + n, x, y + n), (x, y + n, x, y)]
    long_ = [(float(i), 20.0 + i % 2, float(i + 1), 20.0 + (i + 1) % 2) for i in range(17)]
    edges = [("a", *e, False) for e in [*square(0, 0, 2), *square(2, 2, 3), *long_]] + [("b", *e, e[3] == 20.0 + 9 % 2 and e[2] == 9.0) for e in long_] + [("c", *e, False) for e in square(0, 0, 9)]
    df = spark.createDataFrame([(g, *map(float, e), s) for g, *e, s in edges], "g string, x1 double, y1 double, x2 double, y2 double, stop boolean").repartition(5)
    rows = [(r["g"], r["closed"], len(r["points"]), [(p["x"], p["y"]) for p in r["points"]]) for r in ou.joined_up(df, tile).collect()]
    assert sorted(r[:3] for r in rows) == [("a", False, 18), ("a", True, 5), ("a", True, 5), ("b", False, 9), ("b", False, 10), ("c", True, 5)]
    assert [p for r in rows if r[0] == "a" and not r[1] for p in r[3]] == [(float(i), 20.0 + i % 2) for i in range(18)]
    for r in rows:
        if r[1]:
            assert r[3][0] == r[3][-1] and shapes.ring_area(np.array(r[3])) > 0


def raster(spark, seed, n=24, kinds=3):
    rng = np.random.default_rng(seed)
    from arpent.operators.regions import connected_components

    label = np.kron(rng.integers(0, kinds, (n // 2, n // 2)), np.ones((2, 2), int))
    label[rng.random((n, n)) < 0.15] = kinds
    df = spark.createDataFrame([(r * n + c, r, c, c + 0.5, n - r - 0.5, int(label[r, c])) for r in range(n) for c in range(n)], "pid long, r long, c long, x double, y double, k int")
    return connected_components(df, "k").select("r", "c", "x", "y", "region", "k")


@pytest.mark.parametrize("seed, tile", [(1, 5.0), (2, 7.0), (3, 256.0)])
def test_region_outlines(spark, seed, tile):
    px = raster(spark, seed)
    count = {r["region"]: r["count"] for r in px.groupBy("region").count().collect()}
    sides = {r["region"]: r["count"] for r in ou.pixel_borders(px, "region").groupBy("region").count().collect()}
    seen = {}
    for row in ou.region_outlines(px, "region", tile=tile).collect():
        assert row["region"] not in seen  # 4-connected regions are one polygon each
        seen[row["region"]] = True
        assert abs(area(rings_of(row)) - count[row["region"]]) < 1e-9 and abs(row["area"] - count[row["region"]]) < 1e-9
        assert abs(length(rings_of(row)) - sides[row["region"]]) < 1e-9
    assert seen.keys() == count.keys()


def test_simplified_coverage_has_no_gap_or_overlap(spark):
    px = raster(spark, 5, 40)
    same = ou.simplify_coverage(ou.pixel_borders(px, "region"), 0.0, 9.0).agg(F.sum("area")).first()[0]
    assert abs(same - 1600) < 1e-9
    made = ou.simplify_coverage(ou.pixel_borders(px, "region"), 0.8, 9.0)
    rows = made.collect()
    rings = [rings_of(r) for r in rows]
    # each point of the plane inside is in one region, and the outer frame keeps its corners but for what is cut there
    rng = np.random.default_rng(1)
    cover = [sum(shapes.within(r, *p) for r in rings) for p in rng.uniform(2, 38, (400, 2))]
    assert cover == [1] * 400
    before = px.select("region").distinct().count()
    assert sum(len(r) for g in rings for r in g) < sum(len(r) for row in ou.region_outlines(px, "region").collect() for r in rings_of(row))
    assert len({r["region"] for r in rows}) <= before


def test_polygon_coverage_and_source(spark):
    px = raster(spark, 6)
    whole = ou.region_outlines(px, "region").withColumnRenamed("region", "fid").select("fid", "rings")
    full = whole.select("fid", ge.area(F.col("rings")).alias("a")).agg(F.sum("a")).first()[0]
    assert abs(full - 576) < 1e-9


@pytest.mark.parametrize("size", [2.3, 4.0, 50.0])
def test_dissolve_is_seamless(spark, size):
    """Random boxes, bow-free polygons and a frame with a hole: area and outline of the whole union, cell by cell or at once."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(3):
        polys = []
        for _ in range(12):
            x, y, w, h = *rng.uniform(0, 10, 2), *rng.uniform(0.5, 4, 2)
            turn = rng.uniform(0, np.pi)
            box = np.array([(0, 0), (w, 0), (w, h), (0, h), (0, 0)]) @ np.array([[np.cos(turn), np.sin(turn)], [-np.sin(turn), np.cos(turn)]]) + (x, y)
            polys.append([box] if k else [np.rint(box) * 2])
        if k == 2:
            ring = lambda a, b: np.array([(a, a), (b, a), (b, b), (a, b), (a, a)], float)
            polys.append([ring(20, 34), ring(22, 32)[::-1]])
            polys.append([ring(24, 28)])
        rows += [(k, [[(float(x), float(y)) for x, y in r] for r in p]) for p in polys]
    df = spark.createDataFrame(rows, f"k int, rings {RINGS}")
    got = ou.dissolve_whole(df, "k", size).collect()
    for k in range(3):
        polys = [[np.array(r) for r in p] for j, p in rows if j == k]
        want = shapes.union([q for p in polys for q in shapes.valid(p)])
        mine = [rings_of(r) for r in got if r["k"] == k]
        assert abs(sum(map(area, mine)) - sum(map(area, want))) < 1e-6
        assert abs(sum(map(length, mine)) - sum(map(length, want))) < 1e-5
        assert len(mine) == len(want)
