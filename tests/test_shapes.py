"""Polygon kernels against points drawn at random, and invariants of operators that SQL doesn't cover."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from arpent.functions import shapes as sh
from arpent.operators import segments as sg
from arpent.operators.lines import merge_connected_lines
from arpent.plans import urban


def star(rng, n):
    a, d = np.sort(rng.random(n)) * 2 * math.pi, 1 + 3 * rng.random(n)
    p = np.column_stack([d * np.cos(a), d * np.sin(a)]) + 2 * rng.random(2)
    return np.vstack([p, p[:1]])


@pytest.mark.parametrize("keep", [lambda x, y: x & y, lambda x, y: x & ~y, lambda x, y: x | y, lambda x, y: x ^ y])
def test_overlays_of_stars(keep):
    rng = np.random.default_rng(1)
    for _ in range(4):
        a, b = [star(rng, 12)], [star(rng, 15)]
        points = rng.random((600, 2)) * 12 - 5
        want = np.array([keep(np.bool_(sh.within(a, *p)), np.bool_(sh.within(b, *p))) for p in points])
        found = sh.combine(a, b, keep)
        assert abs(sum(sh.ring_area(r) for p in found for r in p) - sh.area_of(sh.trapezoids([a, b], keep)[0])) < 1e-6
        assert (np.array([any(sh.within(p, *q) for p in found) for q in points]) == want).mean() > 0.998


def test_buffer_of_a_polygon_with_a_hole():
    square = lambda x, y, w: np.array([(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)], float)
    (out,) = sh.buffer([square(0, 0, 10), square(4, 4, 2)[::-1]], 0.5)
    assert len(out) == 2 and abs(sh.ring_area(out[1]) + 1) < 1e-9
    (inner,) = sh.buffer([square(0, 0, 10), square(4, 4, 2)[::-1]], -0.5)
    assert abs(sh.ring_area(inner[0]) - 81) < 1e-9 and len(inner) == 2


def test_a_ring_of_lines_is_one_chain(spark):
    corners = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    rows = [(i, *p, *q) for i, (p, q) in enumerate(zip(corners[:-1], corners[1:], strict=True))] + [(9, 5.0, 5.0, 6.0, 5.0)]
    got = {r["chain"]: r for r in merge_connected_lines(spark.createDataFrame(rows, "seg long, x1 double, y1 double, x2 double, y2 double")).collect()}
    assert {k: r["segments"] for k, r in got.items()} == {0: 4, 9: 1} and len(got[0]["line"]) == 5 and got[0]["line"][0] == got[0]["line"][-1]


def test_merges_leave_no_small_region_with_a_neighbour(spark):
    regions = spark.createDataFrame([(i, 1.0 + i % 3, [i / 12, (i * 5 % 12) / 12]) for i in range(12)], "node long, size double, features array<double>")
    contacts = spark.createDataFrame([(i, i + 1, 1.0 + i % 2) for i in range(11) if i != 5], "a long, b long, length double")
    into = {r["node"]: r["into"] for r in sg.merge_similar(regions, contacts, 4.0, 4.0, alike=0.1).collect()}
    size = {g: sum(1.0 + n % 3 for n, h in into.items() if h == g) for g in set(into.values())}
    assert len(into) == 12 and all(s >= 4 for s in size.values()) and all((n < 6) == (g < 6) for n, g in into.items())


def test_superpixels_follow_colour(spark):
    rows = [(r * 12 + c, r, c, 0.0 if c < 5 else 1.0) for r in range(12) for c in range(12)]
    px = spark.createDataFrame(rows, "pid long, r long, c long, v double")
    out = sg.superpixels(px, ["v"], 6, 0.1, 4)
    assert out.count() == 144 and out.groupBy("superpixel").agg(F.count_distinct("v").alias("n")).agg(F.max("n")).first()[0] == 1


def test_surrogate_forest_follows_its_tree(spark):
    zones = spark.range(600).select("id", (F.col("id") % 60).cast("double").alias("h"), (F.col("id") * 7 % 101).cast("double").alias("b"))
    tree = [{"h": [-1, 30, [{"b": [-1, 50, "low"]}, {"b": [50, 101, "dense"]}]]}, {"h": [30, 60, "high"]}]
    out = urban.forest_zones(zones, tree, ["h", "b"], 800, 10)
    assert out.where("lcz = lcz_rf").count() >= 570


def test_only_regions_up_to_their_own_limit_start_a_merge(spark):
    """Two large regions stay apart however alike; a rural one under its limit joins a large one; classes follow the larger part."""
    regions = spark.createDataFrame([(1, 12.0, [0.0], 1, 1.0), (2, 12.0, [0.0], 1, 1.0), (3, 15.0, [0.1], 2, 0.8), (4, 40.0, [0.1], 2, 1.0), (5, 2.0, [0.9], 1, 1.0)], "node long, size double, features array<double>, cls int, share double")
    contacts = spark.createDataFrame([(1, 2, 5.0), (3, 4, 5.0), (4, 5, 1.0)], "a long, b long, length double")
    into = {r["node"]: r["into"] for r in sg.merge_similar(regions, contacts, 4.0, 10.0, 0.5, 10.0, 4, rural=20.0, urban=(1,)).collect()}
    assert into == {1: 1, 2: 2, 3: 3, 4: 3, 5: 3}
    free = {r["node"]: r["into"] for r in sg.merge_similar(regions.drop("cls", "share"), contacts, 4.0, 12.0, 0.5, 10.0, 4).collect()}
    assert free == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}
