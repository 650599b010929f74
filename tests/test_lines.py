"""Planar graphs, offsets, buffers and rings of lines, and the coast, against kernels on whole shapes or plain geometry."""

import numpy as np
import pytest

from arpent.functions import shapes
from arpent.operators import coast as co
from arpent.operators import noding as nd
from arpent.operators.polygons import RINGS

LINE = "array<struct<x:double,y:double>>"


def rings_of(row):
    return [np.array([(p["x"], p["y"]) for p in r]) for r in row["rings"]]


def area(rings):
    return abs(shapes.ring_area(rings[0])) - sum(abs(shapes.ring_area(r)) for r in rings[1:])


def plain(points):
    return [(float(x), float(y)) for x, y in points]


@pytest.mark.parametrize("seed", [1, 2])
def test_faces_of_straight_cuts(spark, seed):
    """Polygons cut by lines that cross them whole: the same areas as by half-planes, one after the other."""
    rng = np.random.default_rng(seed)
    polys = {k: [shapes.hull(rng.uniform(0, 10, (9, 2)) + (12 * k, 0))] for k in range(3)}
    polys[0].append(np.array([(4.5, 4.5), (4.5, 5.5), (5.5, 5.5), (5.5, 4.5), (4.5, 4.5)]))
    ends = [(rng.uniform(-1, 37), -5.0, rng.uniform(-1, 37), 15.0) for _ in range(7)] + [(-5.0, 5.3, 40.0, 4.1)]
    lines = spark.createDataFrame([(plain([(a, b), ((a + c) / 2, (b + d) / 2), (c, d)]),) for a, b, c, d in ends], f"line {LINE}")
    df = spark.createDataFrame([(k, [plain(r) for r in p]) for k, p in polys.items()], f"fid int, rings {RINGS}")
    got = nd.split_by_polylines(df, lines, 3.0).collect()
    for k, p in polys.items():
        parts = [p]
        for a, b, c, d in ends:
            u = np.array([c - a, d - b]) * 100
            o, n = np.array([a, b]), np.array([-u[1], u[0]])
            half = [np.array([o - u, o + u, o + u + n, o - u + n, o - u])]
            parts = [q for r in parts for f in (lambda x, y: x & y, lambda x, y: x & ~y) for q in shapes.combine(r, half, f)]
        mine = sorted(area(rings_of(r)) for r in got if r["fid"] == k)
        assert len(mine) == len(parts), (k, mine, sorted(map(area, parts)))
        assert np.allclose(mine, sorted(map(area, parts)), atol=1e-6)


def test_loose_ends_and_islands(spark):
    square = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]
    df = spark.createDataFrame([(1, square), (2, [[(x + 50, y) for x, y in square[0]]])], f"fid int, rings {RINGS}")
    tree = [plain([(-1, 5), (3, 5), (4, 6)]), plain([(3, 5), (4, 4)]), plain([(8, 8), (9, 8)])]
    island = plain([(5, 1), (7, 1), (7, 3), (5, 3), (5, 1)])
    corner = plain([(0, 8), (1, 8), (1, 9.5), (2, 10)])
    lines = spark.createDataFrame([(x,) for x in [*tree, island, corner]], f"line {LINE}")
    rows = nd.split_by_polylines(df, lines, 4.0).collect()
    assert sorted((r["fid"], round(area(rings_of(r)), 6), len(r["rings"])) for r in rows) == [(1, 2.25, 1), (1, 4.0, 1), (1, 93.75, 2), (2, 100.0, 1)]
    assert nd.split_by_polylines(df, lines.limit(0), 4.0).count() == 2


BENDS = [[(0, 0), (5, 0), (5, 4), (9, 4), (9, 0), (10, -3), (4, -3)], [(0, 0), (3, 3), (6, 0), (9, 3)], [(0, 0), (4, 0)], [(0, 0), (3, 0.3), (0.2, 0.5), (3, 1)]]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(k, plain(x)) for k, x in enumerate(BENDS)], f"lid int, line {LINE}")


@pytest.mark.parametrize("d", [0.7, -0.7, 1.6])
def test_offsets_keep_their_distance(lines, d):
    rows = {r["lid"]: np.array([(p["x"], p["y"]) for p in r["points"]]) for r in co.offset_curves(lines, d, 2.0).collect()}
    assert len(rows) >= 3
    for k, points in rows.items():
        a, b = np.array(BENDS[k], float)[:-1], np.array(BENDS[k], float)[1:]
        for p in points:
            t = np.clip(((p - a) * (b - a)).sum(axis=1) / ((b - a) ** 2).sum(axis=1), 0, 1)
            near = np.hypot(*(p - a - t[:, None] * (b - a)).T).min()
            assert near >= abs(d) * (1 - 1e-6) and near <= abs(d) * 1.2
    assert np.allclose(rows[2], [(0, d), (4, d)])


@pytest.mark.parametrize("d", [0.5, -0.5])
def test_side_buffers(lines, d):
    total = {}
    for r in co.side_buffer(lines, d, 3.0, quarter=8).collect():
        total[r["lid"]] = total.get(r["lid"], 0) + area(rings_of(r))
    for k in (0, 1, 2):
        p = np.array(BENDS[k], float)
        s = np.sign(d)
        pieces = []
        for i, (a, b) in enumerate(zip(p[:-1], p[1:])):
            n = np.array([-(b - a)[1], (b - a)[0]]) / np.hypot(*(b - a)) * d
            pieces.append(np.array([a, b, b + n, a + n, a]))
            if i + 2 < len(p):
                v = p[i + 2] - b
                m = np.array([-v[1], v[0]]) / np.hypot(*v) * d
                if s * ((b - a)[0] * v[1] - (b - a)[1] * v[0]) < 0:
                    t0, turn = np.arctan2(n[1], n[0]), np.arctan2((b - a)[0] * v[1] - (b - a)[1] * v[0], (b - a) @ v)
                    steps = int(max(1, np.ceil(abs(turn) / (np.pi / 16) - 1e-9)))
                    pieces.append(np.array([b, *[b + abs(d) * np.array([np.cos(t0 + turn * j / steps), np.sin(t0 + turn * j / steps)]) for j in range(steps + 1)], b]))
        assert abs(total[k] - sum(map(area, shapes.union([[q] for q in pieces])))) < 1e-6


def test_joint_buffers(spark):
    a, b = [(0, 0), (6, 0), (6, 4), (0, 4), (0, 0)], [(5, 2), (11, 2), (11, 9), (5, 9), (5, 2)]
    df = spark.createDataFrame([("u", [plain(a)]), ("u", [plain(b)])], f"g string, rings {RINGS}")
    whole = shapes.union([[np.array(a, float)], [np.array(b, float)]])
    for d in (0.8, -0.8):
        made = co.joint_buffer(df, d, 2.5, "g").collect()
        want = shapes.union([q for p in whole for q in shapes.buffer(p, d)])
        assert len(made) == len(want) and abs(sum(area(rings_of(r)) for r in made) - sum(map(area, want))) < 1e-6


def test_rings_of_a_bent_line(spark):
    p = BENDS[0]
    segs = spark.createDataFrame([(7, *map(float, (*a, *b))) for a, b in zip(p[:-1], p[1:])], "lid int, x1 double, y1 double, x2 double, y2 double")
    rows = co.ring_zones(segs, 0.9, 3, 3.0).collect()
    by = {k: [rings_of(r) for r in rows if r["ring"] == k] for k in (1, 2, 3)}
    line = np.array(p, float)
    for k in (1, 2, 3):
        want = sum(map(area, shapes.buffer([line], 0.9 * k, line=True))) - (sum(map(area, shapes.buffer([line], 0.9 * (k - 1), line=True))) if k > 1 else 0)
        assert abs(sum(map(area, by[k])) - want) < 1e-6
    rng = np.random.default_rng(1)
    assert max(sum(shapes.within(g, *q) for k in by for g in by[k]) for q in rng.uniform(-3, 12, (300, 2))) == 1


def test_coast_is_closed_and_cut(spark):
    """Sea below a bent shore, with a boat of two pixels and a pond inland: one line, from side to side of what is valid."""
    n = 24
    sea = {(r, c): int(r >= 12 + (c // 8 == 1) * 2) for r in range(n) for c in range(n)}
    sea[18, 10] = sea[18, 11] = 0
    sea[4, 4] = sea[4, 5] = 1
    px = spark.createDataFrame([(r * n + c, r, c, c + 0.5, n - r - 0.5, s, 1) for (r, c), s in sea.items()], "pid long, r long, c long, x double, y double, sea int, valid int")
    seeds = spark.createDataFrame([(20, 3), (0, 0)], "r long, c long")
    assert co.sea_regions(px, "sea", seeds).count() == sum(sea.values()) - 2
    rows = co.coastline(px, "sea", seeds, "valid", close=2.0, rim=2.0, tolerance=0.05, cell=6.0).collect()
    assert len(rows) == 1 and not rows[0]["closed"]
    x = [p["x"] for p in rows[0]["points"]]
    assert abs(min(x) - 2) < 1e-6 and abs(max(x) - 22) < 1e-6 and 20 <= rows[0]["length"] <= 24.1
    raw = co.coastline(px, "sea", seeds, "valid", close=0, rim=2.0, cell=6.0)
    assert sorted((r["closed"], r["length"]) for r in raw.collect()) == [(False, 24.0), (True, 6.0)]


def test_sides_and_distances(spark):
    segs = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 0.0), (2, 10.0, 0.0, 10.0, 10.0)], "seg int, x1 double, y1 double, x2 double, y2 double")
    pts = spark.createDataFrame([(1, 5.0, 2.0), (2, 5.0, -2.0), (3, 13.0, 5.0), (4, 200.0, 5.0), (5, -3.0, -4.0)], "fid int, x double, y double")
    got = {r["fid"]: (r["distance"], r["side"]) for r in co.side_and_distance(pts, segs, 2.0).collect()}
    assert got == {1: (2.0, 1), 2: (2.0, -1), 3: (3.0, -1), 4: (190.0, -1), 5: (5.0, -1)}
    assert co.side_and_distance(pts, segs.limit(0), 2.0).count() == 0
