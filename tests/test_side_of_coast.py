"""Sides and distances of points of a line in many cells, with lists of few segments, by brute force."""

from __future__ import annotations

import math

import pytest

from arpent.operators import coast as co


@pytest.mark.parametrize("few", [20_000, 0])
def test_points_meet_lists_of_segments(spark, monkeypatch, few):
    monkeypatch.setattr(co, "LIST", 2)
    monkeypatch.setattr(co, "FEW_LISTS", few)
    ends = [(5.2 * i, (i * 7) % 10 - 5.0, 5.2 * (i + 1), ((i + 1) * 7) % 10 - 5.0) for i in range(12)] + [(3.0, 3.0, 3.0, 3.0)]  # the last one is a point
    points = [(i, (i * 53 % 700) / 10, (i * 29 % 300) - 150.3) for i in range(80)] + [(3, 15.9, -120.9)]  # two rows of one key
    made = co.side_and_distance(spark.createDataFrame(points, "fid long, x double, y double"), spark.createDataFrame([(i, *e) for i, e in enumerate(ends)], "seg long, x1 double, y1 double, x2 double, y2 double"), 4.0)
    want = {}
    for fid, x, y in points:
        for seg, (x1, y1, x2, y2) in enumerate(ends):
            dx, dy = x2 - x1, y2 - y1
            t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
            at = (round(math.hypot(x - x1 - t * dx, y - y1 - t * dy), 9), seg, 1 if dx * (y - y1) - dy * (x - x1) > 0 else -1)
            want[fid] = min(want.get(fid, at), at)
    got = {r["fid"]: (r["distance"], r["side"]) for r in made.collect()}
    assert made.count() == len(want) and set(got) == set(want)
    assert all(abs(got[k][0] - d) < 2e-9 and got[k][1] == side for k, (d, _, side) in want.items())
