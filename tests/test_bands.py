"""Bands together: identities of resampling, unmixing of independent bands, clusters as by a run for each class."""

import math

import numpy as np

from arpent.operators import bands as bd


def test_lattice_of_the_same_pixels_changes_nothing(spark):
    px = spark.createDataFrame([(r, c, float(r * 7 + c * c)) for r in range(5) for c in range(6)], "r long, c long, v double")
    same = {(x["i"], x["j"]): x["value"] for x in bd.superimpose_bilinear(px, "v", 1.0).collect()}
    assert same == {(r, c): float(r * 7 + c * c) for r in range(5) for c in range(6)}
    for ratio in (0.37, 2.5):
        cells = [(x["i"], x["j"]) for x in bd.lattice(px, ratio).collect()]
        assert sorted(cells) == [(i, j) for i in range(99) for j in range(99) if (i + 0.5) / ratio < 5 and (j + 0.5) / ratio < 6]


def test_independent_bands_are_found_again(spark):
    rng = np.random.default_rng(3)
    s = np.column_stack([rng.uniform(-1, 1, 3000), rng.laplace(size=3000), np.sign(rng.standard_normal(3000)) + rng.normal(0, 0.05, 3000)])
    x = s @ rng.normal(size=(3, 3)) + 5
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    y = np.array([list(r)[3:] for r in bd.independent_components(df, ["a", "b", "c"], rounds=60).collect()])
    match = np.abs(np.corrcoef(s.T, y.T)[:3, 3:])
    assert (match.max(axis=1) > 0.98).all() and sorted(match.argmax(axis=1)) == [0, 1, 2]


def test_clusters_of_all_classes_equal_a_run_for_each(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 3)), *map(float, rng.normal(0, 1, 2) + rng.integers(0, 3) * 6)) for i in range(300)] + [(999, 7, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "pid long, k int, a double, b double")
    whole = {r["pid"]: r["cluster"] for r in bd.kmeans_by_class(df, "k", ["a", "b"], 3, 20).collect()}
    assert whole[999] == 0 and len(whole) == 301
    for k in range(3):
        own = [r for r in rows if r[1] == k]
        x = np.array([r[2:] for r in own])
        centres = x[:3]
        for _ in range(20):
            near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            centres = np.array([x[near == j].mean(axis=0) for j in range(3)])
        assert [whole[r[0]] for r in own] == near.tolist()


def test_sharpening_follows_the_sensor_model(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(50, 10, (400, 2))
    pan = x @ [0.3, 0.6] + 4 + rng.normal(0, 2, 400)
    df = spark.createDataFrame([(int(i), *map(float, r), float(p)) for i, (r, p) in enumerate(zip(x, pan, strict=True))], "pid long, a double, b double, pan double")
    got = np.array([(r["sharp_a"], r["sharp_b"]) for r in bd.bayes_sharpen(df, "pan", ["a", "b"], 0.5).orderBy("pid").collect()])
    c = np.cov(x.T, bias=True)
    design = np.column_stack([x, np.ones(400)])
    w = np.linalg.lstsq(design, pan, rcond=None)[0]
    v = float(((pan - design @ w) ** 2).mean())
    for z, seen, p in zip(got, x, pan, strict=True):
        best = np.linalg.solve(0.5 * np.linalg.inv(c) + 0.5 * np.outer(w[:2], w[:2]) / v, 0.5 * np.linalg.inv(c) @ seen + 0.5 * w[:2] * (p - w[2]) / v)
        assert math.isclose(z[0], best[0], abs_tol=1e-6) and math.isclose(z[1], best[1], abs_tol=1e-6)
