"""Horizons over the whole raster: against brute force over several segments both ways, and without making the raster anew for each direction."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arpent.operators import focal as fo


@pytest.mark.parametrize("rows, columns", [(3, 600), (600, 3)])
def test_horizons_over_segments(spark, rows, columns):
    h = np.floor(np.random.default_rng(rows).exponential(9.0, (rows, columns)))
    made = spark.sparkContext.accumulator(0)

    @F.udf(T.DoubleType())
    def counted(x):
        made.add(1)
        return x

    px = spark.createDataFrame([(r * columns + c, r - 2, c - 2, float(h[r, c])) for r in range(rows) for c in range(columns)], "pid long, r long, c long, z double").withColumn("z", counted("z"))
    got = {p["pid"]: p["svf"] for p in fo.sky_view_factor(px, "z", directions=4).collect()}
    assert made.value <= 2 * rows * columns  # once for the horizons, once for the rows themselves
    for r in range(rows):
        for c in range(columns):
            rises = [[(h[r, k] - h[r, c]) / abs(k - c) for k in ks] for ks in (range(c), range(c + 1, columns))] + [[(h[k, c] - h[r, c]) / abs(k - r) for k in ks] for ks in (range(r), range(r + 1, rows))]
            assert abs(got[r * columns + c] - np.mean([1 / (1 + max([0.0, *x]) ** 2) for x in rises])) < 1e-12
