"""Natural breaks for several numbers of classes share their bins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from arpent.operators import learning as le


def _events(spark):
    return spark.range(4000).select((F.col("id") % 2).alias("scene"), F.round((F.col("id") * 7919 % 4001) * (F.col("id") % 7 + 1) / 10.0, 2).alias("value"))


def test_bins_are_made_once_for_all_numbers_of_classes(spark, monkeypatch):
    calls, settle = [], le.settle
    monkeypatch.setattr(le, "settle", lambda df: calls.append(1) or settle(df))
    df = _events(spark)
    le.natural_breaks_threshold(df, "scene", "value", range(5, 6), 0.0).collect()
    once = len(calls)
    le.natural_breaks_threshold(df, "scene", "value", range(5, 9), 0.0).collect()
    assert len(calls) == 2 * once


def test_thresholds_are_those_of_each_number_of_classes(spark):
    df, want = _events(spark), {}
    for k in range(5, 9):
        centre, lower = le.threshold_of_counts(F.col("counts"), F.col("breaks"))
        for r in le.natural_breaks(df, "scene", "value", k).select("scene", centre.alias("c"), lower.alias("l")).where("l IS NOT NULL").collect():
            want.setdefault(r.scene, []).append((r.c, r.l))
    got = {r.scene: (r.centre, r.lower, r.rounds) for r in le.natural_breaks_threshold(df, "scene", "value", range(5, 9), 0.0).collect()}
    assert got.keys() == want.keys()
    for k, rows in want.items():
        assert np.allclose(got[k][:2], np.mean(np.array(rows), axis=0)) and got[k][2] == len(rows)


def test_bins_hold_what_a_count_of_edges_says(spark):
    """Every value in the bin of the last edge that isn't above it."""
    df = _events(spark).where("scene = 0")
    bins = sorted((r["_v"], r["_w"]) for r in le._natural_bins(df, "scene", "value", 64, 1.0).collect())
    rows = [r.value for r in df.collect()]
    assert sum(w for _, w in bins) == len(rows)
    edges = sorted(df.agg(F.array_distinct(F.percentile_approx("value", [i / 64 for i in range(64)], 6400))).first()[0])
    at = np.searchsorted(edges, rows, "right")
    assert sorted((at == k).sum() for k in np.unique(at)) == sorted(w for _, w in bins)
