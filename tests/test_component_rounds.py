"""What the driver holds of a component loop doesn't grow with its rounds."""

from __future__ import annotations

from arpent.operators import regions as rg


def test_labels_carry_nothing_inferred_from_round_to_round(spark):
    n = 64
    nodes = spark.range(n).selectExpr("id AS node")
    edges = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b")
    out = rg.label_components(nodes, edges)
    assert "RDD" not in out._jdf.queryExecution().analyzed().toString()  # a checkpoint keeps its plan's constraints
    assert {(r.node, r.label) for r in out.collect()} == {(i, 0) for i in range(n)}
