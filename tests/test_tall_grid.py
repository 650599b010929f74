"""Queries against their SQL where the grid is higher than any of the small tables make it."""

from __future__ import annotations

import duckdb
import pytest

import arpent.catalogue_extra  # noqa: F401
import arpent.catalogue_more  # noqa: F401
import arpent.catalogue_plans  # noqa: F401
from arpent.catalogue import ORACLES, QUERIES

HEIGHT = 2100


@pytest.fixture(scope="module")
def tall(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tall"))
    rows = {
        "orders": (125 * HEIGHT, "id AS o_orderkey, id % 1500 AS o_custkey, 'F' AS o_orderstatus, 10.5D AS o_totalprice, TIMESTAMP '1995-01-01' AS o_orderdate, '1-URGENT' AS o_orderpriority"),
        "supplier": (300, "id AS s_suppkey, CAST(id % 25 AS INT) AS s_nationkey"),
        "part": (300, "id AS p_partkey, 'SMALL' AS p_type, CAST(id % 50 + 1 AS INT) AS p_size"),
    }
    for name, (n, columns) in rows.items():
        spark.range(n).selectExpr(*columns.split(", ")).write.parquet(f"{folder}/{name}.parquet")
    for name in ("nation", "region", "customer", "lineitem", "events"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["cc_extend_to_reference", "geo_subdivide", "jn_cut_grid", "jn_difference_overlay", "jn_split_polygons_by_lines", "src_select_tiles", "wn_priority_remove_overlaps"])
def test_query_equals_sql_on_a_tall_grid(spark, tall, name):
    con = duckdb.connect()
    for t in ("orders", "supplier", "part", "nation", "region", "customer", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tall}/{t}.parquet/*.parquet')")
    out = QUERIES[name](spark, tall)
    rel = con.execute(ORACLES[name])
    at = [[d[0] for d in rel.description].index(c) for c in out.columns]
    want = sorted(tuple(r[i] for i in at) for r in rel.fetchall())
    assert sorted(tuple(r) for r in out.collect()) == want
