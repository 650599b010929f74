"""Every registered query of the library against its SQL on DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import arpent.catalogue_bands  # noqa: F401
import arpent.catalogue_extra  # noqa: F401
import arpent.catalogue_focal  # noqa: F401
import arpent.catalogue_more  # noqa: F401
import arpent.catalogue_outlines  # noqa: F401
import arpent.catalogue_plans  # noqa: F401
import arpent.catalogue_shapes  # noqa: F401
from arpent.catalogue import ORACLES, QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float) and not math.isnan(v):
        return round(v, 5) + 0.0
    if v is not None and type(v).__name__ == "Decimal":
        return float(v)
    return "nan" if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    out = QUERIES[name](spark, sf_dir)
    columns = sorted(out.columns)
    rel = duck.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted([tuple(plain(r[i]) for i in at) for r in rel.fetchall()], key=str)
    got = sorted([tuple(plain(v) for v in r) for r in out.select(*[f"`{c}`" for c in columns]).collect()], key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or (isinstance(x, float) and isinstance(y, (float, int)) and math.isclose(x, y, abs_tol=2e-5)), (a, b)
