import math

import numpy as np
import pytest

from arpent.llm import exact_topk, permutation_index, vectors


def load(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)


def brute(ids, x, every, k):
    out = []
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out += [(ids[i], r + 1, ids[j], s[j]) for r, j in enumerate(order)]
    return out


def test_exact_top_k(spark, sf_dir):
    ids, x = load(spark, sf_dir)
    got = sorted(map(tuple, exact_topk.op10_exact_top_k(spark, sf_dir).collect()))
    assert got == sorted((a, b, c, int(d)) for a, b, c, d in brute(ids, np.floor(256 * x), 50, 5))


def test_recall_of_the_permutation_index(spark):
    ids, x = load(spark, "/root/testdata/sf0.1")
    got = permutation_index.op8_permutation_index(spark, "/root/testdata/sf0.1").collect()
    want = brute(ids, x, 20, 20)
    assert len(got) == len(want)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert np.mean([(a, c) in found for a, _, c, _ in want]) >= 0.9
    at = {v: i for i, v in enumerate(ids)}
    assert all(math.isclose(r["score"], float((x[at[r["query_id"]]] * x[at[r["vec_id"]]]).sum()), abs_tol=1e-12) for r in got)


ODD = [(0, [1.0, 0.0, 0.5]), (50, None), (100, [0.0, 0.0, 0.0]), (150, [1.0, None, 0.0]), (200, [float("nan"), 1.0, 0.0]), (250, [float("inf"), 1.0, 0.0]), (7, [1.0, 0.0, 0.5]), (3, [1.0, 0.0, 0.5]), (5, [-1.0, 0.2, 0.5]), (None, [1.0, 1.0, 1.0]), (9, [])]


def test_odd_vectors_and_none(spark):
    df = spark.createDataFrame([(a, b, 1) for a, b in ODD], "vec_id long, embedding array<double>, rank int")
    near = [tuple(r)[:3] for r in permutation_index.nearest(df, every=50, k=2).collect()]
    assert sorted(near) == [(0, 1, 3), (0, 2, 7)]
    exact = [tuple(r) for r in exact_topk.exact_top_k(df, k=3).collect()]
    assert sorted(exact)[:3] == [(0, 1, 3, 256 * 256 + 128 * 128), (0, 2, 7, 256 * 256 + 128 * 128), (0, 3, 100, 0)]
    assert sorted(exact)[3:] == [(100, 1, 0, 0), (100, 2, 3, 0), (100, 3, 5, 0)]
    longer = spark.createDataFrame([(1000, [1.0] * 5, 1), (1001, [2.0] * 5, 1)], df.schema)
    mixed = sorted(tuple(r) for r in exact_topk.exact_top_k(df.union(longer), k=3).collect())
    assert mixed == sorted([*exact, (1000, 1, 1001, 5 * 256 * 512)])
    assert sorted(tuple(r)[:3] for r in permutation_index.nearest(df.union(longer), every=50, k=2).collect()) == sorted(near)
    for f in (permutation_index.nearest, exact_topk.exact_top_k):
        assert f(df.limit(0)).count() == 0


def test_exact_top_k_against_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    want = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({exact_topk.ORACLES['op10_exact_top_k']})").fetchall()
    assert sorted(want) == sorted(map(tuple, exact_topk.op10_exact_top_k(spark, sf_dir).select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("sigma, rows", [(0.0, 8192), (0.3, 8192), (0.7, 8192), (0.3, 400)])
def test_recall_at_the_production_share(spark, sigma, rows, monkeypatch):
    """Without the floor that scores small tiles almost whole; on unit norms and on log-normal ones, in one tile and in five."""
    monkeypatch.setattr(vectors, "VECTORS", rows)
    ids, x = load(spark, "/root/testdata/sf0.1")
    x = x * np.exp(np.random.default_rng(3).normal(0, sigma, len(x)))[:, None]
    df = spark.createDataFrame([(int(i), v) for i, v in zip(ids, x.tolist(), strict=True)], "vec_id long, embedding array<double>")
    found = {(r["query_id"], r["vec_id"]) for r in permutation_index.nearest(df, least=1).collect()}
    assert np.mean([(a, c) in found for a, _, c, _ in brute(ids, x, 20, 20)]) >= 0.9
