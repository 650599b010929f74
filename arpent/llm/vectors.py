"""Query sets against all vectors, in tiles of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arpent.llm._shared import saved

#: Most vectors and queries of a tile, about.
VECTORS, QUERIES_ = 8192, 1024


def usable(vector: str = "embedding", zero: bool = False) -> Column:
    """Not null, not empty, no null or non-finite component and, unless zero is set, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))
    return ok if zero else ok & F.exists(vector, lambda x: x != 0)


def matrix(column: pd.Series, kind: str = "float64") -> np.ndarray:
    return np.stack(column.to_numpy()).astype(kind) if len(column) else np.empty((0, 0), kind)


def top_of_tiles(vectors: DataFrame, every: int, k: int, find: Callable, score: str) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each query, best first, ties to the smaller vec_id.

    vectors: vec_id, v. Queries are the rows whose vec_id is divisible by `every`. Vectors and queries are dealt into
    tiles by a hash of their id; each pair of a vector tile and a query tile is one group of bounded size, in which
    find(query ids, queries, vector ids in order, vectors) gives arrays (query_id, vec_id, score), k a query at most.
    Only those are brought together by query. Vectors of different lengths never meet. As queries are a fixed share of the
    rows, the work grows with the square of the table, in groups of bounded size.
    """
    vectors = saved(vectors.where("vec_id IS NOT NULL"), "vectors")
    queries = vectors.where(F.col("vec_id") % every == 0)
    nv, nq = max(1, -(-vectors.count() // VECTORS)), max(1, -(-queries.count() // QUERIES_))

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    def run(v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(v) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        v = v.sort_values("vec_id", kind="stable")
        a, b, s = find(q["vec_id"].to_numpy(), matrix(q["v"]), v["vec_id"].to_numpy(), matrix(v["v"]))
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": s})

    length = F.size("v").alias("_length")
    left = dealt(vectors, "_vt", nv, "_qt", nq).groupBy("_vt", "_qt", length)
    right = dealt(queries, "_qt", nq, "_vt", nv).groupBy("_vt", "_qt", length)
    found = left.cogroup(right).applyInPandas(run, f"query_id long, vec_id long, score {score}")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]
