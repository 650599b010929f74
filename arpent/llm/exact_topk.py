"""Exact top-k search with multi-resolution segment statistics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arpent.llm._shared import read
from arpent.llm.vectors import best, top_of_tiles, usable

#: Numbers of segments, coarse to fine; a vector is filled up with zeros to a multiple of the last.
LEVELS = (1, 4, 16)


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of equal segments, scaled so that the product of two rows bounds their inner product.

    Within a segment of length l, <q, x> <= l * mean(q) * mean(x) + l * dev(q) * dev(x); so a distance is never below
    |q|^2 + |x|^2 - 2 * bound.
    """
    parts = x.reshape(len(x), segments, -1)
    means, devs = parts.mean(axis=2), parts.std(axis=2)
    return np.concatenate([means, devs], axis=1) * np.sqrt(parts.shape[2])


def search_tile(k: int):
    """For each query of a tile, its k highest integer inner products among the tile's vectors."""

    def find(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray):
        pad = (-v.shape[1]) % LEVELS[-1]
        wide_q, wide_v = (np.pad(x, ((0, 0), (0, pad))) for x in (q, v))
        feats = [(segment_features(wide_q, s), segment_features(wide_v, s)) for s in LEVELS]
        whole_q, whole_v = q.astype(np.int64), v.astype(np.int64)
        slack = 1e-9 * (np.linalg.norm(q, axis=1).max() * np.linalg.norm(v, axis=1).max() + 1)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i in range(len(qid)):
            alive, floor = np.flatnonzero(vid != qid[i]), -np.inf
            for fq, fv in feats:
                bounds = fv[alive] @ fq[i]
                if len(alive) > k:
                    first = alive[np.argpartition(-bounds, k - 1)[:k]]
                    floor = max(floor, np.partition(whole_v[first] @ whole_q[i], 0)[0])  # k rows reach this score
                alive = alive[bounds >= floor - slack]
            scores = whole_v[alive] @ whole_q[i]
            top = best(vid[alive], scores, k)
            out.append((np.full(len(top), qid[i]), vid[alive][top], scores[top]))
        return tuple(np.concatenate([o[z] for o in out]) for z in range(3))

    return find


def exact_top_k(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Components as floor(256 * x); the k highest integer inner products of each query row with the other rows.

    Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without vec_id; rows of
    a query's own vec_id are its own, and vectors of another length are no candidates. Scores are exact while components
    are below 2^53 and scores fit a long.
    """
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = vectors.where(usable(zero=True)).select(F.col("vec_id").cast("long"), ints.alias("v"))
    return top_of_tiles(rows, every, k, search_tile(k), "long")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read(spark, sf_dir, "embeddings"))


QUERIES = {"op10_exact_top_k": op10_exact_top_k}

ORACLES = {
    "op10_exact_top_k": """
WITH ints AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM ints q JOIN ints c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
}
