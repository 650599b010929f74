"""Approximate nearest neighbours by a permutation index over pivots."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arpent.llm._shared import read
from arpent.llm.vectors import best, top_of_tiles, usable

#: The pivots are a bounded sample: the vectors whose ids hash lowest. Each row is represented by its PREFIX nearest.
PIVOTS, PREFIX = 512, 64

#: Share of a tile's rows, and least number of them, that the footrule ranking passes on to exact scores.
SHARE, LEAST = 0.20, 400


def permutations(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Each row's nearest pivots by angle, nearest first."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int16)


def levelled(x: np.ndarray, square: float) -> np.ndarray:
    """x with one more component, by which all rows have the squared norm `square`; nearness by angle is then that by inner product."""
    return np.hstack([x, np.sqrt(np.maximum(square - (x * x).sum(axis=1), 0))[:, None]])


class InvertedFiles:
    """For each pivot, the rows that have it in their prefix, and its place there."""

    def __init__(self, orders: np.ndarray, n_pivots: int):
        n, self.prefix = orders.shape
        flat = orders.ravel()
        by = np.argsort(flat, kind="stable")
        self.rows, self.ranks = (by // self.prefix).astype(np.int32), (by % self.prefix).astype(np.int32)
        self.starts = np.searchsorted(flat[by], np.arange(n_pivots + 1))
        self.n = n

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Distance of every row's prefix to a query's: displacements of shared pivots; one missing stands at the end."""
        k = self.prefix
        total = np.full(self.n, k * (k + 1), np.int32)  # nothing shared: k + (k-1) + ... + 1, for either side
        for rank, p in enumerate(order):
            a, b = self.starts[p], self.starts[p + 1]
            there = self.ranks[a:b]
            total[self.rows[a:b]] += np.abs(there - rank) - (k - rank) - (k - there)
        return total


def search_tile(pivots: np.ndarray, prefix: int, k: int, square: float, share: float, least: int):
    def find(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray):
        files = InvertedFiles(permutations(levelled(v, square), pivots, prefix), len(pivots))
        orders = permutations(np.hstack([q, np.zeros((len(q), 1))]), pivots, prefix)
        most = min(len(vid), max(least, int(share * len(vid))))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i in range(len(qid)):
            near = files.footrule(orders[i]).astype(np.int64) * len(vid) + np.arange(len(vid))  # ties to the smaller id
            near = np.argpartition(near, most - 1)[:most]
            near = near[vid[near] != qid[i]]
            scores = (v[near] * q[i]).sum(axis=1)
            top = best(vid[near], scores, k)
            out.append((np.full(len(top), qid[i]), vid[near][top], scores[top]))
        return tuple(np.concatenate([o[z] for o in out]) for z in range(3))

    return find


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, n_pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """The k rows of largest inner product found for each query row, by (query_id, rank, vec_id, score).

    Every row is posted in the inverted files of its nearest pivots, tile by tile; a query ranks a tile's rows by the
    footrule distance of the prefixes and scores the nearest ones on the original vectors in double precision. Norms count:
    rows and pivots get one more component that makes their norms equal, queries a zero there. A tile of
    `least` rows or fewer is scored whole. Vectors that are null, zero or hold null or non-finite components take no part,
    nor do rows without vec_id, nor those of another length than most (the smaller of ties); rows of a query's own
    vec_id are its own.
    """
    lengths = vectors.where(usable()).groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = vectors.where(usable() & (F.size("embedding") == (lengths["n"] if lengths else 0))).select(F.col("vec_id").cast("long"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    sample = rows.where("vec_id IS NOT NULL").orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).collect()  # n_pivots rows at most
    pivots = np.array([r["v"] for r in sample], np.float64)
    square = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0] or 0.0
    if len(pivots):
        pivots = levelled(pivots, square)
        pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    return top_of_tiles(rows, every, k, search_tile(pivots, min(prefix, max(1, len(pivots))), k, square, share, least), "double")


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))


QUERIES = {"op8_permutation_index": op8_permutation_index}
ORACLES: dict[str, str] = {}
