"""Hard-negative mining: rotated one-bit codes bound inner products, and only rows whose interval may matter are scored."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arpent.llm._shared import read, saved, small
from arpent.llm.vectors import usable

#: Most vectors and anchors of a tile, about.
VECTORS, ANCHORS = 8192, 1024

#: One-bit codes of a vector: each one codes, in a rotation of its own, what the codes before leave over.
CODES = 5

#: Bits of a rotated anchor's components, so many planes to count common bits with.
BITS = 7

_ROTATIONS: dict[tuple[int, int], np.ndarray] = {}


def rotation(size: int, stage: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    if (size, stage) not in _ROTATIONS:
        draw = np.random.default_rng([size, stage]).standard_normal((size, size))
        _ROTATIONS[size, stage] = np.linalg.qr(draw)[0]
    return _ROTATIONS[size, stage]


def _packed(bits: np.ndarray) -> np.ndarray:
    """The last axis as words of 64 bits, filled up with zeros."""
    pad = -bits.shape[-1] % 64
    wide = np.concatenate([bits, np.zeros((*bits.shape[:-1], pad), bool)], axis=-1) if pad else bits
    return np.packbits(wide, axis=-1, bitorder="little").view(np.uint64)


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, along, rest) of the rows of x, for each of CODES stages.

    In stage k the remainder r is rotated and coded by its signs s; `along` is its alignment with the code, <r, s> / size,
    so that r = along * s + (what is at right angles to s), whose norm is `rest`, and which the next stage codes.
    """
    n, size = x.shape
    words = -(-size // 64)
    codes, along, rest = np.zeros((n, CODES, words), np.uint64), np.zeros((n, CODES)), np.zeros((n, CODES))
    left = x.astype(np.float64)
    for k in range(CODES):
        turned = left @ rotation(size, k)
        signs = turned >= 0
        plus = np.where(signs, 1.0, -1.0)
        along[:, k] = (turned * plus).sum(axis=1) / size
        turned -= along[:, k, None] * plus
        rest[:, k] = np.linalg.norm(turned, axis=1)
        codes[:, k] = _packed(signs)
        left = turned @ rotation(size, k).T
    return codes, along, rest


class Anchor:
    """An anchor's rotations in whole numbers of BITS bits, as planes of bits."""

    def __init__(self, q: np.ndarray):
        self.size, self.norm = len(q), float(np.linalg.norm(q))
        self.stages = []
        for k in range(CODES):
            turned = q.astype(np.float64) @ rotation(self.size, k)
            low = turned.min()
            step = (turned.max() - low) / (2**BITS - 1) or 1.0
            whole = np.rint((turned - low) / step).astype(np.int64)
            off = float(np.abs(turned - (low + step * whole)).sum())
            planes = _packed((whole[None, :] >> np.arange(BITS)[:, None]) & 1 > 0)
            self.stages.append((low, step, low * self.size + step * float(whole.sum()), off, planes))

    def along_code(self, k: int, codes: np.ndarray) -> np.ndarray:
        """<rotated anchor, signs> for each code (rows of words), from counts of common bits; off by the stage's `off` at most."""
        low, step, total, _, planes = self.stages[k]
        count = np.zeros(len(codes), np.int64)
        for j, plane in enumerate(planes):
            count += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << j
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        return 2 * (low * ones + step * count) - total


class Intervals:
    """Bounds of an anchor's inner products with the rows of a tile that are still alive, narrower with each stage.

    With the codes so far, <q, x> = sum of along * <q, s> + <q, remainder>; the remainder is at right angles to the last
    code, so by Cauchy-Schwarz its part is at most rest * sqrt(|q|^2 - <q, s>^2 / size). Nothing here is left to chance.
    """

    def __init__(self, q: np.ndarray, tile: tuple[np.ndarray, np.ndarray, np.ndarray], alive: np.ndarray):
        self.anchor, self.tile, self.alive = Anchor(q), tile, alive
        self.at, self.off = np.zeros(len(alive)), np.zeros(len(alive))
        self.low, self.high = np.full(len(alive), -np.inf), np.full(len(alive), np.inf)

    def narrow(self, k: int) -> None:
        codes, along, rest = (part[self.alive, k] for part in self.tile)
        seen, off = self.anchor.along_code(k, codes), self.anchor.stages[k][3]
        self.at += along * seen
        self.off += along * off
        known = np.maximum(0.0, np.abs(seen) - off)
        half = rest * np.sqrt(np.maximum(0.0, self.anchor.norm**2 - known**2 / self.anchor.size)) + self.off
        half += 1e-9 * (self.anchor.norm * (np.abs(along) * np.sqrt(self.anchor.size) + rest) + np.abs(self.at) + 1)
        self.low, self.high = np.maximum(self.low, self.at - half), np.minimum(self.high, self.at + half)

    def keep(self, mask: np.ndarray) -> None:
        if not mask.all():
            self.alive, self.at, self.off, self.low, self.high = (x[mask] for x in (self.alive, self.at, self.off, self.low, self.high))


def _floor(values: np.ndarray, k: int) -> float:
    """The k-th highest value; lowest of all where there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def scored(whole: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
    return whole[at] @ q


def highest(q: np.ndarray, ids: np.ndarray, tile: tuple, whole: np.ndarray, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k highest integer inner products among the rows alive, ties to the smaller id."""
    seen = Intervals(q, tile, alive)
    for stage in range(CODES):
        if len(seen.alive) > k:
            seen.narrow(stage)
            seen.keep(seen.high >= _floor(seen.low, k))
    scores = scored(whole, q, seen.alive)
    top = np.lexsort((ids[seen.alive], -scores))[:k]
    return seen.alive[top], scores[top]


def within_bands(q: np.ndarray, ids: np.ndarray, tile: tuple, whole: np.ndarray, alive: np.ndarray, bands: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each band (lowest, highest), places and scores of its k highest integer inner products, ties to the smaller id.

    A row is of use to a band if its interval meets it and reaches the k-th highest lower bound of those surely inside.
    """
    seen = Intervals(q, tile, alive)
    for stage in range(CODES):
        if not len(seen.alive):
            break
        seen.narrow(stage)
        use = np.zeros(len(seen.alive), bool)
        for lowest, highest_ in bands:
            sure = (seen.low >= lowest) & (seen.high <= highest_)
            use |= (seen.low <= highest_) & (seen.high >= max(lowest, _floor(seen.low[sure], k)))
        seen.keep(use)
    scores = scored(whole, q, seen.alive)
    out = []
    for lowest, highest_ in bands:
        inside = np.flatnonzero((scores >= lowest) & (scores <= highest_))
        top = inside[np.lexsort((ids[seen.alive[inside]], -scores[inside]))[:k]]
        out.append((seen.alive[top], scores[top]))
    return out


def _joined(column: pd.Series, kind: str, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), *shape)


def _tile(v: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, tuple, np.ndarray]:
    v = v.sort_values("vec_id", kind="stable")
    size = int(v["size"].iloc[0])
    tile = (_joined(v["codes"], "u8", CODES, -(-size // 64)), _joined(v["along"], "f8", CODES), _joined(v["rest"], "f8", CODES))
    return v, v["vec_id"].to_numpy(), tile, _joined(v["whole"], "i8", size)


def coded(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, size, whole, codes, along, rest): components as floor(256 * x) with their codes, one row an id.

    Rows without id, label or vector take no part, nor do vectors that are empty or hold null or non-finite components. Of
    rows of one id, that with the least label, and then the least vector, counts.
    """
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    held = vectors.where(usable(zero=True) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    rows = held.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), ints.alias("v"))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("held")).select("vec_id", "held.label", "held.v")

    def run(batches):
        for pdf in batches:
            lengths = pdf["v"].map(len)
            for size, part in pdf.groupby(lengths):
                whole = np.stack(part["v"].to_numpy()).astype(np.int64)
                codes, along, rest = encode(whole)
                yield pd.DataFrame({"vec_id": part["vec_id"], "label": part["label"], "size": np.int32(size)} | {k: [r.tobytes() for r in x] for k, x in (("whole", whole), ("codes", codes), ("along", along), ("rest", rest))})

    return rows.mapInPandas(run, "vec_id long, label long, size int, whole binary, codes binary, along binary, rest binary")


def _dealt(df: DataFrame, own: str, other: str) -> DataFrame:
    """Rows in tile `own` by a hash of their id, once for each tile of the other side; n_<tile> columns have the numbers."""
    tile = F.pmod(F.xxhash64("vec_id"), F.col(f"n_{own}")).cast("int")
    return df.withColumn(own, tile).withColumn(other, F.explode(F.sequence(F.lit(0), (F.col(f"n_{other}") - 1).cast("int"))))


def positives(rows: DataFrame, every: int, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): each anchor's k highest other rows of its label.

    Only rows of one label and length meet, in tiles of bounded size whose numbers follow the label's counts.
    """
    counts = rows.groupBy("label", "size").agg(F.ceil(F.count("*") / VECTORS).alias("n_vt"), F.greatest(F.lit(1), F.ceil(F.sum((F.col("vec_id") % every == 0).cast("long")) / ANCHORS)).alias("n_qt"))
    placed = rows.join(small(saved(counts, "labels")), ["label", "size"])
    left = _dealt(placed, "vt", "qt")
    anchors = saved(placed.where(F.col("vec_id") % every == 0).select("vec_id", "label", "size", "whole", "n_vt", "n_qt"), "anchors")
    right = _dealt(anchors, "qt", "vt")

    def run(v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(v) and len(q):
            v, ids, tile, whole = _tile(v)
            for anchor, x in zip(q["vec_id"], _joined(q["whole"], "i8", whole.shape[1]), strict=True):
                at, scores = highest(x, ids, tile, whole, np.flatnonzero(ids != anchor), k)
                out.append(pd.DataFrame({"anchor_id": anchor, "positive_id": ids[at], "positive_score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": []})

    keys = ("label", "size", "vt", "qt")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "anchor_id long, positive_id long, positive_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    return found.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def hard_negatives(vectors: DataFrame, every: int = 50, positives_: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """The highest rows of another label whose score is least to most percent of a positive's, for anchors and positives.

    vectors: vec_id, label, embedding; extra columns of any name are left alone. Anchors are rows whose vec_id is divisible
    by `every`; a score is the inner product of components floor(256 * x), exact while components stay below 2^53 and scores
    in a long. Ties go to the smaller id. Vectors of another length than the anchor's are no candidates. Without partners
    there is no row; an empty table gives none. See `coded` for rows that take no part and for repeated ids.

    Every anchor is held against all rows in tiles of bounded size, so the work grows with the square of the table, though
    only rows whose interval by the codes may matter are scored.
    """
    rows = saved(coded(vectors), "coded")
    pairs = saved(positives(rows, every, positives_), "positives")
    wanted = pairs.where(F.col("positive_score") >= 0).groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("wanted"))  # positives_ at most
    anchors = saved(rows.where(F.col("vec_id") % every == 0).join(wanted, "vec_id").select("vec_id", "label", "size", "whole", "wanted"), "anchors")
    nv, nq = (F.lit(max(1, -(-df.count() // most_))) for df, most_ in ((rows, VECTORS), (anchors, ANCHORS)))
    left = _dealt(rows.withColumns({"n_vt": nv, "n_qt": nq}), "vt", "qt").groupBy("size", "vt", "qt")
    right = _dealt(anchors.withColumns({"n_vt": nv, "n_qt": nq}), "qt", "vt").groupBy("size", "vt", "qt")

    def run(v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(v) and len(q):
            v, ids, tile, whole = _tile(v)
            labels = v["label"].to_numpy()
            for anchor, label, x, held in zip(q["vec_id"], q["label"], _joined(q["whole"], "i8", whole.shape[1]), q["wanted"], strict=True):
                pairs = [(int(p["positive_id"]), int(p["positive_score"])) for p in held]
                bands = [(-(-least * s // 100), most * s // 100) for _, s in pairs]
                found = within_bands(x, ids, tile, whole, np.flatnonzero(labels != label), bands, negatives)
                out += [pd.DataFrame({"anchor_id": anchor, "positive_id": p, "negative_id": ids[at], "positive_score": s, "negative_score": scores}) for (p, s), (at, scores) in zip(pairs, found, strict=True) if len(at)]
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")})

    found = left.cogroup(right).applyInPandas(run, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved))


QUERIES = {"op11_hard_negatives": op11_hard_negatives}

ORACLES = {
    "op11_hard_negatives": """
WITH ints AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM ints a JOIN ints c ON c.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
  n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
}
