import numpy as np
import pytest

from arpent.llm import hard_negatives as hn


def brute(rows, every=50, k=5, top=3):
    """rows: (vec_id, label, whole numbers); plain loops over all pairs."""
    out = []
    for a, la, x in rows:
        if a % every:
            continue
        scores = [(-sum(p * q for p, q in zip(x, y, strict=True)), b, lb) for b, lb, y in rows if b != a and len(y) == len(x)]
        for s, p, _ in sorted(t for t in scores if t[2] == la)[:k]:
            held = sorted(t for t in scores if t[2] != la and 50 * -s <= 100 * -t[0] and 100 * -t[0] <= 95 * -s)[:top]
            out += [(a, p, r + 1, n, -s, -m) for r, (m, n, _) in enumerate(held)]
    return sorted(out)


@pytest.mark.parametrize("size", [3, 64, 70])
def test_intervals_hold_every_score(size):
    rng = np.random.default_rng(size)
    x = np.rint(rng.standard_normal((500, size)) * rng.choice([1, 40, 3000], (500, 1))).astype(np.int64)
    x[:3] = 0
    x[3:6] = x[6]
    codes = hn.encode(x)
    shares = []
    for q in x[::50]:
        seen = hn.Intervals(q, codes, np.arange(500))
        for k in range(hn.CODES):
            before = seen.high - seen.low
            seen.narrow(k)
            assert (seen.low <= x @ q).all() and (x @ q <= seen.high).all()
            assert (seen.high - seen.low <= before).all()
        shares.append(np.median((seen.high - seen.low)[6:] / np.maximum(1, np.linalg.norm(x, axis=1) * np.linalg.norm(q))[6:]))
    assert np.median(shares) < 0.6  # from 2 without any code


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    rows = [(i, (n + 1) % 10 if i % 7 == 0 else n, [int(np.floor(256 * float(v))) for v in x]) for i, n, x in rows]
    got = hn.op11_hard_negatives(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_ties_tiles_and_one_label_with_most_rows(spark, monkeypatch):
    """Few different vectors, so scores tie; two thirds of the rows share a label; several tiles on both sides."""
    monkeypatch.setattr(hn, "VECTORS", 40)
    monkeypatch.setattr(hn, "ANCHORS", 3)
    rng = np.random.default_rng(7)
    pool = rng.integers(-2, 4, (12, 5))
    rows = [(int(i), int(rng.choice([1, 1, 1, 1, 2, 3])), pool[rng.integers(12)].tolist()) for i in rng.permutation(400)]
    df = spark.createDataFrame([(i, n, [v / 256 for v in x]) for i, n, x in rows], "vec_id long, label int, embedding array<double>")
    got = hn.hard_negatives(df, every=10)
    want = brute(rows, every=10)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want


def test_odd_rows(spark):
    x = [1.0, 0.5, 0.0]
    near = [0.7, 0.3, 0.1]
    odd = [
        (0, 1, x), (None, 1, x), (50, None, x), (100, 1, None), (150, 1, [1.0, None, 0.0]), (200, 1, [float("nan"), 1.0, 0.0]), (250, 1, [float("inf"), 1.0, 0.0]),
        (300, 1, []), (350, 2, [1.0, 1.0]), (3, 1, x), (4, 1, [-1.0, 0.0, 0.0]), (5, 2, near), (5, 2, near), (7, 2, [0.0, 0.0, 0.0]), (8, 3, near), (9, None, near),
    ]
    df = spark.createDataFrame([(*r, 5, "s") for r in odd], "vec_id long, label int, embedding array<double>, rank int, size string")
    got = hn.hard_negatives(df)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    score = 256 * 256 + 128 * 128
    near_score = 256 * int(256 * 0.7) + 128 * int(256 * 0.3)
    assert sorted(map(tuple, got.collect())) == [(0, 3, 1, 5, score, near_score), (0, 3, 2, 8, score, near_score)]
    assert hn.hard_negatives(df.limit(0)).count() == 0
