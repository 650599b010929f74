from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from arpent.llm import quality as q
from arpent.llm.hashing import lots


def enumerated(score, change):
    """(sum, marginals of bad, pair marginals) over all labellings, one after the other."""
    n, total, bad, pairs = len(score), 0.0, np.zeros(len(score)), np.zeros((len(score), 3))
    for y in product((0, 1), repeat=n):
        s = sum(v for v, k in zip(score, y, strict=True) if k)
        steps = [(y[i - 1], y[i]) for i in range(1, n)]
        w = np.exp(s + sum({(0, 0): 0, (0, 1): change[0], (1, 0): change[1], (1, 1): change[2]}[x] for x in steps))
        total += w
        bad += w * np.array(y)
        for i, x in enumerate(steps, 1):
            if x != (0, 0):
                pairs[i, [(0, 1), (1, 0), (1, 1)].index(x)] += w
    return np.log(total), bad / total, pairs / total


def test_forward_backward_equals_all_labellings():
    rng = np.random.default_rng(1)
    counts = np.array([3, 0, 1, 6, 2])
    score, change = rng.normal(0, 2, counts.sum()), rng.normal(0, 1, 3)
    got = q.forward_backward(score, counts, change)
    at = 0
    for k, n in enumerate(counts):
        if n:
            log_z, bad, pairs = enumerated(score[at : at + n], change)
            assert np.isclose(got.log_z[k], log_z) and np.allclose(got.bad[at : at + n], bad) and np.allclose(got.pairs[at : at + n], pairs)
        at += n


def some(rng, n=60):
    counts = rng.integers(0, 6, n)
    return rng.integers(0, q.BINS, (counts.sum(), len(q.STATS))).astype(np.uint8), counts, rng.random(n) < 0.6


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    values, counts, good = some(rng)
    theta = rng.normal(0, 0.2, q.SIZE)
    _, gradient = q.loss_and_gradient(theta, values, counts, good)
    for i in [*rng.integers(0, q.WEIGHTS, 25), *range(q.WEIGHTS, q.SIZE)]:
        step = np.zeros(q.SIZE)
        step[i] = 1e-5
        slope = (q.loss_and_gradient(theta + step, values, counts, good)[0] - q.loss_and_gradient(theta - step, values, counts, good)[0]) / 2e-5
        assert np.isclose(slope, gradient[i], atol=1e-4)


def test_neighbours_stay_within_a_text():
    values = np.arange(4 * len(q.STATS)).reshape(4, -1) % q.BINS
    places = q.neighbours(values.astype(np.uint8), np.array([1, 0, 3])) % (q.BINS + 1)
    none = [q.BINS] * len(q.STATS)
    own, before, after = np.split(places, 3, axis=1)
    assert np.array_equal(own, values)
    assert [b.tolist() for b in before] == [none, none, values[1].tolist(), values[2].tolist()]
    assert [a.tolist() for a in after] == [none, values[2].tolist(), values[3].tolist(), none]


def test_lines_and_their_statistics():
    texts = ["One two two.\n\n  \nab | cd!!\n", "", None, "ÀB c"]
    (_, _, data, edges), = lots(pa.array(texts))
    values, weights, counts, spans = q.line_statistics(data, edges)
    assert counts.tolist() == [2, 0, 0, 1] and weights.tolist() == [10, 7, 3]
    assert [bytes(data[a:b]).decode() for a, b in spans] == ["One two two.", "ab | cd!!", "ÀB c"]
    stat = dict(zip(q.STATS, values.T.tolist(), strict=True))
    assert stat["begin"] == [1, 0, 1] and stat["end"] == [1, 2, 0] and stat["words"] == [1, 1, 1]
    assert stat["bare"] == [0, int(np.digitize(1 / 3, q.SHARES)), 0] and stat["capitals"][2] == int(np.digitize(2 / 3, q.SHARES))


def test_held_out_accuracy(spark):
    """Over all labelled documents of the fold that the fit never saw."""
    sf_dir = "/root/testdata/sf0.1"
    got = q.op13_quality(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = got.where("held_out").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    caught = [r["predicted"] == 0 for r in rows if r["quality"] == 0]
    kept = [r["predicted"] == 1 for r in rows if r["quality"] == 1]
    assert len(caught) > 50 and np.mean(caught) >= 0.97 and np.mean(kept) >= 0.99
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return q.fit(docs, labels)


def test_lines_are_marked(spark, model):
    prose = "The rain and the wind were over by noon, and we went out.\n" * 3
    junk = "Und%%% der*** und&&& die### ein$$$ tag%%% war&&& das### nicht***\n" * 3
    df = spark.createDataFrame([(1, prose + junk), (2, prose), (3, junk), (4, None), (5, " \n")], "doc_id long, text string")
    rows = q.label_lines(df, model).orderBy("doc_id", "line").collect()
    assert [(r["doc_id"], r["line"]) for r in rows] == [(1, i) for i in range(6)] + [(2, i) for i in range(3)] + [(3, i) for i in range(3)]
    assert (prose + junk).encode()[rows[4]["from"] : rows[4]["to"]].decode() == junk.split("\n")[0]
    assert min(r["good"] for r in rows if r["doc_id"] == 2) > 0.5 > max(r["good"] for r in rows if r["doc_id"] == 3)
    assert rows[4]["good"] < 0.5 < rows[0]["good"]
    scores = {r["doc_id"]: r["score"] for r in q.score(df, model).collect()}
    assert scores[3] < 0.3 < scores[2] and scores[4] == scores[5] == model.empty


def test_odd_rows_one_label_and_no_rows(spark, odd, no_docs, model):
    scored = q.score(odd.withColumn("score", odd.doc_id), model, score="s", predicted="p")
    assert scored.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "s", "p"]
    rows = scored.collect()
    assert len(rows) == 12 and all(0 <= r["s"] <= 1 for r in rows)
    assert len({r["s"] for r in rows if r["text"] and r["text"].startswith("alpha")}) == 1
    assert q.score(no_docs, model).count() == 0
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    for docs, known in ((odd, labels), (odd, labels.limit(0)), (no_docs, labels)):
        flat = q.fit(docs, known)
        assert {round(r["score"], 9) for r in q.score(odd, flat).collect()} == {round(flat.empty, 9)}
