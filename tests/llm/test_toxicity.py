import zlib

import numpy as np

from arpent.llm import toxicity


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in toxicity.op3_toxicity(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(got) == docs and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    labels = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(got[d]["predicted"], t) for d, t in labels if got[d]["held_out"]]
    tp, fp, fn = (sum(x == y for x in held) for y in ((1, 1), (1, 0), (0, 1)))
    assert 2 * tp / (2 * tp + fp + fn) >= 0.9


def model_of(words):
    counts = np.zeros(toxicity.SYMBOLS**3)
    s = np.concatenate([[0, 0], toxicity.symbols(" ".join(words)), [0]])
    np.add.at(counts, (s[:-2] * toxicity.SYMBOLS + s[1:-1]) * toxicity.SYMBOLS + s[2:], 1)

    class Counts:
        def collect(self):
            return [{"code": int(i), "n": int(counts[i])} for i in np.flatnonzero(counts)]

    return toxicity.character_model(Counts())


def test_obfuscated_words_are_restored():
    m = model_of(["idiot", "loser", "stupid", "the", "was", "letter", "moron"] * 50)
    for written, word in [("1d10t", "idiot"), ("l0s3r", "loser"), ("$tup!d", "stupid"), ("i d i o t", "idiot"), ("l.o.s.e.r", "loser"), ("looooser", "loser"), ("letter", "letter"), ("m0r*n", "moron")]:
        assert toxicity.viterbi(written, m) == word
    r = toxicity.Restorer(m)
    assert {"idiot", "loser", "stupid"} <= r.words("you are an 1d10t, a l o s e r and stuuuupid!")
    assert {"stupid", "moron"} <= r.words("he is $ t u p ! d") | r.words("a mo.r.on") and "stupid" in r.words("so st.up.id of you")
    assert r.words(None) == set() == r.words("")


def test_odd_rows_and_no_rows(spark, odd, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    for docs in (odd, no_docs):
        for y in (labels, labels.limit(0)):
            out = toxicity.score(docs.withColumn("score", toxicity.F.lit("x")), toxicity.fit(docs, y))
            assert out.count() == docs.count() and set(docs.columns) < set(out.columns)


def test_obfuscation_does_not_hide_toxicity(spark):
    bad, good = ["idiot", "loser", "moron", "scum"], ["table", "river", "garden", "window", "letter", "house"]
    rng = np.random.default_rng(4)
    text = lambda toxic: " ".join([*rng.choice(good, 30), *(rng.choice(bad, 3) if toxic else [])])
    rows = [(i, text(i % 2), i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    hidden = spark.createDataFrame([(1, "table river 1d10t garden l0s3r window m o r o n"), (2, "table river garden window")], "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(hidden, model).collect()}
    assert got == {1: 1, 2: 0}
