import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from test_jaccard import brute as brute_groups
from test_packing import check
from test_secrets import brute as brute_secrets
from test_substring_dedup import brute as brute_spans

from arpent.llm.substring_dedup import cut_spans

BASE = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["toxicity"](spark, docs, sf_dir)
    assert kept.columns == BASE
    ids = {r[0] for r in kept.select("doc_id").collect()}
    clean = [d for d, y in labels.items() if y == 0]
    assert sum(d in ids for d in clean) >= 0.95 * len(clean)

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    near = stages["near_duplicates"](spark, docs, sf_dir)
    assert Counter(r[0] for r in near.select("doc_id").collect()) == Counter(d for d, _, c in brute_groups(rows) if d == c)

    cut = {r["doc_id"]: r["text"] for r in stages["substring_dedup"](spark, docs, sf_dir).collect()}
    want = {d: cut_spans(t, [tuple(map(int, s.split(":"))) for s in spans.split(",") if s]) for (d, t), spans in zip(rows, brute_spans(rows).values(), strict=True)}
    assert cut == {d: t for d, t in want.items() if t.strip(" ")}

    clean = {r["doc_id"]: r for r in stages["secrets"](spark, docs, sf_dir).collect()}
    for doc, *_, line in brute_secrets(rows):
        assert ("[secret]" in clean[doc]["text"]) == bool(line) and clean[doc]["n_chars"] == len(clean[doc]["text"])
    assert not any(re.search("[0-9a-f]{32}|AKIA[A-Z0-9]{12}", r["text"]) for r in clean.values())


def test_run_packs_what_the_stages_keep(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == BASE
    check(corpus_pipeline.run(spark, sf_dir).collect(), docs.select("doc_id", "text").collect())


def test_odd_rows(spark, odd, no_docs, sf_dir):
    clashing = odd.withColumn("score", F.lit(7.0)).withColumn("predicted", F.lit(1)).withColumn("_secrets", F.lit("mine")).withColumn("spans", F.lit(2))
    for docs in (odd, no_docs, clashing, odd.select("doc_id", "text")):
        base = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.saved(stage(spark, docs, sf_dir), "stage")
            assert docs.columns == base
        if "score" in base:
            assert docs.where("score <> 7.0 OR predicted <> 1 OR _secrets <> 'mine' OR spans <> 2").isEmpty() and not docs.isEmpty()
        corpus_pipeline.pack(spark, docs, sf_dir).count()
