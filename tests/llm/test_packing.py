import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from arpent.llm import packing


def check(rows, docs):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = Counter()
    for doc, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, a in enumerate(range(0, len(ids), 2048)):
            want[(doc, k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048 and sum(3 * n > 2048 for _, n in held) <= 2
    return len(bins), -(-sum(n for held in bins.values() for _, n in held) // 2048)


def test_query(spark, sf_dir):
    rows = packing.op9_best_fit_packing(spark, sf_dir).collect()
    n, least = check(rows, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    assert n <= least * 1.1 + 2


def test_odd_rows_and_no_rows(odd, no_docs):
    check(packing.pack_documents(odd).collect(), odd.select("doc_id", "text").collect())
    assert packing.pack_documents(no_docs).count() == 0


def test_counts_are_packed_whole():
    rng = random.Random(2)
    for _ in range(200):
        cap = rng.choice([10, 30, 100, 2048])
        counts = Counter(rng.randint(1, cap) for _ in range(rng.randint(0, 400)))
        got = Counter()
        for n, items in packing.pack_counts(dict(counts), cap):
            assert n > 0 and items and sum(items) <= cap and sum(3 * x > cap for x in items) <= 2
            for x in items:
                got[x] += n
        assert got == counts


def test_words_in_many_scripts_and_cases(spark):
    rng = random.Random(3)
    parts = ["a", "Ab", "'s", "'", "1", "É", "é", "́", " ", "\n", "\t", "\xa0", "\x85", "\x1c", "<|endoftext|>", "<|ENDOFTEXT|>", "!", "...", ",", ".", "ß", "Σ", "İ", "क़", "日", "\r", "I'll"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))) for i in range(4000)]
    check(packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)
