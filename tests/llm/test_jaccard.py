import random
import re
from collections import Counter

from arpent.llm import jaccard


def sets_of(rows):
    out = []
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append((doc, {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()))
    return out


def brute(rows):
    sets = sets_of(rows)
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, (_, s) in enumerate(sets):
        common = Counter(j for x in s for j in by[x] if j < i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return Counter((doc, len(s), least.get(root(i)) if s else doc) for i, (doc, s) in enumerate(sets))


def test_query(spark, sf_dir):
    got = Counter(map(tuple, jaccard.op4_ngram_jaccard(spark, sf_dir).collect()))
    assert got == brute(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())


def test_odd_rows_and_no_rows(odd, no_docs):
    assert Counter(map(tuple, jaccard.near_duplicates(odd).collect())) == brute(odd.select("doc_id", "text").collect())
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_families_near_the_threshold(spark):
    rng, rows = random.Random(5), []
    for family in range(6):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([6, 12, 60, 200]))]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 9)}"
            rows.append((rng.randint(0, 10**9), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, jaccard.near_duplicates(docs).collect())) == brute(rows)


def test_tiles_alone_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    test_families_near_the_threshold(spark)


def test_only_texts_of_possible_pairs_are_read_again(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    passage = word(60)
    rows = [(i, " ".join(word(60) + passage)) for i in range(40)]
    rows.append((40, rows[0][1] + " more"))
    counts, kept = [], jaccard.sorted_sets
    monkeypatch.setattr(jaccard, "sorted_sets", lambda docs, text="text": (counts.append(docs.count()), kept(docs, text))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, jaccard.near_duplicates(docs).collect())) == brute(rows)
    assert max(counts) == 2
