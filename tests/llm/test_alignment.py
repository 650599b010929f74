import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from arpent.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def pieces(text):
    """(ids, bytes) of both sides, each from the libraries alone; nothing where the bytes are not the text's."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, decoders

    if not hasattr(pieces, "held"):
        t = Tokenizer.from_file(A)
        t.encode_special_tokens = True
        names = {v: k for k, v in t.get_vocab().items()}
        plain = [b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]]
        of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        pieces.held = t, names, of, SentencePieceProcessor(model_file=B)
        assert decoders
    t, names, of, sp = pieces.held
    if not text:
        return [], [], [], []
    a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    raw_a = [bytes(of[c] for c in names[i]) for i in a]
    raw_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(sp.id_to_piece, b)]
    raw = (" " + text).encode()
    return (a, b, raw_a, raw_b) if b"".join(raw_a) == raw == b"".join(raw_b) else ([], [], [], [])


def spans(raw):
    at, out = 0, []
    for r in raw:
        out.append((at, at + len(r)))
        at += len(r)
    return out


def brute(rows):
    """Loops over all token pairs that overlap, byte by byte cuts, counts in dictionaries."""
    docs, held = [], Counter()
    for doc, text in rows:
        a, b, ra, rb = pieces(text)
        sa, sb = spans(ra), spans(rb)
        pairs, j = [], 0
        for i, (s, e) in enumerate(sa):
            while j and sb[j - 1][1] > s:
                j -= 1
            while j < len(sb) and sb[j][0] < e:
                if sb[j][1] > s:
                    pairs.append((a[i], b[j]))
                j += 1
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        shown, i, j = [], 0, 0
        for c in cuts:
            left, right = [], []
            while i < len(sa) and sa[i][1] <= c:
                left.append(str(a[i]))
                i += 1
            while j < len(sb) and sb[j][1] <= c:
                right.append(str(b[j]))
                j += 1
            shown.append(",".join(left) + "|" + ",".join(right))
        docs.append((doc, len(a), len(b), len(cuts), pairs, ";".join(shown)))
        held.update(set(pairs))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest() if s else ""
    return Counter((d, na, nb, g, len(p), sum(held[x] == most[x[0]] for x in p), sum(held[x] for x in p), digest(s)) for d, na, nb, g, p, s in docs)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = alignment.op12_cross_alignment(spark, sf_dir)
    assert Counter(map(tuple, got.select(COLUMNS).collect())) == brute(rows)


STRANGE = ["a▁b", "<s> x </s> <0x41> <|endoftext|>", "  two  spaces \n\n end ", "ﬁ Å é", "\x00\x01", " ", "z" * 3000, "\U0001f600" * 40]


def test_odd_rows_long_texts_and_small_lots(spark, odd, no_docs, monkeypatch):
    """Lots of a few rows and buckets of a few pairs give the same."""
    long = ("word  and, otheré words\n " * 400 + "y" * 500 + " ") * 8
    more = spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate([*STRANGE, long, long])], odd.schema)
    df = odd.union(more)
    want = brute(df.select("doc_id", "text").collect())
    for small in (False, True):
        if small:
            for name, value in (("LOT", 2000), ("LINKS", 500), ("BUCKET", 50)):
                monkeypatch.setattr(alignment, name, value)
        got = alignment.cross_alignment(df, A, B, digest=True).withColumnRenamed("groups", "groups_sha256")
        assert Counter(map(tuple, got.select(COLUMNS).collect())) == want
    assert alignment.cross_alignment(no_docs, A, B).count() == 0


def test_parts_and_words_change_no_token(monkeypatch):
    """Parts of long texts and words encoded once, with and without room for all of them."""
    t = alignment.Tokenizers.at(A, B)
    texts = ["word  and, otheré words\n  x " * 300, " ".join(["12 !?'s don't"] * 900), "a" * 900 + " " + "b " * 50, "\n \n  " * 300, "日本語 ひらがな ab " * 200, "one two  three", *STRANGE]
    for part, room in ((40, 1 << 19), (1 << 16, 5)):
        monkeypatch.setattr(alignment, "PART", part)
        monkeypatch.setattr(alignment, "WORDS", room)
        for text in texts:
            a, b, _, _ = pieces(text)
            good, ids_a, count_a, ids_b, count_b = t.encode([text])
            assert (ids_a.tolist(), ids_b.tolist()) == (a, b) and good.tolist() == ([0] if a else []) and count_a.sum() == len(a) and count_b.sum() == len(b)
    assert len(alignment.Tokenizers.at(A, B).cut("a b " * 100_000)) > 1


def test_groups_as_text(spark):
    df = spark.createDataFrame([(1, "hello wonderful world"), (2, None)], "doc_id int, text string")
    rows = {r["doc_id"]: r for r in alignment.cross_alignment(df, A, B).collect()}
    assert rows[2]["groups"] == "" and rows[2]["n_links"] == 0
    a, b, _, _ = pieces("hello wonderful world")
    sides = [g.split("|") for g in rows[1]["groups"].split(";")]
    assert [int(x) for s, _ in sides for x in s.split(",")] == a and [int(x) for _, s in sides for x in s.split(",")] == b
    assert len(sides) == rows[1]["n_groups"]


@pytest.mark.parametrize("seed", range(5))
def test_pointer_doubling_finds_common_ends(seed):
    rng = np.random.default_rng(seed)
    n = 4000
    share = [0.5, 0.01, 0.9, 0.3, 0.02][seed]
    a, b = (np.append(np.flatnonzero(rng.random(n) < s) + 1, n + 1) for s in (share, 0.4))
    group_a, group_b, groups = alignment.group_labels(a, b)
    common = np.intersect1d(a, b)
    assert groups == len(common)
    assert np.array_equal(group_a, np.searchsorted(common, a)) and np.array_equal(group_b, np.searchsorted(common, b))
    i, j, _ = alignment.links(a, b)
    starts_a, starts_b = np.append(0, a[:-1]), np.append(0, b[:-1])
    assert {*zip(i.tolist(), j.tolist(), strict=True)} == {(x, y) for x in range(len(a)) for y in range(len(b)) if starts_a[x] < b[y] and starts_b[y] < a[x]} if len(a) * len(b) < 1e6 else True
