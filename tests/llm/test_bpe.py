import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import tiktoken

from arpent.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute(rows):
    enc, out = encoding(), []
    for doc, text in rows:
        ids = enc.encode_ordinary(text or "")
        out.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(enc.decode_bytes(ids)).hexdigest()))
    return Counter(out)


def test_query_equals_the_library(spark, sf_dir):
    got = bpe.op6_byte_bpe(spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_odd_rows_and_no_rows(odd, no_docs):
    got = bpe.round_trip_digests(odd, PATH, P.PATTERN)
    assert Counter(map(tuple, got.collect())) == brute(odd.select("doc_id", "text").collect())
    assert bpe.round_trip_digests(no_docs, PATH, P.PATTERN).count() == 0


def test_encode_then_decode_is_exact(odd):
    ids = bpe.encode(odd, PATH, P.PATTERN)
    assert ids.columns == ["doc_id", "ids"]
    back = Counter((r[0], bytes(r[1])) for r in bpe.decode(ids, PATH, P.PATTERN).collect())
    assert back == Counter((r["doc_id"], (r["text"] or "").encode()) for r in odd.collect())


def test_long_words_equal_the_library():
    c, enc, rng = bpe.Codec(open(PATH, "rb").read(), P.PATTERN), encoding(), random.Random(3)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    words = ["tiontiontionedshthe" * 20, "abababcbcbab" * 40, "a" * 400, "a" * 40_001, "éèêé" * 200, word("etaoinshrdlu", 4000), word("etaoinshrdluüß", 10_000)]
    words += [word("abcdefghijklmnopqrstuvwxyz", rng.randint(1, 500)) for _ in range(60)]
    got = c.contract([w.encode() for w in words])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [enc.encode_ordinary(w) for w in words]
    assert c.decode([*got, b""]) == [*[w.encode() for w in words], b""]


def test_very_long_words():
    """Cut where no token goes on, by a heap beyond: equal letters, random ones, a period, and other scripts."""
    rng = random.Random(4)
    codec, enc = bpe.Codec(open(PATH, "rb").read(), P.PATTERN), encoding()
    letters = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=100_000))
    words = ["a" * 1_500_000, letters, "ab" * 50_000, "\u65e5\u672c" * 40_000, "=" * 70_001, "".join(rng.choices("ea", k=70_000)), "x" * 300]
    for word in words:
        text = "one " + word + " two"
        (got,) = next(codec.encoded([text]))
        assert got == np.array(enc.encode_ordinary(text), "<u4").tobytes()
