"""Toxicity: noisy-channel deobfuscation by Viterbi decoding under a character model, then scores of the restored text."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arpent.llm._shared import read, small

#: The classifier is fitted on about this many labelled rows at most, chosen by a hash of their id.
TRAINING_ROWS = 40_000

#: Buckets in which features are first counted, and how many of the most telling ones are then counted exactly.
BUCKETS, TELLING = 1 << 18, 4096

#: A feature needs this log-odds, and a likelihood ratio (G-squared) that chance hardly gives among so many features:
#: there are far more words than beginnings that several words of a document share.
LEAST_WEIGHT, LEAST_RATIO = 4.0, {"word": 20.0, "beginning": 14.0}

BEGINNINGS = range(3, 9)

THRESHOLD = 0.3

#: Letters of the character model: a-z and the letters of Latin-1 and Latin Extended-A, lower-cased; others are one symbol.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(c for c in map(chr, range(0xDF, 0x180)) if c.isalpha() and c == c.lower())[:100]
SYMBOLS = len(LETTERS) + 2  # 0: outside a word, 1: any other character
SYMBOL = {c: i + 2 for i, c in enumerate(LETTERS)}

#: Letters that a written sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "*": "aeiou", "(": "c", "€": "e", "£": "l"}

SIGNS = re.compile(r"[0-9@$!|+*(€£]+")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
SPACED = re.compile(r"(?<!\w)[\w@$!|+€£](?:[ .\-_*][\w@$!|+€£]){3,}(?!\w)")
PIECES = re.compile(r"(?<!\w)[^\W\d_]{1,3}(?:[.\-_*][^\W\d_]{1,3}){2,}(?!\w)")
WORDS = re.compile(r"[^\W\d_]+")

#: Channel: chances that a letter is written as itself, by a sign, or stretched, and that a sign is meant as it stands.
P_SELF, P_SIGN, P_STRETCH, P_LITERAL = math.log(0.9), math.log(0.3), math.log(0.4), math.log(0.02)

_TABLE = np.ones(0x180, np.int32)
_TABLE[:] = [0 if not (chr(i).isalnum() or chr(i) in LEET) else SYMBOL.get(chr(i).lower(), 1) for i in range(0x180)]


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < 0x180, _TABLE[np.minimum(points, 0x17F)], 1)


def each(column: pa.Array, most: int = 256) -> Iterator[str | None]:
    """The texts of a column, a few at a time as Python strings."""
    for at in range(0, len(column), most):
        yield from column.slice(at, most).to_pylist()


def character_counts(docs: DataFrame) -> DataFrame:
    """(code, n): how often three symbols follow one another, over every text; SYMBOLS^3 rows at most."""

    def run(batches):
        total, held, size = np.zeros(SYMBOLS**3, np.int64), [], 0
        for b in batches:
            for t in each(b.column(0)):
                if t:
                    s = np.concatenate([[0, 0], symbols(t), [0]])
                    held.append((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:])
                    size += len(s)
                if size > SYMBOLS**3 // 2:
                    total += np.bincount(np.concatenate(held), minlength=SYMBOLS**3)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=SYMBOLS**3)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(total[code], pa.int64())], ["code", "n"])

    return docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def character_model(counts: DataFrame) -> np.ndarray:
    """Log-probability of a symbol after two others: trigram, bigram and unigram shares, mixed."""
    held = np.zeros(SYMBOLS**3)
    for r in counts.collect():  # SYMBOLS^3 rows at most
        held[r["code"]] = r["n"]
    tri = held.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1))
    share = lambda x: x / np.maximum(x.sum(axis=-1, keepdims=True), 1)
    mixed = 0.7 * share(tri) + 0.2 * share(bi)[None] + 0.099 * share(uni)[None, None] + 0.001 / SYMBOLS
    return np.log(mixed).astype(np.float32)


def viterbi(written: str, model: np.ndarray) -> str:
    """The likeliest word behind the written one.

    The lattice has, for each character, the letters that it may stand for; a character like the one before may also be
    stretch, and a separator between spaced letters nothing. Paths are scored by the channel and the character model.
    """
    best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    before = ""
    for c in written.lower():
        if c in " .-_" or (c == "*" and before and before in " .-_"):
            before = c
            continue
        options = [(SYMBOL[c], c, P_SELF)] if c in SYMBOL else [(1, c, P_LITERAL)]
        options += [(SYMBOL[x], x, P_SIGN - math.log(len(LEET[c]))) for x in LEET.get(c, "")]
        new: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, out) in best.items():
            for s, letter, cost in options:
                x = score + cost + float(model[a, b, s])
                if (b, s) not in new or x > new[b, s][0]:
                    new[b, s] = (x, out + letter)
            if c == before:
                x = score + P_STRETCH
                if (a, b) not in new or x > new[a, b][0]:
                    new[a, b] = (x, out)
        best, before = new, c
    return max(((s + float(model[a, b, 0]), out) for (a, b), (s, out) in best.items()), key=lambda x: (x[0], x[1]))[1]


_SEPARATOR = np.isin(np.arange(128), np.frombuffer(b" .-_*", np.uint8))
_WORD = np.array([chr(i).isalnum() or chr(i) in "_@$!|+" for i in range(128)])


def hints(text: str) -> tuple[bool, bool, bool]:
    """Whether a text may have stretched letters, spaced ones, and words in pieces: array tests that only ever err to true."""
    u = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    if len(u) < 3:
        return False, False, False
    stretched = bool(((u[2:] == u[1:-1]) & (u[1:-1] == u[:-2]) & (u[2:] > 64)).any())
    low = np.minimum(u, 127)
    word, apart = _WORD[low] | (u > 126), _SEPARATOR[low] & (u < 127)
    one = word[:-2] & apart[1:-1] & word[2:]
    inner = np.flatnonzero(one & (u[1:-1] != 32))
    return stretched, bool((one[:-2] & one[2:]).any()), bool((np.diff(inner) < 5).any())


def suspects(text: str) -> set[str]:
    """Written forms that may hide a word: tokens with signs among letters, stretched letters, spaced letters, pieces."""
    found = set()
    stretched, spaced, pieces = hints(text)
    for pattern in (SIGNS, STRETCHED) if stretched else (SIGNS,):
        end = -1
        for m in pattern.finditer(text):
            if m.start() < end:
                continue
            a = b = m.start()
            while a and not text[a - 1].isspace():
                a -= 1
            while b < len(text) and not text[b].isspace():
                b += 1
            token, end = text[a:b].strip(".,;:?!\"'()[]{}<>"), b
            if any(c.isalpha() for c in token):
                found.add(token)
    for m in SPACED.finditer(text) if spaced else ():
        found.update((m[0], m[0][2:]))  # the first letter may be a word of its own
    found.update(PIECES.findall(text) if pieces else ())
    return found


class Restorer:
    """Decodes each written form of a worker once."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def words(self, text: str | None) -> set[str]:
        """Words of the text, lower-cased, and those that its suspect forms decode to."""
        if not text:
            return set()
        found = set(WORDS.findall(text.lower()))
        for written in suspects(text):
            if written not in self.known:
                if len(self.known) > 200_000:
                    self.known.clear()
                self.known[written] = WORDS.findall(viterbi(written, self.model))
            found.update(self.known[written])
        return found


def features(words: set[str]) -> set[str]:
    """Words, and the beginnings of 3 to 8 letters that two words or more share."""
    found = set(words)
    for n in BEGINNINGS:
        found.update(f"{p}-" for p, k in Counter([w[:n] for w in words if len(w) > n]).items() if k > 1)
    return found


def likelihood_ratio(n0: int, n1: int, share: float) -> float:
    """G-squared of n1 of n0 + n1 documents being toxic where the given share is."""
    n = n0 + n1
    return 2 * sum(x * math.log(x / (n * p)) for x, p in ((n0, 1 - share), (n1, share)) if x)


@dataclass
class Model:
    characters: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    scale: float = 0.0
    bias: float = -20.0

    def evidence(self, words: set[str]) -> float:
        """Sum of the weights of the features of these words."""
        if not hasattr(self, "_by_length"):
            self._by_length = {n: {f[:-1] for f in self.weights if f.endswith("-") and len(f) == n + 1} for n in BEGINNINGS}
        total = sum(w for x in words if (w := self.weights.get(x)))
        for n, known in self._by_length.items():
            if known:
                found = Counter(p for w in words if (p := w[:n]) in known and len(w) > n)
                total += sum(self.weights[f"{p}-"] for p, k in found.items() if k > 1)
        return total

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.scale * math.sqrt(max(0.0, evidence)) + self.bias))))


def in_held_out_fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of about TRAINING_ROWS labelled rows at most outside the held-out fold; ids' labels are their largest."""
    held = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~in_held_out_fold()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, TRAINING_ROWS / max(1, held.count()))
    chosen = held.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return docs.select("doc_id", "text").join(small(chosen, 2 * TRAINING_ROWS), "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A character model of all texts, and weights of features of restored words from the training rows.

    Features are counted by class in BUCKETS hash buckets; those in the TELLING most telling buckets are counted exactly,
    and log-odds of the telling ones are the weights. Scale and bias are a logistic fit on the square root of the evidence.
    """
    spark = docs.sparkSession
    model = Model(character_model(character_counts(docs)))
    held = spark.sparkContext.broadcast(model.characters)
    rows = training_rows(docs, labels)

    def restored(b):
        restorer = Restorer(held.value)
        for t, y in zip(each(b.column(0)), b.column(1).to_pylist(), strict=True):
            yield features(restorer.words(t)), int(y)

    def coarse(batches):
        counts = np.zeros((2, BUCKETS + 1), np.int64)
        for b in batches:
            for found, y in restored(b):
                counts[y, BUCKETS] += 1
                counts[y, list({zlib.crc32(f.encode()) % BUCKETS for f in found})] += 1
        at = np.flatnonzero(counts.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[0, at], pa.int64()), pa.array(counts[1, at], pa.int64())], ["bucket", "n0", "n1"])

    by_bucket = rows.mapInArrow(coarse, "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()  # BUCKETS + 1 rows at most
    sizes = next(((r["n0"], r["n1"]) for r in by_bucket if r["bucket"] == BUCKETS), (0, 0))
    if not sizes[0] or not sizes[1]:
        return model
    odds = lambda n0, n1: math.log((n1 + 0.1) / (sizes[1] + 0.2)) - math.log((n0 + 0.5) / (sizes[0] + 1))
    share = sizes[1] / sum(sizes)
    telling = sorted((r for r in by_bucket if r["bucket"] != BUCKETS and r["n1"] > share * (r["n0"] + r["n1"])), key=lambda r: -likelihood_ratio(r["n0"], r["n1"], share))[:TELLING]
    wanted = spark.sparkContext.broadcast({r["bucket"] for r in telling})

    def exact(batches):
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in batches:
            for found, y in restored(b):
                counts[y].update(f for f in found if zlib.crc32(f.encode()) % BUCKETS in wanted.value)
        names = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[0][f] for f in names], pa.int64()), pa.array([counts[1][f] for f in names], pa.int64())], ["feature", "n0", "n1"])

    by_feature = rows.mapInArrow(exact, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    strong = by_feature.where("n1 > 2").orderBy(F.desc(F.col("n1") / (F.col("n0") + 1)), F.desc("n1"), "feature").limit(4 * TELLING).collect()
    for r in strong:
        weight, kind = odds(r["n0"], r["n1"]), "beginning" if r["feature"].endswith("-") else "word"
        if weight >= LEAST_WEIGHT and likelihood_ratio(r["n0"], r["n1"], share) >= LEAST_RATIO[kind]:
            model.weights[r["feature"]] = weight
    fitted = spark.sparkContext.broadcast(model)

    def evidence(batches):
        for b in batches:
            restorer = Restorer(fitted.value.characters)
            x = [fitted.value.evidence(restorer.words(t)) for t in each(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), b.column(1).cast(pa.int32())], ["x", "y"])

    seen = rows.mapInArrow(evidence, "x double, y int").collect()  # two numbers for each training row
    x, y = np.sqrt(np.maximum([r["x"] for r in seen], 0)), np.array([r["y"] for r in seen], float)
    theta = np.zeros(2)
    design = np.column_stack([x, np.ones_like(x)])
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        grad = design.T @ (p - y) + 0.01 * theta
        theta -= np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag([0.01, 0.01]), grad)
    model.scale, model.bias = map(float, theta)
    return model


def likelihood(spark: SparkSession, model: Model):
    """A function of a text column: the score of each text. Only texts go to Python, and only scores come back."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restorer = Restorer(held.value.characters)
        for column in columns:
            yield pa.array([held.value.score(held.value.evidence(restorer.words(t))) for t in each(column)], pa.float64())

    return scores


def score(docs: DataFrame, model: Model, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """docs with a score and a prediction in the columns named; a null or empty text has no evidence."""
    found = docs.withColumn(score, likelihood(docs.sparkSession, model)("text"))
    return found.withColumn(predicted, (F.col(score) >= THRESHOLD).cast("int"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", in_held_out_fold().alias("held_out"), "score", "predicted")


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLES: dict[str, str] = {}
