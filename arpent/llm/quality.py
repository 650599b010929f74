"""Document quality: a linear-chain conditional random field marks every line good or bad, and its marginals make a score.

Only documents have labels. A document is taken to be good if all its lines are, so with Z the sum over all labellings and
1 the weight of the all-good one, a good document has the chance 1 / Z and a bad one 1 - 1 / Z; the weights are the
likeliest ones under a small ridge. A document's quality is the mean of its lines' marginals of being good, weighted by
length, and a logistic curve over its log-odds gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arpent.llm._shared import read, saved, small
from arpent.llm.hashing import lots, span_hashes, word_spans

#: The model is fitted on about this many labelled rows at most, chosen by a hash of their id.
TRAINING_ROWS = 20_000

#: Tasks of a round of the fit, and rounds.
TASKS, ROUNDS = 12, 30

RIDGE = 0.3

THRESHOLD = 0.3

#: A statistic of a line is one of BINS values; shares by these upper ends. One more value stands for no neighbour.
BINS = 8
SHARES = np.array([0.005, 0.03, 0.08, 0.2, 0.4, 0.65, 0.9])
STATS = ("marks", "digits", "capitals", "bare", "again", "repeated", "length", "short", "tails", "words", "end", "begin", "doubled")
SELF, BEFORE, AFTER = range(3)
WEIGHTS = 3 * len(STATS) * (BINS + 1)
SIZE = WEIGHTS + 4  # bias, and good to bad, bad to good, bad to bad

_BYTE = np.arange(256)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_CAPITAL = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _CAPITAL | (_BYTE >= 97) & (_BYTE <= 122) | (_BYTE >= 0xC0)  # of other letters the first byte
_MARK = (_BYTE > 32) & (_BYTE < 127) & ~_DIGIT & ~_LETTER


def line_statistics(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(values, weights, counts, spans) of all lines with words of many texts: their statistics as BINS values, their
    lengths in characters, the number of lines of each text, and where they begin and end in data."""
    starts, ends = word_spans(data, edges)
    n = len(edges) - 1
    if not len(starts):
        return np.zeros((0, len(STATS)), np.uint8), np.zeros(0), np.zeros(n, np.int64), np.zeros((0, 2), np.int64)
    letter, digit, mark, capital = _LETTER[data], _DIGIT[data], _MARK[data], _CAPITAL[data]
    capital[:-1] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    doubled = np.zeros(len(data), bool)
    doubled[1:] = mark[1:] & (data[1:] == data[:-1])

    def per_word(mask: np.ndarray) -> np.ndarray:
        held = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return held[ends] - held[starts]

    letters, digits, marks, capitals, twice = map(per_word, (letter, digit, mark, capital, doubled))
    size = letters + digits + marks
    text = np.searchsorted(edges, starts, "right") - 1
    key = np.cumsum(data == 10, dtype=np.int32)[starts] + text
    first = np.flatnonzero(np.diff(key, prepend=-1))
    line = np.repeat(np.arange(len(first)), np.diff(first, append=len(key)))
    last = np.append(first[1:], len(key)) - 1
    total = lambda x: np.add.reduceat(x.astype(np.int64), first)
    hashes = span_hashes(data, starts, ends)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((hashes, line))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1])
    words, chars = last - first + 1, np.maximum(1, total(size))
    share = lambda x, of: np.digitize(x / of, SHARES)
    before_end = np.maximum(ends - 2, starts)
    closing, opening = data[ends[last] - 1], data[starts[first]]
    values = np.stack([
        share(total(marks), chars), share(total(digits), chars), share(total(capitals), np.maximum(1, total(letters))), share(total(letters + digits == 0), words), share(total(again), words), share(words - np.add.reduceat(new.astype(np.int64), first), words),
        np.minimum(BINS - 1, chars // (2 * words)), share(total(size <= 3), words), share(total(mark[ends - 1] & mark[before_end] & (size > 2)), words), np.minimum(BINS - 1, np.log2(words).astype(int)),
        np.select([closing == 46, _MARK[closing], _DIGIT[closing]], [1, 2, 3], 0), np.select([capital[starts[first]], _MARK[opening], _DIGIT[opening]], [1, 2, 3], 0), share(total(twice), chars),
    ], axis=1).astype(np.uint8)
    return values, chars.astype(float), np.bincount(text[first], minlength=n), np.stack([starts[first], ends[last]], axis=1)


def neighbours(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of the features of each line: its own values, those of the line before and those of the line after."""
    edges = np.cumsum(counts)
    before, after = np.full_like(values, BINS), np.full_like(values, BINS)
    before[1:], after[:-1] = values[:-1], values[1:]
    before[(edges - counts)[counts > 0]], after[edges[counts > 0] - 1] = BINS, BINS
    base = np.arange(len(STATS)) * (BINS + 1)
    return np.concatenate([part.astype(np.int64) + base + k * len(STATS) * (BINS + 1) for k, part in enumerate((values, before, after))], axis=1)


@dataclass
class Chains:
    """Sums over all labellings of the lines of many texts: good lines weigh 1, bad ones exp(score)."""

    log_z: np.ndarray  # of each text
    bad: np.ndarray  # marginal of each line
    pairs: np.ndarray  # (text's first line aside) each line: good-bad, bad-good, bad-bad with the line before


def forward_backward(score: np.ndarray, counts: np.ndarray, change: np.ndarray) -> Chains:
    """change: scores of good-bad, bad-good and bad-bad neighbours. All texts move on by one line at a time."""
    edges = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    begins, lengths = edges[order], counts[order]
    gb, bg, bb = change
    fore, back = np.zeros((len(score), 2)), np.zeros((len(score), 2))
    longest = int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(1, longest + 1), "right")  # texts of more than t lines
    for t in range(longest):
        at = begins[: alive[t]] + t
        fore[at, 1] = score[at]
        if t:
            g, b = fore[at - 1, 0], fore[at - 1, 1]
            fore[at, 0] = np.logaddexp(g, b + bg)
            fore[at, 1] += np.logaddexp(g + gb, b + bb)
    for t in range(longest - 2, -1, -1):
        at = begins[: alive[t + 1]] + t
        g, b = back[at + 1, 0], back[at + 1, 1] + score[at + 1]
        back[at, 0], back[at, 1] = np.logaddexp(g, b + gb), np.logaddexp(g + bg, b + bb)
    log_z = np.zeros(len(counts))
    held = counts > 0
    log_z[held] = np.logaddexp(*fore[(edges + counts - 1)[held]].T)
    of = np.repeat(np.arange(len(counts)), counts)
    bad = np.exp(np.minimum(0.0, fore[:, 1] + back[:, 1] - log_z[of]))
    pairs = np.zeros((len(score), 3))
    inner = np.ones(len(score), bool)
    inner[edges[held]] = False
    at = np.flatnonzero(inner)
    for k, (left, right, c) in enumerate(((0, 1, gb), (1, 0, bg), (1, 1, bb))):
        pairs[at, k] = np.exp(np.minimum(0.0, fore[at - 1, left] + c + (score[at] if right else 0) + back[at, right] - log_z[of[at]]))
    return Chains(log_z, bad, pairs)


def scores_of(theta: np.ndarray, places: np.ndarray) -> np.ndarray:
    return theta[places].sum(axis=1) + theta[WEIGHTS]


def loss_and_gradient(theta: np.ndarray, values: np.ndarray, counts: np.ndarray, good: np.ndarray) -> tuple[float, np.ndarray]:
    """Minus the log-likelihood of the texts' labels, and its gradient; texts without lines say nothing."""
    places = neighbours(values, counts)
    chains = forward_backward(scores_of(theta, places), counts, theta[WEIGHTS + 1 :])
    z = np.maximum(chains.log_z, 1e-12)
    bad_loss = -np.log(-np.expm1(-z))
    held = counts > 0
    loss = float(np.where(good, z, bad_loss)[held].sum())
    pull = np.where(good, 1.0, -1 / np.expm1(np.minimum(z, 700.0)))
    each = np.repeat(pull, counts)
    gradient = np.zeros(SIZE)
    line = each * chains.bad
    gradient[:WEIGHTS] = np.bincount(places.ravel(), np.repeat(line, places.shape[1]), WEIGHTS)
    gradient[WEIGHTS] = line.sum()
    gradient[WEIGHTS + 1 :] = (each[:, None] * chains.pairs).sum(axis=0)
    return loss, gradient


def minimise(f, theta: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Quasi-Newton steps from the last few gradients, each halved until the loss falls."""
    value, gradient = f(theta)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, held = gradient.copy(), []
        for s, y in reversed(steps):
            a = (s @ q) / (s @ y)
            q -= a * y
            held.append(a)
        q *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(1.0, np.linalg.norm(gradient))
        for (s, y), a in zip(steps, reversed(held), strict=True):
            q += (a - (y @ q) / (s @ y)) * s
        size = 1.0
        while size > 1e-4:
            new = theta - size * q
            new_value, new_gradient = f(new)
            if new_value <= value - 1e-4 * size * (gradient @ q):
                break
            size /= 4
        else:
            break
        if (new - theta) @ (new_gradient - gradient) > 1e-10:
            steps = [*steps, (new - theta, new_gradient - gradient)][-memory:]
        done = value - new_value < 1e-5 * abs(value)
        theta, value, gradient = new, new_value, new_gradient
        if done:
            break
    return theta


def odds(quality: np.ndarray) -> np.ndarray:
    """Log-odds of a mean marginal, which tell a text with a few bad lines from one with none."""
    q = np.clip(quality, 0.0, 1.0)
    return np.log((q + 1e-3) / (1 - q + 1e-3))


@dataclass
class Model:
    theta: np.ndarray
    scale: float = 1.0
    bias: float = 0.0
    empty: float = 0.5

    def good_lines(self, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The marginal of being good of each line."""
        return 1 - forward_backward(scores_of(self.theta, neighbours(values, counts)), counts, self.theta[WEIGHTS + 1 :]).bad

    def quality(self, values: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of the lines of each text; -1 for a text without lines."""
        of = np.repeat(np.arange(len(counts)), counts)
        good = np.bincount(of, weights * self.good_lines(values, counts), len(counts))
        return np.where(counts > 0, good / np.maximum(np.bincount(of, weights, len(counts)), 1e-9), -1.0)

    def score(self, quality: np.ndarray) -> np.ndarray:
        return np.where(quality < 0, self.empty, 1 / (1 + np.exp(-np.clip(self.scale * odds(quality) + self.bias, -30, 30))))


def in_held_out_fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """(text, quality) of about TRAINING_ROWS labelled rows at most outside the held-out fold; ids' labels are their least."""
    held = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~in_held_out_fold()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, TRAINING_ROWS / max(1, held.count()))
    chosen = held.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return docs.select("doc_id", text).join(small(chosen, 2 * TRAINING_ROWS), "doc_id").select(text, "quality")


def statistics(rows: DataFrame) -> DataFrame:
    """(values, weights, counts, good): line statistics of lots of texts of rows (text, label)."""

    def run(batches):
        for b in batches:
            label = np.array(b.column(1).to_pylist()) > 0
            for first, after, data, edges in lots(b.column(0)):
                values, weights, counts, _ = line_statistics(data, edges)
                parts = values.tobytes(), weights.tobytes(), counts.astype("<i8").tobytes(), label[first:after].astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["values", "weights", "counts", "good"])

    return rows.mapInArrow(run, "values binary, weights binary, counts binary, good binary")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    for b in batches:
        for values, weights, counts, good in zip(*[c.to_pylist() for c in b.columns], strict=True):
            yield np.frombuffer(values, np.uint8).reshape(-1, len(STATS)), np.frombuffer(weights), np.frombuffer(counts, "<i8"), np.frombuffer(good, np.uint8) > 0


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """Weights of the field from the labels of training rows, then the curve from quality to score.

    Each evaluation of the loss is one job over the training rows' statistics, of which each task returns one gradient.
    Without rows of both labels nothing is learned, and every score is the share of good rows, evened out by one of each.
    """
    rows = training_rows(docs, labels, text)
    held = saved(statistics(rows.repartition(TASKS)).coalesce(TASKS), "line-statistics")
    spark = docs.sparkSession

    def evaluate(theta: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches):
            loss, gradient = 0.0, np.zeros(SIZE)
            for values, _, counts, good in _parts(batches):
                more, g = loss_and_gradient(theta, values, counts, good)
                loss, gradient = loss + more, gradient + g
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([gradient.tobytes()], pa.binary())], ["loss", "gradient"])

        parts = held.mapInArrow(run, "loss double, gradient binary").collect()  # one row a task
        loss = sum(p["loss"] for p in parts) + RIDGE / 2 * float(theta @ theta)
        return loss, sum((np.frombuffer(p["gradient"]) for p in parts), RIDGE * theta)

    def seen(model: Model) -> tuple[np.ndarray, np.ndarray]:
        def run(batches):
            for values, weights, counts, good in _parts(batches):
                yield pa.RecordBatch.from_arrays([pa.array(model.quality(values, weights, counts)), pa.array(good.astype(np.int32))], ["x", "y"])

        found = held.mapInArrow(run, "x double, y int").toPandas()  # two numbers for each training row
        return found["x"].to_numpy(), found["y"].to_numpy(float)

    start = np.zeros(SIZE)
    start[WEIGHTS] = -2.0
    model = Model(start)
    x, y = seen(model)
    prior = (y.sum() + 1) / (len(y) + 2)
    if not 0 < y.sum() < len(y):
        return Model(start, 0.0, float(np.log(prior / (1 - prior))), prior)
    model.theta = minimise(evaluate, start, ROUNDS)
    x, y = seen(model)
    none = x < 0
    model.empty = float((y[none].sum() + prior) / (none.sum() + 1))
    model.scale, model.bias = curve(odds(x[~none]), y[~none])
    return model


def curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and bias of a logistic curve, by Newton steps with a small ridge."""
    theta, design = np.zeros(2), np.column_stack([x, np.ones_like(x)])
    value = lambda t: float(np.logaddexp(0, design @ t).sum() - y @ (design @ t) + 0.005 * (t @ t))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2), design.T @ (p - y) + 0.01 * theta)
        size = 1.0
        while size > 1e-6 and value(theta - size * step) > value(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def quality_score(spark: SparkSession, model: Model):
    """A function of a text column: the score of each text. Only texts go to Python, and only scores come back."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [np.zeros(0)]
            for _, _, data, edges in lots(column):
                values, weights, counts, _ = line_statistics(data, edges)
                parts.append(held.value.score(held.value.quality(values, weights, counts)))
            yield pa.array(np.concatenate(parts), pa.float64())

    return scores


def score(docs: DataFrame, model: Model, score: str = "score", predicted: str = "predicted", text: str = "text") -> DataFrame:
    """docs with a score and a prediction in the columns named, other columns as they are.

    A null or empty text, or one of white space, has no line and the score of such training rows.
    """
    found = docs.withColumn(score, quality_score(docs.sparkSession, model)(text))
    return found.withColumn(predicted, (F.col(score) >= THRESHOLD).cast("int"))


def label_lines(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, line, from, to, good): each line with words of each text, the bytes of UTF-8 that it takes, its marginal of being good."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for first, _, data, edges in lots(b.column(1)):
                values, _, counts, spans = line_statistics(data, edges)
                of = np.repeat(np.arange(len(counts)), counts)
                line = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
                columns = [b.column(0).take(pa.array(of + first)), pa.array(line.astype(np.int32)), *[pa.array((spans[:, k] - edges[of]).astype(np.int64)) for k in (0, 1)], pa.array(held.value.good_lines(values, counts))]
                yield pa.RecordBatch.from_arrays(columns, [id, "line", "from", "to", "good"])

    return docs.select(id, text).mapInArrow(run, f"{id} {docs.schema[id].dataType.simpleString()}, line int, `from` long, `to` long, good double")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", in_held_out_fold().alias("held_out"), "score", "predicted")


QUERIES = {"op13_quality": op13_quality}
ORACLES: dict[str, str] = {}
