"""Cross-tokenizer alignment: tokens of two tokenizers over the same bytes, cut into the smallest groups that both agree on.

Every token points to the token of the other tokenizer that reaches farthest to the right among those that overlap it; where
both end at one byte, to the first tokenizer's. Following the pointers leads to the last token of a group, and doubling
them (each token takes its target's target) leads there in as many rounds as the logarithm of the longest chain.
"""

from __future__ import annotations

import hashlib
import math
import os

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arpent.llm._shared import read, saved
from arpent.llm.hashing import lots

#: Characters after which a long text is parted at the next space after another character, which changes no token.
PART = 1 << 16

#: Characters outside of blocks whose letters and numbers have long been settled.
UNUSUAL = regex.compile(r"[^\u0000-\u052F\u2000-\u206F]")

WORD = regex.compile(public_tokenizers.PATTERN)

#: Most different words that a worker keeps, about.
WORDS = 1 << 19

#: UTF-8 bytes of texts that are encoded together, and codes of links that are handled together.
LOT, LINKS = 1 << 20, 1 << 21

#: Most id pairs of a bucket of counts, about.
BUCKET = 1 << 15

LOWER_BLOCK = "▁"  # U+2581, a space in the pieces


def letter_bytes() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Words:
    """Token ids of different words, each encoded once, and whether their bytes are the word's (after what goes before it);
    cleared when it has grown beyond a bound."""

    def __init__(self, encode, raw: list[bytes], before: str = ""):
        self.encode, self.raw, self.before = encode, raw, before
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.int64), 0
        self.begin, self.count, self.whole = [], [], []

    def numbers(self, words: list[str]) -> np.ndarray:
        new = list(dict.fromkeys(w for w in words if w not in self.number))
        for word, ids in zip(new, self.encode(new), strict=True) if new else ():
            self.number[word] = len(self.begin)
            self.begin.append(self.used)
            self.count.append(len(ids))
            self.whole.append(b"".join(map(self.raw.__getitem__, ids)) == (self.before + word).encode())
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def tokens(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all the words in order, number of each word's)."""
        begin, count = np.array(self.begin, np.int64)[numbers], np.array(self.count, np.int64)[numbers]
        return self.ids[np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())], count


class Tokenizers:
    """Both tokenizers of a worker with the bytes of each id.

    No token of the first crosses a match of its pattern, none of the second a space after another character, so texts
    are encoded word by word, and each different word once. Where the pattern's letter classes may depend on the Unicode
    version, or spaces stand together, longer parts take the place of words.
    """

    _held: dict[tuple[str, str], Tokenizers] = {}

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        first, second = Tokenizer.from_file(a), SentencePieceProcessor(model_file=b)
        first.encode_special_tokens = True
        of, names = letter_bytes(), {i: t for t, i in first.get_vocab().items()}
        self.n_a, self.n_b = max(names) + 1, second.vocab_size()
        bytes_a = [bytes(of[c] for c in names[i]) if i in names and all(c in of for c in names[i]) else b"" for i in range(self.n_a)]
        pieces = [second.id_to_piece(i) for i in range(self.n_b)]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace(LOWER_BLOCK, " ").encode() for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (bytes_a, bytes_b))
        # a token with what stands after it: within the group and side, after the first side, after the group
        self.text_a = np.array([f"{i}{s}" for s in ",|" for i in range(self.n_a)], object)
        self.text_b = np.array([f"{i}{s}" for s in ",;" for i in range(self.n_b)], object)
        self.parts = all(LOWER_BLOCK not in p.lstrip(LOWER_BLOCK) for p in pieces)
        self.words_a = Words(lambda words: [e.ids for e in first.encode_batch_fast(words, add_special_tokens=False)], bytes_a)
        self.words_b = Words(lambda words: second.encode(words, num_threads=1), bytes_b, " ")

    @classmethod
    def at(cls, a: str, b: str) -> Tokenizers:
        if (a, b) not in cls._held:
            cls._held[a, b] = cls(a, b)
        return cls._held[a, b]

    def cut(self, text: str) -> list[str]:
        """Parts of the text; each starts anew as a text of its own, as it begins after a space, which both put before it."""
        out, begin = [], 0
        while self.parts and len(text) - begin > PART:
            at = begin + PART
            while (at := text.find(" ", at)) > 0 and text[at - 1].isspace():
                at += 1
            if at < 0:
                break
            out.append(text[begin:at])
            begin = at + 1
        return [*out, text[begin:]]

    def split(self, text: str) -> tuple[list[str], list[str]]:
        """Words of a text for each side; the first's begin with the space before the text, the second adds it to each."""
        parts = self.cut(text)
        plain = self.parts and "  " not in text and text[0] != " " and text[-1] != " "
        return [" " + p for p in parts] if UNUSUAL.search(text) else WORD.findall(" " + text), text.split(" ") if plain else parts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(texts that are whole on both sides, then ids and the number of each text's for each side)."""
        both = [self.split(t) for t in texts]
        sides, good = [], np.ones(len(texts), bool)
        for k, words in enumerate((self.words_a, self.words_b)):
            if len(words.begin) > WORDS or words.used > 8 * WORDS:
                words.clear()
            counts = np.array([len(b[k]) for b in both])
            numbers = words.numbers([w for b in both for w in b[k]])
            text = np.repeat(np.arange(len(texts)), counts)
            good[text[~np.array(words.whole, bool)[numbers]]] = False
            sides.append((words, numbers, text))
        out = [np.flatnonzero(good)]
        for words, numbers, text in sides:
            ids, count = words.tokens(numbers[good[text]])
            out += [ids, np.bincount(text[good[text]], count, len(texts)).astype(np.int64)[good]]
        return tuple(out)


def group_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(group of each token of A, of B, number of groups), groups in order from 0, by pointer doubling.

    ends: where tokens end, in order; both tokenizers end at the same last byte.
    """
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the token of B over A's last byte, which is the farthest that overlaps it
    to = np.concatenate([np.where(ends_b[over_a] > ends_a, n + over_a, np.arange(n)), np.searchsorted(ends_a, ends_b)])
    last = to[:n] == np.arange(n)
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    rank = np.cumsum(last) - 1
    group = rank[to]
    return group[:n], group[n:], int(last.sum())


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, last byte + 1) of each overlap: one for each stretch between ends of either."""
    both = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    ends = both[np.append(both[1:] != both[:-1], True)]
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends), ends


def aligned_lot(texts: list[str | None], t: Tokenizers, digest: bool) -> dict[str, list]:
    """Figures of each text, its groups as text or their digest, and its distinct links with their numbers."""
    n = len(texts)
    out: dict[str, list] = {k: [0] * n for k in ("n_a", "n_b", "n_groups", "n_links")} | {k: [empty] * n for k, empty in (("groups", ""), ("codes", b""), ("times", b""))}
    places: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        if text:
            places.setdefault(text, []).append(i)
    different = list(places)
    if not different:
        return out
    held, ids_a, count_a, ids_b, count_b = t.encode(different)
    if not len(held):
        return out
    ends_a, ends_b = np.cumsum(t.length_a[ids_a]), np.cumsum(t.length_b[ids_b])
    group_a, group_b, groups = group_labels(ends_a, ends_b)
    edge_a, edge_b = np.cumsum(count_a), np.cumsum(count_b)
    group_edge = group_a[edge_a - 1] + 1  # texts end where both tokenizers do, so every group is in one text
    in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
    written = np.empty(len(ids_a) + len(ids_b), object)
    tail_a, tail_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    tail_a[upto_a - 1], tail_b[upto_b - 1] = 1, 1
    written[np.arange(len(ids_a)) + (upto_b - in_b)[group_a]] = t.text_a[ids_a + tail_a * t.n_a]
    written[np.arange(len(ids_b)) + upto_a[group_b]] = t.text_b[ids_b + tail_b * t.n_b]
    of_a, of_b, ends = links(ends_a, ends_b)
    link_edge = np.searchsorted(ends, ends_a[edge_a - 1], "right")
    doc = np.repeat(np.arange(len(held)), np.diff(link_edge, prepend=0)).astype(np.uint64)
    size = np.uint64(t.n_a * t.n_b)
    key, times = np.unique(doc * size + (ids_a[of_a] * t.n_b + ids_b[of_b]).astype(np.uint64), return_counts=True)
    code_edge = np.searchsorted(key // size, np.arange(len(held) + 1, dtype=np.uint64)).tolist()
    codes = key % size
    tokens = written.tolist()
    for i, k in enumerate(held.tolist()):
        b = int(edge_a[i] + edge_b[i])
        a = b - int(count_a[i] + count_b[i])
        shown = "".join(tokens[a:b])[:-1]
        c = slice(code_edge[i], code_edge[i + 1])
        row = {
            "n_a": int(count_a[i]), "n_b": int(count_b[i]), "n_groups": int(group_edge[i] - (group_edge[i - 1] if i else 0)), "n_links": int(link_edge[i] - (link_edge[i - 1] if i else 0)),
            "groups": hashlib.sha256(shown.encode()).hexdigest() if digest else shown, "codes": codes[c].astype("<u8" if size > 1 << 32 else "<u4").tobytes(), "times": times[c].astype("<u4").tobytes(),
        }
        for at in places[different[k]]:
            for k, v in row.items():
                out[k][at] = v
    return out


def aligned(docs: DataFrame, a: str, b: str, digest: bool = False, text: str = "text") -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups, codes, times) of each row of docs; doc_id as it is, null too.

    a: file of a byte-level tokenizer, b: of a piece tokenizer. row numbers the rows, with gaps. groups is text, groups
    apart by `;`, sides by `|`, ids by `,`; or with `digest` its SHA-256. codes holds the distinct linked id pairs as
    little-endian unsigned a * (ids of b) + b in order, times the number of each. A text that is null, empty, or not the
    bytes of either side has none.
    """
    fields = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches):
        t, row = Tokenizers.at(a, b), TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, after, _, _ in lots(batch.column(1), LOT):
                texts = batch.column(1).slice(first, after - first).to_pylist()
                out = aligned_lot(texts, t, digest)
                ids = batch.column(0).slice(first, len(texts))
                columns = [pa.array(range(row, row + len(texts)), pa.int64()), ids, *[pa.array(out[f], pa.int64()) for f in fields], pa.array(out["groups"], pa.string()), *[pa.array(out[f], pa.binary()) for f in ("codes", "times")]]
                row += len(texts)
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", *fields, "groups", "codes", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(run, f"row long, doc_id {kind}, {', '.join(f'{f} long' for f in fields)}, groups string, codes binary, times binary")


def link_counts(found: DataFrame, n_b: int, width: str) -> DataFrame:
    """(code, n, top): in how many rows each id pair is linked, and whether that is the most of any pair of its first id."""

    def run(batches):
        held, size = [], 0

        def out():
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))], ["code", "n"])

        for batch in batches:
            for raw in batch.column(0).to_pylist():
                held.append(np.frombuffer(raw, width))
                size += len(held[-1])
                if size > 4 * LINKS:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    counts = saved(found.select("codes").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "pairs")
    first = F.expr(f"code div {n_b}").alias("a")
    most = counts.groupBy(first).agg(F.max("n").alias("most"))  # one row an id of the first vocabulary at most
    return counts.withColumn("a", first).join(F.broadcast(most), "a").select("code", "n", (F.col("n") == F.col("most")).alias("top"))


def link_sums(found: DataFrame, counts: DataFrame, n_b: int, width: str) -> DataFrame:
    """(row, n_best, count_sum): over the links of each row, those with the highest count of their first id, and all counts.

    Counts go into buckets of bounded size by their code. Rows' codes are cut by bucket, many rows together, and meet
    their bucket in a join, so a bucket that many rows need may be split; only two numbers a row and bucket are shuffled.
    """
    buckets = max(1, -(-counts.count() // BUCKET))
    while math.gcd(buckets, n_b) > 1:
        buckets += 1

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("code")
        columns = [table["code"].to_numpy().astype(width).tobytes(), table["n"].to_numpy().astype("<i8").tobytes(), table["top"].to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()]
        return pa.table({"bucket": pa.array([table["bucket"][0].as_py()], pa.int32())} | {k: pa.array([v], pa.binary()) for k, v in zip(("code", "n", "top"), columns, strict=True)})

    held = counts.withColumn("bucket", F.pmod("code", F.lit(buckets)).cast("int")).groupBy("bucket").applyInArrow(packed, "bucket int, code binary, n binary, top binary")

    def cut(batches):
        rows, codes, times, size = [], [], [], 0

        def out():
            each = np.array([len(c) for c in codes])
            all_codes, all_times, row = np.concatenate(codes), np.concatenate(times), np.repeat(np.array(rows, np.int64), each)
            bucket = (all_codes % np.array(buckets, all_codes.dtype)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for i in np.flatnonzero(np.diff(edges)):
                at = order[edges[i] : edges[i + 1]]
                begin = np.flatnonzero(np.diff(row[at], prepend=-1))  # rows stay together, in the order of the batch
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (row[at[begin]], begin.astype("<i8"), all_codes[at], all_times[at])]], ["bucket", "rows", "begin", "codes", "times"])

        for batch in batches:
            for row, code, time in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if code:
                    rows.append(row)
                    codes.append(np.frombuffer(code, width))
                    times.append(np.frombuffer(time, "<u4"))
                    size += len(codes[-1])
                if size > LINKS:
                    yield from out()
                    rows, codes, times, size = [], [], [], 0
        if size:
            yield from out()

    slices = found.select("row", "codes", "times").mapInArrow(cut, "bucket int, rows binary, begin binary, codes binary, times binary")

    def sums(batches):
        for batch in batches:
            for rows, begin, codes, times, code, n, top in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                at = np.searchsorted(np.frombuffer(code, width), np.frombuffer(codes, width))
                number = np.frombuffer(times, "<u4").astype(np.int64)
                best, total = (np.add.reduceat(number * np.frombuffer(x, kind)[at].astype(np.int64), np.frombuffer(begin, "<i8")) for x, kind in ((top, np.uint8), (n, "<i8")))
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(rows, "<i8")), pa.array(best), pa.array(total)], ["row", "n_best", "count_sum"])

    parts = slices.join(held.hint("merge"), "bucket").select("rows", "begin", "codes", "times", "code", "n", "top").mapInArrow(sums, "row long, n_best long, count_sum long")
    return parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def cross_alignment(docs: DataFrame, a: str, b: str, digest: bool = False, text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each row of docs.

    A link is an overlap of a token of each side. An id pair counts once for each row that holds it linked, rows of equal
    texts too; n_best sums links whose count is the highest of their first id's, ties included, count_sum all counts.
    Texts that are null, empty or not whole in either tokenizer have zeros and no groups. Extra columns are left behind.
    """
    t = Tokenizers.at(a, b)
    width = "<u8" if t.n_a * t.n_b > 1 << 32 else "<u4"
    found = saved(aligned(docs, a, b, digest, text), "aligned")
    counts = saved(link_counts(found, t.n_b, width), "counts")
    sums = link_sums(found, counts, t.n_b, width)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.drop("codes", "times").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups")


def op12_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return cross_alignment(read(spark, sf_dir, "documents"), a, b, digest=True).withColumnRenamed("groups", "groups_sha256")


QUERIES = {"op12_cross_alignment": op12_cross_alignment}
ORACLES: dict[str, str] = {}
