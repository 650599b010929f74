"""Best-fit packing of token pieces into sequences, by large-item matching."""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arpent.llm._shared import numbered, read, saved

CAPACITY = 2048

#: Words that a worker remembers before it starts anew; text that it cuts into words at once.
REMEMBERED, SLICE_CHARS = 600_000, 2_000_000


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Bins for so many items of each length, as (number of bins, lengths in each).

    Items of over a third of the capacity come first, longest first; each takes as partner the longest one left that
    fits, so a bin has two of them at most. Shorter items then go, longest first, to the bin with the least gap that
    holds them, or to a new bin. Only counts by length are handled, so the work depends on the capacity alone.
    """
    left = {n: c for n, c in counts.items() if c}
    large = sorted(n for n in left if 3 * n > capacity)
    gaps: dict[int, list[tuple[int, list[int]]]] = {}
    order: list[int] = []

    def put(bins: int, items: list[int]) -> None:
        gap = capacity - sum(items)
        if gap not in gaps:
            gaps[gap] = []
            insort(order, gap)
        gaps[gap].append((bins, items))

    while large:
        n = large[-1]
        at = bisect_left(large, capacity - n + 1) - 1
        if at < 0:
            put(left.pop(n), [n])
            large.pop()
            continue
        m = large[at]
        bins = left[n] // 2 if m == n else min(left[n], left[m])
        if bins:
            put(bins, [n, m])
        left[n] -= bins
        left[m] -= bins
        if m == n and left[n]:
            put(1, [n])  # the odd one out: all that fits beside it is as long or shorter, and comes next
            left[n] = 0
            if at and left[large[at - 1]]:
                gaps[capacity - n].pop()
                put(1, [n, large[at - 1]])
                left[large[at - 1]] -= 1
        large = [x for x in large if left.get(x)]
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[n]
        while todo:
            at = bisect_left(order, n)
            while at < len(order) and not gaps[order[at]]:
                at += 1
            if at == len(order):
                each = capacity // n
                bins, rest = divmod(todo, each)
                if bins:
                    put(bins, [n] * each)
                if rest:
                    put(1, [n] * rest)
                break
            gap = order[at]
            bins, items = gaps[gap].pop()
            each = gap // n
            full, rest = min(bins, todo // each), 0
            todo -= full * each
            if full:
                put(full, items + [n] * each)
            if full < bins:
                if todo < each:
                    rest, todo = todo, 0
                if rest:
                    put(1, items + [n] * rest)
                if bins - full - (rest > 0):
                    put(bins - full - (rest > 0), items)
    return [b for g in order for b in gaps[g]]


def places(bins: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, sequence of the first, offset) for runs of items of one length."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for n_bins, items in bins:
        at = 0
        for n in items:
            first = used.get(n, 0)
            out.append((n, first, first + n_bins, sequence, at))
            used[n] = first + n_bins
            at += n
        sequence += n_bins
    return out


def is_letters(word: str) -> bool:
    """Letters only, composed and in lower case too, so that the tokenizer's normal form keeps them letters."""
    return word.isalpha() and (word.isascii() or (unicodedata.is_normalized("NFC", word) and word.lower().isalpha()))


class Words:
    """A worker's tokenizer and the ids, as bytes, of the words that it has met."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_str(definition), {}
        self.suffix = json.loads(definition)["model"].get("end_of_word_suffix") or ""
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = bool(self.suffix) and token.endswith(self.suffix)

    def cut(self, text: str | None) -> list[str]:
        """Words between spaces, tabs and line ends; texts of Latin-1 letters only are lower-cased, as the tokenizer does."""
        text = text or ""
        if "<|" not in text:  # names of special tokens keep their case
            try:
                text.isascii() or text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        text = text.replace("\n", " ")
        if "\t" in text or "\r" in text:
            text = text.replace("\t", " ").replace("\r", " ")
        return text.split(" ")

    def learn(self, new: list[str]) -> None:
        """Ids of new words. A run of letters before stops and commas is a token run of its own, and is encoded once."""
        cores = {w: c if is_letters(c := w.rstrip(".,")) else "" for w in new}
        plain = [c for c in dict.fromkeys(cores.values()) if c and c not in self.known]
        for a in range(0, len(plain), 20_000):
            self._letters(plain[a : a + 20_000])
        odd = list(dict.fromkeys(x for w, c in cores.items() for x in ((w[len(c) :],) if c else (w,)) if x not in self.known))
        for a in range(0, len(odd), 20_000):
            self._each(odd[a : a + 20_000])
        self.known.update((w, self.known[c] + self.known[w[len(c) :]]) for w, c in cores.items() if c and c != w)

    def _each(self, words: list[str]) -> None:
        self.known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True))

    def _letters(self, words: list[str], together: int = 200) -> None:
        """Many words in one call; tokens that end a word part their ids."""
        lots = [words[a : a + together] for a in range(0, len(words), together)]
        for lot, e in zip(lots, self.tokenizer.encode_batch_fast([" ".join(x) for x in lots], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(lot):
                self._each(lot)
                continue
            flat, at = ids.tobytes(), 0
            for w, stop in zip(lot, stops.tolist(), strict=True):
                self.known[w] = flat[4 * at : 4 * stop]
                at = stop

    def ids(self, texts: list[str | None]):
        part, size = [], 0
        for i, t in enumerate(texts):
            part.append(self.cut(t))
            size += len(t or "")
            if size > SLICE_CHARS or i == len(texts) - 1:
                every, known = set().union(*part), self.known
                new = [w for w in every if w not in known]
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = list(every)
                self.learn(new)
                for words in part:
                    yield b"".join([known[w] for w in words])
                part, size = [], 0


_WORDS: dict[int, Words] = {}


def words_of(held: Broadcast) -> Words:
    """This worker's tokenizer; it stays for later partitions."""
    key = zlib.crc32(held.value.encode())
    if key not in _WORDS:
        _WORDS[key] = Words(held.value)
    return _WORDS[key]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each text and an end id, cut only where over the capacity.

    The tokenizer drops white space and joins nothing across it, so a text's ids are those of its words between
    spaces, tabs and line ends; each distinct word of a worker is tokenized once. Null text: the end id alone.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        words = words_of(held)
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, ids in zip(b.column(0).to_pylist(), words.ids(b.column(1).to_pylist()), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at : at + 4 * capacity]
                    for column, x in zip(out, (doc, k, at // 4, len(piece) // 4, zlib.crc32(piece)), strict=True):
                        column.append(x)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset. The driver sees one count per length; pieces take places by rank in their length.

    Every length from 1 to the capacity is handled; an empty table gives no rows.
    """
    pieces = saved(pieces.withColumn("_tie", F.xxhash64("doc_id", "piece", "ids_crc32")), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = places(pack_counts(counts, capacity)) or [(-1, 0, 0, 0, 0)]
    table = pieces.sparkSession.createDataFrame(runs, "length long, _from long, _to long, _first long, offset long")
    ranked = numbered(pieces, "length", ["_tie", "doc_id", "piece", "ids_crc32"], "_rank")
    placed = ranked.join(F.broadcast(table), (ranked["length"] == table["length"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))).drop(table["length"])
    return placed.withColumn("sequence_id", F.col("_first") + F.col("_rank") - F.col("_from")).drop("_tie", "_rank", "_from", "_to", "_first")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return pack(token_pieces(docs, tokenizer_path)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


QUERIES = {"op9_best_fit_packing": op9_best_fit_packing}
ORACLES: dict[str, str] = {}
