"""Byte-level BPE by DuckDB recursive queries per partition, and decoding by ordered aggregation."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from arpent.llm._shared import read

#: Words that a worker remembers before it starts anew, text that it cuts into words at once, bytes of words in one query.
REMEMBERED, SLICE_CHARS, QUERY_BYTES = 400_000, 2_000_000, 1_000_000

#: Words of more bytes contract in queries of their own, which take all pairs of a round at once where that is the same;
#: ROUNDS rounds a query, so that its rows stay bounded. Ids that are decoded as one sequence.
LONG_WORD, ROUNDS, SEQUENCE = 256, 48, 100_000

#: A long word is first cut wherever two bytes meet that no token holds side by side, as no merge crosses such a place. What
#: is still longer than this contracts by a heap of pairs, in time n log n and memory in proportion, and not in a query.
HEAPED = 60_000

#: A row is a token at its position with the token after it (-1: none). A round joins the live rows to the merges, takes each
#: word's leftmost pair of least rank and contracts it; a word without such a pair is passed on once more, no longer live.
CONTRACT = """
WITH RECURSIVE state(word, pos, token, after, live) AS (
  SELECT word, pos, token, after, true FROM bytes_in
  UNION ALL
  (WITH best AS (
     SELECT s.word, min(m.rank::BIGINT * 4294967296 + s.pos) AS b
     FROM state s JOIN merges m ON m.pair = s.token::BIGINT * 4294967296 + s.after
     WHERE s.live AND s.after >= 0 GROUP BY s.word),
   merged AS (
     SELECT best.word, (b % 4294967296)::INT AS spot, (b // 4294967296)::INT AS rank, r.after AS beyond
     FROM best JOIN state r ON r.word = best.word AND r.pos = b % 4294967296 + 1 WHERE r.live)
   SELECT s.word, CASE WHEN s.pos > spot THEN s.pos - 1 ELSE s.pos END,
          CASE WHEN s.pos = spot THEN rank ELSE token END,
          CASE WHEN s.pos = spot THEN beyond WHEN s.pos = spot - 1 THEN rank ELSE after END, spot IS NOT NULL
   FROM state s LEFT JOIN merged USING (word)
   WHERE s.live AND (spot IS NULL OR s.pos <> spot + 1)))
SELECT word, pos, token FROM state WHERE NOT live ORDER BY word, pos
"""

#: The same for long words: all pairs of a word's least rank contract in one round, from the left and without overlap, up to
#: the first whose new token makes a pair of lower rank with a neighbour, as that one would be next; so the result is the same.
CONTRACT_LONG = f"""
WITH RECURSIVE state(word, pos, token, live, round) AS (
  SELECT word, pos, token, true, 0 FROM bytes_in
  UNION ALL
  (WITH linked AS (
     SELECT word, pos, token, lag(token) OVER w AS before, lead(token) OVER w AS after, lead(token, 2) OVER w AS beyond, lead(pos) OVER w AS stop
     FROM state WHERE live AND round < {ROUNDS} WINDOW w AS (PARTITION BY word ORDER BY pos)),
   hits AS (
     SELECT word, pos, stop, rank, before, beyond FROM linked JOIN merges m ON m.pair = token::BIGINT * 4294967296 + after
     QUALIFY rank = min(rank) OVER (PARTITION BY word)),
   placed AS (
     SELECT *, (lag(stop) OVER (PARTITION BY word ORDER BY pos) IS DISTINCT FROM pos)::INT AS apart FROM hits),
   runs AS (SELECT *, sum(apart) OVER (PARTITION BY word ORDER BY pos) AS run FROM placed),
   taken AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY pos) % 2 = 1),
   checked AS (
     SELECT t.word, pos, stop, t.rank, coalesce(x.rank < t.rank OR y.rank < t.rank OR z.rank < t.rank, false)::INT AS lower
     FROM taken t LEFT JOIN merges x ON x.pair = before::BIGINT * 4294967296 + t.rank
     LEFT JOIN merges y ON y.pair = t.rank::BIGINT * 4294967296 + beyond
     LEFT JOIN merges z ON z.pair = t.rank::BIGINT * 4294967296 + t.rank),
   chosen AS (
     SELECT word, pos, stop, rank FROM checked
     QUALIFY coalesce(sum(lower) OVER (PARTITION BY word ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0)
   SELECT s.word, s.pos, coalesce(c.rank, s.token), s.word IN (SELECT word FROM chosen), s.round + 1
   FROM state s LEFT JOIN chosen c ON c.word = s.word AND c.pos = s.pos
   LEFT JOIN chosen gone ON gone.word = s.word AND gone.stop = s.pos
   WHERE s.live AND s.round < {ROUNDS} AND gone.word IS NULL))
SELECT word, pos, token, live FROM state WHERE NOT live OR round = {ROUNDS} ORDER BY word, pos
"""

#: vocabulary.piece has the bytes of a token in hexadecimal digits, so that pieces join as strings.
DECODE = "SELECT seq, unhex(string_agg(piece, '' ORDER BY pos)) AS decoded FROM tokens_in JOIN vocabulary USING (token) GROUP BY seq"


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) }


class Codec:
    """Encodes and decodes words, each distinct one once, with an embedded DuckDB of one thread."""

    def __init__(self, content: bytes, pattern: str):
        import duckdb
        import regex

        self.ranks, self.split = read_ranks(content), regex.compile(pattern).findall
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        pairs = [(self.ranks[t[:k]] << 32 | self.ranks[t[k:]], r) for t, r in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        pair, rank = zip(*pairs, strict=True) if pairs else ((), ())
        self.con.register("merges_in", pa.table({"pair": pa.array(pair, pa.int64()), "rank": pa.array(rank, pa.int32())}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges_in")
        self.con.register("vocabulary_in", pa.table({"token": pa.array(self.ranks.values(), pa.int32()), "piece": [t.hex() for t in self.ranks]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_in")
        self.known: dict[str, bytes] = {}
        self.pairs = dict(pairs)
        self.beside = np.zeros((256, 256), bool)  # bytes that stand side by side in a token
        for t in self.ranks:
            if len(t) > 1:
                b = np.frombuffer(t, np.uint8)
                self.beside[b[:-1], b[1:]] = True

    def contract(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit integers; long words part by part."""
        parts = [self._parts(w) if len(w) > LONG_WORD else [w] for w in words]
        if len(parts) == sum(map(len, parts)):
            return self._contract(words)
        done = iter(self._contract([p for held in parts for p in held]))
        return [b"".join([next(done) for _ in held]) for held in parts]

    def _parts(self, word: bytes) -> list[bytes]:
        b = np.frombuffer(word, np.uint8)
        at = [0, *(np.flatnonzero(~self.beside[b[:-1], b[1:]]) + 1).tolist(), len(word)]
        return [word[i:j] for i, j in zip(at, at[1:], strict=False)]

    def _heap(self, word: bytes) -> bytes:
        """The leftmost pair of least rank again and again, from a heap of rank and place; pairs that are gone are passed over."""
        token, n = self.byte[np.frombuffer(word, np.uint8)].tolist(), len(word)
        after, before, pairs = list(range(1, n + 1)), list(range(-1, n - 1)), self.pairs
        heap = [r << 32 | i for i in range(n - 1) if (r := pairs.get(token[i] << 32 | token[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            if token[i] < 0 or j >= n or pairs.get(token[i] << 32 | token[j]) != rank:
                continue
            token[i], token[j], k, h = rank, -1, after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                if (r := pairs.get(rank << 32 | token[k])) is not None:
                    heapq.heappush(heap, r << 32 | i)
            if h >= 0 and (r := pairs.get(token[h] << 32 | rank)) is not None:
                heapq.heappush(heap, r << 32 | h)
        return np.array([t for t in token if t >= 0], "<u4").tobytes()

    def _contract(self, words: list[bytes]) -> list[bytes]:
        out = [b""] * len(words)
        short, long = [], []
        for i, w in enumerate(words):
            if w in self.ranks:
                out[i] = self.ranks[w].to_bytes(4, "little")
            elif len(w) > HEAPED:
                out[i] = self._heap(w)
            else:
                (long if len(w) > LONG_WORD else short).append(i)
        for todo, way in ((short, self._short), (long, self._long)):
            if todo:
                flat, sizes = np.frombuffer(b"".join([words[i] for i in todo]), np.uint8), np.array([len(words[i]) for i in todo])
                word, token = way(np.repeat(np.arange(len(todo), dtype=np.int32), sizes), self._positions(sizes), self.byte[flat], np.cumsum(sizes) - 1)
                ids, ends, at = token.astype("<u4").tobytes(), np.cumsum(np.bincount(word, minlength=len(todo))).tolist(), 0
                for i, end in zip(todo, ends, strict=True):
                    out[i] = ids[4 * at : 4 * end]
                    at = end
        return out

    @staticmethod
    def _positions(sizes: np.ndarray) -> np.ndarray:
        return (np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)

    def _short(self, word: np.ndarray, pos: np.ndarray, token: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        after = np.append(token[1:], np.int32(-1))
        after[lasts] = -1
        self.con.register("bytes_in", pa.table({"word": word, "pos": pos, "token": token, "after": after}))
        got = self.con.sql(CONTRACT).to_arrow_table()
        return got["word"].to_numpy(), got["token"].to_numpy()

    def _long(self, word: np.ndarray, pos: np.ndarray, token: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done = []
        while len(word):
            self.con.register("bytes_in", pa.table({"word": word, "pos": pos, "token": token}))
            got = self.con.sql(CONTRACT_LONG).to_arrow_table()
            live = got["live"].to_numpy()
            columns = [got[c].to_numpy() for c in ("word", "pos", "token")]
            done.append([c[~live] for c in columns])
            word, pos, token = (c[live] for c in columns)
        word, pos, token = (np.concatenate(c) for c in zip(*done, strict=True))
        order = np.lexsort((pos, word))
        return word[order], token[order]

    def decode(self, sequences: list[bytes]) -> list[bytes]:
        """The bytes of each id sequence: rows of token positions join the vocabulary and are put together in order."""
        parts = [(i, s[a : a + 4 * SEQUENCE]) for i, s in enumerate(sequences) for a in range(0, len(s), 4 * SEQUENCE)]
        out: list[list[bytes]] = [[] for _ in sequences]
        at = 0
        while at < len(parts):
            upto, size = at, 0
            while upto < len(parts) and (upto == at or size + len(parts[upto][1]) <= 4 * 8 * SEQUENCE):
                size += len(parts[upto][1])
                upto += 1
            flat = np.frombuffer(b"".join([s for _, s in parts[at:upto]]), "<u4").astype(np.int32)
            sizes = np.array([len(s) // 4 for _, s in parts[at:upto]])
            self.con.register("tokens_in", pa.table({"seq": np.repeat(np.arange(upto - at, dtype=np.int32), sizes), "pos": np.arange(len(flat), dtype=np.int32), "token": flat}))
            got = self.con.sql(DECODE).to_arrow_table()
            for i, piece in sorted(zip(got["seq"].to_pylist(), got["decoded"].to_pylist(), strict=True)):
                out[parts[at + i][0]].append(piece)
            at = upto
        return [b"".join(x) for x in out]

    def learn(self, words: set[str]) -> None:
        """Encodes the words that are new to this worker."""
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        new, part, size = list(words), [], 0
        for i, w in enumerate(new):
            part.append(w)
            size += len(w)
            if size > QUERY_BYTES or i == len(new) - 1:
                self.known.update(zip(part, self.contract([x.encode() for x in part]), strict=True))
                part, size = [], 0

    def encoded(self, texts: list[str | None]) -> Iterator[list[bytes]]:
        """The ids of texts, as little-endian 32-bit integers, a slice of texts at a time."""
        part, size = [], 0
        for i, t in enumerate(texts):
            part.append(self.split(t or ""))
            size += len(t or "")
            if size > SLICE_CHARS or i == len(texts) - 1:
                every = set().union(*part)
                new = every - self.known.keys()
                if new:
                    if len(self.known) + len(new) > REMEMBERED:
                        new = every
                    self.learn(new)
                ids = self.known.__getitem__
                yield [b"".join(map(ids, words)) for words in part]
                part, size = [], 0


_CODECS: dict[tuple, Codec] = {}


def codec(vocabulary: Broadcast, pattern: str) -> Codec:
    """This worker's codec of a vocabulary; it stays for later partitions."""
    key = (hashlib.sha1(vocabulary.value).digest(), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(vocabulary.value, pattern)
    return _CODECS[key]


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file, read by the driver; its size doesn't depend on the data."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids array<int>): the token ids of each text; a null or empty text has none."""
    held = vocabulary(docs.sparkSession, path)

    def run(batches):
        c = codec(held, pattern)
        for b in batches:
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for part in c.encoded(b.column(1).to_pylist()) for x in part]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_column, "ids"])

    return docs.select(id_column, text).mapInArrow(run, f"{id_column} {docs.schema[id_column].dataType.simpleString()}, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """(id, decoded binary) of rows with ids array<int>; null ids give no bytes."""
    held = vocabulary(tokens.sparkSession, path)

    def run(batches):
        c = codec(held, pattern)
        for b in batches:
            out = c.decode([np.array(x or [], "<u4").tobytes() for x in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], [id_column, "decoded"])

    return tokens.select(id_column, "ids").mapInArrow(run, f"{id_column} {tokens.schema[id_column].dataType.simpleString()}, decoded binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: n_tokens, SHA-256 of its ids and SHA-256 of the bytes that the ids decode to.

    A worker contracts each distinct word of its texts once while it remembers it; a text's ids are those of its words in
    order, and every text's whole id sequence is decoded. Null text counts as empty. Rows alike give rows alike.
    """
    held = vocabulary(docs.sparkSession, path)

    def run(batches):
        c = codec(held, pattern)
        for b in batches:
            at = 0
            for part in c.encoded(b.column(1).to_pylist()):
                columns = [
                    b.column(0)[at : at + len(part)],
                    pa.array([len(x) // 4 for x in part], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in part], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in c.decode(part)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(part)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {"op6_byte_bpe": op6_byte_bpe}
ORACLES: dict[str, str] = {}
