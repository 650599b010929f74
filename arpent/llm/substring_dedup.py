"""Substring dedup: content-defined chunks by a gear rolling hash find what repeats, windows of words settle what is cut."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arpent.llm._shared import BROADCAST_ROWS, read, saved, small
from arpent.llm.hashing import SPACE, lots, mix, span_hashes

#: The gear hash is kept modulo 2^16, so it sees the last WINDOW bytes. One place in RATE may be a cut.
WINDOW, RATE = 16, 16

#: Bytes of a chunk: no cut follows another nearer than SHORTEST, none is longer than LONGEST.
SHORTEST, LONGEST = 12, 256

#: Words of a match: only words within a window of so many that stands, one after the other, in one other document are cut.
LEAST_WORDS = 40

#: A run of repeated chunks is looked at where it has so many bytes, together with at most so many bytes on either side: a
#: passage may begin and end within a chunk, which is what the second number allows for.
RUN, MARGIN = 32, LONGEST + WINDOW

#: A word of more bytes counts as several, parted at its own cuts, so that text without spaces has windows too.
LONG_WORD = 32

GEAR = (mix(np.arange(1000, 1256, dtype=np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h = (h << 1) + GEAR[byte] modulo 2^16 at every byte, by doubling: sums over 1, 2, 4, 8 and 16 bytes."""
    h, width = GEAR[data], 1
    while width < WINDOW:
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint16(width)
        h, width = wider, 2 * width
    return h


def chosen(h: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Cuts that the bytes near them choose: places of a low hash with no such place among the SHORTEST - 1 before."""
    places = np.flatnonzero(h < 65536 // RATE) + 1
    begin = edges[np.searchsorted(edges, places, "left") - 1]
    places = places[places - begin >= WINDOW]
    if len(places):
        far = np.ones(len(places), bool)
        far[1:] = (np.diff(places) >= SHORTEST) | (np.searchsorted(edges, places[1:], "left") != np.searchsorted(edges, places[:-1], "left"))
        places = places[far]
    return places


def cuts(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends, counts): where the chunks of texts side by side end, and how many chunks each text has.

    A cut is a place that the WINDOW bytes before it choose, with no such place among the SHORTEST - 1 before. Beyond
    LONGEST bytes without one, the place of least hash is taken, the last of equal ones. So cuts depend on the bytes
    around them alone and move along when something is inserted before.
    """
    if not len(data):
        return np.empty(0, np.int64), np.zeros(len(edges) - 1, np.int64)
    h = gear_hashes(data)
    places = chosen(h, edges)
    ends = np.union1d(places, edges[1:][np.diff(edges) > 0])
    starts = np.concatenate([[0], ends[:-1]])
    extra = []
    for a, b in zip(starts[ends - starts > LONGEST].tolist(), ends[ends - starts > LONGEST].tolist(), strict=True):
        while b - a > LONGEST:
            seen = h[a + WINDOW - 1 : a + LONGEST]
            a += WINDOW + len(seen) - 1 - int(seen[::-1].argmin())
            extra.append(a)
    ends = np.union1d(ends, np.array(extra, np.int64)) if extra else ends
    return ends, np.diff(np.searchsorted(ends, edges, "right"))


def chunks(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, digests) of a text's chunks, in bytes of UTF-8."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    ends, _ = cuts(data, np.array([0, len(data)]))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    return starts, ends, span_hashes(data, starts, ends).astype(np.int64)


def document_key() -> Column:
    """doc_id, or for null ids a hash of the text above all usual ids."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62)))


def units(text: str | None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(words, starts, ends, shift): the text's words with one space between them, where they lie there, and how far before
    their places in the text. A word of more than LONG_WORD bytes is parted where its own bytes choose, between characters.
    """
    data = np.frombuffer((text or "").encode(), np.uint8)
    space = SPACE[data]
    solid = np.concatenate([[False], ~space, [False]])
    starts, ends = np.flatnonzero(solid[1:-1] & ~solid[:-2]), np.flatnonzero(solid[1:-1] & ~solid[2:]) + 1
    joined = np.cumsum(ends - starts + 1) - (ends - starts + 1)
    shift = starts - joined
    words = b" ".join((text or "").encode().split())
    starts, ends = joined, joined + (ends - starts)
    long = np.flatnonzero(ends - starts > LONG_WORD)
    if len(long):
        flat, extra = np.frombuffer(words, np.uint8), []
        h = gear_hashes(flat)
        whole = np.concatenate([(flat & 0xC0) != 0x80, [True]])  # a character begins here
        for i in long.tolist():
            places = np.flatnonzero(h[starts[i] : ends[i]] < 65536 // RATE) + 1 + starts[i]
            for _ in range(3):
                places = places + ~whole[places]
            places = np.unique(places)
            extra.append((places[(places - starts[i] >= WINDOW) & (places < ends[i])], i))
        sizes = np.ones(len(starts), np.int64)
        sizes[[i for _, i in extra]] += [len(p) for p, _ in extra]
        at = np.sort(np.concatenate([p for p, _ in extra]))
        shift = np.repeat(shift, sizes)
        starts, ends = np.sort(np.concatenate([starts, at])), np.sort(np.concatenate([ends, at]))
    return words, starts, ends, shift


def _cell(column: pa.Array, i: int) -> np.ndarray:
    """List i of a column of lists of longs; a null list is empty."""
    return column.values[column.offsets[i].as_py() : column.offsets[i + 1].as_py()].to_numpy()


def chunk_digests(docs: DataFrame) -> DataFrame:
    """(digest, doc) of every chunk, from (doc, text)."""

    def run(batches):
        for b in batches:
            doc = b.column(0).to_numpy()
            for i, j, data, edges in lots(b.column(1)):
                ends, counts = cuts(data, edges)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
                yield pa.RecordBatch.from_arrays([pa.array(span_hashes(data, starts, ends).astype(np.int64)), pa.array(np.repeat(doc[i:j], counts))], ["digest", "doc"])

    return docs.mapInArrow(run, "digest long, doc long")


def reach(text: str, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far a passage may go beyond the runs of repeated chunks from a to b that it causes.

    A chosen cut that a passage holds together with the bytes that choose it is a cut in either document, and chunks
    between two such cuts are the same. So a passage begins after the last chosen cut before its run, less those bytes,
    and ends before the first chosen one after it. MARGIN bounds both where cuts are rare.
    """
    data = np.frombuffer(text.encode(), np.uint8)
    sure = np.concatenate([[-MARGIN], chosen(gear_hashes(data), np.array([0, len(data)])), [len(data) + MARGIN]])
    before, after = sure[np.searchsorted(sure, a, "left") - 1], sure[np.minimum(np.searchsorted(sure, b, "right"), len(sure) - 1)]
    return np.maximum(a - MARGIN, before - WINDOW - SHORTEST), np.minimum(b + MARGIN, after)


def candidate_windows(text: str | None, marked: np.ndarray, least_words: int) -> tuple[np.ndarray, list[bytes]]:
    """(places, digests) of the windows of words around the runs of chunks whose digests are marked."""
    starts, ends, digests = chunks(text)
    hit = np.concatenate([[False], np.isin(digests, marked), [False]])
    a, b = starts[np.flatnonzero(hit[1:-1] & ~hit[:-2])], ends[np.flatnonzero(hit[1:-1] & ~hit[2:])]
    a, b = a[b - a >= RUN], b[b - a >= RUN]
    if not len(a):
        return np.empty(0, np.int32), []
    a, b = reach(text, a, b)
    words, first, last, shift = units(text)
    lo, hi = np.searchsorted(first + shift, a, "left"), np.searchsorted(last + shift, b, "right") - least_words
    wanted = np.zeros(len(first) + 2, np.int64)
    ok = hi >= lo
    np.add.at(wanted, lo[ok], 1)
    np.add.at(wanted, hi[ok] + 1, -1)
    at = np.flatnonzero(np.cumsum(wanted) > 0)
    spans = zip(first[at].tolist(), last[at + least_words - 1].tolist(), strict=True)
    return at.astype(np.int32), [hashlib.blake2b(words[x:y], digest_size=16).digest() for x, y in spans]


def word_windows(docs: DataFrame, least_words: int) -> DataFrame:
    """(doc, written, place, d0, d1): 128-bit digests of windows of words near repeated chunks, from (doc, written, text, marked)."""

    def run(batches):
        names = ["doc", "written", "place", "d0", "d1"]
        for b in batches:
            keys, held, size = [b.column(i).to_numpy() for i in (0, 1)], [], 0
            for i in range(b.num_rows):
                at, digests = candidate_windows(b.column(2)[i].as_py(), _cell(b.column(3), i), least_words)
                held.append((i, at, digests))
                size += len(at)
                if size > 100_000 or i == b.num_rows - 1:
                    pair = np.frombuffer(b"".join([x for *_, d in held for x in d]), np.int64).reshape(-1, 2)
                    row = np.repeat([x[0] for x in held], [len(x[1]) for x in held])
                    yield pa.RecordBatch.from_arrays([pa.array(k[row], pa.int64()) for k in keys] + [pa.array(np.concatenate([x[1] for x in held]), pa.int32()), pa.array(pair[:, 0]), pa.array(pair[:, 1])], names)
                    held, size = [], 0

    return docs.mapInArrow(run, "doc long, written long, place int, d0 long, d1 long")


def _shared(hashes: DataFrame, *by: str) -> DataFrame:
    """(by, keeper): the digests that more than one document has, with the least of them."""
    return hashes.groupBy(*by).agg(F.min("doc").alias("keeper"), F.max("doc").alias("other")).where("keeper <> other").select(*by, "keeper")


def exact_copies(texts: DataFrame, least_words: int) -> DataFrame:
    """(doc, written, copy_of): the documents whose text, of enough bytes for a window, a document of a smaller id has too.

    Texts are told apart by 128-bit digests; only ids and digests are shuffled, combined before that.
    """
    keyed = texts.where(F.octet_length("text") >= least_words).select("doc", "written", F.unhex(F.md5("text")).alias("whole"))
    several = keyed.groupBy("whole").agg(F.min("doc").alias("copy_of"), F.max("doc").alias("last")).where("copy_of <> last").select("whole", "copy_of")
    return keyed.join(small(saved(several, "copied-texts")), "whole").where("doc <> copy_of").select("doc", "written", "copy_of").distinct()


def _repeats(found: DataFrame, copies: DataFrame) -> DataFrame:
    """(doc, written, places, keepers, copy_of, covered): what to cut of documents, from the windows found and the copies.

    A copy has no places, as all of it goes. covered counts the places of its original that stand in still smaller
    documents, whose ids are then its keepers; the original keeps the rest.
    """
    own = found.select("doc", "written", F.transform("_both", lambda x: x["place"].cast("long")).alias("places"), F.col("_both.keeper").alias("keepers"))
    originals = copies.select(F.col("copy_of").alias("doc"), "written").distinct()
    known = own.join(small(saved(originals, "originals")), ["doc", "written"], "left_semi")
    known = saved(known.select(F.col("doc").alias("copy_of"), "written", F.array_distinct("keepers").alias("keepers"), F.size(F.array_distinct("places")).alias("covered")), "known")
    rest = copies.join(small(known), ["copy_of", "written"], "left").select("doc", "written", F.array().cast("array<long>").alias("places"), F.coalesce("keepers", F.array().cast("array<long>")).alias("keepers"), "copy_of", F.coalesce("covered", F.lit(0)).alias("covered"))
    return own.select("*", F.lit(None).cast("long").alias("copy_of"), F.lit(0).alias("covered")).unionByName(rest)


def cut_passages(text: str, places: np.ndarray, keepers: np.ndarray, least_words: int) -> tuple[str, list[tuple[int, int]], list[int]]:
    """(text left, spans cut in bytes, ids that keep them): the words that lie in windows at these places go."""
    order = np.argsort(places, kind="stable")
    places = places[order]
    _, first, last, shift = units(text)
    first, last = first + shift, last + shift
    spans = [(int(first[r[0]]), int(last[r[-1] + least_words - 1])) for r in np.split(places, np.flatnonzero(np.diff(places) > least_words) + 1)]
    return cut_spans(text, spans), spans, sorted(set(keepers.tolist()))


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    data, out, at = text.encode(), [], 0
    for start, end in spans:
        out.append(data[at:start])
        at = end
    return b"".join([*out, data[at:]]).decode()


def remove_repeats(docs: DataFrame, least_words: int = LEAST_WORDS, report: bool = False) -> DataFrame:
    """docs with passages that stand in another document cut out of their texts; the least doc_id keeps a passage.

    Texts are cut into chunks by content, and chunks grouped by digest: those of several documents are repeats. Runs of
    repeated chunks are candidates, as short chunks also repeat by chance. Around them every window of least_words words
    is grouped by a 128-bit digest, and a word is cut if it lies in a window that stands, word for word, in a document
    of a smaller id; so passages go up to their edges, and only white space may differ. A passage of 50 words has about
    ten chunks, so it is missed only where fewer than RUN bytes of it are whole chunks. Words of more than LONG_WORD bytes
    count as several.
    Texts that stand in several documents word for word are chunked once, for the least of their ids; the other documents
    are cut from their first word to their last, where there are least_words of them.
    With report, adds removed_chars, spans (start:end in bytes of the old text, comma-joined) and kept_in (the ids that
    keep the windows cut). Null and empty texts stay; rows of one id count as one document, and repeats within a
    document stay. Null ids keep a passage only among themselves.
    Documents without repeats don't pass through Python at last, nor does their text move where the others are counted
    to be few.
    """
    texts = docs.select(document_key().alias("doc"), F.xxhash64("text").alias("written"), "text").where("text IS NOT NULL")
    copies = saved(exact_copies(texts, least_words), "copies")
    once = texts.join(small(copies.select("doc", "written")), ["doc", "written"], "left_anti")
    first = chunk_digests(once.select("doc", "text"))
    marks = first.join(saved(_shared(first, "digest").select("digest"), "shared-chunks"), "digest")
    marked = saved(marks.groupBy("doc").agg(F.collect_set("digest").alias("marked")), "marked")
    if marked.count() <= BROADCAST_ROWS:  # of ids only
        once = once.join(F.broadcast(marked.select("doc")), "doc", "left_semi")
    near = saved(word_windows(once.join(marked, "doc").select("doc", "written", "text", "marked"), least_words), "windows")
    again = near.join(saved(_shared(near, "d0", "d1"), "shared-windows"), ["d0", "d1"]).where("doc <> keeper").select("doc", "written", F.struct("place", "keeper").alias("_both")).distinct()
    found = saved(again.groupBy("doc", "written").agg(F.collect_list("_both").alias("_both")), "found")
    lists = saved(_repeats(found, copies), "repeats")
    key = ["__arpent_doc", "__arpent_text"]
    lists = lists.select(F.col("doc").alias(key[0]), F.col("written").alias(key[1]), F.struct("places", "keepers", "copy_of", "covered").alias("__arpent_cut"))
    keyed = docs.withColumn(key[0], document_key()).withColumn(key[1], F.xxhash64("text"))
    extra = [T.StructField("removed_chars", T.LongType()), T.StructField("spans", T.StringType()), T.StructField("kept_in", T.ArrayType(T.LongType()))] if report else []
    keep = [c for c in docs.columns if c not in {f.name for f in extra}]
    schema = T.StructType([*[docs.schema[c] for c in keep], *extra])

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                texts, removed, spans, kept = [], [], [], []
                held = b.column("__arpent_cut")
                held = dict(zip(("places", "keepers", "copy_of", "covered"), held.flatten(), strict=True))
                for i, t in enumerate(b.column("text").to_pylist()):
                    places, keepers, original = _cell(held["places"], i), _cell(held["keepers"], i), held["copy_of"][i].as_py()
                    if original is not None:
                        places = np.arange(max(0, len(units(t)[1]) - least_words + 1))
                        keepers = keepers if len(places) <= held["covered"][i].as_py() else np.append(keepers, original)
                    left, cut, ids = cut_passages(t, places, keepers, least_words) if t and len(places) else (t, [], [])
                    texts.append(left)
                    removed.append(len(t or "") - len(left or ""))
                    spans.append(",".join(f"{x}:{y}" for x, y in cut))
                    kept.append(ids)
                columns = [pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in keep]
                columns += [pa.array(removed, pa.int64()), pa.array(spans, pa.string()), pa.array(kept, pa.list_(pa.int64()))] if report else []
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    if lists.count() <= BROADCAST_ROWS:  # of ids only
        ids = F.broadcast(lists.select(*key))
        touched = keyed.join(ids, key, "left_semi").join(lists, key)
        rest = keyed.join(ids, key, "left_anti").select(*keep)
        if report:
            rest = rest.select(*keep, F.lit(0).cast("long").alias("removed_chars"), F.lit("").alias("spans"), F.array().cast("array<long>").alias("kept_in"))
        return touched.select(*keep, "__arpent_cut").mapInArrow(run, schema).unionByName(rest)
    return keyed.join(lists, key, "left").select(*keep, "__arpent_cut").mapInArrow(run, schema)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), report=True)


QUERIES = {"op1_substring_dedup": op1_substring_dedup}
ORACLES: dict[str, str] = {}
