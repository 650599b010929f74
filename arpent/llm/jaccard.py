"""N-gram Jaccard join: size-banded tiles, bitmap signatures that bound overlaps, exact intersection of sorted sets."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arpent.llm._shared import BROADCAST_ROWS, components, read, saved, small
from arpent.llm.hashing import mix, shingle_sets

#: A tile key is a pair of least hashes. Two sets of similarity J share none of the KEYS keys with chance (1 - J^2)^KEYS:
#: 1e-17 at 0.8, less than that of a clash of 64-bit hashes, on which the exact intersection rests too.
KEYS = 38

#: A size band holds sizes in a ratio of the threshold to this power.
BAND = 6

#: Rows of a block of a tile; blocks are compared two by two.
BLOCK = 1024

#: Rounds that link rows to a leader of their tile before the rows of a tile that are still apart are all compared.
STAR_ROUNDS = 4

#: Bits of a bitmap for each element, and its least and most bits.
BITS_EACH, BITMAP_MIN, BITMAP_MAX = 4, 64, 1 << 17

#: Odd factors: an order of 32-bit hashes for each.
ORDERS = (mix(np.arange(1, 2 * KEYS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def band_of(n: Column, percent: int) -> Column:
    """Size band of n elements: those of a set that may link to it lie in this band, the one above, or the one below."""
    return F.floor(F.log(n) / F.lit(BAND * math.log(100 / percent))).cast("int")


def bitmap(s: np.ndarray) -> np.ndarray:
    """A bit for each hash, in a power of two of bits of BITS_EACH times the set's size at least."""
    bits = min(BITMAP_MAX, max(BITMAP_MIN, 1 << int(BITS_EACH * max(1, len(s)) - 1).bit_length()))
    out = np.zeros(bits, np.uint8)
    out[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little")


def fold(b: np.ndarray, size: int) -> np.ndarray:
    """A bitmap in fewer bytes: bits that meet are joined by OR."""
    return np.bitwise_or.reduce(b.reshape(-1, size), axis=0) if len(b) > size else b


def bound(na: np.ndarray, nb: np.ndarray, only_a: np.ndarray, only_b: np.ndarray) -> np.ndarray:
    """Upper bound of the intersection: each bit that one alone has set is an element that the other lacks."""
    return np.minimum(na - only_a, nb - only_b)


def linked(na, nb, common, percent: int):
    """100 * intersection >= percent * union."""
    return (100 + percent) * common >= percent * (na + nb)


def tile_keys(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """KEYS keys a set: under each two orders of its hashes, the two least ones."""
    has = counts > 0
    starts, half = (np.cumsum(counts) - counts)[has], (flat >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(counts), KEYS), np.int64)
    if len(starts):
        for k in range(KEYS):
            low, high = (np.minimum.reduceat(half * f, starts).astype(np.int64) for f in ORDERS[2 * k : 2 * k + 2])
            out[has, k] = high << 32 | low
    return out


def node_of(s: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(s, digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, written, node, n, bits, keys): hash of the text, set digest as a node id, set size, bitmap and tile keys."""

    def run(batches):
        for b in batches:
            for i, j, flat, counts in shingle_sets(b.column(2)):
                ends = np.cumsum(counts)
                sets = [flat[x:y] for x, y in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                keys = tile_keys(flat, counts)
                at = np.concatenate([[0], np.cumsum(np.where(counts > 0, KEYS, 0))]).astype(np.int32)
                arrays = [
                    b.column(0)[i:j],
                    b.column(1)[i:j],
                    pa.array([node_of(s.tobytes()) for s in sets], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([bitmap(s).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(keys[counts > 0].ravel(), pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "written", "node", "n", "bits", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64(text).alias("written"), text).mapInArrow(run, f"doc_id {kind}, written long, node long, n long, bits binary, keys array<long>")


def sorted_sets(docs: DataFrame, text: str = "text") -> DataFrame:
    """(node, shingles): the sorted 64-bit shingle hashes of each text, as bytes."""

    def run(batches):
        for b in batches:
            for _, _, flat, counts in shingle_sets(b.column(0)):
                ends = np.cumsum(counts)
                sets = [flat[x:y].tobytes() for x, y in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array(sets, pa.binary())], ["node", "shingles"])

    return docs.select(text).mapInArrow(run, "node long, shingles binary")


def possible_links(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that bitmaps leave possible. pairs: a, b; nodes: node, n, bits."""

    def run(batches):
        for t in batches:
            keep = np.zeros(t.num_rows, bool)
            na, nb = (t[c].to_numpy() for c in ("na", "nb"))
            for i in range(t.num_rows):
                x, y = (np.frombuffer(t[c][i].as_buffer(), np.uint8) for c in ("ba", "bb"))
                size = min(len(x), len(y))
                x, y = fold(x, size).view(np.uint64), fold(y, size).view(np.uint64)
                keep[i] = linked(na[i], nb[i], bound(na[i], nb[i], int(np.bitwise_count(x & ~y).sum()), int(np.bitwise_count(y & ~x).sum())), percent)
            yield pa.RecordBatch.from_arrays([t["a"], t["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ba", "bb").mapInArrow(run, "a long, b long")


def exact_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, by intersecting the sorted sets whole. pairs: a, b; sets: node, shingles."""

    def run(batches):
        for t in batches:
            keep = np.zeros(t.num_rows, bool)
            for i in range(t.num_rows):
                a, b = (np.frombuffer(t[c][i].as_buffer(), np.uint64) for c in ("xa", "xb"))
                both = np.concatenate([a, b])
                both.sort()
                keep[i] = linked(len(a), len(b), int((both[1:] == both[:-1]).sum()), percent)
            yield pa.RecordBatch.from_arrays([t["a"], t["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "xa", "xb").mapInArrow(run, "a long, b long")


def distinct_tiles(rows: DataFrame) -> DataFrame:
    """rows of one tile, the least, out of those with the same rows: near texts share most of their keys."""
    mark = [F.bit_xor(F.xxhash64("node", "home", F.lit(i))).alias(f"m{i}") for i in (0, 1)]
    kept = rows.groupBy("tile").agg(F.count("*").alias("k"), *mark).groupBy("k", "m0", "m1").agg(F.min("tile").alias("tile"))
    return rows.join(kept.select("tile"), "tile", "left_semi")


def tile_pairs(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of rows of one tile, in different components, whose bitmaps leave the link possible.

    rows: tile, home, node, component, n; nodes: node, bits, which join once the rows are dealt. The rows of a tile's largest component and its other rows lie in
    blocks of about BLOCK rows, dealt by a hash. Each block of the largest component meets each block of the others, and
    those meet one another, two blocks at a time; rows of the largest component are never compared with one another. Only
    pairs within the bound leave.
    """
    by = rows.groupBy("tile", "component").agg(F.count("*").alias("k"))
    sizes = by.groupBy("tile").agg(F.max(F.struct("k", "component"))["component"].alias("major"), F.max("k").alias("most"), F.sum("k").alias("every"))
    sizes = sizes.select("tile", "major", F.ceil(F.col("most") / BLOCK).cast("int").alias("outer"), F.greatest(F.lit(1), F.ceil((F.col("every") - F.col("most")) / BLOCK)).cast("int").alias("inner"))
    dealt = rows.join(sizes, "tile").withColumn("held", F.col("component") == F.col("major")).withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("held"), F.col("outer")).otherwise(F.col("inner"))).cast("int"))
    # i < 0: block -1 - i of the largest component with block j of the others; else blocks i and j of the others
    outers, inners = F.sequence(F.lit(0), F.col("outer") - 1), F.sequence(F.lit(0), F.col("inner") - 1)
    of_major = F.transform(inners, lambda b: F.struct((-1 - F.col("own")).alias("i"), b.alias("j")))
    of_others = F.concat(F.transform(outers, lambda b: F.struct((-1 - b).alias("i"), F.col("own").alias("j"))), F.transform(inners, lambda b: F.struct(F.least("own", b).alias("i"), F.greatest("own", b).alias("j"))))
    dealt = dealt.select("*", F.inline(F.when(F.col("held"), of_major).otherwise(of_others))).drop("major", "outer", "inner").join(nodes, "node")
    columns = ["tile", "i", "j", "node", "component", "n", "home", "held", "own", "bits"]

    def compare(node, comp, n, home, held, own, bits, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        size = min(map(len, bits))
        x = np.stack([fold(np.frombuffer(b, np.uint8), size) for b in bits]).view(np.uint64)
        first, second = (np.flatnonzero(~held), np.flatnonzero(held)) if i < 0 else (np.flatnonzero(own == i), np.flatnonzero(own == j))
        found = [(np.empty(0, np.int64),) * 2]
        for k in first:
            other = second[node[second] > node[k]] if i == j else second
            other = other[(comp[other] != comp[k]) & (home[other] | home[k]) & (100 * np.minimum(n[other], n[k]) >= percent * np.maximum(n[other], n[k]))]
            if len(other):
                only_k = np.bitwise_count(x[k] & ~x[other]).sum(axis=1, dtype=np.int64)
                only_o = np.bitwise_count(x[other] & ~x[k]).sum(axis=1, dtype=np.int64)
                other = other[linked(n[k], n[other], bound(n[k], n[other], only_k, only_o), percent)]
                found.append((np.full(len(other), node[k]), node[other]))
        return tuple(np.concatenate(z) for z in zip(*found, strict=True))

    def run(batches):
        """Groups follow one another in the sorted partition; a group may run over several batches."""
        held: list[pa.RecordBatch] = []

        def pairs_of(t: pa.Table) -> pa.RecordBatch:
            tile, i, j, node, comp, n, home, held_, own = (t[c].to_numpy() for c in columns[:-1])
            bits = t["bits"].to_pylist()
            edges = np.concatenate([[0], np.flatnonzero((np.diff(tile) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1, [len(tile)]])
            found = [(np.empty(0, np.int64),) * 2]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if b - a > 1:
                    g = slice(a, b)
                    found.append(compare(node[g], comp[g], n[g], home[g], held_[g], own[g], bits[g], i[a], j[a]))
            x, y = (np.concatenate(z) for z in zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], ["a", "b"])

        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                last = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("tile", "i", "j")]
                same = np.logical_and.reduce([batch.column(c).to_numpy() == x for c, x in zip(("tile", "i", "j"), last, strict=True)])
                cut = batch.num_rows - int(same[::-1].argmin()) if not same.all() else 0
                if cut:
                    yield pairs_of(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                    held = []
                elif held and [held[-1].column(c)[-1].as_py() for c in ("tile", "i", "j")] != last:
                    yield pairs_of(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(cut))
        if held:
            yield pairs_of(pa.Table.from_batches(held))

    sorted_ = dealt.select(*columns).repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j", "node")
    return sorted_.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): connected components under links of 100 * intersection >= percent * union.

    Texts of one shingle set are one node from the start. Nodes that share a key (a pair of least shingle hashes) and lie
    in one size band, or in two that touch and near their border, share a tile. Rounds of stars then link the nodes of a
    tile that are still apart to one leader, at first the one that shares most; a component takes the label of its first
    leader's leader. What stays apart after that is compared in blocks, all with all. In either case bitmaps bound the
    overlap from above, and only what they leave is read again and its sorted sets are intersected exactly. In the end the
    links between different labels are joined to components. Pairs within a component need no test, so copies are never
    expanded into pairs. Empty sets have no links and their own id as component. Null ids take part and never become a
    component's id unless it has no other; repeated rows stay rows. A component's id reaches its rows by a join on the
    node, which adaptive execution splits where many rows have one node.
    """
    rows = saved(signatures(docs, text).withColumn("row", F.monotonically_increasing_id()), "signatures")
    reps = saved(rows.where("n > 0").groupBy("node").agg(F.min("row").alias("row")).select("row"), "node-rows")
    few = reps.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    nodes = rows.join(F.broadcast(reps) if few else reps, "row", "left_semi").select("node", "n", "written", "bits", "keys")
    nodes = nodes if few else saved(nodes, "nodes")
    # A node is at home in its own band, and a guest in the next lower one if a smaller set there may link to it; pairs of two guests meet in their own band.
    own, lower = band_of(F.col("n"), percent), band_of(F.col("n") * (percent / 100 * (1 - 1e-9)), percent)
    places = F.array(F.struct(F.lit(True).alias("home"), F.col("own").alias("band")), F.struct(F.lit(False).alias("home"), F.col("lower").alias("band")))
    keyed = nodes.select("node", "n", own.alias("own"), F.when(F.col("n") > 1, lower).otherwise(own).alias("lower"), F.posexplode("keys").alias("seed", "key"))
    keyed = keyed.select("node", "n", F.explode(F.when(F.col("lower") < F.col("own"), places).otherwise(F.slice(places, 1, 1))).alias("x"), "seed", "key")
    keyed = keyed.select(F.xxhash64("seed", "key", "x.band").alias("tile"), "x.home", "node", "n")
    shared = keyed.groupBy("tile").agg(F.count("*").alias("k")).where("k > 1")  # a node has a tile once
    tiles = saved(keyed.join(shared, "tile"), "tiles")
    near = saved(tiles.groupBy("node").agg(F.sum("k").alias("weight")), "near")
    near_nodes = saved(nodes.select("node", "n", "written", "bits").join(small(near.select("node")), "node", "left_semi"), "near-nodes")
    labels = saved(near.select("node", F.col("node").alias("component")), "labels")

    def links_of(possible: DataFrame) -> DataFrame:
        """The links among saved pairs; only the texts of these pairs are read again."""
        ends = possible.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = saved(near_nodes.select("node", F.col("written").alias("_w")).join(ends, "node").select("_w").distinct(), "wanted-texts")
        texts = docs.join(small(wanted), F.xxhash64(text) == F.col("_w"), "left_semi")
        sets = sorted_sets(texts, text).groupBy("node").agg(F.first("shingles").alias("shingles"))
        return saved(exact_links(possible, sets, percent), "new-links")

    def by_label(pairs: DataFrame) -> DataFrame:
        """(a, b): pairs of the components of pairs of nodes, where they differ."""
        held = small(labels)
        named = pairs.join(held.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a").join(held.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
        return named.where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))

    def relabelled(new: DataFrame) -> DataFrame:
        """labels after new: component, new."""
        return saved(labels.join(small(saved(new, "relabelled")), "component", "left").select("node", F.coalesce("new", "component").alias("component")), "labels")

    def apart(held: DataFrame) -> DataFrame:
        """tile, home, node, n, component of the tiles that hold several components."""
        now = held.join(small(labels), "node")
        several = now.groupBy("tile").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("tile")
        return saved(now.join(several, "tile", "left_semi"), "apart")

    held, links = tiles.select("tile", "home", "node", "n"), None
    for r in range(STAR_ROUNDS):
        open_ = apart(held)
        if open_.isEmpty():
            break
        rank, ranked = F.xxhash64("component", F.lit(r)), open_
        if r == 0:
            rank, ranked = -F.col("weight"), open_.join(small(near), "node")
        leaders = ranked.groupBy("tile").agg(F.min(F.struct(rank.alias("rank"), "component", F.xxhash64("node", F.lit(r)), "node", "n")).alias("l")).select("tile", F.col("l.node").alias("leader"), F.col("l.component").alias("lc"), F.col("l.n").alias("ln"), F.col("l.rank").alias("rank"))
        pairs = open_.join(leaders, "tile").where("component <> lc AND 100 * least(n, ln) >= " + str(percent) + " * greatest(n, ln)")
        # a follows b: the leader is before it in one order of all components, so that no chain of leaders comes back
        pairs = pairs.select(F.col("node").alias("a"), F.col("leader").alias("b"), "component", "lc", "rank").distinct()
        pairs = saved(pairs, "star-pairs")
        new = links_of(saved(possible_links(pairs, near_nodes, percent), "possible"))
        if new.isEmpty():
            break
        held = open_.drop("component")
        links = new if links is None else links.union(new)
        first = saved(pairs.join(small(new), ["a", "b"], "left_semi").groupBy("component").agg(F.min(F.struct("rank", "lc"))["lc"].alias("lead")), "leaders")
        further = small(first.select(F.col("component").alias("lead"), F.col("lead").alias("next")))
        labels = relabelled(first.join(further, "lead", "left").select("component", F.coalesce("next", "lead").alias("new")))
    rest = saved(distinct_tiles(apart(held)), "apart")
    if not rest.isEmpty():
        new = links_of(saved(tile_pairs(rest, near_nodes.select("node", "bits"), percent), "tile-pairs"))
        links = new if links is None else links.union(new)
    if links is not None and not (between := saved(by_label(links).distinct(), "links")).isEmpty():
        labels = relabelled(components(between).select(F.col("node").alias("component"), F.col("component").alias("new")))

    labelled = rows.select("doc_id", "node", "n").join(small(labels), "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = labelled.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("_k")).where("_k > 1").drop("_k")
    out = labelled.join(small(saved(several, "component-ids")), "component", "left")
    own_id = F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own_id.alias("component_id"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op4_ngram_jaccard": op4_ngram_jaccard}

#: Words, distinct shingles and pairs that share one, all in SQL; components by a recursive walk.
ORACLES = {
    "op4_ngram_jaccard": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM docs, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
), sized AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
-- equal sets are one node, named by its least document
node AS (
  SELECT doc_id, n, min(doc_id) OVER (PARTITION BY n, mark) AS node
  FROM (SELECT doc_id, n, md5(string_agg(s, chr(10) ORDER BY s)) AS mark FROM shingle JOIN sized USING (doc_id) GROUP BY doc_id, n)
), lone AS (SELECT s, doc_id AS node, n FROM shingle JOIN node USING (doc_id) WHERE node = doc_id),
link AS (
  SELECT x.node AS a, y.node AS b FROM lone x JOIN lone y ON x.s = y.s AND x.node < y.node AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY x.node, y.node, x.n, y.n HAVING 180 * count(*) >= 80 * (x.n + y.n)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
walk(start, seen) AS (SELECT DISTINCT a, a FROM edge UNION SELECT start, b FROM walk JOIN edge ON a = seen),
least_ AS (SELECT start, min(seen) AS component FROM walk GROUP BY start)
SELECT d.doc_id, coalesce(node.n, 0) AS n_shingles, coalesce(component, node, d.doc_id) AS component_id
FROM docs d LEFT JOIN node ON node.doc_id = d.doc_id LEFT JOIN least_ ON start = node
"""
}
