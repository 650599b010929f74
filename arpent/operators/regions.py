"""Connected regions of pixels and of features, and merges built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arpent.operators.joins import box_join
from arpent.operators.lineage import stored


#: Columns of a cell in which runs of neighbouring rows meet.
CELL_COLUMNS = 64


def label_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label): the least node that edges (a, b) reach.

    Each round every node takes the least label of its neighbours, then the label of its label (pointer jumping), so the
    number of rounds follows the logarithm of the diameter. A round is two grouped minima and two joins, stored as files:
    a checkpoint would hand on to the next round what the optimiser has inferred about the labels.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = stored(nodes.select("node", F.col("node").alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m")).withColumnRenamed("a", "node")
        new = labels.join(near, "node", "left").select("node", "label", F.least("label", F.coalesce("m", "label")).alias("m"))
        # the old label's node learns the new one too, so whole regions move at once
        hook = new.where("m < label").groupBy(F.col("label").alias("node")).agg(F.min("m").alias("h"))
        new = new.join(hook, "node", "left").select("node", F.least("m", F.coalesce("h", "m")).alias("label"))
        jump = new.select(F.col("node").alias("label"), F.col("label").alias("j"))
        new = stored(new.join(jump, "label", "left").select("node", F.coalesce("j", "label").alias("label")))
        if new.join(labels.withColumnRenamed("label", "was"), "node").where("label <> was").isEmpty():
            return new
        labels = new


def runs(px: DataFrame, value: str) -> DataFrame:
    """(r, run, c0, c1, v): maximal runs of equal values along a row, named by their first pixel. Pixels in, runs out: the
    component loop works on runs, far fewer than pixels."""
    w = Window.partitionBy("r").orderBy("c")
    start = (F.lag("c").over(w) != F.col("c") - 1) | (F.lag("v").over(w) != F.col("v"))
    p = px.select("pid", "r", "c", F.col(value).alias("v")).withColumn("_s", F.coalesce(start.cast("int"), F.lit(1)))
    p = p.withColumn("_g", F.sum("_s").over(w))
    return p.groupBy("r", "_g").agg(F.min("pid").alias("run"), F.min("c").alias("c0"), F.max("c").alias("c1"), F.first("v").alias("v")).drop("_g")


def connected_components(px: DataFrame, value: str, eight: bool = False) -> DataFrame:
    """px with `region`: the least pid of its region of equal value, 4- or 8-connected."""
    r = stored(runs(px, value))
    reach = 1 if eight else 0
    cells = F.explode(F.sequence(F.floor(F.col("c0") / CELL_COLUMNS), F.floor((F.col("c1") + reach) / CELL_COLUMNS)))
    p = r.withColumn("_k", cells)
    a, b = p.select("_k", *[F.col(c).alias(f"a_{c}") for c in r.columns]), p.select("_k", *[F.col(c).alias(f"b_{c}") for c in r.columns])
    meet = (a["_k"] == b["_k"]) & (F.col("b_r") == F.col("a_r") + 1) & (F.col("a_v") == F.col("b_v")) & (F.col("a_c0") <= F.col("b_c1") + reach) & (F.col("b_c0") <= F.col("a_c1") + reach)
    edges = a.join(b, meet).select(F.col("a_run").alias("a"), F.col("b_run").alias("b"))
    labels = label_components(r.select(F.col("run").alias("node")), edges)
    spans = r.join(labels, r["run"] == labels["node"]).select("r", "label", F.explode(F.sequence("c0", "c1")).alias("c"))
    return px.join(spans.withColumnRenamed("label", "region"), ["r", "c"])


def polygonize(px: DataFrame, value: str, eight: bool = False, size: float = 1.0) -> DataFrame:
    """One row per region: value, pixels, bounding box and number of boundary edges, of pixels of a size."""
    half = size / 2
    reg = stored(connected_components(px, value, eight).select("r", "c", "x", "y", "region", F.col(value).alias("value")))
    side = F.inline(F.array(*[F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i, j in ((0, 1), (0, -1), (1, 0), (-1, 0))]))
    want = reg.select("region", "r", "c", side).withColumn("r", F.col("r") + F.col("dr")).withColumn("c", F.col("c") + F.col("dc"))
    there = reg.select("r", "c", F.col("region").alias("other"))
    edge = want.join(there, ["r", "c"], "left").where("other IS NULL OR other <> region").groupBy("region").agg(F.count("*").alias("perimeter"))
    shape = reg.groupBy("region").agg(F.first("value").alias("value"), F.count("*").alias("pixels"), (F.min("x") - half).alias("xmin"), (F.min("y") - half).alias("ymin"), (F.max("x") + half).alias("xmax"), (F.max("y") + half).alias("ymax"))
    return shape.join(edge, "region")


def sieve(px: DataFrame, value: str, least: int) -> DataFrame:
    """px whose regions (8-connected) of fewer than `least` pixels take the value of their largest neighbour region."""
    reg = stored(connected_components(px, value, eight=True))
    size = reg.groupBy("region").agg(F.count("*").alias("n"), F.first(value).alias("v"))
    side = F.inline(F.array(*[F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]))
    small = size.where(F.col("n") < least).select("region")
    want = reg.join(small, "region").select("region", "r", "c", side).withColumn("r", F.col("r") + F.col("dr")).withColumn("c", F.col("c") + F.col("dc"))
    met = want.join(reg.select("r", "c", F.col("region").alias("other")), ["r", "c"]).where("other <> region").select("region", "other").distinct()
    best = met.join(size.withColumnRenamed("region", "other"), "other").groupBy("region").agg(F.max(F.struct("n", (-F.col("other")).alias("o"), "v"))["v"].alias("new"))
    return reg.join(best, "region", "left").withColumn(value, F.coalesce("new", value)).drop("new", "region")


def group_touching(df: DataFrame, size: float, tolerance: float = 1e-3, key: str = "fid") -> DataFrame:
    """df with `group`: the least id of the boxes that touch one another, directly or through others."""
    edges = box_join(df, df, size, pad=tolerance).where(f"a_{key} < b_{key}").select(F.col(f"a_{key}").alias("a"), F.col(f"b_{key}").alias("b"))
    labels = label_components(df.select(F.col(key).alias("node")), edges)
    return df.join(labels.select(F.col("node").alias(key), F.col("label").alias("group")), key)


def prune_dangling(lines: DataFrame, rounds: int = 5) -> DataFrame:
    """Segments (seg, x1, y1, x2, y2) without those that have an end which no other segment shares, round after round."""
    now = lines
    for _ in range(rounds):
        ends = now.select("seg", F.inline(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))))
        lone = ends.groupBy("x", "y").agg(F.count("*").alias("n"), F.min("seg").alias("seg")).where("n = 1").select("seg").distinct()
        now = stored(now.join(lone, "seg", "left_anti"))
    return now


def link_tops(tops: DataFrame, size: float, distance: float = 10, gap: float = 1.1) -> DataFrame:
    """(fid, group): tops within a distance and a height gap of one another, directly or through others."""
    boxes = tops.select("fid", "h", F.col("x").alias("xmin"), F.col("y").alias("ymin"), F.col("x").alias("xmax"), F.col("y").alias("ymax"))
    pairs = box_join(boxes, boxes, size, pad=distance, closed=True).where("a_fid < b_fid")
    d = F.hypot(F.col("a_xmin") - F.col("b_xmin"), F.col("a_ymin") - F.col("b_ymin"))
    edges = pairs.where((d <= distance) & (F.abs(F.col("a_h") - F.col("b_h")) <= gap)).select(F.col("a_fid").alias("a"), F.col("b_fid").alias("b"))
    return label_components(tops.select(F.col("fid").alias("node")), edges).select(F.col("node").alias("fid"), F.col("label").alias("group"))


def merge_small(regions: DataFrame, contacts: DataFrame, least: float) -> DataFrame:
    """(node, into): regions (node, size) under `least` join the neighbour of longest contact (a, b, length), in rounds.

    Each round, a small group and the neighbour it likes best merge; ties go to the lower id. It ends when no group under
    the limit has a neighbour, so the result may differ from merging one at a time, smallest first.
    """
    into = stored(regions.select("node", F.col("node").alias("into")))
    sym = stored(contacts.select("a", "b", "length").union(contacts.select("b", "a", "length")))
    while True:
        size = regions.join(into, "node").groupBy("into").agg(F.sum("size").alias("s"))
        small = size.where(F.col("s") < least).select(F.col("into").alias("ga"))
        g = sym.join(into.select(F.col("node").alias("a"), F.col("into").alias("ga")), "a").join(into.select(F.col("node").alias("b"), F.col("into").alias("gb")), "b").where("ga <> gb")
        best = g.join(small, "ga").groupBy("ga", "gb").agg(F.sum("length").alias("l")).groupBy("ga").agg(F.max(F.struct("l", (-F.col("gb")).alias("o"), "gb"))["gb"].alias("gb"))
        best = stored(best)
        if best.isEmpty():
            return into
        labels = label_components(into.select(F.col("into").alias("node")).distinct(), best.select(F.col("ga").alias("a"), F.col("gb").alias("b")))
        into = stored(into.join(labels.select(F.col("node").alias("into"), "label"), "into").select("node", F.col("label").alias("into")))
