"""Segmentation: superpixels, and merges of regions by likeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arpent.operators.lineage import stored


def superpixels(px: DataFrame, bands: list[str], step: int, compactness: float, rounds: int = 5) -> DataFrame:
    """px with `superpixel`: simple linear iterative clustering on colour and place.

    Centres start on a grid of a step. In each round a pixel takes the nearest of the nine centres whose squares lie around
    it, by squared colour distance plus squared place distance times (compactness / step)^2, and centres move to the means.
    """
    gx, gy = F.floor(F.col("c") / step), F.floor(F.col("r") / step)
    means = [F.avg(b).alias(b) for b in bands]
    centres = stored(px.groupBy(gx.alias("gx"), gy.alias("gy")).agg(F.avg("r").alias("r"), F.avg("c").alias("c"), *means))
    around = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    square = lambda a, b: (a - b) * (a - b)
    weight = (compactness / step) ** 2

    def own(x: Column) -> Column:
        d = sum((square(F.col(b), x[b]) for b in bands), F.lit(0.0)) + weight * (square(F.col("r"), x["r"]) + square(F.col("c"), x["c"]))
        return F.struct(d.alias("d"), x["gy"].alias("gy"), x["gx"].alias("gx"))

    def nearest(df: DataFrame) -> DataFrame:
        """df with _gx and _gy of each pixel's centre; a square's nine centres come as one row, so pixels are shuffled once."""
        near = centres.select(F.struct("gx", "gy", "r", "c", *bands).alias("_x"), around).groupBy((F.col("_x.gx") + F.col("i")).alias("_sx"), (F.col("_x.gy") + F.col("j")).alias("_sy")).agg(F.collect_list("_x").alias("_near"))
        met = df.withColumns({"_sx": gx, "_sy": gy}).join(near, ["_sx", "_sy"]).withColumn("_b", F.array_min(F.transform("_near", own)))
        return met.select(*df.columns, F.col("_b.gx").alias("_gx"), F.col("_b.gy").alias("_gy"))

    for _ in range(rounds - 1):
        best = nearest(px.select("r", "c", *bands))
        centres = stored(best.groupBy(F.col("_gx").alias("gx"), F.col("_gy").alias("gy")).agg(F.avg("r").alias("r"), F.avg("c").alias("c"), *means))
    best = stored(nearest(px))
    names = best.groupBy("_gx", "_gy").agg(F.min("pid").alias("superpixel"))
    return best.join(names, ["_gx", "_gy"]).select("pid", *[c for c in px.columns if c != "pid"], "superpixel")


def region_table(px: DataFrame, region: str, bands: list[str]) -> tuple[DataFrame, DataFrame]:
    """Regions (node, size, features: means of the bands) and contacts (a, b, length) of labelled pixels."""
    nodes = px.groupBy(F.col(region).alias("node")).agg(F.count("*").cast("double").alias("size"), F.array(*[F.avg(b) for b in bands]).alias("features"))
    step = F.inline(F.array(F.struct(F.lit(0).alias("i"), F.lit(1).alias("j")), F.struct(F.lit(1).alias("i"), F.lit(0).alias("j"))))
    moved = px.select(F.col(region).alias("a"), "r", "c", step).withColumn("r", F.col("r") + F.col("i")).withColumn("c", F.col("c") + F.col("j"))
    met = moved.join(px.select("r", "c", F.col(region).alias("b")), ["r", "c"]).where("a <> b")
    contacts = met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").cast("double").alias("length"))
    return nodes, contacts


def feature_distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def merge_round(state: DataFrame, border: DataFrame, medium: float, limit: float, rural: float | None = None, urban: tuple = (), alike: float = 0.7, growth: float = 2.5, top: int = 4) -> DataFrame:
    """(lo, hi): the pairs of regions that merge in a round.

    state: g, size, features and, with `rural`, cls; border: a, b, length both ways. Only a region of at most its own limit
    starts a merge: `limit` if its class is urban or null (or without `rural`), else `rural`. It looks at the `top`
    neighbours of longest contact. Up to the medium size it takes the one of nearest features; above, the nearest that is
    nearer than `alike` and with which it stays within growth times its limit. Ties go to the lower region. A region takes
    part in the nearest of what it starts and of what others start with it, and a pair merges that is so for both.
    """
    town = F.lit(True) if rural is None else F.col("cls").isNull() | F.col("cls").isin(*urban)
    own = state.select(F.col("g").alias("a"), F.col("size").alias("sa"), F.col("features").alias("fa"), F.when(town, F.lit(float(limit))).otherwise(F.lit(float(rural if rural is not None else limit))).alias("most")).where("sa <= most")
    other = state.select(F.col("g").alias("b"), F.col("size").alias("sb"), F.col("features").alias("fb"))
    near = Window.partitionBy("a").orderBy(F.desc("length"), "b")
    close = border.withColumn("_n", F.row_number().over(near)).where(F.col("_n") <= top)
    pairs = close.join(own, "a").join(other, "b").withColumn("d", feature_distance(F.col("fa"), F.col("fb")))
    legal = pairs.where((F.col("sa") <= medium) | ((F.col("d") < alike) & (F.col("sa") + F.col("sb") <= growth * F.col("most"))))
    starts = legal.groupBy("a").agg(F.min(F.struct("d", "b")).alias("x")).select(F.least("a", "x.b").alias("lo"), F.greatest("a", "x.b").alias("hi"), "x.d").distinct()
    sides = starts.select(F.col("lo").alias("g"), "d", "lo", "hi").union(starts.select(F.col("hi").alias("g"), "d", "lo", "hi"))
    return sides.groupBy("g").agg(F.min(F.struct("d", "lo", "hi")).alias("x")).groupBy("x.lo", "x.hi").agg(F.count("*").alias("n")).where("n = 2").select("lo", "hi")


def merge_similar(regions: DataFrame, contacts: DataFrame, medium: float, limit: float, alike: float = 0.7, growth: float = 2.5, top: int = 4, rural: float | None = None, urban: tuple = ()) -> DataFrame:
    """(node, into): regions (node, size, features and, with `rural`, cls and share) merged with neighbours (a, b, length).

    Rounds of `merge_round`, whose rules these are, until no pair may merge. Features are averaged by size; a merged region
    has the class whose part of it is the largest, and that part as its share. Many small regions take many rounds.
    """
    into = stored(regions.select("node", F.col("node").alias("into")))
    named = "cls" in regions.columns
    state = stored(regions.select(F.col("node").alias("g"), "size", "features", *(["cls", "share"] if named else [])))
    both = F.inline(F.array(F.struct("a", "b", "length"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "length")))
    border = stored(contacts.select(both))
    while True:
        best = stored(merge_round(state, border, medium, limit, rural, urban, alike, growth, top))
        if best.isEmpty():
            return into
        move = best.select(F.col("hi").alias("g"), F.col("lo").alias("new"))  # a pair each: nothing moves twice
        now = lambda df, c: df.join(move.select(F.col("g").alias(c), "new"), c, "left").withColumn(c, F.coalesce("new", c)).drop("new")  # noqa: E731, B023
        into = stored(now(into, "into"))
        border = stored(now(now(border, "a"), "b").where("a <> b").groupBy("a", "b").agg(F.sum("length").alias("length")))
        weighted = now(state, "g").withColumn("features", F.transform("features", lambda f: f * F.col("size")))
        part = [F.max(F.struct((F.col("size") * F.col("share")).alias("w"), "cls")).alias("_c"), F.count_distinct("cls").alias("_k"), F.sum(F.col("size") * F.col("share")).alias("_w")] if named else []
        parts = weighted.groupBy("g").agg(F.sum("size").alias("size"), F.array_sort(F.collect_list(F.struct("features"))).alias("l"), *part)  # two at most
        features = F.transform(F.aggregate(F.slice("l", 2, 2), F.element_at("l", 1)["features"], lambda s, x: F.zip_with(s, x["features"], lambda p, q: p + q)), lambda f: f / F.col("size")).alias("features")
        own = [F.col("_c.cls").alias("cls"), (F.when(F.col("_k") == 1, F.col("_w")).otherwise(F.col("_c.w")) / F.col("size")).alias("share")] if named else []
        state = stored(parts.select("g", "size", features, *own))


def segment_by_similarity(px: DataFrame, bands: list[str], step: int, compactness: float, medium: float, limit: float, alike: float) -> DataFrame:
    """px with `segment`: superpixels merged by likeness."""
    sp = stored(superpixels(px, bands, step, compactness))
    into = merge_similar(*region_table(sp, "superpixel", bands), medium, limit, alike)
    return sp.join(into.select(F.col("node").alias("superpixel"), F.col("into").alias("segment")), "superpixel").drop("superpixel")


def fill_by_longest_border(df: DataFrame, contacts: DataFrame, label: str, key: str = "fid") -> DataFrame:
    """Features without a label take that of the labelled neighbour of longest border (a, b, length), then the lowest id."""
    known = df.where(F.col(label).isNotNull()).select(F.col(key).alias("b"), F.col(label).alias("_l"))
    holes = df.where(F.col(label).isNull()).select(F.col(key).alias("a"))
    best = contacts.join(holes, "a").join(known, "b").groupBy(F.col("a").alias(key)).agg(F.max(F.struct("length", (-F.col("b")).alias("o"), "_l"))["_l"].alias("_l"))
    return df.join(best, key, "left").withColumn(label, F.coalesce(label, "_l")).drop("_l")


def simplify_coverage(px: DataFrame, region: str, size: float = 1.0) -> DataFrame:
    """(a, b, x1, y1, x2, y2): borders between labelled pixels, each once for both sides (b null: the raster's edge), with steps
    in one direction joined to one edge, so no gaps arise."""
    sides = F.array(F.struct(F.lit(0).alias("i"), F.lit(1).alias("j")), F.struct(F.lit(1).alias("i"), F.lit(0).alias("j")), F.struct(F.lit(0).alias("i"), F.lit(-1).alias("j")), F.struct(F.lit(-1).alias("i"), F.lit(0).alias("j")))
    moved = px.select(F.col(region).alias("a"), "r", "c", F.inline(sides)).withColumn("_r", F.col("r") + F.col("i")).withColumn("_c", F.col("c") + F.col("j"))
    met = moved.join(px.select(F.col("r").alias("_r"), F.col("c").alias("_c"), F.col(region).alias("b")), ["_r", "_c"], "left").where("b IS NULL OR a < b")
    # an edge lies on a grid line (at) and runs from a step to the next
    upright = F.col("j") != 0
    at = F.when(upright, F.greatest("c", "_c")).otherwise(F.greatest("r", "_r"))
    e = met.select("a", "b", upright.alias("u"), at.alias("at"), F.when(upright, F.col("r")).otherwise(F.col("c")).alias("k"))
    order = Window.partitionBy("u", "at", "a", "b").orderBy("k")
    e = e.withColumn("g", F.col("k") - F.row_number().over(order)).groupBy("u", "at", "a", "b", "g").agg(F.min("k").alias("s"), (F.max("k") + 1).alias("t"))
    point = lambda k: (F.when(F.col("u"), F.col("at")).otherwise(F.col(k)) * size, F.when(F.col("u"), F.col(k)).otherwise(F.col("at")) * -size)
    (x1, y1), (x2, y2) = point("s"), point("t")
    return e.select("a", "b", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
