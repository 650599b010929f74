"""Street canyons, urban segments, samples, crowns and structures: plans over the operators."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arpent.functions.geometry import point_distance
from arpent.operators import focal as fo
from arpent.operators import segments as sg
from arpent.operators.joins import BOX, box_join, points_in_boxes
from arpent.operators.learning import assemble
from arpent.operators.lineage import settle, stored
from arpent.operators.lines import allowed_merges, first_hits, ray_hits_box, tag_by_line
from arpent.operators.polygons import with_box
from arpent.operators.regions import connected_components, link_tops
from arpent.plans.climate import Tree, compile_tree


def aspect_ratio(roads: DataFrame, buildings: DataFrame, zones: DataFrame, reach: float, size: float, step: float, buffer: float, default: float = 0.0) -> DataFrame:
    """(fid, aspect): mean over the road points within `buffer` of a zone of ((h1 + h2) / 2) / (w1 + w2), where it is above 0.

    Road points are the first points of segments (seg, x1, y1, x2, y2) of half a step or more. h and w are height and
    distance of the nearest building on either side, sought from the point at right angles to the segment within reach.
    Zones (rings) without such a point get the default.
    """
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    at = roads.where(length >= step / 2).withColumns({"px": F.col("x1"), "py": F.col("y1"), "nx": -(F.col("y2") - F.col("y1")) / length, "ny": (F.col("x2") - F.col("x1")) / length})
    ray = lambda k, s: at.select((F.col("seg") * 2 + k).alias("id"), "px", "py", (s * F.col("nx")).alias("ux"), (s * F.col("ny")).alias("uy"))
    hit = lambda px, py, ux, uy, pairs: ray_hits_box(px, py, ux, uy, *[F.col(f"b_{c}") for c in BOX])
    hits = first_hits(ray(0, 1.0).unionByName(ray(1, -1.0)), buildings.select("fid", "hauteur", *BOX), reach, size, hit, ["hauteur"])
    two = hits.groupBy(F.floor(F.col("id") / 2).cast("long").alias("seg")).agg(F.count("*").alias("n"), F.sum("hauteur").alias("h"), F.sum("t").alias("w")).where("n = 2")
    ratio = two.select("seg", F.try_divide(F.col("h") / 2, F.col("w")).alias("ratio")).where("ratio > 0")
    points = at.join(ratio, "seg").select("seg", F.col("px").alias("xmin"), F.col("py").alias("ymin"), F.col("px").alias("xmax"), F.col("py").alias("ymax"), "ratio")
    near = box_join(with_box(zones.select("fid", "rings")), points, size, pad=buffer, closed=True)
    held = near.where(point_distance(F.col("a_rings"), F.col("b_xmin"), F.col("b_ymin")) <= buffer)
    mean = held.groupBy(F.col("a_fid").alias("fid")).agg(F.avg("b_ratio").alias("aspect"))
    return zones.select("fid").join(mean, "fid", "left").select("fid", F.coalesce("aspect", F.lit(default)).alias("aspect"))


def surrogate_forest(zones: DataFrame, tree: Tree, fields: list[str], n: int, trees: int = 30, names: dict[str, float] | None = None, seed: int = 1):
    """(forest, labels): a forest fitted on a design of n points that fills the fields' ranges in zones, labelled by the tree.

    The design is stratified: each field takes one value from each of n slices of its range, in an order of its own.
    """
    ends = zones.agg(*[f(c).alias(f"{k}_{c}") for c in fields for k, f in (("lo", F.min), ("hi", F.max))]).first()
    points = zones.sparkSession.range(n)
    for i, c in enumerate(fields):
        slice_ = F.row_number().over(Window.orderBy(F.xxhash64("id", F.lit(seed * 1000 + i)), "id")) - 1  # n rows, a parameter
        u = (slice_ + F.pmod(F.xxhash64("id", F.lit(seed * 2000 + i)), F.lit(1_000_000)) / 1e6) / n
        points = points.withColumn(c, ends[f"lo_{c}"] + u * (ends[f"hi_{c}"] - ends[f"lo_{c}"]))
    design = settle(points.withColumn("label", compile_tree(tree, names)).where("label IS NOT NULL"))
    labels = sorted(r["label"] for r in design.select("label").distinct().collect())  # classes
    y = F.element_at(F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(v), F.lit(float(i)))]), F.col("label"))
    return RandomForestClassifier(labelCol="y", numTrees=trees, featureSubsetStrategy="5" if len(fields) > 5 else "all", seed=seed).fit(assemble(design.withColumn("y", y), fields)), labels


def forest_zones(zones: DataFrame, tree: Tree, fields: list[str], n: int, trees: int = 30, names: dict[str, float] | None = None) -> DataFrame:
    """zones with the tree's label `lcz` and the surrogate forest's `lcz_rf`."""
    model, labels = surrogate_forest(zones, tree, fields, n, trees, names)
    out = model.transform(assemble(zones.withColumn("lcz", compile_tree(tree, names)), fields))
    name = F.element_at(F.array(*[F.lit(v) for v in labels]), F.col("prediction").cast("int") + 1)
    return out.withColumn("lcz_rf", name).select(*zones.columns, "lcz", "lcz_rf")


def macro_samples(px: DataFrame, layers: list[tuple[DataFrame, int, float]], size: float) -> DataFrame:
    """(pid, macro): pixels in a layer's boxes grown (or shrunk) by its distance; those of several classes are dropped."""
    found = None
    for layer, code, d in layers:
        grown = layer.select("fid", (F.col("xmin") - d).alias("xmin"), (F.col("ymin") - d).alias("ymin"), (F.col("xmax") + d).alias("xmax"), (F.col("ymax") + d).alias("ymax")).where("xmax > xmin AND ymax > ymin")
        hit = points_in_boxes(px.select("pid", "x", "y"), grown, size).select(F.col("p_pid").alias("pid"), F.lit(code).alias("macro"))
        found = hit if found is None else found.unionByName(hit)
    return found.groupBy("pid").agg(F.min("macro").alias("macro"), F.max("macro").alias("_m")).where("macro = _m").drop("_m")


def clean_merge_samples(layers: dict[int, tuple[DataFrame, float, float]]) -> DataFrame:
    """(macro, fid, box): the samples of each class shrunk by its distance and of its least area or more, in one layer."""
    found = None
    for code, (layer, d, least) in layers.items():
        own = layer.select(F.lit(code).alias("macro"), "fid", (F.col("xmin") + d).alias("xmin"), (F.col("ymin") + d).alias("ymin"), (F.col("xmax") - d).alias("xmax"), (F.col("ymax") - d).alias("ymax"))
        own = own.where("xmax > xmin AND ymax > ymin").where((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")) >= least)
        found = own if found is None else found.unionByName(own)
    return found


def structures_by_edges(px: DataFrame, band: str, threshold: float, least: int) -> DataFrame:
    """(region, pixels): connected pixels of strong Sobel gradient, of `least` pixels or more."""
    mask = fo.sobel(px, band).where(F.col("gradient") > threshold).withColumn("m", F.lit(1))
    return connected_components(mask.select("pid", "r", "c", "m"), "m").groupBy("region").agg(F.count("*").alias("pixels")).where(F.col("pixels") >= least)


def structures_by_rest(boxes: DataFrame, d: float, least: float) -> DataFrame:
    """(fid, area): what an opening by d (shrink, then grow) takes off each box; boxes too narrow for it go whole."""
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    narrow = (w <= 2 * d) | (h <= 2 * d)
    return boxes.select("fid", F.when(narrow, w * h).otherwise(0.0).alias("area")).where(F.col("area") >= least)


def tree_crowns(px: DataFrame, greenness: str, height: str, least_green: float, least_height: float, size: float, distance: float, gap: float) -> DataFrame:
    """(region, pixels, top, x, y, crown): connected tall vegetation, its highest pixel, and the group of crowns whose tops lie
    near in place and height."""
    held = px.where((F.col(greenness) > least_green) & (F.col(height) > least_height)).withColumn("m", F.lit(1))
    reg = settle(connected_components(held, "m"))
    best = F.max(F.struct(F.col(height).alias("h"), (-F.col("pid")).alias("o"), "x", "y"))
    tops = settle(reg.groupBy("region").agg(F.count("*").alias("pixels"), best.alias("b")).select("region", "pixels", F.col("b.h").alias("top"), "b.x", "b.y"))
    groups = link_tops(tops.select(F.col("region").alias("fid"), F.col("top").alias("h"), "x", "y"), size, distance, gap)
    return tops.join(groups.select(F.col("fid").alias("region"), F.col("group").alias("crown")), "region")


def urban_segments(px: DataFrame, roads: DataFrame, bands: list[str], step: int, compactness: float, medium: float, limit: float, alike: float, size: float, reach: float) -> DataFrame:
    """(segment, pixels, side): superpixels, tagged by their side of the roads, merged by likeness within a side."""
    sp = stored(sg.superpixels(px, bands, step, compactness))
    box = sp.groupBy(F.col("superpixel").alias("fid")).agg((F.min("x") - 0.5).alias("xmin"), (F.min("y") - 0.5).alias("ymin"), (F.max("x") + 0.5).alias("xmax"), (F.max("y") + 0.5).alias("ymax"))
    tagged = settle(tag_by_line(box, roads, size, reach).withColumn("side", F.coalesce("side", F.lit("away"))))
    nodes, contacts = sg.region_table(sp, "superpixel", bands)
    into = sg.merge_similar(nodes, allowed_merges(tagged, contacts), medium, limit, alike)
    out = into.join(nodes.select("node", "size"), "node").join(tagged.select(F.col("fid").alias("node"), "side"), "node")
    return out.groupBy(F.col("into").alias("segment")).agg(F.sum("size").cast("long").alias("pixels"), F.min("side").alias("side"))


def combine_segmentations(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """One partition cut by another: a row for each pair of boxes that meet, with the box of the piece and its area."""
    pairs = box_join(a, b, size)
    box = {"xmin": F.greatest("a_xmin", "b_xmin"), "ymin": F.greatest("a_ymin", "b_ymin"), "xmax": F.least("a_xmax", "b_xmax"), "ymax": F.least("a_ymax", "b_ymax")}
    return pairs.withColumns(box).select(F.col("a_fid").alias("a"), F.col("b_fid").alias("b"), *BOX, ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area"))
