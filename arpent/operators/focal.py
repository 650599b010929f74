"""Focal operators on halo tiles: each pixel's window is an array step in its tile, whatever its radius."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arpent.operators.lineage import settle, stored
from arpent.operators.tiles import Tile, disk, mean_and_variance, most_frequent, on_tiles, shifted, shrunk, square, window_least

#: Pixels of a line that stand together in a step along the line.
SEGMENT = 256


def majority_filter(px: DataFrame, label: str, radius: int) -> DataFrame:
    """px with `majority`: the most frequent label around; of ties the centre's own, else the smallest. Null is no label."""

    def kernel(tile: Tile):
        codes, values = tile.codes(label)
        return {"majority": (most_frequent(codes, len(values), disk(radius)), values)}

    return on_tiles(px, [label], radius, kernel, {"majority": dict(px.dtypes)[label]})


def _least(px: DataFrame, value: str, name: str, signs: list[int], radius: int) -> DataFrame:
    """Minima (1) or maxima (-1) over a disk, one after the other; pixels outside the raster are ignored."""

    def kernel(tile: Tile):
        a = tile.grid(value)
        there = ~np.isnan(a)
        for s in signs:
            a = s * window_least(np.where(np.isnan(a), np.inf, s * a), disk(radius))
            there = shrunk(there, radius)
            a = np.where(there & np.isfinite(a), a, np.nan)
        return {name: a}

    return on_tiles(px, [value], radius * len(signs), kernel, {name: dict(px.dtypes)[value]})


def erode(px: DataFrame, mask: str, radius: int, name: str) -> DataFrame:
    return _least(px, mask, name, [1], radius)


def dilate(px: DataFrame, mask: str, radius: int, name: str) -> DataFrame:
    return _least(px, mask, name, [-1], radius)


def opening(px: DataFrame, mask: str, radius: int, name: str) -> DataFrame:
    """Erosion, then dilation, by a disk."""
    return _least(px, mask, name, [1, -1], radius)


def closing(px: DataFrame, mask: str, radius: int, name: str) -> DataFrame:
    """Dilation, then erosion, by a disk."""
    return _least(px, mask, name, [-1, 1], radius)


def sobel(px: DataFrame, value: str, name: str = "gradient") -> DataFrame:
    """Gradient magnitude of 3x3 Sobel kernels; null at pixels without all eight neighbours."""

    def kernel(tile: Tile):
        a = tile.grid(value)
        at = lambda i, j: shifted(a, i, j, 1)
        gx = sum((2 if i == 0 else 1) * j * at(i, j) for i in (-1, 0, 1) for j in (-1, 1))
        gy = sum((2 if j == 0 else 1) * i * at(i, j) for i in (-1, 1) for j in (-1, 0, 1))
        return {name: np.sqrt(gx * gx + gy * gy) + 0 * at(0, 0)}

    return on_tiles(px, [value], 1, kernel, {name: "double"})


def gradient(px: DataFrame, value: str, name: str = "gradient") -> DataFrame:
    """Magnitude of central differences; at the rim the missing neighbour is the pixel itself."""

    def kernel(tile: Tile):
        a = tile.grid(value)
        at = lambda i, j: np.where(np.isnan(shifted(a, i, j, 1)), shifted(a, 0, 0, 1), shifted(a, i, j, 1))
        return {name: np.hypot(at(0, 1) - at(0, -1), at(1, 0) - at(-1, 0)) / 2}

    return on_tiles(px, [value], 1, kernel, {name: "double"})


#: Which side of a line through the centre an offset is on, for the four lines that the ratio of means compares.
SIDES = (lambda i, j: i, lambda i, j: j, lambda i, j: i + j, lambda i, j: i - j)


def touzi(px: DataFrame, value: str, radius: int, name: str = "edge") -> DataFrame:
    """Ratio edge detector: 1 - the least ratio of the means of two window halves, over four directions; 0 where a mean is 0.

    Halves leave out the line between them. Pixels outside the raster are ignored; a half without pixels counts as 0.
    """

    def kernel(tile: Tile):
        a = tile.grid(value)
        ok = ~np.isnan(a)
        x, best = np.where(ok, a, 0.0), None
        span = range(-radius, radius + 1)
        for side in SIDES:
            means = []
            for sign in (1, -1):
                cells = [(i, j) for i in span for j in span if side(i, j) * sign > 0]
                n = sum(shifted(ok, i, j, radius).astype(float) for i, j in cells)
                means.append(sum(shifted(x, i, j, radius) for i, j in cells) / np.maximum(n, 1))
            p, q = means
            both = (p != 0) & (q != 0)
            ratio = np.where(both, 1 - np.minimum(p / np.where(both, q, 1), q / np.where(both, p, 1)), 0.0)
            best = ratio if best is None else np.maximum(best, ratio)
        return {name: np.where(shrunk(ok, radius), best, np.nan)}

    return on_tiles(px, [value], radius, kernel, {name: "double"})


def fill_holes_by_majority(px: DataFrame, label: str, radius: int, forced: int) -> DataFrame:
    """Pixels of label 0 take the majority around, those still 0 the forced value."""
    out = majority_filter(px, label, radius)
    return out.withColumn("filled", F.when(F.col(label) != 0, F.col(label)).when(F.col("majority") != 0, F.col("majority")).otherwise(F.lit(forced)))


def local_mean_variance(px: DataFrame, value: str, radius: int) -> DataFrame:
    """px with mean and (population) variance over a square window."""

    def kernel(tile: Tile):
        _, mean, variance = mean_and_variance(tile.grid(value), square(radius))
        return {"mean": mean, "variance": variance}

    return on_tiles(px, [value], radius, kernel, {"mean": "double", "variance": "double"})


def ratio_sharpen(px: DataFrame, pan: str, xs: str, radius: int) -> DataFrame:
    """px with `sharp`: xs scaled by the panchromatic band over its local mean; null where that mean is 0."""
    out = local_mean_variance(px, pan, radius)
    return out.withColumn("sharp", F.try_divide(F.col(xs) * F.col(pan), F.col("mean")))


def extent(px: DataFrame, height: str) -> tuple[float, int]:
    """Span of the heights, and the number of steps that cross the raster from corner to corner."""
    dh, dr, dc = px.agg(F.max(height) - F.min(height), F.max("r") - F.min("r"), F.max("c") - F.min("c")).first()
    return float(dh or 0), max(1, math.ceil(math.hypot(dr or 0, dc or 0)))


def _step(turn: float, s: int) -> tuple[int, int]:
    """Rows and columns of s steps at an angle from the row's direction, rounded to even halves like the grid's own."""
    dr, dc = math.sin(turn) * s, math.cos(turn) * s
    away = lambda x: int(math.copysign(math.floor(abs(x) + 0.5), x))
    return away(dr), away(dc)


def _horizons(px: DataFrame, height: str, down: bool, names: tuple[str, str]) -> DataFrame:
    """(r, c, names): the steepest rise (height over pixels, -inf at the end) to any pixel on and back along columns (down) or
    rows, for pixels with a height.

    Lines are cut into segments. In one step over blocks of segments a pixel finds the steepest rise to either side in its
    own, and whether it is a corner of the segment's upper hull; only corners can be steepest from outside, and they are the
    same from both sides. The hulls of all segments ahead are joined to one, corner by corner, and each pixel looks at the
    corners of that one. A line of one segment has no hull ahead.
    """
    lines = 64
    p = px.where(F.col(height).isNotNull()).select(F.col("c" if down else "r").cast("long").alias("_line"), F.col("r" if down else "c").cast("long").alias("_at"), F.col(height).cast("double").alias("_h")).withColumn("_seg", F.floor(F.col("_at") / SEGMENT))
    schema = "_line long, _seg long, _at long, _on double, _back double, _corner boolean, _h double"

    def near(key, table):
        h = np.full((lines, SEGMENT), np.nan)
        line, along = table["_line"].to_numpy() - key[0].as_py() * lines, table["_at"].to_numpy() - key[1].as_py() * SEGMENT
        h[line, along] = table["_h"].to_numpy()
        ahead, behind = np.full(h.shape, -np.inf), np.full(h.shape, np.inf)
        for d in range(1, SEGMENT):
            slope = (h[:, d:] - h[:, :-d]) / d
            ahead[:, :-d], behind[:, d:] = np.fmax(ahead[:, :-d], slope), np.fmin(behind[:, d:], slope)
        at_ = line, along
        return pa.table({"_line": table["_line"], "_seg": pa.array(np.full(len(line), key[1].as_py())), "_at": table["_at"], "_on": pa.array(ahead[at_]), "_back": pa.array(-behind[at_]), "_corner": pa.array((ahead <= behind)[at_]), "_h": table["_h"]})

    block = F.floor(F.col("_line") / lines).alias("_block")
    seen = settle(p.groupBy(block, "_seg").applyInArrow(near, schema))
    several = seen.groupBy("_line").agg(F.min("_seg").alias("_a"), F.max("_seg").alias("_b")).where("_a < _b").select("_line")
    corners = seen.where("_corner").select("_line", "_seg", "_at", "_h").join(several, "_line", "left_semi")
    def beyond(sign: int):
        def run(key, table):
            order = np.argsort(-sign * table["_at"].to_numpy())
            seg, at_, h = (table[c].to_numpy()[order] for c in ("_seg", "_at", "_h"))
            first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]])).tolist()
            out_seg, out_at, out_h, hull = [], [], [], []
            for a, b in zip(first, [*first[1:], len(seg)], strict=True):
                out_seg += [seg[a]] * len(hull)
                out_at += [x for x, _ in hull]
                out_h += [y for _, y in hull]
                for x, y in zip((sign * at_[a:b]).tolist(), h[a:b].tolist(), strict=True):  # from the far end: hull[-1] is the nearest corner so far
                    while len(hull) > 1 and (hull[-1][1] - y) * (hull[-2][0] - x) <= (hull[-2][1] - y) * (hull[-1][0] - x):
                        hull.pop()
                    hull.append((x, y))
            return pa.table({"_line": pa.array([key[0].as_py()] * len(out_seg), pa.int64()), "_seg": pa.array(out_seg, pa.int64()), "_x": pa.array(out_at, pa.int64()), "_y": pa.array(out_h, pa.float64())})

        return run

    found = seen
    for name, sign, own in zip(names, (1, -1), ("_on", "_back"), strict=True):
        far = corners.groupBy("_line").applyInArrow(beyond(sign), "_line long, _seg long, _x long, _y double").groupBy("_line", "_seg").agg(F.collect_list(F.struct("_x", "_y")).alias("_far"))  # the corners of one hull
        steepest = F.array_max(F.transform("_far", lambda k: (k["_y"] - F.col("_h")) / (k["_x"] - sign * F.col("_at"))))  # noqa: B023
        found = found.join(far, ["_line", "_seg"], "left").withColumn(name, F.greatest(own, F.coalesce(steepest, F.lit(float("-inf"))))).drop("_far")
    return found.select(F.col("_at" if down else "_line").alias("r"), F.col("_line" if down else "_at").alias("c"), *names)


def sky_view_factor(px: DataFrame, height: str, radius: int | None = None, directions: int = 8) -> DataFrame:
    """px with `svf`: mean over directions of the squared cosine of the horizon angle within the radius, or else the whole raster.

    Directions along rows and columns look over the whole raster by `_horizons`; others, without a radius, have tiles
    whose margin is the raster's diagonal.
    """
    kinds = [_step(2 * math.pi * k / directions, 1) if 4 * k % directions == 0 else None for k in range(directions)]
    lines = [k for k in kinds if k] if radius is None else []
    turns = [2 * math.pi * k / directions for k in range(directions) if radius is not None or kinds[k] is None]
    out, names = px, {k: f"_horizon{i}" for i, k in enumerate(((0, 1), (0, -1), (1, 0), (-1, 0)))}
    if lines:
        once = stored(px.select("r", "c", height))
        for on, back in (((0, 1), (0, -1)), ((1, 0), (-1, 0))):
            if on in lines or back in lines:
                both = names[on], names[back]
                out = out.join(_horizons(once, height, on[0] == 1, both), ["r", "c"], "left").select(*out.columns, *both)
    if turns:
        reach = radius if radius is not None else extent(px, height)[1]

        def kernel(tile: Tile):
            h = tile.grid(height)
            total = 0.0
            for turn in turns:
                steep = np.zeros(shrunk(h, reach).shape)
                for s in range(1, reach + 1):
                    steep = np.fmax(steep, (shifted(h, *_step(turn, s), reach) - shrunk(h, reach)) / s)
                total = total + 1 / (1 + steep * steep)
            return {"_rest": total}

        out = on_tiles(out, [height], reach, kernel, {"_rest": "double"})
    cosine = [1 / (1 + F.pow(F.greatest(F.lit(0.0), F.col(names[k])), 2)) for k in lines] + ([F.col("_rest")] if turns else [])
    return out.withColumn("svf", reduce(lambda a, b: a + b, cosine) / directions).drop("_rest", *names.values())


def shadow_mask(px: DataFrame, height: str, azimuth: float, elevation: float, reach: int | None = None) -> DataFrame:
    """px with `shadow`: 1 where a pixel towards the sun rises above the ray, within reach or else wherever the heights let it.

    Without reach, along rows or columns the greatest height less the ray's rise is carried on from the sun's side, first
    over segments and then within each; other azimuths have tiles whose margin is the longest shadow of the raster.
    """
    dr, dc, slope = -math.cos(math.radians(azimuth)), math.sin(math.radians(azimuth)), math.tan(math.radians(elevation))
    if reach is None and azimuth % 90 == 0:
        at = F.col("r") * round(dr) + F.col("c") * round(dc)
        line = "c" if round(dr) else "r"
        p = px.withColumns({"_at": at, "_seg": F.floor(at / SEGMENT), "_level": F.col(height) - at * slope})
        ahead = Window.partitionBy(line).orderBy(F.desc("_seg")).rowsBetween(Window.unboundedPreceding, -1)
        far = p.groupBy(line, "_seg").agg(F.max("_level").alias("_m")).select(line, "_seg", F.max("_m").over(ahead).alias("_far"))
        before = Window.partitionBy(line, "_seg").orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, -1)
        most = F.greatest(F.max("_level").over(before), F.col("_far"))
        return p.join(far, [line, "_seg"]).withColumn("shadow", F.coalesce((most > F.col("_level")).cast("int"), F.lit(0))).select(*px.columns, "shadow")
    return shadows(px, height, [(azimuth, elevation)], reach).withColumn("shadow", F.col("shadows")).drop("shadows")


def shadows(px: DataFrame, height: str, suns: list[tuple[float, float]], reach: int | None = None) -> DataFrame:
    """px with `shadows`: under how many of the suns (azimuth, elevation in degrees) a pixel lies in shadow.

    A sun below the horizon leaves every pixel in shadow. Without reach the margin is the longest shadow of the raster.
    """
    up = [(math.radians(a), math.tan(math.radians(e))) for a, e in suns if e > 0]
    if reach is None:
        dh, most = extent(px, height)
        reach = max([1, *[min(most, math.ceil(dh / slope)) for _, slope in up]])

    def kernel(tile: Tile):
        h = tile.grid(height)
        own = shrunk(h, reach)
        count = np.full(own.shape, float(len(suns) - len(up)))
        for turn, slope in up:
            hit = np.zeros(own.shape, bool)
            for s in range(1, reach + 1):
                hit |= shifted(h, round(-math.cos(turn) * s), round(math.sin(turn) * s), reach) - own > s * slope
            count += hit
        return {"shadows": count}

    return on_tiles(px, [height], reach, kernel, {"shadows": "int"})


def interpolate_from_points(cells: DataFrame, points: DataFrame, size: float, k: int = 4) -> DataFrame:
    """(pid, value): inverse-distance mean of a cell's k nearest points, ties to the smaller fid.

    Round by round the grid squares double: a cell looks into its own square and those around it, and is done when its
    k-th point is no farther than a square, or when the squares hold every point. The sum runs from the nearest on.
    """
    ends = points.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.count("*")).first()
    if not ends[4]:
        return cells.select("pid", F.lit(None).cast("double").alias("value"))
    far = cells.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    reach = max((max(ends[i + 1], far[i + 1] if far[i + 1] is not None else ends[i + 1]) - min(ends[i], far[i] if far[i] is not None else ends[i]) for i in (0, 2)))
    spread = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    open_, done = cells.select("pid", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")), []
    while True:
        p = points.select(F.col("x").alias("px_"), F.col("y").alias("py_"), "z", "fid", F.inline(spread)).withColumn("gx", F.floor(F.col("px_") / size) + F.col("i")).withColumn("gy", F.floor(F.col("py_") / size) + F.col("j"))
        q = open_.withColumn("gx", F.floor(F.col("x") / size)).withColumn("gy", F.floor(F.col("y") / size)).join(p, ["gx", "gy"])
        d = F.sqrt((F.col("x") - F.col("px_")) * (F.col("x") - F.col("px_")) + (F.col("y") - F.col("py_")) * (F.col("y") - F.col("py_")))
        ranked = q.withColumn("d", d).withColumn("n", F.row_number().over(Window.partitionBy("pid").orderBy("d", "fid"))).where(F.col("n") <= k)
        near = ranked.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("d", "fid", "z"))).alias("near"))  # k points at most
        last = size >= reach
        held = settle(near if last else near.where((F.size("near") == k) & (F.element_at("near", -1)["d"] <= size)))
        done.append(held)
        if last:
            break
        open_ = settle(open_.join(held.select("pid"), "pid", "left_anti"))
        if open_.isEmpty():
            break
        size *= 2
    w = lambda s: 1 / F.greatest(s["d"], F.lit(1e-9))
    total = lambda f: F.aggregate("near", F.lit(0.0), lambda a, s: a + f(s))
    found = reduce(lambda a, b: a.unionByName(b), done)
    return found.select("pid", (total(lambda s: w(s) * s["z"]) / total(w)).alias("value"))
