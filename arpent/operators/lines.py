"""Networks of segments: chains, extension to reference lines, rays, sides."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arpent.operators.joins import box_join, segment_distance
from arpent.operators.regions import label_components, prune_dangling

ENDS = ("x1", "y1", "x2", "y2")


def merge_connected_lines(lines: DataFrame, key: str = "seg") -> DataFrame:
    """(chain, segments, line): segments that touch at ends where just two meet, as one line of points in order.

    Ends are matched by equality; a chain is named by its least key. A ring starts at its least point. One chain, which is
    one row of the result, comes together in a task; chains are found by components.
    """
    ends = lines.select(key, F.inline(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))))
    joints = ends.groupBy("x", "y").agg(F.count("*").alias("n"), F.min(key).alias("a"), F.max(key).alias("b")).where("n = 2 AND a <> b").select("a", "b")
    labels = label_components(lines.select(F.col(key).alias("node")), joints)

    def chained(pdf: pd.DataFrame) -> pd.DataFrame:
        at: dict[tuple, list[int]] = {}
        segs = list(zip(*(pdf[c].tolist() for c in ENDS), strict=True))
        for i, (a, b, c, d) in enumerate(segs):
            at.setdefault((a, b), []).append(i)
            at.setdefault((c, d), []).append(i)
        p = min((q for q, on in at.items() if len(on) == 1), default=min(at))
        line, left = [p], set(range(len(segs)))
        while nexts := [i for i in at[p] if i in left]:
            left.discard(nexts[0])
            a, b, c, d = segs[nexts[0]]
            p = (c, d) if (a, b) == p else (a, b)
            line.append(p)
        return pd.DataFrame({"chain": [int(pdf["label"].iloc[0])], "segments": [len(segs)], "line": [[{"x": x, "y": y} for x, y in line]]})

    held = lines.join(labels.withColumnRenamed("node", key), key).select("label", *ENDS)
    return held.groupBy("label").applyInPandas(chained, "chain long, segments long, line array<struct<x:double,y:double>>")


def ray_hit(px: Column, py: Column, ux: Column, uy: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """How far along a ray (point, unit direction) it meets a segment; null where it doesn't."""
    dx, dy = x2 - x1, y2 - y1
    det = F.nullif(ux * dy - uy * dx, F.lit(0.0))
    t, u = ((x1 - px) * dy - (y1 - py) * dx) / det, ((x1 - px) * uy - (y1 - py) * ux) / det
    return F.when((t >= 0) & (u >= 0) & (u <= 1), t)


def ray_hits_box(px: Column, py: Column, ux: Column, uy: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """How far along a ray it enters a box, 0 inside; null where it doesn't."""
    inf = F.lit(float("inf"))
    side = lambda p, u, a, b: (F.when(u == 0, F.when((p >= a) & (p <= b), -inf).otherwise(inf)).otherwise(F.least((a - p) / F.nullif(u, F.lit(0.0)), (b - p) / F.nullif(u, F.lit(0.0)))), F.when(u == 0, F.when((p >= a) & (p <= b), inf).otherwise(-inf)).otherwise(F.greatest((a - p) / F.nullif(u, F.lit(0.0)), (b - p) / F.nullif(u, F.lit(0.0)))))
    (xi, xo), (yi, yo) = side(px, ux, xmin, xmax), side(py, uy, ymin, ymax)
    enter, leave = F.greatest(xi, yi, F.lit(0.0)), F.least(xo, yo)
    return F.when(enter <= leave, enter)


def first_hits(rays: DataFrame, targets: DataFrame, reach: float, size: float, hit, keep: list[str], key: str = "id") -> DataFrame:
    """(key, t, kept columns) of the first target along each ray (px, py, ux, uy) within reach; rays without one are left out.

    Rays and targets (with boxes) meet on grid cells by their boxes; ties go to the smaller fid.
    """
    ex, ey = F.col("px") + F.col("ux") * reach, F.col("py") + F.col("uy") * reach
    r = rays.withColumns({"xmin": F.least("px", ex), "ymin": F.least("py", ey), "xmax": F.greatest("px", ex), "ymax": F.greatest("py", ey)})
    pairs = box_join(r.select(key, "px", "py", "ux", "uy", "xmin", "ymin", "xmax", "ymax"), targets, size, closed=True)
    t = hit(*[F.col(f"a_{c}") for c in ("px", "py", "ux", "uy")], pairs)
    met = pairs.withColumn("t", t).where(F.col("t") <= reach)
    best = met.groupBy(F.col(f"a_{key}").alias(key)).agg(F.min(F.struct("t", F.col("b_fid").alias("fid"), *[F.col(f"b_{c}").alias(c) for c in keep])).alias("_b"))
    return best.select(key, "_b.t", *[f"_b.{c}" for c in keep])


def _unit(x1, y1, x2, y2) -> tuple[Column, Column]:
    n = F.nullif(F.hypot(x2 - x1, y2 - y1), F.lit(0.0))
    return (x2 - x1) / n, (y2 - y1) / n


def extend_to_reference(lines: DataFrame, refs: DataFrame, length: float, size: float, key: str = "seg") -> DataFrame:
    """lines (key, x1, y1, x2, y2) whose ends move outwards to the first reference segment within a length; an end that meets
    none stays."""
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    ux, uy = _unit(x1, y1, x2, y2)
    first = lines.select((F.col(key) * 2).alias("id"), x1.alias("px"), y1.alias("py"), (-ux).alias("ux"), (-uy).alias("uy"))
    last = lines.select((F.col(key) * 2 + 1).alias("id"), x2.alias("px"), y2.alias("py"), ux.alias("ux"), uy.alias("uy"))
    boxed = refs.select("fid", *ENDS, F.least("x1", "x2").alias("xmin"), F.least("y1", "y2").alias("ymin"), F.greatest("x1", "x2").alias("xmax"), F.greatest("y1", "y2").alias("ymax"))
    hit = lambda px, py, a, b, pairs: ray_hit(px, py, a, b, *[F.col(f"b_{c}") for c in ENDS])
    hits = first_hits(first.unionByName(last), boxed, length, size, hit, [])
    far = lambda which, name: hits.where(F.col("id") % 2 == which).select(F.floor(F.col("id") / 2).cast("long").alias(key), F.col("t").alias(name))
    out = lines.join(far(0, "_s"), key, "left").join(far(1, "_e"), key, "left")
    s, e = F.coalesce("_s", F.lit(0.0)), F.coalesce("_e", F.lit(0.0))
    return out.select(key, (x1 - ux * s).alias("x1"), (y1 - uy * s).alias("y1"), (x2 + ux * e).alias("x2"), (y2 + uy * e).alias("y2"), *[c for c in lines.columns if c not in (key, *ENDS)])


def clean_skeleton(roads: DataFrame, skeleton: DataFrame, least_rank: int, dropped: list[str], length: float, size: float, rounds: int = 5) -> DataFrame:
    """(seg, x1, y1, x2, y2): roads of a rank or more and not of the dropped kinds, extended to the skeleton, with the
    skeleton, less dangling ends."""
    held = roads.where((F.col("rank") >= least_rank) & ~F.col("kind").isin(dropped)).select("seg", *ENDS)
    refs = skeleton.select(F.col("seg").alias("fid"), *ENDS)
    longer = extend_to_reference(held, refs, length, size).select((F.col("seg") * 2 + 1).alias("seg"), *ENDS)
    return prune_dangling(longer.unionByName(skeleton.select((F.col("seg") * 2).alias("seg"), *ENDS)), rounds)


def tag_by_line(df: DataFrame, lines: DataFrame, size: float, reach: float, key: str = "fid") -> DataFrame:
    """df with `side`: 'on' where a box meets a segment of the line, else 'left' or 'right' of the nearest segment within
    reach of its middle, else null."""
    boxed = lines.select("seg", *ENDS, F.least("x1", "x2").alias("xmin"), F.least("y1", "y2").alias("ymin"), F.greatest("x1", "x2").alias("xmax"), F.greatest("y1", "y2").alias("ymax"))
    pairs = box_join(df.select(key, "xmin", "ymin", "xmax", "ymax"), boxed, size, pad=reach, closed=True)
    x1, y1, x2, y2 = (F.col(f"b_{c}") for c in ENDS)
    mx, my = (F.col("a_xmin") + F.col("a_xmax")) / 2, (F.col("a_ymin") + F.col("a_ymax")) / 2
    n = F.hypot(x2 - x1, y2 - y1)
    ux, uy = F.coalesce(F.try_divide(x2 - x1, n), F.lit(0.0)), F.coalesce(F.try_divide(y2 - y1, n), F.lit(0.0))
    on = F.coalesce(ray_hits_box(x1, y1, ux, uy, *[F.col(f"a_{c}") for c in ("xmin", "ymin", "xmax", "ymax")]) <= n, F.lit(False))
    d = segment_distance(mx, my, x1, y1, x2, y2)
    left = (x2 - x1) * (my - y1) - (y2 - y1) * (mx - x1) > 0
    best = pairs.where(on | (d <= reach)).groupBy(F.col(f"a_{key}").alias(key)).agg(F.max(on).alias("_on"), F.min(F.struct(d.alias("d"), F.col("b_seg").alias("s"), left.alias("l"))).alias("_n"))
    side = F.when(F.col("_on"), "on").when(F.col("_n.l"), "left").otherwise("right")
    return df.join(best.select(key, side.alias("side")), key, "left")


def allowed_merges(tagged: DataFrame, contacts: DataFrame, key: str = "fid") -> DataFrame:
    """Contacts (a, b, ...) between a polygon on the line and one beside it, or between two on the same side."""
    side = tagged.select(F.col(key).alias("a"), F.col("side").alias("_sa")), tagged.select(F.col(key).alias("b"), F.col("side").alias("_sb"))
    out = contacts.join(side[0], "a").join(side[1], "b")
    return out.where("(_sa = 'on') <> (_sb = 'on') OR (_sa = _sb AND _sa <> 'on')").drop("_sa", "_sb")


def smooth_coast(lines: DataFrame, rounds: int = 1, key: str = "seg") -> DataFrame:
    """(chain, segments, line): connected segments as one line, smoothed by cutting corners."""
    from arpent.functions.geometry import chaikin

    out = merge_connected_lines(lines, key)
    for _ in range(rounds):
        out = out.withColumn("line", chaikin(F.col("line")))
    return out
