"""Lines beside lines: offset curves, one-sided buffers, rings of a joint line; and the coast as a line of sea regions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arpent.functions import geometry as ge
from arpent.operators.joins import on_cells, segment_distance
from arpent.operators.lineage import stored
from arpent.operators.noding import _boxed, noded
from arpent.operators.outlines import ENDS, _doubles, dissolve_whole, joined_up, polygons_of, region_outlines, simplified_line
from arpent.operators.polygons import points_in_polygons
from arpent.operators.regions import connected_components


#: Segments of a list, and lists that may be broadcast.
LIST, FEW_LISTS = 64, 20_000


def _p(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _bounded(line: Column) -> Column:
    """The line without points equal to the one before."""
    return F.filter(line, lambda p, i: (i == 0) | (p != F.element_at(line, F.greatest(i, F.lit(1)))))


def _turn(u: tuple[Column, Column], v: tuple[Column, Column]) -> Column:
    return F.atan2(u[0] * v[1] - u[1] * v[0], u[0] * v[0] + u[1] * v[1])


def offset_curves(lines: DataFrame, d: float, size: float, key: str = "lid", line: str = "line", quarter: int = 8) -> DataFrame:
    """(key, points): the lines at distance d to their left, to their right for negative d.

    Where a line bends away, corners are arcs of 4 * quarter points a turn; where it bends towards the offset, neighbours
    are cut where they meet. Points that are nearer to any part of their line than d are left out, so tight bends are
    trimmed. A row a segment makes the points, a join on the line and the cells of a grid finds those to trim.
    """
    seg = ge.segments(_bounded(F.col(line)))
    each = stored(lines.select(key, seg.alias("_s")).select(key, F.posexplode("_s").alias("k", "s"), "_s").select(key, "k", F.col("s.p.x").alias("x1"), F.col("s.p.y").alias("y1"), F.col("s.q.x").alias("x2"), F.col("s.q.y").alias("y2"), F.try_element_at("_s", F.col("k") + 2)["q"].alias("n")))
    length, ahead = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")), F.hypot(F.col("n.x") - F.col("x2"), F.col("n.y") - F.col("y2"))
    e = each.withColumns({"ux": (F.col("x2") - F.col("x1")) / length, "uy": (F.col("y2") - F.col("y1")) / length, "vx": (F.col("n.x") - F.col("x2")) / ahead, "vy": (F.col("n.y") - F.col("y2")) / ahead})
    e = e.withColumn("turn", _turn((F.col("ux"), F.col("uy")), (F.col("vx"), F.col("vy"))))
    at = lambda x, y: _p(F.col(x) - F.col("uy") * d, F.col(y) + F.col("ux") * d)
    steps = F.greatest(F.lit(1), F.ceil(F.abs("turn") / (math.pi / 2 / quarter) - 1e-9)).cast("int")
    s = math.copysign(1.0, d)
    start = F.atan2(F.col("ux") * s, -F.col("uy") * s)
    arc = F.transform(F.sequence(F.lit(0), steps), lambda k: _p(F.col("x2") + abs(d) * F.cos(start + F.col("turn") * k / steps), F.col("y2") + abs(d) * F.sin(start + F.col("turn") * k / steps)))
    back = F.tan(F.col("turn") / 2) * d
    inner = F.array(_p(F.col("x2") - F.col("uy") * d - F.col("ux") * back, F.col("y2") + F.col("ux") * d - F.col("uy") * back))
    apart = F.array(at("x2", "y2"), _p(F.col("x2") - F.col("vy") * d, F.col("y2") + F.col("vx") * d))  # they do not meet before their ends
    meets = F.abs(back) <= F.least(length, ahead)
    bend = F.when(F.col("turn").isNull() | (F.abs("turn") < 1e-12), F.array(at("x2", "y2"))).when(F.col("turn") * d > 0, F.when(meets, inner).otherwise(apart)).otherwise(arc)
    first = F.when(F.col("k") == 0, F.array(at("x1", "y1"))).otherwise(F.array().cast("array<struct<x:double,y:double>>"))
    made = stored(e.select(key, "k", F.posexplode(F.concat(first, bend)).alias("j", "p")).select(key, "k", "j", "p.x", "p.y"))
    reach = abs(d)
    cells = on_cells(each, size, F.least("x1", "x2") - reach, F.least("y1", "y2") - reach, F.greatest("x1", "x2") + reach, F.greatest("y1", "y2") + reach).select(key, "_cx", "_cy", *ENDS)
    near = made.withColumns({"_cx": F.floor(F.col("x") / size), "_cy": F.floor(F.col("y") / size)}).join(cells, [key, "_cx", "_cy"])
    gone = near.where(segment_distance(F.col("x"), F.col("y"), *[F.col(c) for c in ENDS]) < reach * (1 - 1e-6)).select(key, "k", "j").distinct()
    left = made.join(gone, [key, "k", "j"], "left_anti").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("k", "j", "x", "y"))).alias("_l"))
    return left.select(key, F.transform("_l", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))


def _pie(p: Column, d: float, start: Column, turn: Column, quarter: int) -> Column:
    steps = F.greatest(F.lit(1), F.ceil(F.abs(turn) / (math.pi / 2 / quarter) - 1e-9)).cast("int")
    arc = F.transform(F.sequence(F.lit(0), steps), lambda k: _p(p["x"] + d * F.cos(start + turn * k / steps), p["y"] + d * F.sin(start + turn * k / steps)))
    return F.concat(F.array(p), arc, F.array(p))


def side_buffer(lines: DataFrame, d: float, size: float, key: str = "lid", line: str = "line", quarter: int = 8) -> DataFrame:
    """(key, rid, rings, area): all within d of a line on its left, on its right for negative d, flat at its ends.

    A box for each segment and a slice of a disk for each corner that bends away are dissolved line by line, cell by cell.
    """
    r, s = abs(d), math.copysign(1.0, d)
    pieces = lines.select(key, F.posexplode(ge.segments(_bounded(F.col(line)))).alias("k", "s"))
    p, q = F.col("s.p"), F.col("s.q")
    n = F.hypot(q["x"] - p["x"], q["y"] - p["y"])
    nx, ny = -(q["y"] - p["y"]) / n * d, (q["x"] - p["x"]) / n * d
    box = F.array(p, q, _p(q["x"] + nx, q["y"] + ny), _p(p["x"] + nx, p["y"] + ny), p)
    own = pieces.select(key, F.array(box).alias("rings"))
    after = pieces.select(key, (F.col("k") - 1).alias("k"), F.col("s").alias("t"))
    joint = pieces.join(after, [key, "k"])
    ux, uy, vx, vy = q["x"] - p["x"], q["y"] - p["y"], F.col("t.q.x") - F.col("t.p.x"), F.col("t.q.y") - F.col("t.p.y")
    turn = F.atan2(ux * vy - uy * vx, ux * vx + uy * vy)
    slices = joint.where(turn * s < 0).select(key, F.array(_pie(q, r, F.atan2(ux * s, -uy * s), turn, quarter)).alias("rings"))
    return dissolve_whole(own.union(slices), key, size)


def capsules(segments: DataFrame, d: Column, keep: list[str], quarter: int = 8, ends: bool = True) -> DataFrame:
    """(keep, rings): a box of width 2 d around each segment (x1, y1, x2, y2), and a disk of 4 * quarter corners about its first
    point, about its last too if `ends` is set."""
    n = 4 * quarter
    row = segments.select(*keep, *ENDS, d.cast("double").alias("_d"))
    circle = lambda x, y: F.array(*[_p(F.col(x) + F.col("_d") * math.cos(2 * math.pi * (k % n) / n), F.col(y) + F.col("_d") * math.sin(2 * math.pi * (k % n) / n)) for k in range(n + 1)])
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    nx, ny = -(F.col("y2") - F.col("y1")) / length * F.col("_d"), (F.col("x2") - F.col("x1")) / length * F.col("_d")
    box = F.array(_p(F.col("x1") - nx, F.col("y1") - ny), _p(F.col("x2") - nx, F.col("y2") - ny), _p(F.col("x2") + nx, F.col("y2") + ny), _p(F.col("x1") + nx, F.col("y1") + ny), _p(F.col("x1") - nx, F.col("y1") - ny))
    boxes = F.when(length > 0, F.array(F.array(box))).otherwise(F.array().cast("array<array<array<struct<x:double,y:double>>>>"))
    return row.select(*keep, F.explode(F.concat(boxes, F.array(*[F.array(circle(*c)) for c in (("x1", "y1"), ("x2", "y2"))[: 1 + ends]]))).alias("rings"))


def joint_buffer(df: DataFrame, d: float, size: float, by: str, quarter: int = 8) -> DataFrame:
    """(by, rid, rings, area): all within d of each group's polygons (rings), united; for negative d what lies deeper than -d in
    their union. A group of any size is united, and cut, cell by cell."""
    if d < 0:
        df = dissolve_whole(df.select(by, "rings"), by, size)
    rim = capsules(df.select(by, _doubles()), F.lit(abs(d)), [by], quarter, ends=False).withColumn("minus", F.lit(d < 0))
    return dissolve_whole(df.select(by, "rings", F.lit(False).alias("minus")).unionByName(rim), by, size)


def ring_zones(lines: DataFrame, width: float, n: int, size: float, key: str = "lid", quarter: int = 8) -> DataFrame:
    """(key, ring, rid, rings, area): n rings of a width around the united segments (key, x1, y1, x2, y2) of each key.

    Ring k is what lies within k * width of the line but not within (k - 1) * width: the outline of the larger buffer, and
    that of the smaller one turned round, as one set of outlines. Rings do not overlap, whatever the line's bends.
    """
    each = lines.select(key, *ENDS, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("ring"))
    names = stored(each.select(key, "ring").distinct().withColumn("g", F.monotonically_increasing_id()))
    pieces = capsules(each.join(names, [key, "ring"]), F.col("ring") * float(width), ["g"], quarter)
    zones = stored(dissolve_whole(pieces, "g", size).join(names, "g").select(key, "ring", "rings"))
    out = zones.select(key, "ring", _doubles())
    back = zones.where(F.col("ring") < n).select(key, (F.col("ring") + 1).alias("ring"), _doubles()).select(key, "ring", F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    edges = out.unionByName(back).join(names, [key, "ring"]).select("g", *ENDS, F.lit(False).alias("stop"))
    return polygons_of(joined_up(edges, 8 * size), 8 * size).join(names, "g").select(key, "ring", "rid", "rings", "area")


# --- the coast ---------------------------------------------------------------------------------------------------------


def sea_regions(px: DataFrame, sea: str, seeds: DataFrame) -> DataFrame:
    """px (r, c, x, y) of the regions of sea pixels (value 1) that hold a seed's pixel (r, c), with `region`."""
    reg = stored(connected_components(px.where(F.col(sea) == 1).select("pid", "r", "c", "x", "y", sea), sea))
    held = reg.join(seeds.select("r", "c").distinct(), ["r", "c"], "left_semi").select("region").distinct()
    return reg.join(held, "region", "left_semi").select("r", "c", "x", "y", "region")


def lines_within(segments: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """Segments (x1, y1, x2, y2) cut at the edges of polygons (rings), those pieces that lie in one."""
    rim = polygons.select(_doubles())
    every = stored(segments.select(*ENDS, F.lit(True).alias("own")).union(rim.select(*ENDS, F.lit(False))).withColumns({"sid": F.monotonically_increasing_id(), "g": F.lit(0)}))
    pieces = noded(every, size).join(every.where("own").select("sid"), "sid", "left_semi").drop("sid")
    mid = pieces.withColumns({"mx": (F.col("x1") + F.col("x2")) / 2, "my": (F.col("y1") + F.col("y2")) / 2})
    inside = points_in_polygons(mid, polygons.select("rings").withColumn("fid", F.lit(0)), size, "mx", "my")
    return inside.select(*[F.col(f"p_{c}").alias(c) for c in ENDS]).distinct()


def coastline(px: DataFrame, sea: str, seeds: DataFrame, valid: str, size: float = 1.0, close: float = 3.5, rim: float = 2.0, tolerance: float = 0.0, cell: float = 32.0, quarter: int = 4) -> DataFrame:
    """(closed, points, length): the border of the sea as lines.

    Sea regions are those of sea pixels with a seed in them. Their polygons are closed by a buffer of `close` and one of
    -close, which drops boats and joins near parts; their outlines are cut to what lies deeper than `rim` in the valid
    pixels (value 1), so that the picture's edge is no coast, joined up and simplified.
    """
    water = region_outlines(sea_regions(px, sea, seeds), "region", size).select("rings", F.lit(0).alias("g"))
    if close:
        wide = stored(joint_buffer(water, close, cell, "g", quarter).select("g", "rings"))
        water = stored(joint_buffer(wide, -close, cell, "g", quarter))
    ground = connected_components(px.where(F.col(valid) == 1).select("pid", "r", "c", "x", "y", valid), valid)
    inner = region_outlines(ground, "region", size).select("rings", F.lit(0).alias("g"))
    inner = stored(joint_buffer(inner, -rim, cell, "g", quarter) if rim else inner)
    kept = stored(lines_within(water.select(_doubles()), inner, 4 * size))
    lines = joined_up(kept.withColumns({"g": F.lit(0), "stop": F.lit(False)}), 8 * cell)
    points = simplified_line(F.col("points"), float(tolerance))
    return lines.select("closed", points.alias("points")).withColumn("length", ge.length(F.col("points")))


def side_and_distance(points: DataFrame, segments: DataFrame, size: float, x: str = "x", y: str = "y", key: str = "fid") -> DataFrame:
    """(key, distance, side): distance to the nearest segment (seg, x1, y1, x2, y2; ties to the smaller seg), and side 1 on its
    left, -1 on its right or on it. Grid squares double for the points that are not settled, as for `nearest_segment`."""
    ends = segments.agg(*[f(F.least(a, b) if f is F.min else F.greatest(a, b)) for a, b in (("x1", "x2"), ("y1", "y2")) for f in (F.min, F.max)]).first()
    far = points.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    if ends[0] is None or far[0] is None:
        return points.select(key).where("false").withColumns({"distance": F.lit(0.0), "side": F.lit(0)})
    reach = max(max(ends[i + 1], far[i + 1]) - min(ends[i], far[i]) for i in (0, 2))
    open_, done = points.select(key, F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py")), []
    while True:
        near = on_cells(_boxed(segments), size, F.least("x1", "x2") - size, F.least("y1", "y2") - size, F.greatest("x1", "x2") + size, F.greatest("y1", "y2") + size)
        # segments of a cell in lists of about LIST, so that a point meets a row a list, and not all points of a cell one task
        cells = near.groupBy("_cx", "_cy").agg(F.ceil(F.count("*") / LIST).alias("_n"))
        dealt = near.join(cells, ["_cx", "_cy"]).groupBy("_cx", "_cy", F.pmod(F.xxhash64("seg"), F.col("_n")).alias("_n"))
        lists = stored(dealt.agg(F.collect_list(F.struct("seg", *ENDS)).alias("_s")))
        lists = F.broadcast(lists) if lists.count() <= FEW_LISTS else lists

        def nearest(s: Column) -> Column:
            dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
            t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide((F.col("px") - s["x1"]) * dx + (F.col("py") - s["y1"]) * dy, dx * dx + dy * dy)))
            d = F.hypot(F.col("px") - s["x1"] - F.coalesce(t, F.lit(0.0)) * dx, F.col("py") - s["y1"] - F.coalesce(t, F.lit(0.0)) * dy)
            side = F.when(dx * (F.col("py") - s["y1"]) - dy * (F.col("px") - s["x1"]) > 0, 1).otherwise(-1)
            return F.struct(F.round(d, 9).alias("distance"), s["seg"].alias("seg"), side.alias("side"))

        q = open_.withColumns({"_cx": F.floor(F.col("px") / size), "_cy": F.floor(F.col("py") / size)}).join(lists, ["_cx", "_cy"])
        one = stored(q.select(key, F.array_min(F.transform("_s", nearest)).alias("_b")))  # else the lists would be sorted with the points
        best = one.groupBy(key).agg(F.min("_b").alias("_b")).select(key, "_b.distance", "_b.side")
        last = size >= reach
        held = stored(best if last else best.where(F.col("distance") <= size))
        done.append(held)
        if last:
            break
        open_ = stored(open_.join(held.select(key), key, "left_anti").repartition(points.sparkSession.sparkContext.defaultParallelism))  # narrow rows, which would come together in one task
        if open_.isEmpty():
            break
        size *= 2
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out

