"""Outlines: directed edges joined up to rings and lines, rings to polygons, and what is built on them.

Edges are first joined within square tiles, in one array step each; only the paths that leave a tile are joined by Spark, by
doubling: each path looks twice as far back in every round. So no outline of edges is ever gathered before it is short of
straight steps, and a feature comes together once, as its own row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arpent.functions import batches
from arpent.functions import geometry as ge
from arpent.functions.batches import in_order, successors
from arpent.operators.joins import points_in_boxes
from arpent.operators.lineage import stored
from arpent.operators.polygons import PARTS, explode_parts, with_box

LINE = "array<struct<x:double,y:double>>"
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])

ENDS = ("x1", "y1", "x2", "y2")


def _points(x: np.ndarray, y: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays([pa.array(x), pa.array(y)], fields=list(_POINT)))


# --- one tile ----------------------------------------------------------------------------------------------------------


def _chain_tile(keep: list[str], g: str):
    def run(key, table):
        k = table[g].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(table) else np.zeros(0, int)
        x1, y1, x2, y2 = (table[c].to_numpy() for c in ENDS)
        n, stop = len(k), table["stop"].to_numpy(zero_copy_only=False)
        kk, xx, yy = np.concatenate([k, k]), np.concatenate([x1, x2]), np.concatenate([y1, y2])
        order = np.lexsort((yy, xx, kk))
        new = np.concatenate([[True], (kk[order][1:] != kk[order][:-1]) | (xx[order][1:] != xx[order][:-1]) | (yy[order][1:] != yy[order][:-1])])
        place = np.empty(2 * n, np.int64)
        place[order] = np.cumsum(new) - 1
        angle = np.arctan2(y2 - y1, x2 - x1)
        head, far, closed = in_order(successors(place[:n], place[n:], angle, angle, stop))
        order = np.lexsort((far, head))
        first = np.flatnonzero(np.concatenate([[True], head[order][1:] != head[order][:-1]])) if n else np.zeros(0, int)
        a, b = order[first], order[np.append(first[1:], n) - 1] if n else order[first]
        columns = {c: table[c].take(pa.array(a)) for c in dict.fromkeys([g, *keep])}
        columns |= {"closed": pa.array(closed[a]), "stop": pa.array(stop[b]), "sx": pa.array(x1[a]), "sy": pa.array(y1[a]), "ex": pa.array(x2[b]), "ey": pa.array(y2[b]), "out_angle": pa.array(angle[a]), "in_angle": pa.array(angle[b])}
        return pa.table(columns | {"points": _points(x1[order], y1[order], np.append(first, n))})

    return run


# --- all tiles ---------------------------------------------------------------------------------------------------------


def _doubled(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(pid, at, far, low): the start of each path's chain, how far back it is, and the least path on the way.

    links: (pid, before). In each round a path sees as far again as what it has seen to. On a ring there is no start, and
    `at` keeps going round; the rounds end when nothing lower is seen and no more starts are reached.
    """
    state = stored(nodes.join(links, "pid", "left").select("pid", F.coalesce("before", "pid").alias("at"), F.col("before").isNotNull().cast("long").alias("far"), F.least("pid", F.coalesce("before", "pid")).alias("low"), F.col("before").isNull().alias("done")))
    waiting = -1
    while True:
        back = state.select(F.col("pid").alias("at"), F.col("at").alias("_at"), F.col("far").alias("_far"), F.col("low").alias("_low"), F.col("done").alias("_done"))
        new = state.join(back, "at")
        new = stored(new.select("pid", F.when(F.col("done"), F.col("at")).otherwise(F.col("_at")).alias("at"), F.when(F.col("done"), F.col("far")).otherwise(F.col("far") + F.col("_far")).alias("far"), F.least("low", "_low").alias("low"), (F.col("done") | F.col("_done")).alias("done"), (F.col("_low") < F.col("low")).alias("_moved")))
        moved, open_ = new.agg(F.sum(F.col("_moved").cast("long")), F.sum((~F.col("done")).cast("long"))).first()
        state = new.drop("_moved")
        if not open_ or (not moved and open_ == waiting):
            return state
        waiting = open_


def joined_up(edges: DataFrame, size: float, g: str = "g", keep: list[str] | None = None) -> DataFrame:
    """(g, keep, closed, points): edges (g, x1, y1, x2, y2, stop) of equal g joined end to start, as far as they go.

    Places are equal if their coordinates are. Where several go on, the sharpest turn to the left is taken; none goes on
    from an edge marked `stop`. keep: columns that are the same along a line, taken from its first edge. A closed line has
    its first point last as well. size: width of the tiles in which edges are joined first.
    """
    keep = keep or []
    fields = [edges.schema[c] for c in dict.fromkeys([g, *keep])]
    schema = T.StructType([*fields, *[T.StructField(c, T.BooleanType()) for c in ("closed", "stop")], *[T.StructField(c, T.DoubleType()) for c in ("sx", "sy", "ex", "ey", "out_angle", "in_angle")], T.StructField("points", T._parse_datatype_string(LINE))])
    tiles = edges.select(*dict.fromkeys([g, *keep]), *[F.col(c).cast("double").alias(c) for c in ENDS], "stop").withColumns({"_tx": F.floor(F.col("x1") / size), "_ty": F.floor(F.col("y1") / size)})
    paths = stored(tiles.groupBy("_tx", "_ty").applyInArrow(_chain_tile(keep, g), schema).withColumn("pid", F.monotonically_increasing_id()))
    ends = paths.where("NOT closed AND NOT stop").select(F.col("pid").alias("before"), F.col(g).alias("_g"), "ex", "ey", "in_angle")
    starts = paths.where("NOT closed").select("pid", F.col(g).alias("_h"), "sx", "sy", "out_angle")
    turn = F.pmod(F.col("out_angle") - F.col("in_angle") + math.pi, F.lit(2 * math.pi))
    turn = F.when(turn > 2 * math.pi - 1e-9, 0.0).otherwise(turn)
    meet = ends.join(starts, F.col("_g").eqNullSafe(F.col("_h")) & (F.col("ex") == F.col("sx")) & (F.col("ey") == F.col("sy")))
    best = meet.groupBy("before").agg(F.max(F.struct(turn.alias("t"), (-F.col("pid")).alias("p"), "pid"))["pid"].alias("pid"))
    links = stored(best.groupBy("pid").agg(F.min("before").alias("before")))
    if links.isEmpty():
        ranked = paths.select("pid", F.col("pid").alias("chain"), F.lit(0).cast("long").alias("far"), F.lit(False).alias("ring"))
    else:
        nodes = links.select("pid").union(links.select("before")).distinct()
        seen = _doubled(links, nodes)
        rings = seen.where("NOT done").select(F.col("low").alias("pid")).distinct()
        if not rings.isEmpty():
            round_ = seen.where("NOT done").select("pid", F.lit(True).alias("ring"))
            seen = _doubled(links.join(rings, "pid", "left_anti"), nodes).join(round_, "pid", "left")
        else:
            seen = seen.withColumn("ring", F.lit(False))
        ranked = seen.select("pid", F.col("at").alias("chain"), "far", F.coalesce("ring", F.lit(False)).alias("ring"))
    held = paths.join(ranked, "pid", "left").withColumn("chain", F.coalesce("chain", "pid")).withColumn("far", F.coalesce("far", F.lit(0)))
    whole = held.groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("far", "points", "ex", "ey"))).alias("_p"), F.max(F.col("closed") | F.coalesce("ring", F.lit(False))).alias("closed"), *[F.min_by(c, "far").alias(c) for c in dict.fromkeys([g, *keep])])
    flat = F.flatten(F.transform("_p", lambda p: p["points"]))
    last = F.element_at("_p", -1)
    end = F.when(F.col("closed"), F.element_at(flat, 1)).otherwise(F.struct(last["ex"].alias("x"), last["ey"].alias("y")))
    return whole.select(*dict.fromkeys([g, *keep]), "closed", F.concat(flat, F.array(end)).alias("points"))


def _without_spikes(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Places of a ring's points without ways that go back where they came from."""
    held: list[int] = []
    for i in range(len(x)):
        held.append(i)
        while len(held) > 2 and x[held[-1]] == x[held[-3]] and y[held[-1]] == y[held[-3]]:
            del held[-2:]
    a, b = 0, len(held) - 1
    while b - a > 1 and x[held[a + 1]] == x[held[b]] and y[held[a + 1]] == y[held[b]]:
        a, b = a + 1, b - 1
    return held[a + 1 if a else 0 : b + 1]


def _tidy(points: pa.Array) -> pa.Array:
    """Closed rings without spikes and points on straight lines, and their signed areas; all rings of a batch in one step."""
    values, at = points.flatten(), np.concatenate([[0], np.cumsum(np.array(points.value_lengths().fill_null(0)))])
    x, y = (values.field(c).to_numpy() for c in (0, 1))
    own = np.ones(len(x), bool)
    own[(at[1:] - 1)[np.diff(at) > 0]] = False  # the closing points
    x, y, n = x[own], y[own], np.maximum(np.diff(at) - 1, 0)

    def around(n: np.ndarray):
        ring, first = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
        i = np.arange(n.sum())
        return ring, first, np.where(i == first[ring], first[ring] + n[ring] - 1, i - 1), np.where(i == (first + n - 1)[ring], first[ring], i + 1)

    ring, first, prev, next_ = around(n)
    spiked = np.unique(ring[(x[prev] == x[next_]) & (y[prev] == y[next_])])
    if len(spiked):
        keep = np.ones(len(x), bool)
        for k in spiked.tolist():
            a, b = first[k], first[k] + n[k]
            keep[a:b] = False
            keep[a + np.array(_without_spikes(x[a:b], y[a:b]), int)] = True
        x, y, n = x[keep], y[keep], np.bincount(ring[keep], minlength=len(n))
        ring, first, prev, next_ = around(n)
    ax, ay, bx, by = x - x[prev], y - y[prev], x[next_] - x, y[next_] - y
    bend = np.abs(ax * by - ay * bx) > 1e-9 * (np.hypot(ax, ay) * np.hypot(bx, by) + 1e-300)
    cx, cy = x - x[first[ring]], y - y[first[ring]]
    area = np.bincount(ring, cx * cy[next_] - cx[next_] * cy, len(n)) / 2
    x, y, m = x[bend], y[bend], np.bincount(ring[bend], minlength=len(n))
    begin = np.cumsum(m) - m
    ends = np.concatenate([[0], np.cumsum(m + (m > 0))])
    take = np.arange(ends[-1]) - np.repeat(np.cumsum(m > 0) - (m > 0), m + (m > 0))  # a ring's points, then its first again
    take[ends[1:][m > 0] - 1] = begin[m > 0]
    lists = _points(x[take], y[take], ends)
    return pa.StructArray.from_arrays([lists, pa.array(area)], ["ring", "area"])


def tidy(points: Column) -> Column:
    """(ring, area) of a closed line."""

    @F.arrow_udf("struct<ring:array<struct<x:double,y:double>>,area:double>")
    def made(a: pa.Array) -> pa.Array:
        return _tidy(a)

    return made(points)


def polygons_of(lines: DataFrame, size: float, g: str = "g") -> DataFrame:
    """(g, part, rings, area): polygons from closed lines of `joined_up`, inside on their left.

    Rings against the clock are outer ones. A hole goes to the smallest outer ring of its g that holds a point just beside
    it. Boxes find the candidates on a grid of the given size; part numbers the polygons of a g from 0.
    """
    r = stored(lines.where("closed").select(g, tidy(F.col("points")).alias("_t")).select(g, F.col("_t.ring").alias("ring"), F.col("_t.area").alias("area")).where(F.size("ring") > 3).withColumn("rid", F.monotonically_increasing_id()))
    outer = r.where("area > 0").select(F.col(g).alias("g"), "rid", "area", F.array("ring").alias("rings"))
    holes = r.where("area < 0").select(F.col(g).alias("_g"), F.col("ring").alias("hole"), F.col("area").alias("_less"), F.col("rid").alias("hid"))
    p, q = F.element_at("hole", 1), F.element_at("hole", 2)
    n = F.hypot(q["x"] - p["x"], q["y"] - p["y"])
    step = F.least(F.lit(1e-6), n / 4)
    probe = holes.select("_g", "hid", "hole", "_less", ((p["x"] + q["x"]) / 2 - (q["y"] - p["y"]) / n * step).alias("x"), ((p["y"] + q["y"]) / 2 + (q["x"] - p["x"]) / n * step).alias("y"))
    of = with_box(outer.join(holes.select(F.col("_g").alias("g")).distinct(), "g", "left_semi"))
    inside = points_in_boxes(probe, of, size).where((F.col("p__g") == F.col("b_g")) & ge.contains(F.col("b_rings"), F.col("p_x"), F.col("p_y")))
    owner = inside.groupBy("p_hid").agg(F.min_by(F.struct("b_rid", "p_hole", "p__less"), F.struct("b_area", "b_rid")).alias("_o"))
    cut = owner.groupBy(F.col("_o.b_rid").alias("rid")).agg(F.array_sort(F.collect_list("_o.p_hole")).alias("_holes"), F.sum("_o.p__less").alias("_less"))
    whole = outer.join(cut, "rid", "left").select(F.col("g").alias(g), "rid", F.when(F.col("_holes").isNull(), F.col("rings")).otherwise(F.concat("rings", "_holes")).alias("rings"), (F.col("area") + F.coalesce("_less", F.lit(0.0))).alias("area"))
    return whole


# --- regions of pixels -------------------------------------------------------------------------------------------------

_SIDES = [(1, 0, (-1, -1), (1, -1)), (0, 1, (1, -1), (1, 1)), (-1, 0, (1, 1), (-1, 1)), (0, -1, (-1, 1), (-1, -1))]  # rows grow downwards


def pixel_borders(px: DataFrame, region: str, size: float = 1.0) -> DataFrame:
    """(region, other, x1, y1, x2, y2): the sides of labelled pixels (r, c, x, y) beyond which another region, or none, lies;
    the region is on the left."""
    h = size / 2
    sides = [F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), *[(F.col(c) + k * h).alias(n) for n, c, k in zip(ENDS, "xyxy", (*p, *q), strict=True)]) for dr, dc, p, q in _SIDES]
    edges = px.select(F.col(region).alias("region"), "r", "c", F.inline(F.array(*sides)))
    edges = edges.withColumn("r", F.col("r") + F.col("dr")).withColumn("c", F.col("c") + F.col("dc")).drop("dr", "dc")
    return edges.join(px.select("r", "c", F.col(region).alias("other")), ["r", "c"], "left").where("other IS NULL OR other <> region").select("region", "other", *ENDS)


def region_outlines(px: DataFrame, region: str, size: float = 1.0, tile: float = 256.0) -> DataFrame:
    """(region, rid, rings, area): the polygons of labelled pixels, holes included; one row a polygon."""
    edges = pixel_borders(px, region, size).withColumn("stop", F.lit(False))
    return polygons_of(joined_up(edges, tile * size, "region"), tile * size, "region")


# --- coverages ---------------------------------------------------------------------------------------------------------


def _doubles(rings: str = "rings") -> Column:
    return F.inline(F.flatten(F.transform(rings, lambda r: F.transform(ge.segments(r), lambda s: F.struct(s["p"]["x"].alias("x1"), s["p"]["y"].alias("y1"), s["q"]["x"].alias("x2"), s["q"]["y"].alias("y2"))))))


def arcs(borders: DataFrame, tile: float) -> DataFrame:
    """(a, b, closed, points): borders (region, other, x1, y1, x2, y2; region on the left) between two regions, each once for
    both, from node to node; b is null at the outside. Nodes are places where more than two borders meet."""
    once = borders.where("other IS NULL OR region < other").select(F.col("region").alias("a"), F.col("other").alias("b"), *ENDS)
    places = once.select(F.inline(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))))
    nodes = places.groupBy("x", "y").count().where("count <> 2").select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.lit(True).alias("stop"))
    marked = once.join(nodes, ["x2", "y2"], "left").withColumns({"stop": F.coalesce("stop", F.lit(False)), "g": F.lit(0)})
    return joined_up(marked, tile, "g", ["a", "b"]).drop("g")


def _simplified(points: pa.Array, tolerance: float) -> pa.Array:
    values, at = points.flatten(), np.concatenate([[0], np.cumsum(np.array(points.value_lengths()))])
    x, y = (values.field(c).to_numpy() for c in (0, 1))
    held = batches.simplified(x, y, at, tolerance)
    return _points(x[held], y[held], np.concatenate([[0], np.cumsum(held)])[at])


def simplified_line(points: Column, tolerance: float) -> Column:
    @F.arrow_udf(LINE)
    def made(a: pa.Array) -> pa.Array:
        return _simplified(a, tolerance)

    return made(points)


def rebuilt(lines: DataFrame, tile: float) -> DataFrame:
    """(region, rid, rings, area): polygons of both sides of arcs (a, b, points)."""
    back = F.reverse("points")
    both = lines.select(F.col("a").alias("region"), "points").union(lines.where("b IS NOT NULL").select(F.col("b"), back))
    edges = both.select("region", F.inline(F.transform(ge.segments(F.col("points")), lambda s: F.struct(s["p"]["x"].alias("x1"), s["p"]["y"].alias("y1"), s["q"]["x"].alias("x2"), s["q"]["y"].alias("y2")))))
    return polygons_of(joined_up(edges.withColumn("stop", F.lit(False)), tile, "region"), tile, "region")


def simplify_coverage(borders: DataFrame, tolerance: float, tile: float, outer: bool = True) -> DataFrame:
    """(region, rid, rings, area): a coverage whose borders are simplified, each once for both regions, nodes staying.
    Without `outer` the borders to the outside stay as they are.

    borders: as of pixel_borders or polygon_borders. As both sides take the same line, no gap or overlap arises between
    neighbours. A region thinner than the tolerance may go, or overlap another where its borders cross. Islands keep four
    points at least.
    """
    lines = arcs(borders, tile)
    points = simplified_line(F.col("points"), float(tolerance))
    return rebuilt(lines.withColumn("points", points if outer else F.when(F.col("b").isNull(), F.col("points")).otherwise(points)), tile)


def with_source(made: DataFrame, source: DataFrame, size: float, key: str = "fid", least: float = 0.5) -> DataFrame:
    """made (rings, rid) with the key of the source polygon that covers more than a share of it; rows without one go."""
    from arpent.operators.polygons import meeting

    pairs = meeting(made.select("rid", "rings"), source.select(key, "rings"), size)
    held = pairs.where(F.col("area") > least * ge.area(F.col("a_rings"))).select(F.col("a_rid").alias("rid"), F.col(f"b_{key}").alias(key))
    return made.join(held, "rid")


def polygon_borders(df: DataFrame, key: str = "fid") -> DataFrame:
    """(region, other, x1, y1, x2, y2): edges of the polygons of a coverage, whose neighbours have the same corners."""
    e = df.select(F.col(key).alias("region"), _doubles())
    back = e.select(F.col("region").alias("other"), F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    return e.join(back, list(ENDS), "left").select("region", "other", *ENDS)


# --- dissolve ----------------------------------------------------------------------------------------------------------

#: Coordinates nearer than this share of a cell to its sides, or to each other along one, are the same.
SNAP = 1e-9


def _cell_unions(df: DataFrame, by: str, size: float) -> DataFrame:
    """(by, _cx, _cy, parts): in each cell of a grid the union of each group's polygons, without those marked `minus`."""
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))
    cells = with_box(df.select(by, "rings", "minus")).withColumn("_cx", span("xmin", "xmax")).withColumn("_cy", span("ymin", "ymax"))

    @F.arrow_udf(PARTS)
    def joined(plus: pa.Array, minus: pa.Array, cx: pa.Array, cy: pa.Array) -> pa.Array:
        i, j = (c.to_numpy(zero_copy_only=False).astype(float) for c in (cx, cy))
        return batches.in_cells(plus, minus, np.column_stack([i * size, j * size, (i + 1) * size, (j + 1) * size]))

    lists = cells.groupBy(by, "_cx", "_cy").agg(F.collect_list(F.when(~F.col("minus"), F.col("rings"))).alias("_l"), F.collect_list(F.when(F.col("minus"), F.col("rings"))).alias("_m"))
    return lists.where(F.size("_l") > 0).select(by, "_cx", "_cy", joined("_l", "_m", "_cx", "_cy").alias("parts")).where(F.size("parts") > 0)


#: Lines, and cells along them, whose sides are met in one array step.
SIDE_BLOCK = 16


def _meet_on_sides(by: str, size: float):
    """For the sides of a block of cells and all groups: what the two cells' edges along each side leave over, and equal names
    for equal places.

    Edges along a side count +1 or -1 by direction. Where they cancel, the union goes on in the next cell.
    """

    def run(key, table):
        g = table[by].combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        line, cell, edge = (table[c].to_numpy() for c in ("line", "cell", "edge"))
        n, v = len(g), np.concatenate([table["s"].to_numpy(), table["e"].to_numpy()])
        twice = [np.concatenate([c, c]) for c in (g, line, cell)]
        order = np.lexsort((v, *twice))
        v_, other = v[order], np.zeros(2 * n - 1, bool)
        for c in twice:
            other |= c[order][1:] != c[order][:-1]
        new = np.concatenate([[True], other | (np.diff(v_) > SNAP * size)])
        first, at = np.flatnonzero(new), np.empty(2 * n, np.int64)
        at[order] = np.cumsum(new) - 1
        cuts, row = v_[first], order[first] % n  # a place, and a row of its side and group
        s, e = at[:n][edge], at[n:][edge]
        net = np.cumsum(np.bincount(s, minlength=len(cuts)) - np.bincount(e, minlength=len(cuts)))  # 0 at a side's last place
        left = np.flatnonzero(net)
        a, b = np.where(net[left] > 0, (cuts[left], cuts[left + 1]), (cuts[left + 1], cuts[left]))
        moved = np.flatnonzero((v_ != cuts[at[order]]) & np.concatenate([[True], other | (np.diff(v_) != 0)]))  # each place once
        rows = table.take(pa.array(np.concatenate([row[left], order[moved] % n])))
        out = {"edge": pa.array(np.arange(len(rows)) < len(left)), "a": pa.array(np.concatenate([a, v_[moved]])), "b": pa.array(np.concatenate([b, cuts[at[order[moved]]]]))}
        return pa.table({by: rows[by], **out, **{c: rows[c] for c in ("upright", "line", "cell")}})

    return run


def dissolve_whole(df: DataFrame, by: str, size: float) -> DataFrame:
    """(by, rid, rings, area): the union of each group's polygons, one row for each connected part, seamless.

    Polygons have no ring that crosses itself or another; those with a true `minus` are taken away. The union is made cell by cell. Then edges along a side between two cells cancel, places on sides get one name for both
    cells, and the edges that are left are joined up to rings. Every step but the last sees a cell or a side only.
    """
    df = df if "minus" in df.columns else df.withColumn("minus", F.lit(False))
    one = explode_parts(_cell_unions(df, by, size), "parts")
    near = lambda v, c: F.when(F.abs(v - c * size) <= SNAP * size, c * size).when(F.abs(v - (c + 1) * size) <= SNAP * size, (c + 1) * size).otherwise(v)
    e = one.select(by, "_cx", "_cy", _doubles()).withColumns({n: near(F.col(n), F.col("_cx" if n[0] == "x" else "_cy")) for n in ENDS}).where("x1 <> x2 OR y1 <> y2")
    e = stored(e)
    on = {("x", k): (F.col(f"x{k}") == F.col("_cx") * size) | (F.col(f"x{k}") == (F.col("_cx") + 1) * size) for k in (1, 2)} | {("y", k): (F.col(f"y{k}") == F.col("_cy") * size) | (F.col(f"y{k}") == (F.col("_cy") + 1) * size) for k in (1, 2)}
    upright = (F.col("x1") == F.col("x2")) & on["x", 1]
    level = (F.col("y1") == F.col("y2")) & on["y", 1]
    line = lambda v: F.round(F.col(v) / size).cast("long")
    along = [e.where(upright).select(by, F.lit(True).alias("upright"), line("x1").alias("line"), F.col("_cy").cast("long").alias("cell"), F.lit(True).alias("edge"), F.col("y1").alias("s"), F.col("y2").alias("e"))]
    along.append(e.where(level & ~upright).select(by, F.lit(False), line("y1"), F.col("_cx").cast("long"), F.lit(True), F.col("x1"), F.col("x2")))
    free = e.where(~upright & ~level)
    for k in (1, 2):
        along.append(free.where(on["x", k]).select(by, F.lit(True), line(f"x{k}"), F.col("_cy").cast("long"), F.lit(False), F.col(f"y{k}"), F.col(f"y{k}")))
        along.append(free.where(on["y", k] & ~on["x", k]).select(by, F.lit(False), line(f"y{k}"), F.col("_cx").cast("long"), F.lit(False), F.col(f"x{k}"), F.col(f"x{k}")))
    sides = along[0]
    for more in along[1:]:
        sides = sides.union(more)
    kind = df.schema[by].dataType.simpleString()
    met = stored(sides.groupBy("upright", F.floor(F.col("line") / SIDE_BLOCK), F.floor(F.col("cell") / SIDE_BLOCK)).applyInArrow(_meet_on_sides(by, size), f"`{by}` {kind}, edge boolean, a double, b double, upright boolean, line long, cell long"))
    at = F.col("line") * size
    left = met.where("edge").select(by, *[F.when(F.col("upright"), v if i % 2 == 0 else w).otherwise(w if i % 2 == 0 else v).alias(n) for i, (n, v, w) in enumerate(zip(ENDS, (at, at, at, at), (F.col("a"), F.col("a"), F.col("b"), F.col("b")), strict=True))])
    names = met.where("NOT edge").select(F.col(by).alias("_by"), *[F.when(F.col("upright"), at if c == "x" else F.col(v)).otherwise(F.col(v) if c == "x" else at).alias(n) for n, c, v in (("_x", "x", "a"), ("_y", "y", "a"), ("_u", "x", "b"), ("_v", "y", "b"))]).dropDuplicates(["_by", "_x", "_y"])
    inner = free.select(by, *ENDS)
    for k in (1, 2):
        hit = inner.join(names, F.col(by).eqNullSafe(F.col("_by")) & (F.col(f"x{k}") == F.col("_x")) & (F.col(f"y{k}") == F.col("_y")), "left")
        inner = hit.withColumns({f"x{k}": F.coalesce("_u", f"x{k}"), f"y{k}": F.coalesce("_v", f"y{k}")}).select(by, *ENDS)
    edges = inner.union(left).where("x1 <> x2 OR y1 <> y2").withColumn("stop", F.lit(False))
    return polygons_of(joined_up(edges, 8 * size, by), 8 * size, by)
