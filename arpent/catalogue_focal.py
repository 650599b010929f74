"""Registered queries of windows on halo tiles: wide ones, textures, edges, shadows and the sun."""

from __future__ import annotations

from pyspark.sql import functions as F

from arpent.catalogue import query, r6
from arpent.functions.solar import DECLINATION, EQUATION_OF_TIME, sun_position
from arpent.operators import focal as fo
from arpent.operators import textures as tx

#: Each pixel with the pixels of a square around it, by equal row and column.
_NB = "p.pid, n.{v} AS v, n.r - p.r AS dr, n.c - p.c AS dc FROM px p CROSS JOIN (SELECT i, j FROM range(-{k}, {k} + 1) a(i), range(-{k}, {k} + 1) b(j)) o JOIN px n ON n.r = p.r + o.i AND n.c = p.c + o.j"


@query("foc_majority_wide", f"WITH n AS (SELECT {_NB.format(v='cls', k=10)} WHERE (n.r - p.r) ** 2 + (n.c - p.c) ** 2 <= 100), m AS (SELECT pid, v, count(*) AS k, max((dr = 0 AND dc = 0)::INT) AS own FROM n GROUP BY pid, v) SELECT pid, arg_min(v, (-k, -own, v)) AS majority FROM m GROUP BY pid")
def _(t):
    return fo.majority_filter(t("px").select("pid", "r", "c", "cls"), "cls", 10).select("pid", "majority")


@query("foc_closing", f"""WITH b AS (SELECT pid, r, c, (red > 60)::INT AS m FROM px), e AS (SELECT pid, max(v) AS m FROM (SELECT {_NB.format(v='m', k=2).replace('px ', 'b ')} WHERE (n.r - p.r) ** 2 + (n.c - p.c) ** 2 <= 4) GROUP BY pid),
f AS (SELECT b.pid, b.r, b.c, e.m FROM b JOIN e USING (pid)) SELECT pid, min(v) AS closed FROM (SELECT {_NB.format(v='m', k=2).replace('px ', 'f ')} WHERE (n.r - p.r) ** 2 + (n.c - p.c) ** 2 <= 4) GROUP BY pid""")
def _(t):
    m = t("px").select("pid", "r", "c", (F.col("red") > 60).cast("int").alias("m"))
    return fo.closing(m, "m", 2, "closed").select("pid", "closed")


@query("foc_edge_gradient", """SELECT p.pid, round(sqrt((coalesce(e.nir, p.nir) - coalesce(w.nir, p.nir)) ** 2 + (coalesce(s.nir, p.nir) - coalesce(n.nir, p.nir)) ** 2) / 2, 6) AS gradient
FROM px p LEFT JOIN px e ON e.r = p.r AND e.c = p.c + 1 LEFT JOIN px w ON w.r = p.r AND w.c = p.c - 1 LEFT JOIN px s ON s.r = p.r + 1 AND s.c = p.c LEFT JOIN px n ON n.r = p.r - 1 AND n.c = p.c""")
def _(t):
    return fo.gradient(t("px").select("pid", "r", "c", "nir"), "nir").select("pid", *r6("gradient"))


_HALF = "coalesce(avg(v) FILTER ({s} {o} 0), 0)"
_RATIO = "CASE WHEN {a} <> 0 AND {b} <> 0 THEN 1 - least({a} / {b}, {b} / {a}) ELSE 0 END"
_FOUR = ", ".join(f"{_HALF.format(s=s, o=o)} AS {n}{k}" for k, s in enumerate(("dr", "dc", "(dr + dc)", "(dr - dc)")) for n, o in (("a", ">"), ("b", "<")))


@query("foc_edge_touzi", f"WITH n AS (SELECT {_NB.format(v='nir', k=2)}), m AS (SELECT pid, {_FOUR} FROM n GROUP BY pid) SELECT pid, round(greatest({', '.join(_RATIO.format(a=f'a{k}', b=f'b{k}') for k in range(4))}), 6) AS edge FROM m")
def _(t):
    return fo.touzi(t("px").select("pid", "r", "c", "nir"), "nir", 2).select("pid", *r6("edge"))


#: Shares p of level pairs (i, j) in each window, and what follows from them.
_PAIRS = """WITH g AS (SELECT pid, r, c, CAST(least(7, floor(red / 256 * 8)) AS INTEGER) AS a FROM px), q AS (SELECT g.r, g.c, g.a * 8 + h.a AS k FROM g JOIN g h ON h.r = g.r AND h.c = g.c + 1),
n AS (SELECT g.r, g.c, q.k AS v FROM g CROSS JOIN (SELECT i, j FROM range(-1, 2) a(i), range(-1, 2) b(j)) o JOIN q ON q.r = g.r + o.i AND q.c = g.c + o.j),
s AS (SELECT r, c, v, count(*) AS k FROM n GROUP BY r, c, v), w AS (SELECT r, c, k / sum(k) OVER (PARTITION BY r, c)::DOUBLE AS p, v // 8 AS i, v % 8 AS j FROM s),
m AS (SELECT r, c, sum(i * p) AS mu FROM w GROUP BY r, c), x AS (SELECT r, c, i, sum(p) AS p FROM w GROUP BY r, c, i), y AS (SELECT r, c, j, sum(p) AS p FROM w GROUP BY r, c, j),
hx AS (SELECT r, c, -sum(p * ln(p)) AS hx, greatest(sum(p * p) / 8 - 1.0 / 64, 0) AS sx FROM x GROUP BY r, c), hy AS (SELECT r, c, -sum(p * ln(p)) AS hy FROM y GROUP BY r, c)"""


@query("foc_texture_simple", f"""{_PAIRS}, o AS (SELECT r, c, sum(p * p) AS energy, -sum(p * ln(p)) AS entropy, sum((i - mu) * (j - mu) * p) AS co, sum((i - mu) ** 2 * p) AS va, sum(p / (1 + (i - j) ** 2)) AS idm, sum((i - j) ** 2 * p) AS inertia,
sum((i + j - 2 * mu) ** 3 * p) AS cluster_shade, sum((i + j - 2 * mu) ** 4 * p) AS cluster_prominence, sum(i * j * p) AS ij FROM w JOIN m USING (r, c) GROUP BY r, c)
SELECT r, c, round(energy, 6) AS energy, round(entropy, 6) AS entropy, round(CASE WHEN va > 1e-12 THEN co / va ELSE 0 END, 6) AS correlation, round(idm, 6) AS idm, round(inertia, 6) AS inertia, round(cluster_shade, 5) AS cluster_shade, round(cluster_prominence, 4) AS cluster_prominence,
round(CASE WHEN sx > 1e-12 THEN (ij - 1.0 / 64) / sx ELSE 0 END, 3) AS haralick_correlation FROM o JOIN hx USING (r, c)""")
def _(t):
    out = tx.cooccurrence(t("px").select("r", "c", "red"), "red", 8, 0, 256, 1)
    return out.select("r", "c", *r6("energy", "entropy", "correlation", "idm", "inertia"), F.round("cluster_shade", 5).alias("cluster_shade"), F.round("cluster_prominence", 4).alias("cluster_prominence"), F.round("haralick_correlation", 3).alias("haralick_correlation"))


@query("foc_texture_advanced", f"""{_PAIRS}, u AS (SELECT r, c, i + j AS k, sum(p) AS p FROM w GROUP BY r, c, i + j), d AS (SELECT r, c, abs(i - j) AS k, sum(p) AS p FROM w GROUP BY r, c, abs(i - j)),
um AS (SELECT r, c, sum(k * p) AS a, -sum(p * ln(p)) AS e FROM u GROUP BY r, c), uv AS (SELECT r, c, sum((k - a) ** 2 * p) AS v FROM u JOIN um USING (r, c) GROUP BY r, c),
dm AS (SELECT r, c, sum(k * p) AS a, -sum(p * ln(p)) AS e FROM d GROUP BY r, c), dv AS (SELECT r, c, sum((k - a) ** 2 * p) AS v FROM d JOIN dm USING (r, c) GROUP BY r, c),
o AS (SELECT w.r, w.c, min(mu) AS mu, sum((w.i - mu) ** 2 * w.p) AS va, sum(abs(w.i - w.j) * w.p) AS di, -sum(w.p * ln(w.p)) AS h, -sum(w.p * ln(x.p * y.p)) AS h1 FROM w JOIN m USING (r, c) JOIN x ON x.r = w.r AND x.c = w.c AND x.i = w.i JOIN y ON y.r = w.r AND y.c = w.c AND y.j = w.j GROUP BY w.r, w.c)
SELECT o.r, o.c, round(mu, 6) AS mean_, round(va, 6) AS variance_, round(di, 6) AS dissimilarity, round(um.a, 6) AS sum_average, round(uv.v, 5) AS sum_variance, round(um.e, 6) AS sum_entropy, round(dm.e, 6) AS difference_entropy, round(dv.v, 5) AS difference_variance,
round(CASE WHEN greatest(hx, hy) > 1e-12 THEN (h - h1) / greatest(hx, hy) ELSE 0 END, 5) AS ic1, round(sqrt(greatest(0, 1 - exp(-2 * (hx + hy - h)))), 3) AS ic2
FROM o JOIN hx USING (r, c) JOIN hy USING (r, c) JOIN um USING (r, c) JOIN uv USING (r, c) JOIN dm USING (r, c) JOIN dv USING (r, c)""")
def _(t):
    out = tx.cooccurrence(t("px").select("r", "c", "red"), "red", 8, 0, 256, 1, names=tx.ADVANCED)
    fine = {"sum_variance": 5, "difference_variance": 5, "ic1": 5, "ic2": 3}
    return out.select("r", "c", *[F.round(n, fine.get(n, 6)).alias(n) for n in tx.ADVANCED])


@query("foc_texture_runs", """WITH g AS (SELECT r, c, CAST(least(7, floor(red / 256 * 3)) AS INTEGER) + 1 AS a FROM px), n AS (SELECT g.r, g.c, h.r AS y, h.c AS x, h.a FROM g CROSS JOIN (SELECT i, j FROM range(-2, 3) a(i), range(-2, 3) b(j)) o JOIN g h ON h.r = g.r + o.i AND h.c = g.c + o.j),
s AS (SELECT *, CASE WHEN lag(x) OVER k = x - 1 AND lag(a) OVER k = a THEN 0 ELSE 1 END AS new_ FROM n WINDOW k AS (PARTITION BY r, c, y ORDER BY x)), q AS (SELECT *, sum(new_) OVER (PARTITION BY r, c, y ORDER BY x) AS run FROM s),
u AS (SELECT r, c, min(a) AS i, count(*) AS j FROM q GROUP BY r, c, y, run), l AS (SELECT r, c, sum(k * k) AS s FROM (SELECT r, c, i, count(*) AS k FROM u GROUP BY r, c, i) GROUP BY r, c), z AS (SELECT r, c, sum(k * k) AS s FROM (SELECT r, c, j, count(*) AS k FROM u GROUP BY r, c, j) GROUP BY r, c)
SELECT r, c, round(avg(1.0 / (j * j)), 6) AS short_runs, round(avg(j * j), 6) AS long_runs, round(min(l.s) / count(*), 6) AS level_nonuniformity, round(min(z.s) / count(*), 6) AS run_nonuniformity, round(count(*) / sum(j), 6) AS run_percentage, round(avg(1.0 / (i * i)), 6) AS low_levels, round(avg(i * i), 6) AS high_levels,
round(avg(1.0 / (i * i * j * j)), 6) AS short_low, round(avg(i * i / (j * j)::DOUBLE), 6) AS short_high, round(avg(j * j / (i * i)::DOUBLE), 6) AS long_low, round(avg(i * i * j * j), 6) AS long_high FROM u JOIN l USING (r, c) JOIN z USING (r, c) GROUP BY r, c""")
def _(t):
    return tx.run_lengths(t("px").select("r", "c", "red"), "red", 3, 0, 256, 2).select("r", "c", *r6(*tx.RUNS))


_HEIGHTS = "h AS (SELECT pid, r, c, hgt FROM px JOIN height_px USING (pid))"


def _heights(t):
    return t("px").select("pid", "r", "c").join(t("height_px").withColumn("hgt", F.col("hgt").cast("double")), "pid")


@query("foc_shadow_slanted", f"""WITH {_HEIGHTS}, e AS (SELECT greatest(1, least(ceil(sqrt((max(r) - min(r)) ** 2 + (max(c) - min(c)) ** 2)), ceil((max(hgt) - min(hgt)) / tan(radians(75))))) AS reach FROM h),
s AS (SELECT s, CAST(round(-cos(radians(130)) * s) AS BIGINT) AS dr, CAST(round(sin(radians(130)) * s) AS BIGINT) AS dc FROM e, range(1, 2000) k(s) WHERE s <= reach)
SELECT h.pid, coalesce(max((q.hgt - h.hgt > s.s * tan(radians(75)))::INT), 0) AS shadow FROM h CROSS JOIN s LEFT JOIN h q ON q.r = h.r + s.dr AND q.c = h.c + s.dc GROUP BY h.pid""")
def _(t):
    return fo.shadow_mask(_heights(t), "hgt", 130, 75).select("pid", "shadow")


def _terms(terms: tuple[float, ...]) -> str:
    return " + ".join([str(terms[0]), *[f"({terms[2 * k - 1]}) * cos({k} * g) + ({terms[2 * k]}) * sin({k} * g)" for k in (1, 2, 3)]])


def _sun(rows: str) -> str:
    """SQL of (keep, azimuth, elevation) for rows with day, hour, lat and lon in CTE t0."""
    return f"""t0 AS ({rows}), t1 AS (SELECT *, 2 * pi() / 365 * (dayofyear(day) - 1 + (hour - 12) / 24) AS g FROM t0), t2 AS (SELECT *, radians((hour * 60 + 229.18 * ({_terms(EQUATION_OF_TIME)}) + 4 * lon) / 4 - 180) AS turn, {_terms(DECLINATION)} AS tilt FROM t1),
sun AS (SELECT *, degrees(atan2(sin(turn), cos(turn) * sin(radians(lat)) - tan(tilt) * cos(radians(lat)))) + 180 AS azimuth, degrees(asin(sin(radians(lat)) * sin(tilt) + cos(radians(lat)) * cos(tilt) * cos(turn))) AS elevation FROM t2)"""


@query("foc_sun_position", f"WITH {_sun('SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, o_orderkey % 24 + 0.25::DOUBLE AS hour, CAST(o_custkey % 120 - 60 AS DOUBLE) AS lat, CAST(o_custkey % 30 - 15 AS DOUBLE) AS lon FROM orders')} SELECT id, round(azimuth, 5) AS azimuth, round(elevation, 5) AS elevation FROM sun")
def _(t):
    o = t("orders")
    az, el = sun_position(F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 24 + 0.25, (F.col("o_custkey") % 120 - 60).cast("double"), (F.col("o_custkey") % 30 - 15).cast("double"))
    return o.select(F.col("o_orderkey").alias("id"), F.round(az, 5).alias("azimuth"), F.round(el, 5).alias("elevation"))


@query("foc_sun_exposure", f"""WITH {_HEIGHTS}, {_sun("SELECT n_nationkey AS id, DATE '2023-06-21' AS day, n_nationkey + 0.0::DOUBLE AS hour, 43.6::DOUBLE AS lat, 1.4::DOUBLE AS lon FROM nation WHERE n_nationkey BETWEEN 8 AND 16")},
s AS (SELECT id, s, tan(radians(elevation)) * s AS rise, CAST(round(-cos(radians(azimuth)) * s) AS BIGINT) AS dr, CAST(round(sin(radians(azimuth)) * s) AS BIGINT) AS dc FROM sun, range(1, 13) k(s)),
k AS (SELECT h.pid, s.id, max((q.hgt - h.hgt > s.rise)::INT) AS hit FROM h CROSS JOIN s JOIN h q ON q.r = h.r + s.dr AND q.c = h.c + s.dc GROUP BY h.pid, s.id) SELECT h.pid, CAST(coalesce(sum(k.hit), 0) AS INTEGER) AS shadows FROM h LEFT JOIN k USING (pid) GROUP BY h.pid""")
def _(t):
    """Hours of shadow of each pixel on a day, at the hours of a small table."""
    hours = t("nation").where("n_nationkey BETWEEN 8 AND 16").select(F.lit("2023-06-21").cast("date").alias("day"), F.col("n_nationkey").cast("double").alias("hour"))
    az, el = sun_position(F.col("day"), F.col("hour"), F.lit(43.6), F.lit(1.4))
    suns = [(s["a"], s["e"]) for s in hours.select(az.alias("a"), el.alias("e")).collect()]  # a row an hour
    return fo.shadows(_heights(t), "hgt", suns, 12).select("pid", "shadows")
