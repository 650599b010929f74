"""Registered queries of bands together: other lattices, pansharpening, components, clusters of all classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from arpent.catalogue import query, r6
from arpent.operators import bands as bd
from arpent.operators import learning as le


def _superimposed(ratio: float) -> str:
    return f"""WITH l AS (SELECT i, j, (j + 0.5) / {ratio} AS lx, (i + 0.5) / {ratio} AS ly FROM (SELECT unnest(range(0, CAST(ceil(h * {ratio}) AS BIGINT))) AS i FROM grid_meta) CROSS JOIN (SELECT unnest(range(0, CAST(ceil(w * {ratio}) AS BIGINT))) AS j FROM grid_meta)),
s AS (SELECT i, j, count(*) AS k, sum((1 - abs(lx - 0.5 - c)) * (1 - abs(ly - 0.5 - r)) * red) AS b FROM l JOIN px ON c IN (floor(lx - 0.5), floor(lx - 0.5) + 1) AND r IN (floor(ly - 0.5), floor(ly - 0.5) + 1) GROUP BY i, j)
SELECT l.i, l.j, round(coalesce(CASE WHEN k = 4 THEN b END, red), 6) AS value FROM l JOIN px ON c = floor(lx) AND r = floor(ly) LEFT JOIN s USING (i, j)"""


@query("jn_superimpose_finer", _superimposed(1.6))
def _(t):
    return bd.superimpose_bilinear(t("px").select("r", "c", "red"), "red", 1.6).select("i", "j", *r6("value"))


@query("jn_superimpose_coarser", _superimposed(0.3))
def _(t):
    return bd.superimpose_bilinear(t("px").select("r", "c", "red"), "red", 0.3).select("i", "j", *r6("value"))


@query("foc_pansharpen_lmvm", """WITH m AS (SELECT p.pid, avg(n.nir) AS pm, var_pop(n.nir) AS pv, avg(n.red) AS rm, var_pop(n.red) AS rv, avg(n.green) AS gm, var_pop(n.green) AS gv FROM px p JOIN px n ON n.r BETWEEN p.r - 2 AND p.r + 2 AND n.c BETWEEN p.c - 2 AND p.c + 2 GROUP BY p.pid)
SELECT pid, round(CASE WHEN pv > 1e-9 THEN (nir - pm) * sqrt(rv / pv) + rm ELSE rm END, 5) AS sharp_red, round(CASE WHEN pv > 1e-9 THEN (nir - pm) * sqrt(gv / pv) + gm ELSE gm END, 5) AS sharp_green FROM px JOIN m USING (pid)""")
def _(t):
    out = bd.local_moment_sharpen(t("px").select("pid", "r", "c", "nir", "red", "green"), "nir", ["red", "green"], 2)
    return out.select("pid", *[F.round(c, 5).alias(c) for c in ("sharp_red", "sharp_green")])


@query("foc_pansharpen_bayes", """WITH m AS (SELECT avg(nir) AS p, avg(red) AS m1, covar_pop(nir, red) / var_pop(red) AS a, var_pop(red) AS cv, var_pop(nir) - covar_pop(nir, red) ** 2 / var_pop(red) AS v FROM px)
SELECT pid, round(red + cv * a * (0.5 / v) / (0.5 + 0.5 / v * a * a * cv) * (nir - (p - a * m1) - a * red), 5) AS sharp_red FROM px CROSS JOIN m""")
def _(t):
    return bd.bayes_sharpen(t("px").select("pid", "nir", "red"), "nir", ["red"], 0.5).select("pid", F.round("sharp_red", 5).alias("sharp_red"))


_ROOTS = "SELECT CAST(k AS INTEGER) AS component, round((q + (2 * k - 1) * sqrt(greatest(0, q * q - 4 * (a * c - b * b) * (d * f - e * e)))) / (2 * (a * c - b * b)), 5) AS ratio FROM (SELECT *, a * f + c * d - 2 * b * e AS q FROM o CROSS JOIN n) CROSS JOIN range(0, 2) r(k)"


@query("ml_autocorrelation_factors", f"""WITH o AS (SELECT var_pop(red) AS a, covar_pop(red, nir) AS b, var_pop(nir) AS c FROM px), g AS (SELECT p.red - q.red AS x, p.nir - q.nir AS y FROM px p JOIN px q ON (q.r = p.r AND q.c = p.c + 1) OR (q.c = p.c AND q.r = p.r + 1)),
n AS (SELECT var_pop(x) AS d, covar_pop(x, y) AS e, var_pop(y) AS f FROM g) {_ROOTS}""")
def _(t):
    """Variance between neighbours over variance of each component, measured on the components."""
    out, _ = bd.autocorrelation_factors(t("px").select("pid", "r", "c", "red", "nir"), ["red", "nir"])
    two = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, 0))]))
    names = [f"component_{k}" for k in (0, 1)]
    near = out.select(*[F.col(n).alias(f"_{n}") for n in names], "r", "c", two).select((F.col("r") - F.col("i")).alias("r"), (F.col("c") - F.col("j")).alias("c"), *[f"_{n}" for n in names]).join(out.select("r", "c", *names), ["r", "c"])
    own, apart = out.agg(*[F.var_pop(n).alias(n) for n in names]), near.agg(*[F.var_pop(F.col(n) - F.col(f"_{n}")).alias(f"d_{n}") for n in names])
    return own.crossJoin(apart).select(F.inline(F.array(*[F.struct(F.lit(k).alias("component"), F.round(F.col(f"d_{n}") / F.col(n), 5).alias("ratio")) for k, n in enumerate(names)])))  # one row each


@query("ml_noise_adjusted_components", f"""WITH o AS (SELECT var_pop(red) AS a, covar_pop(red, nir) AS b, var_pop(nir) AS c FROM px), g AS (SELECT min(p.red) - avg(q.red) AS x, min(p.nir) - avg(q.nir) AS y FROM px p JOIN px q ON q.r BETWEEN p.r - 1 AND p.r + 1 AND q.c BETWEEN p.c - 1 AND p.c + 1 GROUP BY p.pid),
n AS (SELECT var_pop(x) AS d, covar_pop(x, y) AS e, var_pop(y) AS f FROM g) {_ROOTS}""")
def _(t):
    """Shares of noise of the components; the components' own variance is 1."""
    out, ratios = bd.noise_adjusted_components(t("px").select("pid", "r", "c", "red", "nir"), ["red", "nir"], 1)
    names = [f"component_{k}" for k in (0, 1)]
    unit = out.agg(*[F.var_pop(n).alias(n) for n in names])
    return unit.select(F.inline(F.array(*[F.struct(F.lit(k).alias("component"), F.round(F.lit(r) / F.col(n), 5).alias("ratio")) for k, (n, r) in enumerate(zip(names, ratios, strict=True))])))


def _nearest(centres: str) -> str:
    return f"SELECT pid, cls, red, nir, cluster FROM (SELECT px.*, k.cluster, row_number() OVER (PARTITION BY pid ORDER BY (px.red - k.x) ** 2 + (px.nir - k.y) ** 2, k.cluster) AS i FROM px JOIN {centres} k USING (cls)) WHERE i = 1"


_MEANS = "SELECT cls, cluster, avg(red) AS x, avg(nir) AS y FROM {} GROUP BY cls, cluster"


@query("ml_kmeans_by_class", f"""WITH c0 AS (SELECT cls, row_number() OVER (PARTITION BY cls ORDER BY pid) - 1 AS cluster, red AS x, nir AS y FROM px QUALIFY cluster < 3), a0 AS ({_nearest('c0')}), c1 AS ({_MEANS.format('a0')}), a1 AS ({_nearest('c1')}), c2 AS ({_MEANS.format('a1')}), a2 AS ({_nearest('c2')})
SELECT pid, CAST(cluster AS INTEGER) AS cluster FROM a2""")
def _(t):
    """Two rounds for all classes at once."""
    return bd.kmeans_by_class(t("px").select("pid", "cls", "red", "nir"), "cls", ["red", "nir"], 3, 2).select("pid", "cluster")


@query("ml_independent_components", None)
def _(t):
    out = bd.independent_components(t("px").select("pid", "red", "nir", "swir1"), ["red", "nir", "swir1"], 2, 10)
    return out.select("pid", "component_0", "component_1")


@query("ml_principal_variances", "SELECT CAST(k AS INTEGER) AS component, round((a + c + (1 - 2 * k) * sqrt((a - c) ** 2 + 4 * b * b)) / 2, 4) AS variance FROM (SELECT var_pop(red) AS a, covar_pop(red, nir) AS b, var_pop(nir) AS c FROM px) CROSS JOIN range(0, 2) r(k)")
def _(t):
    """Variances of the principal components of two bands, measured on the components."""
    out = le.reduce_dimensions(t("px").select("pid", "red", "nir"), ["red", "nir"], 2)
    own = out.agg(*[F.round(F.var_pop(F.element_at("components", k + 1)), 4).alias(f"v{k}") for k in (0, 1)])
    return own.select(F.inline(F.array(*[F.struct(F.lit(k).alias("component"), F.col(f"v{k}").alias("variance")) for k in (0, 1)])))
