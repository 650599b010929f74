"""Sampling and learning on pixel and feature tables."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.ml.classification import LinearSVC, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arpent.operators.lineage import settle


def spread(key: str, seed: int) -> Column:
    """A fixed order that looks random: the CRC of seed and key, then the key."""
    return F.struct(F.crc32(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))).alias("h"), F.col(key).alias("k"))


def first_by_hash(df: DataFrame, group: str, quotas: DataFrame, key: str, seed: int) -> DataFrame:
    """The rows of each group that come first in the order of spread, as many as quotas (group, _q) says; groups are few.

    Counts of slices of the hash give the slice in which a group's quota ends; only that slice's rows are ranked.
    """
    h = F.crc32(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    sliced = df.withColumn("_b", F.shiftright(h, 20).cast("int"))
    counts = sliced.groupBy(F.col(group), "_b").agg(F.count("*").alias("_n"))  # 4096 slices a group at most
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    upto = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(F.broadcast(quotas), group)
    upto = upto.where("_before < _q").select(group, "_b", (F.col("_q") - F.col("_before")).alias("_left"), (F.col("_n") <= F.col("_q") - F.col("_before")).alias("_whole"))
    held = sliced.join(F.broadcast(upto), [group, "_b"])
    rank = F.row_number().over(Window.partitionBy(group, "_b").orderBy(spread(key, seed)))
    last = held.where("NOT _whole").withColumn("_r", rank).where("_r <= _left").drop("_r")
    return held.where("_whole").unionByName(last).select(*df.columns)


def sample_per_class(px: DataFrame, cls: str, percent: float | None = None, floor: bool = False, key: str = "pid", seed: int = 1) -> DataFrame:
    """All rows, a fixed percentage per class, or with floor at least as many as the smallest class, which stays whole."""
    if percent is None:
        return px
    counts = px.groupBy(cls).agg(F.count("*").alias("_n"))
    least = counts.agg(F.min("_n").alias("_least"))
    quota = F.ceil(F.col("_n") * percent / 100)
    quotas = counts.join(F.broadcast(least)).select(cls, (F.greatest(quota, F.col("_least")) if floor else quota).alias("_q"))
    return first_by_hash(px, cls, quotas, key, seed)


def random_points(px: DataFrame, n: int, seed: int, only: tuple[str, int] | None = None, key: str = "pid") -> DataFrame:
    """n pixels without repeats, of one class only if asked."""
    held = px if only is None else px.where(F.col(only[0]) == only[1])
    return held.orderBy(spread(key, seed)).limit(n)


def sample_size(classes: int, share: float, alpha: float, error: float) -> int:
    """chi2(1 - alpha / k, 1) p (1 - p) / error^2; the quantile is the square of a normal one."""
    z = NormalDist().inv_cdf(1 - alpha / classes / 2)
    return math.ceil(z * z * share * (1 - share) / (error * error))


def sample_sizes(df: DataFrame, cls: str, alpha: float, error: float) -> DataFrame:
    """(class, share, n): for each class of df the size of a sample that tells its share within the error."""
    counts = settle(df.groupBy(cls).agg(F.count("*").alias("_n")))
    k = counts.count()  # classes
    z = NormalDist().inv_cdf(1 - alpha / max(1, k) / 2)
    share = F.col("_n") / F.sum("_n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share", share).select(cls, "share", F.ceil(z * z * F.col("share") * (1 - F.col("share")) / (error * error)).cast("long").alias("n"))


def classify_objects(vectors: DataFrame, features: list[str], label: str, training: Column, method: str = "rf", trees: int = 50, seed: int = 1) -> DataFrame:
    """Features of a layer classified by their attributes; those that the training filter takes, and that have a label, teach."""
    return train_and_classify(vectors.where(training & F.col(label).isNotNull()), vectors, features, label, method, trees, seed)


def assemble(df: DataFrame, bands: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=bands, outputCol=out, handleInvalid="skip").transform(df)


def kmeans_labels(px: DataFrame, bands: list[str], k: int, base: int, seed: int = 1, extra_background_cluster: bool = False) -> tuple[DataFrame, list]:
    """px with `micro` = base + cluster, and the centroids."""
    model = KMeans(k=k + extra_background_cluster, seed=seed).fit(assemble(px, bands))
    out = model.transform(assemble(px, bands)).withColumn("micro", F.col("prediction") + base).drop("features", "prediction")
    return out, [c.tolist() for c in model.clusterCenters()]


def split_class(px: DataFrame, cls: str, value: int, parts: int, bands: list[str], least: int, seed: int = 1) -> DataFrame:
    """Pixels of one class split by k-means into new labels after the highest used one, if there are over parts * least."""
    one = px.where(F.col(cls) == value)
    if one.limit(parts * least + 1).count() <= parts * least:
        return px
    top = px.agg(F.max(cls)).first()[0]
    new, _ = kmeans_labels(one, bands, parts, top + 1, seed)
    return px.where(F.col(cls) != value).unionByName(new.withColumn(cls, F.col("micro").cast(dict(px.dtypes)[cls])).drop("micro"))


def train_and_classify(train: DataFrame, image: DataFrame, bands: list[str], label: str, method: str = "rf", trees: int = 50, seed: int = 1) -> DataFrame:
    """image with `predicted` and, for forests, `confidence`; bands are standardised with the image's own statistics."""
    wide = assemble(image, bands, "_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True).fit(wide)
    points = scaler.transform(assemble(train, bands, "_raw")).withColumn("_y", F.col(label).cast("double"))
    if method == "rf":
        model = RandomForestClassifier(labelCol="_y", numTrees=trees, seed=seed).fit(points)
        out = model.transform(scaler.transform(wide)).withColumn("confidence", F.array_max(vector_to_array("probability")))
    else:
        model = OneVsRest(classifier=LinearSVC(maxIter=20), labelCol="_y").fit(points)
        out = model.transform(scaler.transform(wide)).withColumn("confidence", F.lit(None).cast("double"))
    return out.withColumn("predicted", F.col("prediction").cast("int")).select(*image.columns, "predicted", "confidence")


def reduce_dimensions(px: DataFrame, bands: list[str], k: int) -> DataFrame:
    """px with `components`: the first k principal components as an array."""
    wide = assemble(px, bands)
    return PCA(k=k, inputCol="features", outputCol="_pc").fit(wide).transform(wide).withColumn("components", vector_to_array("_pc")).drop("features", "_pc")


def fisher_jenks_each(values: list[float], weights: list[int], classes: list[int]) -> list[tuple[list[int], float]]:
    """First bin of each class, and goodness of variance fit, for sorted weighted bins and each number of classes: exact,
    quadratic in the bins. Fewer classes are met on the way to the most."""
    import numpy as np

    v, w = np.asarray(values, float), np.asarray(weights, float)
    sw, sv, sq = (np.concatenate([[0], np.cumsum(x)]) for x in (w, w * v, w * v * v))

    def cost(i, j):
        n = sw[j] - sw[i]
        return sq[j] - sq[i] - (sv[j] - sv[i]) ** 2 / np.where(n > 0, n, 1)

    m, most = len(v), max(classes)
    best, cut = cost(0, np.arange(m + 1)), np.zeros((most, m + 1), int)
    left = {1: best[m]}
    for k in range(1, most):
        new = best.copy()
        for j in range(k + 1, m + 1):
            i = np.arange(k, j)
            c = best[i] + cost(i, j)
            a = int(c.argmin())
            new[j], cut[k, j] = c[a], i[a]
        best = new
        left[k + 1] = best[m]
    total = cost(0, m)

    def one(n: int):
        starts, j = [], m
        for k in range(n - 1, -1, -1):
            j = int(cut[k, j])
            starts.append(j)
        return starts[::-1], float(1 - left[n] / total) if total > 0 else 1.0

    return [one(n) for n in classes]


def fisher_jenks(values: list[float], weights: list[int], classes: int) -> tuple[list[int], float]:
    """`fisher_jenks_each` for one number of classes."""
    return fisher_jenks_each(values, weights, [classes])[0]


def _natural_bins(df: DataFrame, scene: str, value: str, bins: int, loss: float) -> DataFrame:
    """(scene, _v, _w): mean and number of the values of each bin of each scene.

    Bins start at quantiles; those that hold more than their part of a loss (as a share of the scene's variance) are cut
    at their mean until none does, so outliers get bins of their own. Up to `bins` distinct values are bins of their own
    from the start. A row finds its bin by halving: `_p` holds the powers of 2 up to the number of edges, largest first.
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(scene, F.col(value).cast("double").alias("_x"))
    share = [i / bins for i in range(bins)]
    powers = F.transform(F.sequence(F.floor(F.log2(F.size("_e"))).cast("int"), F.lit(0)), lambda k: F.pow(F.lit(2.0), k).cast("int"))
    edges = settle(rows.groupBy(scene).agg(F.array_sort(F.array_distinct(F.percentile_approx("_x", F.lit(share), 100 * bins))).alias("_e"), F.var_pop("_x").alias("_var"), F.count("*").alias("_n")).withColumn("_p", powers))
    while True:
        at = F.aggregate("_p", F.lit(0), lambda k, p: F.when(F.try_element_at("_e", k + p) <= F.col("_x"), k + p).otherwise(k))
        hist = rows.join(edges, scene).groupBy(scene, at.alias("_b")).agg(F.avg("_x").alias("_v"), F.count("*").alias("_w"), F.var_pop("_x").alias("_s"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.first("_var").alias("_var"), F.first("_n").alias("_n"))
        hist = settle(hist)
        cut = hist.where((F.col("_lo") < F.col("_hi")) & (F.col("_s") * F.col("_w") * bins > loss * F.col("_var") * F.col("_n")) & (F.col("_v") > F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        more = settle(cut.groupBy(scene).agg(F.collect_list("_v").alias("_m")))
        if more.isEmpty():
            return hist.select(scene, "_v", "_w")
        edges = settle(edges.join(more, scene, "left").withColumn("_e", F.array_sort(F.array_distinct(F.concat("_e", F.coalesce("_m", F.array().cast("array<double>")))))).drop("_m").withColumn("_p", powers))


def _breaks_each(hist: DataFrame, scene: str, classes: list[int]) -> DataFrame:
    """(scene, classes, breaks, fit, counts) for each number of classes; the bins of a scene come together."""
    import pandas as pd

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_v")
        v, w = pdf["_v"].tolist(), pdf["_w"].tolist()
        found = fisher_jenks_each(v, w, [min(k, len(pdf)) for k in classes])
        sizes = [[int(sum(w[a:b])) for a, b in zip(starts, [*starts[1:], len(w)], strict=True)] for starts, _ in found]
        return pd.DataFrame({scene: [pdf[scene].iloc[0]] * len(classes), "classes": classes, "breaks": [[float(v[s]) for s in starts] for starts, _ in found], "fit": [fit for _, fit in found], "counts": sizes})

    return hist.groupBy(scene).applyInPandas(one, f"{scene} {hist.schema[scene].dataType.simpleString()}, classes long, breaks array<double>, fit double, counts array<long>")


def natural_breaks(df: DataFrame, scene: str, value: str, classes: int, bins: int = 1024, loss: float = 1e-4) -> DataFrame:
    """(scene, breaks, fit, counts): Fisher-Jenks on weighted bins of each scene (`_natural_bins`); scenes in parallel.

    The bins, not the rows, of a scene come together.
    """
    return _breaks_each(_natural_bins(df, scene, value, bins, loss), scene, [classes]).drop("classes")


def low_classes(counts: Column) -> Column:
    """Numbers (from 1) of the classes inside that hold fewer values than both their neighbours."""
    inside = F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(counts) - 1))
    return F.filter(inside, lambda i: (F.element_at(counts, i) < F.element_at(counts, i - 1)) & (F.element_at(counts, i) < F.try_element_at(counts, i + 1)))


def threshold_of_counts(counts: Column, breaks: Column) -> tuple[Column, Column]:
    """(centre, lower): the centre of the second class that holds fewer values than its neighbours, and the lower bound of the
    first one; both of the first where there is only one, null where there is none. breaks: lower bounds of the classes."""
    low = low_classes(counts)
    first, second = F.try_element_at(low, F.lit(1)), F.coalesce(F.try_element_at(low, F.lit(2)), F.try_element_at(low, F.lit(1)))
    return (F.try_element_at(breaks, second) + F.try_element_at(breaks, second + 1)) / 2, F.try_element_at(breaks, first)


def natural_breaks_threshold(df: DataFrame, scene: str, value: str, classes: range = range(20, 31), least_fit: float = 0.9) -> DataFrame:
    """(scene, centre, lower, rounds): where few values lie, by `threshold_of_counts` for each number of classes that fits
    well enough, averaged over those numbers. All numbers share their bins and one pass over them."""
    b = _breaks_each(_natural_bins(df, scene, value, 1024, 1e-4), scene, list(classes)).where(F.col("fit") >= least_fit)
    centre, lower = threshold_of_counts(F.col("counts"), F.col("breaks"))
    found = b.select(scene, lower.alias("lower"), centre.alias("centre")).where("lower IS NOT NULL")
    return found.groupBy(scene).agg(F.avg("centre").alias("centre"), F.avg("lower").alias("lower"), F.count("*").alias("rounds"))


def split_train_validation(df: DataFrame, key: str, empty: str, percent: float, most_empty: float, seed: int = 1) -> DataFrame:
    """df with `part`: empty samples capped to a percentage of the others, then a fixed random split."""
    full = df.where(~F.col(empty)).count()
    quota = df.sparkSession.createDataFrame([(True, int(full * most_empty // 100))], f"{empty} boolean, _q long")
    kept = df.where(~F.col(empty)).unionByName(first_by_hash(df.where(F.col(empty)), empty, quota, key, seed))
    return kept.withColumn("part", F.when(F.crc32(F.concat_ws(":", F.lit(seed + 1), F.col(key).cast("string"))) % 10000 < percent * 100, "train").otherwise("validation"))


def suspicious_classes(indicators: DataFrame, nearest: DataFrame, areas: DataFrame, least_performance: float, least_area: float) -> DataFrame:
    """(cls, action, target): missing or small classes are deleted, weak ones take their nearest class of another group."""
    t = areas.join(indicators.select("cls", "performance"), "cls", "left").join(nearest.select(F.col("a").alias("cls"), F.col("b").alias("target"), "distance"), "cls", "left")
    action = F.when(F.col("performance").isNull() | (F.col("area") < least_area), "delete").when(F.col("performance") < least_performance, "relabel").otherwise("keep")
    return t.select("cls", action.alias("action"), F.when(action == "relabel", F.col("target")).alias("target"))


def tile_inference(tiles: DataFrame, predict, schema: str) -> DataFrame:
    """A user's function from an iterator of pandas frames of tiles to frames of the schema."""
    return tiles.mapInPandas(predict, schema)
