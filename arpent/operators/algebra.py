"""Map algebra on pixel tables: aligned rasters are joined by pixel and combined by Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align(rasters: dict[str, tuple[DataFrame, str]], key: str | list[str] = "pid") -> DataFrame:
    """One column per raster of the pixels that all of them have."""
    keys = [key] if isinstance(key, str) else key
    return reduce(lambda a, b: a.join(b, keys), [df.select(*keys, F.col(c).alias(n)) for n, (df, c) in rasters.items()])


def raster_calculator(rasters: dict[str, tuple[DataFrame, str]], expression: str, out: str = "value", key: str | list[str] = "pid") -> DataFrame:
    """A formula over aligned rasters."""
    keys = [key] if isinstance(key, str) else key
    return align(rasters, key).select(*keys, F.expr(expression).alias(out))


def surface_height(terrain: Column, elevation: Column) -> Column:
    return terrain + elevation


def binary_mask(v: Column, threshold: float, positive: bool = True) -> Column:
    return (v > threshold if positive else ~(v > threshold)).cast("int")


def range_mask(v: Column, low: float, high: float) -> Column:
    return v.between(low, high).cast("int")


def valid_mask(bands: list[Column], nodata: float) -> Column:
    return reduce(lambda a, b: a & b, [b != nodata for b in bands]).cast("int")


def mask_and(v: Column, mask: Column) -> Column:
    return F.when(mask == 1, v).otherwise(F.lit(0))


def mask_or(a: Column, b: Column) -> Column:
    return ((a != 0) | (b != 0)).cast("int")


def masked_difference(a: Column, b: Column, mask: Column) -> Column:
    return F.when(mask == 1, F.abs(a - b)).otherwise(F.lit(0.0))


def first_valid(layers: list[Column], nodata: float = 0) -> Column:
    """The first layer's value that isn't nodata, in list order, else nodata."""
    return F.coalesce(*[F.when(x != nodata, x) for x in layers], F.lit(nodata))


def drop_overlaps(masks: list[Column]) -> list[Column]:
    """Masks with pixels that several have set to 0 in all."""
    total = reduce(lambda a, b: a + b, masks)
    return [F.when(total > 1, 0).otherwise(m) for m in masks]


def reclass(v: Column, mapping: dict[int, int]) -> Column:
    """The first matching class mapping, else unchanged."""
    out = F
    for a, b in mapping.items():
        out = out.when(v == a, F.lit(b))
    return out.otherwise(v) if mapping else v


def fuse_to_macro(v: Column, step: int = 100) -> Column:
    return (F.rint(v / step) * step).cast("int")


def minmax_normalise(px: DataFrame, bands: list[str]) -> DataFrame:
    """(v - min) / (max - min) of each band; null where a band is constant. One row of extremes is broadcast."""
    ends = px.agg(*[f(b).alias(f"_{n}_{b}") for b in bands for n, f in (("lo", F.min), ("hi", F.max))])
    out = px.crossJoin(F.broadcast(ends))
    scaled = {b: F.try_divide(F.col(b) - F.col(f"_lo_{b}"), F.col(f"_hi_{b}") - F.col(f"_lo_{b}")) for b in bands}
    return out.withColumns(scaled).select(*px.columns)


def height_model(surface: Column, terrain: Column) -> Column:
    """-1 for inputs outside (-9999, 9999), 0 for negative heights."""
    bad = (surface <= -9999) | (surface >= 9999) | (terrain <= -9999) | (terrain >= 9999)
    return F.when(bad, -1.0).when(surface < terrain, 0.0).otherwise(surface - terrain)


def height_classes(v: Column, thresholds: list[float]) -> Column:
    """i + 1 within [t_i, t_i+1), the last open, 0 below the first."""
    out = F.when(v.isNull(), F.lit(None).cast("int"))
    for i, t in reversed(list(enumerate(sorted(thresholds)))):
        out = out.when(v >= t, i + 1)
    return out.otherwise(0)


def replace_under_mask(v: Column, mask: Column, new: int, only: int | None = None) -> Column:
    hit = mask == 1 if only is None else (mask == 1) & (v == only)
    return F.when(hit, F.lit(new)).otherwise(v)


def layer_threshold(sample: Column, layer: Column, low: float, high: float, mode: str = "and") -> Column:
    held = layer.between(low, high)
    return ((sample == 1) & held if mode == "and" else (sample == 1) | held).cast("int")


def argmax_class(scores: Column, skip_background: bool = False) -> tuple[Column, Column]:
    """(class, confidence): position of the largest score from 0, the first of ties; class 0 can be left out."""
    held = F.slice(scores, 2, F.size(scores) - 1) if skip_background else scores
    best = F.array_max(held)
    return (F.array_position(held, best) - (0 if skip_background else 1)).cast("int"), best


def pixel_centres(r: Column, c: Column, x0: float, y0: float, size: float = 1.0) -> tuple[Column, Column]:
    return F.lit(x0) + (c + 0.5) * size, F.lit(y0) - (r + 0.5) * size


def snap_extent(xmin: Column, ymin: Column, xmax: Column, ymax: Column, size: float) -> list[Column]:
    return [(f(v / size) * size).cast("double") for f, v in ((F.floor, xmin), (F.floor, ymin), (F.ceil, xmax), (F.ceil, ymax))]


def apply_palette(px: DataFrame, lut: DataFrame, cls: str) -> DataFrame:
    """Three colour bands from a table (class, red, green, blue); unknown classes stay black. The table is one row a class."""
    table = lut.select(F.col(lut.columns[0]).alias(cls), *[F.col(c).alias(f"out_{i}") for i, c in enumerate(lut.columns[1:4], 1)])
    return px.join(F.broadcast(table), cls, "left").withColumns({f"out_{i}": F.coalesce(f"out_{i}", F.lit(0)) for i in (1, 2, 3)})


def footprint(bands: list[Column], nodata: float) -> Column:
    """0 where the only band, or the sum of the first three, is nodata."""
    v = bands[0] if len(bands) == 1 else reduce(lambda a, b: a + b, bands[:3])
    return (v != nodata).cast("int")
