"""Pixel and tile tables, vector layers, scene catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = "features array<struct<type string, id string, properties map<string,string>, geometry struct<type string, coordinates string>>>"


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def tiles_to_pixels(tiles: DataFrame, width: int, absent: bool = True) -> DataFrame:
    """(scene, tx, ty, band, r, c, value) from tiles whose data are rows of `width` values; without absent, nulls are left out."""
    long = tiles.select("scene", "tx", "ty", "band", F.posexplode("data").alias("_i", "value"))
    out = long.select("scene", "tx", "ty", "band", (F.col("ty") * width + F.floor(F.col("_i") / width)).alias("r"), (F.col("tx") * width + F.col("_i") % width).alias("c"), "value")
    return out if absent else out.where("value IS NOT NULL")


def pixels_to_tiles(px: DataFrame, band: str, width: int) -> DataFrame:
    """(tx, ty, band, data): width * width values of each tile in row order, null where there is no pixel or no value; a pixel given twice is an error."""
    place = (F.pmod("r", F.lit(width)) * width + F.pmod("c", F.lit(width))).cast("int")
    k = F.struct(place.alias("i"), F.col(band).cast("float").alias("v"))
    t = px.groupBy(F.floor(F.col("c") / width).alias("tx"), F.floor(F.col("r") / width).alias("ty")).agg(F.map_from_entries(F.collect_list(k)).alias("_p"))
    return t.select("tx", "ty", F.lit(band).alias("band"), F.transform(F.sequence(F.lit(0), F.lit(width * width - 1)), lambda i: F.col("_p")[i]).alias("data"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(fid, properties, geometry_type, coordinates) of a GeoJSON collection; fid is the id, or the ordinal."""
    rows = spark.read.schema(FEATURES).json(path, multiLine=True).select(F.posexplode("features").alias("_i", "f"))
    return rows.select(F.coalesce(F.col("f.id").try_cast("long"), F.col("_i").cast("long")).alias("fid"), F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def raster_metadata(px: DataFrame, bands: list[str], size: float | None = None, nodata: float | None = None) -> DataFrame:
    """One row: rows, columns, pixel size, extent (outer edges), bands, their type and nodata. Without a size it is the step
    between neighbouring pixel centres, and 1 for a single row and column."""
    step = lambda x, i: F.try_divide((F.max(x) - F.min(x)).cast("double"), F.max(i) - F.min(i))
    unit = F.lit(float(size)) if size else F.coalesce(step("x", "c"), step("y", "r"), F.lit(1.0))
    kinds = ",".join(sorted({dict(px.dtypes)[b] for b in bands}))
    return px.agg(
        (F.max("r") - F.min("r") + 1).alias("rows"), (F.max("c") - F.min("c") + 1).alias("columns"), unit.alias("pixel_size"), (F.min("x") - unit / 2).alias("xmin"), (F.max("x") + unit / 2).alias("xmax"),
        (F.min("y") - unit / 2).alias("ymin"), (F.max("y") + unit / 2).alias("ymax"), F.lit(len(bands)).alias("bands"), F.lit(kinds).alias("dtype"), F.lit(nodata).cast("double").alias("nodata"),
    )


def vector_metadata(df: DataFrame, geometry: str = "Polygon", special: tuple[str, ...] = ("xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """One row: feature count, extent, geometry type and the other fields with their types."""
    fields = ",".join(f"{c}:{t}" for c, t in df.dtypes if c not in special)
    return df.agg(F.count("*").alias("features"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"), F.lit(geometry).alias("geometry"), F.lit(fields).alias("fields"))


def features_from_rows(df: DataFrame, points: str, fields: dict[str, str]) -> DataFrame:
    """Polygon features (rings and renamed fields) from rows with an array of corners (x, y), closed where they are open."""
    ring = F.col(points)
    closed = F.when(F.element_at(ring, 1) == F.element_at(ring, -1), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))
    return df.select(*[F.col(a).alias(b) for a, b in fields.items()], F.array(closed).alias("rings"))


def points_from_layer(df: DataFrame, columns: list[str], rings: str = "rings") -> DataFrame:
    """(columns, part, k, x, y): the points of each feature's rings, without the closing one."""
    parts = df.select(*columns, F.posexplode(rings).alias("part", "_r"))
    inner = parts.select(*columns, "part", F.posexplode(F.slice("_r", F.lit(1), F.size("_r") - 1)).alias("k", "_p"))
    return inner.select(*columns, "part", "k", "_p.x", "_p.y")


def filter_geometry_type(df: DataFrame, kind: str, column: str = "geometry_type", rings: str | None = "rings") -> DataFrame:
    """Features of one geometry type, without null or empty geometry."""
    held = df.where(F.col(column) == kind)
    return held.where(F.col(rings).isNotNull() & (F.size(rings) > 0) & (F.size(F.element_at(rings, 1)) > 0)) if rings else held


def write_features(df: DataFrame, path: str, geometry_type: str, coordinates: Column, fields: list[str], key: str = "fid") -> None:
    """A GeoJSON feature a line, so that files can be written and read in parts."""
    shape = F.struct(F.lit(geometry_type).alias("type"), coordinates.alias("coordinates"))
    df.select(F.lit("Feature").alias("type"), F.col(key).alias("id"), F.struct(*fields).alias("properties"), shape.alias("geometry")).write.json(path)


def read_feature_lines(spark: SparkSession, path: str, fields: str, coordinates: str) -> DataFrame:
    """(fid, fields, geometry_type, coordinates) of features that stand a line each; fields and coordinates are types in DDL."""
    schema = f"type string, id long, properties struct<{fields}>, geometry struct<type: string, coordinates: {coordinates}>"
    rows = spark.read.schema(schema).json(path)
    return rows.select(F.col("id").alias("fid"), "properties.*", F.col("geometry.type").alias("geometry_type"), F.col("geometry.coordinates").alias("coordinates"))


def scene_dates(name: Column, separator: str = "_", position: int = 2) -> tuple[Column, Column, Column]:
    """(date, time, folder id) from a scene name: eight digits of the part are the date, trailing digits are milliseconds of
    the day; what can't be read gives 1900-01-01 and midnight."""
    part = F.try_element_at(F.split(name, separator), F.lit(position))
    digits = F.regexp_extract(part, r"^(\d{8})", 1)
    date = F.coalesce(F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMdd")).cast("date"), F.lit("1900-01-01").cast("date"))
    ms = F.coalesce(F.regexp_extract(part, r"^\d{8}\D+(\d+)$", 1).try_cast("bigint"), F.lit(0))
    time = F.date_format(F.timestamp_millis(ms), "HH:mm:ss")
    return date, time, F.element_at(F.split(name, separator), -1)


def select_scenes(scenes: DataFrame, bbox: tuple[float, float, float, float]) -> DataFrame:
    """(date, n, box) of the scenes that meet the study box, grouped by day."""
    x0, y0, x1, y1 = bbox
    hit = (F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0)
    return scenes.where(hit).groupBy("date").agg(F.count("*").alias("n"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def select_tiles(rois: DataFrame, size: float, unit: float = 1000.0) -> DataFrame:
    """Aligned square tiles that meet each region's box, named by x_y in the unit, padded to four digits; longer ones stay whole."""
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.ceil(F.col(b) / size) - 1))
    t = rois.where("xmax > xmin AND ymax > ymin").withColumn("tx", span("xmin", "xmax")).withColumn("ty", span("ymin", "ymax"))
    name = lambda c: (F.col(c) * size / unit).cast("long").cast("string")
    pad = lambda c: F.lpad(name(c), F.greatest(F.lit(4), F.length(name(c))), F.lit("0"))
    return t.withColumn("tile", F.concat_ws("_", pad("tx"), pad("ty")))


def detection_boxes(tiles: DataFrame, boxes: DataFrame, size: float, pixels: int) -> DataFrame:
    """Pixel boxes of features in each tile: offset by its corner, y turned down, rounded, clamped to [0, pixels]."""
    from arpent.operators.joins import box_join

    pairs = box_join(tiles, boxes, size)
    k = pixels / size
    at = lambda v: F.least(F.lit(pixels), F.greatest(F.lit(0), F.round(v * k).cast("int")))
    out = pairs.select(
        F.col("a_tile").alias("tile"), F.col("b_fid").alias("fid"), at(F.col("b_xmin") - F.col("a_xmin")).alias("x0"), at(F.col("b_xmax") - F.col("a_xmin")).alias("x1"),
        at(F.col("a_ymax") - F.col("b_ymax")).alias("y0"), at(F.col("a_ymax") - F.col("b_ymin")).alias("y1"),
    )
    return out.withColumn("area", (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
