"""Text and vector helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_label(text: Column, allowed: str = "A-Za-z0-9_", replacement: str = "_") -> Column:
    return F.regexp_replace(text, f"[^{allowed}]", replacement)


def truncate_name(text: Column, length: int = 10) -> Column:
    return F.substring(text, 1, length)


def clean_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, " +", " "))


def replace_suffix(text: Column, suffix: str) -> Column:
    return F.regexp_replace(text, r"\.[^.]*$", suffix)


def label_from_history(history: Column) -> Column:
    """'LCZ E_0161' gives 'E'; any other text '0'."""
    found = F.regexp_extract(history, r"^LCZ ([^_]+)_", 1)
    return F.when(history.isNull(), F.lit(None).cast("string")).when(found != "", found).otherwise("0")


def euclidean_distance(a: Column, b: Column) -> Column:
    """-1 where lengths differ."""
    d = F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    return F.when(F.size(a) != F.size(b), -1.0).otherwise(d)


def arg_min_except(values: Column, skipped: list[float]) -> Column:
    """Position from 0 of the least value that isn't skipped; -1 where none is left."""
    held = F.filter(values, lambda v: ~v.isin(skipped))
    return (F.array_position(values, F.array_min(held)) - 1).cast("int")


def arg_max(values: Column) -> Column:
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
