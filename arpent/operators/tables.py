"""Attribute edits, filters, ordered rules, windows and set operations on any table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def filter_select(df: DataFrame, columns: list[str], condition: str) -> DataFrame:
    return df.where(condition).select(*columns)


def filter_min_area(df: DataFrame, area: Column, least: float, by: str) -> tuple[DataFrame, DataFrame]:
    """Rows of at least this area, and their total area by class."""
    kept = df.where(area >= least)
    return kept, kept.groupBy(by).agg(F.sum(area).alias("area"))


def delete_classes(df: DataFrame, cls: str, gone: list) -> DataFrame:
    return df.where(~F.col(cls).isin(gone) | F.col(cls).isNull())


def reallocate_classes(df: DataFrame, table: DataFrame, cls: str) -> DataFrame:
    """Relabel by a table (class, action, target): 'relabel' gives the target, 'delete' drops the row. One row a class."""
    t = table.select(F.col("class").alias(cls), "action", "target")
    out = df.join(F.broadcast(t), cls, "left").where("action IS NULL OR action <> 'delete'")
    return out.withColumn(cls, F.when(F.col("action") == "relabel", F.col("target")).otherwise(F.col(cls))).drop("action", "target")


def update_by_key(df: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Values replaced where the key has an update that is not null."""
    columns = [c for c in updates.columns if c != key]
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = df.join(new, key, "left").withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns})
    return out.drop(*[f"_new_{c}" for c in columns]).select(*df.columns)


def cast_columns(df: DataFrame, types: dict[str, str], rounded: tuple[str, ...] = ()) -> DataFrame:
    return df.withColumns({c: (F.round(c) if c in rounded else F.col(c)).cast(t) for c, t in types.items()})


def edit_fields(df: DataFrame, add: dict[str, object] | None = None, rename: dict[str, str] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    out = df.withColumns({c: F.lit(v) for c, v in (add or {}).items()})
    return out.withColumnsRenamed(rename or {}).drop(*drop)


def short_names(schema: StructType, length: int = 10) -> dict[str, str]:
    """Column names cut to a length; raises where two become one."""
    short = {n: n[:length] for n in schema.names}
    if len(set(short.values())) < len(short):
        raise ValueError("shortened names are not distinct")
    return short


def row_index(df: DataFrame, order: list[str], by: list[str], name: str = "idx") -> DataFrame:
    """Numbers from 1 within each group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def distinct_on(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row per key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def largest(df: DataFrame, key: str, size: str, n: int, tie: str) -> DataFrame:
    """The n largest rows per key, with their rank."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(size), tie))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def apply_rules(state: Column, rules: list[tuple[Column, object]]) -> Column:
    """First match among conditions, else the state."""
    out = F
    for cond, v in rules:
        out = out.when(cond, v if isinstance(v, Column) else F.lit(v))
    return out.otherwise(state)


def ordered_updates(df: DataFrame, column: str, rules: list[tuple[str, object]]) -> DataFrame:
    """Updates one after another: each condition is SQL and reads the state that the ones before left."""
    return reduce(lambda d, r: d.withColumn(column, F.when(F.expr(r[0]), F.lit(r[1])).otherwise(F.col(column))), rules, df)


def correct_percent_rounding(df: DataFrame, columns: list[str], rest: str) -> DataFrame:
    """rest = 100 - sum; where it is -1, one comes off the largest column (the first of ties) and rest is 0."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    out = df.withColumn(rest, 100 - total)
    top, taken = F.greatest(*columns), F.lit(False)
    fixed = {}
    for c in columns:
        here = (F.col(rest) == -1) & (F.col(c) == top) & ~taken
        fixed[c] = F.when(here, F.col(c) - 1).otherwise(F.col(c))
        taken = taken | (F.col(c) == top)
    return out.withColumns(fixed | {rest: F.when(F.col(rest) == -1, 0).otherwise(F.col(rest))})


def minmax_scale(df: DataFrame, columns: list[str], prefix: str = "n_") -> DataFrame:
    """(v - min) / (max - min) over the table: 0 where max is 0, null where max = min. One row of extremes is broadcast."""
    ends = df.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
    lo, hi = (lambda c: F.col(f"_lo_{c}")), (lambda c: F.col(f"_hi_{c}"))
    out = df.join(F.broadcast(ends))
    return out.withColumns({f"{prefix}{c}": F.when(hi(c) == 0, 0.0).otherwise(F.try_divide(F.col(c) - lo(c), hi(c) - lo(c))) for c in columns}).drop(*ends.columns)


def merge_layers(layers: dict[str, DataFrame], label: str | None = None) -> DataFrame:
    """Union by name; with a label column, each row tells its layer."""
    parts = [df.withColumn(label, F.lit(n)) if label else df for n, df in layers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def delete_rows(df: DataFrame, condition: str) -> DataFrame:
    """Rows whose condition isn't true; unknown counts as not true."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(False)))


def ring_index(distance: Column, size: float, n: int) -> Column:
    """Which of n rings of a width holds a distance, from 1; null beyond the last."""
    k = F.greatest(F.lit(1), F.ceil(distance / size)).cast("int")
    return F.when(k <= n, k)
