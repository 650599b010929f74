"""Population, change and plot indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arpent.operators.joins import intersection_overlay
from arpent.operators.tables import minmax_scale


def habitable_surface(area: Column, height: Column) -> Column:
    """Floor area at three metres a storey, at least 1e-6."""
    return F.greatest(area * height / 3, F.lit(1e-6))


def population_by_building(squares: DataFrame, buildings: DataFrame, count: str, size: float) -> DataFrame:
    """(fid, population): each square's count shared over the building pieces in it by habitable surface."""
    pieces = intersection_overlay(squares, buildings, size).withColumn("_s", F.col("area") * F.col("b_hauteur") / 3)
    whole = pieces.groupBy("a_fid").agg(F.greatest(F.sum("_s"), F.lit(1e-6)).alias("_w"))
    part = pieces.join(whole, "a_fid").withColumn("_p", F.col(f"a_{count}") * F.col("_s") / F.col("_w"))
    return part.groupBy(F.col("b_fid").alias("fid")).agg(F.sum("_p").alias("population"))


def population_by_zone(zones: DataFrame, buildings: DataFrame, count: str, size: float) -> DataFrame:
    """(fid, population): each building's count shared over the zones that it meets by area of the pieces."""
    pieces = intersection_overlay(buildings, zones, size)
    whole = (F.col("a_xmax") - F.col("a_xmin")) * (F.col("a_ymax") - F.col("a_ymin"))
    return pieces.groupBy(F.col("b_fid").alias("fid")).agg(F.sum(F.col(f"a_{count}") * F.col("area") / whole).alias("population"))


def vulnerability(df: DataFrame, stakes: list[str], health: list[str], social: list[str]) -> DataFrame:
    """Scaled fields n_*, then stakes, health and social indices, each from 0 to 1; the overall one scales health and social."""
    out = minmax_scale(df, list(dict.fromkeys(stakes + health + social)))
    kinds = {"stakes": stakes, "health": health, "social": social}
    out = out.withColumns({k: sum((F.col(f"n_{c}") for c in fields), F.lit(0.0)) for k, fields in kinds.items()})
    out = minmax_scale(out, list(kinds), "i_")
    out = out.withColumn("overall", F.col("i_health") + F.col("i_social"))
    return minmax_scale(out, ["overall"], "i_")


def change_flags(before: Column, after: Column, surface_before: Column, surface_after: Column, rate: float, surface: float, both: bool = True) -> Column:
    """'positive', 'negative' or 'none' by change of rate and of surface; negative wins where both hold."""
    d, s = after - before, surface_after - surface_before
    def test(sign: int) -> Column:
        tests = ([sign * d >= rate] if rate else []) + ([sign * s >= surface] if surface else [])
        if not tests:
            return F.lit(False)
        return tests[0] if len(tests) == 1 else (tests[0] & tests[1] if both else tests[0] | tests[1])
    return F.when(test(-1), "negative").when(test(1), "positive").otherwise("none")
