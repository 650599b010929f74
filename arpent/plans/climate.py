"""Climate zones and urban indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arpent.operators.joins import BOX, intersection_overlay
from arpent.operators.tables import apply_rules, ordered_updates
from arpent.operators.zonal import volume_weighted_height
from arpent.plans.landcover import frontal_area

#: Interval tree: a list of {indicator: [low, high, leaf or list]}.
Tree = list[dict[str, list]]


def operational_zones(df: DataFrame, built_limit: float = 10, low_cover_limit: float = 50) -> DataFrame:
    """lcz and lcz_int from hre, are, bur, ror, bsr, war, ver, vhr by ordered rules.

    A zone is urban over the built limit, else natural, or low_ocs under the cover limit. Each rule reads what the ones
    before left, so compact classes come out of the open ones; rows that no rule takes keep their text and a null code.
    """
    cover = "(bur + ror + bsr + war + ver)"
    start = F.when(F.col("bur") > built_limit, "urban").when(F.col("bur") <= built_limit, "natural")
    compact = "bur > 40 AND (bur + ror) > 70"
    most = lambda a: " AND ".join(f"{a} >= {b}" for b in ("ror", "bsr", "war", "ver") if b != a)
    rules = [
        (f"lcz = 'natural' AND {cover} <= {low_cover_limit}", "low_ocs"),
        ("lcz = 'urban' AND bur > 60 AND bsr > (ror + war + ver)", "7"),
        ("lcz = 'urban' AND hre <= 21 AND (bur + ror) > 40 AND are > 700", "8"),
        ("lcz = 'urban' AND bur <= 20 AND hre <= 9", "9"),
        ("lcz = 'urban' AND hre <= 9", "6"),
        ("lcz = 'urban' AND hre > 9 AND hre <= 30", "5"),
        ("lcz = 'urban' AND hre > 30", "4"),
        *[(f"lcz = '{a}' AND {compact}", b) for a, b in (("6", "3"), ("5", "2"), ("4", "1"))],
        *[(f"lcz = 'natural' AND {most('ver')} AND {c}", n) for c, n in (("vhr > 50", "A"), ("vhr > 25 AND vhr <= 50", "B"), ("vhr > 10 AND vhr <= 25", "C"), ("vhr <= 10", "D"))],
        *[(f"lcz = 'natural' AND {most(a)}", n) for a, n in (("ror", "E"), ("bsr", "F"), ("war", "G"))],
    ]
    out = ordered_updates(df.withColumn("lcz", start), "lcz", rules)
    codes = {**{str(i): i for i in range(1, 10)}, **{n: 11 + i for i, n in enumerate("ABCDEFG")}}
    return out.withColumn("lcz_int", apply_rules(F.lit(None).cast("int"), [(F.col("lcz") == k, v) for k, v in codes.items()]))


def compile_tree(tree: Tree, names: dict[str, float] | None = None) -> Column:
    """The tree as one Column. Intervals are (low, high]; equal bounds match that value; high < low wraps around.

    The first interval that holds is final, also where its subtree gives nothing. Unknown threshold names count as 0.
    """
    def bound(v) -> float:
        return float(v) if isinstance(v, (int, float)) else float((names or {}).get(v, 0))

    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for node in tree:
        ((name, (low, high, then)),) = node.items()
        lo, hi, v = bound(low), bound(high), F.col(name)
        held = ((v > lo) & (v <= hi)) | (F.lit(lo == hi) & (v == lo)) if hi >= lo else (v <= hi) | (v > lo)
        out = out.when(held, compile_tree(then, names) if isinstance(then, list) else F.lit(then))
    return out.otherwise(F.lit(None).cast("string"))


def classify_zones(df: DataFrame, trees: dict[str, Tree], land_use: str, fixed: dict[str, str] | None = None, names: dict[str, float] | None = None) -> DataFrame:
    """A tree chosen by land-use code; codes in fixed give their label at once. Adds history."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for code, label in (fixed or {}).items():
        out = out.when(F.col(land_use) == code, F.lit(label))
    for code, tree in trees.items():
        out = out.when(F.col(land_use) == code, compile_tree(tree, names))
    return df.withColumn("history", out)


def roughness_length(h: Column, zd: Column, far: Column) -> Column:
    """(h - zd) exp(-sqrt(0.4 / FAR)), 0 without frontal area."""
    return F.when(far == 0, 0.0).otherwise((h - zd) * F.exp(-F.sqrt(F.lit(0.4) / F.nullif(far, F.lit(0.0)))))


def displacement_height(h: Column, plan_ratio: Column) -> Column:
    """zd = h PAR^0.6."""
    return h * F.pow(plan_ratio, F.lit(0.6))


def terrain_roughness(zones: DataFrame, buildings: DataFrame, lines: list[DataFrame], size: float, spacing: float) -> DataFrame:
    """(fid, h, par, zd, far, z0, cls) of zones: height by volume, plan area ratio, displacement height, frontal area ratio
    as the mean over the directions of lines, roughness length and class. Zones without buildings have zeros and class 1.
    """
    whole = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    pieces = intersection_overlay(zones.select("fid", *BOX), buildings, size).groupBy(F.col("a_fid").alias("fid"))
    built = pieces.agg(volume_weighted_height(F.col("area") * F.col("b_hauteur"), F.col("b_hauteur")).alias("h"), F.sum("area").alias("_s"))
    out = zones.select("fid", whole.alias("_w")).join(built, "fid", "left").select("fid", F.coalesce("h", F.lit(0.0)).alias("h"), F.coalesce(F.col("_s") / F.col("_w"), F.lit(0.0)).alias("par"))
    out = out.withColumn("zd", displacement_height(F.col("h"), F.col("par")))
    rough = []
    for i, way in enumerate(lines):
        out = out.join(frontal_area(way, buildings, zones, size, spacing).select("fid", F.col("far").alias(f"_f{i}")), "fid", "left").withColumn(f"_f{i}", F.coalesce(f"_f{i}", F.lit(0.0)))
        rough.append(roughness_length(F.col("h"), F.col("zd"), F.col(f"_f{i}")))
    out = out.withColumn("far", sum(F.col(f"_f{i}") for i in range(len(lines))) / len(lines)).withColumn("z0", sum(rough) / len(rough))
    return out.select("fid", "h", "par", "zd", "far", "z0", roughness_class(F.col("z0")).alias("cls"))


def roughness_class(z0: Column, limits: tuple[float, ...] = (0.0025, 0.0175, 0.065, 0.175, 0.375, 0.75, 1.5)) -> Column:
    """1 below the first limit, up to 8 from the last on."""
    return reduce(lambda out, t: out + (z0 >= t).cast("int"), limits, F.lit(1))


def facade_ratio(facade: Column, unbuilt: Column) -> Column:
    return F.lit(0.5) * facade / (unbuilt + 0.0001)


#: (zone, least SI, most SI, least RA, most RA, roughness): fixed values, tried in this order; None is open.
COMBINATION = (
    (7, None, 10, 0.05, None, 4), (6, None, 40, 0.1, 0.5, 5), (5, 35, 65, 0.2, 0.6, 6), (4, 70, 95, 0.05, 0.2, 5),
    (3, 70, 85, 0.5, 1.5, 7), (2, 85, None, 1, 2.5, 7), (1, 90, None, 2, None, 8),
)
COMBINATION_WITHOUT_OVERLAP = (
    (7, None, 15, None, 0.2, None), (6, 15, 30, None, 0.6, None), (5, 30, 60, None, 0.6, None), (4, 60, None, None, 0.2, None),
    (3, 60, 75, 0.2, 2, None), (2, 75, None, 0.6, None, None), (1, 80, None, 1.5, None, None),
)


def urban_zones(df: DataFrame, method: str = "combination", roughness: bool = False) -> DataFrame:
    """ucz from si (imperviousness), ra (facade ratio) and, for methods with roughness, rug.

    combination: first match in the first table, with roughness where asked, then in the second for the rows that are left.
    combination_disjoint: the second table alone. hierarchy: every zone is split in turn; with roughness
    the last two updates may move 6 to 5 and back.
    """
    if method.startswith("combination"):
        table = (*COMBINATION, *COMBINATION_WITHOUT_OVERLAP) if method == "combination" else COMBINATION_WITHOUT_OVERLAP
        rules = []
        for ucz, s0, s1, r0, r1, rug in table:
            tests = [t for t, v in ((f"si >= {s0}", s0), (f"si < {s1}", s1), (f"ra >= {r0}", r0), (f"ra < {r1}", r1)) if v is not None]
            rules.append((" AND ".join(tests + ([f"rug = {rug}"] if roughness and rug else [])), ucz))
        return df.withColumn("ucz", apply_rules(F.lit(0), [(F.expr(c), v) for c, v in rules]))
    steps = [("ucz = 7 AND si >= 10 AND si < 35", 6), ("ucz = 7 AND si >= 35 AND si < 65", 5), ("ucz = 7 AND si >= 65", 4), ("ucz = 4 AND ra >= 0.5 AND ra < 1.5", 3), ("ucz = 4 AND ra >= 1.5 AND ra < 2.5", 2), ("ucz = 4 AND ra >= 2.5", 1)]
    steps += [("ucz = 6 AND rug = 6", 5), ("ucz = 5 AND rug = 5", 6)] if roughness else []
    return ordered_updates(df.withColumn("ucz", F.lit(7)), "ucz", steps)
