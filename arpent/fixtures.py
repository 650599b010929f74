"""Raster, zone, building, point and line tables derived from the relational tables, in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: One statement for both engines, but for: //, a date format and the text type.
DEFINITIONS = {
    "grid_meta": "SELECT CAST(125 AS BIGINT) AS w, CAST(count(*) // 125 AS BIGINT) AS h FROM orders",
    "px": """SELECT o_orderkey AS pid, o_orderkey // 125 AS r, o_orderkey % 125 AS c,
  (o_orderkey % 125) + CAST(0.5 AS DOUBLE) AS x, h - (o_orderkey // 125) - CAST(0.5 AS DOUBLE) AS y,
  CAST(o_custkey % 256 AS DOUBLE) AS red, CAST((o_orderkey * 7) % 256 AS DOUBLE) AS green, CAST((o_orderkey * 11) % 256 AS DOUBLE) AS blue,
  CAST(CAST(floor(o_totalprice) AS BIGINT) % 256 AS DOUBLE) AS nir, CAST((o_custkey * 3) % 256 AS DOUBLE) AS swir1, CAST((o_custkey * 5) % 256 AS DOUBLE) AS swir2,
  CAST(substr(o_orderpriority,1,1) AS INTEGER) * 100 AS cls, CASE o_orderstatus WHEN 'F' THEN 100 WHEN 'O' THEN 200 ELSE 300 END AS ref
  FROM orders CROSS JOIN grid_meta""",
    "height_px": "SELECT o_orderkey AS pid, coalesce(sum(l_quantity), CAST(0 AS DOUBLE)) AS hgt FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey",
    "zone": """SELECT CAST(n_nationkey AS BIGINT) AS fid, n_name AS name, CAST((n_nationkey % 5) * 25 AS DOUBLE) AS xmin, CAST((n_nationkey % 5) * 25 + 25 AS DOUBLE) AS xmax,
  (n_nationkey // 5) * CAST(h // 5 AS DOUBLE) AS ymin, (n_nationkey // 5 + 1) * CAST(h // 5 AS DOUBLE) AS ymax FROM nation CROSS JOIN grid_meta""",
    "zone_ov": """SELECT s_suppkey AS fid, s_nationkey AS zoning, CAST((s_suppkey * 13) % 110 AS DOUBLE) AS xmin, CAST((s_suppkey * 13) % 110 + 5 + s_suppkey % 15 AS DOUBLE) AS xmax,
  CAST((s_suppkey * 7) % h AS DOUBLE) AS ymin, CAST((s_suppkey * 7) % h + 2 + s_suppkey % 10 AS DOUBLE) AS ymax FROM supplier CROSS JOIN grid_meta""",
    "bld": """SELECT p_partkey AS fid, p_type AS nature, CAST(p_size AS DOUBLE) AS hauteur, CAST(((p_partkey * 37) % 1200) AS DOUBLE) / 10 AS xmin, CAST(((p_partkey * 37) % 1200) AS DOUBLE) / 10 + CAST((1 + p_size % 10) AS DOUBLE) / 2 AS xmax,
  CAST(((p_partkey * 91) % (h * 10)) AS DOUBLE) / 10 AS ymin, CAST(((p_partkey * 91) % (h * 10)) AS DOUBLE) / 10 + CAST((1 + p_size % 7) AS DOUBLE) / 2 AS ymax FROM part CROSS JOIN grid_meta""",
    "pt": "SELECT c_custkey AS fid, c_acctbal AS z, CAST(((c_custkey * 53) % 1250) AS DOUBLE) / 10 AS x, CAST(((c_custkey * 29) % (h * 10)) AS DOUBLE) / 10 AS y FROM customer CROSS JOIN grid_meta",
    "coast": """SELECT CAST(a.n_nationkey AS BIGINT) AS seg, a.n_nationkey * CAST(5.2 AS DOUBLE) AS x1, CAST(h AS DOUBLE) / 2 + (a.n_nationkey * 7) % 10 - 5 AS y1, b.n_nationkey * CAST(5.2 AS DOUBLE) AS x2, CAST(h AS DOUBLE) / 2 + (b.n_nationkey * 7) % 10 - 5 AS y2
  FROM nation a JOIN nation b ON b.n_nationkey = a.n_nationkey + 1 CROSS JOIN grid_meta""",
    "scene": "SELECT o_orderkey AS sid, concat('IMG_', strftime(o_orderdate, '%Y%m%d'), 'T', lpad(CAST((o_orderkey * 7919) % 86400000 AS VARCHAR), 9, '0'), '_', CAST(o_custkey AS VARCHAR)) AS name FROM orders",
    "alloc": "SELECT user_id AS src, event_type AS dst, sum(value) AS w FROM events GROUP BY user_id, event_type",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def oracle(sql: str) -> str:
    """The statement with the derived tables that it may name in front."""
    given = ",\n".join(f"{name} AS ({text})" for name, text in DEFINITIONS.items())
    if "w(" in sql and " UNION SELECT " in sql:
        given = "RECURSIVE " + given
    return f"WITH {given},\n{sql.strip()[5:]}" if sql.strip()[:5].upper() == "WITH " else f"WITH {given}\n{sql.strip()}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, or one of the given ones."""
    if name not in DEFINITIONS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = DEFINITIONS[name].replace("//", "div").replace("strftime(o_orderdate, '%Y%m%d')", "date_format(o_orderdate, 'yyyyMMdd')").replace("AS VARCHAR", "AS STRING")
    needs = {t: table(spark, sf_dir, t) for t in (*TABLES, "grid_meta") if t != name and t in text.replace(",", " ").replace(")", " ").split()}
    for t in needs:
        text = " ".join(f"{{{t}}}" if w == t else w for w in text.split())
    return spark.sql(text, **needs)
