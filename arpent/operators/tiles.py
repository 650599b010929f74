"""Halo tiles: pixels go to square tiles with a margin of their neighbours, and one array step a tile gives new columns.

A pixel is sent to its own tile and to those whose margin it stands in, so the shuffle grows with the pixels and not with
the window: (1 + 2 * reach / width)^2 copies at most, of which only the own one carries the other columns.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Pixels on a side of a tile, without its margin.
WIDTH = 256


class Tile:
    """The pixels of a tile and its margin. Arrays reach `reach` pixels beyond the tile on every side."""

    def __init__(self, table: pa.Table, corner: tuple[int, int], reach: int, width: int):
        self.table, self.reach, self.side = table, reach, width + 2 * reach
        self.at = tuple(table[k].to_numpy() - (c - reach) for k, c in zip(("r", "c"), corner, strict=True))
        self.corner, self.width = corner, width

    def grid(self, name: str, fill: float = np.nan) -> np.ndarray:
        """A column as an array; `fill` where there is no pixel or no value."""
        out = np.full((self.side, self.side), fill)
        held = self.table[name].cast(pa.float64()).to_numpy(zero_copy_only=False)
        out[self.at] = np.where(np.isnan(held), fill, held)
        return out

    def codes(self, name: str) -> tuple[np.ndarray, pa.Array]:
        """Places of a column's values in their order, -1 where there is none; the values."""
        out = np.full((self.side, self.side), -1)
        held = self.table[name].combine_chunks()
        values = held.unique().drop_null()
        values = values.take(pa.compute.sort_indices(values))
        found = pa.compute.index_in(held, values).fill_null(-1)
        out[self.at] = found.to_numpy(zero_copy_only=False)
        return out, values


def on_tiles(px: DataFrame, columns: list[str], reach: int, kernel: Callable[[Tile], dict[str, np.ndarray]], outputs: dict[str, str], width: int | None = None) -> DataFrame:
    """px with the columns that kernel(tile) gives for the tile without its margin (width x width arrays, NaN for null).

    px has one row a pixel, by row r and column c; columns are those that neighbours need. outputs: name and SQL type; an
    output may also be (codes, values), for a type of the input's own. Other columns stay as they are.
    """
    width = width or max(WIDTH, reach)
    carried = [c for c in px.columns if c not in ("r", "c", *columns)]
    span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / width), F.floor((F.col(c) + reach) / width)))
    own = (F.floor(F.col("r") / width) == F.col("_tr")) & (F.floor(F.col("c") / width) == F.col("_tc"))
    copies = px.withColumn("_tr", span("r")).withColumn("_tc", span("c")).select("_tr", "_tc", own.alias("_own"), "r", "c", *columns, *[F.when(own, F.col(c)).alias(c) for c in carried])
    schema = T.StructType([*px.select("r", "c", *columns, *carried).schema.fields, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in outputs.items()]])
    for f in schema.fields:
        f.nullable = True
    arrow = {n: to_arrow_type(schema[n].dataType) for n in outputs}

    def run(key, table):
        tile = Tile(table, (key[0].as_py() * width, key[1].as_py() * width), reach, width)
        mine = table["_own"].combine_chunks()
        out = table.filter(mine).drop_columns(["_tr", "_tc", "_own"])
        at = (out["r"].to_numpy() - tile.corner[0], out["c"].to_numpy() - tile.corner[1])
        made = kernel(tile) if len(out) else {}
        for n in outputs:
            x = made.get(n)
            if x is None:  # a margin without a tile of its own
                column = pa.array([], arrow[n])
            elif isinstance(x, tuple):
                column = x[1].take(pa.array(x[0][at], mask=x[0][at] < 0))
            else:
                seen = np.asarray(x, float)[at]
                column = pa.array(np.where(np.isnan(seen), 0, seen), mask=np.isnan(seen)).cast(arrow[n])
            out = out.append_column(n, column)
        return out

    return copies.groupBy("_tr", "_tc").applyInArrow(run, schema).select(*px.columns, *outputs)


# --- windows: arrays in, arrays without the window's radius on every side out -------------------------------------------


def disk(radius: int) -> list[tuple[int, int]]:
    """(row, half width) of a disk's rows."""
    return [(d, int(np.sqrt(radius * radius - d * d))) for d in range(-radius, radius + 1)]


def square(radius: int) -> list[tuple[int, int]]:
    return [(d, radius) for d in range(-radius, radius + 1)]


def window_sum(a: np.ndarray, rows: list[tuple[int, int]]) -> np.ndarray:
    """Sums over a window, from running sums along each row."""
    m = rows[-1][0]
    n, w = a.shape[0] - 2 * m, a.shape[1] - 2 * m
    run = np.concatenate([np.zeros((a.shape[0], 1)), np.cumsum(a, axis=1)], axis=1)
    out = np.zeros((n, w))
    for d, h in rows:
        band = run[m + d : m + d + n]
        out += band[:, m + h + 1 : m + h + 1 + w] - band[:, m - h : m - h + w]
    return out


def window_least(a: np.ndarray, rows: list[tuple[int, int]]) -> np.ndarray:
    """Minima over a window; along a row from minima of doubled lengths."""
    m = rows[-1][0]
    n, w = a.shape[0] - 2 * m, a.shape[1] - 2 * m
    doubled = [a]
    while 2 ** len(doubled) <= 2 * m + 1:
        last, step = doubled[-1], 2 ** (len(doubled) - 1)
        doubled.append(np.minimum(last[:, :-step], last[:, step:]))
    out = np.full((n, w), np.inf)
    for d, h in rows:
        k = (2 * h + 1).bit_length() - 1
        band = doubled[k][m + d : m + d + n]
        out = np.minimum(out, np.minimum(band[:, m - h : m - h + w], band[:, m + h + 1 - 2**k : m + h + 1 - 2**k + w]))
    return out


def shrunk(a: np.ndarray, by: int) -> np.ndarray:
    return a[by : a.shape[0] - by, by : a.shape[1] - by] if by else a


def shifted(a: np.ndarray, dr: int, dc: int, margin: int) -> np.ndarray:
    """a at (r + dr, c + dc), without the margin."""
    n, w = a.shape[0] - 2 * margin, a.shape[1] - 2 * margin
    return a[margin + dr : margin + dr + n, margin + dc : margin + dc + w]


def most_frequent(codes: np.ndarray, n: int, rows: list[tuple[int, int]]) -> np.ndarray:
    """The most frequent code of a window; of ties the centre's own, else the smallest; -1 where there is none."""
    own = shrunk(codes, rows[-1][0])
    best, count = np.full(own.shape, -1), np.zeros(own.shape)
    for k in range(n):
        seen = np.rint(window_sum((codes == k).astype(float), rows))
        better = (seen > count) | (seen == count) & (own == k) & (seen > 0)
        best[better], count[better] = k, seen[better]
    return best


def mean_and_variance(a: np.ndarray, rows: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, mean, variance) of the values of a window; NaN is no value."""
    ok = ~np.isnan(a)
    mid = float(a[ok].mean()) if ok.any() else 0.0
    x = np.where(ok, a - mid, 0.0)
    n = np.rint(window_sum(ok.astype(float), rows))
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = window_sum(x, rows) / n
        variance = np.maximum(window_sum(x * x, rows) / n - mean * mean, 0.0)
    return n, mean + mid, variance
