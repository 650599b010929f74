"""Spectral indices of a pixel, as Columns of band Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-7


def _zero(*bands: Column) -> Column:
    out = bands[0] == 0
    for b in bands[1:]:
        out = out & (b == 0)
    return out


def normalised(a: Column, b: Column, guard: Column | None = None) -> Column:
    """(a - b) / (a + b + eps); equal bands give 0 where the guard band is 0 and eps elsewhere."""
    return F.when(a == b, F.when((a if guard is None else guard) == 0, 0.0).otherwise(EPS)).otherwise((a - b) / (a + b + EPS))


def _modified(a: Column, b: Column, extra: Column) -> Column:
    top = a - b + extra
    return F.when(_zero(a, b, extra), 0.0).when(top == 0, EPS).otherwise(top / (a + b + extra + EPS))


def tndvi(nir: Column, red: Column) -> Column:
    return F.when(_zero(nir, red), 0.0).otherwise(F.sqrt((nir - red) / (nir + red + EPS) + 0.5))


def pndvi(nir: Column, green: Column, red: Column, blue: Column) -> Column:
    top = nir - green - red - blue
    return F.when(_zero(nir, green, red, blue), 0.0).when(top == 0, EPS).otherwise(top / (nir + green + red + blue + EPS))


def ndwi2(green: Column, nir: Column) -> Column:
    return F.when(nir == green, F.when(nir == 0, 0.0).otherwise(EPS)).otherwise((green - nir) / (green + nir + EPS))


def isu(red: Column, nir: Column) -> Column:
    """Null where nir is 0 and red is not."""
    return F.when(red == 0, 0.0).otherwise(75 * (F.try_divide(red, nir) + EPS))


def gemi(nir: Column, red: Column) -> Column:
    """Null where a denominator is 0."""
    eta = F.try_divide(2 * (nir * nir - red * red) + 1.5 * nir + 0.5 * red, nir + red + 0.5)
    return F.when(_zero(nir, red), 0.0).otherwise(eta * (1 - 0.25 * eta) - F.try_divide(red - 0.125, 1 - red))


def bsi(swir1: Column, red: Column, nir: Column, blue: Column) -> Column:
    return F.when(_zero(red, blue, nir, swir1), 0.0).otherwise(((swir1 + red) - (nir + blue)) / ((swir1 + red) + (nir + blue) + EPS))


def nbi(red: Column, mir: Column, nir: Column) -> Column:
    return F.when(_zero(mir, nir, red), 0.0).when((red != mir) & ((red == 0) | (mir == 0)), EPS).otherwise(red * mir / (nir + EPS))


def redness(red: Column, green: Column, blue: Column) -> Column:
    return F.when(_zero(green, blue, red), 0.0).when(red == 0, EPS).otherwise(red * red / (EPS + blue + green * green * green))


def c3(red: Column, green: Column, blue: Column) -> Column:
    return F.when(blue == 0, 0.0).otherwise(F.atan(blue / (F.greatest(red, green) + EPS)))


def exg(red: Column, green: Column, blue: Column) -> Column:
    top = green - red - blue
    return F.when(top == 0, 0.0).otherwise(2 * top / (red + green + blue + EPS))


def luminance(red: Column, green: Column, blue: Column) -> Column:
    return F.when(_zero(red, green, blue), 0.0).otherwise((red + green + blue) / 3)


def msavi2(nir: Column, red: Column) -> Column:
    """Null where the root has no real value."""
    twice = 2 * nir + 1
    under = twice * twice - 8 * (nir - red)
    return F.when(_zero(nir, red), EPS).otherwise((twice - F.when(under >= 0, F.sqrt(under)) + EPS) / 2)


def sipi(nir: Column, blue: Column, red: Column) -> Column:
    return F.when((nir == red) | ((nir == blue) & (nir == 0)), EPS).otherwise((nir - blue) / (nir - red + EPS))


def intensity(red: Column, green: Column, blue: Column) -> Column:
    return (red + green + blue) / 3


def saturation(red: Column, green: Column, blue: Column) -> Column:
    total = red + green + blue
    return F.when(total == 0, 0.0).otherwise(1 - 3 * F.least(red, green, blue) / F.nullif(total, F.lit(0.0)))


def hue(red: Column, green: Column, blue: Column) -> Column:
    """Degrees around the colour circle, 0 for greys."""
    x, y = 2 * red - green - blue, F.sqrt(F.lit(3.0)) * (green - blue)
    return F.when((x == 0) & (y == 0), 0.0).otherwise(F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0)))


def isi(h: Column, i: Column, nir: Column) -> Column:
    """Null where a denominator is 0."""
    ratio = F.try_divide(h - i, h + i)
    return F.when((h == -i) & (i == 0), 0.001).otherwise(F.try_divide(ratio + (1 - nir), ratio + (1 + nir)))


def scowi(blue: Column, green: Column, nir: Column, swir1: Column | None = None, swir2: Column | None = None) -> Column:
    if swir1 is None or swir2 is None:
        return blue + 2 * green - 2.4 * nir
    return blue + 2 * (green - nir) - 0.75 * swir1 - 0.5 * swir2


#: Index name -> function and the channels that it takes, in order.
INDICES: dict[str, tuple[Callable[..., Column], tuple[str, ...]]] = {
    "ndvi": (normalised, ("nir", "red")),
    "ndvi_mod": (_modified, ("nir", "red", "rededge")),
    "tndvi": (tndvi, ("nir", "red")),
    "pndvi": (pndvi, ("nir", "green", "red", "blue")),
    "ndwi": (normalised, ("nir", "mir")),
    "ndwi2": (ndwi2, ("green", "nir")),
    "ndwi2_mod": (_modified, ("green", "nir", "rededge")),
    "mndwi": (lambda g, s: normalised(g, s, s), ("green", "swir1")),
    "ndmi": (lambda n, s: normalised(n, s, s), ("nir", "swir1")),
    "isu": (isu, ("red", "nir")),
    "gemi": (gemi, ("nir", "red")),
    "bsi": (bsi, ("swir1", "red", "nir", "blue")),
    "ndbi": (normalised, ("mir", "nir")),
    "nbi": (nbi, ("red", "mir", "nir")),
    "redness": (redness, ("red", "green", "blue")),
    "ci": (normalised, ("red", "green")),
    "bi": (lambda n, r: F.sqrt(n * n + r * r), ("nir", "red")),
    "bi2": (lambda n, r, g: F.sqrt((n * n + r * r + g * g) / 3), ("nir", "red", "green")),
    "c3": (c3, ("red", "green", "blue")),
    "exg": (exg, ("red", "green", "blue")),
    "luminance": (luminance, ("red", "green", "blue")),
    "msavi2": (msavi2, ("nir", "red")),
    "sipi": (sipi, ("nir", "blue", "red")),
    "hue": (hue, ("red", "green", "blue")),
    "intensity": (intensity, ("red", "green", "blue")),
    "saturation": (saturation, ("red", "green", "blue")),
    "isi": (lambda r, g, b, n: isi(hue(r, g, b), intensity(r, g, b), n), ("red", "green", "blue", "nir")),
    "vssi": (lambda g, r, n: 2 * g - 5 * (r + n), ("green", "red", "nir")),
    "blue_index": (lambda r, g, b: F.when(b == 0, 0.0).otherwise(b / (r + g + b) + EPS), ("red", "green", "blue")),
    "scowi": (scowi, ("blue", "green", "nir")),
    "scowi_swir": (scowi, ("blue", "green", "nir", "swir1", "swir2")),
}


def index(name: str, channels: dict[str, str]) -> Column:
    """One index; channels maps channel names to columns. A missing channel raises KeyError before any work."""
    f, needs = INDICES[name]
    missing = [c for c in needs if c not in channels]
    if missing:
        raise KeyError(f"{name} needs the channels {missing}")
    return f(*[F.col(channels[c]) for c in needs])


def compute_indices(px: DataFrame, names: list[str], channels: dict[str, str]) -> DataFrame:
    """Many indices in one projection; fails before any work if a channel is missing."""
    return px.select("*", *[index(n, channels).alias(n) for n in names])
