"""Position of the sun for a date, an hour and a place, by the usual short series for declination and equation of time."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the series: for 1, cos g, sin g, cos 2g, sin 2g, cos 3g, sin 3g of the year's angle g.
EQUATION_OF_TIME = (0.000075, 0.001868, -0.032077, -0.014615, -0.040849, 0.0, 0.0)  # times 229.18 minutes
DECLINATION = (0.006918, -0.399912, 0.070257, -0.006758, 0.000907, -0.002697, 0.00148)  # radians


def _series(g: Column, terms: tuple[float, ...]) -> Column:
    out = F.lit(terms[0])
    for k in (1, 2, 3):
        out = out + terms[2 * k - 1] * F.cos(k * g) + terms[2 * k] * F.sin(k * g)
    return out


def sun_position(date: Column, hour: Column, latitude: Column, longitude: Column, zone: Column | float = 0.0) -> tuple[Column, Column]:
    """(azimuth clockwise from north, elevation) in degrees; hour is local time with its fraction, zone its hours east of UTC."""
    g = 2 * math.pi / 365 * (F.dayofyear(date) - 1 + (hour - 12) / 24)
    minutes = hour * 60 + 229.18 * _series(g, EQUATION_OF_TIME) + 4 * longitude - 60 * (zone if isinstance(zone, Column) else F.lit(zone))
    turn, lat, tilt = F.radians(minutes / 4 - 180), F.radians(latitude), _series(g, DECLINATION)
    elevation = F.asin(F.sin(lat) * F.sin(tilt) + F.cos(lat) * F.cos(tilt) * F.cos(turn))
    azimuth = F.atan2(F.sin(turn), F.cos(turn) * F.sin(lat) - F.tan(tilt) * F.cos(lat))
    return F.degrees(azimuth) + 180, F.degrees(elevation)
