"""Points around a place, in whole micro-degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values, in metres.
MERIDIAN = 40008000.0
EARTH_RADIUS = 6371000.0


def latitude_span(metres: float) -> float:
    return metres / MERIDIAN * 360.0


def longitude_span(metres: float) -> float:
    """Degrees at the equator, whatever the latitude."""
    return math.sin(metres / 2 / EARTH_RADIUS) * 2.0 * (180.0 / math.pi)


def box(lat: float, lon: float, radius: int) -> tuple[int, int, int, int]:
    """(least lon, most lon, least lat, most lat) in micro-degrees."""
    micro = lambda x: int(x * 1_000_000)
    dx, dy = longitude_span(radius), latitude_span(radius)
    return micro(lon) + micro(-dx), micro(lon) + micro(dx), micro(lat) + micro(-dy), micro(lat) + micro(dy)


def micro_degrees(c: Column) -> Column:
    """By way of a float, as stored coordinates were."""
    return (c.try_cast("float") * F.lit(1000000)).try_cast("bigint")


def audience_near(points: DataFrame, lat: float, lon: float, radius: int, first: str, last: str) -> DataFrame:
    """(typ, visitor_id): devices seen in the box (least, most] in the dates."""
    x0, x1, y0, y1 = box(lat, lon, radius)
    x, y = micro_degrees(F.col("longitude")), micro_degrees(F.col("latitude"))
    here = points.filter(F.col("dt").between(first, last) & (x > x0) & (x <= x1) & (y > y0) & (y <= y1))
    return here.select(F.lit("did").alias("typ"), F.col("did").alias("visitor_id")).distinct()
