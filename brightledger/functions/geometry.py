"""Distances, boxes and vectors as plain columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def great_circle_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return EARTH_RADIUS_KM * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def register_sql_functions(spark) -> None:
    """SQL-callable distance, as a SQL expression function (no Python in the plan)."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION great_circle_km(a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE)
        RETURNS DOUBLE
        RETURN 6371.0D * 2 * asin(least(1.0D, sqrt(
            power(sin(radians(c - a) / 2), 2)
            + cos(radians(a)) * cos(radians(c)) * power(sin(radians(d - b) / 2), 2))))""")


def _side(box: str | Column, name: str) -> Column:
    return F.col(box + name) if isinstance(box, str) else box[name]


def intersection_area(a: str | Column, b: str | Column) -> Column:
    w = F.least(_side(a, "xmax"), _side(b, "xmax")) - F.greatest(_side(a, "xmin"), _side(b, "xmin"))
    h = F.least(_side(a, "ymax"), _side(b, "ymax")) - F.greatest(_side(a, "ymin"), _side(b, "ymin"))
    return F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0))


def box_area(p: str | Column = "") -> Column:
    return (_side(p, "xmax") - _side(p, "xmin")) * (_side(p, "ymax") - _side(p, "ymin"))


def box_overlap_ratio(a: str | Column, b: str | Column) -> Column:
    """Intersection over union of the boxes with column prefixes ``a`` and ``b``; either may be a struct instead."""
    inter = intersection_area(a, b)
    return inter / (box_area(a) + box_area(b) - inter + F.lit(1e-6))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: Column) -> Column:
    """Unit vector; a zero vector stays as it is."""
    n = norm(a)
    return F.when(n == 0, a.cast("array<double>")).otherwise(F.transform(a, lambda v: v.cast("double") / n))


def squared_distance(a: Column, b: Column) -> Column:
    diff = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(diff, F.lit(0.0), lambda acc, v: acc + v * v)


def argmax(a: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def second_max(a: Column) -> Column:
    return F.sort_array(a, asc=False)[1]


def entropy(a: Column) -> Column:
    return -F.aggregate(F.transform(a, lambda p: p * F.log(p + F.lit(1e-10))), F.lit(0.0), lambda acc, v: acc + v)
