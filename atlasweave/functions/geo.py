"""Geometry arithmetic on plain columns.

A geometry is ``array<struct<hole:boolean, points:array<struct<x:double,y:double>>>>``:
the closed rings of a (multi)polygon in degrees. No geometry library is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS_TYPE = "array<struct<hole:boolean,points:array<struct<x:double,y:double>>>>"

# --- fixed values -------------------------------------------------------------
EARTH_RADIUS_M = 6371000.0


def cell_area(lat: Column, dlat: float | Column, dlon: float | Column) -> Column:
    """Area in square metres of a ``dlat`` x ``dlon`` degree cell centred at ``lat``."""
    dlat = dlat if isinstance(dlat, Column) else F.lit(float(dlat))
    dlon = dlon if isinstance(dlon, Column) else F.lit(float(dlon))
    per_square_degree = (math.pi / 180.0) ** 2 * EARTH_RADIUS_M**2
    return F.abs(dlat * dlon) * F.lit(per_square_degree) * F.cos(F.radians(lat))


def all_points(rings: Column) -> Column:
    return F.flatten(F.transform(rings, lambda r: r["points"]))


def bounding_box(rings: Column, buffer: float | Column = 0.0) -> Column:
    """struct(min_x, min_y, max_x, max_y), widened by ``buffer`` degrees."""
    pts = all_points(rings)
    xs = F.transform(pts, lambda p: p["x"])
    ys = F.transform(pts, lambda p: p["y"])
    b = buffer if isinstance(buffer, Column) else F.lit(float(buffer))
    return F.struct(
        (F.array_min(xs) - b).alias("min_x"),
        (F.array_min(ys) - b).alias("min_y"),
        (F.array_max(xs) + b).alias("max_x"),
        (F.array_max(ys) + b).alias("max_y"),
    )


def ring_area2(points: Column) -> Column:
    """Twice the signed area of a closed ring (positive when counter-clockwise)."""
    n = F.size(points)
    head = F.slice(points, F.lit(1), n - 1)
    tail = F.slice(points, F.lit(2), n - 1)
    terms = F.zip_with(head, tail, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def geometry_problem(rings: Column) -> Column:
    """Why a geometry cannot be used, or null when it can.

    Checked: present, at least four points per ring, closed, finite, in lon/lat range.
    """
    pts = all_points(rings)
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 1e300)
    short = F.exists(rings, lambda r: F.size(r["points"]) < 4)
    bad = F.exists(pts, lambda p: ~(finite(p["x"]) & finite(p["y"])))
    open_ring = F.exists(
        rings,
        lambda r: (F.element_at(r["points"], 1)["x"] != F.element_at(r["points"], -1)["x"])
        | (F.element_at(r["points"], 1)["y"] != F.element_at(r["points"], -1)["y"]),
    )
    outside = F.exists(pts, lambda p: (F.abs(p["x"]) > 180) | (F.abs(p["y"]) > 90))
    return (
        F.when(rings.isNull() | (F.size(rings) == 0), "no geometry")
        .when(short, "ring too short")
        .when(bad, "coordinate not finite")
        .when(open_ring, "ring not closed")
        .when(outside, "outside lon/lat range")
    )
