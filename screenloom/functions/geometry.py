"""Coordinates, transforms and ratios as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_rotation(x: Column, y: Column, t: dict) -> tuple[Column, Column]:
    """x' = sx (cos θ x - sin θ y + dx), y' = sy (sin θ x + cos θ y + dy); ``t`` has dx, dy, theta (radians), scale_x, scale_y."""
    cos, sin = F.cos(t["theta"]), F.sin(t["theta"])
    return t["scale_x"] * (cos * x - sin * y + t["dx"]), t["scale_y"] * (sin * x + cos * y + t["dy"])


def affine(x: Column, y: Column, a, b, tx, c, d, ty) -> tuple[Column, Column]:
    return a * x + b * y + tx, c * x + d * y + ty


def sheared(x: Column, y: Column, dx, dy, theta, sx, sy, shear) -> tuple[Column, Column]:
    """Six degrees of freedom: shear in x, then rotation, scale and shift."""
    cos, sin = math.cos(theta), math.sin(theta)
    u = x + shear * y
    return sx * (cos * u - sin * y) + dx, sy * (sin * u + cos * y) + dy


def perspective(x: Column, y: Column, dx, dy, theta, sx, sy, px, py) -> tuple[Column, Column]:
    """Eight degrees of freedom with the two perspective terms ``px`` and ``py``."""
    cos, sin = math.cos(theta), math.sin(theta)
    w = px * x + py * y + 1
    return (sx * (cos * x - sin * y) + dx) / w, (sy * (sin * x + cos * y) + dy) / w


def to_global(local: Column, place: Column, size: int) -> Column:
    """Tile coordinate to well coordinate, cut to a whole number; ``place`` is the tile's row or column."""
    return (local + place * size).cast("long")


def circularity(area: Column, perimeter: Column) -> Column:
    """4 π A / P²; 0 for perimeter 0."""
    return F.when(perimeter == 0, F.lit(0.0)).otherwise(4 * math.pi * area / (perimeter * perimeter))


def ratio(part: Column, whole: Column) -> Column:
    """0 where the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def to_centre(x: Column, y: Column, width: float, height: float) -> Column:
    return F.sqrt((x - width / 2) * (x - width / 2) + (y - height / 2) * (y - height / 2))


def to_edge(x: Column, y: Column, width: float, height: float) -> Column:
    return F.least(x, y, width - x, height - y)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))
