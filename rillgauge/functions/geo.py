"""Grid cells and the proximity box."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def cells_per_degree(threshold: float) -> int:
    """Whole number of grid cells in a degree, none of them narrower than the threshold."""
    fitting = math.floor(1 / threshold) if threshold > 0 else 0
    if fitting < 1:
        raise ValueError("the threshold must be over 0 and at most 1 degree")
    return fitting


def grid_cell(degrees: Column, threshold: float) -> Column:
    """Index of the nearest grid line, halves rounded up (also below zero)."""
    return F.floor(degrees * F.lit(cells_per_degree(threshold)) + F.lit(0.5))


def usable(lat: Column, lon: Column) -> Column:
    """Both coordinates present, numeric and non-zero: zero marks a missing location."""
    return (
        lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
        & (lat != 0) & (lon != 0)
    )


def within_box(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column, threshold: float) -> Column:
    """Both offsets strictly below the threshold."""
    return (F.abs(lat_a - lat_b) < threshold) & (F.abs(lon_a - lon_b) < threshold)
