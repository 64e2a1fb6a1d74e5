"""Adaptive cells for joins by distance: a quadtree over latitude and longitude, split where points are many.

Points are counted on a grid of 2**DEPTH x 2**DEPTH cells; a cell of the tree is split while it holds more than ``limit`` points.
A site meets the leaves that its circle can touch, and each of them is of one of three classes: outside (left out), inside
(every point is within the radius, no test), edge (points are tested). The classes follow from the distance to the leaf's middle
and a bound on how far its points are from there, so they are exact at the poles and the date line as well.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_KM, haversine_km

#: Levels of the tree; the grid has 4 ** DEPTH cells, which bounds the table of leaves.
DEPTH = 8
SIDE = 1 << DEPTH
#: Points of a leaf from which it is split.
LEAF_POINTS = 20_000
_HEIGHT, _WIDTH = 180.0 / SIDE, 360.0 / SIDE


def fine_cell(lat: Column, lon: Column) -> dict[str, Column]:
    """Row and column of the grid; the poles belong to the outermost rows, longitudes wrap."""
    row = F.least(F.greatest(F.floor((lat + 90.0) / _HEIGHT).cast("int"), F.lit(0)), F.lit(SIDE - 1))
    return {"_row": row, "_column": F.pmod(F.floor((lon + 180.0) / _WIDTH).cast("int"), F.lit(SIDE))}


def leaf_levels(counts: np.ndarray, limit: int) -> np.ndarray:
    """For each grid cell the level of the leaf that holds it: the first from above with at most ``limit`` points."""
    level = np.full(counts.shape, DEPTH)
    for at in range(DEPTH - 1, -1, -1):
        n = 1 << at
        size = SIDE // n
        sums = counts.reshape(n, size, n, size).sum(axis=(1, 3))
        level = np.where(np.kron(sums <= limit, np.ones((size, size), dtype=bool)), at, level)
    return level


def quadtree(points: DataFrame, limit: int = LEAF_POINTS) -> DataFrame:
    """_row, _column, leaf (level, row, column in one number): for each grid cell that holds points, its leaf.

    Counts of at most 4 ** DEPTH cells come to the driver, whatever the number of points.
    """
    counted = points.select(*[c.alias(n) for n, c in fine_cell(F.col("latitude"), F.col("longitude")).items()]).groupBy("_row", "_column").count()
    counts = np.zeros((SIDE, SIDE), dtype=np.int64)
    for r in counted.where(F.col("_row").isNotNull() & F.col("_column").isNotNull()).collect():
        counts[r["_row"], r["_column"]] = r["count"]
    level = leaf_levels(counts, limit)
    rows, columns = np.nonzero(counts)
    down = DEPTH - level[rows, columns]
    leaf = (level[rows, columns] << 2 * DEPTH) | ((rows >> down) << DEPTH) | (columns >> down)
    made = [(int(a), int(b), int(c)) for a, b, c in zip(rows, columns, leaf)]
    return points.sparkSession.createDataFrame(made, "_row int, _column int, leaf int")


def _touched(sites: DataFrame, radius_km: float) -> DataFrame:
    """Each site once per grid cell of the box around its circle."""
    arc = radius_km / EARTH_RADIUS_KM
    reach = math.degrees(arc) + 1e-6
    lat, lon = F.col("site_lat"), F.col("site_lon")
    polar = (lat - reach <= -90) | (lat + reach >= 90) | F.lit(arc >= math.pi / 2)
    half = F.when(polar, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(arc)) / F.cos(F.radians(lat))))) + 1e-6)

    def row(angle: Column) -> Column:
        return F.least(F.greatest(F.floor((angle + 90.0) / _HEIGHT).cast("int"), F.lit(0)), F.lit(SIDE - 1))

    first, last = (F.floor((lon + sign * half + 180.0) / _WIDTH).cast("int") for sign in (-1, 1))
    # a circle that spans all meridians takes every column once
    columns = F.when(last - first >= SIDE - 1, F.sequence(F.lit(0), F.lit(SIDE - 1))).otherwise(F.transform(F.sequence(first, last), lambda i: F.pmod(i, F.lit(SIDE))))
    return sites.withColumn("_row", F.explode(F.sequence(row(lat - reach), row(lat + reach)))).withColumn("_column", F.explode(columns))


def site_leaves(sites: DataFrame, tree: DataFrame, keys: Sequence[str], radius_km: float) -> DataFrame:
    """keys, site_lat, site_lon, leaf, inside: the leaves of the tree that a site's circle can touch."""
    met = _touched(sites.select(*keys, "site_lat", "site_lon"), radius_km).join(tree, ["_row", "_column"])
    met = met.select(*keys, "site_lat", "site_lon", "leaf").distinct()
    level = F.shiftright("leaf", 2 * DEPTH)
    row, column = F.shiftright("leaf", DEPTH).bitwiseAND(F.lit(SIDE - 1)), F.col("leaf").bitwiseAND(F.lit(SIDE - 1))
    height, width = F.lit(180.0) / F.pow(F.lit(2.0), level), F.lit(360.0) / F.pow(F.lit(2.0), level)
    lat, lon = (row + 0.5) * height - 90.0, (column + 0.5) * width - 180.0
    nearest_equator = F.greatest(F.abs(lat) - height / 2, F.lit(0.0))
    # a way along the meridian, then along the parallel, is never shorter than the arc
    spread = EARTH_RADIUS_KM * (F.radians(height / 2) + F.radians(width / 2) * F.cos(F.radians(nearest_equator)))
    placed = met.withColumn("_apart", haversine_km(F.col("site_lat"), F.col("site_lon"), lat, lon)).withColumn("_spread", spread)
    # a metre of margin, far above rounding
    return placed.where(F.col("_apart") - F.col("_spread") <= radius_km + 1e-3).withColumn("inside", F.col("_apart") + F.col("_spread") <= radius_km - 1e-3).drop("_apart", "_spread")


def in_leaves(points: DataFrame, tree: DataFrame) -> DataFrame:
    """``points`` with the ``leaf`` that holds each. The tree has at most 4 ** DEPTH rows, so it is broadcast."""
    celled = points.withColumns(fine_cell(F.col("latitude"), F.col("longitude")))
    return celled.join(F.broadcast(tree), ["_row", "_column"]).drop("_row", "_column")
