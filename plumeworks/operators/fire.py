"""Fire points to daily smoke-transport features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import (
    CENTRE_LAT, CENTRE_LON, angular_diff_deg, bearing_deg, bounding_box, haversine_km,
)
from .cells import LEAF_POINTS, in_leaves, quadtree, site_leaves
from .daily import per_day, total
from .joins import BROADCAST_ROWS, counted_within, lookup_join

RADIUS_KM = 400.0
UPWIND_SECTOR_DEG = 45.0


def fires_near(
    points: DataFrame, lat: float = CENTRE_LAT, lon: float = CENTRE_LON, radius_km: float = RADIUS_KM
) -> DataFrame:
    """Points within the radius of one centre, with ``distance_km`` and ``bearing_deg``.

    The box test comes first; on typed points (``parse_fire_points`` of a typed table)
    it reaches the scan and skips row groups. The exact test follows.
    """
    box = bounding_box(lat, lon, radius_km)
    return (
        points.filter(box.contains(F.col("latitude"), F.col("longitude")))
        .withColumn("distance_km", haversine_km(lat, lon, F.col("latitude"), F.col("longitude")))
        .filter(F.col("distance_km") <= radius_km)
        .withColumn("bearing_deg", bearing_deg(lat, lon, F.col("latitude"), F.col("longitude")))
    )


def _spread(points: DataFrame) -> DataFrame:
    """Points dealt to all tasks by their own hash. What follows multiplies rows, so a table of few files must not keep it in
    as few tasks."""
    spark = points.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return points.repartition(tasks, F.xxhash64("latitude", "longitude", "datetime"))


def fires_near_sites(
    points: DataFrame, sites: DataFrame, keys: Sequence[str] = ("site_id",), radius_km: float = RADIUS_KM,
    broadcast_rows: int = BROADCAST_ROWS, salts: int | None = None, leaf_points: int = LEAF_POINTS,
) -> DataFrame:
    """The same for many sites (``keys, site_lat, site_lon``): an equi-join on adaptive cells.

    A point has one cell, a site the cells its circle touches. Points of cells that lie inside the circle are
    taken as they are, those of cells at its edge are tested. The cells of the sites are broadcast when they were
    counted to be few; else cells are salted, so a region full of fires spans several tasks.
    """
    tree = quadtree(points, leaf_points)
    cells = site_leaves(sites, tree, keys, radius_km)
    small = counted_within(cells, broadcast_rows)
    pairs = lookup_join(
        in_leaves(_spread(points), tree), cells, ["leaf"], "inner",
        max_lookup_rows=broadcast_rows if small else None,
        salt_on=["latitude", "longitude", "datetime"], salts=salts,
    ).drop("leaf")
    here, there = (F.col("site_lat"), F.col("site_lon")), (F.col("latitude"), F.col("longitude"))
    # a pair that passes becomes a row with its distance, so the distance is computed once; the outer form keeps Spark from
    # testing the size of the array, distance and all, before it
    reached = F.filter(F.array(haversine_km(*here, *there)), lambda km: F.col("inside") | (km <= radius_km))
    return pairs.withColumn("distance_km", F.explode_outer(reached)).where(F.col("distance_km").isNotNull()).drop("inside").withColumn("bearing_deg", bearing_deg(*here, *there))


def site_fire_counts(
    points: DataFrame, sites: DataFrame, keys: Sequence[str] = ("site_id",), radius_km: float = RADIUS_KM, leaf_points: int = LEAF_POINTS
) -> DataFrame:
    """``fire_count, fire_frp_sum`` per site and day, without looking at a distance inside a circle.

    Points are summed by cell and day first; a cell inside a circle gives its sums, only points at the edge meet the site.
    """
    tree = quadtree(points, leaf_points)
    cells = site_leaves(sites, tree, keys, radius_km)
    located = in_leaves(points, tree)
    by_cell = located.groupBy("leaf", "date").agg(F.count(F.lit(1)).alias("n"), F.sum("frp").alias("frp"))
    whole = by_cell.join(cells.where("inside"), "leaf").select(*keys, "date", "n", "frp")
    edge = lookup_join(located, cells.where("NOT inside"), ["leaf"], "inner", max_lookup_rows=BROADCAST_ROWS if counted_within(cells) else None, salt_on=["latitude", "longitude", "datetime"])
    apart = haversine_km(F.col("site_lat"), F.col("site_lon"), F.col("latitude"), F.col("longitude"))
    tested = edge.where(apart <= radius_km).select(*keys, "date", F.lit(1).cast("long").alias("n"), "frp")
    return whole.unionByName(tested).groupBy(*keys, "date").agg(F.sum("n").alias("fire_count"), F.coalesce(F.sum("frp"), F.lit(0.0)).alias("fire_frp_sum"))


def join_wind(
    located: DataFrame, wind_daily: DataFrame, keys: Sequence[str] = (), max_wind_rows: int | None = None
) -> DataFrame:
    """Attach the day's wind direction; fires on days without wind keep a NULL.

    The wind table is broadcast when a bound is given or it was counted to be small (the
    count reads it, so pass a written table); else the join is salted.
    """
    wind = wind_daily.select(*keys, "date", "era5_wind_from_deg")
    if max_wind_rows is None and counted_within(wind):
        max_wind_rows = BROADCAST_ROWS
    return lookup_join(
        located, wind, [*keys, "date"], "left", max_lookup_rows=max_wind_rows,
        salt_on=["latitude", "longitude", "datetime"],
    )


def smoke_rows(with_wind: DataFrame, sector_deg: float = UPWIND_SECTOR_DEG) -> DataFrame:
    """Per-fire transport features from distance, bearing and wind."""
    diff = F.col("angle_diff_deg")
    spread = F.col("distance_km") + 1.0
    return (
        with_wind.withColumn("angle_diff_deg", angular_diff_deg(F.col("bearing_deg"), F.col("era5_wind_from_deg")))
        .withColumns(
            {
                # rounded, so that a wind at the very edge does not hang on the order in which its mean was summed
                "is_upwind": F.coalesce(F.round(diff, 9) <= sector_deg, F.lit(False)),
                "frp_over_distance": F.col("frp") / spread,
                # greatest skips NULL, an unknown wind must stay unknown
                "transport_weight": F.when(diff.isNotNull(), F.greatest(F.cos(F.radians(diff)), F.lit(0.0))),
            }
        )
        .withColumn("smoke_index", F.col("frp") * F.col("transport_weight") / (spread * spread))
    )


def all_fire_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("fire_count"),
        total("frp").alias("fire_frp_sum"),
        F.avg("frp").alias("fire_frp_mean"),
        F.min("distance_km").alias("fire_nearest_km"),
        F.avg("distance_km").alias("fire_mean_km"),
        total("frp_over_distance").alias("fire_frp_dist_weighted_sum"),
        total("smoke_index").alias("fire_smoke_transport_index"),
    ]


def upwind_measures() -> list[Column]:
    upwind = F.col("is_upwind")
    return [
        F.count_if(upwind).alias("upwind_fire_count"),
        total(F.when(upwind, F.col("frp"))).alias("upwind_fire_frp_sum"),
        F.min(F.when(upwind, F.col("distance_km"))).alias("upwind_fire_nearest_km"),
    ]


def fire_daily(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """All fires and the upwind ones in one aggregation (no second pass, no join)."""
    return per_day(rows, keys, [*all_fire_measures(), *upwind_measures()])


def fire_features(
    points: DataFrame,
    wind_daily: DataFrame,
    lat: float = CENTRE_LAT,
    lon: float = CENTRE_LON,
    radius_km: float = RADIUS_KM,
    sector_deg: float = UPWIND_SECTOR_DEG,
) -> DataFrame:
    """Daily fire features for one centre."""
    located = fires_near(points, lat, lon, radius_km)
    return fire_daily(smoke_rows(join_wind(located, wind_daily), sector_deg))


def site_fire_features(
    points: DataFrame,
    sites: DataFrame,
    wind_daily: DataFrame,
    keys: Sequence[str] = ("site_id",),
    radius_km: float = RADIUS_KM,
    sector_deg: float = UPWIND_SECTOR_DEG,
    max_wind_rows: int | None = None,
) -> DataFrame:
    """Daily fire features for many sites, each with its own wind."""
    located = fires_near_sites(points, sites, keys, radius_km).select(*keys, "latitude", "longitude", "datetime", "date", "frp", "distance_km", "bearing_deg")
    return fire_daily(smoke_rows(join_wind(located, wind_daily, keys, max_wind_rows), sector_deg), keys)
