"""Landed pages of an air-quality API: locations, their sensors, daily measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import utc_day
from ..functions.geo import bounding_box, haversine_km

# Parameter id of PM2.5 and the search radius in km.
PM25_PARAMETER_ID = 2
SEARCH_RADIUS_KM = 25.0

_SENSOR = (
    "struct<id:bigint, parameter:struct<id:bigint, name:string, units:string>, "
    "datetimeFirst:struct<utc:string>, datetimeLast:struct<utc:string>>"
)
LOCATION_PAGE = (
    "meta struct<page:int>, results array<struct<id:bigint, name:string, provider:struct<name:string>, "
    "owner:struct<name:string>, coordinates:struct<latitude:double, longitude:double>, isMobile:boolean, "
    "datetimeFirst:struct<utc:string>, datetimeLast:struct<utc:string>, "
    f"sensors:array<{_SENSOR}>>>"
)
MEASUREMENT_PAGE = (
    "meta struct<page:int>, results array<struct<value:double, parameter:struct<name:string, units:string>, "
    "period:struct<datetimeFrom:struct<utc:string, local:string>, datetimeTo:struct<utc:string, local:string>>>>"
)


def read_pages(spark: SparkSession, paths: str | list[str], schema: str, multi_line: bool = True) -> DataFrame:
    """All landed pages at once; the page loop of a client becomes one scan of the folder."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(paths)


def flatten_locations(pages: DataFrame) -> DataFrame:
    item = pages.select(F.explode("results").alias("r"))
    return item.select(
        F.col("r.id").alias("location_id"),
        F.col("r.name").alias("location_name"),
        F.col("r.provider.name").alias("provider"),
        F.col("r.owner.name").alias("owner"),
        F.col("r.coordinates.latitude").alias("latitude"),
        F.col("r.coordinates.longitude").alias("longitude"),
        F.col("r.isMobile").alias("is_mobile"),
        F.col("r.datetimeFirst.utc").alias("datetime_first_utc"),
        F.col("r.datetimeLast.utc").alias("datetime_last_utc"),
        F.col("r.sensors").alias("sensors"),
    )


def explode_sensors(locations: DataFrame, parameter_id: int = PM25_PARAMETER_ID) -> DataFrame:
    """One row per sensor that measures the parameter; locations without such a sensor give none."""
    sensor = locations.select("location_id", "location_name", F.explode("sensors").alias("s"))
    return sensor.filter(F.col("s.parameter.id") == parameter_id).select(
        "location_id",
        "location_name",
        F.col("s.id").alias("sensor_id"),
        F.col("s.parameter.id").alias("parameter_id"),
        F.col("s.parameter.name").alias("parameter_name"),
        F.col("s.parameter.units").alias("units"),
        F.col("s.datetimeFirst.utc").alias("coverage_datetime_from"),
        F.col("s.datetimeLast.utc").alias("coverage_datetime_to"),
    )


def _coverage_order() -> list[Column]:
    return [
        F.asc_nulls_last(F.col("coverage_datetime_from").try_cast("timestamp")),
        F.desc_nulls_last(F.col("coverage_datetime_to").try_cast("timestamp")),
        F.asc("sensor_id"),
    ]


def best_sensor(sensors: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Earliest coverage start, then latest coverage end; the smaller sensor id breaks full ties.

    Without keys this is a top-1 (no global sort). With keys the best row is a
    ``min`` over one ordering struct, which combines before the shuffle.
    """
    if not keys:
        return sensors.orderBy(*_coverage_order()).limit(1)
    start = F.col("coverage_datetime_from").try_cast("timestamp")
    end = F.unix_micros(F.col("coverage_datetime_to").try_cast("timestamp"))
    rank = F.struct(
        start.isNull().alias("n0"), start.alias("start"), end.isNull().alias("n1"), (-end).alias("end"),
        F.col("sensor_id"), F.struct(*[c for c in sensors.columns if c not in keys]).alias("row"),
    )
    best = sensors.groupBy(*keys).agg(F.min(rank).alias("best"))
    return best.select(*keys, "best.row.*").select(*sensors.columns)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def flatten_measurements(pages: DataFrame) -> DataFrame:
    item = pages.select(F.explode("results").alias("r"))
    return item.select(
        F.col("r.period.datetimeFrom.utc").alias("date_utc_from"),
        F.col("r.period.datetimeFrom.local").alias("date_local_from"),
        F.col("r.period.datetimeTo.utc").alias("date_utc_to"),
        F.col("r.period.datetimeTo.local").alias("date_local_to"),
        F.col("r.value").alias("value"),
        F.col("r.parameter.units").alias("unit"),
        F.col("r.parameter.name").alias("parameter_name"),
    )


def measurement_rows(flat: DataFrame, sensor: DataFrame) -> DataFrame:
    """Daily rows tagged with the chosen sensor (one row) and their UTC day. Without a sensor the job fails."""
    chosen = sensor.select(F.struct("sensor_id", "location_name").alias("s")).scalar()
    return (
        flat.withColumn("_s", F.coalesce(chosen, F.raise_error(F.lit("no sensor measures the parameter"))))
        .select(*flat.columns, F.col("_s.sensor_id").alias("sensor_id"), F.col("_s.location_name").alias("location_name"))
        .withColumn("date", utc_day("date_local_from"))
    )


def stations_in_radius(
    locations: DataFrame, lat: float, lon: float, radius_km: float = SEARCH_RADIUS_KM,
    parameter_id: int = PM25_PARAMETER_ID,
) -> DataFrame:
    """Locations within the radius that have a sensor for the parameter, with their distance."""
    box = bounding_box(lat, lon, radius_km)
    measures = F.exists("sensors", lambda s: s["parameter"]["id"] == parameter_id)
    return (
        locations.filter(box.contains(F.col("latitude"), F.col("longitude")))
        .filter(measures)
        .withColumn("distance_km", haversine_km(lat, lon, F.col("latitude"), F.col("longitude")))
        .filter(F.col("distance_km") <= radius_km)
    )
