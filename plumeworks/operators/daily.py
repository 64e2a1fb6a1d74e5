"""Daily roll-ups of the sensor, weather and reanalysis feeds.

Each is one scan and one aggregation that combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import day_in, is_text, number_in, parse_once
from ..functions.names import first_existing, require_columns
from ..functions.weather import kelvin_to_celsius, pascal_to_hectopascal, wind_from_deg, wind_speed

# Accepted column names, in order of preference.
PM25_DATE = ["date", "date_local_from", "date_utc_from"]
PM25_VALUE = ["value", "pm25", "pm2_5"]
WEATHER_TIME = ["date_time_lst", "date_time", "date_time_local"]
ERA5_TIME = ["valid_time", "time", "datetime"]

# Source column -> (statistic, output column).
WEATHER_FEATURES = {
    "temp_c": [("avg", "wx_temp_mean_c"), ("max", "wx_temp_max_c"), ("min", "wx_temp_min_c")],
    "dew_point_temp_c": [("avg", "wx_dewpoint_mean_c")],
    "rel_hum": [("avg", "wx_rh_mean_pct"), ("max", "wx_rh_max_pct"), ("min", "wx_rh_min_pct")],
    "precip_amount_mm": [("total", "wx_precip_total_mm"), ("max", "wx_precip_max_mm")],
    "wind_spd_km_h": [("avg", "wx_windspd_mean_kmh"), ("max", "wx_windspd_max_kmh")],
    "stn_press_kpa": [("avg", "wx_pressure_mean_kpa")],
    "visibility_km": [("avg", "wx_visibility_mean_km"), ("min", "wx_visibility_min_km")],
}


def total(c: Column | str) -> Column:
    """Sum that is 0.0 when every value is missing."""
    return F.coalesce(F.sum(c), F.lit(0.0))


_STATISTICS = {"avg": F.avg, "max": F.max, "min": F.min, "total": total}


def per_day(rows: DataFrame, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Aggregate per key and day, without the group of rows that have no day.

    That group is dropped after the aggregation, by a count: a filter on the parsed day
    would be pushed below and parse every text a second time.
    """
    grouped = rows.groupBy(*keys, "date").agg(*measures, F.count("date").alias("_dated"))
    return grouped.filter(F.col("_dated") > 0).drop("_dated")


def _typed(raw: DataFrame, date: str, columns: list[Column]) -> DataFrame:
    """The columns a roll-up needs. A typed date column stays open to scan filters."""
    return parse_once(raw, columns) if is_text(raw, date) else raw.select(*columns).filter(F.col("date").isNotNull())


def filter_days(df: DataFrame, start: str, end: str) -> DataFrame:
    """Days from ``start`` to ``end``, both included."""
    return df.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def pm25_daily(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean concentration per day; with a ``location_name`` column also the number of stations."""
    date, value = first_existing(raw, PM25_DATE), first_existing(raw, PM25_VALUE)
    stations = ["location_name"] if "location_name" in raw.columns else []
    columns = [F.col(c) for c in (*keys, *stations)]
    rows = _typed(raw, date, [*columns, day_in(raw, date).alias("date"), number_in(raw, value).alias("pm25")])
    measures = [F.avg("pm25").alias("pm25")]
    if stations:
        measures.append(F.count_distinct("location_name").alias("pm25_station_count"))
    return per_day(rows, keys, measures)


def weather_daily(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Daily station weather; only the measurements present in the feed give features."""
    time = first_existing(raw, WEATHER_TIME)
    present = [c for c in WEATHER_FEATURES if c in raw.columns]
    columns = [*[F.col(k) for k in keys], day_in(raw, time).alias("date"), *[number_in(raw, c).alias(c) for c in present]]
    rows = _typed(raw, time, columns)
    measures = [_STATISTICS[stat](c).alias(out) for c in present for stat, out in WEATHER_FEATURES[c]]
    return per_day(rows, keys, measures)


def era5_daily(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Daily reanalysis features. The wind direction comes from the mean vector."""
    time = first_existing(raw, ERA5_TIME)
    require_columns(raw, ["u10", "v10"], "reanalysis feed")
    present = [c for c in ("u10", "v10", "t2m", "d2m", "sp") if c in raw.columns]
    columns = [*[F.col(k) for k in keys], day_in(raw, time).alias("date"), *[number_in(raw, c).alias(c) for c in present]]
    rows = _typed(raw, time, columns)
    speed = wind_speed(F.col("u10"), F.col("v10"))
    measures = [
        F.avg("u10").alias("era5_u10_mean_ms"),
        F.avg("v10").alias("era5_v10_mean_ms"),
        F.avg(speed).alias("era5_wind_speed_mean_ms"),
        F.max(speed).alias("era5_wind_speed_max_ms"),
    ]
    if "t2m" in present:
        measures += [
            kelvin_to_celsius(f("t2m")).alias(f"era5_t2m_{name}_c")
            for name, f in (("mean", F.avg), ("max", F.max), ("min", F.min))
        ]
    if "d2m" in present:
        measures.append(kelvin_to_celsius(F.avg("d2m")).alias("era5_d2m_mean_c"))
    if "sp" in present:
        measures.append(pascal_to_hectopascal(F.avg("sp")).alias("era5_sp_mean_hpa"))
    daily = per_day(rows, keys, measures)
    from_deg = wind_from_deg(F.col("era5_u10_mean_ms"), F.col("era5_v10_mean_ms"))
    order = list(daily.columns)
    order.insert(order.index("era5_wind_speed_max_ms") + 1, "era5_wind_from_deg")
    return daily.withColumn("era5_wind_from_deg", from_deg).select(*order)
