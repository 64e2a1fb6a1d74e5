"""Feeds to master table to model-ready table."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import CENTRE_LAT, CENTRE_LON
from ..functions.names import numeric_columns
from ..operators import daily as D
from ..operators import fire as FI
from ..operators import spine as S
from ..operators.stats import zscore
from ..session import materialise
from ..sources.feeds import parse_fire_points
from ..sources.tables import counts_to_double, write_table


@dataclass(frozen=True)
class Feeds:
    """Raw feeds as text tables. ``sites`` (keys, site_lat, site_lon) switches to many sites."""

    pm25: DataFrame
    weather: DataFrame
    era5: DataFrame
    fire: DataFrame
    sites: DataFrame | None = None


@dataclass(frozen=True)
class Options:
    start: str = "2018-04-01"
    end: str = "2025-04-01"
    radius_km: float = FI.RADIUS_KM
    sector_deg: float = FI.UPWIND_SECTOR_DEG
    lat: float = CENTRE_LAT
    lon: float = CENTRE_LON
    train_ratio: float = 0.7
    val_ratio: float = 0.15
    keys: tuple[str, ...] = ()

    def check(self) -> None:
        if S.days_between(self.start, self.end) <= 1:
            raise ValueError("start must be before end")
        if not (0 < self.radius_km and 0 < self.sector_deg <= 180):
            raise ValueError("radius must be positive and the sector within (0, 180]")


Keep = Callable[[str, DataFrame], DataFrame]


def _keep_wind(name: str, df: DataFrame) -> DataFrame:
    """Write the reanalysis table, which two later steps start from; leave the others as plans."""
    return materialise(df, name) if name == "era5_daily" else df


def daily_tables(feeds: Feeds, opt: Options, keep: Keep = _keep_wind) -> dict[str, DataFrame]:
    """The four clean daily tables within the date range; the fire table is complete.

    ``keep`` gets each table as soon as it is defined and gives the one to go on with.
    """
    opt.check()
    keys = opt.keys

    def within(df: DataFrame) -> DataFrame:
        return D.filter_days(df, opt.start, opt.end)

    pm25 = keep("pm25_daily", within(D.pm25_daily(feeds.pm25, keys)))
    weather = keep("weather_daily", within(D.weather_daily(feeds.weather, keys)))
    era5 = keep("era5_daily", within(D.era5_daily(feeds.era5, keys)))
    points = within(parse_fire_points(feeds.fire))
    if feeds.sites is None:
        fire = FI.fire_features(points, era5, opt.lat, opt.lon, opt.radius_km, opt.sector_deg)
    else:
        fire = FI.site_fire_features(points, feeds.sites, era5, keys, opt.radius_km, opt.sector_deg)
    spine = S.date_spine(fire.sparkSession, opt.start, opt.end, feeds.sites, keys)
    fire = keep("fire_daily", S.fill_fire(spine, fire, opt.radius_km, keys))
    return {"pm25_daily": pm25, "weather_daily": weather, "era5_daily": era5, "fire_daily": fire}


def master_features(feeds: Feeds, opt: Options) -> DataFrame:
    """One row per day of the range (and site) with the target and every feature."""
    tables = daily_tables(feeds, opt)
    # the complete fire table already has every day and key, so it serves as the spine
    spine = tables["fire_daily"]
    others = [tables["pm25_daily"], tables["weather_daily"], tables["era5_daily"]]
    joined = S.join_master(spine, others, opt.keys)
    names = [c for t in others for c in t.columns if c not in ("date", *opt.keys)]
    fire = [c for c in spine.columns if c not in ("date", *opt.keys)]
    return joined.select(*opt.keys, "date", *names, *fire)


def model_ready(master: DataFrame, opt: Options = Options(), fit_on: DataFrame | None = None) -> DataFrame:
    """Rows with a target, features filled, ``split`` added.

    Medians use all rows, as the published figures do; pass ``fit_on`` to keep
    later rows out of them.
    """
    filled = S.fill_features(master, opt.keys, fit_on=fit_on)
    return S.chrono_split(filled, opt.train_ratio, opt.val_ratio, opt.keys)


def scaled(ready: DataFrame, opt: Options = Options(), fit_on: DataFrame | None = None) -> DataFrame:
    columns = numeric_columns(ready, exclude=["pm25", *opt.keys])
    return zscore(ready, columns, opt.keys, fit_on)


def run_pipeline(feeds: Feeds, opt: Options, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Build and write every table below ``root``.

    Every feed is scanned once and every table written once, to its final place, in key and
    date order; later steps start from what was written. Splits are one table each, in one
    folder per ``split``.
    """
    spark: SparkSession = feeds.pm25.sparkSession
    order = [*opt.keys, "date"]

    def put(name: str, df: DataFrame) -> DataFrame:
        ordered = counts_to_double(df, keep=opt.keys).orderBy(*order)
        if fmt != "parquet":
            # a delimited file loses types, so the next step starts from a typed copy
            ordered = materialise(ordered, name)
        parts = ("split",) if "split" in df.columns else ()
        write_table(ordered, os.path.join(root, name), fmt, parts)
        return spark.read.schema(ordered.schema).parquet(os.path.join(root, name)).select(*df.columns) if fmt == "parquet" else ordered

    tables = daily_tables(feeds, opt, put)
    joined = S.join_master(tables["fire_daily"], [tables[n] for n in ("pm25_daily", "weather_daily", "era5_daily")], opt.keys)
    named = [c for n in ("pm25_daily", "weather_daily", "era5_daily", "fire_daily") for c in tables[n].columns]
    features = [c for c in dict.fromkeys(named) if c not in ("date", *opt.keys)]
    tables["master_daily"] = put("master_daily", joined.select(*opt.keys, "date", *features))
    tables["model_ready"] = put("model_ready", model_ready(tables["master_daily"], opt))
    tables["model_ready_scaled"] = put("model_ready_scaled", scaled(tables["model_ready"], opt))
    return tables


def dataset_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and missing cells of each named table, one aggregation per table."""
    parts = []
    for name, df in tables.items():
        missing = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
        parts.append(
            df.agg(
                F.lit(name).alias("dataset"),
                F.count(F.lit(1)).alias("rows"),
                F.lit(len(df.columns)).cast("bigint").alias("columns"),
                missing.cast("bigint").alias("missing_cells"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ("date",)) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)
