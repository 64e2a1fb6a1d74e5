"""Every registered query: a Spark function, the shape of its rows, and (mostly) the SQL it must equal."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession

from ..plans.pipeline import Feeds, Options, master_features, model_ready
from ..session import shared_dir
from ..sources.tables import is_there, publish
from .adapters import END, FEEDS, START, feed
from .sql import full_sql, shape

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFn
    spec: str | None
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, spec: str | None = None, sql: str | None = None):
    """Register a query. With ``spec`` both sides are cast to that shape; without ``sql`` rows only are checked."""

    def add(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            df = fn(spark, sf)
            return shape(df, spec) if spec else df

        QUERIES[name] = Query(run, spec, full_sql(spec, sql) if spec and sql else None)
        return fn

    return add


OPTIONS = Options(start=START, end=END)
#: Changes with how a kept table is made.
KEPT_FORMAT = 1
_FEED_NAMES = ("fx_pm25", "fx_weather", "fx_era5", "fx_fire")


def feeds(spark: SparkSession, sf: str) -> Feeds:
    return Feeds(*[feed(spark, sf, n) for n in _FEED_NAMES])


def _source_key(spark: SparkSession, sf: str, names: tuple[str, ...]) -> str:
    """Names the files behind feeds: their paths, sizes and times of change."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = []
    for table in sorted({FEEDS[n][0] for n in names}):
        for file in spark.read.parquet(f"{sf}/{table}.parquet").inputFiles():
            where = hadoop.Path(file)
            status = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where)
            found.append((file, status.getLen(), status.getModificationTime()))
    return f"{crc32(repr(sorted(found)).encode()):08x}"


def kept_folder(spark: SparkSession, sf: str, label: str, write: Callable[[str], object]) -> str:
    """A folder that many queries start from: written once for a state of its source files, then found in the shared folder."""
    settled = crc32(repr((OPTIONS, KEPT_FORMAT)).encode())
    path = os.path.join(shared_dir(spark), "plumeworks-kept", f"{label}-{_source_key(spark, sf, _FEED_NAMES)}-{settled:08x}")
    if not is_there(spark, path):
        publish(spark, path, write)
    return path


def _kept(spark: SparkSession, sf: str, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    return spark.read.parquet(kept_folder(spark, sf, label, lambda to: make().write.parquet(to)))


def master_table(spark: SparkSession, sf: str) -> DataFrame:
    """The integrated table."""
    return _kept(spark, sf, "master", lambda: master_features(feeds(spark, sf), OPTIONS))


def ready_table(spark: SparkSession, sf: str) -> DataFrame:
    """Model-ready rows with their ``split``."""
    return _kept(spark, sf, "ready", lambda: model_ready(master_table(spark, sf), OPTIONS))
