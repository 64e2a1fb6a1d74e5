"""Shape the supplied tables into the feeds. One text per column serves Spark and the SQL check."""

from __future__ import annotations

import contextlib
import functools
import gzip
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import csv as pa_csv
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import with_scalars
from ..session import materialise, new_path

START, END = "1995-01-01", "2001-12-31"

_DAY = "CAST(CAST({0} AS DATE) AS STRING)"
_HOUR = f"concat({_DAY.format('l_shipdate')}, ' ', lpad(CAST((l_linenumber*3)%24 AS STRING),2,'0'), ':00')"
_HAZE_SHIP = "month(l_shipdate)=7 AND day(l_shipdate) BETWEEN 10 AND 24"

FEEDS: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "fx_pm25": ("orders", None, {
        "date": _DAY.format("o_orderdate"),
        "value": "CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(o_totalprice/5e4 + CASE WHEN "
                 "month(o_orderdate)=7 AND day(o_orderdate) BETWEEN 10 AND 24 THEN 4e1 ELSE 0e0 END AS STRING) END",
        "location_name": "concat('st', CAST(o_custkey % 5 AS STRING))",
    }),
    "fx_weather": ("lineitem", None, {
        "date_time_lst": _HOUR,
        "temp_c": "l_quantity-2e1",
        "dew_point_temp_c": "l_quantity/2e0-1.5e1",
        "rel_hum": "l_discount*1e3",
        "precip_amount_mm": "CASE WHEN year(l_shipdate)=1999 THEN NULL ELSE l_tax*1e2 END",
        "wind_spd_km_h": "l_tax*5e2",
        "stn_press_kpa": "8.8e1+l_discount*1e1",
        "visibility_km": f"CASE WHEN {_HAZE_SHIP} THEN l_quantity/1e1 ELSE l_quantity END",
    }),
    # no wind on the 29th of a month
    "fx_era5": ("lineitem", None, {
        "valid_time": _HOUR,
        "u10": "CASE WHEN day(l_shipdate) <> 29 THEN (l_quantity-2.5e1)/5e0 END",
        "v10": "CASE WHEN day(l_shipdate) <> 29 THEN (l_discount-5e-2)*1e2 END",
        "t2m": "2.7315e2+l_quantity-2e1",
        "d2m": "2.7315e2+l_quantity/2e0-1.5e1",
        "sp": "8.8e4+l_linenumber*1e2",
    }),
    "fx_fire": ("lineitem", None, {
        "latitude": "4.7e1+(l_partkey%800)/1e2",
        "longitude": "-1.2e2+((l_suppkey*37)%120)/1e1",
        "acq_date": _DAY.format("l_shipdate"),
        "acq_time": "CAST(l_orderkey % 2400 AS STRING)",
        "frp": "CASE WHEN l_returnflag='R' AND l_linenumber=1 THEN NULL ELSE l_extendedprice/1e3 END",
    }),
    "fx_scores": ("events", None, {
        "event_id": "event_id",
        "date": "CAST(ts AS DATE)",
        "y": "CASE WHEN event_type='purchase' THEN 1 ELSE 0 END",
        "prob": "CASE WHEN value/1e2 > 1e0 THEN 1e0 ELSE value/1e2 END",
        "fold": "event_id % 5",
        "model": "concat('m', CAST(user_id % 3 AS STRING))",
    }),
    # 25 sites; a feed per site for the many-site forms
    "fx_sites": ("nation", None, {
        "site_id": "CAST(n_nationkey AS BIGINT)",
        "site_lat": "4.5e1+(n_nationkey%5)*2e0",
        # on the fires' meridians: bearings of exactly 0 meet winds of exactly 45 degrees
        "site_lon": "-1.22e2+(n_nationkey%7)*2.5e0",
    }),
    "fx_site_era5": ("lineitem", None, {
        "site_id": "l_suppkey % 25",
        "valid_time": _HOUR,
        "u10": "CASE WHEN day(l_shipdate) <> 29 THEN (l_quantity-2.5e1)/5e0 END",
        "v10": "CASE WHEN day(l_shipdate) <> 29 THEN (l_discount-5e-2)*1e2 END",
    }),
    "fx_site_pm25": ("orders", None, {
        "site_id": "o_custkey % 25",
        "date": _DAY.format("o_orderdate"),
        "value": "CAST(o_totalprice/5e4 AS STRING)",
    }),
    # one angle pair and one coordinate pair per row
    "fx_angles": ("lineitem", None, {
        "id": "l_orderkey*10+l_linenumber",
        "a": "CAST((l_orderkey*7)%720-360 AS DOUBLE)",
        "b": "CAST((l_partkey*11)%720-360 AS DOUBLE)",
        "lat": "(l_suppkey*13)%170-8.5e1",
        "lon": "(l_partkey*29)%360-1.8e2",
        "u": "(l_quantity-2.5e1)/5e0",
        "v": "(l_discount-5e-2)*1e2",
    }),
    # dirty texts
    "fx_texts": ("orders", None, {
        "id": "o_orderkey",
        "num": "CASE WHEN o_orderkey%7=0 THEN 'n/a' WHEN o_orderkey%7=1 THEN '1d' WHEN o_orderkey%7=2 THEN '' "
               "WHEN o_orderkey%7=3 THEN concat(' ', CAST(o_totalprice AS STRING), ' ') "
               "WHEN o_orderkey%7=4 THEN '1.5e3' ELSE CAST(o_totalprice AS STRING) END",
        "day": f"CASE WHEN o_orderkey%5=0 THEN 'unknown' WHEN o_orderkey%5=1 THEN '2024-13-45' "
               f"WHEN o_orderkey%5=2 THEN concat({_DAY.format('o_orderdate')}, ' 23:59') ELSE {_DAY.format('o_orderdate')} END",
        "local": f"CASE WHEN o_orderkey%11=0 THEN 'bad' ELSE concat({_DAY.format('o_orderdate')}, 'T', "
                 "lpad(CAST(o_orderkey%24 AS STRING),2,'0'), ':30:00-0', CAST(o_orderkey%8 AS STRING), ':00') END",
    }),
}


def feed_sql(name: str) -> str:
    table, where, columns = FEEDS[name]
    body = ", ".join(f"{text} AS {c}" for c, text in columns.items())
    return f"SELECT {body} FROM {table}" + (f" WHERE {where}" if where else "")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def feed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source, where, columns = FEEDS[name]
    df = table(spark, sf, source)
    if where:
        df = df.filter(where)
    return df.selectExpr(*[f"{text} AS {c}" for c, text in columns.items()])


# --- landed files written from the tables, so the readers have something to read ---

#: Landed folders to use again, by what was landed; None (the default) lands anew for each query.
LANDED: dict[tuple, str] | None = None


def _lands(write: Callable[..., str]) -> Callable[..., str]:
    @functools.wraps(write)
    def land(first, second, *rest, **options) -> str:
        slot = (write.__name__, first.semanticHash() if isinstance(first, DataFrame) else second, str(second), str(options))
        if LANDED is None:
            return write(first, second, *rest, **options)
        if slot not in LANDED:
            LANDED[slot] = write(first, second, *rest, **options)
        return LANDED[slot]

    return land


@_lands
def land_csv(df: DataFrame, label: str) -> str:
    path = new_path(df.sparkSession, label)
    df.write.option("header", True).csv(path)
    return path


@_lands
def land_weather_drift(spark: SparkSession, sf: str) -> str:
    """Two header layouts in one folder: odd years lack visibility and order columns differently."""
    feed_df = feed(spark, sf, "fx_weather")
    odd = F.substring("date_time_lst", 1, 4).cast("int") % 2 == 1
    path = new_path(spark, "weather")
    feed_df.filter(~odd).write.option("header", True).csv(path)
    other = ["rel_hum", "date_time_lst", "temp_c", "precip_amount_mm"]
    feed_df.filter(odd).select(*other).write.mode("append").option("header", True).csv(path)
    return path


@_lands
def land_fire_drift(spark: SparkSession, sf: str) -> str:
    """Two layouts of the fire feed in one folder: the same columns in another order, and one more."""
    rows = feed(spark, sf, "fx_fire")
    odd = F.col("acq_time").cast("int") % 2 == 1
    path = new_path(spark, "fire")
    rows.filter(~odd).write.option("header", True).csv(path)
    other = [F.lit("x").alias("satellite"), *reversed(rows.columns)]
    rows.filter(odd).select(*other).write.mode("append").option("header", True).csv(path)
    return path


@_lands
def land_weather_years(spark: SparkSession, sf: str) -> str:
    """One folder per year; odd years are error pages without coordinates."""
    feed_df = feed(spark, sf, "fx_weather").withColumn("yr", F.substring("date_time_lst", 1, 4).cast("int"))
    line = F.concat_ws(",", "date_time_lst", F.col("temp_c").cast("string"))
    good = feed_df.filter("yr % 2 = 0").select("yr", F.concat(F.lit("Longitude (x)=-114.0,"), line).alias("value"))
    bad = feed_df.filter("yr % 2 = 1").select("yr", line.alias("value"))
    path = new_path(spark, "landing")
    good.unionByName(bad).write.partitionBy("yr").text(path)
    return path


def _csv_text(batch: pa.RecordBatch, names: list[str]) -> bytes:
    sink = pa.BufferOutputStream()
    pa_csv.write_csv(batch.select(names), sink, pa_csv.WriteOptions(include_header=False))
    return sink.getvalue().to_pybytes()


def _make_folder(path: str) -> tuple[fs.FileSystem, str]:
    filesystem, inner = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "", 1))
    filesystem.create_dir(inner, recursive=True)
    return filesystem, inner


def _write_members(sink, batches: Iterator[pa.RecordBatch], parts: list[list[str]]) -> int:
    """One zip with a CSV for each list of columns; how many rows. Rows stream through and are not held: the first member
    goes to the archive, the others wait as packed text in a temp folder."""
    rows = 0
    with contextlib.ExitStack() as open_files:
        archive = open_files.enter_context(zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED))
        waiting = [open_files.enter_context(tempfile.TemporaryFile()) for _ in parts[1:]]
        with contextlib.ExitStack() as writers:
            bodies = [writers.enter_context(archive.open("data0.csv", "w", force_zip64=True))]
            bodies += [writers.enter_context(gzip.GzipFile(fileobj=f, mode="wb", compresslevel=1)) for f in waiting]
            for body, names in zip(bodies, parts):
                body.write((",".join(names) + "\n").encode())
            for batch in batches:
                rows += batch.num_rows
                for body, names in zip(bodies, parts):
                    body.write(_csv_text(batch, names))
        for number, file in enumerate(waiting, start=1):
            file.seek(0)
            with gzip.GzipFile(fileobj=file) as text, archive.open(f"data{number}.csv", "w", force_zip64=True) as body:
                shutil.copyfileobj(text, body, 1 << 20)
    return rows


@_lands
def land_zip(df: DataFrame, label: str, members: tuple[tuple[str, ...], ...] = ()) -> str:
    """Each task writes its rows into one zip that is named ``.csv``: one CSV, or one for each list of columns."""
    path = new_path(df.sparkSession, label)
    parts = [list(m) for m in members] or [df.columns]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = _make_folder(path)
        with filesystem.open_output_stream(f"{inner}/part-{TaskContext.get().partitionId():05d}.csv") as sink:
            rows = _write_members(sink, batches, parts)
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64())})

    df.mapInArrow(write, "rows bigint").agg(F.sum("rows")).collect()
    return path


@_lands
def land_zip_single(df: DataFrame, label: str) -> str:
    """All rows in one zip with one CSV. Its tasks turn rows into packed text, one task streams the texts into the archive."""
    path = new_path(df.sparkSession, label)
    texts, names = f"{path}-texts", df.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = _make_folder(texts)
        # a task that is tried again has a name of its own, only the one that ended is listed
        name = f"{inner}/{uuid.uuid4().hex}.gz"
        with filesystem.open_output_stream(name, compression=None) as sink, gzip.GzipFile(fileobj=sink, mode="wb", compresslevel=1) as body:
            for batch in batches:
                body.write(_csv_text(batch, names))
        yield pa.RecordBatch.from_pydict({"name": [name]})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = _make_folder(path)
        with filesystem.open_output_stream(f"{inner}/part-00000.csv") as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
            with archive.open("data0.csv", "w", force_zip64=True) as body:
                body.write((",".join(names) + "\n").encode())
                for batch in batches:
                    for name in batch.column("name").to_pylist():
                        with filesystem.open_input_stream(name, compression=None) as packed, gzip.GzipFile(fileobj=packed) as text:
                            shutil.copyfileobj(text, body, 1 << 20)
        yield pa.RecordBatch.from_pydict({"rows": pa.array([0], pa.int64())})

    # the names are written, so that the archive is not begun before every text is whole
    written = materialise(df.mapInArrow(pack, "name string"), f"{label}-names")
    written.repartition(1).mapInArrow(join, "rows bigint").collect()
    return path


def location_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One location per four suppliers, up to fifty locations per page."""
    s = table(spark, sf, "supplier")
    loc = F.floor(F.col("s_suppkey") / 4)
    key = F.col("s_suppkey")
    start = F.when(key % 7 != 0, F.concat(F.date_add(F.lit("2016-01-01").cast("date"), (key % 900).cast("int")).cast("string"), F.lit("T00:00:00Z")))
    stop = F.when(key % 5 != 0, F.concat(F.date_add(F.lit("2024-01-01").cast("date"), (key % 400).cast("int")).cast("string"), F.lit("T00:00:00Z")))
    sensor = F.struct(
        key.alias("id"),
        F.struct((key % 3).alias("id"), F.concat(F.lit("p"), (key % 3).cast("string")).alias("name"), F.lit("ug/m3").alias("units")).alias("parameter"),
        F.struct(start.alias("utc")).alias("datetimeFirst"),
        F.struct(stop.alias("utc")).alias("datetimeLast"),
    )
    locations = s.groupBy(loc.alias("id")).agg(F.sort_array(F.collect_list(sensor)).alias("sensors")).select(
        F.struct(
            "id",
            F.concat(F.lit("loc"), F.col("id").cast("string")).alias("name"),
            F.when(F.col("id") % 3 != 0, F.struct(F.lit("prov").alias("name"))).alias("provider"),
            F.struct(F.lit("own").alias("name")).alias("owner"),
            F.struct((F.lit(50.8) + (F.col("id") % 40) / 80.0).alias("latitude"), (F.lit(-114.3) + (F.col("id") % 30) / 60.0).alias("longitude")).alias("coordinates"),
            (F.col("id") % 2 == 0).alias("isMobile"),
            F.struct(F.lit("2016-01-01T00:00:00Z").alias("utc")).alias("datetimeFirst"),
            F.when(F.col("id") % 4 != 0, F.struct(F.lit("2024-01-01T00:00:00Z").alias("utc"))).alias("datetimeLast"),
            "sensors",
        ).alias("r")
    )
    page = F.floor(F.col("r.id") / 50).cast("int")
    return locations.groupBy(page.alias("page")).agg(F.collect_list("r").alias("results")).select(F.struct("page").alias("meta"), "results")


def measurement_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One measurement per order, up to a thousand per page."""
    o = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    nxt = F.date_format(F.date_add(F.to_date("o_orderdate"), 1), "yyyy-MM-dd")
    key = F.col("o_orderkey")

    def moment(d):
        local = F.concat(d, F.lit("T00:00:00-0"), (key % 8).cast("string"), F.lit(":00"))
        return F.struct(F.concat(d, F.lit("T0"), (key % 8).cast("string"), F.lit(":00:00Z")).alias("utc"), local.alias("local"))

    item = F.struct(
        F.when(key % 97 != 0, F.col("o_totalprice")).alias("value"),
        F.when(key % 13 != 0, F.struct(F.lit("pm25").alias("name"), F.lit("ug/m3").alias("units"))).alias("parameter"),
        F.struct(moment(day).alias("datetimeFrom"), F.when(key % 17 != 0, moment(nxt)).alias("datetimeTo")).alias("period"),
    )
    page = F.floor(key / 1000).cast("int")
    return o.groupBy(page.alias("page")).agg(F.collect_list(item).alias("results")).select(F.struct("page").alias("meta"), "results")


def feature_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Feature collections of up to 500 customers each."""
    c = table(spark, sf, "customer")
    key = F.col("c_custkey")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.when(key % 10 != 0, F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))).alias("properties"),
        F.when(key % 4 != 0, F.struct(F.when(key % 2 == 0, "Polygon").otherwise("Point").alias("type"))).alias("geometry"),
    )
    doc = F.floor(key / 500)
    return c.groupBy(doc.alias("doc")).agg(F.collect_list(feature).alias("features")).select(F.lit("FeatureCollection").alias("type"), "features")


@_lands
def land_json(df: DataFrame, label: str) -> str:
    path = new_path(df.sparkSession, label)
    df.write.json(path)
    return path


@_lands
def land_one_document(df: DataFrame, label: str) -> str:
    """The features of all collections as one document in one file."""
    path = new_path(df.sparkSession, label)
    lines = df.select(F.to_json("features").alias("j")).selectExpr("1 AS part", "substring(j, 2, length(j) - 2) AS value")
    first = lines.agg(F.min("value").alias("first"))
    head = F.col("value") == F.col("_s.first")
    body = with_scalars(lines, first).select(F.when(head, 1).otherwise(2).alias("part"), F.concat(F.when(head, "").otherwise(","), "value").alias("value"))
    ends = df.sparkSession.createDataFrame([(0, '{"type": "FeatureCollection", "bbox": [1, 2], "features": ['), (3, "]}")], "part int, value string")
    body.unionByName(ends).coalesce(1).sortWithinPartitions("part", "value").select("value").write.text(path)
    return path
