"""Delimited feeds: sensor, station weather, zipped reanalysis, fire points.

Everything is read as text (no inference pass), names are cleaned, and the
roll-ups cast what they need.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import csv as pa_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.coerce import MISSING_TOKENS, day_in, fire_moment, is_text, missing_to_null, number_in, parse_once
from ..functions.names import clean_columns, clean_name, clean_names, first_existing, require_columns
from ..session import materialise
from .files import header_groups, layouts, list_files, open_input, zip_members

FIRE_COLUMNS = ["latitude", "longitude", "acq_date", "acq_time", "frp"]
_CHUNK_ROWS = 50_000
#: Unpacked bytes that are parsed at a time.
ZIP_BLOCK = 4 << 20


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Row concatenation with the union of the columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _text_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _blank_missing(df: DataFrame) -> DataFrame:
    return df.select(*[missing_to_null(f"`{c}`").alias(c) for c in df.columns])


def _read_layout(spark: SparkSession, paths: str | list[str], header: list[str], multi_line: bool, pattern: str = "*") -> DataFrame:
    # files that turn out to have other columns fail here instead of being read by position
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').option("multiLine", multi_line)
    reader = reader.option("pathGlobFilter", pattern)
    return clean_columns(reader.schema(_text_schema(header)).csv(paths))


def scan_csv(
    spark: SparkSession, paths: str | list[str], header: list[str] | None = None, pattern: str = "*", multi_line: bool = False
) -> DataFrame:
    """CSV with a header as cleaned text columns, matched **by name**.

    The first line of every file is looked at; a folder with one layout is one scan, else there is a
    scan for each layout. A known ``header`` saves that look, and files that differ from it fail.
    ``multi_line`` reads line breaks inside quotes; such files are not split.
    """
    if header is not None:
        return _blank_missing(_read_layout(spark, paths, header, multi_line))
    groups = header_groups(list_files(spark, paths, pattern))
    if not groups:
        raise FileNotFoundError(f"{paths} holds nothing that matches {pattern}")
    return _blank_missing(union_all([_read_layout(spark, found or paths, layout, multi_line, pattern) for layout, found in groups]))


def scan_weather_dir(spark: SparkSession, directory: str, pattern: str = "weather_*.csv") -> DataFrame:
    """All matching files, columns matched by name."""
    return scan_csv(spark, directory, pattern=pattern)


def _members_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The CSV members of archives, from their directories alone."""
    for batch in batches:
        for path in batch["path"]:
            with open_input(path) as stream, zipfile.ZipFile(stream) as archive:
                yield pd.DataFrame({"path": path, "member": zip_members(archive)}, dtype=str)


def _record_end(data: bytes, after: int = 0) -> int:
    """Where the last whole record of ``data`` ends (0 if none does): a line break that is not inside quotes."""
    marks = np.frombuffer(data, dtype=np.uint8)
    breaks = np.flatnonzero(marks == 10)
    outside = breaks[np.searchsorted(np.flatnonzero(marks == 34), breaks) % 2 == 0]
    outside = outside[outside >= after]
    return int(outside[-1]) + 1 if len(outside) else 0


def _member_blocks(path: str, member: str, block_bytes: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(number, header, records) of a member, unpacked as a stream; blocks end where records do."""
    with open_input(path) as stream, zipfile.ZipFile(stream) as archive, archive.open(member) as body:
        header, held, number = b"", b"", 0
        for data in iter(lambda: body.read(block_bytes), b""):
            held += data
            if not header:
                first = next((i + 1 for i, c in enumerate(held) if c == 10 and held.count(b'"', 0, i) % 2 == 0), 0)
                if not first:
                    continue
                header, held = held[:first], held[first:]
            end = _record_end(held)
            if end:
                yield number, header, held[:end]
                held, number = held[end:], number + 1
        if held:
            yield (number, header, held) if header else (number, held, b"")


def _parse_block(header: bytes, records: bytes, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a block; only the wanted columns are parsed."""
    wanted, data, schema = set(columns), header + records, pa.schema([(c, pa.string()) for c in columns])
    names = next(csv.reader(io.StringIO(header.decode("utf-8-sig"), newline="")), [])
    cleaned = {clean_name(n): n for n in names}
    if records and len(names) > 1 and len(cleaned) == len(names) and all(names):
        found = [c for c in columns if c in cleaned]
        try:
            table = pa_csv.read_csv(
                pa.py_buffer(data), pa_csv.ReadOptions(use_threads=False, block_size=len(data) + 1), pa_csv.ParseOptions(newlines_in_values=True),
                pa_csv.ConvertOptions(
                    include_columns=[cleaned[c] for c in found], column_types={cleaned[c]: pa.string() for c in found},
                    null_values=MISSING_TOKENS, strings_can_be_null=True,
                ),
            )
            rows = dict(zip(found, table.columns)) if found else None
        except pa.ArrowInvalid:  # lines of unequal length and the like are for the more tolerant reader
            rows = None
        if rows is not None:
            whole = pa.table([rows.get(c, pa.nulls(table.num_rows, pa.string())) for c in columns], schema=schema)
            yield from whole.to_batches(max_chunksize=_CHUNK_ROWS)
            return
    for chunk in pd.read_csv(io.BytesIO(data), dtype=str, chunksize=_CHUNK_ROWS, usecols=lambda c: clean_name(c) in wanted):
        chunk.columns = [clean_name(c) for c in chunk.columns]
        yield pa.RecordBatch.from_pandas(chunk.reindex(columns=columns).astype(object), schema, preserve_index=False)


def _unpack_and_parse(columns: list[str], block_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, member in zip(batch.column("path").to_pylist(), batch.column("member").to_pylist()):
                for _, header, records in _member_blocks(path, member, block_bytes):
                    yield from _parse_block(header, records, columns)

    return rows


def _unpack(block_bytes: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, member in zip(batch.column("path").to_pylist(), batch.column("member").to_pylist()):
                for number, header, records in _member_blocks(path, member, block_bytes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path]), pa.array([member]), pa.array([number], pa.int32()), pa.array([header], pa.binary()), pa.array([records], pa.binary())],
                        ["path", "member", "number", "header", "records"],
                    )

    return blocks


def _parse(columns: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for header, records in zip(batch.column("header"), batch.column("records")):
                yield from _parse_block(header.as_py(), records.as_py(), columns)

    return rows


def scan_zip_csv(
    spark: SparkSession, paths: str | list[str], columns: list[str] | None = None, pattern: str = "*", block_bytes: int = ZIP_BLOCK
) -> DataFrame:
    """CSV inside zip archives (which may be named ``.csv``) as cleaned text columns.

    Members are unpacked in parallel, as streams. With at least as many members as tasks, each task parses what it unpacks;
    with fewer, unpacked text is dealt out in blocks of whole records, so one archive, even one member, is parsed by all
    tasks (unpacking a member itself can't be divided). A task holds one block and never a whole archive. ``columns``
    are the only ones parsed.
    """
    files = list_files(spark, paths, pattern)
    if columns is None:
        names = {clean_name(c) for header in layouts(files) for c in header}
        if not names:
            raise FileNotFoundError(f"no archives in {paths}")
        columns = sorted(names)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    members = materialise(files.mapInPandas(_members_of, "path string, member string"), "zip-members")
    dealt = members.repartition(tasks, "path", "member")
    if members.count() >= tasks:
        return dealt.mapInArrow(_unpack_and_parse(columns, block_bytes), _text_schema(columns))
    blocks = dealt.mapInArrow(_unpack(block_bytes), "path string, member string, number int, header binary, records binary")
    return blocks.repartition(tasks, "path", "member", "number").mapInArrow(_parse(columns), _text_schema(columns))


def scan_fire_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    df = scan_csv(spark, paths)
    require_columns(df, FIRE_COLUMNS, "fire table")
    return df


def _plain_number(df: DataFrame, name: str):
    """A typed coordinate. A double stays itself (a NaN fails every later range test), so that filters reach the scan."""
    return F.col(name) if dict(df.dtypes)[name] == "double" else number_in(df, name).alias(name)


def parse_fire_points(raw: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Typed fire points; rows without position or day are dropped, rows without FRP stay."""
    require_columns(raw, FIRE_COLUMNS, "fire table")
    columns = [
        *[F.col(k) for k in keys],
        *[number_in(raw, c).alias(c) for c in ("latitude", "longitude", "frp")],
        fire_moment(raw).alias("datetime"),
    ]
    if any(is_text(raw, c) for c in ("latitude", "longitude", "acq_date")):
        typed = parse_once(raw, columns).withColumn("date", F.to_date("datetime"))
        return typed.dropna(subset=["latitude", "longitude", "date"])
    # typed: the position and the day are plain columns, so filters on them reach the scan
    day = F.to_date("acq_date")
    moment = fire_moment(raw)
    typed = raw.select(*[F.col(k) for k in keys], *[_plain_number(raw, c) for c in ("latitude", "longitude")], number_in(raw, "frp").alias("frp"), moment.alias("datetime"), day.alias("date"))
    return typed.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("date").isNotNull() & F.col("datetime").isNotNull())


def read_events(raw: DataFrame) -> DataFrame:
    """Event table with its ``date`` text parsed."""
    return raw.withColumn("date", day_in(raw, first_existing(raw, ["date"])))
