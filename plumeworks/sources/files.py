"""Small per-file probes that run in tasks: what is the header of each landed file?

Only the first line of each file is read. The file listing comes from Spark's
binary-file source with the content column pruned away.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the first bytes of a zip archive.
_ZIP_MAGIC = b"PK\x03\x04"


def list_files(spark: SparkSession, paths: str | list[str], pattern: str) -> DataFrame:
    """One row per file: ``path``. The files are not opened."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(paths)
        .select("path")
    )


def open_input(path: str):
    """A seekable stream on any file system Arrow knows (local, HDFS, object stores)."""
    uri = path if "://" in path else path.replace("file:", "", 1)
    filesystem, inner = fs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(inner)


def zip_members(archive: zipfile.ZipFile) -> list[str]:
    return sorted(n for n in archive.namelist() if n.lower().endswith(".csv"))


def _columns(line: bytes) -> list[str]:
    return next(csv.reader([line.decode("utf-8-sig").rstrip("\r\n")]), [])


def _first_line(path: str) -> list[str]:
    """The header of a file; of an archive the columns of all its members, each once."""
    with open_input(path) as stream:
        zipped = stream.read(4) == _ZIP_MAGIC
        stream.seek(0)
        if not zipped:
            return _columns(io.BufferedReader(stream).readline())
        found: dict[str, None] = {}
        with zipfile.ZipFile(stream) as archive:
            members = zip_members(archive)
            if not members:
                raise ValueError(f"no CSV inside {path}")
            for member in members:
                with archive.open(member) as body:
                    found |= dict.fromkeys(_columns(body.readline()))
        return list(found)


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "header": [_first_line(p) for p in batch["path"]]})


def file_headers(files: DataFrame) -> DataFrame:
    """``path, header`` for every listed file (plain CSV, or a zip holding one)."""
    return files.mapInPandas(_headers, "path string, header array<string>")


def layouts(files: DataFrame) -> list[list[str]]:
    """The distinct headers, in the order of the first path that has each. Their number is that of layouts, not of files."""
    return [list(r["header"]) for r in file_headers(files).groupBy("header").agg(F.min("path").alias("path")).orderBy("path").collect()]


def header_groups(files: DataFrame) -> list[tuple[list[str], list[str]]]:
    """Files by identical header: ``[(header, [paths])]``, in path order.

    With one layout the list of paths is left empty: the caller reads the folder. Only with
    several do paths come to the driver, row by row and not gathered in one group.
    """
    found = layouts(files)
    if len(found) < 2:
        return [(header, []) for header in found]
    paths: dict[tuple[str, ...], list[str]] = {tuple(h): [] for h in found}
    for r in file_headers(files).orderBy("path").toLocalIterator():
        paths[tuple(r["header"])].append(r["path"])
    return [(list(h), p) for h, p in paths.items()]
