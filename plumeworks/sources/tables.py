"""Writers and readers for result tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, MapType, StructType

SPLITS = ("train", "val", "test")


def counts_to_double(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Whole-number feature columns as doubles, the type they have in the exchanged tables."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, (LongType, IntegerType)) and f.name not in keep
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (), mode: str = "overwrite"
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        flat = [f.name for f in df.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
        writer = df.select(*flat).write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_locations(locations: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Locations without the sensor array when the format is flat."""
    write_table(locations.drop("sensors") if fmt == "csv" else locations, path, fmt)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def reload_splits(spark: SparkSession, root: str, scaled: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test as written by the pipeline (one table, a ``split`` column)."""
    name = "model_ready_scaled" if scaled else "model_ready"
    table = read_table(spark, os.path.join(root, name))
    parts = [table.filter(F.col("split") == s).drop("split") for s in SPLITS]
    return parts[0], parts[1], parts[2]


def _files(spark: SparkSession, path: str):
    """The file system of a path and the path for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def is_there(spark: SparkSession, path: str) -> bool:
    fs, where = _files(spark, path)
    return fs.exists(where)


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write`` to a folder of its own, which then becomes ``path`` by a rename: readers see all of it or nothing.

    What is there already stays: of two writers of the same thing, the first one counts.
    """
    made = f"{path}.{uuid.uuid4().hex}.part"
    write(made)
    fs, target = _files(spark, path)
    if fs.exists(target) or not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(made), target):
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(made), True)


class VersionedTable:
    """A small table that is replaced as a whole, such as a leaderboard.

    Each version is a folder of its own; a commit file, numbered one up and put in place by a rename that fails if the number
    is taken, names it. A reader follows the last commit, so it never sees half a table, and a driver lost at any point leaves
    the table as it was. A writer that finds its number taken starts again from what the other one wrote. Old versions stay for
    those who still read them.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _commits(self) -> list[int]:
        fs, where = _files(self.spark, f"{self.path}/commits")
        if not fs.exists(where):
            return []
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(where) if f.getPath().getName().isdigit())

    def _version(self, number: int) -> DataFrame:
        name = self.spark.read.text(f"{self.path}/commits/{number:08d}").first()["value"]
        return self.spark.read.parquet(f"{self.path}/versions/{name}")

    def read(self) -> DataFrame | None:
        commits = self._commits()
        return self._version(commits[-1]) if commits else None

    def _commit(self, number: int, name: str) -> bool:
        """Whether the number was free and now names the version."""
        jvm = self.spark._jvm
        fs, folder = _files(self.spark, f"{self.path}/commits")
        fs.mkdirs(folder)
        # dots and underscores hide a file from readers
        made = jvm.org.apache.hadoop.fs.Path(folder, f"_{uuid.uuid4().hex}")
        out = fs.create(made, False)
        out.write(bytearray(name.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(made), context.makeQualified(jvm.org.apache.hadoop.fs.Path(folder, f"{number:08d}")), none)
        except Py4JJavaError as e:
            fs.delete(made, False)
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False
        return True

    def update(self, change: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
        """Replace the table by ``change`` of what is there (None at first)."""
        while True:
            commits = self._commits()
            name = uuid.uuid4().hex
            change(self._version(commits[-1]) if commits else None).write.parquet(f"{self.path}/versions/{name}")
            number = commits[-1] + 1 if commits else 1
            if self._commit(number, name):
                return self._version(number)


def update_table(spark: SparkSession, path: str, change: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
    """Replace the table at ``path`` by ``change`` of what is there (None at first); see :class:`VersionedTable`."""
    return VersionedTable(spark, path).update(change)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
