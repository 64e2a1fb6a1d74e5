"""JSON-like documents and mixed file groups."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .big_json import RANGE_BYTES, SPLIT_BYTES, document_objects, element_schema, has_large, read_objects
from .feeds import scan_csv, scan_zip_csv, union_all


def _feature_rows(feature: DataFrame, inner) -> DataFrame:
    """Properties and ``geometry_type`` of features that stand in the column ``f``."""
    names = inner.fieldNames() if isinstance(inner, StructType) else []
    columns = []
    if "properties" in names and isinstance(inner["properties"].dataType, StructType):
        columns = [F.col(f"f.properties.`{p}`").alias(p) for p in inner["properties"].dataType.fieldNames()]
    has_geometry = "geometry" in names and isinstance(inner["geometry"].dataType, StructType)
    kind = F.col("f.geometry.type") if has_geometry else F.lit(None).cast("string")
    return feature.select(*columns, kind.alias("geometry_type"))


def scan_geojson(
    spark: SparkSession, paths: str | list[str], schema: StructType | None = None, multi_line: bool = True, split_bytes: int = SPLIT_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Feature collections to one row per feature: its properties and ``geometry_type``.

    Other JSON documents give one row each, a JSON list one row per element.
    ``multi_line=False`` reads one document per line and splits large files. Multi-line files are one document each; if one
    of them is larger than ``split_bytes``, all must be feature collections or lists, and each is read by many tasks.
    """
    if multi_line and has_large(spark, paths, split_bytes):
        rows = read_objects(document_objects(spark, paths, range_bytes=range_bytes), element_schema(schema))
        if "type" in rows.columns and "properties" in rows.columns:
            return _feature_rows(rows.select(F.struct(*rows.columns).alias("f")), rows.schema)
        return rows
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    doc = reader.json(paths)
    fields = {f.name: f.dataType for f in doc.schema.fields}
    if not isinstance(fields.get("features"), ArrayType):
        return doc
    feature = doc.filter("type = 'FeatureCollection'").select(F.explode("features").alias("f"))
    return _feature_rows(feature, fields["features"].elementType)


def scan_any(spark: SparkSession, path: str, zipped: bool = False) -> DataFrame:
    """Pick the reader by suffix: CSV (or a zip under a CSV name), JSON, GeoJSON."""
    readers = {".csv": scan_zip_csv if zipped else scan_csv, ".json": scan_geojson, ".geojson": scan_geojson}
    read = readers.get(PurePosixPath(path).suffix.lower())
    if read is None:
        raise ValueError(f"no reader for {path}; known endings are {', '.join(readers)}")
    return read(spark, path)


def _exists(spark: SparkSession, path: str):
    """Hadoop status of a path, or None; works on every file system Spark reads."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    filesystem = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return filesystem.getFileStatus(target) if filesystem.exists(target) else None


def scan_grouped(spark: SparkSession, targets: list[str], zipped: tuple[str, ...] = ()) -> DataFrame | None:
    """Union of files and directories of CSV files, columns in alphabetical order.

    Missing targets are skipped; None when nothing is there.
    """
    frames = []
    for target in targets:
        status = _exists(spark, target)
        if status is None:
            continue
        if status.isDirectory():
            frames.append(scan_csv(spark, target, pattern="*.csv"))
        else:
            frames.append(scan_any(spark, target, zipped=target in zipped))
    if not frames:
        return None
    df = union_all(frames)
    return df.select(*sorted(df.columns))


def validate_landing(
    spark: SparkSession, directory: str, pattern: str = "*", marker: str = "Longitude"
) -> tuple[DataFrame, DataFrame]:
    """Split landed files into accepted and rejected by whether the text contains ``marker``.

    Scanned line by line and combined per file, so large files are not held whole. Spark
    lists no empty files, so those are in neither part: never accepted, never read.
    """
    lines = (
        spark.read.option("pathGlobFilter", pattern)
        .text(directory)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").contains(marker).alias("hit"))
    )
    verdict = lines.groupBy("path").agg(F.bool_or("hit").alias("hit"))
    return verdict.filter("hit").select("path"), verdict.filter("NOT hit").select("path")
