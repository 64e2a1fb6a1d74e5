"""One large JSON document read by many tasks: a feature collection, or a list of objects.

The file is cut into byte ranges. A first pass tells, for each way a range may begin (outside a string, inside one, after a
backslash), how it ends and by how much the nesting changes; composing these few numbers along a file gives the true beginning of
every range. A second pass then takes from each range the objects that begin in it, reading on past its end to finish the last.
No task holds more than its range and one object.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .files import open_input

#: Bytes of a range, and the size from which a document is worth it.
RANGE_BYTES, SPLIT_BYTES = 16 << 20, 128 << 20
#: How far back a key may begin before the bracket that it names.
KEY_BYTES = 4096
_MARK = re.compile(rb'[\\"{}\[\]]')
_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$')
#: How a range may begin.
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2


def _transition(data: bytes, state: int) -> tuple[int, int]:
    """State at the end and change of nesting, for a range that begins in ``state``."""
    depth, skip = 0, 0 if state == ESCAPED else -1  # the place of an escaped byte
    inside = state != OUTSIDE
    for m in _MARK.finditer(data):
        at, mark = m.start(), data[m.start()]
        if at == skip:
            continue
        if inside:
            if mark == 92:
                skip = at + 1
            elif mark == 34:
                inside = False
        elif mark == 34:
            inside = True
        elif mark in b"{[":
            depth += 1
        elif mark in b"}]":
            depth -= 1
    return (ESCAPED if skip == len(data) else INSIDE) if inside else OUTSIDE, depth


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, number, offset, size in batch.itertuples(index=False):
            with open_input(path) as stream:
                data = stream.read_at(size, offset)
            ends = [_transition(data, s) for s in (OUTSIDE, INSIDE, ESCAPED)]
            yield pd.DataFrame([(path, number, offset, size, [e for e, _ in ends], [d for _, d in ends], data.lstrip(b"\xef\xbb\xbf \t\r\n")[:1] == b"[")],
                               columns=["path", "number", "offset", "size", "ends", "change", "list"])


def _compose(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state and nesting at the begin of each range of one file: a few numbers for every ``RANGE_BYTES``."""
    ranges = ranges.sort_values("number")
    state, depth, begins = OUTSIDE, 0, []
    for ends, change in zip(ranges["ends"], ranges["change"]):
        begins.append((state, depth))
        state, depth = ends[state], depth + change[state]
    ranges["state"], ranges["depth"] = [s for s, _ in begins], [d for _, d in begins]
    ranges["list"] = bool(ranges["list"].iloc[0])
    return ranges[["path", "number", "offset", "size", "state", "depth", "list"]]


def _objects(path: str, offset: int, size: int, state: int, depth: int, is_list: bool) -> Iterator[tuple[int, str, str]]:
    """(place, kind, text) of what begins in a range: objects of the list or of top-level arrays, and what opens these arrays."""
    level = 1 if is_list else 2
    with open_input(path) as stream:
        at, end = offset, offset + size
        inside, skip = state != OUTSIDE, offset if state == ESCAPED else -1
        begun, parts = -1, []
        while True:
            data = stream.read_at(min(RANGE_BYTES, size) if at >= end else end - at, at)
            if not data:
                return
            taken = 0  # where the part of an open object begins in ``data``
            for m in _MARK.finditer(data):
                place, mark = at + m.start(), data[m.start()]
                if place == skip:
                    continue
                if inside:
                    if mark == 92:
                        skip = place + 1
                    elif mark == 34:
                        inside = False
                elif mark == 34:
                    inside = True
                elif mark in b"{[":
                    if begun < 0 and place >= end:
                        return
                    if begun < 0 and depth == level and mark == 123:
                        begun, taken, parts = place, m.start(), []
                    elif begun < 0 and depth == 1 and not is_list:
                        back = max(0, place - KEY_BYTES)
                        key = _KEY.search(stream.read_at(place - back, back))
                        yield place, "open", key.group(1).decode() if key and mark == 91 else ""
                    depth += 1
                elif mark in b"}]":
                    depth -= 1
                    if begun >= 0 and depth == level:
                        yield begun, "object", b"".join([*parts, data[taken : m.start() + 1]]).decode()
                        begun = -1
                        if place + 1 >= end:
                            return
            if begun >= 0:
                parts.append(data[taken:])
            at += len(data)
            if at >= end and begun < 0:
                return


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, _, offset, size, state, depth, is_list in batch.itertuples(index=False):
            held, n = [], 0
            for row in _objects(path, offset, size, state, depth, is_list):
                held.append((path, *row))
                n += len(row[2])
                if n > 1 << 22:
                    yield pd.DataFrame(held, columns=["path", "place", "kind", "text"])
                    held, n = [], 0
            if held:
                yield pd.DataFrame(held, columns=["path", "place", "kind", "text"])


def document_objects(spark: SparkSession, paths: str | list[str], array: str = "features", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, place, text: every object of the named top-level array, or of a list document, as its own JSON text."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = files.where("length > 0").select("path", "length", F.posexplode(starts).alias("number", "offset"))
    ranges = ranges.select("path", F.col("number").cast("long").alias("number"), "offset", F.least(F.lit(range_bytes).cast("long"), F.col("length") - F.col("offset")).alias("size"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    scanned = ranges.repartition(tasks, "path", "number").mapInPandas(_scan, "path string, number long, offset long, size long, ends array<int>, change array<long>, list boolean")
    placed = scanned.groupBy("path").applyInPandas(_compose, "path string, number long, offset long, size long, state int, depth long, list boolean")
    found = placed.repartition(tasks, "path", "number").mapInPandas(_extract, "path string, place long, kind string, text string")
    # the brackets that open top-level arrays: a few for each file
    opens = found.where("kind = 'open'").groupBy("path").agg(F.collect_list(F.struct("place", "text")).alias("opens"))
    objects = found.where("kind = 'object'").select("path", "place", "text").join(opens, "path", "left")
    around = F.array_max(F.filter("opens", lambda o: o["place"] < F.col("place")))
    return objects.where(F.col("opens").isNull() | (around["text"] == array)).select("path", "place", "text")


def read_objects(objects: DataFrame, schema: StructType | None = None) -> DataFrame:
    """JSON texts, one object each, as rows; the schema is inferred over all of them if none is given."""
    spark = objects.sparkSession
    texts = getattr(objects.select("text")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark._jsparkSession.read()
    if schema is not None:
        reader = reader.schema(spark._jsparkSession.parseDataType(schema.json()))
    return DataFrame(reader.json(texts), spark)


def element_schema(schema: StructType | None, array: str = "features") -> StructType | None:
    """What the schema of a document says about the elements of an array."""
    if schema is None:
        return None
    fields = {f.name: f.dataType for f in schema.fields}
    kind = fields.get(array)
    return kind.elementType if isinstance(kind, ArrayType) else schema


def has_large(spark: SparkSession, paths: str | list[str], split_bytes: int) -> bool:
    return not spark.read.format("binaryFile").load(paths).select("length").where(F.col("length") > split_bytes).isEmpty()
