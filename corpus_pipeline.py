"""The corpus pipeline: toxicity, near-duplicate, benchmark and secret stages over documents, then packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the columns
of ``documents``. Rows are judged by their own text, whatever their id: a row with an empty text is clean, has no near
duplicate, and is packed with length 0. Extra columns, whatever their names, travel along unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumeworks.llm import contain, jaccard, packing, secret_scan, toxicity
from plumeworks.operators.joins import counted_within, lookup_join
from plumeworks.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as toxic go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _keyed(docs: DataFrame, label: str) -> DataFrame:
    """key, row: a number for each row, so that rows with null or repeated ids are judged by their own text.

    Rows of a written table are numbered by their file and their place in it, which are the same whenever they are read; rows of
    anything else are written first.
    """
    row = F.struct(*docs.columns).alias("row")
    try:
        placed = docs.select(row, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    except AnalysisException:
        return materialise(docs.select(F.monotonically_increasing_id().alias("key"), row), label)
    if "_metadata" in docs.columns:
        return materialise(docs.select(F.monotonically_increasing_id().alias("key"), row), label)
    sizes = placed.groupBy("file").agg(F.max("at").alias("last"))  # a row for each file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    begins = materialise(sizes.select("file", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("begin")), label)
    files = lookup_join(placed, begins, ["file"], "inner", max_lookup_rows=0 if counted_within(begins) else None, salt_on=["at"])
    return files.select((F.col("begin") + F.col("at")).alias("key"), "row")


def _texts(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the smallest id stays; of rows without words, one per id and text."""
    keyed = _keyed(docs, "pipeline-rows")
    linked = jaccard.link(_texts(keyed)).withColumnRenamed("doc_id", "key")
    own = keyed.select("key", F.col("row.doc_id").cast("long").alias("id"), F.col("row.text").alias("text"))
    rows = linked.join(own, "key")
    blank = (F.col("n_shingles") == 0) & F.col("id").isNotNull()
    groups = rows.groupBy(F.when(~blank, F.col("component_id")), F.when(blank, F.col("id")), F.when(blank, F.col("text")))
    first = groups.agg(F.min(F.struct(F.col("id").isNull(), "id", F.xxhash64("text"), "key")).getField("key").alias("key"))
    return keyed.join(first, "key", "left_semi").select("row.*")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold three quarters or more of a test item's shingles go."""
    keyed = _keyed(docs, "pipeline-rows")
    found = contain.find_items(_texts(keyed), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return keyed.join(found.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark."""
    return secret_scan.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents, or pieces of long ones, in bins."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: Trees and taggers can't be said in SQL. The tests hold each stage, and ``run``, against its module or brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
