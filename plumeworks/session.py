"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_session(app: str = "plumeworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Shuffle partitions are left to the cluster (AQE coalesces small ones); pass
    ``**{"spark.sql.shuffle.partitions": "8"}`` for a laptop.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the cluster names none (a local test) is one created, and it is
    then set on the context so that ``checkpoint()`` uses it as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    made = tempfile.mkdtemp(prefix="plumeworks-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is overwritten."""
    return os.path.join(shared_dir(spark), "plumeworks", f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str, arrow_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and pins the rows: used where two branches of a plan must
    see exactly the same rows, or where a result feeds several jobs.
    ``arrow_rows``: the most rows that a Python task is handed at once meanwhile;
    a smaller setting of the session stays. Rows of long texts then take less
    memory on both sides.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(ARROW_ROWS)
    fewer = arrow_rows is not None and not 0 < int(before) <= arrow_rows
    try:
        if fewer:
            spark.conf.set(ARROW_ROWS, str(arrow_rows))
        df.write.parquet(path)
    finally:
        if fewer:
            spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)
