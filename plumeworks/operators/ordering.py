"""Ordered computations that do not gather a whole ordered sequence in one task.

A sequence is cut into blocks that respect the order. Per-block totals are
small, so they can be accumulated by a window; the rows only need a window
inside their own block, plus the total of the blocks before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The fewest blocks, and the rows of one.
BLOCKS, BLOCK_ROWS = 256, 200_000


def blocks_for(rows: int) -> int:
    return max(BLOCKS, -(-rows // BLOCK_ROWS))


def quantile_blocks(df: DataFrame, column: str, out: str = "_block", blocks: int | None = BLOCKS) -> DataFrame:
    """Add a block number that grows with ``column`` and holds about equally many rows.

    The cut points (at most ``blocks`` doubles) are computed by one job and
    fixed in the plan, so every branch and every retry sees the same blocks. With ``blocks=None`` that job counts the rows
    as well, and only where they call for more than ``BLOCKS`` blocks is there a second one.
    """
    if blocks is None:
        shares = [i / BLOCKS for i in range(1, BLOCKS)]
        found = df.agg(F.percentile_approx(F.col(column).cast("double"), shares, 8 * BLOCKS).alias("cuts"), F.count(F.lit(1)).alias("n")).first()
        if blocks_for(found["n"]) > BLOCKS:
            return quantile_blocks(df, column, out, blocks_for(found["n"]))
        cuts = sorted(set(found["cuts"] or []))
    else:
        wanted = [i / blocks for i in range(1, blocks)]
        cuts = sorted(set(df.approxQuantile(column, wanted, 1.0 / (4 * blocks))))
    if not cuts:
        return df.withColumn(out, F.lit(0).cast("int"))
    splits = [float("-inf"), *cuts, float("inf")]
    binned = Bucketizer(splits=splits, inputCol=column, outputCol=out).transform(df)
    return binned.withColumn(out, F.col(out).cast("int"))


def hash_blocks(df: DataFrame, number: str, out: str = "_block", blocks: int = BLOCKS) -> DataFrame:
    """Block number from the top bits of a 64-bit hash column, so it grows with the hash itself."""
    bits = max((blocks - 1).bit_length(), 1)
    return df.withColumn(out, F.shiftright(number, 64 - bits))


def running_totals(
    df: DataFrame,
    measures: dict[str, Column],
    order: Sequence[Column],
    keys: Sequence[str] = (),
    block: str = "_block",
    block_descending: bool = False,
    totals: bool = True,
) -> DataFrame:
    """Add ``cum_<m>`` (inclusive running sum in ``order``) and ``all_<m>`` per key.

    ``block`` must be monotone in the order (descending when the order is).
    """
    keys = list(keys)
    names = list(measures)
    df = df.withColumns({f"_m_{n}": c for n, c in measures.items()})
    per_block = df.groupBy(*keys, block).agg(*[F.sum(f"_m_{n}").alias(f"_b_{n}") for n in names])
    block_order = F.col(block).desc() if block_descending else F.col(block).asc()
    across = W.partitionBy(*keys).orderBy(block_order)
    before = across.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    offsets = per_block.select(
        *keys, block,
        *[F.coalesce(F.sum(f"_b_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names],
        *([F.sum(f"_b_{n}").over(whole).alias(f"all_{n}") for n in names] if totals else []),
    )
    inside = W.partitionBy(*keys, block).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    joined = df.join(offsets, [*keys, block])
    return joined.withColumns(
        {f"cum_{n}": F.col(f"_o_{n}") + F.sum(f"_m_{n}").over(inside) for n in names}
    ).drop(*[f"_m_{n}" for n in names], *[f"_o_{n}" for n in names])


def shuffled_position(
    df: DataFrame, identity: Sequence[str], seed: int, keys: Sequence[str] = (), out: str = "position",
    blocks: int | None = None,
) -> DataFrame:
    """1-based position of each row in a seeded random order per key.

    The order is a hash of the identity columns: repeatable, and spread over
    ``blocks`` tasks per key even when there are only two keys (by default four for each
    shuffle partition, the setting that is sized to the data).
    """
    blocks = blocks or max(BLOCKS, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    df = df.withColumn("_h", F.xxhash64(F.lit(seed), *keys, *identity))
    df = hash_blocks(df, "_h", blocks=blocks)
    placed = running_totals(
        df, {"row": F.lit(1)}, [F.col("_h"), *[F.col(c) for c in identity]], keys=keys, totals=False
    )
    return placed.withColumnRenamed("cum_row", out).drop("_h", "_block")


def forward_fill(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), order: str = "date", block: Column | None = None
) -> DataFrame:
    """Last non-NULL value so far, per key in ``order``.

    Daily tables hold one row per key and day, so a key's window is bounded by
    the calendar and the plain window is used. For finer series give ``block``
    (e.g. ``trunc(date, 'month')``): each block then fills on its own, starting
    from the last values of the blocks before it.
    """
    keys = list(keys)
    if block is None:
        w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    df = df.withColumn("_block", block)
    ends = df.groupBy(*keys, "_block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    )
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(*keys, "_block", *[F.last(c, ignorenulls=True).over(before).alias(f"_c_{c}") for c in columns])
    inside = W.partitionBy(*keys, "_block").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    filled = df.join(carried, [*keys, "_block"]).withColumns(
        {c: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"_c_{c}")) for c in columns}
    )
    return filled.drop("_block", *[f"_c_{c}" for c in columns])
