"""Best-fit packing of token sequences into bins of several permitted lengths.

Items are documents by length; longer ones than the largest bin are cut into pieces of it. The plan is made on the
histogram of lengths, which has at most as many entries as the largest bin has tokens, whatever the number of
documents: lengths go from large to small, each into the open bins with the least room that still holds it; where none
does, a bin is opened at the permitted size with the least cost per token it is expected to hold. Bins that were filled
alike stay one *pattern* with a count, so the plan stays of the order of the histogram. At the end each bin shrinks to
the smallest permitted size that holds its contents. Documents then get their places by their rank within their
length: all documents of a length in turn fill that length's slots in the patterns.

Defined results: a null or empty text has no tokens and takes a place of length 0 in no bin (bin_id null); ids may
repeat, each row is an item of its own; ties in length are ordered by id and then text; an empty table gives an empty
result. Other columns are not read. The plan is exact for any size; nothing is sampled.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

SIZES = (512, 1024, 2048, 4096)
#: What a bin costs beside its tokens, in tokens.
OVERHEAD = 32
#: Rows of one length that are ranked by one task, on average.
RANKED = 250_000


@dataclass
class Pattern:
    size: int  # permitted length
    room: int
    count: int  # bins filled like this
    items: list[tuple[int, int, int]]  # length, first rank of that length, how many in each bin


def _open_size(length: int, left: dict[int, int], sizes: Sequence[int], overhead: int) -> int:
    """The permitted size with the least cost per token expected in it; larger sizes win ties.

    What a size can still hold beside the item is bounded by its room and by the tokens left in items that fit there.
    """
    best, chosen = None, sizes[-1]
    for size in sizes:
        if size < length:
            continue
        room = size - length
        waiting = 0
        for other, n in left.items():
            if other <= room:
                waiting += other * n
                if waiting >= room:
                    waiting = room
                    break
        cost = (size + overhead) / (length + waiting)
        if best is None or cost <= best:
            best, chosen = cost, size
    return chosen


def plan(histogram: dict[int, int], sizes: Sequence[int] = SIZES, overhead: int = OVERHEAD) -> list[Pattern]:
    """Best fit, longest first, over a histogram of lengths from 1 to the largest size."""
    sizes = sorted(sizes)
    left = dict(sorted(histogram.items(), reverse=True))
    if left and (min(left) < 1 or max(left) > sizes[-1]):
        raise ValueError("a length lies outside 1 to the largest bin")
    opened: list[tuple[int, int]] = []  # (room, pattern number), least room first
    patterns: list[Pattern] = []
    for length in list(left):
        waiting = left.pop(length)
        rank = 0
        while waiting:
            at = bisect_left(opened, (length, -1))
            if at < len(opened):
                room, number = opened.pop(at)
                p = patterns[number]
                each = room // length
                bins = min(p.count, waiting // each)
                if not bins:  # fewer items than one of these bins takes
                    each, bins = waiting, 1
                if bins < p.count:
                    # the bins that stay as they are keep their own later ranks of what both share
                    patterns.append(Pattern(p.size, room, p.count - bins, [(n, first + bins * k, k) for n, first, k in p.items]))
                    insort(opened, (room, len(patterns) - 1))
                    p.count = bins
            else:
                size = _open_size(length, {**left, length: waiting - 1} if waiting > 1 else left, sizes, overhead)
                each = size // length
                bins = waiting // each
                if not bins:
                    each, bins = waiting, 1
                p, number = Pattern(size, size, bins, []), len(patterns)
                patterns.append(p)
            p.items.append((length, rank, each))
            p.room -= each * length
            rank += bins * each
            waiting -= bins * each
            if p.room:
                insort(opened, (p.room, number))
    for p in patterns:
        used = p.size - p.room
        p.size = next(s for s in sizes if s >= used)
        p.room = p.size - used
    return patterns


def word_count(text: Column) -> Column:
    """Words between white space: the unit of length unless another column is named."""
    trimmed = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(F.coalesce(trimmed, F.lit(""))) == 0, 0).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1)


def pack(documents: DataFrame, sizes: Sequence[int] = SIZES, overhead: int = OVERHEAD, length: Column | None = None) -> DataFrame:
    """doc_id, piece, first (token where the piece starts), n_tokens, bin_id, bin_size, bin_start: one row per piece.

    ``length`` is the number of tokens of a row (default: words); ``bin_start`` is where the piece stands in its bin.
    """
    sizes = sorted({int(s) for s in sizes})
    if not sizes or sizes[0] < 1 or overhead < 0:
        raise ValueError("sizes must be positive")
    spark, largest = documents.sparkSession, sizes[-1]
    measured = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("tie"),
        F.coalesce((length if length is not None else word_count(F.col("text").cast("string"))).cast("long"), F.lit(0)).alias("whole"),
    )
    pieces = measured.select("doc_id", "tie", "whole", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("whole") / largest).cast("int") - 1, F.lit(0)))).alias("piece")).select(
        "doc_id", "tie", "piece", (F.col("piece").cast("long") * largest).alias("first"), F.least(F.col("whole") - F.col("piece").cast("long") * largest, F.lit(largest)).alias("n_tokens"),
    )
    pieces = materialise(pieces, "packing-pieces")  # counts and ranks must be of the same rows
    parts = max(8, -(-pieces.count() // RANKED))  # so that a length that all rows share still spreads
    pieces = pieces.withColumn("spread", F.pmod(F.xxhash64("doc_id", "tie", "piece"), F.lit(parts)))
    counts = pieces.groupBy("n_tokens", "spread").agg(F.count("*").alias("n"))
    before = Window.partitionBy("n_tokens").orderBy("spread").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("n_tokens", "spread", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    histogram = {r["n_tokens"]: r["n"] for r in counts.groupBy("n_tokens").agg(F.sum("n").alias("n")).collect() if r["n_tokens"] > 0}
    slots, first_bin = [], 0
    for p in plan(histogram, sizes, overhead):
        start = 0
        for n, rank, each in p.items:
            slots.append((n, rank, rank + p.count * each, first_bin, each, start, p.size))
            start += n * each
        first_bin += p.count
    within = Window.partitionBy("n_tokens", "spread").orderBy("doc_id", "tie", "piece")
    ranked = pieces.withColumn("at", F.row_number().over(within) - 1).join(offsets, ["n_tokens", "spread"]).withColumn("rank", F.col("at") + F.col("offset"))
    # one array of slots per length, for a look-up without a range join; the plan has of the order of ``largest`` slots
    table = spark.createDataFrame(slots, "n_tokens long, low long, high long, first_bin long, each long, start long, bin_size int")
    by_length = table.groupBy("n_tokens").agg(F.array_sort(F.collect_list(F.struct("low", "high", "first_bin", "each", "start", "bin_size"))).alias("slots"))
    placed = ranked.join(F.broadcast(by_length), "n_tokens", "left").withColumn(
        "slot", F.element_at(F.filter("slots", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"])), 1)
    )
    inside = F.col("rank") - F.col("slot.low")
    return placed.select(
        "doc_id", "piece", "first", "n_tokens", (F.col("slot.first_bin") + F.floor(inside / F.col("slot.each"))).alias("bin_id"), F.col("slot.bin_size").alias("bin_size"),
        (F.col("slot.start") + F.pmod(inside, F.col("slot.each")) * F.col("n_tokens")).alias("bin_start"),
    )
