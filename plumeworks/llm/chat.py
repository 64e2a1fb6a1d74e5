"""Chat formatting with cumulative-snapshot collapse, in DataFrame operations only.

Logs often hold a conversation once per turn: each snapshot repeats the turns before it. A rolling hash of the turn
prefixes (the exclusive-or of two 64-bit hashes of position, role and text) names every prefix; a conversation whose
whole hash, with its length, is a proper prefix of another is dropped by an anti-join, and of equal conversations the one
with the smallest id stays. The rest is rendered.

Turns are first put into stretches of ``STRETCH`` turn numbers. Positions and prefix hashes are window results within
a stretch plus what the stretches before it add up to, and rendering gives one row per stretch, so a long conversation
does not come together in one task; only turns whose numbers lie in one stretch, or are all null, do. A rendered conversation is
its parts joined in order; up to ``STRETCH`` turn numbers there is one part.

Defined results: turns are ordered by turn number (null first), then role, then text; repeated identical rows count once;
a null role or text is a value of its own when compared and is rendered empty; rows with a null conversation id are
left out; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

STRETCH = 1024


def _name(*columns: Column) -> tuple[Column, Column]:
    """Two hashes that also tell a null from an empty text."""
    parts = [x for c in columns for x in (c, c.isNull())]
    return F.xxhash64(*parts), F.xxhash64(F.lit(0x5EED), *reversed(parts))


def _rolled(turns: DataFrame) -> DataFrame:
    """conv_id, stretch, pos (from 1 within the conversation), role, text, h1, h2 (hashes of the prefix that ends there)."""
    block = Window.partitionBy("conv_id", "stretch").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = turns.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"))
    offsets = sizes.select("conv_id", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = turns.withColumn("at", F.row_number().over(block)).join(offsets, ["conv_id", "stretch"]).withColumn("pos", F.col("at") + F.col("offset"))
    a, b = _name(F.col("pos"), F.col("role"), F.col("text"))
    so_far = Window.partitionBy("conv_id", "stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = placed.select(
        "conv_id", "stretch", "pos", "role", "text", F.bit_xor(a).over(so_far).alias("r1"), F.bit_xor(b).over(so_far).alias("r2"),
    )
    ends = within.groupBy("conv_id", "stretch").agg(F.max_by("r1", "pos").alias("e1"), F.max_by("r2", "pos").alias("e2"))
    carried = ends.select("conv_id", "stretch", F.coalesce(F.bit_xor("e1").over(before), F.lit(0)).alias("c1"), F.coalesce(F.bit_xor("e2").over(before), F.lit(0)).alias("c2"))
    return within.join(carried, ["conv_id", "stretch"]).select(
        "conv_id", "stretch", "pos", "role", "text", F.col("r1").bitwiseXOR(F.col("c1")).alias("h1"), F.col("r2").bitwiseXOR(F.col("c2")).alias("h2"),
    )


def ordered_turns(conversations: DataFrame) -> DataFrame:
    turn = F.col("turn").cast("long")
    return (
        conversations.where(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
        .distinct()
        .withColumn("stretch", F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 60))))
    )


def maximal(rolled: DataFrame) -> DataFrame:
    """conv_id, n_turns of the conversations that prefix no other and are the first of their equals."""
    whole = rolled.groupBy("conv_id").agg(F.max("pos").alias("n_turns"), F.max_by("h1", "pos").alias("h1"), F.max_by("h2", "pos").alias("h2"))
    first = whole.groupBy("n_turns", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    # every prefix but the whole one, once each however many conversations share it
    sizes = whole.select("conv_id", "n_turns")
    shorter = rolled.join(sizes, "conv_id").where("pos < n_turns").select(F.col("pos").alias("n_turns"), "h1", "h2").distinct()
    return first.join(shorter, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", "n_turns")


def format_chats(conversations: DataFrame, opening: str = "<|im_start|>", closing: str = "<|im_end|>") -> DataFrame:
    """conv_id, n_turns, part, n_parts, text: the rendered maximal conversations, in parts of ``STRETCH`` turn numbers."""
    # the windows are computed once: names, anti-join and rendering must see the same rows
    rolled = materialise(_rolled(ordered_turns(conversations)), "chat-turns")
    empty = F.lit("")
    line = F.concat(F.lit(opening), F.coalesce("role", empty), F.lit("\n"), F.coalesce("text", empty), F.lit(f"{closing}\n"))
    kept = rolled.join(maximal(rolled), "conv_id")
    parts = kept.groupBy("conv_id", "n_turns", "stretch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))), lambda x: x["line"]), "").alias("text"))
    order = Window.partitionBy("conv_id")
    return parts.select(
        "conv_id", "n_turns", F.row_number().over(order.orderBy("stretch")).alias("part"), F.count("*").over(order).alias("n_parts"), "text",
    )


#: The same for DuckDB, comparing the prefixes themselves; only for conversations of one part.
ORACLE = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
marked AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos, role, text,
  CASE WHEN role IS NULL THEN 'n' ELSE 'r' || length(role) || ':' || role END || CASE WHEN text IS NULL THEN 'n' ELSE 't' || length(text) || ':' || text END AS piece FROM turns),
rolled AS (SELECT conv_id, pos, role, text, string_agg(piece, '|') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM marked),
sized AS (SELECT *, max(pos) OVER (PARTITION BY conv_id) AS n_turns FROM rolled),
firsts AS (SELECT min(conv_id) AS conv_id, prefix FROM sized WHERE pos = n_turns GROUP BY prefix),
kept AS (SELECT conv_id FROM firsts WHERE prefix NOT IN (SELECT prefix FROM sized WHERE pos < n_turns))
SELECT conv_id, n_turns, CAST(1 AS INTEGER) AS part, CAST(1 AS BIGINT) AS n_parts,
  string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM sized JOIN kept USING (conv_id) GROUP BY conv_id, n_turns
"""
