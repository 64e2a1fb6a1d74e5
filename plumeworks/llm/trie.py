"""The prefix trie of conversations, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns; a hash of two times 64 bits names it (the exclusive-or of hashes of position,
role and text of its turns, so a parent's name follows from its child's). Totals of subtrees are passed upwards: nodes are
sorted externally by reverse level order (deepest first), and each passes its totals to its parent's later turn through a
priority queue that spills to unnamed files of the task when it grows.

Shards. Equal conversations are first counted once. A node is heavy when the turns below it exceed a limit that grows with the
square root of all turns; the topmost nodes that are not heavy are shard roots, and their subtrees the shards: complete, bounded,
and cut at whatever depth a common beginning needs. Totals of shard roots are summed by parent and enter the tree of the heavy
nodes, a few for each level, which runs through the same queues in bands of ``BAND`` levels: bands on their own, then band
roots, then bands again with what came from below.

No step gathers a conversation or a node's members in one task: positions and prefix names are windows within a stretch of a
conversation plus what the stretches before it add up to, heavy nodes are reduced by partial aggregates, and only numbers, no
texts, cross the network. A hash over the ids that end at a node is one sequence by nature; its ids are joined in pieces
by all tasks and only these pieces are read in order.

Defined results: rows with a null conversation id are left out; turns are ordered by turn number (null first), then by the MD5
of role and text; repeated identical rows are turns of their own; a null role or text is empty; an empty table has no node.
Other columns are not read. Collisions of the 128 bits are not verified.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import counted_within, lookup_join
from ..session import materialise

#: Turn numbers of a stretch; turns of a stretch from which it is cut by turn and hash; levels of a band.
STRETCH, CROWDED, BAND = 1024, 65_536, 1024
#: Turns below a node from which it is heavy, at least, and the factor of the square root of all turns.
LEAST_HEAVY, HEAVY_ROOT = 65_536, 4
#: Entries of a queue that are held in memory; ids joined in one piece; rows of a returned batch.
QUEUED, JOINED, BATCH = 200_000, 65_536, 8192
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["depth", "h1", "h2"]


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, stretch, pos (from 1), t1, t2 (hashes of role and text), words: every turn by its place, without its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.md5(F.concat(role, F.lit("\n"), text)).alias("tie"),
        F.xxhash64(role, F.lit(0), text).alias("t1"), F.xxhash64(F.lit(0x5EED), text, F.lit(1), role).alias("t2"), F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    turns = turns.withColumn("lot", F.floor(F.col("turn") / STRETCH))
    crowded = materialise(turns.groupBy("conv_id", "lot").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).select("conv_id", F.coalesce("lot", F.lit(-(1 << 62))).alias("at"), F.lit(True).alias("cut")), "crowded-turns")
    whole = F.struct("lot", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("part"))
    if crowded.isEmpty():
        placed = turns.withColumn("stretch", whole)
    else:  # within such a stretch, every turn number stands alone and its rows are cut by the first letters of their order
        marked = lookup_join(turns.withColumn("at", F.coalesce("lot", F.lit(-(1 << 62)))), crowded, ["conv_id", "at"], max_lookup_rows=0 if counted_within(crowded) else None, salt_on=["turn", "tie"])
        placed = marked.withColumn("stretch", F.when(F.col("cut"), F.struct("lot", "turn", F.substring("tie", 1, 3).alias("part"))).otherwise(whole)).drop("at", "cut")
    inside = Window.partitionBy("conv_id", "stretch").orderBy(F.col("turn").asc_nulls_first(), "tie")
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"))
    offsets = sizes.select("conv_id", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # the struct of a stretch holds nulls, so it is compared as one text
    named = lambda df: df.withColumn("stretch", F.to_json("stretch"))
    numbered = named(placed.withColumn("at", F.row_number().over(inside)))
    return numbered.join(named(offsets), ["conv_id", "stretch"]).select("conv_id", (F.col("at") + F.col("offset")).alias("pos"), "t1", "t2", "words")


def rebuilt(turns: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """conversations (conv_id), and their rebuilt turns (conv_id, pos, t1, t2, words).

    A conversation c begins with the first h turns of conversation c - c % ``every``, h being crc32(c) % ``heads``; its own turns
    after its first h follow.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % every
    sizes = materialise(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "trie-sizes")
    wanted = sizes.select("conv_id", h.alias("h"), base.alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    wanted = wanted.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    first = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "base")
    borrowed = wanted.where("taken > 0").join(first, "base").where("pos <= taken").select("conv_id", "pos", "t1", "t2", "words")
    # the shift is repeated for each stretch of positions, so a long conversation is not joined in one task
    lots = wanted.join(sizes, "conv_id").select("conv_id", "h", "taken", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / STRETCH))).alias("lot"))
    own = turns.withColumn("lot", F.floor(F.col("pos") / STRETCH)).join(lots, ["conv_id", "lot"]).where("pos > h")
    return sizes.select("conv_id"), borrowed.unionByName(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "t1", "t2", "words"))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, band, h1, h2 (the prefix that ends here), p1, p2 (the one before), b1, b2 (the one of the band's first level), words."""
    names = [F.xxhash64("pos", "t1"), F.xxhash64(F.lit(7), F.col("t2"), F.col("pos"))]
    named = turns.select("conv_id", F.col("pos").cast("long").alias("depth"), "words", names[0].alias("a1"), names[1].alias("a2")).withColumn("lot", F.floor((F.col("depth") - 1) / BAND))
    so_far = Window.partitionBy("conv_id", "lot").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = named.withColumns({"r1": F.bit_xor("a1").over(so_far), "r2": F.bit_xor("a2").over(so_far)})
    ends = named.groupBy("conv_id", "lot").agg(F.bit_xor("a1").alias("e1"), F.bit_xor("a2").alias("e2"))
    before = Window.partitionBy("conv_id").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("conv_id", "lot", F.coalesce(F.bit_xor("e1").over(before), F.lit(0)).alias("c1"), F.coalesce(F.bit_xor("e2").over(before), F.lit(0)).alias("c2"))
    rolled = within.join(carried, ["conv_id", "lot"]).withColumns({"h1": F.col("r1").bitwiseXOR(F.col("c1")), "h2": F.col("r2").bitwiseXOR(F.col("c2"))})
    return rolled.select(
        "conv_id", "depth", "lot", "h1", "h2", F.col("h1").bitwiseXOR(F.col("a1")).alias("p1"), F.col("h2").bitwiseXOR(F.col("a2")).alias("p2"), F.col("c1").alias("b1"), F.col("c2").alias("b2"), "words",
    )


class SpillingQueue:
    """A priority queue of tuples. Beyond ``room`` entries, what it holds becomes a sorted run in an unnamed file of the task."""

    def __init__(self, room: int):
        self.room, self.held, self.runs, self.heads = room, [], [], []

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.held, entry)
        if len(self.held) > self.room:
            file = tempfile.TemporaryFile()
            for x in sorted(self.held):
                pickle.dump(x, file)
            file.seek(0)
            self.held = []
            self.runs.append(file)
            self._advance(len(self.runs) - 1)

    def _advance(self, run: int) -> None:
        try:
            heapq.heappush(self.heads, (pickle.load(self.runs[run]), run))
        except EOFError:
            self.runs[run].close()

    def first(self) -> tuple | None:
        if self.heads and (not self.held or self.heads[0][0] < self.held[0]):
            return self.heads[0][0]
        return self.held[0] if self.held else None

    def pop(self) -> tuple:
        if self.heads and (not self.held or self.heads[0][0] < self.held[0]):
            entry, run = heapq.heappop(self.heads)
            self._advance(run)
            return entry
        return heapq.heappop(self.held)


#: What a node takes along: name, own values, what enters from other shards, and after its turn its totals.
NODE = "s1 long, s2 long, depth long, h1 long, h2 long, p1 long, p2 long, conv_id long, n_convs long, words long, children long, leaves long, saved long"
DONE = "depth long, h1 long, h2 long, p1 long, p2 long, conv_id long, n_convs long, children long, leaves long, saved long, parent_conv_id long, top boolean"


def forward(nodes: DataFrame, room: int = QUEUED) -> DataFrame:
    """Totals of every node of each shard (s1, s2), passed up from level to level. ``nodes`` has the columns of ``NODE``.

    children, leaves and saved of a node come in as what other shards add below it. A node is returned once its parent's
    turn has come, with the parent's conv_id; the top of a shard is returned with none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in DONE.split(", ")]
        types = [pa.bool_() if c.endswith("boolean") else pa.int64() for c in DONE.split(", ")]
        out: list[tuple] = []
        queue, shard = SpillingQueue(room), None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for s1, s2, depth, h1, h2, p1, p2, conv, n, words, children, leaves, saved in zip(*[c.to_pylist() for c in batch.columns]):
                if shard != (s1, s2):
                    if queue.first() is not None:
                        raise ValueError("a node has no parent in its shard")
                    shard = (s1, s2)
                saved += (n - 1) * words
                while (first := queue.first()) is not None and first[:3] == (-depth, h1, h2):
                    child = queue.pop()[3:]
                    out.append((*child, conv, False))
                    children, leaves, saved = children + 1, leaves + child[8], saved + child[9]
                done = (depth, h1, h2, p1, p2, conv, n, children, leaves if children else 1, saved)
                if (h1, h2) == shard:
                    out.append((*done, None, True))
                else:
                    queue.push((1 - depth, p1, p2, *done))
                if len(out) >= BATCH:
                    yield batch_of(out)
                    out = []
        if queue.first() is not None:
            raise ValueError("a node has no parent in its shard")
        if out:
            yield batch_of(out)

    columns = [c.split(" ")[0] for c in NODE.split(", ")]
    sorted_nodes = nodes.select(*columns).repartition("s1", "s2").sortWithinPartitions("s1", "s2", F.col("depth").desc(), "h1", "h2")
    return sorted_nodes.mapInArrow(run, DONE)


def _message(done: DataFrame) -> DataFrame:
    """What tops of shards add to the nodes above them."""
    return done.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(
        F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )


def _joined_by(nodes: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    return lookup_join(nodes, small, keys, max_lookup_rows=0 if counted_within(small) else None, salt_on=["h1", "h2"])


def _entering(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    filled = nodes.join(messages, KEY, "left")
    return filled.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("children", "leaves", "saved")})


def _heavy_totals(heavy: DataFrame, below: DataFrame, room: int) -> DataFrame:
    """Totals of the heavy nodes (with band roots b1, b2) given the messages of the shards below them."""
    band_top = F.col("depth") % BAND == 0
    shards = heavy.withColumns({"s1": F.when(band_top, F.col("h1")).otherwise(F.col("b1")), "s2": F.when(band_top, F.col("h2")).otherwise(F.col("b2"))})
    tops = shards.where(band_top & (F.col("depth") > 0))
    if tops.isEmpty():
        return forward(_entering(shards, below), room)
    # bands on their own: a node whose children are in the next band is no leaf, but what they add is not known yet
    known = tops.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count("*").alias("children"), F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    summed = lambda m: m.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
    alone = forward(_entering(shards, summed(below.unionByName(known))), room).where("top").select(*KEY, "leaves", "saved")
    # band roots: a tree of its own, in which a root's parent is the root of the band above
    bands = shards.where(band_top).join(alone, KEY).select(
        F.lit(0).cast("long").alias("s1"), F.lit(0).cast("long").alias("s2"), (F.col("depth") / BAND).cast("long").alias("depth"), "h1", "h2", F.col("b1").alias("p1"), F.col("b2").alias("p2"),
        "conv_id", F.lit(1).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("words"), F.lit(1).cast("long").alias("children"), "leaves", "saved",
    )
    totals = materialise(forward(bands, room), "trie-bands").select((F.col("depth") * BAND).alias("depth"), "h1", "h2", "leaves", "saved")
    passed = _message(tops.select(*KEY, "p1", "p2").join(totals, KEY))
    return forward(_entering(shards, summed(below.unionByName(passed))), room)


def ends_hashes(members: DataFrame) -> DataFrame:
    """depth, h1, h2, ends_sha256: SHA-256 of the decimal conv_ids of a node, in order, joined by commas."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out = None, [], []

        def piece() -> None:
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids))))
                ids.clear()

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*KEY, "first", "piece"])
            out.clear()
            return made

        for batch in batches:
            for *now, conv in zip(*[c.to_pylist() for c in batch.columns]):
                if now != key or len(ids) >= JOINED:
                    piece()
                    key = now
                ids.append(conv)
                if len(out) >= BATCH:
                    yield batch_of()
        piece()
        if out:
            yield batch_of()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out = []
            for *now, _, text in zip(*[c.to_pylist() for c in batch.columns]):
                if now != key:
                    if key:
                        out.append((*key, sha.hexdigest()))
                    key, sha = now, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*KEY, "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], [*KEY, "ends_sha256"])

    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = members.select(*KEY, "conv_id").repartitionByRange(tasks, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(join, "depth long, h1 long, h2 long, first long, piece string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, "depth long, h1 long, h2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, every: int = 20, heads: int = 4, least_heavy: int = LEAST_HEAVY, room: int = QUEUED) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row for each node."""
    convs, turns = rebuilt(materialise(ordered(conversations), "trie-turns"), every, heads)
    rolled = materialise(prefixes(turns), "trie-prefixes")
    zero = F.lit(0).cast("long")
    # the whole of each conversation: the root itself if it has no turn
    whole = rolled.groupBy("conv_id").agg(F.max(F.struct("depth", "h1", "h2")).alias("end")).select("conv_id", "end.*")
    members = materialise(convs.join(whole, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in KEY]), "trie-members")
    equal = members.groupBy(*KEY).agg(F.count("*").alias("copies"), F.min("conv_id").alias("conv_id"))
    lots = equal.where("depth > 0").select("conv_id", "copies", F.col("depth").alias("size"), F.explode(F.sequence(zero, F.floor((F.col("depth") - 1) / BAND))).alias("lot"))
    paths = materialise(rolled.join(lots, ["conv_id", "lot"]), "trie-paths")

    # heavy nodes, and for each path the first node below them: the root of its shard
    limit = max(least_heavy, HEAVY_ROOT * math.isqrt(paths.count()))
    heavy_keys = materialise(paths.groupBy(*KEY).agg(F.sum(F.col("size") - F.col("depth") + 1).alias("below")).where(F.col("below") > limit).select(*KEY), "trie-heavy")
    deepest = _marked(paths, heavy_keys).where("heavy").groupBy("conv_id").agg(F.max("depth").alias("last"))
    last = equal.where("depth > 0").select("conv_id", F.col("depth").alias("size")).join(deepest, "conv_id", "left").select("conv_id", "size", F.coalesce("last", zero).alias("last"))
    last = last.withColumn("lot", F.explode(F.sequence(zero, F.floor((F.col("size") - 1) / BAND)))).drop("size")
    # a path's shard root is one row of it; it goes to every stretch of the path
    placed = paths.join(last, ["conv_id", "lot"])
    roots = placed.where(F.col("depth") == F.col("last") + 1).select("conv_id", F.col("h1").alias("s1"), F.col("h2").alias("s2"), F.explode(F.sequence(F.col("lot"), F.floor((F.col("size") - 1) / BAND))).alias("lot"))
    values = [F.max(c).alias(c) for c in ("p1", "p2", "words")] + [F.min("conv_id").alias("conv_id"), F.sum("copies").alias("n_convs")]
    light = placed.where("depth > last").join(roots, ["conv_id", "lot"]).groupBy(*KEY).agg(*values, F.max("s1").alias("s1"), F.max("s2").alias("s2"))
    heavy = placed.where("depth <= last").groupBy(*KEY).agg(*values, F.max("b1").alias("b1"), F.max("b2").alias("b2"))
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        *[zero.alias(c) for c in (*KEY, "p1", "p2", "words", "b1", "b2")], "conv_id", "n_convs"
    )
    heavy = materialise(heavy.unionByName(root), "trie-top")

    plain = light.withColumns({c: zero for c in ("children", "leaves", "saved")})
    lower = materialise(forward(plain, room), "trie-lower")
    upper = materialise(_heavy_totals(heavy, _message(lower.where("top")), room), "trie-upper")
    parents = heavy.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("above"))
    done = lower.unionByName(upper)
    topped = _joined_by(done.where("top"), parents, ["depth", "p1", "p2"]).withColumn("parent_conv_id", F.col("above")).drop("above")
    nodes = done.where("NOT top").unionByName(topped)
    ends = ends_hashes(members)
    return nodes.join(ends, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _marked(paths: DataFrame, heavy_keys: DataFrame) -> DataFrame:
    """``paths`` with ``heavy``. The heavy nodes are few; where they are not, hot ones are spread."""
    return lookup_join(paths, heavy_keys.withColumn("heavy", F.lit(True)), KEY, max_lookup_rows=0 if counted_within(heavy_keys) else None, salt_on=["conv_id"])


#: The same for DuckDB, comparing the turns themselves.
ORACLE = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || chr(10) || coalesce(text, ''))) AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: [CAST(ord(s) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, y: CASE WHEN y >= 0 THEN xor(a, y) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
k AS (SELECT c.*, least(h, (SELECT count(*) FROM t WHERE t.conv_id = c.base)) AS taken FROM c),
r AS (SELECT k.conv_id, t.pos, t.role, t.text FROM k JOIN t ON t.conv_id = k.base AND t.pos <= k.h
  UNION ALL SELECT k.conv_id, t.pos - k.h + k.taken, t.role, t.text FROM k JOIN t ON t.conv_id = k.conv_id AND t.pos > k.h),
p AS (SELECT conv_id, pos, text, string_agg(length(role) || ':' || role || length(text) || ':' || text || ';', '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM r),
m AS (SELECT conv_id, pos AS depth, prefix, lag(prefix, 1, '') OVER (PARTITION BY conv_id ORDER BY pos) AS parent, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM p
  UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM c),
n AS (SELECT depth, prefix, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words FROM m GROUP BY depth, prefix),
kids AS (SELECT parent AS prefix, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (prefix)),
tops AS (SELECT a.prefix, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens FROM v a JOIN v b ON starts_with(b.prefix, a.prefix) GROUP BY a.prefix),
last AS (SELECT conv_id, max_by(prefix, depth) AS prefix FROM m GROUP BY conv_id),
e AS (SELECT prefix, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256 FROM last GROUP BY prefix)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, tops.n_leaves, CAST(tops.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM v JOIN tops USING (prefix) LEFT JOIN v u ON u.prefix = v.parent LEFT JOIN e ON e.prefix = v.prefix
"""
