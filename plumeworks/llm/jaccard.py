"""Exact n-gram Jaccard join with set-relation skipping.

A document's set holds its distinct five-word shingles, as 64-bit hashes. Documents with equal sets form one class. Sets
are ordered by one global order, rare shingles first, and the first n - ceil(0.75 n) + ``SHARED`` of each go into index
lists: two sets that link share at least ``SHARED`` of them (all that a link needs, in smaller sets), which single
shingles that meet by chance do not. Two kinds of relation between sets keep the lists from being joined in full:

* *Answers*: a list has one leader, and every set is first compared with the one leader it meets most often. A set that
  links to its leader has the leader's answers: both lie in one component, and no pair inside a component is looked at
  again.
* *Index blocks*: what is left of a list is cut into blocks by position and size. A pair of blocks is skipped as a whole
  when all of it lies in one component, or when positions and sizes bound the overlap below what a link needs. Only the
  remaining blocks are opened, and their pairs compared exactly.

The order puts shingles that occur often behind the others, by their count: a passage that many documents share then
stands at the end of their sets and hardly ever in a list. The counts cover all documents; shingles that occur at least
twice in some thousand rows are added up, and as many of the most frequent as ``room`` allows take part in the order (the order
decides the work, never the result). Lists of the other shingles are bounded by the number of batches.

Defined results: see :func:`link`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import counted_within
from ..session import materialise
from .components import components
from .contain import shingle_sql
from .texts import SLICE, many_shingles, mix

SHINGLE, PERCENT = 5, 75
#: Shingles that two sets must share in the index lists, unless they are too small for that.
SHARED = 3
#: Index entries of a partition, and rows that a task holds in Python at a time.
PART, ROWS = 400_000, 2048


def _first_copies(batch: pa.RecordBatch) -> tuple[list, list[str | None], np.ndarray]:
    """Ids, texts, and whether a row is the first (smallest id) of its text in the batch."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    least: dict[str, int] = {}
    for i, t in enumerate(texts):
        if t and (t not in least or ids[i] < ids[least[t]]):
            least[t] = i
    first = np.zeros(len(ids), dtype=bool)
    first[list(least.values())] = True
    return ids, texts, first


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def frequent_shingles(texts: DataFrame, room: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, ascending, and their counts; ``room`` of them at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(low, 2 * ROWS) for whole in batches for low in range(0, whole.num_rows, 2 * ROWS)):
            seen: set[int] = set()
            found = []
            for at in range(0, batch.num_rows, SLICE):
                own = []
                for t in batch.column(1).slice(at, SLICE).to_pylist():
                    if t and hash(t) not in seen:
                        seen.add(hash(t))
                        own.append(t)
                found += many_shingles(own, SHINGLE)
            keys = np.concatenate([np.zeros(0, np.uint64), *found])
            found.clear()
            keys.sort()
            if len(keys):
                first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                keys, n = keys[first], np.diff(np.append(first, len(keys)))
                yield pa.RecordBatch.from_arrays([pa.array(_signed(keys[n > 1])), pa.array(n[n > 1])], ["token", "n"])

    counts = materialise(texts.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")), "shingle-counts", 2 * ROWS)
    steps = [2**j for j in range(1, 40)]
    above = counts.agg(*[F.count(F.when(F.col("n") >= s, 1)).alias(str(s)) for s in steps]).first()
    least = next((s for s in steps if above[str(s)] <= room), steps[-1])
    table = counts.where(F.col("n") >= least).toArrow()  # at most ``room`` rows
    keys, n = table.column("token").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def sketches(texts: DataFrame, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> DataFrame:
    """doc_id, n, f1, f2 (fingerprint of the set), rare, common: the prefix, in order, for the first copy in a batch."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = shared.value
        sieve = np.zeros(1 << 20, dtype=bool)
        sieve[(keys >> np.uint64(44)).astype(np.int64)] = True
        for part_batch in (whole.slice(low, ROWS) for whole in batches for low in range(0, whole.num_rows, ROWS)):
            ids, own, first = _first_copies(part_batch)
            for at in range(0, len(ids), SLICE):
                part = slice(at, at + SLICE)
                n, f1, f2, rare, common = [], [], [], [], []
                for s, is_first in zip(many_shingles(own[part], SHINGLE), first[part]):
                    n.append(len(s))
                    other = mix(s + np.uint64(0x5851F42D4C957F2D))
                    f1.append(int(_signed(np.bitwise_xor.reduce(s, keepdims=True))[0]) if len(s) else 0)
                    f2.append(int(_signed(np.add.reduce(other, keepdims=True))[0]) if len(s) else 0)
                    if not is_first or not len(s):
                        rare.append(None)
                        common.append(None)
                        continue
                    want = min(len(s), len(s) - (-(-percent * len(s) // 100)) + SHARED)
                    maybe = np.flatnonzero(sieve[(s >> np.uint64(44)).astype(np.int64)])
                    place = np.searchsorted(keys, s[maybe])
                    ok = (place < len(keys)) & (keys[np.minimum(place, max(0, len(keys) - 1))] == s[maybe]) if len(keys) else np.zeros(len(maybe), bool)
                    often = np.zeros(len(s), dtype=bool)
                    often[maybe[ok]] = True
                    ahead = s[~often][:want]
                    behind = s[often][np.argsort(counts[place[ok]], kind="stable")][: want - len(ahead)]
                    rare.append(_signed(ahead))
                    common.append(_signed(behind))
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[part], pa.int64()), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(rare, kind), pa.array(common, kind)],
                    ["doc_id", "n", "f1", "f2", "rare", "common"],
                )

    return texts.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, rare array<long>, common array<long>")


def _rare_lists(sketch: DataFrame) -> DataFrame:
    """Index entries (token, doc_id, n, pos) of the rare shingles that two sets or more have in their lists.

    Entries travel in packed blocks, dealt by ranges of the hash; a partition sorts its blocks and keeps repeated tokens.
    """
    total = sketch.agg(F.sum(F.size("rare"))).first()[0] or 0
    parts = max(1, -(-total // PART))
    entry = np.dtype([("token", "<u8"), ("doc", "<i8"), ("n", "<i4"), ("pos", "<i4")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(low, ROWS) for whole in batches for low in range(0, whole.num_rows, ROWS)):
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            tokens = lists.flatten().to_numpy().view(np.uint64)
            block = np.empty(len(tokens), dtype=entry)
            block["token"] = tokens
            block["doc"] = np.repeat(batch.column(0).to_numpy(), sizes)
            block["n"] = np.repeat(batch.column(1).to_numpy(), sizes)
            block["pos"] = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            part = ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            some = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array([block[order[cuts[p] : cuts[p + 1]]].tobytes() for p in some], pa.binary())], ["part", "data"]
            )

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for p, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(p, []).append(data)
        for p in sorted(held):
            rows = np.frombuffer(b"".join(held.pop(p)), dtype=entry)
            rows = rows[np.argsort(rows["token"], kind="stable")]
            same = rows["token"][1:] == rows["token"][:-1]
            live = np.zeros(len(rows), dtype=bool)
            live[1:] |= same
            live[:-1] |= same
            rows = rows[live]
            for at in range(0, len(rows), 100_000):
                r = rows[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(r["token"]).view(np.int64)), pa.array(r["doc"]), pa.array(r["n"].astype(np.int64)), pa.array(r["pos"].astype(np.int64))], ["token", "doc_id", "n", "pos"]
                )

    packed = sketch.where("size(rare) > 0").select("doc_id", "n", "rare").mapInArrow(pack, "part int, data binary")
    return packed.repartitionById(parts, "part").mapInArrow(repeated, "token long, doc_id long, n long, pos long")


def _common_lists(sketch: DataFrame) -> DataFrame:
    rows = sketch.where("size(common) > 0").select("doc_id", "n", F.size("rare").alias("before"), F.posexplode("common").alias("p", "token"))
    return rows.select("token", "doc_id", "n", (F.col("p") + F.col("before")).cast("long").alias("pos"))


def _verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """u, v of the pairs whose sets link, compared whole."""
    ids = pairs.select(F.col("u").alias("doc_id")).unionByName(pairs.select(F.col("v").alias("doc_id"))).distinct()
    if counted_within(ids):  # then only the texts that are compared travel
        texts = texts.join(F.broadcast(ids), "doc_id", "left_semi")
    left = pairs.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("left")), "u")
    both = left.join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("right")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                lefts, rights = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                fresh = [i for i in range(len(rights)) if rights[i] != (rights[i - 1] if i else last[0])]
                sets = many_shingles(lefts + [rights[i] for i in fresh], SHINGLE)
                keep = np.zeros(len(lefts), dtype=bool)
                turn = iter(sets[len(lefts) :])
                for i, mine in enumerate(sets[: len(lefts)]):
                    if rights[i] != last[0]:
                        last = (rights[i], next(turn))
                    common = len(np.intersect1d(mine, last[1], assume_unique=True))
                    keep[i] = 100 * common >= percent * (len(mine) + len(last[1]) - common)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["u", "v"])

    return both.select("u", "v", "left", "right").mapInArrow(run, "u long, v long")


def _enough(shared: str, n: str, percent: int) -> Column:
    """Whether sets that share so many entries can link; ``n`` is the larger size."""
    return F.col(shared) >= F.least(F.lit(SHARED), F.ceil(F.col(n) * percent / 100))


def _leader_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """u, v: every set with the leader that it meets in most lists.

    The leader of a list is the set whose shingles are shared most: an original shares nearly all of its own, an edited
    copy has some to itself. Leaders are aggregated before the join, which can split a hot list.
    """
    shares = lists.groupBy("rep").agg((F.count("*") / F.max("n")).alias("share"))
    rated = lists.select("token", "rep", "n").join(shares, "rep")
    leaders = rated.groupBy("token").agg(F.max_by("rep", F.struct("share", F.xxhash64("rep"))).alias("leader"), F.count("*").alias("k")).where("k > 1")
    met = rated.join(leaders, "token").where("rep <> leader").groupBy("rep", "leader").agg(F.count("*").alias("shared"), F.max("n").alias("n"))
    best = met.where(_enough("shared", "n", percent)).groupBy("rep").agg(F.max_by("leader", F.struct("shared", "leader")).alias("leader"))
    return best.select(F.greatest("rep", "leader").alias("u"), F.least("rep", "leader").alias("v")).distinct()


def _block_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """u, v: pairs from different components in blocks that positions, sizes and components do not rule out."""
    mixed = lists.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("token")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
    entries = lists.join(mixed, "token").withColumn("band", band).withColumn("block", F.floor(F.col("pos") / 8))
    blocks = entries.groupBy("token", "band", "block").agg(
        F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("pos").alias("p0"), F.min("component").alias("c0"), F.max("component").alias("c1"),
    )
    a, b = blocks.alias("a"), blocks.alias("b")
    # one of the first SHARED shared entries: the overlap is at most what is left of either set and those before; a link
    # needs percent / (100 + percent) of both sizes
    needs = (F.col("a.n0") + F.col("b.n0")) * percent
    gives = (F.least(F.col("a.n1") - F.col("a.p0"), F.col("b.n1") - F.col("b.p0")) + (SHARED - 1)) * (100 + percent)
    open_blocks = a.join(
        b,
        (F.col("a.token") == F.col("b.token")) & (F.abs(F.col("a.band") - F.col("b.band")) <= 1)
        & ((F.col("a.band") < F.col("b.band")) | (F.col("a.band") == F.col("b.band")) & (F.col("a.block") <= F.col("b.block")))
        & (gives >= needs) & ~((F.col("a.c0") == F.col("a.c1")) & (F.col("b.c0") == F.col("b.c1")) & (F.col("a.c0") == F.col("b.c0"))),
    ).select("a.token", F.col("a.band").alias("band"), F.col("a.block").alias("block"), F.col("b.band").alias("band2"), F.col("b.block").alias("block2"))
    one = entries.select("token", "band", "block", F.col("rep").alias("r"), F.col("n").alias("rn"), F.col("pos").alias("rp"), F.col("component").alias("rc"))
    two = entries.select("token", F.col("band").alias("band2"), F.col("block").alias("block2"), F.col("rep").alias("s"), F.col("n").alias("sn"), F.col("pos").alias("sp"), F.col("component").alias("sc"))
    pairs = open_blocks.join(one, ["token", "band", "block"]).join(two, ["token", "band2", "block2"]).where(
        "rc <> sc"
    ).where(F.least("rn", "sn") * 100 >= F.greatest("rn", "sn") * percent).where(
        (F.least(F.col("rn") - F.col("rp"), F.col("sn") - F.col("sp")) + (SHARED - 1)) * (100 + percent) >= (F.col("rn") + F.col("sn")) * percent
    )
    met = pairs.select("token", F.greatest("r", "s").alias("u"), F.least("r", "s").alias("v"), F.greatest("rn", "sn").alias("n")).distinct().groupBy("u", "v").agg(F.count("*").alias("shared"), F.max("n").alias("n"))
    return met.where(_enough("shared", "n", percent)).select("u", "v")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def link(documents: DataFrame, percent: int = PERCENT, room: int = 1_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``documents``.

    Words are runs of other characters than space and 0x09 to 0x0D, with A-Z lower-cased. A text with fewer words than a
    shingle is one shingle; a null text, or one without words, has none and is linked with nothing. Two sets link when
    100 * shared >= ``percent`` * union. A component is named by its smallest id. Rows that repeat an id and its text give
    that many equal rows; an id with several texts is one document for each, which are linked through the id itself;
    a row with a null id is linked with nothing and keeps a null component. An empty table gives an empty result; other
    columns are not read.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.where("doc_id IS NOT NULL")
    sketch = materialise(sketches(known, frequent_shingles(known, room, percent), percent), "shingle-sketches", ROWS)
    sets = sketch.where("n > 0")
    classes = sets.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"))
    members = materialise(sets.select("doc_id", "f1", "f2", "n").join(classes, ["f1", "f2", "n"]).select("doc_id", "rep", "n").distinct(), "shingle-classes")
    entries = _rare_lists(sketch).unionByName(_common_lists(sketch))
    # copies stand for their class once; the class of an entry is that of its id and size
    lists = materialise(entries.join(members, ["doc_id", "n"]).select("token", "rep", "n", "pos").distinct(), "shingle-lists")
    # an id with several texts: every text's set must be found by the id, so each is compared
    tried = materialise(_leader_pairs(lists, percent), "leader-pairs")
    links = materialise(_verify(tried, known, percent), "leader-links", ROWS)
    twice = members.groupBy("doc_id").agg(F.count("*").alias("k"), F.min("rep").alias("v"), F.max("rep").alias("u")).where("k > 1").select("u", "v")
    labels = components(links.unionByName(twice))
    rest = materialise(_block_pairs(_labelled(lists, labels), percent).join(tried, ["u", "v"], "left_anti"), "block-pairs")
    more = None if rest.isEmpty() else materialise(_verify(rest, known, percent), "block-links", ROWS)
    if more is not None and not more.isEmpty():
        # the links that are left join whole components
        ends = _labelled(more.select(F.col("u").alias("rep"), "v"), labels).select(F.col("component").alias("u"), F.col("v").alias("rep"))
        joined = components(_labelled(ends, labels).select("u", F.col("component").alias("v")))
        top = joined.select(F.col("node").alias("component"), F.col("component").alias("top"))
        again = top.select(F.col("component").alias("node"), F.col("top").alias("component"))
        labels = labels.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component")).unionByName(again.join(labels, "node", "left_anti"))
    # copies follow their class, named by its smallest id; so only classes are nodes of the links
    named = _labelled(members, labels).groupBy("doc_id").agg(F.min("component").alias("component"))
    rows = sketch.select("doc_id", F.col("n").alias("n_shingles")).join(named, "doc_id", "left")
    lone = texts.where("doc_id IS NULL")
    # a row without an id still has its set counted
    blank = sketches(lone, (np.zeros(0, np.uint64), np.zeros(0, np.int64)), percent).select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component"))
    return rows.unionByName(blank).select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


ORACLE = f"""
WITH RECURSIVE d AS {shingle_sql("documents", "doc_id")},
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM d a JOIN d b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM shared JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
reach AS (SELECT doc_id AS node, doc_id AS top FROM documents UNION SELECT v, top FROM reach JOIN links ON links.u = reach.node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(top) FROM reach WHERE node = documents.doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id)
"""
