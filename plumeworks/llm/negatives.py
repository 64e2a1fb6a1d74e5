"""Hard negatives by exact search over lists that the anchors of a cluster share.

Vectors become integers, floor(256 * x). Anchors are clustered by direction and packed into chunks of near ones. For a chunk
with centre c whose members lie within the angle b of it, a candidate x at the angle t from c scores at most
|a| * |x| * cos(max(0, t - b)) with any member a. Candidates are sorted by |x| * cos(...) once for the chunk, and every member
walks that list in steps until its bound falls below what it still needs: the k-th score so far, or, for negatives, the
floor of the band. So the end of a walk is certified, and a cap on the score drops no row that belongs to the answer.

The walk runs twice: for the positives of each anchor, then, with their scores known, for the negatives in the band below each
of them. A bound travels along: the positives among the anchors of the chunk itself set a first k-th score before any list is read.

Work is dealt as a grid. Candidates are packed in stretches, anchors in chunks; about ``STRETCHES`` of the former and
``CHUNKS`` of the latter meet in one cell, a grouped task of bounded size, however many rows a label, a cluster or a vector
has (smaller tables get smaller cells, one for each task). So a stretch is sent once per ``CHUNKS`` chunks of anchors, and a
chunk once per ``STRETCHES`` stretches.

The centres are fitted on at most ``FIT_ROWS`` anchors, chosen by a hash of the id; they decide the work, never the result.

Defined results: rows take part that have an id, a label, and a vector of finite components, not empty; only vectors of the
anchor's dimension are compared; repeated identical rows count once, and rows sharing an id are all that id's own, so none
is a candidate of that id; ties go to the smaller id, and a candidate that comes with several vectors counts once for each of them;
an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Components of a stretch (2 MB), anchors of a chunk, and how many of each meet in a cell.
STRETCH, CHUNK, STRETCHES, CHUNKS = 1 << 18, 64, 16, 64
#: Components of a cell, at least.
LEAST_CELL = 1 << 16
#: Parts that the hits of an anchor are cut in before they come together.
PARTS = 16
#: Clusters, the rows their centres are fitted on, and the rounds of the fit.
CLUSTERS, FIT_ROWS, FIT_ROUNDS = 32, 4096, 8
#: List entries that a walk scores at a time.
STEP = 256
PACKED = "dim int, n int, ids binary, labels binary, data binary"


def labelled_numbers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, dim, v (array of long) of the rows that take part."""
    x = F.col(vector_col)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return (
        vectors.where(x.isNotNull() & (F.size(x) > 0) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & fine)
        .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.size(x).alias("dim"), F.transform(x, lambda c: F.floor(c.cast("double") * 256)).alias("v"))
        .distinct()
    )


def fitted_centres(rows: np.ndarray, clusters: int = CLUSTERS, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Unit centres of directions, by rounds of spherical k-means from spread-out rows."""
    x = rows.astype(np.float64)
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    centres = [x[0]]
    near = x @ x[0]
    for _ in range(min(clusters, len(x)) - 1):  # each next centre is the row farthest from those chosen
        centres.append(x[int(near.argmin())])
        near = np.maximum(near, x @ centres[-1])
    c = np.array(centres)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norms > 0, sums / np.maximum(norms, 1e-300), c)
    return c


def _clustered(anchors: DataFrame) -> DataFrame:
    """``anchors`` with ``cluster``: the nearest of the centres of the vector's dimension."""
    order = F.xxhash64("vec_id", "v")
    sample = [(r["dim"], r["v"]) for r in anchors.select("dim", "v", order.alias("o")).orderBy("o").limit(FIT_ROWS).collect()]
    centres = {d: fitted_centres(np.array([v for e, v in sample if e == d])) for d in {d for d, _ in sample}}

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            flat, ends = batch.column("v").flatten().to_numpy(), np.cumsum(dims.astype(np.int64))
            cluster = np.full(len(dims), -1, dtype=np.int32)  # dimensions that the sample has not seen are one cluster
            for dim in set(dims.tolist()) & set(centres):
                on = np.flatnonzero(dims == dim)
                cluster[on] = (flat[(ends[on] - dim)[:, None] + np.arange(dim)] @ centres[dim].T).argmax(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster)], [*batch.schema.names, "cluster"])

    return anchors.select("vec_id", "label", "dim", "v").mapInArrow(nearest, "vec_id long, label long, dim int, v array<long>, cluster int")


def _packed(rows: DataFrame, size: Callable[[int], int]) -> DataFrame:
    """Rows of at most ``size(dimension)`` vectors of one dimension and cluster, in the order they come."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        kind, n = None, 0

        def out() -> pa.RecordBatch:
            ids, labels, data = (np.concatenate(x) for x in zip(*held))
            columns = [pa.array([kind[0]], pa.int32()), pa.array([len(ids)], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (ids, labels, data)]]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["dim", "n", "ids", "labels", "data"])

        for batch in batches:
            ids, labels, dims, clusters = (batch.column(c).to_numpy() for c in ("vec_id", "label", "dim", "cluster"))
            flat, ends = batch.column("v").flatten().to_numpy(), np.cumsum(dims.astype(np.int64))
            changes = np.flatnonzero((dims[1:] != dims[:-1]) | (clusters[1:] != clusters[:-1])) + 1
            for at, end in zip([0, *changes], [*changes, len(ids)]):
                if at == end:
                    continue
                if held and kind != (dims[at], clusters[at]):
                    yield out()
                    n = 0
                kind = (dims[at], clusters[at])
                while at < end:
                    upto = min(end, at + size(int(kind[0])) - n)
                    held.append((ids[at:upto], labels[at:upto], flat[ends[at] - dims[at] : ends[upto - 1]]))
                    n, at = n + upto - at, upto
                    if n == size(int(kind[0])):
                        yield out()
                        n = 0
        if held:
            yield out()

    return rows.select("vec_id", "label", "dim", "v", "cluster").mapInArrow(pack, PACKED)


def _unpacked(table: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(dimension, ids, labels, vectors) of packed rows."""
    out = []
    for r in table.select(["dim", "ids", "labels", "data"]).to_pylist():
        ids, labels, data = (np.frombuffer(r[c], dtype=np.int64) for c in ("ids", "labels", "data"))
        out.append((r["dim"], ids, labels, data.reshape(len(ids), r["dim"])))
    return out


def _joined(parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates of a cell by dimension."""
    return {d: tuple(np.concatenate([p[i] for p in parts if p[0] == d]) for i in (1, 2, 3)) for d in {p[0] for p in parts}}


class SharedList:
    """The candidates of a cell, sorted by the angular bound that holds for every member of a chunk."""

    def __init__(self, members: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.members = members.astype(np.float64)
        self.lengths = np.linalg.norm(self.members, axis=1)
        x = vectors.astype(np.float64)
        # double arithmetic on whole numbers is exact below 2**53
        if max(1.0, np.abs(self.members).max()) * max(1.0, np.abs(x).max(initial=0.0)) * x.shape[1] >= 2**53:
            raise ValueError("components too large for exact scores")
        units = self.members / np.maximum(self.lengths, 1e-300)[:, None]
        centre = units.sum(0)
        norm = np.linalg.norm(centre)
        centre = centre / norm if norm > 1e-9 else units[0]
        spread = np.arccos(np.clip(units @ centre, -1, 1))[self.lengths > 0].max(initial=0.0)
        sizes = np.linalg.norm(x, axis=1)
        angles = np.arccos(np.clip(x @ centre / np.maximum(sizes, 1e-300), -1, 1))
        # the margins are far above rounding and far below a score of 1 apart from what bounds can't tell
        bounds = sizes * (np.cos(np.clip(angles - spread - 1e-6, 0, np.pi)) + 1e-9)
        order = np.lexsort((ids, -bounds))
        self.ids, self.labels, self.bounds, self.order, self.vectors = ids[order], labels[order], bounds[order], order, x

    def steps(self, needs) -> Iterator[tuple[np.ndarray, slice, np.ndarray]]:
        """(members, list places, scores) until no remaining candidate can reach what ``needs()`` says of each member."""
        for at in range(0, len(self.ids), STEP):
            active = np.flatnonzero(self.lengths * self.bounds[at] >= needs())
            if not len(active):
                return
            part = slice(at, min(at + STEP, len(self.ids)))
            yield active, part, self.members[active] @ self.vectors[self.order[part]].T


class Best:
    """The ``k`` best (score, id) of each slot so far; ties go to the smaller id."""

    def __init__(self, slots: int, k: int):
        self.k, self.floor = k, np.full(slots, -np.inf)
        self.slot, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, name: np.ndarray) -> None:
        able = score >= self.floor[slot]
        if not able.any():
            return
        slot, score, name = (np.concatenate([a, b[able]]) for a, b in ((self.slot, slot), (self.score, score), (self.id, name)))
        order = np.lexsort((name, -score, slot))
        slot, score, name = slot[order], score[order], name[order]
        begins = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(begins, np.diff(np.r_[begins, len(slot)]))
        keep = rank < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], name[keep]
        full = rank == self.k - 1
        self.floor[slot[full]] = score[full]


def walk_positives(shared: SharedList, anchor_ids: np.ndarray, anchor_labels: np.ndarray, k: int, known: np.ndarray) -> Best:
    """The best ``k`` candidates of each member's own label. ``known`` are scores that its k-th one is not below."""
    best = Best(len(anchor_ids), k)
    best.floor = known.copy()
    for active, part, scores in shared.steps(lambda: best.floor):
        same = (shared.labels[part] == anchor_labels[active, None]) & (shared.ids[part] != anchor_ids[active, None])
        row, col = np.nonzero(same & (scores >= best.floor[active, None]))
        best.add(active[row], scores[row, col], shared.ids[part][col])
    return best


def walk_negatives(shared: SharedList, anchor_labels: np.ndarray, levels: np.ndarray, k: int, low: int, high: int) -> Best:
    """For each member and level (a positive score, or NaN): the best ``k`` candidates of other labels in the band
    low * level <= 100 * score <= high * level. Slots are member * levels + level."""
    per = levels.shape[1]
    least = np.where(np.isnan(levels) | (low * levels > high * levels), np.inf, low * levels / 100 - 1e-6)
    best = Best(levels.size, k)
    need = lambda: np.maximum(best.floor.reshape(-1, per), least).min(1, initial=np.inf)
    for active, part, scores in shared.steps(need):
        other = shared.labels[part] != anchor_labels[active, None]
        for j in range(per):
            level = levels[active, j][:, None]
            fits = other & (100 * scores >= low * level) & (100 * scores <= high * level) & (scores >= best.floor[active * per + j][:, None])
            row, col = np.nonzero(fits)
            best.add(active[row] * per + j, scores[row, col], shared.ids[part][col])
    return best


def first_bounds(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """For each anchor of a chunk its k-th score among the chunk's other anchors of its label: never above the true one."""
    scores = vectors.astype(np.float64) @ vectors.T.astype(np.float64)
    scores[(labels[:, None] != labels) | (ids[:, None] == ids)] = -np.inf
    if len(ids) < k:
        return np.full(len(ids), -np.inf)
    return np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]


def _numbered(packed: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Packed rows, written once, with a ``number`` and a ``deal`` that spreads the rows of every task evenly; their count."""
    made = packed.withColumn("number", F.monotonically_increasing_id())
    written = materialise(made.withColumn("deal", F.shiftright("number", 33) + F.col("number").bitwiseAND(F.lit((1 << 33) - 1))), label)
    return written, written.count()


def _dealt(packed: DataFrame, own: str, groups: int, other: str, copies: int) -> DataFrame:
    """One side of the grid: its rows fall in ``groups`` lines, and each line crosses ``copies`` lines of the other side."""
    return packed.withColumn(own, F.pmod("deal", F.lit(groups))).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)).cast("array<long>")))


def _best(found: DataFrame, keys: list[str], k: int, out: str) -> DataFrame:
    """The ``k`` best hits of each key, cut to k in parts first."""
    hit = F.struct((-F.col("score")).alias("down"), F.col("id"))
    parts = found.groupBy(*keys, F.pmod(F.xxhash64("id"), F.lit(PARTS)).alias("part")).agg(F.slice(F.array_sort(F.collect_list(hit)), 1, k).alias("top"))
    return parts.groupBy(*keys).agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias(out))


def mine(
    vectors: DataFrame, positives: int = 5, negatives: int = 3, every: int = 50, low: int = 50, high: int = 95,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``. For each of an anchor's ``positives`` best rows of its own label:
    the ``negatives`` best rows of other labels whose score is ``low`` to ``high`` percent of the positive's.
    """
    if min(positives, negatives, every) < 1:
        raise ValueError("positives, negatives and every must be at least 1")
    spark = vectors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = labelled_numbers(vectors, id_col, vector_col, label_col)
    # the order makes packing repeatable; a candidate's place has no other meaning
    plain = rows.withColumn("cluster", F.lit(0)).sortWithinPartitions("dim", "vec_id", "v")
    stretches, n_stretches = _numbered(_packed(plain, lambda dim: max(1, STRETCH // dim)), "negative-stretches")
    anchors = materialise(_clustered(rows.where(F.col("vec_id") % every == 0)), "negative-anchors")
    near = anchors.repartitionByRange(max(1, tasks // 4), "dim", "cluster", "label", F.xxhash64("vec_id")).sortWithinPartitions("dim", "cluster", "label", "vec_id", "v")
    chunks, n_chunks = _numbered(_packed(near, lambda dim: CHUNK), "negative-chunks")
    # cells of small tables are smaller, but not so small that the best of each cell outnumber the candidates it holds
    held = stretches.agg(F.sum(F.col("n").cast("long") * F.col("dim"))).first()[0] or 0
    lines = max(1, -(-held // (STRETCH * STRETCHES)), min(n_stretches, tasks, -(-held // LEAST_CELL)))
    columns = max(1, -(-n_chunks // CHUNKS))
    cells = _dealt(stretches, "line", lines, "column", columns)

    def met(members: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        sides = cells.groupBy("line", "column"), _dealt(members, "column", columns, "line", lines).groupBy("line", "column")
        return sides[0].cogroup(sides[1]).applyInArrow(fn, schema)

    def table(found: list[list[np.ndarray]], names: list[str]) -> pa.Table:
        parts = zip(*found) if found else [[np.zeros(0, np.int64)]] * len(names)
        return pa.table([pa.array(np.concatenate(list(p)), pa.int64()) for p in parts], names=names)

    def find_positives(cell: pa.Table, members: pa.Table) -> pa.Table:
        found, candidates = [], _joined(_unpacked(cell))
        for number, (dim, ids, labels, data) in zip(members["number"].to_pylist(), _unpacked(members)):
            if dim in candidates:
                best = walk_positives(SharedList(data, *candidates[dim]), ids, labels, positives, first_bounds(ids, labels, data, positives))
                found.append([np.full(len(best.slot), number), best.slot, ids[best.slot], best.id, best.score.astype(np.int64)])
        return table(found, ["chunk", "place", "anchor_id", "id", "score"])

    first = met(chunks, find_positives, "chunk long, place long, anchor_id long, id long, score long")
    chosen = materialise(_best(first, ["chunk", "place", "anchor_id"], positives, "top"), "negative-positives")
    levels = chosen.groupBy(F.col("chunk").alias("number")).agg(F.collect_list(F.struct("place", F.transform("top", lambda t: -t["down"]).alias("scores"))).alias("levels"))

    def find_negatives(cell: pa.Table, members: pa.Table) -> pa.Table:
        found, candidates = [], _joined(_unpacked(cell))
        for number, kept, (dim, ids, labels, data) in zip(members["number"].to_pylist(), members["levels"].to_pylist(), _unpacked(members)):
            if dim in candidates:
                wanted = np.full((len(ids), positives), np.nan)
                for r in kept:
                    wanted[r["place"], : len(r["scores"])] = r["scores"]
                best = walk_negatives(SharedList(data, *candidates[dim]), labels, wanted, negatives, low, high)
                found.append([np.full(len(best.slot), number), best.slot // positives, best.slot % positives, best.id, best.score.astype(np.int64)])
        return table(found, ["chunk", "place", "level", "id", "score"])

    second = met(chunks.join(levels, "number"), find_negatives, "chunk long, place long, level long, id long, score long")
    below = _best(second, ["chunk", "place", "level"], negatives, "below")
    each = chosen.select("chunk", "place", "anchor_id", F.posexplode("top").alias("level", "positive")).withColumn("level", F.col("level").cast("long"))
    return (
        each.join(below, ["chunk", "place", "level"])
        .select("anchor_id", F.col("positive.id").alias("positive_id"), (-F.col("positive.down")).alias("positive_score"), F.posexplode("below").alias("p", "n"))
        .select("anchor_id", "positive_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"), "positive_score", (-F.col("n.down")).alias("negative_score"))
    )
