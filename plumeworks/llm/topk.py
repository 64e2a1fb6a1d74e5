"""Exact top-k inner-product search by block-at-a-time pruning.

Vectors become integers, floor(256 * x). Candidates are laid out in blocks of a document range; a block keeps its
vectors (a small forward index) and the maximum and minimum of every dimension. For a query, the sum over dimensions of
the larger of q*max and q*min bounds every score in the block. Blocks are taken in the order of these bounds and scored
whole, until no remaining bound reaches the k-th score so far; a block whose bound only equals it is still scored, for
a smaller id may win the tie.

Queries are packed into chunks as well, and chunks meet stretches of candidate blocks by an equi-join on the chunk's
number: a stated query set against all rows, in blocks. Each meeting keeps k rows per query, and a partial aggregate
cuts them to k again before the shuffle.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part; only vectors of the
query's dimension are its candidates; repeated identical rows count once; rows sharing an id are all that id's own, so
none of them is a candidate of that id; ties go to the smaller id; an empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Vectors of a block, of a stretch of blocks (one row of packed data), and queries of a chunk.
BLOCK, STRETCH, CHUNK = 64, 4096, 256


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, dim, v (array of long) of the vectors that take part."""
    x = F.col(vector_col)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return (
        vectors.where(x.isNotNull() & (F.size(x) > 0) & F.col(id_col).isNotNull() & fine)
        .select(F.col(id_col).cast("long").alias("vec_id"), F.size(x).alias("dim"), F.transform(x, lambda c: F.floor(c.cast("double") * 256)).alias("v"))
        .distinct()
    )


def _packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows of at most ``size`` vectors of one dimension: dim, ids, data. Vectors of near ids stand together."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def out(dim: int, whole: bool) -> Iterator[pa.RecordBatch]:
            ids, data = (np.concatenate(x) for x in zip(*held[dim]))
            stop = len(ids) if whole else len(ids) // size * size
            for at in range(0, stop, size):
                end = min(at + size, stop)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([ids[at:end].tobytes()], pa.binary()), pa.array([data[at:end].tobytes()], pa.binary())], ["dim", "ids", "data"]
                )
            held[dim] = [(ids[stop:], data[stop:])] if stop < len(ids) else []

        for batch in batches:
            ids, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            flat = batch.column(2).flatten().to_numpy()
            ends = np.cumsum(dims.astype(np.int64))
            for dim in np.unique(dims):
                on = np.flatnonzero(dims == dim)
                data = flat[(ends[on] - dim)[:, None] + np.arange(dim)] if len(on) < len(dims) else flat.reshape(-1, dim)
                held.setdefault(int(dim), []).append((ids[on], data))
                if sum(len(x[0]) for x in held[int(dim)]) >= size:
                    yield from out(int(dim), False)
        for dim in list(held):
            if held[dim]:
                yield from out(dim, True)

    packed = rows.select("vec_id", "dim", "v").mapInArrow(pack, "dim int, ids binary, data binary")
    return packed.select(F.col("dim").alias(f"{name}_dim"), F.col("ids").alias(f"{name}_ids"), F.col("data").alias(f"{name}_data"))


def block_search(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, block: int = BLOCK) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, ids, scores) of the k best of each query among ``x``, by pruned blocks."""
    # near vectors side by side make the maxima tight: order by the nearest of a few spread-out members
    pivots = x[np.linspace(0, len(x) - 1, min(len(x), max(1, len(x) // block))).astype(int)].astype(np.float64)
    order = np.lexsort((ids, (x @ pivots.T).argmax(1)))
    x, ids = x[order].astype(np.float64), ids[order]
    starts = np.arange(0, len(x), block)
    high, low = np.maximum.reduceat(x, starts), np.minimum.reduceat(x, starts)
    # double arithmetic on whole numbers is exact below 2**53
    q = q.astype(np.float64)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    turn = np.argsort(-bounds, axis=1, kind="stable")
    best = [(np.full(0, 0.0), np.zeros(0, dtype=np.int64)) for _ in q]
    active = np.arange(len(q))
    for step in range(len(starts)):
        if not len(active):
            break
        still = []
        nth = turn[active, step]
        for b in np.unique(nth):
            who = active[nth == b]
            members = slice(starts[b], min(starts[b] + block, len(x)))
            scores = q[who] @ x[members].T
            for row, i in enumerate(who):
                have, names = best[i]
                floor = have[-1] if len(have) >= k else -np.inf
                if bounds[i, b] < floor:
                    continue  # and so are all later blocks
                other = ids[members] != q_ids[i]
                s, n = np.concatenate([have, scores[row][other]]), np.concatenate([names, ids[members][other]])
                top = np.lexsort((n, -s))[:k]
                best[i] = (s[top], n[top])
                still.append(i)
        active = np.array(still, dtype=np.int64)
    return [(np.full(len(s), q_ids[i]), n, s.astype(np.int64)) for i, (s, n) in enumerate(best) if len(s)]


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each row whose id is divisible by ``every``, among all other rows."""
    if k < 1:
        raise ValueError("k must be at least 1")
    rows = whole_numbers(vectors, id_col, vector_col)
    # sorted, so that a task run again packs the same rows the same way
    stretches = _packed(rows.sortWithinPartitions("dim", "vec_id"), STRETCH, "c")
    chunks = materialise(
        _packed(rows.where(F.col("vec_id") % every == 0).sortWithinPartitions("dim", "vec_id"), CHUNK, "q").withColumn("chunk", F.monotonically_increasing_id()), "query-chunks"
    )
    lanes = chunks.select("chunk", F.col("q_dim").alias("c_dim"))
    # the numbers of the chunks, one per CHUNK queries, go to every stretch; their data follow by an equi-join
    meetings = stretches.join(lanes, "c_dim").join(chunks, "chunk")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dim = r["q_dim"]
                q_ids, ids = (np.frombuffer(r[n], dtype=np.int64) for n in ("q_ids", "c_ids"))
                q, x = (np.frombuffer(r[n], dtype=np.int64).reshape(-1, dim) for n in ("q_data", "c_data"))
                if max(1, np.abs(q).max()) * float(max(1, np.abs(x).max())) * dim >= 2**53:
                    raise ValueError("components too large for exact scores")
                found = block_search(q, q_ids, x, ids, k)
                if found:
                    columns = [np.concatenate(c) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    found = meetings.select("q_dim", "q_ids", "q_data", "c_ids", "c_data").mapInArrow(search, "query_id long, vec_id long, score long").distinct()
    hits = F.struct((-F.col("score")).alias("down"), F.col("vec_id"))
    # k rows per query and stretch: cut to k in 64 parts of a query first, then over the parts
    parts = found.groupBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("part")).agg(F.slice(F.array_sort(F.collect_list(hits)), 1, k).alias("top"))
    top = parts.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
    return top.select("query_id", F.posexplode("top").alias("p", "t")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.down")).alias("score"))
