"""Boosted trees with an L2 penalty on leaves, and forests whose bootstraps are balanced tree by tree.

Features are binned once into bytes and packed into blocks of rows. Trees grow level by level: for all open nodes of all trees
that grow side by side (the rows of a grid, or a batch of a forest) one pass over the blocks adds up histograms of three numbers
by node, feature and bin, and the best split of every node is read from their running sums.

Boosting sums gradients, hessians and counts of the log loss; a leaf is -G / (H + l2), times the learning rate, and a tree keeps
at most ``MAX_LEAVES`` leaves, best splits first. A forest draws Poisson(1) weights for each tree from a hash of the row, scales
them so that both classes weigh the same within that tree, and looks at a hashed choice of features in every node.

Where the passes run depends on the rows. Up to ``LOCAL_ROWS`` the packed bytes go to every task once and each task grows whole
trees on them; beyond that, each level is one job: partial histograms by task, summed and searched by node where they meet, and
only one best split per node comes to the driver. Boosted scores are then written every ``KEEP_ROUNDS`` rounds, which cuts the
lineage; in between they are recomputed from the rounds since. Both ways share every line that decides about a tree.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from ..sources.tables import is_there, publish

#: Bins of a feature; distinct values up to which every value has its own bin.
BINS = 255
#: Leaves of a boosted tree, the least rows of one, and the least sum of hessians of one.
MAX_LEAVES, BOOST_LEAF, LEAST_HESSIAN = 31, 20, 1e-3
#: Rows that are fitted from one copy of the packed bytes; rows of a block; trees of a forest that grow side by side.
LOCAL_ROWS, BLOCK_ROWS, BATCH_TREES = 20_000, 65_536, 32
#: Rounds of boosting between two writes of the scores.
KEEP_ROUNDS = 16
#: Running shares of the Poisson distribution with mean 1.
POISSON = np.cumsum(np.exp(-1.0) / np.array([1.0, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880]))


@dataclass
class Tree:
    """Nodes by number, the root first. ``feature`` is -1 in a leaf; bins up to ``cut`` go left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    #: Weighted totals of the first two numbers at the root (gradients and hessians, or the two classes).
    root: tuple[float, float]

    @property
    def depth(self) -> int:
        deep = np.zeros(len(self.feature), dtype=int)
        for n in range(len(self.feature)):  # children come after their parents
            if self.feature[n] >= 0:
                deep[[self.left[n], self.right[n]]] = deep[n] + 1
        return int(deep.max())

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        at = np.zeros(len(bins), dtype=np.int64)
        rows = np.arange(len(bins))
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                return at
            rows_in = rows[inner]
            here = at[inner]
            at[inner] = np.where(bins[rows_in, self.feature[here]] <= self.cut[here], self.left[here], self.right[here])

    def uses(self, feature: int) -> bool:
        return bool((self.feature == feature).any())

    def to_json(self) -> str:
        return json.dumps({k: np.asarray(getattr(self, k)).tolist() for k in ("feature", "cut", "left", "right", "value", "root")})

    @staticmethod
    def from_json(text: str) -> Tree:
        d = json.loads(text)
        return Tree(*[np.array(d[k], dtype=np.int64) for k in ("feature", "cut", "left", "right")], np.array(d["value"]), tuple(d["root"]))


@dataclass
class Ensemble:
    """Trees over the same bins. ``start`` is the log odds that boosting begins with, or None for a forest."""

    cuts: list[np.ndarray]
    trees: list[Tree]
    start: float | None

    def binned(self, values: np.ndarray) -> np.ndarray:
        return bin_values(values, self.cuts)

    def raw(self, bins: np.ndarray, trees: Sequence[Tree] | None = None) -> np.ndarray:
        total = np.zeros(len(bins))
        for t in self.trees if trees is None else trees:
            total += t.value[t.leaves(bins)]
        return total

    def probability_of(self, raw: np.ndarray) -> np.ndarray:
        """Class 1, from the sum of the trees' values."""
        return raw / len(self.trees) if self.start is None else 1.0 / (1.0 + np.exp(-np.clip(self.start + raw, -700, 700)))

    def probability(self, features: Column) -> Column:
        """``features``: an array of filled numbers. Rows are scored by Arrow batches."""
        spark = SparkSession.active()
        shared = spark.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def scored(x: pd.Series) -> pd.Series:
            ensemble = shared.value
            values = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(ensemble.cuts)))
            return pd.Series(ensemble.probability_of(ensemble.raw(ensemble.binned(values))))

        return scored(features)

    def rows(self) -> list[tuple]:
        """number, tree as text; the bins and the start as number -1."""
        head = json.dumps({"cuts": [c.tolist() for c in self.cuts], "start": self.start})
        return [(-1, head), *[(i, t.to_json()) for i, t in enumerate(self.trees)]]

    @staticmethod
    def from_rows(rows: Sequence[tuple]) -> Ensemble:
        (_, head), *trees = sorted(rows)
        d = json.loads(head)
        return Ensemble([np.array(c, dtype=float) for c in d["cuts"]], [Tree.from_json(t) for _, t in trees], d["start"])


def bin_values(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The number of cuts below each value."""
    return np.stack([np.searchsorted(c, values[:, i]) for i, c in enumerate(cuts)], axis=1).astype(np.uint8)


def feature_cuts(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Where bins end: midway between values if a feature has few, else at quantiles. Two aggregations over ``df``."""
    counts = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in features]).first()
    few = {c for c in features if counts[c] <= BINS * 0.8}  # the estimate errs by a few percent; either way is right
    shares = [i / BINS for i in range(1, BINS)]
    found = df.agg(*[(F.sort_array(F.collect_set(c)) if c in few else F.percentile_approx(c, shares, 100_000)).alias(c) for c in features]).first()
    out = []
    for c in features:
        v = np.unique(np.array(found[c] or [], dtype=float))
        out.append((v[1:] + v[:-1]) / 2 if c in few else v)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of 64 bits."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bootstrap(marks: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson(1) numbers that depend on the row and the tree alone."""
    own = _mixed(np.array([(seed << 32) + tree], dtype=np.uint64))
    share = (_mixed(marks.view(np.uint64) ^ own) >> np.uint64(11)).astype(float) / 2.0**53
    return np.searchsorted(POISSON, share).astype(float)


class Block:
    """Packed rows of one table: bins (rows x features), labels, row marks."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, marks: np.ndarray):
        self.bins, self.y, self.marks = bins, y, marks
        self.flat = bins.astype(np.int64) + np.arange(bins.shape[1]) * (BINS + 1)

    def histogram(self, place: np.ndarray, n: int, first: np.ndarray, second: np.ndarray, counted: np.ndarray) -> np.ndarray:
        """Sums of the three numbers by place (-1 for none), feature and bin."""
        width = self.bins.shape[1] * (BINS + 1)
        on = np.flatnonzero((place >= 0) & counted)
        index = (place[on, None] * width + self.flat[on]).ravel()
        sums = [np.bincount(index, np.repeat(v[on], self.bins.shape[1]), n * width) for v in (first, second)]
        return np.stack([*sums, np.bincount(index, minlength=n * width)], axis=-1).reshape(n, self.bins.shape[1], BINS + 1, 3)


@dataclass
class Growing:
    """A tree while it grows. ``rule`` holds the limits; forests also their seed, tree number and class scales."""

    rule: dict

    def __post_init__(self):
        self.feature, self.cut, self.left, self.right, self.depth, self.total, self.gain, self.open = [-1], [0], [-1], [-1], [0], [None], [0.0], [0]

    def partial(self) -> Tree:
        return Tree(*[np.array(x, dtype=np.int64) for x in (self.feature, self.cut, self.left, self.right)], np.zeros(len(self.feature)), (0.0, 0.0))

    def places(self, bins: np.ndarray) -> np.ndarray:
        """Which of the open nodes each row is in, or -1."""
        number = np.full(len(self.feature), -1)
        number[self.open] = np.arange(len(self.open))
        return number[self.partial().leaves(bins)]

    def take(self, splits: list[tuple]) -> None:
        """One level: the best split of each open node becomes two children."""
        after = []
        for node, (total, gain, feature, cut, left) in zip(self.open, splits):
            if self.total[node] is None:
                self.total[node] = total
            if feature < 0:
                continue
            first = len(self.feature)
            right = tuple(t - x for t, x in zip(total, left))
            for child in (left, right):
                for column, x in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.depth, self.depth[node] + 1), (self.total, child), (self.gain, 0.0)):
                    column.append(x)
            self.feature[node], self.cut[node], self.left[node], self.right[node], self.gain[node] = feature, cut, first, first + 1, gain
            after += [n for n in (first, first + 1) if self.depth[n] < self.rule["max_depth"] and self.total[n][2] >= self.rule["least_split"]]
        self.open = after

    def done(self) -> Tree:
        rule = self.rule
        if rule["kind"] == "boost":
            kept, ready = set(), [(-self.gain[0], 0)] if self.feature[0] >= 0 else []
            while ready and len(kept) < rule["max_leaves"] - 1:  # best splits first
                _, node = heapq.heappop(ready)
                kept.add(node)
                for child in (self.left[node], self.right[node]):
                    if self.feature[child] >= 0:
                        heapq.heappush(ready, (-self.gain[child], child))
            value = [-rule["rate"] * t[0] / (t[1] + rule["l2"]) if t[1] + rule["l2"] > 0 else 0.0 for t in self.total]
        else:
            kept = {n for n, f in enumerate(self.feature) if f >= 0}
            value = [t[1] / (t[0] + t[1]) if t[0] + t[1] > 0 else 0.0 for t in self.total]
        # nodes below a split that is not kept are left out
        order, stack = [], [0]
        while stack:
            node = stack.pop(0)
            order.append(node)
            if node in kept:
                stack += [self.left[node], self.right[node]]
        number = {n: i for i, n in enumerate(order)}
        pick = lambda column, leaf: np.array([column[n] if n in kept else leaf for n in order], dtype=np.int64)
        sides = [np.array([number[column[n]] if n in kept else -1 for n in order], dtype=np.int64) for column in (self.left, self.right)]
        return Tree(pick(self.feature, -1), pick(self.cut, 0), *sides, np.array([value[n] for n in order]), tuple(float(x) for x in self.total[0][:2]))


def best_split(hist: np.ndarray, rule: dict, node: int) -> tuple:
    """(totals, gain, feature or -1, cut, left totals) of one node from its histogram (features x bins x 3). Ties go to the
    first feature and the lowest cut."""
    left = hist.cumsum(axis=1)
    total = left[0, -1]
    right = total - left
    a, b, n = (left[..., i] for i in range(3))
    c, d, m = (right[..., i] for i in range(3))
    least = rule["least_leaf"]
    allowed = (n >= least) & (m >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        if rule["kind"] == "boost":
            l2 = rule["l2"]
            allowed &= (b >= LEAST_HESSIAN) & (d >= LEAST_HESSIAN)
            gain = a * a / (b + l2) + c * c / (d + l2) - total[0] ** 2 / (total[1] + l2)
            gain = np.where(allowed & (gain > 1e-12), gain, -np.inf)
        else:
            gain = (a * a + b * b) / (a + b) + (c * c + d * d) / (c + d) - (total[0] ** 2 + total[1] ** 2) / (total[0] + total[1])
            pure = min(total[0], total[1]) <= 1e-12 * (total[0] + total[1])
            gain = np.where(allowed & (not pure), np.maximum(gain, 0.0), -np.inf)
            gain = np.where(_looked_at(hist, gain, rule, node)[:, None], gain, -np.inf)
    totals = tuple(float(x) for x in total)
    at = int(gain.argmax())
    if gain.flat[at] == -np.inf:
        return totals, 0.0, -1, 0, None
    feature, cut = divmod(at, gain.shape[1])
    return totals, float(gain.flat[at]), feature, cut, tuple(float(x) for x in left[feature, cut])


def _looked_at(hist: np.ndarray, gain: np.ndarray, rule: dict, node: int) -> np.ndarray:
    """The features a forest node may split on: the first few, in a hashed order, that vary in it; if none of them can be
    split, the next that can."""
    f = np.arange(len(hist), dtype=np.uint64)
    own = _mixed(np.array([(rule["seed"] << 32) + rule["tree"]], dtype=np.uint64)) ^ _mixed(np.array([node + 1], dtype=np.uint64))
    order = np.argsort(_mixed(own ^ _mixed(f + np.uint64(1 << 40))), kind="stable")
    order = order[((hist[..., 2] > 0).sum(1) > 1)[order]]
    wanted = max(1, int(len(hist) ** 0.5))
    able = gain.max(1) > -np.inf
    chosen = order[:wanted]
    if not able[chosen].any():
        chosen = order[able[order]][:1]
    out = np.zeros(len(hist), dtype=bool)
    out[chosen] = True
    return out


def _numbers(block: Block, growing: Growing, score: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The two numbers of every row that a tree sums, and which rows count."""
    rule = growing.rule
    if rule["kind"] == "boost":
        p = 1.0 / (1.0 + np.exp(-np.clip(score, -700, 700)))
        return p - block.y, p * (1 - p), np.ones(len(p), dtype=bool)
    drawn = bootstrap(block.marks, rule["seed"], rule["tree"])
    return drawn * (block.y == 0) * rule["scale"][0], drawn * (block.y == 1) * rule["scale"][1], drawn > 0


class LocalRows:
    """All rows in the memory of this process."""

    def __init__(self, block: Block):
        self.block = block

    def class_totals(self, rules: list[dict]) -> list[tuple[float, float]]:
        return [drawn_totals(self.block, r) for r in rules]

    def begin(self, start: float, n: int) -> None:
        self.scores = np.full((n, len(self.block.y)), start)

    def add(self, number: int, tree: Tree) -> None:
        self.scores[number] += tree.value[tree.leaves(self.block.bins)]

    def round_done(self) -> None:
        pass

    def level(self, growing: dict[int, Growing]) -> dict[int, list[tuple]]:
        out = {}
        for number, g in growing.items():
            numbers = _numbers(self.block, g, self.scores[number] if g.rule["kind"] == "boost" else None)
            hist = self.block.histogram(g.places(self.block.bins), len(g.open), *numbers)
            out[number] = [best_split(h, g.rule, node) for h, node in zip(hist, g.open)]
        return out


def drawn_totals(block: Block, rule: dict) -> tuple[float, float]:
    drawn = bootstrap(block.marks, rule["seed"], rule["tree"])
    return float(drawn[block.y == 0].sum()), float(drawn[block.y == 1].sum())


class SparkRows:
    """Rows in packed blocks of a table; every question is one job."""

    def __init__(self, blocks: DataFrame, features: int):
        self.blocks, self.features, self.spark = blocks, features, blocks.sparkSession
        self.pending: list[list[Tree]] = []
        self.rounds = 0

    def class_totals(self, rules: list[dict]) -> list[tuple[float, float]]:
        features = self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(rules), 2))
            for block, _ in _unpacked(batches, features):
                sums += [drawn_totals(block, r) for r in rules]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(rules)), pa.int32()), pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["rule", "a", "b"])

        found = self.blocks.mapInArrow(run, "rule int, a double, b double").groupBy("rule").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        by_rule = {r["rule"]: (r["a"], r["b"]) for r in found.collect()}  # one row for each tree of the batch
        return [by_rule.get(i, (0.0, 0.0)) for i in range(len(rules))]

    def begin(self, start: float, n: int) -> None:
        self.pending = [[] for _ in range(n)]
        self.start = start

    def add(self, number: int, tree: Tree) -> None:
        self.pending[number].append(tree)

    def round_done(self) -> None:
        self.rounds += 1
        if self.rounds % KEEP_ROUNDS == 0:
            scored = _with_scores(self.pending, self.start, self.features)
            self.blocks = materialise(self.blocks.mapInArrow(lambda batches: _packed_again(batches, scored), PACKED), "boost-scores")
            self.pending = [[] for _ in self.pending]

    def level(self, growing: dict[int, Growing]) -> dict[int, list[tuple]]:
        features = self.features
        scored = _with_scores(self.pending, getattr(self, "start", 0.0), features)
        shape = (features, BINS + 1, 3)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for block, _, scores in scored(batches):
                for number, g in growing.items():
                    numbers = _numbers(block, g, scores[number] if g.rule["kind"] == "boost" else None)
                    hist = block.histogram(g.places(block.bins), len(g.open), *numbers)
                    sums[number] = sums[number] + hist if number in sums else hist
            for number, hist in sums.items():
                keys = [pa.array([number] * len(hist), pa.int32()), pa.array(range(len(hist)), pa.int32())]
                yield pa.RecordBatch.from_arrays([*keys, pa.array([h.tobytes() for h in hist], pa.binary())], ["number", "place", "hist"])

        def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, total = None, None

            def found() -> pa.RecordBatch:
                number, place = key
                g = growing[number]
                split = best_split(total.reshape(shape), g.rule, g.open[place])
                return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([place], pa.int32()), pa.array([json.dumps(split)])], ["number", "place", "split"])

            for batch in batches:
                for number, place, hist in zip(*[c.to_pylist() for c in batch.columns]):
                    if (number, place) != key:
                        if key is not None:
                            yield found()
                        key, total = (number, place), np.zeros(features * (BINS + 1) * 3)
                    total = total + np.frombuffer(hist)
            if key is not None:
                yield found()

        sums = self.blocks.mapInArrow(partial, "number int, place int, hist binary").repartition("number", "place").sortWithinPartitions("number", "place")
        # one row for each open node
        rows = sorted((r["number"], r["place"], r["split"]) for r in sums.mapInArrow(searched, "number int, place int, split string").collect())
        out: dict[int, list[tuple]] = {n: [] for n in growing}
        for number, _, split in rows:
            total, gain, feature, cut, left = json.loads(split)
            out[number].append((tuple(total), gain, feature, cut, left and tuple(left)))
        return out


PACKED = "bins binary, y binary, marks binary, scores binary"


def _unpacked(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[Block, np.ndarray]]:
    for batch in batches:
        for bins, y, marks, scores in zip(*[c.to_pylist() for c in batch.columns]):
            yield Block(np.frombuffer(bins, np.uint8).reshape(-1, features), np.frombuffer(y, np.uint8).astype(float), np.frombuffer(marks, np.int64)), np.frombuffer(scores)


def _with_scores(pending: list[list[Tree]], start: float, features: int) -> Callable:
    """(block, kept scores, scores now) of packed rows: the kept ones, or the start, and the rounds since."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
        for block, kept in _unpacked(batches, features):
            now = kept.reshape(len(pending), -1).copy() if len(kept) else np.full((len(pending), len(block.y)), start)
            for number, trees in enumerate(pending):
                for t in trees:
                    now[number] += t.value[t.leaves(block.bins)]
            yield block, kept, now

    return run


def _packed_again(batches: Iterator[pa.RecordBatch], scored: Callable) -> Iterator[pa.RecordBatch]:
    for block, _, now in scored(batches):
        columns = [block.bins.tobytes(), block.y.astype(np.uint8).tobytes(), block.marks.tobytes(), now.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], ["bins", "y", "marks", "scores"])


def packed(df: DataFrame, features: Sequence[str], label: Column, marks: Column, cuts: list[np.ndarray]) -> DataFrame:
    """Blocks of at most ``BLOCK_ROWS`` binned rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out() -> pa.RecordBatch:
            columns = [np.concatenate(c).tobytes() for c in zip(*held)]
            held.clear()
            return pa.RecordBatch.from_arrays([*[pa.array([c], pa.binary()) for c in columns], pa.array([b""], pa.binary())], ["bins", "y", "marks", "scores"])

        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cuts))
            if len(values):
                held.append((bin_values(values, cuts), batch.column(1).to_numpy().astype(np.uint8), batch.column(2).to_numpy()))
            if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                yield out()
        if held:
            yield out()

    return df.select(F.array(*features).alias("x"), label.cast("int").alias("y"), marks.alias("m")).mapInArrow(run, PACKED)


def _one_block(rows: Sequence, features: int) -> Block:
    joined = [b"".join(bytes(r[c]) for r in rows) for c in ("bins", "y", "marks")]
    return Block(np.frombuffer(joined[0], np.uint8).reshape(-1, features), np.frombuffer(joined[1], np.uint8).astype(float), np.frombuffer(joined[2], np.int64))


def grow(rows: LocalRows | SparkRows, rules: dict[int, dict]) -> dict[int, Tree]:
    """Trees side by side, a level of all of them at a time."""
    growing = {n: Growing(r) for n, r in rules.items()}
    while True:
        active = {n: g for n, g in growing.items() if g.open}
        if not active:
            return {n: g.done() for n, g in growing.items()}
        for n, splits in rows.level(active).items():
            growing[n].take(splits)


class RoundJournal:
    """Rounds of boosting that are done, ``KEEP_ROUNDS`` at a time, each part published by a rename."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def load(self, grid_rows: int) -> list[list[Tree]]:
        out: list[list[Tree]] = [[] for _ in range(grid_rows)]
        part = 0
        while is_there(self.spark, f"{self.path}/{part:06d}"):
            for r in sorted(self.spark.read.parquet(f"{self.path}/{part:06d}").collect(), key=lambda r: (r["item"], r["number"])):
                out[r["item"]].append(Tree.from_json(r["tree"]))
            part += 1
        return out

    def keep(self, part: int, grown: list[list[Tree]]) -> None:
        rows = [(i, n, t.to_json()) for i, trees in enumerate(grown) for n, t in enumerate(trees) if n // KEEP_ROUNDS == part]
        made = self.spark.createDataFrame(rows, "item int, number int, tree string").coalesce(1)
        publish(self.spark, f"{self.path}/{part:06d}", lambda path: made.write.parquet(path))


def boost(rows: LocalRows | SparkRows, grid: Sequence[dict], start: float, journal: RoundJournal | None = None) -> list[list[Tree]]:
    """The trees of every grid row (learning_rate, max_depth, max_iter, l2_regularization), round by round. Rounds that the
    ``journal`` has are not grown again."""
    rows.begin(start, len(grid))
    out = journal.load(len(grid)) if journal else [[] for _ in grid]
    for n, trees in enumerate(out):
        for tree in trees:
            rows.add(n, tree)
    rules = [{"kind": "boost", "max_leaves": p.get("max_leaf_nodes", MAX_LEAVES), "max_depth": p["max_depth"], "l2": p.get("l2_regularization", 0.0), "rate": p["learning_rate"], "least_leaf": p.get("min_samples_leaf", BOOST_LEAF), "least_split": 2 * p.get("min_samples_leaf", BOOST_LEAF)} for p in grid]
    for r in range(max(len(t) for t in out), max(p["max_iter"] for p in grid)):
        for n, tree in grow(rows, {n: rules[n] for n, p in enumerate(grid) if r < p["max_iter"]}).items():
            out[n].append(tree)
            rows.add(n, tree)
        rows.round_done()
        if journal and (r + 1) % KEEP_ROUNDS == 0:
            journal.keep(r // KEEP_ROUNDS, out)
    return out


def plant(rows: LocalRows | SparkRows, params: dict, numbers: Sequence[int], seed: int) -> list[Tree]:
    """Trees of a forest (max_depth, min_samples_leaf, min_samples_split), a batch at a time."""
    base = {"kind": "forest", "max_depth": params["max_depth"], "least_leaf": params.get("min_samples_leaf", 1), "least_split": params.get("min_samples_split", 2), "seed": seed}
    out: list[Tree] = []
    for at in range(0, len(numbers), BATCH_TREES):
        rules = [base | {"tree": t} for t in numbers[at : at + BATCH_TREES]]
        # both classes weigh the same within the rows drawn for a tree
        for rule, (a, b) in zip(rules, rows.class_totals(rules)):
            rule["scale"] = ((a + b) / (2 * a) if a else 0.0, (a + b) / (2 * b) if b else 0.0)
        grown = grow(rows, dict(enumerate(rules)))
        out += [grown[i] for i in range(len(rules))]
    return out


def _on_tasks(spark: SparkSession, block: Block, work: list, fn: Callable) -> list[list[Tree]]:
    """``fn(rows, item)`` for each item of work, each in a task of its own on a shared copy of the packed rows."""
    shared = spark.sparkContext.broadcast((block.bins, block.y, block.marks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                trees = fn(LocalRows(Block(*shared.value)), work[i])
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(trees)), pa.array(range(len(trees)), pa.int64()), pa.array([t.to_json() for t in trees], pa.string())], ["item", "number", "tree"])

    rows = spark.range(0, len(work), 1, len(work)).mapInArrow(run, "item long, number long, tree string").collect()
    out: list[list[Tree]] = [[] for _ in work]
    for r in sorted(rows, key=lambda r: (r["item"], r["number"])):
        out[r["item"]].append(Tree.from_json(r["tree"]))
    shared.unpersist()
    return out


def fit_ensembles(kind: str, grid: Sequence[dict], df: DataFrame, features: Sequence[str], label: Column, marks: Column, seed: int = 42, local_rows: int | None = None, journal: str | None = None) -> list[Ensemble]:
    """One ensemble for each grid row, all from one binning. ``kind``: boost or forest; ``features`` hold no null.

    ``journal``: a shared folder that belongs to these rows and this grid; boosting that runs level by level goes on from there.
    """
    limit = LOCAL_ROWS if local_rows is None else local_rows
    spark = df.sparkSession
    cuts = feature_cuts(df, features)
    n, ones = df.agg(F.count(F.lit(1)), F.sum(label.cast("int"))).first()
    share = min(max((ones or 0) / max(n, 1), 1e-12), 1 - 1e-12)
    start = float(np.log(share / (1 - share))) if kind == "boost" else None
    blocks = packed(df, features, label, marks, cuts)
    if n <= limit:
        block = _one_block(blocks.collect(), len(features))  # at most ``limit`` rows, a byte for each feature
        if kind == "boost":
            grown = _on_tasks(spark, block, list(grid), lambda rows, p: boost(rows, [p], start)[0])
        else:
            tasks = spark.sparkContext.defaultParallelism
            work = [(g, numbers.tolist()) for g, p in enumerate(grid) for numbers in np.array_split(np.arange(p["n_estimators"]), min(tasks, p["n_estimators"]))]
            parts = _on_tasks(spark, block, work, lambda rows, w: plant(rows, grid[w[0]], w[1], seed))
            grown = [[t for (g, _), trees in zip(work, parts) if g == i for t in trees] for i in range(len(grid))]
    else:
        rows = SparkRows(materialise(blocks, "tree-blocks"), len(features))
        grown = boost(rows, grid, start, RoundJournal(spark, journal) if journal else None) if kind == "boost" else [plant(rows, p, range(p["n_estimators"]), seed) for p in grid]
    return [Ensemble(cuts, trees, start) for trees in grown]
