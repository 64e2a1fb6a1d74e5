"""Own tree ensembles against brute force, and both ways of growing them against each other."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumeworks.plans import trees as T

GRID = [{"learning_rate": 0.3, "max_depth": 2, "max_iter": 4, "l2_regularization": 1.0, "min_samples_leaf": 5}, {"learning_rate": 0.1, "max_depth": 3, "max_iter": 6, "l2_regularization": 0.0, "min_samples_leaf": 8}]
FOREST = [{"n_estimators": 5, "max_depth": 4, "min_samples_leaf": 4, "min_samples_split": 12}]


def table(n=240, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.random(), rng.choice((0.0, 1.0, 2.0)), rng.gauss(0, 1)
        rows.append((i, a, b, c, 7.0, int(a + 0.3 * b + 0.2 * c + rng.gauss(0, 0.2) > 0.9)))
    return rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(table(), "i long, a double, b double, c double, same double, label int").repartition(3).cache()


FEATURES = ["a", "b", "c", "same"]


def fit(df, kind, grid, **kw):
    return T.fit_ensembles(kind, grid, df, FEATURES, F.col("label"), F.xxhash64("i"), **kw)


def brute_boost(x, y, p, cuts):
    """Plain recursion over the rows, every split tried."""
    score = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    for _ in range(p["max_iter"]):
        prob = 1 / (1 + np.exp(-score))
        g, h = prob - y, prob * (1 - prob)
        step = np.zeros(len(y))

        def grow(on, depth):
            best = (1e-12, None)
            if depth < p["max_depth"]:
                for f in range(x.shape[1]):
                    for c in cuts[f]:
                        left = on & (x[:, f] <= c)
                        right = on & ~(x[:, f] <= c)
                        if min(left.sum(), right.sum()) < p["min_samples_leaf"] or min(h[left].sum(), h[right].sum()) < T.LEAST_HESSIAN:
                            continue
                        part = lambda r: g[r].sum() ** 2 / (h[r].sum() + p["l2_regularization"])
                        gain = part(left) + part(right) - part(on)
                        if gain > best[0] + 1e-9:
                            best = (gain, left, right)
            if best[1] is None:
                step[on] = -p["learning_rate"] * g[on].sum() / (h[on].sum() + p["l2_regularization"])
            else:
                grow(best[1], depth + 1)
                grow(best[2], depth + 1)

        grow(np.ones(len(y), bool), 0)
        score += step
    return 1 / (1 + np.exp(-score))


def test_boosting_equals_brute_force(df):
    rows = table()
    x, y = np.array([r[1:5] for r in rows]), np.array([r[5] for r in rows], dtype=float)
    for p, e in zip(GRID, fit(df, "boost", GRID)):
        assert e.probability_of(e.raw(e.binned(x))) == pytest.approx(brute_boost(x, y, p, e.cuts), abs=1e-9)
        assert len(e.trees) == p["max_iter"] and max(t.depth for t in e.trees) <= p["max_depth"]
    assert len(fit(df, "boost", GRID)[0].cuts[1]) == 2  # few values: a cut between each


def test_level_jobs_grow_the_same_trees(df, monkeypatch):
    monkeypatch.setattr(T, "KEEP_ROUNDS", 2)
    monkeypatch.setattr(T, "BLOCK_ROWS", 50)
    monkeypatch.setattr(T, "BATCH_TREES", 3)
    x = np.array([r[1:5] for r in table()])
    for kind, grid in (("boost", GRID), ("forest", FOREST)):
        for one, many in zip(fit(df, kind, grid), fit(df, kind, grid, local_rows=0)):
            assert [t.feature.tolist() for t in one.trees] == [t.feature.tolist() for t in many.trees]
            assert one.raw(one.binned(x)) == pytest.approx(many.raw(many.binned(x)), abs=1e-9)


def test_boosting_goes_on_from_its_journal(df, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "KEEP_ROUNDS", 2)
    path = str(tmp_path / "rounds")
    whole = fit(df, "boost", GRID, local_rows=0)
    grown, stop = [], T.grow

    def counted(rows, rules):
        if len(grown) == 5:
            raise KeyboardInterrupt
        grown.append(1)
        return stop(rows, rules)

    monkeypatch.setattr(T, "grow", counted)
    with pytest.raises(KeyboardInterrupt):
        fit(df, "boost", GRID, local_rows=0, journal=path)
    grown.clear()
    monkeypatch.setattr(T, "grow", lambda rows, rules: grown.append(1) or stop(rows, rules))
    again = fit(df, "boost", GRID, local_rows=0, journal=path)
    assert len(grown) == 2  # four of six rounds were kept
    assert [[t.feature.tolist() for t in e.trees] for e in again] == [[t.feature.tolist() for t in e.trees] for e in whole]


def test_every_tree_of_a_forest_is_balanced(df):
    (e,) = fit(df, "forest", FOREST)
    roots = [t.root for t in e.trees]
    assert all(a == pytest.approx(b) for a, b in roots) and len({round(a, 6) for a, _ in roots}) > 1
    assert all(0 <= v <= 1 for t in e.trees for v in t.value) and max(t.depth for t in e.trees) <= 4
    marks = np.arange(100_000, dtype=np.int64) * 7919
    drawn = T.bootstrap(marks, 42, 3)
    assert drawn.mean() == pytest.approx(1, abs=0.02) and drawn.var() == pytest.approx(1, abs=0.03)
    assert (drawn == T.bootstrap(marks, 42, 3)).all() and (drawn != T.bootstrap(marks, 42, 4)).any()


def test_forest_limits(df):
    rows = table()
    x, y = np.array([r[1:5] for r in rows]), np.array([r[5] for r in rows], dtype=float)
    (e,) = fit(df, "forest", FOREST)
    block = T.Block(e.binned(x), y, np.array([0] * len(y)))
    assert block.bins.max() < T.BINS
    # the rows' own marks come from Spark's hash; the limits are seen with marks made here
    marked = T.Block(e.binned(x), y, np.arange(len(y), dtype=np.int64))
    for number, t in enumerate(T.plant(T.LocalRows(marked), FOREST[0], range(5), 42)):
        drawn = T.bootstrap(marked.marks, 42, number) > 0
        at = t.leaves(marked.bins)
        assert all((drawn & (at == leaf)).sum() >= 4 for leaf in np.unique(at[drawn]))


def test_best_splits_first_and_shapes(df):
    (e,) = fit(df, "boost", [GRID[1] | {"max_leaf_nodes": 3}])
    assert all((t.feature < 0).sum() <= 3 for t in e.trees)
    again = T.Ensemble.from_rows(e.rows())
    x = np.array([r[1:5] for r in table()])
    assert (again.raw(again.binned(x)) == e.raw(e.binned(x))).all()
    scored = df.select("i", e.probability(F.array(*FEATURES)).alias("p")).collect()
    want = e.probability_of(e.raw(e.binned(x)))
    assert all(r["p"] == pytest.approx(want[r["i"]]) for r in scored)


def test_one_class_and_constant_features(spark):
    one = spark.createDataFrame([(i, 1.0, 1) for i in range(30)], "i long, a double, label int")
    (e,) = T.fit_ensembles("boost", [GRID[0]], one, ["a"], F.col("label"), F.xxhash64("i"))
    assert e.probability_of(e.raw(e.binned(np.ones((1, 1)))))[0] > 0.99
    (f,) = T.fit_ensembles("forest", FOREST, one, ["a"], F.col("label"), F.xxhash64("i"))
    assert f.probability_of(f.raw(f.binned(np.ones((1, 1)))))[0] == 1.0
