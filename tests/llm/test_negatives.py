"""Hard negatives against brute force."""

import random

import numpy as np
import pytest

from plumeworks.llm import negatives


def brute(rows, positives, below, every, low=50, high=95):
    clean = {(i, l, tuple(int(c) for c in np.floor(np.array(v, dtype=float) * 256))) for i, v, l in rows if None not in (i, l) and v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, l, a in clean:
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), j, m) for j, m, v in clean if j != i and len(v) == len(a)]
        for s, j, _ in sorted(r for r in scored if r[2] == l)[:positives]:
            band = sorted(r for r in scored if r[2] != l and -low * s <= -100 * r[0] <= -high * s)
            out += [(i, j, n + 1, r[1], -s, -r[0]) for n, r in enumerate(band[:below])]
    return sorted(out)


def found(df, *a, **kw):
    return sorted(tuple(r) for r in negatives.mine(df, *a, **kw).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(negatives, "STRETCH", 64)
    monkeypatch.setattr(negatives, "CHUNK", 5)
    monkeypatch.setattr(negatives, "STRETCHES", 3)
    monkeypatch.setattr(negatives, "CHUNKS", 2)
    monkeypatch.setattr(negatives, "CLUSTERS", 4)
    monkeypatch.setattr(negatives, "LEAST_CELL", 100)


@pytest.mark.parametrize("kind", ["spread", "ties", "clusters"])
def test_against_brute_force(spark, small, kind):
    rng = random.Random(3)
    if kind == "ties":
        make = lambda: [rng.choice((-1.0, 0.25, 0.5)) for _ in range(3)]
    elif kind == "spread":
        make = lambda: [rng.gauss(0, 1) for _ in range(6)]
    else:
        centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
        make = lambda: [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]
    rows = [(i, make(), rng.choice((0, 0, 0, 1, 2))) for i in range(240)]
    rows += [(900, None, 1), (910, [], 1), (920, [1.0, None, 2.0], 1), (930, [float("nan"), 1.0, 1.0], 1), (940, [float("inf"), 1.0, 1.0], 1), (None, make(), 1), (950, make(), None)]
    rows += [(960, [1.0, 2.0], 1), (961, [0.5, 2.0], 1), (962, [0.5, 1.9], 2), (10, rows[10][1], rows[10][2]), (20, [0.0] * len(rows[0][1]), 0), (20, make(), 1)]
    rows += [(1000 + i, rows[30][1], i % 3) for i in range(60)]  # one common vector
    df = spark.createDataFrame([(i, v, l, 1, 2) for i, v, l in rows], "vec_id long, embedding array<double>, label int, chunk int, line int").repartition(3)
    want = brute(rows, 5, 3, 10)
    assert len(want) > 50 and found(df, 5, 3, 10) == want


def test_shapes(spark, small):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.8, 0.1], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert found(df) == brute(rows, 5, 3, 50) != []
    assert found(df.limit(0)) == []
    assert found(df.where("vec_id > 0")) == []  # no anchor
    with pytest.raises(ValueError):
        negatives.mine(df, positives=0)


def test_walks_stop_early_and_stay_exact(monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.integers(-60, 60, size=(3000, 8)) + 200 * rng.integers(0, 2, size=(3000, 8))
    labels, ids = rng.integers(0, 3, 3000), np.arange(3000)
    members = x[:20]
    monkeypatch.setattr(negatives, "STEP", 32)
    shared = negatives.SharedList(members[labels[:20] >= 0], ids, labels, x)
    true = members @ x.T
    looked = []
    steps = shared.steps
    shared.steps = lambda needs: (looked.append(s[1]) or s for s in steps(needs))
    best = negatives.walk_positives(shared, ids[:20], labels[:20], 5, np.full(20, -np.inf))
    for m in range(20):
        same = sorted((-true[m, j], j) for j in range(3000) if labels[j] == labels[m] and j != m)[:5]
        assert [(-s, i) for s, i in zip(best.score[best.slot == m], best.id[best.slot == m])] == same
    assert len(looked) < 3000 // 32
    assert (shared.lengths[:, None] * shared.bounds >= members @ x[shared.order].T).all()
