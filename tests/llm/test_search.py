"""Top-k search, benchmark containment and the Jaccard join against brute force."""

import itertools
import random

import numpy as np
import pytest

from plumeworks.llm import contain, jaccard, topk
from plumeworks.llm.components import components


def brute_top(rows, k, every):
    clean = {(i, tuple(np.floor(np.array(v, dtype=float) * 256).astype(int))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, q in sorted(clean):
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in clean if j != i and len(c) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice((-1.0, 0.25, 0.5, 0.003)) for _ in range(3)]) for i in range(120)]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [float("nan"), 1.0, 1.0]), (204, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (250, [1.0, 2.0]), (251, [0.5, 2.0]), (10, rows[10][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = sorted(tuple(r) for r in topk.top_k(df, 5, 10).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute_top(rows, 5, 10)
    assert topk.top_k(df.limit(0)).count() == 0


def test_pruned_blocks_are_exact():
    rng = np.random.default_rng(2)
    x, q = rng.integers(-9, 9, size=(500, 6)), rng.integers(-9, 9, size=(20, 6))
    ids = rng.permutation(500)
    found = topk.block_search(q, np.arange(1000, 1020), x, ids, 4, block=16)
    for (qid, names, scores), v in zip(found, q):
        best = sorted((-int(s), int(i)) for s, i in zip(x @ v, ids))[:4]
        assert [(-int(s), int(i)) for s, i in zip(scores, names)] == best


def texts(rng, n, words="abcdefgh"):
    out = []
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append((" " if rng.random() < 0.5 else "\t\n").join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    return out


@pytest.mark.parametrize("seed,words,room", [(1, "abcdefgh", 1000), (2, [f"w{i}" for i in range(300)], 1000), (3, [f"w{i}" for i in range(60)], 3), (4, "ab", 0)])
def test_jaccard_components(spark, seed, words, room):
    rng = random.Random(seed)
    rows = list(enumerate(texts(rng, 40, words)))
    rng.shuffle(rows)
    rows = [(i * 3, t) for i, t in rows] + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "one"), (1004, "one")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component string").repartition(3)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.link(df, room=room).collect()}
    sets = {i: contain.shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    assert got == {(i, len(s), top(i)) for i, s in sets.items()}


def test_jaccard_odd_rows(spark):
    schema = "doc_id long, text string"
    assert jaccard.link(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "something else entirely in this row"), (7, "Something else entirely in this row"), (8, "x" * 700000 + " y")]
    got = sorted(((r[0], r[1], r[2]) for r in jaccard.link(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(None, 2, None), (5, 2, 5), (5, 2, 5), (7, 2, 5), (8, 1, 8)], key=str)


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    parent = {}

    def top(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: top(i) for a, b in links if a != b for i in (a, b)}


@pytest.mark.parametrize("room", [100_000, 20])
def test_containment(spark, room):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(25)] + [(90, None), (91, ""), (92, "two words"), (None, "a b c d e")]
    docs = [(100, None), (101, ""), (102, "Two  WORDS"), (None, items[0][1])]
    for d in range(60):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            piece = items[rng.randrange(25)][1].split()
            for _ in range(rng.randint(0, 3)):
                piece[rng.randrange(len(piece))] = rng.choice(words)
            parts[len(parts) // 2 : len(parts) // 2] = piece
        docs.append((d, rng.choice((" ", "\n", "\x0b ")).join(parts)))
    docs.append(docs[-1])
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    got = {tuple(r) for r in contain.find_items(df, spark.createDataFrame(items, "item_id long, text string"), room=room).collect()}
    want = set()
    for i, t in docs:
        for j, u in items:
            a, b = contain.shingles(t), contain.shingles(u)
            if i is not None and j is not None and b and 100 * len(a & b) >= 75 * len(b):
                want.add((i, j, len(a & b), len(b)))
    assert got == want and len(want) > 10
    none = spark.createDataFrame([], "item_id long, text string")
    assert contain.find_items(df, none).count() == 0 and contain.find_items(df.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_sketch_width_misses_nothing():
    for n in range(1, 300):
        assert contain.sketch_width(n, 0.75) >= n - contain.needed(n, 0.75) + 1
