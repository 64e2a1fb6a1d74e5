"""The conversation trie against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from plumeworks.llm import trie


def brute(rows, every=20, heads=4):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.md5(f"{role}\n{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = {}, {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - int(abs(c) % every) * (1 if c >= 0 else -1)
        path = tuple(own.get(base, [])[:h] + ts[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        words = len(re.findall(trie.WORD, p[-1][1])) if p else 0
        saved[p] = sum(saved[k] for k in below) + (len(members[p]) - 1) * words
    sha = lambda cs: hashlib.sha256(",".join(map(str, sorted(cs))).encode()).hexdigest()
    return sorted(
        ((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], sha(ends.get(p, []))) for p, m in members.items()), key=repr
    )


def found(df, **kw):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in trie.prefix_trie(df, **kw).select(*columns).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, h1 string, stretch int").repartition(3)


def logs(rng, n, size):
    texts = ["", "one", "two  words", "tab\tand\nline", None, " x\x0b y ", "ça và"]
    rows = []
    for c in range(n):
        for t in range(rng.randint(0, size)):
            rows.append((c * rng.choice((1, 1, 3)), t, rng.choice(("user", "user", None, "assistant")), rng.choice(texts[:3]) if t < 3 else rng.choice(texts)))
    return rows


@pytest.mark.parametrize("heavy,band,room", [(65_536, 1024, 200_000), (6, 1024, 3), (6, 3, 2), (0, 2, 1)])
def test_against_brute_force(spark, monkeypatch, heavy, band, room):
    monkeypatch.setattr(trie, "HEAVY_ROOT", 0)
    monkeypatch.setattr(trie, "BAND", band)
    monkeypatch.setattr(trie, "STRETCH", 4)
    monkeypatch.setattr(trie, "JOINED", 3)
    monkeypatch.setattr(trie, "BATCH", 5)
    rng = random.Random(heavy + band)
    rows = logs(rng, 60, 9)
    rows += [(-7, 0, "user", "one"), (-7, None, "user", "before"), (-20, 5, None, None), (None, 1, "user", "lost"), (500, None, None, None), (500, None, "a", "b"), (500, 3, "a", "b"), (500, 3, "a", "b")]
    rows += [(1000 + c, t, "user", "the same") for c in range(25) for t in range(6)]  # a group of copies
    rows += [(2000 + c, t, "user", "common" if t < 2 else f"own {c}") for c in range(25) for t in range(4)]  # one common beginning
    rows += [(2100 + c, 0, "user", "single") for c in range(8)]  # some of these keep no turn
    rng.shuffle(rows)
    assert found(frame(spark, rows), least_heavy=heavy, room=room) == brute(rows)


@pytest.mark.parametrize("crowded", [3, 65_536])
def test_a_long_conversation_and_equal_turn_numbers(spark, monkeypatch, crowded):
    monkeypatch.setattr(trie, "HEAVY_ROOT", 0)
    monkeypatch.setattr(trie, "BAND", 7)
    monkeypatch.setattr(trie, "STRETCH", 5)
    monkeypatch.setattr(trie, "CROWDED", crowded)
    rng = random.Random(9)
    rows = [(40, t, "user", rng.choice(("a", "b c"))) for t in range(60)]
    rows += [(41, t, "user", "x y z") for t in range(30)]
    rows += [(60, rng.choice((None, 1, 2, 2, 9)), rng.choice("uv"), rng.choice(("a", "b c", "d"))) for _ in range(40)]
    assert found(frame(spark, rows), least_heavy=10, room=5) == brute(rows)


def test_empty_tables(spark):
    df = frame(spark, [(None, 1, "user", "lost")])
    assert found(df) == [] and found(df.limit(0)) == []


def test_a_spilling_queue_keeps_the_order():
    rng = random.Random(1)
    queue, plain, out = trie.SpillingQueue(4), [], []
    for _ in range(300):
        x = (rng.randint(0, 20), rng.randint(0, 5))
        queue.push(x)
        plain.append(x)
        if rng.random() < 0.4:
            assert queue.first() == min(plain)
            out.append(queue.pop())
            plain.remove(out[-1])
    while queue.first() is not None:
        assert queue.pop() == min(plain)
        plain.remove(min(plain))
    assert not plain and queue.runs
