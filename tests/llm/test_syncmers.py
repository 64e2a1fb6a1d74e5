"""Closed-syncmer fingerprints against a brute-force version."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from plumeworks.llm import syncmers as s


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def of_text(text):
    return signed(xxhash.xxh64_intdigest(text.encode(), seed=42))


def of_numbers(numbers):
    seed = 42
    for n in numbers:
        seed = xxhash.xxh64_intdigest((n & (1 << 64) - 1).to_bytes(8, "little"), seed=seed)
    return signed(seed)


def brute_anchors(text):
    inner = [of_text(text[i : i + s.S]) for i in range(len(text) - s.S + 1)]
    if len(text) < 2 * s.K:
        return [(i, h & s.LOW) for i, h in enumerate(inner)] if inner else [(0, of_text(text) & s.LOW)] if text else []
    out = []
    for i in range(len(text) - s.K + 1):
        window = inner[i : i + s.WINDOW]
        if min(window) in (window[0], window[-1]):
            out.append((i, of_numbers([window[j] for j in [*range(0, s.WINDOW, s.S), s.WINDOW - 1]]) & s.LOW))
    return out


def brute_print(text):
    found = brute_anchors(text)
    return ",".join(f"{i - b}:{h:08x}" for (i, h), (b, _) in zip(found, [(0, 0), *found]))


def brute_like(a, b):
    def steps(text):
        found = brute_anchors(text)
        return {(h, g, i - p, n == 0) for n, ((i, h), (p, g)) in enumerate(zip(found, [(0, 0), *found]))}

    a, b = steps(a), steps(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, of_text(r[1])))
    out = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        q = len(t) // 4
        e = t[: len(t) - q] + after[:q]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), brute_print(t), brute_print(e), round(brute_like(t, e), 9), round(brute_like(t, after), 9)))
    return sorted(out, key=repr)


def found(df, **kw):
    rows = s.fingerprint_documents(df, **kw).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


def texts(rng):
    sizes = [*range(0, 12), 30, 31, 61, 62, 63, 90, 1000, 1023, 1024, 1025, 1054, 1055, 2048, 2100, 5000]
    out = ["".join(rng.choice("ab é😀\n") for _ in range(n)) for n in sizes]
    out += ["".join(rng.choice("abcdefghij ") for _ in range(n)) for n in sizes]
    return [*out, "a" * 700, " " * 62, None, "", out[-1], out[-1][:2000] + "new" + out[-1][2000:]]


@pytest.mark.parametrize("hot", [20_000, 3])
def test_against_brute_force(spark, hot):
    rng = random.Random(5)
    all_texts = texts(rng)
    rows = [(i * 7 - 20, t) for i, t in enumerate(all_texts)]
    rows += [(1000, t) for t in all_texts[10:30]] + [(None, t) for t in all_texts[5:15]] + [(None, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], "doc_id long, text string, place int, block string, found int, extra int").repartition(3)
    assert found(df, hot=hot) == brute(rows)


def test_repeated_rows_are_documents_of_their_own(spark):
    rows = [(1, "one and the same text " * 9)] * 3 + [(2, "another text of some length " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows)


def test_empty_and_single(spark):
    df = spark.createDataFrame([(4, "abcdefgh")], "doc_id long, text string")
    assert found(df) == brute([(4, "abcdefgh")])
    assert found(df.limit(0)) == []


def test_context_free_and_dense_enough():
    rng = random.Random(6)
    core = "".join(rng.choice("abcdefgh ") for _ in range(300))
    alone = {h for _, h in brute_anchors(core)}
    inside = {h for _, h in brute_anchors("x" * 70 + core + "y" * 70)}
    assert alone <= inside
    for n in (62, 80, 200):
        for letters in ("a", "ab", "abcdefgh"):
            places = [i for i, _ in brute_anchors("".join(rng.choice(letters) for _ in range(n)))]
            assert places and max(b - a for a, b in zip([-1, *places], [*places, n - s.K + 1])) <= s.K - s.S + 1


def test_no_python_worker_and_one_shuffle_of_texts(spark):
    df = spark.createDataFrame([(i, f"text {i} " * 30) for i in range(50)], "doc_id long, text string")
    plan = s.fingerprint_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert plan.count("hashpartitioning(to") == 1


def test_block_borders_and_a_long_text(spark):
    rng = random.Random(7)
    sizes = [m * s.BLOCK + d for m in (1, 2, 3) for d in (-1, 0, 1, s.K - 2, s.K - 1, s.K)]
    made = ["".join(rng.choice("ab é😀\n") for _ in range(n)) for n in [*sizes, 60_000]]
    made += [t[: len(t) - len(t) // 4] + "z" * 40 for t in made[:6]] + ["", "ab" * 400, "short", None]
    rows = [(i, t) for i, t in enumerate(made)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df) == brute(rows)


def test_steps_keep_their_first_anchor_apart(spark):
    pairs = [([5 << 32 | s.LOW, 9 << 32], s.NONE), ([5 << 32 | s.LOW, 9 << 32], 0), ([4 << 32 | s.LOW, 9 << 32], s.NONE), ([], s.NONE)]
    df = spark.createDataFrame(pairs, "found array<long>, before long")
    first, zero, moved, none = [r[0] for r in df.select(s.steps(F.col("found"), F.col("before"))).collect()]
    assert first[0] != zero[0] != moved[0] != first[0] and first[1] == zero[1] != moved[1] and none == []


def test_inner_substrings_are_compared_by_columns(spark):
    # interpreted functions of array elements took most of the time; they are left to texts of less than two k-mers
    text = "".join(random.Random(8).choice("abc é😀") for _ in range(s.BLOCK + s.K - 1))
    df = s.with_anchors(spark.createDataFrame([(1, 0, text), (2, 1000, text), (3, 0, text[: s.K - 1])], "key int, at long, piece string"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and "lambda" not in plan
    got = {r["key"]: [(a >> 32, a & s.LOW) for a in r["found"]] for r in df.collect()}
    want = brute_anchors(text)
    assert want and got == {1: want, 2: [(i + 1000, h) for i, h in want], 3: []}


def test_blocks_do_not_carry_their_text(spark):
    df = spark.createDataFrame([(i, f"text {i} " * 30) for i in range(5)], "doc_id long, text string")
    plan = s.fingerprint_documents(df)._jdf.queryExecution().executedPlan().toString()
    made = [line for line in plan.splitlines() if "Generate posexplode" in line]
    assert made and not any(re.search("text#|edited#", line) for line in made)
