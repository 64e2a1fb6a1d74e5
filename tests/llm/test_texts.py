"""Repeated strings, pages, chats, packing and toxicity against brute force or held-out cases."""

import hashlib
import random

import numpy as np
import pytest

from plumeworks.llm import chat, packing, pages, suffix, texts, toxicity
from plumeworks.llm.crf import decode


def brute_repeats(rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    owner = {}
    for i, b in raw:
        if i is not None:
            for s in range(len(b) - suffix.WIDTH + 1):
                w = b[s : s + suffix.WIDTH]
                owner[w] = min(owner.get(w, i), i)
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, dtype=bool)
        if i is not None:
            for s in range(len(b) - suffix.WIDTH + 1):
                if owner[b[s : s + suffix.WIDTH]] < i:
                    gone[s : s + suffix.WIDTH] = True
        gone = gone[: len(b)]
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,alphabet,piece", [(1, "ab", None), (2, "abcdefghij é", None), (3, "a", None), (4, "abcdefghijklmnop ", 300)])
def test_repeated_strings(spark, monkeypatch, seed, alphabet, piece):
    rng = random.Random(seed)
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randint(40, 140))) for _ in range(6)]
    rows = [(1000, None), (1001, ""), (1002, "short"), (1003, "short"), (None, passages[0])]
    for i in range(40):
        body = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200)))
        for p in rng.sample(passages, rng.randint(0, 3)):
            at = rng.randint(0, len(body))
            low = rng.randint(0, 20)
            body = body[:at] + p[low : len(p) - rng.randint(0, 20)] + body[at:]
        rows.append((rng.randint(0, 60), body))
    rows += [(500 + i, rows[10][1]) for i in range(3)] + [rows[12], rows[12]]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_bytes int").repartition(3)
    assert sorted((tuple(r) for r in suffix.remove_repeats(df).collect()), key=str) == brute_repeats(rows)


def test_shared_anchors_do_not_grow_with_the_parts(spark):
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(900))
    df = spark.createDataFrame([(i, i + 100, f"{i}{passage}{i}" * 2) for i in range(5)], "k1 long, k2 long, text string").repartition(2)
    few, many = ({r["k1"]: sorted(r["found"]) for r in suffix._shared_anchors(df, parts).collect()} for parts in (1, 400))
    assert len(few) == 5 and {k: len(v) for k, v in few.items()} == {k: len(v) for k, v in many.items()}
    assert all(len(set(v)) == len(v) > 20 for v in many.values())


def test_repeats_of_an_empty_table(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffix_sort_orders_each_group():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, size=4000).astype(np.uint8)
    start = rng.integers(0, 3900, size=700)
    group = np.sort(rng.integers(0, 25, size=700))
    order = suffix.suffix_sort(data, texts.prefix_sums(data), start, group)
    assert sorted(order) == list(range(700)) and (group[order] == group).all()
    keys = [(group[k], data[start[k] : start[k] + suffix.WIDTH].tobytes()) for k in order]
    assert keys == sorted(keys)


def test_common_extension():
    data = np.frombuffer(b"abcabcabxabcabcaby" * 8, dtype=np.uint8)
    a, b = np.array([0, 0, 3]), np.array([9, 3, 12])
    assert list(suffix.common_extension(texts.prefix_sums(data), a, b, 20)) == [8, 5, 5]


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(4)
    raw = bytes(rng.choice(b"abc ") for _ in range(5000))
    whole = suffix.anchors([raw])
    monkeypatch.setattr(suffix, "PIECE", 700)
    parts = suffix.anchors([raw])

    def by_start(x):
        return {int(s) + k: (int(s) + int(lead), int(h)) for s, n, lead, h in zip(x.start, x.count, x.lead, x.hash) for k in range(int(n))}

    assert by_start(whole) == by_start(parts) and len(by_start(whole)) == 5000 - suffix.WIDTH + 1


def test_shingles_are_those_of_the_words():
    rng = random.Random(5)
    rows = ["".join(rng.choice("abAB \t\né") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["", None, " ", "x" * 600_000 + " a b c d e f"]
    seen = {}
    for t, hashes in zip(rows, texts.many_shingles(rows)):
        words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        sets = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        assert len(hashes) == len(sets)
        key = frozenset(sets)
        assert seen.setdefault(key, hashes.tobytes()) == hashes.tobytes()
    assert len(set(seen.values())) == len(seen)


@pytest.fixture(scope="module")
def page_model():
    return pages.model()


def test_held_out_pages(page_model):
    test = pages.labelled_pages(1234, 120)
    right = sum(int((np.array(y) == p).sum()) for (_, y), p in zip(test, decode(page_model, [pages.features(b) for b, _ in test])))
    assert right / sum(len(y) for _, y in test) > 0.97


KEPT = [
    ("<p data-x=don't>It's a fine day for all of them today.</p>", "It's a fine day for all of them today."),
    ("<p title=\"a > b\" data-y='x'>A quoted sign ends no tag in here.</p>", "A quoted sign ends no tag in here."),
    ("<noscript><p>The figures of the last year are given below.</p></noscript>", "The figures of the last year are given below."),
    ("<div class='popular-science'><p>Stars are born in clouds of dust and gas, far away.</p></div>", "Stars are born in clouds of dust and gas, far away."),
    ("<p class='body-search'>The search for water on other worlds goes on for years.</p>", "The search for water on other worlds goes on for years."),
    ("<div class=\"warning-signs\"><p>Doctors name five signs that one should not overlook.</p></div>", "Doctors name five signs that one should not overlook."),
]


@pytest.mark.parametrize("part,text", KEPT)
def test_article_text_is_not_lost(page_model, part, text):
    first, last = "The council met on Monday to speak about the new bridge.", "It will meet again when the plans of the engineers are ready."
    page = f"<html><body><nav><ul><li><a href=x>Home</a></li><li><a href=x>World news</a></li></ul></nav><article><h1>The new bridge</h1><p>{first}</p>{part}<p>{last}</p></article><footer><p>&copy; 2024 example.org. All rights kept.</p></footer></body></html>"
    assert pages.main_texts([page], page_model) == ["\n".join(["The new bridge", first, text, last])]


def test_heads_and_feet_of_an_article(page_model):
    body = "<p>The council met on Monday to speak about the new bridge.</p><p>It will meet again when the plans of the engineers are ready.</p>"
    page = f"<header class='site-header'><h2>Daily paper</h2></header><nav><ul><li><a href=x>Home</a></li></ul></nav><article><header><h1>The new bridge</h1></header>{body}<footer><p>Printed by the town.</p></footer></article>"
    (text,) = pages.main_texts([page], page_model)
    assert text.split("\n") == ["The new bridge", "The council met on Monday to speak about the new bridge.", "It will meet again when the plans of the engineers are ready."]


def test_broken_pages(page_model):
    cases = {
        None: "", "": "", "<p>": "", "<article><p>One &amp; two&nbsp;words here, said once.<p>Next  \n one follows on, and ends.</article><footer>&copy; x</footer>": "One & two words here, said once.\nNext one follows on, and ends.",
        "<article><h1>Title of it</h1><p>Some text of the article, with an end.<script>var a='<p>no</p>'": "Title of it\nSome text of the article, with an end.",
        "<article><p>Before the comment, all is well.<!-- open <p>x": "Before the comment, all is well.",
        "<nav><ul><li><a href=x>Home</a></li></ul></nav><article><p>The words of an article stand here, in full.</p></article><di": "The words of an article stand here, in full.",
    }
    assert pages.main_texts(list(cases), page_model) == list(cases.values())
    assert pages.main_texts(["<div>" * 20000 + "x" + "</div>" * 20000, "<" * 50000, "<!--" * 5000, "<a b='" * 5000], page_model)


def test_choices_and_formulas_drop_nothing_else(page_model):
    """An option needs no end tag, and formulas are text of their paragraph."""
    story = "<article><h1>A long day at the lake</h1><p>We went out early and saw the whole valley lie in the sun.</p><p>Then the wind came up and we turned back to the old house.</p></article>"
    want = "A long day at the lake\nWe went out early and saw the whole valley lie in the sun.\nThen the wind came up and we turned back to the old house."
    search = "<form><input list=q><datalist id=q><option value=a><option value=b></datalist></form>"
    menu = "<form><select><optgroup label=x><option>Red<option>Green<optgroup label=y><option>Blue</select></form>"
    formula = story.replace("whole valley", "whole <math><mi>x</mi><mo>+</mo><mn>1</mn></math> valley")
    got = pages.main_texts([story, search + story, menu + story, search.replace("</datalist>", "") + story, formula], page_model)
    assert got == [want, want, want, want, want.replace("whole valley", "whole x+1 valley")]
    found = pages.blocks("<p>pick <select><option>Red<option>Green</select> now</p>")
    assert [(b.text, b.cues[-1:]) for b in found] == [("pick", ()), ("Red", ("form",)), ("Green", ("form",)), ("now", ())]


def test_pages_table(spark, page_model):
    df = spark.createDataFrame([(1, "u", None, 5), (1, "u", None, 5), (None, None, "<article><p>A text that stands alone, with an end.</p></article>", 6)], "page_id long, url string, html string, text int")
    got = sorted((tuple(r) for r in pages.extract(df, page_model).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "A text that stands alone, with an end.", 38)], key=str)
    assert pages.extract(df.limit(0), page_model).count() == 0


def test_given_pages_against_their_article(spark, sf, page_model):
    import html
    import re

    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", body)]
        assert pages.main_texts([r["html"]], page_model) == ["\n".join(b for b in blocks if b)]


def brute_chats(rows):
    convs = {}
    for c, turn, role, text in set(rows):
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    seqs = {c: tuple((t[2:]) for t in sorted(v)) for c, v in convs.items()}
    keep = {}
    for c, s in sorted(seqs.items()):
        longer = any(len(o) > len(s) and o[: len(s)] == s for o in seqs.values())
        if not longer and s not in keep.values():
            keep[c] = s
    return {c: (len(s), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, r, _, t in s)) for c, s in keep.items()}


@pytest.mark.parametrize("stretch", [1024, 2])
def test_chats(spark, monkeypatch, stretch):
    monkeypatch.setattr(chat, "STRETCH", stretch)
    rng = random.Random(6)
    rows, cid = [], 0
    for _ in range(15):
        turns = [(k, rng.choice(("user", "assistant", None)), rng.choice(("a", "b", None, "", "long " * 50))) for k in range(rng.randint(1, 7))]
        for cut in {rng.randint(1, len(turns)) for _ in range(3)} | {len(turns)}:
            shift = rng.choice((0, 0, 3))
            rows += [(cid, k + shift, r, t) for k, r, t in turns[:cut]]
            cid += 1
    rows += [(None, 0, "user", "x"), (900, None, "user", "y"), (900, 1, "user", "z"), *rows[:5]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos int").repartition(3)
    got = {}
    for r in sorted(chat.format_chats(df).collect(), key=lambda r: (r["conv_id"], r["part"])):
        n, text = got.get(r["conv_id"], (r["n_turns"], ""))
        got[r["conv_id"]] = (n, text + r["text"])
        assert r["part"] <= r["n_parts"]
    assert got == brute_chats(rows)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_plan_fills_every_slot_once():
    rng = random.Random(1)
    for t in range(200):
        sizes = (8, 16, 32) if t % 2 else (20,)
        histogram = {rng.randint(1, sizes[-1]): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
        taken = {}
        for p in packing.plan(histogram, sizes, 2):
            used = sum(n * k for n, _, k in p.items)
            assert p.count > 0 and used == p.size - p.room and p.size == min(s for s in sizes if s >= used)
            for n, rank, k in p.items:
                taken.setdefault(n, []).append((rank, rank + p.count * k))
        for n, count in histogram.items():
            at = 0
            for low, high in sorted(taken[n]):
                assert low == at
                at = high
            assert at == count


def brute_best_fit(lengths, size):
    """Best fit, longest first, item by item: the number of bins."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            best = min(fits)
            rooms.remove(best)
            rooms.append(best - n)
        else:
            rooms.append(size - n)
    return len(rooms)


def test_plan_packs_as_well_as_item_by_item():
    rng = random.Random(2)
    for _ in range(60):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(1, 120))]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        bins = sum(p.count for p in packing.plan(histogram, (40,)))
        assert bins == brute_best_fit(lengths, 40)


def test_packing_of_a_table(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 90)))) for i in range(300)] + [(7, "a b"), (7, "a b"), (None, "c d e"), (400, None), (401, " "), (402, "x " * 1000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, bin_id int").repartition(4)
    got = packing.pack(df, sizes=(16, 32, 64), overhead=4).collect()
    words = sorted(len((t or "").split()) for _, t in rows)
    assert sum(r["n_tokens"] for r in got) == sum(words)
    assert sum(r["bin_id"] is None for r in got) == sum(n == 0 for n in words)
    bins = {}
    for r in got:
        if r["bin_id"] is not None:
            bins.setdefault((r["bin_id"], r["bin_size"]), []).append((r["bin_start"], r["n_tokens"]))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, size), items in bins.items():
        at = 0
        for start, n in sorted(items):
            assert start == at and n > 0
            at += n
        assert at <= size and size == min(s for s in (16, 32, 64) if s >= at)
    assert sorted(r["first"] for r in got if r["doc_id"] == 402) == list(range(0, 1000, 64))
    assert packing.pack(df.limit(0)).count() == 0


def test_toxicity_of_held_out_rows(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    docs = spark.read.parquet(f"{big}/documents.parquet").selectExpr("*", "1.0 AS score", "'x' AS toxic")
    got = toxicity.score(docs, labels, trees=8)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    bad, good = [r["score"] for r in rows if r["toxic"] == 1], [r["score"] for r in rows if r["toxic"] == 0]
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert len(bad) > 3 and auc > 0.9
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.9


def test_toxicity_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "idiot"), (None, None), (3, ""), (3, "")], "doc_id long, text string")
    empty = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert sorted((r["doc_id"] or 0, r["score"], r["predicted"]) for r in toxicity.score(docs, empty).collect()) == [(0, 0.0, 0), (1, 0.0, 0), (3, 0.0, 0), (3, 0.0, 0)]
    one = spark.createDataFrame([(i, 1, 1) for i in range(30)], "doc_id long, toxic int, quality int")
    many = spark.createDataFrame([(i, "bad words") for i in range(30)], "doc_id long, text string")
    assert {(r["score"], r["predicted"]) for r in toxicity.score(many, one).collect()} == {(1.0, 1)}
    assert toxicity.score(many.limit(0), one).count() == 0
