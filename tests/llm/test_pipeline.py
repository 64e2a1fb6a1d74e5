"""Pipeline stages that drop rows, against brute force, with repeated and null ids."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from plumeworks import session
from plumeworks.llm import jaccard, secret_scan, texts, toxicity
from plumeworks.llm.contain import shingles

SCHEMA = "doc_id long, text string, lang string"


def words(seed, n=40):
    rng = random.Random(seed)
    return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]


def near(seed, change):
    w = words(seed)
    w[change] = "other"
    return " ".join(w)


def groups(rows):
    """Rows linked by Jaccard of at least 3/4, joined up."""
    sets, group = [shingles(t) if t else set() for _, t, _ in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    return group


def table(spark, rows, written, path):
    """The rows as they are, or read from files of a few rows each, as the stages get them."""
    df = spark.createDataFrame(rows, SCHEMA)
    if not written:
        return df
    df.repartition(4).write.parquet(f"{path}/docs")
    return spark.read.parquet(f"{path}/docs")


@pytest.mark.parametrize("written", [False, True])
def test_near_duplicates_by_row(spark, written, tmp_path):
    x, y, z = (" ".join(words(k)) for k in (1, 2, 3))
    rows = [
        (7, x, "a"), (7, y, "b"), (8, near(1, 0), "c"), (9, near(2, 39), "d"), (3, z, "e"), (3, z, "f"), (None, near(3, 0), "g"),
        (None, " ".join(words(4)), "h"), (None, near(4, 0), "i"), (5, "", "j"), (5, "", "k"), (5, None, "l"), (6, "", "m"), (None, "", "n"), (None, "", "o"),
    ]
    got = cp.drop_near_duplicates(spark, table(spark, rows, written, tmp_path), "").collect()
    best = {}
    for g, (i, t, _) in zip(groups(rows), rows):
        key = (i, t) if not t and i is not None else g
        best[key] = min(best.get(key, (True, 0)), (i is None, i or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted(best.values())
    texts = [r["text"] for r in got]
    assert x in texts and y in texts and texts.count(z) == 1 and [r.asDict().keys() for r in got][0] == {"doc_id", "text", "lang"}


@pytest.mark.parametrize("written", [False, True])
def test_leaks_by_row(spark, tmp_path, written):
    item = " ".join(words(5))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"so {item} it is", "a"), (1, "clean words of the same id are here", "b"), (None, f"and {item}", "c"), (None, "clean words without any id", "d"), (2, None, "e")]
    got = cp.drop_benchmark_leaks(spark, table(spark, rows, written, tmp_path), str(tmp_path))
    want = [r for r in rows if not shingles(item) & shingles(r[1] or "")]
    assert sorted(r["lang"] for r in got.collect()) == [r[2] for r in want] == ["b", "d", "e"]


def test_rows_of_files_are_numbered_once_and_alike(spark, tmp_path):
    rows = [(i % 5 or None, f"text {i}", "x") for i in range(50)]
    docs = table(spark, rows, True, tmp_path)
    one, two = (sorted((r["key"], r["row"]["text"]) for r in cp._keyed(d, "rows").collect()) for d in (docs, spark.read.option("mergeSchema", True).parquet(f"{tmp_path}/docs")))
    assert one == two and [k for k, _ in one] == list(range(50))
    assert cp._keyed(docs.withColumn("_metadata", F.lit(1)), "rows").select("key").distinct().count() == 50


def test_all_stages(spark, sf, tmp_path):
    """``run`` is the stages one after the other; what each keeps is held against its own module or against plain Python."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = docs
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    for name, stage in cp.STAGES:
        before = {r["doc_id"]: r for r in kept.collect()}
        out = stage(spark, kept, sf)
        if name == "packing":
            rows = out.collect()
            break
        out.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        assert kept.columns == docs.columns
        after = {r["doc_id"]: r for r in kept.collect()}
        if name == "toxicity":
            predicted = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, labels).collect()}
            assert set(after) == {i for i, p in predicted.items() if p == 0}
        elif name == "near_duplicates":
            rows_before = [(i, r["text"], "") for i, r in sorted(before.items())]
            best = {}
            for g, (i, t, _) in zip(groups(rows_before), rows_before):
                best.setdefault(g if t else ("blank", i), i)
            assert set(after) == set(best.values())
        elif name == "decontamination":
            items = [shingles(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            leaks = {i for i, r in before.items() if any(4 * len(s & shingles(r["text"] or "")) >= 3 * len(s) for s in items)}
            assert set(after) == set(before) - leaks
        else:
            model = secret_scan.tagger()
            for i, r in after.items():
                ((_, spans),) = secret_scan.all_spans([before[i]["text"]], model)
                assert r["text"] == secret_scan.redact(before[i]["text"], spans) and r["n_chars"] == len(r["text"])
        if name != "toxicity":
            assert all(after[i]["lang"] == before[i]["lang"] for i in after)
    lengths = {r["doc_id"]: len([w for w in (r["text"] or "").split()]) for r in kept.collect()}
    packed = {}
    for r in rows:
        packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["n_tokens"]
        assert r["bin_start"] + r["n_tokens"] <= r["bin_size"]
    assert set(packed) == set(lengths) and all(packed[i] == n for i, n in lengths.items())
    columns = sorted(rows[0].asDict())
    assert sorted(map(tuple, cp.run(spark, sf).select(*columns).collect())) == sorted(tuple(r[c] for c in columns) for r in rows)


def test_texts_reach_python_few_and_once(spark, monkeypatch):
    seen = []

    def note(df, label, arrow_rows=None):
        out = session.materialise(df, label, arrow_rows)
        seen.append((label, arrow_rows))
        return out

    before = spark.conf.get(session.ARROW_ROWS)
    monkeypatch.setattr(jaccard, "materialise", note)
    df = spark.createDataFrame([(i, " ".join(words(i // 2)), "x") for i in range(6)], SCHEMA)
    assert cp.drop_near_duplicates(spark, df, "").count() == 3
    assert dict(seen)["shingle-sketches"] == dict(seen)["leader-links"] == jaccard.ROWS and spark.conf.get(session.ARROW_ROWS) == before
    sent = []
    monkeypatch.setattr(toxicity, "per_text", lambda documents, rows, made, also=(): sent.append((documents.schema["row"].dataType.names, also)) if "row" in also else texts.per_text(documents, rows, made, also=also))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, ("you idiot " if i % 2 else "kind words ") * 4, "x") for i in range(40)], SCHEMA)
    with pytest.raises(AttributeError):  # nothing comes back from the stub
        toxicity.without_toxic(docs, labels)
    assert sent == [(["doc_id", "lang"], ("row", "text"))]


def test_kept_rows_are_as_they_came(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    docs = spark.createDataFrame([("a", ("you idiot " if i % 2 else "kind words ") * 4, i, i / 2) for i in range(40)], "lang string, text string, doc_id int, score double")
    kept = toxicity.without_toxic(docs, labels)
    assert kept.dtypes == docs.dtypes and kept.count() and kept.exceptAll(docs).count() == 0
