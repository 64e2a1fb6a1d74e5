"""One archive and one JSON document over many tasks, against plain readers."""

import io
import json
import random
import weakref
import zipfile

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumeworks.checks import adapters
from plumeworks.sources import big_json, documents, feeds


def archive(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)
    return str(path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def quoted(rng, n):
    frame = pd.DataFrame({"A b": [str(i) for i in range(n)], "text": [rng.choice(['plain', 'a "quote"', "two\nlines", "comma, here", "", "é\r\nx"]) for _ in range(n)], "c": [str(rng.random()) for _ in range(n)]})
    return frame.to_csv(index=False)


@pytest.mark.parametrize("block", [40, 1000, 1 << 20])
def test_one_archive_over_many_tasks(spark, tmp_path, block):
    rng = random.Random(block)
    texts = {"a.csv": quoted(rng, 300), "b.csv": "﻿" + quoted(rng, 50).rstrip("\n"), "c.csv": "A b,text,c\n", "note.txt": "no"}
    path = archive(tmp_path / "one.csv", texts)
    df = feeds.scan_zip_csv(spark, path, block_bytes=block)
    want = pd.concat([pd.read_csv(io.StringIO(t.lstrip("﻿")), dtype=str) for n, t in texts.items() if n.endswith(".csv")])
    want = sorted(((a, c, t) for a, t, c in want.astype(object).where(want.notna(), None).itertuples(index=False)), key=repr)
    assert df.columns == ["a_b", "c", "text"] and rows_of(df) == want
    assert rows_of(feeds.scan_zip_csv(spark, path, columns=["c", "nothing"], block_bytes=block)) == sorted(((c, None) for _, c, _ in want), key=repr)
    used = df.withColumn("task", F.spark_partition_id()).select("task").distinct().count()
    assert used >= 2 or block > 1000  # one archive, parsed by several tasks


def test_many_members_are_parsed_where_they_are_unpacked(spark, tmp_path):
    path = archive(tmp_path / "many.zip", {f"m{i}.csv": f"x,y\n{i},\"a\n{i}\"\n" for i in range(20)})
    df = feeds.scan_zip_csv(spark, path)
    assert df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 1
    assert rows_of(df) == sorted(((str(i), f"a\n{i}") for i in range(20)), key=repr)


def features(rng, n):
    texts = ['plain', 'br{ace', 'br]acket', 'quo"te', "back\\slash", 'end\\"', "é😀", '{"type": "Feature"}', "features", ""]
    out = []
    for i in range(n):
        kind = rng.choice(("Point", "Polygon", None))
        geometry = {"type": kind, "coordinates": [[1.5, 2], [i, {"deep": [rng.choice(texts)]}]] if i % 3 else []} if kind else None
        out.append({"type": "Feature", "properties": {"name": rng.choice(texts), "segment": str(i)} if i % 5 else None, "geometry": geometry})
    return out


@pytest.mark.parametrize("span", [3, 17, 64, 1000, 1 << 20])
def test_a_collection_in_ranges(spark, tmp_path, span):
    rng = random.Random(span)
    n = 12 if span < 10 else 120
    made = features(rng, n)
    doc = {"type": "FeatureCollection", "bbox": [{"a": 1}, 2], "crs": {"type": "x", "features": [{"no": 1}]}, "features": made, "other": [{"type": "Feature", "properties": {"name": "no"}}]}
    path = tmp_path / "big.geojson"
    path.write_text(json.dumps(doc, indent=rng.choice((None, 1)), ensure_ascii=rng.random() < 0.5))
    objects = [json.loads(r["text"]) for r in sorted(big_json.document_objects(spark, str(path), range_bytes=span).collect(), key=lambda r: r["place"])]
    assert objects == made
    if span == 64:
        split = documents.scan_geojson(spark, str(path), split_bytes=10, range_bytes=span)
        whole = documents.scan_geojson(spark, str(path))
        assert sorted(split.columns) == sorted(whole.columns) and rows_of(split.select(*whole.columns)) == rows_of(whole)


def test_a_list_document_and_several_files(spark, tmp_path):
    rows = [{"a": i, "b": "x]}" * (i % 4), "c": [{"d": 1}]} for i in range(40)]
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "one.json").write_text("  " + json.dumps(rows[:25], indent=2))
    (tmp_path / "docs" / "two.json").write_text(json.dumps(rows[25:]))
    (tmp_path / "docs" / "none.json").write_text("[]")
    split = documents.scan_geojson(spark, str(tmp_path / "docs"), split_bytes=10, range_bytes=50)
    assert sorted(r["a"] for r in split.collect()) == list(range(40)) and {len(r["c"]) for r in split.collect()} == {1}


def test_transitions_compose():
    rng = random.Random(3)
    data = json.dumps(features(rng, 30)).encode()
    for _ in range(200):
        cut = rng.randint(0, len(data))
        state, depth = big_json._transition(data[:cut], big_json.OUTSIDE)
        end, change = big_json._transition(data[cut:], state)
        assert (end, depth + change) == (big_json.OUTSIDE, 0)


def test_rows_landed_in_several_members_are_not_held():
    seen = []

    def batches():
        for i in range(30):
            seen.append(None)
            batch = pa.RecordBatch.from_pydict({"a": [f"{i}"] * 5, "b": [float(i)] * 5, "c": [None, "x,y", 'q"', "", "z"]})
            seen[-1] = weakref.ref(batch)
            yield batch
            del batch
            assert sum(r() is not None for r in seen) <= 2

    sink = io.BytesIO()
    assert adapters._write_members(sink, batches(), [["a", "b"], ["a", "c"], ["b"]]) == 150
    with zipfile.ZipFile(sink) as z:
        read = [pd.read_csv(z.open(n)) for n in sorted(z.namelist())]
    assert [list(r.columns) for r in read] == [["a", "b"], ["a", "c"], ["b"]] and [len(r) for r in read] == [150] * 3
    assert read[0]["a"].tolist() == read[0]["b"].tolist() == read[1]["a"].tolist() == [i for i in range(30) for _ in range(5)]
    assert read[1]["c"].fillna("").tolist() == ["", "x,y", 'q"', "", "z"] * 30


def test_one_archive_is_landed_by_many_tasks(spark):
    df = spark.range(0, 500, 1, 5).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("x"))
    path = adapters.land_zip_single(df, "single-test")
    texts = spark.read.format("binaryFile").load(f"{path}-texts")
    assert texts.count() == 5  # one task for each partition made text
    files = spark.read.format("binaryFile").load(path)
    assert files.count() == 1
    read = feeds.scan_zip_csv(spark, path, columns=["k", "x"]).select("k", F.col("x").cast("double"))
    assert rows_of(read) == rows_of(df)


@pytest.mark.parametrize("text", [
    "a,b,c\n1,2\n3,4,5\n", "a,a,c\n1,2,3\n", "a,b,c\n1,2,3\n\n  \n4,NA,\"null\"\n", "a,b\n1,2,3\n4,5,6\n", "a\n  \nx\n", 'a,"b ""q"""\n"l1\nl2","x, ""y"""\n,\n',
    "a,b,c\r\n1, 2 ,-nan\r\n", "a,,c\n1,2,3\n",
])
def test_blocks_are_parsed_as_by_the_plain_reader(text):
    end = text.index("\n") + 1
    header, records = text[:end].encode(), text[end:].encode()
    names = ["a", "b", "c", "b_q", "none"]
    plain = pd.read_csv(io.StringIO(text), dtype=str, usecols=lambda c: feeds.clean_name(c) in names)
    plain.columns = [feeds.clean_name(c) for c in plain.columns]
    plain = plain.reindex(columns=names).astype(object)
    got = [r for b in feeds._parse_block(header, records, names) for r in b.to_pylist()]
    assert got == plain.where(plain.notna(), None).to_dict("records")
