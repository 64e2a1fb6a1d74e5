"""Keyed medians, windows with a halo, the year grid and versioned tables."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from plumeworks.operators import patterns, spine, stats
from plumeworks.sources import tables


def column(rng, kind, n):
    if kind == "wide":
        return [rng.choice((-1, 1)) * 10.0 ** rng.randint(-200, 200) for _ in range(n)]
    if kind == "ties":
        return [float(rng.choice((0, 0, 0, 1))) for _ in range(n)]
    if kind == "outlier":
        return [rng.random() for _ in range(n - 1)] + [1e300]
    return [rng.gauss(0, 1) if rng.random() > 0.2 else None for _ in range(n)]


@pytest.mark.parametrize("settled", [1, 7])
def test_keyed_medians_by_refinement(spark, monkeypatch, settled):
    monkeypatch.setattr(stats.median_brackets, "__defaults__", (4, settled))
    rng = random.Random(settled)
    rows = []
    for key, n in ((1, 1), (2, 2), (3, 101), (4, 200), (5, 37)):
        rows += [(key, *cells, None) for cells in zip(*[column(rng, k, n) for k in ("wide", "ties", "outlier", "plain")])]
    rows += [(6, None, None, None, None, None), (None, 1.0, 2.0, 3.0, 4.0, None), (None, 2.0, 2.0, 3.0, 5.0, None)]
    df = spark.createDataFrame(rows, "site_id int, wide double, ties double, outlier double, plain double, empty double").repartition(3)
    columns = ["wide", "ties", "outlier", "plain", "empty"]
    got = {r["site_id"]: r for r in stats.exact_medians(df, columns, ["site_id"]).collect()}
    for key in (1, 2, 3, 4, 5, 6):
        for i, c in enumerate(columns, start=1):
            held = [r[i] for r in rows if r[0] == key and r[i] is not None]
            want = statistics.median(held) if held else None
            assert (got[key][c] is None) if want is None else math.isclose(got[key][c], want, rel_tol=1e-12)


def test_brackets_are_narrow(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i % 2, rng.gauss(0, 1)) for i in range(4000)], "k int, v double")
    for r in stats.median_brackets(df, ["v"], ["k"], bins=8, settled=50).collect():
        inside = df.where((F.col("k") == r["k"]) & F.col("v").between(r["_low"], r["_high"])).count()
        assert 1 <= inside <= 50 and r["_low"] <= 0.1 and r["_high"] >= -0.1


@pytest.mark.parametrize("spans", [1, 4])
def test_moving_mean_with_a_halo(spark, spans):
    rng = random.Random(spans)
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 900)), rng.choice((None, rng.random()))) for k in (1, 2) for _ in range(300)]
    df = spark.createDataFrame(rows, "site int, at timestamp, v double").repartition(3)
    span = 72 * 3600
    got = patterns.rolling_mean_by_time(df, "v", "at", span, ["site"], block_spans=spans)
    assert got.columns == ["site", "at", "v", "v_mean"] and got.count() == len(rows)
    for r in got.collect():
        held = [v for k, at, v in rows if k == r["site"] and v is not None and 0 <= (r["at"] - at).total_seconds() <= span]
        assert (r["v_mean"] is None) == (not held) and (not held or r["v_mean"] == pytest.approx(sum(held) / len(held)))
    assert "_to" in got._jdf.queryExecution().executedPlan().toString()


def test_year_grid_finds_its_years(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0), (dt.date(2023, 1, 5), 3.0), (dt.date(2023, 1, 6), 5.0), (dt.date(2031, 2, 1), 7.0)], "date date, pm25 double")
    got = {r["month"]: r.asDict() for r in patterns.month_year_grid(df).collect()}
    assert got[1] == {"month": 1, "2020": 1.0, "2023": 4.0, "2031": None} and got[2]["2031"] == 7.0
    assert patterns.month_year_grid(df, [2023]).columns == ["month", "2023"]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "board")
    board = tables.VersionedTable(spark, path)
    assert board.read() is None
    one = board.update(lambda old: spark.range(2) if old is None else old)
    assert one.count() == 2
    held = board.read()
    board.update(lambda old: old.union(spark.range(5, 6)))
    assert board.read().count() == 3 and held.count() == 2  # a reader keeps the version it found


def test_a_writer_that_comes_second_starts_again(spark, tmp_path):
    board = tables.VersionedTable(spark, str(tmp_path / "board"))
    board.update(lambda old: spark.range(1))
    calls = []

    def change(old):
        if not calls:  # another writer is faster
            calls.append(old.count())
            tables.VersionedTable(spark, board.path).update(lambda x: x.union(spark.range(10, 11)))
        calls.append(old.count())
        return old.union(spark.range(20, 21))

    assert sorted(r["id"] for r in board.update(change).collect()) == [0, 10, 20]
    assert calls == [1, 1, 2]


def test_a_writer_that_is_lost_leaves_the_table(spark, tmp_path):
    board = tables.VersionedTable(spark, str(tmp_path / "board"))
    board.update(lambda old: spark.range(4))
    with pytest.raises(Exception):
        board.update(lambda old: old.select(F.raise_error(F.lit("lost")).alias("id")))
    assert board.read().count() == 4


def test_publish_shows_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "made")

    def lost(to):
        spark.range(3).write.parquet(f"{to}/part")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        tables.publish(spark, path, lost)
    assert not tables.is_there(spark, path)
    tables.publish(spark, path, lambda to: spark.range(3).write.parquet(to))
    tables.publish(spark, path, lambda to: spark.range(9).write.parquet(to))  # the first one counts
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("train,val,what", [(0.0, 0.1, "train share"), (1.2, 0.1, "train share"), (0.7, -0.1, "validation share"), (0.7, 1.0, "validation share"), (0.7, 0.3, "nothing for the test")])
def test_split_shares(spark, train, val, what):
    with pytest.raises(ValueError, match=what):
        spine.chrono_split(spark.range(1), train, val)
