import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from plumeworks.operators import events, patterns, scoring
from plumeworks.operators import spine as S


def scored(spark, y, p):
    return spark.createDataFrame(list(zip(range(len(y)), y, map(float, p))), "id bigint, y int, prob double")


def brute(y, p, cut=0.5):
    """Metrics from their definitions: pairs for ROC, steps per distinct score for AP."""
    pos = [b for a, b in zip(y, p) if a]
    neg = [b for a, b in zip(y, p) if not a]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, before = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp = sum(1 for a, b in zip(y, p) if b >= t and a)
        recall = tp / len(pos)
        ap += (recall - before) * tp / sum(1 for b in p if b >= t)
        before = recall
    z = [int(b >= cut) for b in p]
    tp = sum(a and b for a, b in zip(y, z))
    precision = tp / sum(z) if sum(z) else 0.0
    recall = tp / len(pos)
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return {"accuracy": sum(a == b for a, b in zip(y, z)) / len(y), "precision": precision, "recall": recall, "f1": f1, "roc_auc": auc, "pr_auc": ap}


def test_known_scores(spark):
    m = scoring.classification_metrics(scored(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])).first()
    assert m["roc_auc"] == pytest.approx(0.75) and m["pr_auc"] == pytest.approx(5 / 6)
    none = scoring.classification_metrics(scored(spark, [0, 1], [0.1, 0.2])).first()
    assert none["precision"] == 0.0 and none["f1"] == 0.0
    one_class = scoring.classification_metrics(scored(spark, [0, 0], [0.1, 0.9])).first()
    assert one_class["roc_auc"] is None and one_class["recall"] == 0.0


@pytest.mark.parametrize("blocks", [2, 16, 256])
def test_metrics_and_curves_against_brute_force(spark, blocks):
    rnd = random.Random(blocks)
    y = [int(rnd.random() < 0.3) for _ in range(300)]
    p = [min(1.0, round(rnd.random() * 0.6 + 0.4 * a * rnd.random(), 2)) if rnd.random() < 0.7 else 0.5 for a in y]
    df = scored(spark, y, p)
    got = scoring.classification_metrics(df, blocks=blocks).first().asDict()
    for name, want in brute(y, p).items():
        assert got[name] == pytest.approx(want), name
    squeezed = scoring.roc_auc(df.withColumn("prob", F.col("prob") ** 3), blocks=blocks).first()[0]
    assert squeezed == pytest.approx(got["roc_auc"])
    full = sorted((r["fpr"], r["tpr"]) for r in scoring.roc_curve(df, thin=False, blocks=blocks).collect())
    thin = sorted((r["fpr"], r["tpr"]) for r in scoring.roc_curve(df, blocks=blocks).collect())
    area = lambda c: sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(c, c[1:]))
    assert full[0] == (0.0, 0.0) and full[-1] == (1.0, 1.0) and set(thin) <= set(full)
    assert area(full) == pytest.approx(got["roc_auc"]) and area(thin) == pytest.approx(got["roc_auc"])
    curve = scoring.pr_curve(df, blocks=blocks).collect()
    assert len(curve) == len(set(p)) + 1 and [r for r in curve if r["threshold"] is None][0]["precision"] == 1.0


def test_thin_curve_points(spark):
    # equal steps in a row lie on a straight line
    df = scored(spark, [1, 1, 0, 0, 1], [0.9, 0.8, 0.7, 0.6, 0.5])
    thin = sorted((r["fpr"], round(r["tpr"], 6)) for r in scoring.roc_curve(df, blocks=3).collect())
    assert thin == sorted([(0.0, 0.0), (0.0, round(1 / 3, 6)), (0.0, round(2 / 3, 6)), (1.0, round(2 / 3, 6)), (1.0, 1.0)])


def test_folds_balance_and_repeat(spark):
    df = scored(spark, [int(i % 10 == 0) for i in range(1003)], [0.5] * 1003)
    one = scoring.stratified_folds(df, ["id"])
    sizes = {}
    for r in one.groupBy("y", "fold").count().collect():
        sizes.setdefault(r["y"], []).append(r["count"])
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())
    again = scoring.stratified_folds(df.repartition(7), ["id"])
    assert sorted(one.select("id", "fold").collect()) == sorted(again.select("id", "fold").collect())
    assert one.count() == 1003


def test_leaderboard(spark):
    board = spark.createDataFrame([("a", "v1", 0.5), ("b", "v1", 0.9)], "model string, version string, f1 double")
    row = spark.createDataFrame([("a", 0.7)], "model string, f1 double")
    new = scoring.leaderboard_upsert(board, row)
    assert [tuple(r) for r in new.collect()] == [("b", "v1", 0.9), ("a", None, 0.7)]
    assert new.collect() == scoring.leaderboard_upsert(new, row).collect()


def test_published_gap(spark):
    cv = spark.createDataFrame([("rf", 0.9645996947928687, 0.5175229097278433, 0.959047619047619, 0.668872794711304, 0.05572318703982177, 0.990880573996612, 0.8252356764274408)],
                               "model string, accuracy_mean double, precision_mean double, recall_mean double, f1_mean double, f1_std double, roc_auc_mean double, pr_auc_mean double")
    test = spark.createDataFrame([("rf", 0.952112676056338, 0.4166666666666667, 0.7692307692307693, 0.5405405405405406, 0.9556905083220872, 0.6004117227801438)],
                                 "model string, accuracy double, precision double, recall double, f1 double, roc_auc double, pr_auc double")
    r = scoring.generalisation_gap(cv, test).first()
    assert r["f1_gap"] == pytest.approx(0.12833225417076344) and r["avg_gap"] == pytest.approx(0.13580387327412233)


def test_grid_and_ranking_ties(spark):
    g = spark.createDataFrame([(1, 0.4), (2, 0.6), (3, 0.6)], "config int, val_f1 double")
    assert scoring.top_row(g).first()["config"] == 2
    imp = spark.createDataFrame([("b", 0.1), ("a", 0.1), ("c", 0.3)], "feature string, importance_mean double")
    assert [r["feature"] for r in scoring.feature_ranking(imp, 2).collect()] == ["c", "a"]


def daily(spark, start, values):
    first = dt.date.fromisoformat(start)
    return spark.createDataFrame([(first + dt.timedelta(days=i), v) for i, v in enumerate(values)], "date date, pm25 double")


def test_patterns(spark):
    days = daily(spark, "2024-04-12", [30.0 if i in (95, 96, 120) else 5.0 + i % 3 for i in range(355)])
    monthly = patterns.monthly_patterns(days)
    top = patterns.peak_and_safest(monthly).first()
    assert (top["peak_month_name"], top["peak_days"], top["safest_month_name"]) == ("Jul", 2, "Jan")
    yearly = {r["year"]: r for r in patterns.yearly_patterns(days).collect()}
    assert yearly[2024]["total_days"] == 264 and yearly[2024]["high_pollution_ratio"] == 3 / 264 and yearly[2025]["high_pollution_days"] == 0
    trend = patterns.trend_label(patterns.yearly_patterns(days)).first()
    assert trend["trend"] == "DECREASING"
    o = patterns.overall_summary(days).first()
    assert (o["total_days"], o["duration_days"], o["high_days"]) == (355, 354, 3)
    assert str(o["last_date"]) == "2025-04-01"


def test_published_forecast_roll_up(spark):
    rows = [("2025-04-02", 3.0069631535385777e-06, 0, 4.623999661676364), ("2025-04-03", 1.757666339571511e-05, 0, 6.165210579805745), ("2025-05-01", 0.5, 1, 1.0)]
    df = spark.createDataFrame(rows, "date string, smoke_prob double, smoke_impact_pred int, pred_pm25 double").withColumn("date", F.to_date("date"))
    got = {r["month"]: r for r in patterns.forecast_monthly(df).collect()}
    assert got["2025-04"]["mean_pred_pm25"] == pytest.approx((4.623999661676364 + 6.165210579805745) / 2)
    assert got["2025-05"]["smoke_days"] == 1
    assert S.future_spine(daily(spark, "2025-04-01", [1.0])).agg(F.min("date"), F.max("date"), F.count("*")).first() == (dt.date(2025, 4, 2), dt.date(2026, 4, 1), 365)


def test_events(spark):
    rows = [(dt.date(2024, 7, 24), 134.0, None, 45.0, 3.0), (dt.date(2024, 7, 26), 134.0, 2.0, 10.0, 0.0), (dt.date(2024, 8, 15), 53.5, 4.5, 0.0, 1.0)]
    high = spark.createDataFrame(rows, "date date, pm25 double, era5_wind_speed_mean_ms double, era5_wind_from_deg double, fire_count double")
    top = events.top_events(high)
    assert [(r["event_rank"], r["date"].day) for r in top.orderBy("event_rank").collect()] == [(1, 24), (2, 26)]
    line = events.timeline(high)
    shown = {r["date"]: r for r in line.collect()}
    assert len(shown) == 29 and shown[dt.date(2024, 7, 24)]["era5_wind_speed_mean_ms"] is None and shown[dt.date(2024, 7, 25)]["pm25"] == 15.0
    assert shown[dt.date(2024, 7, 24)]["upwind_fire_count"] == 0.0
    windows = events.event_windows(top, line)
    plan = windows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    frames = events.day_frames(windows, geometry=True).collect()
    first = sorted((f for f in frames if f["event_rank"] == 1), key=lambda f: f["day_num"])
    assert len(first) == 8 and [f["is_peak"] for f in first] == [False, False, False, True, False, False, False, False]
    assert first[0]["event_name"] == "Event #1 - PM2.5 Peak: 134.0 ug/m3" and first[3]["fire"] == "Yes" and first[3]["wind_color"] == "red"
    assert first[0]["major_axis"] == pytest.approx(50 * 0.6 * 1.25) and len(first[0]["ellipse"]["coordinates"][0]) == 65
    seven = events.playback(high, line).groupBy("event_number").count().collect()
    assert {r["event_number"]: r["count"] for r in seven} == {1: 7, 2: 7, 3: 4}
    assert math.isclose(first[0]["direction"], 0.0)
