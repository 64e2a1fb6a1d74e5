import dataclasses
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumeworks.checks import score_queries as Q
from plumeworks.operators import spine as S
from plumeworks.operators.stats import exact_medians
from plumeworks.plans import linear
from plumeworks.plans import modelling as M


@pytest.fixture(scope="module")
def ready(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(400):
        smoke = rnd.random()
        rows.append((dt.date(2023, 1, 1) + dt.timedelta(days=i), 40.0 * smoke, smoke * 10 if i % 17 else None, rnd.random(), None))
    df = spark.createDataFrame(rows, "date date, pm25 double, smoke double, noise double, empty double")
    return S.chrono_split(df)


@pytest.fixture(scope="module")
def logreg(ready):
    train, val, _ = S.splits(ready)
    return M.tune(M.LOGREG, train, val)


def test_logreg(spark, ready, logreg, tmp_path):
    model, grid = logreg
    assert model.features == ["smoke", "noise"]  # the empty column is gone
    assert [r["params"] for r in grid.orderBy("config").collect()] == ["C=0.01", "C=0.1", "C=1.0", "C=5.0", "C=10.0"]
    test = S.splits(ready)[2]
    row = M.metrics_row(model, test).first()
    assert row["model"] == "LogisticRegression" and row["f1"] > 0.75 and "model_version" not in row.asDict()
    M.save_model(model, str(tmp_path / "m"), spark)
    again = M.load_model(str(tmp_path / "m"), spark)
    assert again.score(test).select("prob").collect() == model.score(test).select("prob").collect()


def test_logreg_reaches_the_penalised_optimum(ready):
    """Against Newton's method on C * weighted loss + half the squared norm of the feature weights."""
    train = S.splits(ready)[0]
    c = 1.0
    model = M.fit_estimator(M.LOGREG, {"C": c}, train, ["smoke", "noise"], {"smoke": 5.0, "noise": 0.5}, 25.0)
    rows = train.select("smoke", "noise", "pm25").collect()
    x = np.array([[5.0 if r["smoke"] is None else r["smoke"], r["noise"]] for r in rows])
    x = np.c_[(x - x.mean(0)) / x.std(0), np.ones(len(x))]
    y = np.array([float(r["pm25"] >= 25) for r in rows])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    w = np.zeros(3)
    penalty = np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = penalty @ w + c * x.T @ (weight * (p - y))
        w -= np.linalg.solve(penalty + c * (x.T * (weight * p * (1 - p))) @ x, gradient)
    fitted = [*model.model.coefficients.toArray(), model.model.intercept]
    assert fitted == pytest.approx(list(w), rel=1e-2, abs=1e-2)


def test_trees_and_summary(ready, logreg):
    train, val, test = S.splits(ready)
    small = [{"n_estimators": 3, "max_depth": 4, "min_samples_leaf": 5}], [{"learning_rate": 0.1, "max_depth": 3, "max_iter": 3, "l2_regularization": 0.5}]
    forest, _ = M.tune(dataclasses.replace(M.FOREST, grid=small[0]), train, val)
    boost, _ = M.tune(dataclasses.replace(M.BOOST, grid=small[1]), train, val)
    assert len(forest.model.trees) == len(boost.model.trees) == 3 and boost.params == small[1][0]
    models = {m.family: m for m in (logreg[0], forest, boost)}
    board = M.score_test(models, test).collect()
    assert len(board) == 3 and [r["f1"] for r in board] == sorted((r["f1"] for r in board), reverse=True)
    assert M.metrics_row(forest, test).first()["model_version"] == "regularized"
    cv = M.cross_validate(models, train.unionByName(val)).collect()
    assert len(cv) == 3 and all(0 <= r["f1_mean"] <= 1 for r in cv)


def test_permutation_importance(ready, logreg):
    test = S.splits(ready)[2]
    scores = M.permutation_scores(logreg[0], test, repeats=4).persist()
    assert scores.count() == 8
    got = {r["feature"]: r["importance_mean"] for r in M.importance_summary(scores).collect()}
    assert got["smoke"] > 0.2 and abs(got["noise"]) < 0.1


def test_split_paths_equal_full_rescoring(ready, monkeypatch):
    train, _, test = S.splits(ready)
    model = M.fit_estimator(M.BOOST, {"learning_rate": 0.2, "max_depth": 2, "max_iter": 6, "l2_regularization": 0.1}, train, ["smoke", "noise"], {"smoke": 5.0, "noise": 0.5}, 25.0)
    quick = sorted(M.permutation_scores(model, test, repeats=3).collect())

    class Plain:  # the same scores from a model whose trees are not known
        def __getattr__(self, name):
            return getattr(model, name)

        model = None

        def score(self, df):
            return model.score(df)

    full = sorted(M.permutation_scores(Plain(), test, repeats=3).collect())
    assert [(r["feature"], r["repeat"]) for r in quick] == [(r["feature"], r["repeat"]) for r in full] and len(quick) == 6
    assert [r["importance"] for r in quick] == pytest.approx([r["importance"] for r in full], abs=1e-12)


def test_fits_that_ended_are_kept(spark, ready, tmp_path, monkeypatch):
    train = S.splits(ready)[0]
    grid = [{"learning_rate": 0.2, "max_depth": 2, "max_iter": n, "l2_regularization": 0.1} for n in (2, 3)]
    args = (train, ["smoke", "noise"], {"smoke": 5.0, "noise": 0.5}, 25.0, str(tmp_path / "kept"))
    fits, real = [], M.fit_estimators

    def stopped(family, rows, *a):
        fits.append(rows)
        if rows == [grid[1]]:
            raise RuntimeError("stopped")
        return real(family, rows, *a)

    monkeypatch.setattr(M, "fit_estimators", stopped)
    with pytest.raises(RuntimeError):
        M.fit_grid(M.BOOST, grid, *args)
    fits.clear()
    monkeypatch.setattr(M, "fit_estimators", lambda family, rows, *a: fits.append(rows) or real(family, rows, *a))
    models = M.fit_grid(M.BOOST, grid, *args)
    assert fits == [[grid[1]]] and [len(m.model.trees) for m in models] == [2, 3]
    fits.clear()
    assert [len(m.model.trees) for m in M.fit_grid(M.BOOST, grid, *args)] == [2, 3] and not fits


def test_forecast(ready, logreg):
    out = M.forecast(logreg[0], ready.drop("split"), rounds=2)
    first, last, n, flags = out.agg(F.min("date"), F.max("date"), F.count("pred_pm25"), F.max("smoke_impact_pred")).first()
    end = dt.date(2023, 1, 1) + dt.timedelta(days=399)
    assert (first, last, n) == (end + dt.timedelta(days=1), end + dt.timedelta(days=365), 365) and flags in (0, 1)


def test_queries_score_with_the_chosen_grid_row(spark, sf, ready, monkeypatch):
    """The kept fit is that of the first maximum of the validation F1, not of the last grid row."""
    monkeypatch.setattr(Q, "ready_table", lambda *_: ready)
    # heavier penalties up to all-but-no weights: the last row is the worst
    family = dataclasses.replace(M.LOGREG, grid=[{"C": 1.0}, {"C": 0.1}, {"C": 1e-9}])
    model, grid, _ = Q._tuned(spark, sf, family)
    rows = sorted(grid.collect(), key=lambda r: r["config"])
    best = max(r["val_f1"] for r in rows)
    first = next(r for r in rows if r["val_f1"] == best)
    assert M.params_text(model.params) == first["params"] != rows[-1]["params"] and model.val_f1 == best
    again, kept, _ = Q._tuned(spark, sf, family)
    assert again.trained_at == model.trained_at and sorted(kept.collect()) == sorted(grid.collect())
    assert Q._fitted(spark, sf, family)[0].params == model.params


def test_kept_boosted_model_fills_with_train_medians(spark, sf, ready, monkeypatch):
    monkeypatch.setattr(Q, "ready_table", lambda *_: ready)
    family = dataclasses.replace(M.BOOST, grid=[{"learning_rate": 0.1, "max_depth": 3, "max_iter": 2}])
    model, _ = Q._fitted(spark, sf, family)
    train, val, _ = S.splits(ready)
    assert model.fill == exact_medians(train, model.features).first().asDict() != exact_medians(train.unionByName(val), model.features).first().asDict()


def test_logistic_over_many_tasks_and_nearly_separable_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    x[:, 2] = 0.0  # a constant column gets no weight
    y = (x[:, 0] > 0).astype(int)
    df = spark.createDataFrame([([float(v) for v in row], int(t), 1.0 + i % 2) for i, (row, t) in enumerate(zip(x, y))], "features array<double>, label int, weight double")
    one, many = linear.fit_logistic(df.coalesce(1), 3, [1e-4, 10.0], one_task=True), linear.fit_logistic(df.repartition(5), 3, [1e-4, 10.0])
    for a, b, penalty in zip(one, many, (1e-4, 10.0)):
        assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), rel=1e-6, abs=1e-9) and a.coefficients[2] == 0.0
        p = 1 / (1 + np.exp(-(x @ a.coefficients.toArray() + a.intercept)))
        w = 1.0 + np.arange(300) % 2
        slope = np.r_[x.T @ (w * (p - y)) + penalty * a.coefficients.toArray(), (w * (p - y)).sum()]
        assert np.abs(slope).max() < 1e-6


def test_backtest_sees_earlier_rows_only(ready):
    history = ready.drop("split")
    args = (M.LOGREG, {"C": 1.0}, history, ["smoke", "noise"])
    tested = M.backtest_forecast(*args, days=100, rounds=2).persist()
    end = dt.date(2023, 1, 1) + dt.timedelta(days=399)
    dates = sorted(r["date"] for r in tested.collect())
    assert dates == [end - dt.timedelta(days=99 - i) for i in range(100)]
    # other values in the last days change what came, never the forecast
    moved = history.withColumns({"smoke": F.when(F.col("date") > end - dt.timedelta(days=100), -1.0).otherwise(F.col("smoke")), "pm25": F.when(F.col("date") > end - dt.timedelta(days=100), 0.0).otherwise(F.col("pm25"))})
    again = M.backtest_forecast(M.LOGREG, {"C": 1.0}, moved, ["smoke", "noise"], days=100, rounds=2)
    columns = ["date", "smoke_prob", "smoke_impact_pred", "pred_pm25", "usual_pm25"]
    assert sorted(tested.select(*columns).collect()) == sorted(again.select(*columns).collect())
    skill = M.forecast_skill(tested).first()
    rows = tested.collect()
    assert skill["days"] == 100 and skill["usual_error"] == pytest.approx(sum(abs(r["usual_pm25"] - r["pm25"]) for r in rows) / 100)
    assert skill["brier"] == pytest.approx(sum((r["smoke_prob"] - r["y"]) ** 2 for r in rows) / 100)


def test_few_rows_reach_the_one_task_of_a_fit_by_a_shuffle(ready, monkeypatch):
    seen = []
    monkeypatch.setattr(linear, "fit_logistic", lambda rows, n, penalties, one_task=False: seen.append((rows, one_task)) or [None] * len(penalties))
    train = S.splits(ready)[0]
    M.fit_estimators(M.LOGREG, M.LOGREG.grid[:1], train, ["smoke", "noise"], {"smoke": 0.0, "noise": 0.0}, 25.0)
    rows, one_task = seen[0]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # a coalesce would run the windows of all partitions in that task
    assert one_task and rows.rdd.getNumPartitions() == 1 and "Repartition 1, true" in plan and "Repartition 1, false" not in plan
