"""Queries over scores, metrics, curves and models."""

from __future__ import annotations

import math
import os
from zlib import crc32

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.names import feature_columns
from ..operators import scoring as SC
from ..operators import spine as S
from ..operators.patterns import high_days
from ..operators.stats import drop_all_null, exact_medians
from ..plans import modelling as M
from ..session import new_path, shared_dir
from ..sources.tables import is_there, publish, update_table
from .adapters import feed
from .registry import query, ready_table
from .sql import FEATURES, metric_sql

_METRICS = "accuracy:e precision:e recall:e f1:e roc_auc:e pr_auc:e"


def _scores(spark, sf):
    return feed(spark, sf, "fx_scores")


@query("classification_metrics", _METRICS, metric_sql("fx_scores", []))
def _(spark, sf):
    return SC.classification_metrics(_scores(spark, sf))


@query("metrics_by_model", f"model:s {_METRICS}", metric_sql("fx_scores", ["model"]))
def _(spark, sf):
    return SC.classification_metrics(_scores(spark, sf), ["model"])


@query("label_metrics", "fold:i accuracy:e precision:e recall:e f1:e",
       f"SELECT fold, accuracy, precision, recall, f1 FROM ({metric_sql('fx_scores', ['fold'])})")
def _(spark, sf):
    rows = _scores(spark, sf).withColumn("y_pred", (F.col("prob") >= 0.5).cast("int"))
    return SC.label_metrics(rows, ["fold"])


_FOLD_METRICS = metric_sql("fx_scores", ["model", "fold"])
_STATS = " ".join(f"{m}_mean:e {m}_std:e" for m in SC.METRICS)


@query("cv_summary", f"model:s {_STATS}",
       "SELECT model, " + ", ".join(f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_std" for m in SC.METRICS) + f" FROM ({_FOLD_METRICS}) GROUP BY 1")
def _(spark, sf):
    return SC.cv_summary(SC.classification_metrics(_scores(spark, sf), ["model", "fold"]))


_GAPPED = [m for m in SC.METRICS if m != "accuracy"]


@query("generalisation_gap", "model:s cv_f1_mean:e cv_f1_std:e test_f1:e f1_gap:e f1_gap_share:e avg_gap:e",
       f"SELECT model, f1_mean AS cv_f1_mean, f1_std AS cv_f1_std, f1 AS test_f1, f1_mean-f1 AS f1_gap, (f1_mean-f1)/f1_mean AS f1_gap_share, "
       f"({'+'.join(f'{m}_mean-{m}' for m in _GAPPED)})/5e0 AS avg_gap FROM (SELECT model, "
       + ", ".join(f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_std" for m in SC.METRICS)
       + f" FROM ({_FOLD_METRICS}) GROUP BY 1) JOIN ({metric_sql('fx_scores', ['model'])}) USING (model)")
def _(spark, sf):
    scores = _scores(spark, sf)
    cv = SC.cv_summary(SC.classification_metrics(scores, ["model", "fold"]))
    return SC.generalisation_gap(cv, SC.classification_metrics(scores, ["model"]))


@query("roc_auc", "model:s roc_auc:e", f"SELECT model, roc_auc FROM ({metric_sql('fx_scores', ['model'])})")
def _(spark, sf):
    return SC.roc_auc(_scores(spark, sf), ["model"])


@query("average_precision", "model:s pr_auc:e", f"SELECT model, pr_auc FROM ({metric_sql('fx_scores', ['model'])})")
def _(spark, sf):
    return SC.average_precision(_scores(spark, sf), ["model"])


_ORIGIN = "SELECT DISTINCT model, NULL AS threshold, 0e0 AS fpr, 0e0 AS tpr FROM fx_scores"
_POINT = "model, threshold, CAST(fp AS DOUBLE)/n AS fpr, CAST(tp AS DOUBLE)/p AS tpr"


def _open_threshold(df):
    # an infinite threshold has no counterpart in the comparison, show it as NULL
    return df.withColumn("threshold", F.when(F.col("threshold") < float("inf"), F.col("threshold")))


@query("roc_curve_table", "model:s threshold:e fpr:e tpr:e",
       f"SELECT {_POINT} FROM (SELECT *, lag(1) OVER v IS NULL OR lead(1) OVER v IS NULL OR lead(pos) OVER v<>pos OR lead(neg) OVER v<>neg AS corner "
       f"FROM score_ranks WINDOW v AS (PARTITION BY model ORDER BY threshold DESC)) WHERE corner UNION ALL {_ORIGIN}")
def _(spark, sf):
    return _open_threshold(SC.roc_curve(_scores(spark, sf), ["model"]))


@query("roc_curve_full", "model:s threshold:e fpr:e tpr:e", f"SELECT {_POINT} FROM score_ranks UNION ALL {_ORIGIN}")
def _(spark, sf):
    return _open_threshold(SC.roc_curve(_scores(spark, sf), ["model"], thin=False))


@query("pr_curve_table", "model:s threshold:e precision:e recall:e",
       "SELECT model, threshold, CAST(tp AS DOUBLE)/(tp+fp) AS precision, CAST(tp AS DOUBLE)/p AS recall FROM score_ranks "
       "UNION ALL SELECT DISTINCT model, NULL, 1e0, 0e0 FROM fx_scores")
def _(spark, sf):
    return SC.pr_curve(_scores(spark, sf), ["model"])


@query("positive_rate", "fold:i samples:i positive_pct:e", "SELECT fold, count(*) AS samples, 1e2*avg(y) AS positive_pct FROM fx_scores GROUP BY 1")
def _(spark, sf):
    return SC.positive_rate(_scores(spark, sf), by=["fold"])


@query("class_weights", "y:i rows:i weight:e",
       "SELECT y, count(*) AS rows, CAST((SELECT count(*) FROM fx_scores) AS DOUBLE)/(2*count(*)) AS weight FROM fx_scores GROUP BY 1")
def _(spark, sf):
    return SC.class_weights(_scores(spark, sf))


@query("stratified_folds", "y:i fold:i rows:i",
       "SELECT y, f AS fold, n//5 + CASE WHEN f < n%5 THEN 1 ELSE 0 END AS rows FROM (SELECT y, count(*) AS n, unnest(range(5)) AS f FROM fx_scores GROUP BY y)")
def _(spark, sf):
    rows = _scores(spark, sf).drop("fold")
    return SC.stratified_folds(rows, ["event_id"]).groupBy("y", "fold").agg(F.count(F.lit(1)).alias("rows"))


@query("leaderboard_upsert", "model:s version:s f1:e",
       f"SELECT model, version, f1 FROM (SELECT model, 'v1' AS version, f1 FROM ({metric_sql('fx_scores', ['model'])}) WHERE model<>'m1' "
       f"UNION ALL SELECT 'm1', NULL, f1 FROM ({metric_sql('fx_scores', [])}))")
def _(spark, sf):
    scores = _scores(spark, sf)
    board = SC.classification_metrics(scores, ["model"]).select("model", F.lit("v1").alias("version"), "f1")
    row = SC.classification_metrics(scores).select(F.lit("m1").alias("model"), "f1")
    return SC.leaderboard_upsert(board, row)


@query("leaderboard_file", "model:s version:s f1:e",
       f"SELECT model, version, f1 FROM (SELECT model, 'v1' AS version, f1 FROM ({metric_sql('fx_scores', ['model'])}) WHERE model<>'m1' "
       f"UNION ALL SELECT 'm1', NULL, f1 FROM ({metric_sql('fx_scores', [])}))")
def _(spark, sf):
    scores, path = _scores(spark, sf), new_path(spark, "leaderboard")
    board = SC.classification_metrics(scores, ["model"]).select("model", F.lit("v1").alias("version"), "f1")
    row = SC.classification_metrics(scores).select(F.lit("m1").alias("model"), "f1")
    update_table(spark, path, lambda old: board if old is None else SC.leaderboard_upsert(old, board))
    return update_table(spark, path, lambda old: SC.leaderboard_upsert(old, row))


@query("grid_select", "config:i val_f1:e",
       f"SELECT fold AS config, f1 AS val_f1 FROM ({metric_sql('fx_scores', ['fold'])}) ORDER BY f1 DESC, fold LIMIT 1")
def _(spark, sf):
    rated = SC.classification_metrics(_scores(spark, sf), ["fold"])
    return SC.top_row(rated.select(F.col("fold").alias("config"), F.col("f1").alias("val_f1")))


@query("importance_summary", "feature:s importance_mean:e importance_std:e",
       f"SELECT model AS feature, avg(f1) AS importance_mean, stddev_pop(f1) AS importance_std FROM ({_FOLD_METRICS}) GROUP BY 1")
def _(spark, sf):
    rated = SC.classification_metrics(_scores(spark, sf), ["model", "fold"])
    return SC.importance_summary(rated.select(F.col("model").alias("feature"), F.col("f1").alias("importance")))


@query("feature_ranking", "feature:s importance_mean:e",
       f"SELECT model AS feature, avg(f1) AS importance_mean FROM ({_FOLD_METRICS}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 2")
def _(spark, sf):
    rated = SC.classification_metrics(_scores(spark, sf), ["model", "fold"])
    summary = SC.importance_summary(rated.select(F.col("model").alias("feature"), F.col("f1").alias("importance")))
    return SC.feature_ranking(summary, top=2)


# ---- models on the integrated daily table, fitted in full ----
# A fit has no SQL counterpart, but what a right fit must satisfy has: the SQL states the grid, the sizes, the rows that
# are scored and the rules that scores obey; each row says whether the fitted model meets them.


#: Whether fits that ended are found by later calls. A timing of fits turns this off.
KEEP_FITS = True


def _journal(spark):
    return os.path.join(shared_dir(spark), "plumeworks-models") if KEEP_FITS else new_path(spark, "models")


def _tuned(spark, sf, family):
    """The result of ``M.tune`` and the ready rows: the grid row with the best validation F1, fitted on train and validation
    rows, and the grid results. Fits that have ended are kept one by one, and the result as a whole, in the shared folder by the
    fingerprints of the train and the validation rows and the grid, so whatever changes gives another fit."""
    ready = ready_table(spark, sf)
    train, val, _ = S.splits(ready)
    grid = f"{crc32(';'.join(map(M.params_text, family.grid)).encode()):08x}"
    journal = _journal(spark)
    path = os.path.join(journal, f"{M.FORMAT}-tuned-{family.name}-{grid}-{M.fingerprint(train)}-{M.fingerprint(val)}")
    if not is_there(spark, path):
        model, results = M.tune(family, train, val, journal=journal)

        def write(to):
            results.coalesce(1).write.parquet(f"{to}/grid")
            M.save_model(model, to, spark)

        publish(spark, path, write)
    return M.load_model(path, spark), spark.read.parquet(f"{path}/grid"), ready


def _fitted(spark, sf, family):
    model, _, ready = _tuned(spark, sf, family)
    return model, ready


def _grid_fits(spark, sf, family):
    """Every grid row fitted on the train rows: (number, params text, model), and those rows."""
    train = S.splits(ready_table(spark, sf))[0].persist()
    features = drop_all_null(train, feature_columns(train))
    models = M.fit_grid(family, family.grid, train, features, exact_medians(train, features).first().asDict(), journal=_journal(spark))
    return [(i, M.params_text(p), m) for i, (p, m) in enumerate(zip(family.grid, models), start=1)], train


def _grid_sql(family, extra):
    return " UNION ALL ".join(f"SELECT {i} AS config, '{M.params_text(p)}' AS params, {extra(p)}" for i, p in enumerate(family.grid, start=1))


def _learned(model, rows):
    """Whether the mean log loss is below that of the class share alone."""
    p = F.greatest(F.least("prob", F.lit(1 - 1e-9)), F.lit(1e-9))
    r = model.score(M.with_label(rows)).agg(F.avg(-F.log(F.when(F.col("y") == 1, p).otherwise(1 - p))).alias("loss"), F.avg("y").alias("share")).first()
    share = r["share"]
    return bool(r["loss"] < -(share * math.log(share) + (1 - share) * math.log(1 - share)))


@query("ml_logreg", "config:i params:s slope:e", _grid_sql(M.LOGREG, lambda p: "0e0 AS slope"))
def _(spark, sf):
    fits, train = _grid_fits(spark, sf, M.LOGREG)
    rows = [(i, text, round(M.steepest_slope(m, train), 4)) for i, text, m in fits]
    return spark.createDataFrame(rows, "config int, params string, slope double")


def _deepest(model):
    return max(t.depth for t in model.model.trees)


@query("ml_random_forest", "config:i params:s trees:i in_depth:b balanced:b learned:b",
       _grid_sql(M.FOREST, lambda p: f"{p['n_estimators']} AS trees, true AS in_depth, true AS balanced, true AS learned"))
def _(spark, sf):
    """Trees, their depth, whether both classes weigh the same at the root of every tree, whether the model beats the class share."""
    fits, train = _grid_fits(spark, sf, M.FOREST)
    even = lambda m: all(abs(a - b) <= 1e-6 * (a + b) for a, b in (t.root for t in m.model.trees))
    rows = [(i, text, len(m.model.trees), _deepest(m) <= m.params["max_depth"], even(m), _learned(m, train)) for i, text, m in fits]
    return spark.createDataFrame(rows, "config int, params string, trees int, in_depth boolean, balanced boolean, learned boolean")


def _first_leaves_hold(model, train):
    """Whether the leaves of the first boosted tree are -rate * G / (H + l2), with sums taken by plain aggregation of the rows
    that reach them."""
    tree, p = model.model.trees[0], model.params
    share = 1.0 / (1.0 + math.exp(-model.model.start))
    cuts = model.model.cuts
    here = {0: F.lit(True)}
    for n, f in enumerate(tree.feature):
        if f >= 0:
            low = model.prepare(train)[f] <= float(cuts[f][tree.cut[n]])
            here[int(tree.left[n])], here[int(tree.right[n])] = here[n] & low, here[n] & ~low
    leaves = [n for n, f in enumerate(tree.feature) if f < 0]
    y = M.with_label(train)
    sums = y.agg(*[F.sum(F.when(here[n], F.lit(share) - F.col("y"))).alias(f"g{n}") for n in leaves], *[F.count(F.when(here[n], 1)).alias(f"n{n}") for n in leaves]).first()
    want = [-p["learning_rate"] * sums[f"g{n}"] / (sums[f"n{n}"] * share * (1 - share) + p["l2_regularization"]) for n in leaves]
    return all(abs(tree.value[n] - w) <= 1e-6 for n, w in zip(leaves, want))


@query("ml_gbt", "config:i params:s trees:i in_depth:b leaves:b learned:b",
       _grid_sql(M.BOOST, lambda p: f"{p['max_iter']} AS trees, true AS in_depth, true AS leaves, true AS learned"))
def _(spark, sf):
    fits, train = _grid_fits(spark, sf, M.BOOST)
    rows = [(i, text, len(m.model.trees), _deepest(m) <= m.params["max_depth"], _first_leaves_hold(m, train), _learned(m, train)) for i, text, m in fits]
    return spark.createDataFrame(rows, "config int, params string, trees int, in_depth boolean, leaves boolean, learned boolean")


def _by_rule(results, model):
    """``results`` with ``chosen`` (the grid row the model has) and ``by_rule``: chosen are exactly the first maxima of val_f1."""
    whole = W.partitionBy()  # a handful of rows
    marked = results.withColumn("top", F.max("val_f1").over(whole)).withColumn("first", F.min(F.when(F.col("val_f1") == F.col("top"), F.col("config"))).over(whole))
    chosen = F.col("params") == M.params_text(model.params)
    return marked.withColumn("chosen", chosen).withColumn("by_rule", (chosen == (F.col("config") == F.col("first"))) & F.col("val_f1").between(0, 1))


@query("ml_selection", "model:s config:i params:s by_rule:b chosen:i", " UNION ALL ".join(
    f"SELECT '{f.name}' AS model, config, params, true AS by_rule, 1 AS chosen FROM ({_grid_sql(f, lambda p: '0 AS x')})" for f in (M.LOGREG, M.FOREST, M.BOOST)))
def _(spark, sf):
    """Every grid row of every family, whether the choice obeys the rule, and how many rows of the family are chosen."""
    out = None
    for family in (M.LOGREG, M.FOREST, M.BOOST):
        model, results, _ = _tuned(spark, sf, family)
        part = _by_rule(results, model).withColumn("chosen", F.count_if("chosen").over(W.partitionBy()).cast("int"))
        part = part.select(F.lit(family.name).alias("model"), "config", "params", "by_rule", "chosen")
        out = part if out is None else out.unionByName(part)
    return out


def _rule():
    return (F.col("y_pred") == (F.col("prob") >= 0.5).cast("int")) & F.col("prob").between(0, 1)


@query("predict_proba", "date:t y:i rule:b", "SELECT date, CASE WHEN pm25>=25e0 THEN 1 ELSE 0 END AS y, true AS rule FROM ready_split WHERE split='test'")
def _(spark, sf):
    model, ready = _fitted(spark, sf, M.BOOST)
    return M.score_models({M.BOOST.name: model}, S.splits(ready)[2]).select("date", "y", _rule().alias("rule"))


def _plain_metrics(scored, by):
    """The metrics again, in plain counts and ranks over y and prob, to hold the operators against."""
    w = W.partitionBy(*by)
    below = W.partitionBy(*by).orderBy("prob").rangeBetween(W.unboundedPreceding, W.currentRow)
    above = W.partitionBy(*by).orderBy(F.col("prob").desc()).rangeBetween(W.unboundedPreceding, W.currentRow)
    ranked = scored.withColumns({
        "z": (F.col("prob") >= 0.5).cast("int"), "pos": F.sum("y").over(w), "n": F.count("y").over(w),
        # the mean rank of ties is half of what is not above plus half of what is below, plus a half
        "rank": (F.count("y").over(below) + F.count("y").over(w) - F.count("y").over(above) + 1) / 2,
        "precision_here": F.sum("y").over(above) / F.count("y").over(above),
    })
    d = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, z, p, n = F.sum(F.col("y") * F.col("z")), F.sum("z"), F.sum("y"), F.count("y")
    return ranked.groupBy(*by).agg(
        F.avg((F.col("y") == F.col("z")).cast("double")).alias("accuracy"), d(tp, z).alias("precision"), d(tp, p).alias("recall"), d(2 * tp, z + p).alias("f1"),
        F.try_divide(F.sum(F.col("y") * F.col("rank")) - p * (p + 1) / 2, (p * (n - p)).cast("double")).alias("roc_auc"),
        d(F.sum(F.col("y") * F.col("precision_here")), p).alias("pr_auc"),
    )


def _agree(found, again, on):
    """Whether two metric tables agree: one row for each key, with ``agrees``."""
    near = F.lit(True)
    for m in SC.METRICS:
        near = near & (F.col(f"a.{m}").eqNullSafe(F.col(f"b.{m}")) | F.coalesce(F.abs(F.col(f"a.{m}") - F.col(f"b.{m}")) < 1e-9, F.lit(False)))
    joined = found.alias("a").join(again.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in on], "left")
    return joined.select("a.*", F.coalesce(near, F.lit(False)).alias("agrees"))


@query("metrics_row", "model:s model_version:s pm25_threshold:e in_grid:b first_maximum:b agrees:b",
       f"SELECT '{M.BOOST.name}' AS model, '{M.BOOST.version}' AS model_version, 25e0 AS pm25_threshold, true AS in_grid, true AS first_maximum, true AS agrees")
def _(spark, sf):
    """The leaderboard row, with whether its parameters are of the grid, are the first maximum of the grid's val_f1 and come
    with that value, and whether its metrics are those counted again from the predictions."""
    model, results, ready = _tuned(spark, sf, M.BOOST)
    test = S.splits(ready)[2]
    row = M.metrics_row(model, test)
    again = _plain_metrics(M.score_models({model.family: model}, test), ["model"])
    rule = _by_rule(results, model).where("chosen").select(F.col("params").alias("best_params"), "val_f1", "by_rule")
    return (
        _agree(row, again, ["model"]).join(rule, "best_params", "left")
        .withColumn("in_grid", F.col("best_params").isin([M.params_text(p) for p in M.BOOST.grid]))
        .withColumn("first_maximum", F.coalesce(F.col("by_rule") & (F.col("val_f1") == F.col("val_f1_selected")), F.lit(False)))
    )


def _all_models(spark, sf):
    fitted = [_fitted(spark, sf, f) for f in (M.LOGREG, M.FOREST, M.BOOST)]
    return {m.family: m for m, _ in fitted}, fitted[0][1]


_FAMILY_ROWS = " UNION ALL ".join(f"SELECT '{f.name}' AS model, true AS agrees" for f in (M.LOGREG, M.FOREST, M.BOOST))


@query("score_test", "model:s agrees:b", _FAMILY_ROWS)
def _(spark, sf):
    """Whether the board's metrics are those counted again from the predictions."""
    models, ready = _all_models(spark, sf)
    test = S.splits(ready)[2]
    return _agree(M.score_test(models, test), _plain_metrics(M.score_models(models, test), ["model"]), ["model"])


@query("cross_validate", "model:s agrees:b", _FAMILY_ROWS)
def _(spark, sf):
    """Whether means and deviations over the folds are those of metrics counted again from the folds' predictions."""
    models, ready = _all_models(spark, sf)
    train, val, _ = S.splits(ready)
    both = train.unionByName(val)
    again = _plain_metrics(M.folded_scores(models, both), ["model", "fold"]).groupBy(F.col("model").alias("m")).agg(
        *[f(m).alias(f"again_{m}_{k}") for m in SC.METRICS for k, f in (("mean", F.avg), ("std", F.stddev_pop))]
    )
    near = F.lit(True)
    for m in SC.METRICS:
        for k in ("mean", "std"):
            near = near & (F.abs(F.col(f"{m}_{k}") - F.col(f"again_{m}_{k}")) < 1e-9)
    cv = M.cross_validate(models, both)
    return cv.join(again, cv["model"] == again["m"], "left").select("model", F.coalesce(near, F.lit(False)).alias("agrees"))


@query("shared_folds", "rows:i folds:i differing:i",
       "SELECT count(*) AS rows, 5 AS folds, 0 AS differing FROM ready_split WHERE split IN ('train','val')")
def _(spark, sf):
    model, ready = _fitted(spark, sf, M.LOGREG)
    train, val, _ = S.splits(ready)
    scored = M.folded_scores({"one": model, "two": model}, train.unionByName(val))
    per_row = scored.groupBy("date").agg(F.count_distinct("fold").alias("k"), F.min("fold").alias("fold"))
    return per_row.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("fold").alias("folds"), F.count_if(F.col("k") > 1).alias("differing"))


@query("cross_validate_refit", "model:s valid:b", f"SELECT '{M.LOGREG.name}' AS model, true AS valid")
def _(spark, sf):
    train, val, _ = S.splits(ready_table(spark, sf))
    rows = train.unionByName(val)
    cv = M.cross_validate_refit({M.LOGREG.name: (M.LOGREG, M.LOGREG.grid[2])}, rows, drop_all_null(rows, feature_columns(rows)))
    return cv.select("model", (F.col("f1_mean").between(0, 1) & (F.col("f1_std") >= 0)).alias("valid"))


@query("permutation_importance", "feature:s repeats:i rule:b", "SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURES) + "]) AS feature, 20 AS repeats, true AS rule")
def _(spark, sf):
    """Repeats of each feature; a feature that no tree splits on must lose nothing."""
    model, ready = _fitted(spark, sf, M.BOOST)
    used = [f for i, f in enumerate(model.features) if any(t.uses(i) for t in model.model.trees)]
    rated = M.permutation_scores(model, S.splits(ready)[2]).groupBy("feature").agg(F.count("importance").alias("repeats"), F.max(F.abs("importance")).alias("most"))
    return rated.withColumn("rule", (F.col("most") <= 1) & (F.col("feature").isin(used) | (F.col("most") == 0)))


@query("model_files", "model:s date:t same:b", " UNION ALL ".join(
    f"SELECT '{f.name}' AS model, date, true AS same FROM ready_split WHERE split='test'" for f in (M.LOGREG, M.BOOST)))
def _(spark, sf):
    """A linear and a tree model, saved and loaded: whether each test day is scored as before."""
    out = None
    for family in (M.LOGREG, M.BOOST):
        model, ready = _fitted(spark, sf, family)
        path, test = new_path(spark, "model"), S.splits(ready)[2]
        M.save_model(model, path, spark)
        again = M.load_model(path, spark).score(test).select("date", F.col("prob").alias("again"))
        part = model.score(test).join(again, "date").select(F.lit(family.name).alias("model"), "date", (F.col("prob") == F.col("again")).alias("same"))
        out = part if out is None else out.unionByName(part)
    return out


@query("forecast_next_year", "date:t rule:b",
       "SELECT CAST(unnest(generate_series(hi+INTERVAL 1 DAY, hi+INTERVAL 365 DAY, INTERVAL 1 DAY)) AS DATE) AS date, true AS rule FROM (SELECT max(date) AS hi FROM ready_split)")
def _(spark, sf):
    model, ready = _fitted(spark, sf, M.BOOST)
    out = M.forecast(model, ready.drop("split"))
    flag = F.col("smoke_impact_pred") == (F.col("smoke_prob") >= 0.5).cast("int")
    return out.select("date", (flag & F.col("smoke_prob").between(0, 1) & F.col("pred_pm25").isNotNull()).alias("rule"))


@query("forecast_backtest", "date:t pm25:e y:i usual_pm25:e rule:b",
       "SELECT date, pm25, CASE WHEN pm25>=25e0 THEN 1 ELSE 0 END AS y, coalesce(u.usual, (SELECT avg(pm25) FROM ready WHERE date <= hi - INTERVAL 365 DAY)) AS usual_pm25, true AS rule "
       "FROM ready CROSS JOIN (SELECT max(date) AS hi FROM ready) LEFT JOIN (SELECT dayofyear(date) AS doy, avg(pm25) AS usual FROM ready, (SELECT max(date) AS top FROM ready) "
       "WHERE date <= top - INTERVAL 365 DAY GROUP BY 1) u ON u.doy = dayofyear(date) WHERE date > hi - INTERVAL 365 DAY")
def _(spark, sf):
    """The last year forecast from the years before, beside what came and the usual level of each day."""
    ready = ready_table(spark, sf).drop("split")
    out = M.backtest_forecast(M.LOGREG, M.LOGREG.grid[2], ready, feature_columns(ready), rounds=10)
    flag = F.col("smoke_impact_pred") == (F.col("smoke_prob") >= 0.5).cast("int")
    return out.withColumn("rule", flag & F.col("smoke_prob").between(0, 1) & F.col("pred_pm25").isNotNull())


@query("model_day_predictions", "date:t pm25:e is_high_pollution:i rule:b",
       "SELECT date, pm25, 1 AS is_high_pollution, true AS rule FROM ready_split WHERE pm25>=25e0")
def _(spark, sf):
    model, ready = _fitted(spark, sf, M.BOOST)
    out = M.event_predictions(model, high_days(ready))
    flag = F.col("predicted_label") == (F.col("prediction_probability") >= 0.5).cast("int")
    return out.select("date", "pm25", "is_high_pollution", flag.alias("rule"))
