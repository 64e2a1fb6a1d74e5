"""Event models: tuning, scoring, permutation importance, forecast. The fits are those of ``linear`` and ``trees``.

Class probability is always read from the model's probability vector and cut
explicitly, so every model family shares one rule.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.levels import PM25_THRESHOLD, exceeds, predicted_label
from ..functions.names import feature_columns
from ..operators.ordering import shuffled_position
from ..operators.scoring import METRICS, class_weights, classification_metrics, cv_summary, importance_summary, label_metrics, ratio, stratified_folds, top_row
from ..operators.spine import future_spine
from ..operators.stats import drop_all_null, exact_medians, moments
from ..sources.tables import is_there, publish
from . import linear, trees

SEED = 42

# The published grids. Leaf sizes imply the split sizes (twice the leaf).
LOGREG_GRID = [{"C": 0.01}, {"C": 0.1}, {"C": 1.0}, {"C": 5.0}, {"C": 10.0}]
FOREST_GRID = [
    {"n_estimators": 200, "max_depth": 5, "min_samples_leaf": 15, "min_samples_split": 30},
    {"n_estimators": 300, "max_depth": 7, "min_samples_leaf": 20, "min_samples_split": 40},
    {"n_estimators": 300, "max_depth": 10, "min_samples_leaf": 30, "min_samples_split": 60},
    {"n_estimators": 400, "max_depth": 5, "min_samples_leaf": 25, "min_samples_split": 50},
]
BOOST_GRID = [
    {"learning_rate": 0.01, "max_depth": 4, "max_iter": 300, "l2_regularization": 1.0},
    {"learning_rate": 0.02, "max_depth": 5, "max_iter": 400, "l2_regularization": 0.1},
    {"learning_rate": 0.02, "max_depth": 4, "max_iter": 500, "l2_regularization": 0.01},
    {"learning_rate": 0.015, "max_depth": 5, "max_iter": 350, "l2_regularization": 0.5},
]


@dataclass(frozen=True)
class Family:
    """A model family: its names, grid and how a grid row becomes an estimator."""

    name: str
    version: str | None
    grid: list[dict]
    scale: bool = False
    weighted: bool = True
    refit_fill: bool = True


LOGREG = Family("LogisticRegression", None, LOGREG_GRID, scale=True)
FOREST = Family("RandomForest_Improved_V1", "regularized", FOREST_GRID)
# medians come from the train rows only, also for the final fit
BOOST = Family("HistGradientBoosting_Improved_V1", "l2_regularized", BOOST_GRID, weighted=False, refit_fill=False)


@dataclass
class EventModel:
    """A fitted model with everything needed to score raw feature columns."""

    family: str
    features: list[str]
    fill: dict[str, float]
    centre: dict[str, float]
    spread: dict[str, float]
    model: linear.LinearModel | trees.Ensemble
    params: dict
    threshold: float = PM25_THRESHOLD
    val_f1: float | None = None
    version: str | None = None
    trained_at: str = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat())

    def prepare(self, df: DataFrame) -> list[Column]:
        """Feature columns, filled and (if the family asks for it) standardised."""
        return self.prepare_from("")

    def prepare_from(self, prefix: str) -> list[Column]:
        """The same for features that stand in a struct."""
        out = []
        for c in self.features:
            value = F.coalesce(F.col(f"{prefix}{c}").cast("double"), F.lit(self.fill.get(c)))
            if self.spread:
                value = (value - F.lit(self.centre[c])) / F.lit(self.spread[c] or 1.0)
            out.append(value.alias(c))
        return out

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``prob`` (class 1) and ``y_pred``."""
        values = self.prepare(df)
        scored = df.withColumn("prob", self.model.probability(F.array(*values) if isinstance(self.model, trees.Ensemble) else values))
        return scored.withColumn("y_pred", predicted_label(F.col("prob"))).select(*df.columns, "prob", "y_pred")


def _one_row(df: DataFrame) -> dict[str, float]:
    """A one-row aggregate as a dict (one number per feature column)."""
    return df.first().asDict()


#: Training rows of a partition of a logistic fit, which passes over the rows about ten times.
FIT_ROWS = 20_000
#: Changes with what a kept fit holds or how it is made.
FORMAT = "f5"


def _filled(train: DataFrame, features: list[str], fill: dict, threshold: float) -> DataFrame:
    return train.select(
        *[F.coalesce(F.col(c).cast("double"), F.lit(fill[c])).alias(c) for c in features],
        exceeds(F.col("pm25"), threshold).alias("label"),
    )


def _logistic(grid: Sequence[dict], filled: DataFrame, features: list[str], threshold: float, fill: dict) -> list[EventModel]:
    m = _one_row(moments(filled, features))
    centre = {c: m[f"mean_{c}"] for c in features}
    spread = {c: m[f"std_{c}"] or 1.0 for c in features}
    shells = [EventModel(LOGREG.name, features, fill, centre, spread, None, p, threshold, version=LOGREG.version) for p in grid]
    weight = F.lit(1.0)
    balanced = class_weights(filled, "label").collect()
    for r in balanced if len(balanced) == 2 else []:
        weight = F.when(F.col("label") == r["label"], r["weight"]).otherwise(weight)
    data = filled.select(F.array(*shells[0].prepare(filled)).alias("features"), "label", weight.alias("weight"))
    rows = sum(r["rows"] for r in balanced)
    few = rows <= FIT_ROWS
    # few rows are shuffled into one task: a coalesce would run every partition's windows and sorts in it and hold all their pages
    data = data.repartition(1 if few else -(-rows // FIT_ROWS))
    for shell, model in zip(shells, linear.fit_logistic(data, len(features), [1.0 / p["C"] for p in grid], few)):
        shell.model = model
    return shells


def fit_estimators(
    family: Family, grid: Sequence[dict], train: DataFrame, features: list[str], fill: dict, threshold: float, journal: str | None = None
) -> list[EventModel]:
    """Fit grid rows in full; trees of all rows grow side by side. ``journal``: a folder for boosting rounds that are done."""
    filled = _filled(train, features, fill, threshold)
    if family.scale:
        return _logistic(grid, filled, features, threshold, fill)
    kind = "forest" if family.weighted else "boost"
    fitted = trees.fit_ensembles(kind, grid, filled, features, F.col("label"), F.xxhash64(*filled.columns), SEED, journal=journal)
    return [EventModel(family.name, features, fill, {}, {}, m, p, threshold, version=family.version) for p, m in zip(grid, fitted)]


def fit_estimator(family: Family, params: dict, train: DataFrame, features: list[str], fill: dict, threshold: float) -> EventModel:
    return fit_estimators(family, [params], train, features, fill, threshold)[0]


def fingerprint(df: DataFrame) -> str:
    """Names a table by its rows."""
    return "-".join(str(x) for x in df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns))).first())


def fit_grid(
    family: Family, grid: Sequence[dict], train: DataFrame, features: list[str], fill: dict, threshold: float = PM25_THRESHOLD, journal: str | None = None
) -> list[EventModel]:
    """Every grid row fitted on ``train``.

    With ``journal``, a shared folder, a fit that has ended is published there by a rename, under the rows, the fill values and
    the grid row; a later call loads it. So a stopped call loses at most the fits that had not ended, and of boosting
    over many rows only the rounds since the last kept ones. Small tables fit one grid row per job, so that each is published by itself.
    """
    if journal is None:
        return fit_estimators(family, grid, train, features, fill, threshold)
    spark = train.sparkSession
    settled = json.dumps([features, fill, threshold, family.name], sort_keys=True)
    base = os.path.join(journal, f"{FORMAT}-{family.name}-{fingerprint(train.select(*features, 'pm25'))}-{crc32(settled.encode()):08x}")
    paths = [f"{base}-{crc32(params_text(p).encode()):08x}" for p in grid]
    missing = [i for i, p in enumerate(paths) if not is_there(spark, p)]
    fitted: dict[int, EventModel] = {}

    def fit(rows: list[int]) -> None:
        models = fit_estimators(family, [grid[i] for i in rows], train, features, fill, threshold, f"{base}-rounds-{len(rows)}-{rows[0]}")
        for i, model in zip(rows, models):
            fitted[i] = model
            publish(spark, paths[i], lambda path, m=model: save_model(m, path, spark))

    if missing and (family.scale or family.name == BOOST.name and train.count() > trees.LOCAL_ROWS):
        fit(missing)
    else:
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda i: fit([i]), missing))
    return [fitted[i] if i in fitted else load_model(p, spark) for i, p in enumerate(paths)]


def steepest_slope(model: EventModel, train: DataFrame) -> float:
    """Largest absolute slope of the penalised, class-weighted log loss at a logistic model's coefficients: 0 at the optimum."""
    labelled = train.withColumn("label", exceeds(F.col("pm25"), model.threshold))
    weights = {r["label"]: (r["rows"], r["weight"]) for r in class_weights(labelled, "label").collect()}
    rows = sum(n for n, _ in weights.values())
    weight = F.when(F.col("label") == 1, weights[1][1]).otherwise(weights[0][1])
    pull = weight * (F.col("prob") - F.col("label"))
    scored = model.score(labelled)
    sums = scored.agg(F.sum(pull).alias("_free"), *[F.sum(pull * c).alias(n) for n, c in zip(model.features, model.prepare(scored))]).first()
    penalty = 1.0 / (model.params["C"] * rows)
    slopes = [sums[n] / rows + penalty * w for n, w in zip(model.features, model.model.coefficients.toArray())]
    return float(max(abs(x) for x in [*slopes, sums["_free"] / rows]))


def tune(
    family: Family, train: DataFrame, val: DataFrame, keys: Sequence[str] = (), threshold: float = PM25_THRESHOLD,
    max_rows_for_plain_median: int | None = None, journal: str | None = None,
) -> tuple[EventModel, DataFrame]:
    """Choose the grid row with the best validation F1, then refit on train + validation.

    Returns the model and the grid results. All validation scores are rated in one grouped job. With ``journal``, fits
    that have ended are kept, see :func:`fit_grid`.
    """
    spark = train.sparkSession
    train, val = train.persist(), val.persist()
    features = drop_all_null(train, feature_columns(train, keys))

    def medians(df: DataFrame) -> dict[str, float]:
        return _one_row(exact_medians(df, features, max_group_rows=max_rows_for_plain_median))

    fill = medians(train)
    fitted = fit_grid(family, family.grid, train, features, fill, threshold, journal)
    labelled = val.withColumn("y", exceeds(F.col("pm25"), threshold))
    scored = None
    for number, m in enumerate(fitted, start=1):
        part = m.score(labelled).select(F.lit(number).alias("config"), "y", "y_pred")
        scored = part if scored is None else scored.unionByName(part)
    names = spark.createDataFrame([(i, params_text(p)) for i, p in enumerate(family.grid, start=1)], "config int, params string")
    results = label_metrics(scored, ["config"]).withColumnRenamed("f1", "val_f1").join(F.broadcast(names), "config")
    # a handful of rows, one per grid row
    rows = sorted(results.collect(), key=lambda r: r["config"])
    kept = spark.createDataFrame(rows, results.schema)
    best = top_row(kept).first()
    both = train.unionByName(val)
    final = fit_grid(
        family, [family.grid[best["config"] - 1]], both, features, medians(both) if family.refit_fill else fill, threshold, journal
    )[0]
    final.val_f1 = best["val_f1"]
    train.unpersist()
    val.unpersist()
    return final, kept


def params_text(params: dict) -> str:
    return ",".join(f"{k}={v}" for k, v in params.items())


def with_label(df: DataFrame, threshold: float = PM25_THRESHOLD) -> DataFrame:
    return df.withColumn("y", exceeds(F.col("pm25"), threshold))


def score_models(models: dict[str, EventModel], df: DataFrame, keep: Sequence[str] = ("date",)) -> DataFrame:
    """All models' scores as one table keyed by ``model``."""
    labelled = with_label(df)
    out = None
    for name, m in models.items():
        part = m.score(labelled).select(F.lit(name).alias("model"), *keep, "y", "prob", "y_pred")
        out = part if out is None else out.unionByName(part)
    return out


def score_test(models: dict[str, EventModel], test: DataFrame) -> DataFrame:
    """Test metrics of every model from one grouped job, best F1 first."""
    return classification_metrics(score_models(models, test), ["model"]).orderBy(F.desc_nulls_last("f1"), "model")


def folded_scores(models: dict[str, EventModel], df: DataFrame, identity: Sequence[str] = ("date",), folds: int = 5) -> DataFrame:
    """All models' scores with the fold of each row. Folds are dealt to the rows once, before scoring, so all models share them."""
    dealt = stratified_folds(with_label(df), identity, folds=folds)
    return score_models(models, dealt.drop("y"), [*identity, "fold"])


def cross_validate(models: dict[str, EventModel], df: DataFrame, identity: Sequence[str] = ("date",), folds: int = 5) -> DataFrame:
    """Per-model mean and std over stratified folds. The fitted models are rated, not refitted."""
    return cv_summary(classification_metrics(folded_scores(models, df, identity, folds), ["model", "fold"]))


def cross_validate_refit(
    families: dict[str, tuple[Family, dict]], df: DataFrame, features: list[str], identity: Sequence[str] = ("date",), folds: int = 5,
    threshold: float = PM25_THRESHOLD,
) -> DataFrame:
    """The same with a fresh fit per fold: each fold is scored by models that saw only the others."""
    dealt = stratified_folds(with_label(df, threshold), identity, folds=folds).drop("y")
    scored = None
    for fold in range(folds):
        rest = dealt.filter(F.col("fold") != fold)
        fill = _one_row(exact_medians(rest, features))
        models = {name: fit_estimator(family, params, rest, features, fill, threshold) for name, (family, params) in families.items()}
        part = score_models(models, dealt.filter(F.col("fold") == fold), [*identity, "fold"])
        scored = part if scored is None else scored.unionByName(part)
    return cv_summary(classification_metrics(scored, ["model", "fold"]))


def metrics_row(model: EventModel, test: DataFrame) -> DataFrame:
    """One row for the leaderboard."""
    rated = classification_metrics(model.score(with_label(test, model.threshold)))
    extra = [F.lit(model.version).alias("model_version")] if model.version else []
    return rated.select(
        F.lit(model.family).alias("model"),
        *extra,
        F.lit(model.threshold).alias("pm25_threshold"),
        F.lit(params_text(model.params)).alias("best_params"),
        F.lit(model.val_f1).cast("double").alias("val_f1_selected"),
        *METRICS,
        F.lit(model.trained_at).alias("trained_at_utc"),
    )


def save_model(model: EventModel, path: str, spark: SparkSession) -> None:
    """Coefficients or trees as rows, and one metadata row."""
    if isinstance(model.model, trees.Ensemble):
        spark.createDataFrame(model.model.rows(), "number int, tree string").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    else:
        rows = [(model.model.coefficients.toArray().tolist(), model.model.intercept)]
        spark.createDataFrame(rows, "coefficients array<double>, intercept double").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    row = (
        model.family, model.features, model.fill, model.centre, model.spread, json.dumps(model.params),
        model.threshold, model.val_f1, model.version, model.trained_at,
    )
    schema = (
        "family string, features array<string>, fill map<string,double>, centre map<string,double>, "
        "spread map<string,double>, params string, threshold double, val_f1 double, version string, trained_at string"
    )
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def load_model(path: str, spark: SparkSession) -> EventModel:
    m = spark.read.parquet(f"{path}/meta").first()
    kept = spark.read.parquet(f"{path}/model").collect()  # a line for each tree, or one
    if m["family"] in (FOREST.name, BOOST.name):
        stage = trees.Ensemble.from_rows([tuple(r) for r in kept])
    else:
        stage = linear.LinearModel(DenseVector(kept[0]["coefficients"]), kept[0]["intercept"])
    return EventModel(
        m["family"], list(m["features"]), dict(m["fill"]), dict(m["centre"]), dict(m["spread"]), stage, json.loads(m["params"]),
        m["threshold"], m["val_f1"], m["version"], m["trained_at"],
    )


def permutation_scores(
    model: EventModel, df: DataFrame, identity: Sequence[str] = ("date",), repeats: int = 20, seed: int = SEED
) -> DataFrame:
    """``feature, repeat, importance``: the F1 lost when one feature is shuffled.

    One shuffle of the rows per repeat serves all features: the row at position i of a
    fixed order is paired (equi-join) with the row at position i of a random order, and
    every feature in turn takes the partner's value. Work is rows x features x repeats,
    spread over all tasks; of an ensemble, only the trees that split on the feature are scored again.
    """
    features = model.features
    labelled = with_label(df, model.threshold)
    base = labelled.select(*identity, "y", F.struct(*features).alias("own"))
    rounds = base.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    fixed = shuffled_position(rounds, identity, seed, keys=["repeat"])
    # the same rows in another order per repeat
    mixed = shuffled_position(rounds, identity, seed + 1, keys=["repeat"])
    partners = mixed.select("repeat", "position", F.col("own").alias("other"))
    paired = fixed.select(*identity, "repeat", "position", "y", "own").join(partners, ["repeat", "position"])
    if isinstance(model.model, trees.Ensemble):
        rated = _rescored_trees(model, paired)
        baseline = label_metrics(model.score(labelled)).select("f1")
        return rated.select("feature", "repeat", (baseline.scalar() - F.col("f1")).alias("importance"))
    each = paired.withColumn("feature", F.explode(F.array(*[F.lit(c) for c in features])))
    shuffled = each.select(
        "feature", "repeat", "y",
        *[F.when(F.col("feature") == c, F.col(f"other.{c}")).otherwise(F.col(f"own.{c}")).alias(c) for c in features],
    )
    rated = label_metrics(model.score(shuffled), ["feature", "repeat"]).select("feature", "repeat", "f1")
    baseline = label_metrics(model.score(labelled)).select("f1")
    return rated.select("feature", "repeat", (baseline.scalar() - F.col("f1")).alias("importance"))


def _rescored_trees(model: EventModel, paired: DataFrame) -> DataFrame:
    """feature, repeat, f1 when each feature in turn takes the partner's value.

    The sum over the trees that don't split on a feature stays; per batch and feature only the others are walked again.
    """
    ensemble, features = model.model, model.features
    shared = paired.sparkSession.sparkContext.broadcast(ensemble)
    sides = [F.array(*model.prepare_from(f"{side}.")).alias(side) for side in ("own", "other")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = shared.value
        using = [[i for i, t in enumerate(e.trees) if t.uses(f)] for f in range(len(features))]
        for batch in batches:
            repeats, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("repeat", "y"))
            own, other = (e.binned(batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(features))) for c in ("own", "other"))
            each = [t.value[t.leaves(own)] for t in e.trees]
            total = np.sum(each, axis=0) if each else np.zeros(len(y))
            for f, name in enumerate(features):
                mixed = own.copy()
                mixed[:, f] = other[:, f]
                changed = total.copy()
                for i in using[f]:
                    changed += e.trees[i].value[e.trees[i].leaves(mixed)] - each[i]
                chosen = e.probability_of(changed) >= 0.5
                for r in np.unique(repeats):
                    on = repeats == r
                    sums = [int((chosen & (y == 1) & on).sum()), int((chosen & on).sum()), int(((y == 1) & on).sum())]
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([int(r)], pa.int32()), *[pa.array([x], pa.int64()) for x in sums]], ["feature", "repeat", "tp", "z", "p"])

    counted = paired.select("repeat", "y", *sides).mapInArrow(run, "feature string, repeat int, tp long, z long, p long")
    summed = counted.groupBy("feature", "repeat").agg(*[F.sum(c).alias(c) for c in ("tp", "z", "p")])
    return summed.select("feature", "repeat", ratio(F.col("tp") * 2, F.col("p") + F.col("z")).alias("f1"))


def permutation_importance(model: EventModel, df: DataFrame, identity: Sequence[str] = ("date",), repeats: int = 20) -> DataFrame:
    return importance_summary(permutation_scores(model, df, identity, repeats))


def climatology(history: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean of each feature by day of the year."""
    return history.groupBy(*keys, F.dayofyear("date").alias("day_of_year")).agg(*[F.avg(c).alias(c) for c in features])


def fit_level(history: DataFrame, features: list[str], rounds: int = 50) -> tuple[Transformer, dict[str, float]]:
    """Boosted regression of the concentration itself."""
    fill = _one_row(exact_medians(history, features))
    rows = history.select("pm25", *[F.coalesce(F.col(c).cast("double"), F.lit(fill[c])).alias(c) for c in features])
    data = VectorAssembler(inputCols=features, outputCol="_features").transform(rows)
    est = GBTRegressor(featuresCol="_features", labelCol="pm25", predictionCol="pred_pm25", maxIter=rounds, maxDepth=4, seed=SEED)
    return est.fit(data), fill


def forecast(
    model: EventModel, history: DataFrame, days: int = 365, keys: Sequence[str] = (), rounds: int = 50
) -> DataFrame:
    """Daily event probability, flag and level for the days after the last one.

    Features of a future day are the means of that day of the year (29 February and
    other unseen days fall back to the medians). The flag is ``probability >= 0.5``.
    """
    features = model.features
    level, fill = fit_level(history, features, rounds)
    ahead = future_spine(history, days, keys).withColumn("day_of_year", F.dayofyear("date"))
    typical = climatology(history, features, keys)
    future = ahead.join(typical, [*keys, "day_of_year"], "left")
    scored = model.score(future)
    ready = scored.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fill[c])) for c in features})
    out = level.transform(ready.withColumn("_features", array_to_vector(F.array(*features))))
    return out.select(
        *keys, "date",
        F.col("prob").alias("smoke_prob"),
        F.col("y_pred").alias("smoke_impact_pred"),
        "pred_pm25",
        F.lit(model.threshold).alias("pm25_threshold"),
    )


def backtest_forecast(
    family: Family, params: dict, history: DataFrame, features: list[str], days: int = 365, threshold: float = PM25_THRESHOLD, rounds: int = 50
) -> DataFrame:
    """The forecast of the last ``days`` of ``history`` from what was known before, beside what came.

    Model, level and climatology see earlier rows only. ``usual_pm25`` is the day-of-year mean of the earlier concentration itself,
    the forecast that any other has to beat.
    """
    end = history.agg(F.max("date")).first()[0]
    start = end - dt.timedelta(days=days)
    past, later = history.where(F.col("date") <= F.lit(start)), history.where(F.col("date") > F.lit(start))
    fill = _one_row(exact_medians(past, features))
    model = fit_estimator(family, params, past, features, fill, threshold)
    ahead = forecast(model, past, (end - start).days, rounds=rounds)
    usual = past.groupBy(F.dayofyear("date").alias("_doy")).agg(F.avg("pm25").alias("usual_pm25"))
    overall = past.agg(F.avg("pm25").alias("pm25"))
    known = with_label(later, threshold).select("date", "pm25", "y").withColumn("_doy", F.dayofyear("date")).join(F.broadcast(usual), "_doy", "left")  # at most 366 rows
    filled = known.withColumn("usual_pm25", F.coalesce("usual_pm25", overall.select("pm25").scalar())).drop("_doy")
    return filled.join(ahead, "date").select("date", "pm25", "y", "smoke_prob", "smoke_impact_pred", "pred_pm25", "usual_pm25")


def forecast_skill(tested: DataFrame) -> DataFrame:
    """days, mean absolute errors of the level and of the usual level, the Brier score and that of the mean rate, and F1 of the flag."""
    rate = tested.select(F.avg("y")).scalar()
    y, z = F.col("y"), F.col("smoke_impact_pred")
    return tested.withColumn("_rate", rate).agg(
        F.count(F.lit(1)).alias("days"),
        F.avg(F.abs(F.col("pred_pm25") - F.col("pm25"))).alias("level_error"), F.avg(F.abs(F.col("usual_pm25") - F.col("pm25"))).alias("usual_error"),
        F.avg(F.pow(F.col("smoke_prob") - y, F.lit(2))).alias("brier"), F.avg(F.pow(F.col("_rate") - y, F.lit(2))).alias("rate_brier"),
        ratio(F.sum(y * z) * 2, F.sum(y) + F.sum(z)).alias("f1"),
    )


def event_predictions(model: EventModel, ready: DataFrame) -> DataFrame:
    """High-pollution days with the model's label and probability."""
    high = ready.filter(F.col("pm25") >= model.threshold)
    return (
        model.score(high)
        .withColumnsRenamed({"y_pred": "predicted_label", "prob": "prediction_probability"})
        .withColumn("is_high_pollution", F.lit(1))
    )
