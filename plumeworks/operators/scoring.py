"""Exact binary-classification metrics, curves and summaries.

Input rows carry a 0/1 label, a probability and optional group columns (model,
fold, ...). Rows are first combined per distinct score; curves are then built
with blocked running totals, so a single model's curve uses all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .ordering import quantile_blocks, running_totals, shuffled_position

METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is 0 when undefined (also a double ``/ 0`` raises under ANSI)."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def score_groups(df: DataFrame, by: Sequence[str] = (), label: str = "y", prob: str = "prob") -> DataFrame:
    """Positives and negatives per group and distinct score."""
    return (
        df.select(*by, F.col(prob).cast("double").alias("threshold"), F.col(label).cast("int").alias("_y"))
        .groupBy(*by, "threshold")
        .agg(F.sum("_y").cast("bigint").alias("pos"), F.sum(1 - F.col("_y")).cast("bigint").alias("neg"))
    )


def ranked_scores(
    df: DataFrame, by: Sequence[str] = (), label: str = "y", prob: str = "prob", blocks: int | None = None
) -> DataFrame:
    """``score_groups`` plus cumulative ``tp`` / ``fp`` from the highest score down, and totals ``p`` / ``n``.

    The groups are written once, so the facts are read once: the cut points, the totals and the
    rows all come from them. Unless given, the number of blocks follows their number.
    """
    kept = materialise(score_groups(df, by, label, prob), "score-groups")
    groups = quantile_blocks(kept, "threshold", blocks=blocks)
    ranked = running_totals(
        groups, {"pos": F.col("pos"), "neg": F.col("neg")}, [F.col("threshold").desc()], keys=by, block_descending=True
    )
    return ranked.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp", "all_pos": "p", "all_neg": "n"})


def _auc_measures() -> tuple[Column, Column]:
    # pairs won plus half the ties, over all positive-negative pairs
    won = F.sum(F.col("neg").cast("double") * ((F.col("tp") - F.col("pos")) + F.col("pos") / 2.0))
    pairs = F.max("p").cast("double") * F.max("n").cast("double")
    roc = F.try_divide(won, pairs)
    # recall step times the precision reached at that step
    steps = F.sum(F.col("pos") * ratio(F.col("tp"), F.col("tp") + F.col("fp")))
    return roc, ratio(steps, F.max("p"))


def classification_metrics(
    df: DataFrame, by: Sequence[str] = (), label: str = "y", prob: str = "prob", cut: float = 0.5, blocks: int | None = None
) -> DataFrame:
    """accuracy, precision, recall, f1, roc_auc, pr_auc per group.

    ``roc_auc`` is NULL where a group has only one class.
    """
    ranked = ranked_scores(df, by, label, prob, blocks)
    chosen = F.col("threshold") >= cut
    roc, ap = _auc_measures()
    counted = ranked.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(chosen, F.col("pos"))), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum(F.when(chosen, F.col("neg"))), F.lit(0)).alias("_fp"),
        F.max("p").alias("_p"),
        F.max("n").alias("_n"),
        roc.alias("roc_auc"),
        ap.alias("pr_auc"),
    )
    tp, fp, p, n = (F.col(c) for c in ("_tp", "_fp", "_p", "_n"))
    return counted.select(
        *by,
        ratio(tp + n - fp, p + n).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, p).alias("recall"),
        ratio(tp * 2, p + tp + fp).alias("f1"),
        "roc_auc",
        "pr_auc",
    )


def label_metrics(df: DataFrame, by: Sequence[str] = (), label: str = "y", predicted: str = "y_pred") -> DataFrame:
    """accuracy, precision, recall, f1 from given 0/1 predictions: one aggregation, no ordering."""
    y, z = F.col(label), F.col(predicted)
    counted = df.groupBy(*by).agg(
        F.sum(y * z).alias("_tp"), F.sum(z).alias("_z"), F.sum(y).alias("_p"),
        F.avg((y == z).cast("double")).alias("accuracy"),
    )
    return counted.select(
        *by, "accuracy",
        ratio(F.col("_tp"), F.col("_z")).alias("precision"),
        ratio(F.col("_tp"), F.col("_p")).alias("recall"),
        ratio(F.col("_tp") * 2, F.col("_p") + F.col("_z")).alias("f1"),
    )


def roc_auc(df: DataFrame, by: Sequence[str] = (), label: str = "y", prob: str = "prob", blocks: int | None = None) -> DataFrame:
    return ranked_scores(df, by, label, prob, blocks).groupBy(*by).agg(_auc_measures()[0].alias("roc_auc"))


def average_precision(
    df: DataFrame, by: Sequence[str] = (), label: str = "y", prob: str = "prob", blocks: int | None = None
) -> DataFrame:
    return ranked_scores(df, by, label, prob, blocks).groupBy(*by).agg(_auc_measures()[1].alias("pr_auc"))


def _mark_corners(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    """``_corner``: the curve bends at this point, or it is an end.

    A point lies on a straight piece when the next score adds the same counts. The
    next score of a block's last row is the first of the following block, taken
    from per-block heads.
    """
    by = list(by)
    step = F.struct(F.col("pos"), F.col("neg"))
    heads = ranked.groupBy(*by, "_block").agg(F.max_by(step, "threshold").alias("_head"))
    down = W.partitionBy(*by).orderBy(F.col("_block").desc())
    heads = heads.select(
        *by, "_block",
        F.lead("_head").over(down).alias("_next_head"),
        F.lag(F.lit(1)).over(down).isNull().alias("_first_block"),
    )
    inside = W.partitionBy(*by, "_block").orderBy(F.col("threshold").desc())
    after = F.coalesce(F.lead(step).over(inside), F.col("_next_head"))
    first = F.col("_first_block") & F.lag(F.lit(1)).over(inside).isNull()
    corner = first | after.isNull() | (after["pos"] != F.col("pos")) | (after["neg"] != F.col("neg"))
    return ranked.join(heads, [*by, "_block"]).withColumn("_corner", corner)


def roc_curve(
    df: DataFrame, by: Sequence[str] = (), label: str = "y", prob: str = "prob", thin: bool = True, blocks: int | None = None
) -> DataFrame:
    """``threshold, fpr, tpr`` from (0, 0) up. ``thin`` leaves out points on straight pieces."""
    ranked = ranked_scores(df, by, label, prob, blocks)
    if thin:
        ranked = _mark_corners(ranked, by).filter("_corner")
    points = ranked.select(
        *by, "threshold", F.try_divide(F.col("fp").cast("double"), F.col("n").cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("p").cast("double")).alias("tpr"),
    )
    origin = ranked.select(*by, F.lit(1).alias("_x")).groupBy(*by).agg(F.count("_x").alias("_x")).filter("_x > 0")
    start = origin.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def pr_curve(
    df: DataFrame, by: Sequence[str] = (), label: str = "y", prob: str = "prob", blocks: int | None = None
) -> DataFrame:
    """``threshold, precision, recall`` per distinct score plus the closing point (1, 0) without threshold."""
    ranked = ranked_scores(df, by, label, prob, blocks)
    points = ranked.select(
        *by, "threshold",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        # without any positive the recall counts as 1 everywhere
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("p").cast("double")), F.lit(1.0)).alias("recall"),
    )
    closing = ranked.select(*by, F.lit(1).alias("_x")).groupBy(*by).agg(F.count("_x").alias("_x")).filter("_x > 0")
    end = closing.select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def stratified_folds(
    df: DataFrame, identity: Sequence[str], label: str = "y", folds: int = 5, seed: int = 42, keys: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Add ``fold`` in 0..folds-1; within each label fold sizes differ by at most one.

    Rows are placed in a seeded hash order per label. Membership is repeatable but
    not that of any other random generator.
    """
    placed = shuffled_position(df, identity, seed, keys=[*keys, label], blocks=blocks)
    return placed.withColumn("fold", F.pmod(F.col("position") - 1, F.lit(folds)).cast("int")).select(*df.columns, "fold")


def cv_summary(fold_metrics: DataFrame, by: Sequence[str] = ("model",), metrics: Sequence[str] = tuple(METRICS)) -> DataFrame:
    """Mean and population std of each metric over the folds."""
    return fold_metrics.groupBy(*by).agg(
        *[f(m).alias(f"{m}_{name}") for m in metrics for name, f in (("mean", F.avg), ("std", F.stddev_pop))]
    )


def generalisation_gap(cv: DataFrame, test: DataFrame, on: str = "model") -> DataFrame:
    """Cross-validation F1 against test F1, and the mean gap over all metrics but accuracy."""
    compared = [m for m in METRICS if m != "accuracy"]
    both = cv.join(test, on)
    gaps = sum((F.col(f"{m}_mean") - F.col(m) for m in compared), F.lit(0.0)) / len(compared)
    f1_gap = F.col("f1_mean") - F.col("f1")
    return both.select(
        F.col(on),
        F.col("f1_mean").alias("cv_f1_mean"),
        F.col("f1_std").alias("cv_f1_std"),
        F.col("f1").alias("test_f1"),
        f1_gap.alias("f1_gap"),
        F.try_divide(f1_gap, F.col("f1_mean")).alias("f1_gap_share"),
        gaps.alias("avg_gap"),
    )


def positive_rate(df: DataFrame, label: str = "y", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("samples"), (F.avg(F.col(label).cast("double")) * 100.0).alias("positive_pct")
    )


def class_weights(df: DataFrame, label: str = "y") -> DataFrame:
    """Balanced weights ``n / (classes * n_class)`` for the two classes."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    # at most one row per class
    n = F.sum("rows").over(W.partitionBy())
    classes = F.count(F.lit(1)).over(W.partitionBy())
    return counts.select(label, "rows", (n / (classes * F.col("rows"))).cast("double").alias("weight"))


def leaderboard_upsert(board: DataFrame, row: DataFrame, on: str = "model") -> DataFrame:
    """Replace the row of the same model, best F1 first. Columns missing on either side become NULL."""
    others = board.join(row.select(on), on, "left_anti")
    return others.unionByName(row, allowMissingColumns=True).orderBy(F.desc_nulls_last("f1"))


def top_row(results: DataFrame, score: str = "val_f1", tie: str = "config") -> DataFrame:
    """The best grid row; the first configuration wins ties."""
    return results.orderBy(F.desc_nulls_last(score), F.asc(tie)).limit(1)


def feature_ranking(importance: DataFrame, top: int | None = None) -> DataFrame:
    ranked = importance.orderBy(F.desc_nulls_last("importance_mean"), F.asc("feature"))
    return ranked.limit(top) if top is not None else ranked


def importance_summary(repeats: DataFrame) -> DataFrame:
    """Mean and population std of the score drop over the repeats of each feature."""
    return repeats.groupBy("feature").agg(
        F.avg("importance").alias("importance_mean"), F.stddev_pop("importance").alias("importance_std")
    )
