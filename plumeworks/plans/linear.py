"""Logistic regression with an L2 penalty, by Newton's method on sums that Spark adds up.

Every pass over the rows sums, for all penalties of a grid at once, the loss, its slope and its curvature at the current
coefficients: a few thousand numbers, whatever the number of rows. The penalised loss is convex, so a step that does not lower it is
halved, and a few passes reach the optimum. The intercept is free.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Passes at most, and the slope (for each unit of weight) that counts as flat.
PASSES, FLAT = 100, 1e-11


@dataclass
class LinearModel:
    coefficients: DenseVector
    intercept: float

    def probability(self, features: Sequence[Column]) -> Column:
        score = F.lit(float(self.intercept))
        for w, x in zip(self.coefficients.toArray(), features):
            score = score + F.lit(float(w)) * x
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def _sums(rows: DataFrame, places: np.ndarray, one_task: bool) -> np.ndarray:
    """For each row of coefficients (the intercept last): loss, slope and curvature, in one line of numbers."""
    count, width = places.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, 1 + width + width * width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.c_[batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width - 1), np.ones(batch.num_rows)]
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for k in range(count):
                z = x @ places[k]
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
                total[k, 0] += (w * (np.logaddexp(0.0, z) - y * z)).sum()
                total[k, 1 : 1 + width] += x.T @ (w * (p - y))
                total[k, 1 + width :] += ((x * (w * p * (1 - p))[:, None]).T @ x).ravel()
        size = total.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(count), size), pa.int32()), pa.array(np.tile(np.arange(size), count), pa.int32()), pa.array(total.ravel())], ["row", "place", "value"])

    out = np.zeros((count, 1 + width + width * width))
    parts = rows.mapInArrow(run, "row int, place int, value double")
    if not one_task:
        parts = parts.groupBy("row", "place").agg(F.sum("value").alias("value"))
    found = parts.toArrow()  # numbers for each penalty, not for each row of the table
    np.add.at(out, (found["row"].to_numpy(), found["place"].to_numpy()), found["value"].to_numpy())
    return out


def fit_logistic(rows: DataFrame, features: int, penalties: Sequence[float], one_task: bool = False) -> list[LinearModel]:
    """One model for each penalty p: the least of the weighted log loss plus p / 2 times the squared coefficients.

    ``rows``: features (an array of double), label (0 or 1), weight. ``one_task``: they are one partition, whose sums need no shuffle.
    """
    data = rows.select(F.col("features"), F.col("label").cast("double"), F.col("weight").cast("double")).persist()
    width = features + 1
    ridge = np.array([[p] * features + [0.0] for p in penalties], dtype=float)
    kept = np.zeros((len(penalties), width))
    best = np.full(len(penalties), np.inf)
    step = np.zeros_like(kept)
    scale = np.ones(len(penalties))
    open_ = list(range(len(penalties)))
    for _ in range(PASSES):
        tried = kept + scale[:, None] * step
        sums = _sums(data, tried[open_], one_task)
        after = []
        for k, line in zip(open_, sums):
            loss = line[0] + 0.5 * float(ridge[k] @ tried[k] ** 2)
            if loss > best[k] + 1e-9 * abs(best[k]):
                scale[k] /= 2
                if scale[k] > 1e-6:
                    after.append(k)
                continue
            kept[k], best[k], scale[k] = tried[k], min(best[k], loss), 1.0
            slope = line[1 : 1 + width] + ridge[k] * kept[k]
            curve = line[1 + width :].reshape(width, width) + np.diag(ridge[k])
            weight = max(line[0], 1.0)
            step[k] = -np.linalg.lstsq(curve, slope, rcond=None)[0]
            if np.abs(slope).max() > FLAT * weight and np.abs(step[k]).max() > 1e-12 * (1 + np.abs(kept[k]).max()):
                after.append(k)
        open_ = after
        if not open_:
            break
    data.unpersist()
    return [LinearModel(DenseVector(k[:-1]), float(k[-1])) for k in kept]
