"""Column statistics used for filling and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .joins import BROADCAST_ROWS, counted_within, lookup_join, with_scalars

_ACCURACY = 10_000
#: Bins of a round of median refinement, and the rows from which a bracket is refined no more.
BINS, SETTLED = 64, 1000
#: Rows of a group whose distinct values one task may hold.
PLAIN_ROWS = 250_000


def exact_medians(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), max_group_rows: int | None = None
) -> DataFrame:
    """Exact interpolated median of each column, per key (one row without keys).

    An exact median keeps every distinct value of a group. Where the group size is
    bounded that is fine; otherwise values are first clamped to a narrow bracket
    around the middle. Clamping does not move the median, and only the few values inside the
    bracket stay distinct. Without keys the bracket comes from one approximate quantile per column,
    with keys from :func:`median_brackets`.
    """
    keys = list(keys)
    if max_group_rows is not None and max_group_rows <= PLAIN_ROWS:
        return df.groupBy(*keys).agg(*[F.median(c).alias(c) for c in columns])
    if keys:
        brackets = median_brackets(df, columns, keys)
        named = F.map_from_entries(F.collect_list(F.struct("_c", F.struct("_low", "_high"))))
        wide = lookup_join(df.select(*keys, *columns), brackets.groupBy(*keys).agg(named.alias("_q")), keys, salt_on=list(columns))
        q = {c: (F.col("_q")[c]["_low"], F.col("_q")[c]["_high"]) for c in columns}
    else:
        slack = 3.0 / _ACCURACY
        found = df.agg(*[F.percentile_approx(c, [0.5 - slack, 0.5 + slack], _ACCURACY).alias(f"_q_{c}") for c in columns])
        wide = with_scalars(df.select(*columns), found, "_q")
        q = {c: (F.col(f"_q._q_{c}")[0].cast("double"), F.col(f"_q._q_{c}")[1].cast("double")) for c in columns}

    def clamped(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.when(value.isNotNull(), F.greatest(F.least(value, q[c][1]), q[c][0]))

    return wide.groupBy(*keys).agg(*[F.median(clamped(c)).alias(c) for c in columns])


def _stretched(x: Column) -> Column:
    """Grows with x and spreads magnitudes, so that a few rounds reach any value."""
    return F.signum(x) * F.log1p(F.abs(x))


def median_brackets(df: DataFrame, columns: Sequence[str], keys: Sequence[str], bins: int = BINS, settled: int = SETTLED) -> DataFrame:
    """``keys, _c, _low, _high``: for each key and column two values between which its median lies.

    All keys and columns are refined together, one pass over the rows a round: values inside a bracket are counted in
    ``bins`` bins, and the bins that hold the middle ranks, cut to their least and greatest value, are the next bracket. It ends when
    no bracket holds more than ``settled`` rows or all of them hold one value. A task keeps ``bins`` counters for each key
    and column that it sees, and in the end ``settled`` values; every round narrows a bracket to a fraction of its width.
    """
    keys = list(keys)
    group = [*keys, "_c"]
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in columns]))
    values = df.select(*keys, cells.alias("_s")).select(*keys, "_s._c", "_s._v").where(F.col("_v").isNotNull())
    state = values.groupBy(*group).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_n"))
    state = materialise(state.withColumns({"_below": F.lit(0).cast("long"), "_inside": F.col("_n")}), "medians")
    ordered = W.partitionBy(*group).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    first, last = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    while True:
        open_ = state.where((F.col("_inside") > settled) & (F.col("_low") < F.col("_high")))
        if open_.isEmpty():
            return state.select(*group, "_low", "_high")
        share = F.try_divide(_stretched(F.col("_v")) - _stretched(F.col("_low")), _stretched(F.col("_high")) - _stretched(F.col("_low")))
        bin_ = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1))
        met = lookup_join(values, open_, group, "inner", max_lookup_rows=BROADCAST_ROWS if counted_within(open_) else None, salt_on=["_v"])
        inside = met.where(F.col("_v").between(F.col("_low"), F.col("_high"))).withColumn("_bin", bin_)
        counted = inside.groupBy(*group, "_n", "_below", "_bin").agg(F.count("*").alias("_m"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        placed = counted.withColumn("_before", F.col("_below") + F.coalesce(F.sum("_m").over(ordered), F.lit(0)))
        middle = placed.where((F.col("_before") <= last) & (F.col("_before") + F.col("_m") > first))
        narrowed = middle.groupBy(*group, "_n").agg(F.min("_a").alias("_low"), F.max("_b").alias("_high"), F.min("_before").alias("_below"), F.sum("_m").alias("_inside"))
        done = state.join(open_.select(*group), group, "left_anti")
        before = open_.agg(F.sum("_inside")).first()[0]
        state = materialise(done.unionByName(narrowed.select(*state.columns)), "medians")
        now = state.where((F.col("_inside") > settled) & (F.col("_low") < F.col("_high"))).agg(F.sum("_inside")).first()[0]
        if now == before:  # what is left are a few neighbouring values, each many times
            return state.select(*group, "_low", "_high")


def moments(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation as ``mean_<c>``, ``std_<c>``."""
    parts = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return df.groupBy(*keys).agg(*parts)


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str] = (), salt_on: Sequence[str] = ()):
    """``df`` plus a function that gives the column of a statistic for a row."""
    if keys:
        renamed = stats.select(*keys, F.struct(*[c for c in stats.columns if c not in keys]).alias("_s"))
        wide = lookup_join(df, renamed, list(keys), salt_on=list(salt_on))
    else:
        wide = with_scalars(df, stats)
    return wide, lambda name: F.col("_s")[name]


def zscore(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), fit_on: DataFrame | None = None) -> DataFrame:
    """Append ``z_<c> = (c - mean) / std`` (population std; a constant column gives 0).

    ``fit_on`` takes the statistics from another table, e.g. only the train rows.
    """
    stats = moments(fit_on if fit_on is not None else df, columns, keys)
    wide, stat = attach(df, stats, keys, salt_on=["date"] if "date" in df.columns else list(columns))

    def scaled(c: str) -> Column:
        spread = stat(f"std_{c}")
        return (F.col(c) - stat(f"mean_{c}")) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)

    return wide.select(*df.columns, *[scaled(c).alias(f"z_{c}") for c in columns])


def drop_all_null(train: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that have at least one value in ``train`` (one counting job)."""
    counts = train.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] > 0]
