"""The key figures of a period as one ``item, value`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.levels import PM25_THRESHOLD
from ..operators import patterns as P
from ..session import materialise


def _as_rows(one_row: DataFrame, items: dict[str, Column]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(k).alias("item"), v.cast("string").alias("value")) for k, v in items.items()])
    return one_row.select(F.explode(pairs).alias("e")).select("e.*")


def pattern_report(days: DataFrame, threshold: float = PM25_THRESHOLD) -> DataFrame:
    """Figures of the text report for one site. ``days`` has date and pm25, optionally y and y_pred.

    The days (one row each) are written once, so whatever they come from is computed once; the
    parts are small aggregations over what was written.
    """
    days = materialise(days.select(*[c for c in ("date", "pm25", "y", "y_pred") if c in days.columns]), "report-days")
    summary = P.overall_summary(days, threshold)
    monthly = P.monthly_patterns(days, threshold)
    yearly = P.yearly_patterns(days, threshold)

    def two(c: str) -> Column:
        return F.format_string("%.2f", F.col(c))

    head = {
        "total_days": F.col("total_days"),
        "first_date": F.col("first_date"),
        "last_date": F.col("last_date"),
        "duration_days": F.col("duration_days"),
        "high_days": F.col("high_days"),
        "high_pct": two("high_pct"),
        "high_mean": two("high_mean"),
        "pm25_max": two("pm25_max"),
        "pm25_min": two("pm25_min"),
    }
    if "accuracy" in summary.columns:
        head["correct_days"] = F.col("correct_days")
        head["accuracy_pct"] = F.format_string("%.2f", F.col("accuracy") * 100.0)
    parts = [
        _as_rows(summary, head),
        _as_rows(
            P.peak_and_safest(monthly),
            {n: F.col(n) for n in ("peak_month_name", "peak_days", "safest_month_name", "safest_days")},
        ),
        _as_rows(P.peak_year(yearly), {n: F.col(n) for n in ("peak_year", "peak_year_days")}),
        _as_rows(P.trend_label(yearly), {n: F.col(n) for n in ("first_events", "last_events", "trend")}),
        P.seasonal_means(days).select(
            F.concat(F.lower("season"), F.lit("_avg")).alias("item"), F.format_string("%.2f", F.col("pm25_mean")).alias("value")
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
