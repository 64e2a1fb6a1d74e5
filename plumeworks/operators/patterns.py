"""Monthly, yearly and seasonal patterns of a daily table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.calendar import calendar_parts, month_name, season_of
from ..functions.levels import PM25_THRESHOLD, exceeds


def with_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(calendar_parts(F.col(date)))


def high_days(df: DataFrame, threshold: float = PM25_THRESHOLD) -> DataFrame:
    return df.filter(F.col("pm25") >= threshold)


def _measures(threshold: float) -> list[Column]:
    return [
        F.avg("pm25").alias("pm25_mean"),
        F.stddev_samp("pm25").alias("pm25_std"),
        F.max("pm25").alias("pm25_max"),
        F.sum(exceeds(F.col("pm25"), threshold)).cast("bigint").alias("high_pollution_days"),
        F.count(F.lit(1)).alias("total_days"),
    ]


def monthly_patterns(daily: DataFrame, threshold: float = PM25_THRESHOLD, keys: Sequence[str] = ()) -> DataFrame:
    """By month of the year, over all years."""
    grouped = daily.groupBy(*keys, F.month("date").alias("month")).agg(*_measures(threshold))
    return grouped.withColumn("month_name", month_name(F.make_date(F.lit(2000), F.col("month"), F.lit(1))))


def yearly_patterns(daily: DataFrame, threshold: float = PM25_THRESHOLD, keys: Sequence[str] = ()) -> DataFrame:
    grouped = daily.groupBy(*keys, F.year("date").alias("year")).agg(*_measures(threshold), F.min("pm25").alias("pm25_min"))
    share = F.col("high_pollution_days") / F.col("total_days")
    return grouped.withColumn("high_pollution_ratio", share)


def seasonal_means(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean over the days of a season (not over its month means)."""
    return daily.groupBy(*keys, season_of(F.month("date")).alias("season")).agg(F.avg("pm25").alias("pm25_mean"))


def accuracy_by(predictions: DataFrame, part: str, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, actual and predicted events by ``month`` or ``year`` of a table with ``y`` and ``y_pred``."""
    when = {"month": F.month, "year": F.year}[part](F.col("date")).alias(part)
    y, z = F.col("y"), F.col("y_pred")
    return predictions.groupBy(*keys, when).agg(
        F.avg((y == z).cast("double")).alias("accuracy"),
        F.sum(y).cast("bigint").alias("actual_events"),
        F.sum(z).cast("bigint").alias("predicted_events"),
    )


def overall_summary(daily: DataFrame, threshold: float = PM25_THRESHOLD, keys: Sequence[str] = ()) -> DataFrame:
    """Days, span, share and level of high days; with ``y`` and ``y_pred`` also the correct predictions."""
    high = F.col("pm25") >= threshold
    measures = [
        F.count(F.lit(1)).alias("total_days"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.datediff(F.max("date"), F.min("date")).alias("duration_days"),
        F.count_if(high).alias("high_days"),
        (F.avg(F.coalesce(high.cast("double"), F.lit(0.0))) * 100.0).alias("high_pct"),
        F.avg(F.when(high, F.col("pm25"))).alias("high_mean"),
        F.max("pm25").alias("pm25_max"),
        F.min("pm25").alias("pm25_min"),
    ]
    if {"y", "y_pred"} <= set(daily.columns):
        correct = F.col("y") == F.col("y_pred")
        measures += [F.count_if(correct).alias("correct_days"), F.avg(correct.cast("double")).alias("accuracy")]
    return daily.groupBy(*keys).agg(*measures)


def trend_label(yearly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Events of the first year against the last (one row per year, so there are no ties)."""
    events = F.col("high_pollution_days")
    ends = yearly.groupBy(*keys).agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.min_by(events, "year").alias("first_events"), F.max_by(events, "year").alias("last_events"),
    )
    label = (
        F.when(F.col("last_events") < F.col("first_events"), "DECREASING")
        .when(F.col("last_events") > F.col("first_events"), "INCREASING")
        .otherwise("STABLE")
    )
    return ends.withColumn("trend", label)


def peak_and_safest(monthly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Month with most and with fewest high days; the earlier month wins ties. At most 12 rows per key."""
    days, month = F.col("high_pollution_days"), F.col("month")
    peak = F.max(F.struct(days.alias("d"), (-month).alias("m"), F.col("month_name").alias("name")))
    safe = F.min(F.struct(days.alias("d"), month.alias("m"), F.col("month_name").alias("name")))
    both = monthly.groupBy(*keys).agg(peak.alias("p"), safe.alias("s"))
    return both.select(
        *keys,
        (-F.col("p.m")).alias("peak_month"), F.col("p.name").alias("peak_month_name"), F.col("p.d").alias("peak_days"),
        F.col("s.m").alias("safest_month"), F.col("s.name").alias("safest_month_name"), F.col("s.d").alias("safest_days"),
    )


def peak_year(yearly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    best = F.max(F.struct(F.col("high_pollution_days").alias("d"), (-F.col("year")).alias("y")))
    return yearly.groupBy(*keys).agg(best.alias("b")).select(
        *keys, (-F.col("b.y")).alias("peak_year"), F.col("b.d").alias("peak_year_days")
    )


def rolling_mean(daily: DataFrame, days: int = 30, keys: Sequence[str] = ()) -> DataFrame:
    """Trailing mean over the last ``days`` rows of each key (short windows at the start).

    One row per key and day, so a key's window is bounded by the calendar.
    """
    w = W.partitionBy(*keys).orderBy("date").rowsBetween(-(days - 1), 0)
    return daily.withColumn(f"pm25_mean_{days}d", F.avg("pm25").over(w))


def rolling_mean_by_time(
    series: DataFrame, value: str, at: str, span_seconds: int, keys: Sequence[str] = (), out: str | None = None, block_spans: int = 4
) -> DataFrame:
    """Mean over the ``span_seconds`` up to each row's own moment, for hourly or finer series.

    A key's rows are cut into blocks of ``block_spans`` spans; each block also gets a halo, the rows of the last span
    before it, so the window of a long series runs in many tasks. A row is sent at most twice.
    """
    keys, size = list(keys), span_seconds * block_spans
    seconds = F.unix_timestamp(at) if dict(series.dtypes)[at] != "bigint" else F.col(at)
    timed = series.withColumn("_at", seconds).withColumn("_block", F.floor(F.col("_at") / size))
    reaches = F.col("_at") >= (F.col("_block") + 1) * size - span_seconds
    sent = timed.withColumn("_to", F.explode(F.when(reaches, F.array("_block", F.col("_block") + 1)).otherwise(F.array("_block"))))
    window = W.partitionBy(*keys, "_to").orderBy("_at").rangeBetween(-span_seconds, 0)
    averaged = sent.withColumn(out or f"{value}_mean", F.avg(value).over(window))
    return averaged.where(F.col("_to") == F.col("_block")).drop("_at", "_block", "_to")


def month_year_grid(daily: DataFrame, years: Sequence[int] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Mean by month (rows) and year (columns). One small job finds the years; ``years`` picks some of them."""
    parts = daily.select(*keys, "pm25", F.month("date").alias("month"), F.year("date").alias("_year"))
    if years is None:
        years = [r[0] for r in parts.select("_year").where(F.col("_year").isNotNull()).distinct().orderBy("_year").collect()]
    return parts.groupBy(*keys, "month").pivot("_year", [int(y) for y in years]).agg(F.avg("pm25"))


def forecast_monthly(forecast: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Monthly means of the forecast and the number of smoke days."""
    return forecast.groupBy(*keys, F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.avg("pred_pm25").alias("mean_pred_pm25"),
        F.avg("smoke_prob").alias("mean_smoke_prob"),
        F.sum("smoke_impact_pred").cast("bigint").alias("smoke_days"),
    )
