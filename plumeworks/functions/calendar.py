"""Calendar parts of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Meteorological seasons by month.
SEASONS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8], "Fall": [9, 10, 11]}


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMM")


def season_of(month: Column) -> Column:
    expr = F
    for name, months in SEASONS.items():
        expr = expr.when(month.isin(months), F.lit(name))
    return expr


def calendar_parts(date: Column) -> dict[str, Column]:
    """year, month, month_name, ISO week, day_of_year, quarter."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "month_name": month_name(date),
        "week": F.weekofyear(date),
        "day_of_year": F.dayofyear(date),
        "quarter": F.quarter(date),
    }
