"""Classes and drawing parameters derived from a concentration or a wind speed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import wrap_degrees

PM25_THRESHOLD = 25.0

# Lower bound -> colour, and the documented four-step names.
COLOURS_5 = [(100.0, "#8B0000"), (50.0, "#DC143C"), (35.0, "#FF4500"), (25.0, "#FF8C00")]
COLOUR_BASE = "#90EE90"
NAMES_4 = [(50.0, "severe"), (35.0, "high"), (25.0, "moderate")]
NAME_BASE = "low"
# Upper bound of the wind speed in m/s -> arrow colour.
WIND_COLOURS = [(2.0, "blue"), (3.0, "green"), (4.0, "orange")]
WIND_TOP = "red"


def _at_least(value: Column, steps, base) -> Column:
    expr = F
    for bound, label in steps:
        expr = expr.when(value >= bound, F.lit(label))
    return expr.otherwise(F.lit(base))


def _below(value: Column, steps, top) -> Column:
    expr = F
    for bound, label in steps:
        expr = expr.when(value < bound, F.lit(label))
    return expr.otherwise(F.lit(top))


def exceeds(pm25: Column, threshold: float = PM25_THRESHOLD) -> Column:
    """1 when the concentration reaches the threshold, else 0 (also for NULL)."""
    return F.coalesce((pm25 >= threshold).cast("int"), F.lit(0))


def predicted_label(probability: Column, cut: float = 0.5) -> Column:
    return (probability >= cut).cast("int")


def risk_colour(pm25: Column) -> Column:
    return _at_least(pm25, COLOURS_5, COLOUR_BASE)


def risk_name(pm25: Column) -> Column:
    return _at_least(pm25, NAMES_4, NAME_BASE)


def wind_colour(speed: Column) -> Column:
    return _below(speed, WIND_COLOURS, WIND_TOP)


def wind_weight(speed: Column, base: int = 2) -> Column:
    """Line width in three steps: ``base``, one more from 3 m/s, two more from 4 m/s."""
    return _below(speed, [(3.0, base), (4.0, base + 1)], base + 2)


def dispersion(pm25: Column, speed: Column, wind_from: Column, threshold: float = PM25_THRESHOLD) -> dict[str, Column]:
    """Ellipse axes in km and the direction the plume is carried to."""
    # greatest / least skip NULL, so the guard keeps a missing input missing
    intensity = F.when(pm25.isNotNull(), F.greatest(F.lit(0.3), F.least(F.lit(2.0), pm25 / threshold)))
    stretch = F.when(speed.isNotNull(), F.least(speed / 5.0, F.lit(1.0)))
    radius = intensity * 50.0
    return {
        "influence_radius": radius,
        "major_axis": radius * (1.0 + stretch * 0.5),
        "minor_axis": radius * (1.0 - stretch * 0.3),
        "direction": wrap_degrees(wind_from + 180.0),
    }
