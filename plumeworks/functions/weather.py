"""Wind vectors and unit changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import wrap_degrees


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_from_deg(u: Column, v: Column) -> Column:
    """Direction the wind comes from. Give it mean vectors: angles themselves do not average."""
    return wrap_degrees(F.lit(270.0) - F.degrees(F.atan2(v, u)))


def kelvin_to_celsius(c: Column) -> Column:
    return c - 273.15


def pascal_to_hectopascal(c: Column) -> Column:
    return c / 100.0
