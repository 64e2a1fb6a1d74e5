"""The registered queries against their SQL at the smallest scale (all of them: ``python check.py``)."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

FEW = ["fire_features", "pm25_daily", "weather_daily", "era5_daily", "explode_sensors", "event_windows", "roc_curve_table", "cv_summary"]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) > 100


@pytest.mark.parametrize("name", FEW)
def test_matches_sql(spark, sf, name):
    assert compare(spark, connect(sf), name, sf).startswith("ok")
