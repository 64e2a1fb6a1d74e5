import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumeworks.functions import coerce, geo, levels, names, weather
from plumeworks.functions.calendar import calendar_parts, season_of


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_clean_names(spark):
    assert [names.clean_name(n) for n in ("Wind Spd (km/h)", " Temp (°C) ", '"Date/Time (LST)"')] == [
        "wind_spd_km_h", "temp_c", "date_time_lst"]
    assert names.clean_names(["a b", "A-B", "c"]) == ["a_b", "a_b_2", "c"]
    df = spark.createDataFrame([(1, 2)], ["date_local_from", "date"])
    assert names.first_existing(df, ["date", "date_local_from"]) == "date"
    with pytest.raises(KeyError):
        names.first_existing(df, ["x"])
    assert values(df, names.column_or(df, "fire_count", 0).alias("x")) == [(0,)]


def test_numbers(spark):
    texts = ["1", " 2.5 ", "1e3", "-.5", "1d", "0x1p3", "n/a", "", None, "nan", "inf", "1_0", "3."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in values(df, coerce.to_number("t"))]
    assert got == [1.0, 2.5, 1000.0, -0.5, None, None, None, None, None, None, math.inf, None, 3.0]
    typed = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert [r[0] for r in values(typed, coerce.number_in(typed, "x"))] == [None, 1.0, None]


def test_dashed_days_need_no_pattern(spark):
    texts = ["2024-05-01", "2024-5-1 3:04", "2024-05-01 99:00", "2024-05-01\n", "2024-05-01\n\n", "2024-05-01 \r", "12024-05-01", "+2024-05-01", "2024-05", "2024",
             " 2024-05-01", "2024-05-01 05:30Z", "2024-05-01T05:30:00.5-06:00", "2024-05-01T", "202-5-01", "-2024-05-01", "2024-05-01x", "20240501", "01 May 2024"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.to_date(coerce._readable(F.col("t")).try_cast("timestamp_ntz"))
    got = values(df, coerce.to_day("t"), plain)
    assert [a for a, _ in got] == [b for _, b in got] and sum(a is None for a, _ in got) >= 6
    # the fast way alone reads the usual forms
    fast = values(df, F.when(coerce._dashed(F.col("t")), F.to_date(F.col("t").try_cast("timestamp_ntz"))))
    assert [r[0] for r in fast[:2]] == [dt.date(2024, 5, 1)] * 2


def test_days(spark):
    texts = ["2024-05-01", "2024-05-01 23:59", "2024-13-01", "bad", None, "1500-01-01", "2300-01-01", "20240-01-01",
             "2024-05-01T23:30:00-06:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    may = dt.date(2024, 5, 1)
    assert [r[0] for r in values(df, coerce.to_day("t"))] == [may, may, None, None, None, dt.date(1500, 1, 1), dt.date(2300, 1, 1), None, may]
    utc = [r[0] for r in values(df, coerce.utc_day("t"))]
    assert utc[-1] == dt.date(2024, 5, 2) and utc[0] == may and utc[3] is None
    # the other common forms; a month beyond twelve or an unknown name stays unreadable
    texts = ["2024/05/01", "05/01/2024 23:59", "20240501", "May 1, 2024", "1 May 2024", "May 1, 2024 23:59", "2024-05-01T03:05-06:00", "13/01/2024", "Foo 1, 2024", "2024-05-01T03:05Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in values(df, coerce.to_day("t"))] == [may] * 7 + [None, None, may]


def test_fire_clock(spark):
    clocks = ["5", "930", "2359", "2410", "0075", None, "12345", " 45 "]
    df = spark.createDataFrame([(c,) for c in clocks], "c string")
    got = [r[0] for r in values(df, coerce.fire_timestamp(F.lit("2024-08-01"), "c"))]
    day = dt.datetime(2024, 8, 1)
    assert got == [day.replace(minute=5), day.replace(hour=9, minute=30), day.replace(hour=23, minute=59), None, None, None,
                   None, day.replace(minute=45)]


def test_distance_and_bearing_against_numpy(spark):
    rng = np.random.default_rng(7)
    pts = [(float(a), float(b)) for a, b in zip(rng.uniform(-80, 80, 50), rng.uniform(-180, 180, 50))]
    df = spark.createDataFrame(pts, "lat double, lon double")
    got = values(df, geo.haversine_km(51.0, -114.0, F.col("lat"), F.col("lon")), geo.haversine_km(F.col("lat"), F.col("lon"), 51.0, -114.0),
                 geo.bearing_deg(51.0, -114.0, F.col("lat"), F.col("lon")))
    for (lat, lon), (km, back, bearing) in zip(pts, got):
        a, b = map(np.array, ((math.radians(51), math.radians(-114)), (math.radians(lat), math.radians(lon))))
        u = np.array([math.cos(a[0]) * math.cos(a[1]), math.cos(a[0]) * math.sin(a[1]), math.sin(a[0])])
        v = np.array([math.cos(b[0]) * math.cos(b[1]), math.cos(b[0]) * math.sin(b[1]), math.sin(b[0])])
        assert km == pytest.approx(6371.0088 * math.acos(np.clip(u @ v, -1, 1)), rel=1e-6)
        assert km == pytest.approx(back) and 0 <= bearing < 360


def test_angles(spark):
    df = spark.createDataFrame([(10.0, 350.0, 20.0), (350.0, 10.0, 20.0), (0.0, 180.0, 180.0), (-190.0, 0.0, 170.0)], "a double, b double, d double")
    for got, want in values(df, geo.angular_diff_deg(F.col("a"), F.col("b")), "d"):
        assert got == pytest.approx(want)


@pytest.mark.parametrize("lat,lon,radius", [(51.0447, -114.0719, 400.0), (89.0, 10.0, 400.0), (0.0, 179.5, 300.0), (-60.0, -179.0, 900.0)])
def test_bounding_box_holds_the_circle(spark, lat, lon, radius):
    rng = np.random.default_rng(3)
    pts = [(float(a), float(b)) for a, b in zip(np.clip(rng.normal(lat, 6, 4000), -90, 90), (rng.normal(lon, 30, 4000) + 180) % 360 - 180)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    km = geo.haversine_km(lat, lon, F.col("lat"), F.col("lon"))
    box = geo.bounding_box(lat, lon, radius).contains(F.col("lat"), F.col("lon"))
    assert df.filter((km <= radius) & ~box).count() == 0
    assert df.filter(km <= radius).count() > 0


def test_shapes(spark):
    df = spark.createDataFrame([(60.0, 30.0, 0.0, 180.0, 10.0)], "major double, minor double, dir double, wfrom double, ws double")
    ring = values(df, geo.ellipse_polygon(0.0, 0.0, F.col("major"), F.col("minor"), F.col("dir")))[0][0]["coordinates"][0]
    assert len(ring) == 65 and ring[0] == ring[64]
    assert ring[0][0] == pytest.approx(60 / 111.0) and max(p[1] for p in ring) == pytest.approx(30 / 111.0, rel=1e-2)
    capped, free = values(df, geo.wind_arrow(0.0, 0.0, F.col("wfrom"), F.col("ws")), geo.wind_arrow(0.0, 0.0, F.col("wfrom"), F.col("ws"), cap=None))[0]
    assert capped["coordinates"][1][1] == pytest.approx(0.3) and free["coordinates"][1][1] == pytest.approx(0.45)


def test_levels(spark):
    df = spark.createDataFrame([(10.0, 1.0), (25.0, 2.0), (35.0, 3.5), (50.0, 4.0), (134.0, 9.0), (None, None)], "p double, w double")
    got = values(df, levels.risk_colour(F.col("p")), levels.risk_name(F.col("p")), levels.wind_colour(F.col("w")), levels.wind_weight(F.col("w")), levels.exceeds(F.col("p")))
    assert [g[0] for g in got] == ["#90EE90", "#FF8C00", "#FF4500", "#DC143C", "#8B0000", "#90EE90"]
    assert [g[1] for g in got] == ["low", "moderate", "high", "severe", "severe", "low"]
    assert [g[2] for g in got] == ["blue", "green", "orange", "red", "red", "red"]
    assert [g[3] for g in got] == [2, 2, 3, 4, 4, 4]
    assert [g[4] for g in got] == [0, 1, 1, 1, 1, 0]


# published rows: date, u, v, wind direction, pm25, week, day of year, quarter
GOLDEN = [
    ("2024-05-11", 2.025908794583333, -0.7229245487916667, 289.6384143895902, 19, 132, 2),
    ("2024-07-24", -0.41977755, -0.4102274619583333, 45.65921962622178, 30, 206, 3),
    ("2024-12-16", -0.8449796057916666, 0.33392461375, 111.56326752126654, 51, 351, 4),
]


def test_published_wind_and_calendar(spark):
    df = spark.createDataFrame(GOLDEN, "d string, u double, v double, deg double, week int, doy int, q int").withColumn("date", F.to_date("d"))
    parts = calendar_parts(F.col("date"))
    for row in df.withColumns({f"c_{k}": v for k, v in parts.items()}).withColumn("from", weather.wind_from_deg(F.col("u"), F.col("v"))).collect():
        assert row["from"] == pytest.approx(row["deg"], abs=1e-9)
        assert (row["c_week"], row["c_day_of_year"], row["c_quarter"]) == (row["week"], row["doy"], row["q"])
    assert [r[0] for r in values(df.orderBy("date"), season_of(F.month("date")))] == ["Spring", "Summer", "Winter"]
