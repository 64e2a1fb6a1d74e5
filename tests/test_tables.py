import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from plumeworks.operators import daily, fire, spine
from plumeworks.operators.joins import lookup_join
from plumeworks.operators.ordering import forward_fill
from plumeworks.operators.stats import drop_all_null, exact_medians, zscore
from plumeworks.plans.pipeline import Feeds, Options, dataset_profile, master_features, model_ready, run_pipeline
from plumeworks.sources import air_api, documents, feeds, tables

D = dt.date


def days(spark, rows, schema):
    return spark.createDataFrame(rows, schema).withColumn("date", F.to_date("date"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- sources ----


def test_weather_headers_differ(spark, tmp_path):
    (tmp_path / "weather_1.csv").write_text('"a","Temp (°C)"\n1,2\n')
    (tmp_path / "weather_2.csv").write_text("Temp (°C),b\n3,NA\n")
    (tmp_path / "other.csv").write_text("zzz\n1\n")
    got = feeds.scan_weather_dir(spark, str(tmp_path))
    assert sorted(got.columns) == ["a", "b", "temp_c"]
    assert {(r["a"], r["temp_c"], r["b"]) for r in got.collect()} == {("1", "2", None), (None, "3", None)}
    with pytest.raises(FileNotFoundError):
        feeds.scan_weather_dir(spark, str(tmp_path), "none_*.csv")


def test_zip_under_csv_name(spark, tmp_path):
    for i in range(2):
        with zipfile.ZipFile(tmp_path / f"era{i}.csv", "w") as z:
            z.writestr("inner.csv", "Valid Time,u10\n" + "".join(f"2024-01-0{i + 1} 00:00,{k}\n" for k in range(3)))
    got = feeds.scan_zip_csv(spark, str(tmp_path))
    assert got.columns == ["u10", "valid_time"] and got.count() == 6
    assert documents.scan_any(spark, str(tmp_path / "era0.csv"), zipped=True).count() == 3


def test_fire_columns_required(spark, tmp_path):
    (tmp_path / "f.csv").write_text("latitude,longitude,acq_date,acq_time\n1,2,2024-01-01,5\n")
    with pytest.raises(KeyError, match="frp"):
        feeds.scan_fire_csv(spark, str(tmp_path))


def test_geojson_and_suffixes(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "x"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"type": "Feature", "properties": None, "geometry": None}]}
    (tmp_path / "a.geojson").write_text(json.dumps(doc, indent=1))
    (tmp_path / "b.json").write_text(json.dumps([{"k": 1}, {"k": 2}], indent=1))
    got = documents.scan_any(spark, str(tmp_path / "a.geojson"))
    assert {(r["name"], r["geometry_type"]) for r in got.collect()} == {("x", "Point"), (None, None)}
    assert documents.scan_any(spark, str(tmp_path / "b.json")).count() == 2
    with pytest.raises(ValueError):
        documents.scan_any(spark, str(tmp_path / "c.xlsx"))
    grouped = documents.scan_grouped(spark, [str(tmp_path / "missing.csv"), str(tmp_path / "b.json")])
    assert grouped.columns == ["k"]
    assert documents.scan_grouped(spark, [str(tmp_path / "missing.csv")]) is None


def test_landing(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("Longitude,x\n1,2\n")
    (tmp_path / "bad.csv").write_text("<html></html>\n")
    good, bad = documents.validate_landing(spark, str(tmp_path), "*.csv")
    assert [r.path.rsplit("/")[-1] for r in good.collect()] == ["ok.csv"]
    assert sorted(r.path.rsplit("/")[-1] for r in bad.collect()) == ["bad.csv"]


def test_sensors(spark):
    rows = [(1, "a", 10, None, "2024-01-01T00:00:00Z"), (1, "a", 11, "2019-01-01T00:00:00Z", None),
            (1, "a", 12, "2019-01-01T00:00:00Z", "2023-01-01T00:00:00Z"), (2, "b", 13, None, None)]
    s = spark.createDataFrame(rows, "location_id int, location_name string, sensor_id int, coverage_datetime_from string, coverage_datetime_to string")
    assert air_api.best_sensor(s).first()["sensor_id"] == 12
    per = {r["location_id"]: r["sensor_id"] for r in air_api.best_sensor(s, keys=("location_id",)).collect()}
    assert per == {1: 12, 2: 13}
    with pytest.raises(ValueError):
        air_api.require_rows(s.limit(0), "none")


# ---- roll-ups ----


def test_all_missing_rain_and_absent_columns(spark):
    raw = spark.createDataFrame([("2024-01-01 00:00", None, "1"), ("2024-01-01 01:00", None, "x"), ("bad", "5", "5")], "date_time string, precip_amount_mm string, temp_c string")
    got = daily.weather_daily(raw)
    assert got.columns == ["date", "wx_temp_mean_c", "wx_temp_max_c", "wx_temp_min_c", "wx_precip_total_mm", "wx_precip_max_mm"]
    assert [tuple(r) for r in got.collect()] == [(D(2024, 1, 1), 1.0, 1.0, 1.0, 0.0, None)]
    with pytest.raises(KeyError):
        daily.era5_daily(spark.createDataFrame([("2024-01-01", "1")], "time string, u10 string"))


def test_pm25_daily(spark):
    raw = spark.createDataFrame([("2024-01-01", "1", "s"), ("2024-01-01", "3", "t"), ("2024-01-02", "n/a", None), (None, "9", "s")], "date string, value string, location_name string")
    got = {r["date"]: (r["pm25"], r["pm25_station_count"]) for r in daily.pm25_daily(raw).collect()}
    assert got == {D(2024, 1, 1): (2.0, 2), D(2024, 1, 2): (None, 0)}


def test_range_filter_reaches_typed_scan(spark, tmp_path):
    path = str(tmp_path / "typed")
    spark.range(1000).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp_ntz").alias("date"), F.col("id").cast("double").alias("value")).write.parquet(path)
    plan = plan_of(daily.filter_days(daily.pm25_daily(spark.read.parquet(path)), "2020-03-01", "2020-03-31"))
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(date" in pushed and "LessThan" in pushed


def points(spark, rows):
    return spark.createDataFrame(rows, "latitude double, longitude double, frp double, datetime timestamp_ntz").withColumn("date", F.to_date("datetime"))


def test_fire_edge_days(spark):
    noon = dt.datetime(2024, 8, 16, 12)
    p = points(spark, [(52.0, -114.0, None, noon), (52.0, -114.0, 4.0, noon), (53.0, -114.0, None, noon + dt.timedelta(days=1)), (10.0, 10.0, 9.0, noon)])
    wind = days(spark, [("2024-08-16", 3.0)], "date string, era5_wind_from_deg double")
    got = {r["date"].day: r for r in fire.fire_features(p, wind).collect()}
    assert set(got) == {16, 17}
    one, two = got[16], got[17]
    assert one["fire_count"] == 2 and one["fire_frp_sum"] == 4.0 and one["fire_frp_mean"] == 4.0 and one["upwind_fire_count"] == 2
    assert two["fire_frp_sum"] == 0.0 and two["fire_frp_mean"] is None and two["fire_smoke_transport_index"] == 0.0
    assert two["upwind_fire_count"] == 0 and two["upwind_fire_nearest_km"] is None


def test_published_single_fire_days(spark):
    # date, frp, distance km, frp / (d + 1), smoke index, upwind count
    rows = [("2024-08-16", 1.14, 259.52643793814923, 0.0043757555241692, 1.6117493089778476e-05),
            ("2024-08-17", 3.1, 172.54673563534604, 0.0178626235097482, 1.619756279554958e-05),
            ("2024-12-16", 2.6, 336.770085171746, 0.007697543726165, 0.0)]
    for date, frp, km, weighted, smoke in rows:
        cosine = smoke * (km + 1) ** 2 / frp
        import math
        angle = math.degrees(math.acos(cosine)) if smoke else 120.0
        one = days(spark, [(date, frp, km, angle, 0.0)], "date string, frp double, distance_km double, bearing_deg double, era5_wind_from_deg double")
        r = fire.fire_daily(fire.smoke_rows(one)).first()
        assert r["fire_frp_dist_weighted_sum"] == pytest.approx(weighted, rel=1e-12)
        assert r["fire_smoke_transport_index"] == pytest.approx(smoke, rel=1e-9, abs=1e-18)
        assert r["upwind_fire_count"] == (1 if angle <= 45 else 0)


def test_sites_equal_single_site_and_salting_changes_nothing(spark, sf):
    from plumeworks.checks.adapters import feed
    p = feeds.parse_fire_points(feed(spark, sf, "fx_fire")).persist()
    wind = daily.era5_daily(feed(spark, sf, "fx_era5")).persist()
    single = fire.fire_features(p, wind)
    site = spark.createDataFrame([(1, fire.CENTRE_LAT, fire.CENTRE_LON)], "site_id int, site_lat double, site_lon double")
    many = fire.site_fire_features(p, site, wind.withColumn("site_id", F.lit(1))).drop("site_id")

    def rounded(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*single.columns).collect())

    want = sorted(rounded(single), key=str)
    assert sorted(rounded(many), key=str) == want
    salted = fire.fires_near_sites(p, site, broadcast_rows=0, salts=3)
    assert "BroadcastNestedLoopJoin" not in plan_of(salted) and "CartesianProduct" not in plan_of(salted)
    assert salted.count() == fire.fires_near(p).count()


def test_grid_join_against_brute_force(spark):
    import random
    rnd = random.Random(5)
    sites = spark.createDataFrame([(i, rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for i in range(20)] + [(20, 0.0, 179.9), (21, 88.5, 0.0)], "site_id int, site_lat double, site_lon double")
    p = points(spark, [(rnd.uniform(-90, 90), rnd.uniform(-180, 180), 1.0, dt.datetime(2024, 1, 1)) for _ in range(3000)])
    from plumeworks.functions.geo import haversine_km
    near = haversine_km(F.col("site_lat"), F.col("site_lon"), F.col("latitude"), F.col("longitude")) <= 1500.0
    want = {tuple(r) for r in p.join(sites, near).select("site_id", "latitude", "longitude").collect()}
    got = [tuple(r) for r in fire.fires_near_sites(p, sites, radius_km=1500.0).select("site_id", "latitude", "longitude").collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


# ---- filling, scaling, splitting ----


def test_fill_order(spark):
    rows = [("2024-01-01", 1.0, None, 5.0), ("2024-01-02", 2.0, 4.0, None), ("2024-01-03", None, 99.0, None), ("2024-01-04", 3.0, None, None), ("2024-02-05", 4.0, 8.0, None)]
    m = days(spark, rows, "date string, pm25 double, a double, b double")
    got = [(r["a"], r["b"]) for r in spine.fill_features(m).orderBy("date").collect()]
    assert got == [(4.0, 5.0), (4.0, 5.0), (4.0, 5.0), (8.0, 5.0)]
    later = [(r["a"], r["b"]) for r in spine.fill_features(m, drop_missing_target=False).orderBy("date").collect()]
    assert later[2] == (99.0, 5.0)
    blocks = forward_fill(m, ["a", "b"], block=F.trunc("date", "month"))
    assert sorted(map(str, blocks.select(m.columns).collect())) == sorted(map(str, forward_fill(m, ["a", "b"]).collect()))


def test_exact_medians_with_hot_values(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") * 1.0).alias("a"), F.when(F.col("id") < 0, 1.0).alias("none"))
    for keys in ((), ("k",)):
        want = df.groupBy(*keys).agg(F.median("a").alias("a"), F.median("none").alias("none")).collect()
        assert sorted(exact_medians(df, ["a", "none"], keys).collect()) == sorted(want)
    even = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "a double")
    assert exact_medians(even, ["a"]).first()["a"] == 2.5


def test_zscore(spark):
    df = days(spark, [("2024-01-01", 1.0, 5.0), ("2024-01-02", 3.0, 5.0)], "date string, a double, c double")
    assert [(r["z_a"], r["z_c"]) for r in zscore(df, ["a", "c"]).orderBy("date").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_split_sizes_and_errors(spark):
    base = spark.range(2361).select(F.date_add(F.lit("2018-04-01").cast("date"), F.col("id").cast("int")).alias("date"), F.lit(1.0).alias("x"))
    for one in (True, False):
        sizes = {r["split"]: r["count"] for r in spine.chrono_split(base, one_row_per_day=one).groupBy("split").count().collect()}
        assert sizes == {"train": 1652, "val": 354, "test": 355}
    train, val, test = spine.splits(spine.chrono_split(base))
    assert train.agg(F.max("date")).first()[0] < val.agg(F.min("date")).first()[0] <= val.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]
    for ratios in ((0.0, 0.1), (0.7, 1.0), (0.7, 0.3)):
        with pytest.raises(ValueError):
            spine.chrono_split(base, *ratios)
    with pytest.raises(Exception, match="not enough rows"):
        spine.chrono_split(base.limit(9)).collect()
    with pytest.raises(Exception, match="empty validation"):
        spine.chrono_split(base.limit(20), 0.7, 0.0).collect()


def test_all_null_column_dropped(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert drop_all_null(df, ["a", "b"]) == ["a"]


def test_lookup_join_forms_agree(spark):
    facts = spark.range(200).select((F.col("id") % 3).alias("k"), "id")
    dim = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, v string")
    forms = [lookup_join(facts, dim, ["k"], max_lookup_rows=10), lookup_join(facts, dim, ["k"], salt_on=["id"], salts=4), lookup_join(facts, dim, ["k"])]
    want = sorted(map(str, forms[0].select("k", "id", "v").collect()))
    assert all(sorted(map(str, f.select("k", "id", "v").collect())) == want for f in forms[1:])


def test_whole_run_writes_and_reloads(spark, sf, tmp_path):
    from plumeworks.checks.adapters import END, START, feed
    f = Feeds(*[feed(spark, sf, n) for n in ("fx_pm25", "fx_weather", "fx_era5", "fx_fire")])
    opt = Options(start=START, end=END)
    written = run_pipeline(f, opt, str(tmp_path / "out"))
    lazy = model_ready(master_features(f, opt), opt)
    n = f.pm25.filter(f"value <> 'n/a' AND date BETWEEN '{START}' AND '{END}'").select("date").distinct().count()
    assert written["model_ready"].count() == lazy.count() == n
    train, val, test = tables.reload_splits(spark, str(tmp_path / "out"))
    first, second = int(n * 0.7), int(n * (0.7 + 0.15))
    assert (train.count(), val.count(), test.count()) == (first, second - first, n - second)
    assert dict(written["fire_daily"].dtypes)["fire_count"] == "double"
    profile = {r["dataset"]: r["rows"] for r in dataset_profile(written).collect()}
    assert profile["master_daily"] == profile["fire_daily"] == spine.days_between(START, END)
    with pytest.raises(ValueError):
        Options(start="2024-01-02", end="2024-01-01").check()


def test_typed_fires_are_pruned_at_the_scan(spark, tmp_path):
    import datetime as dt

    rows = [(51.0 + i / 100, -114.0, dt.date(2020, 1, 1 + i % 20), str(i), 1.0) for i in range(40)]
    spark.createDataFrame(rows, "latitude double, longitude double, acq_date date, acq_time string, frp double").write.parquet(str(tmp_path / "f"))
    points = feeds.parse_fire_points(spark.read.parquet(str(tmp_path / "f")))
    near = fire.fires_near(points.filter("date >= DATE '2020-01-05'"), 51.0, -114.0, 10.0)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else the list is shown in part
    scan = next(line for line in plan_of(near).splitlines() if "PushedFilters" in line)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert all(f"OrEqual({c}," in scan.split("PushedFilters")[1] for c in ("latitude", "longitude", "acq_date"))
    assert near.count() == sum(r[2] >= dt.date(2020, 1, 5) and (r[0] - 51.0) * 111.195 <= 10 for r in rows)


def test_mixed_folders_never_swap(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("a,b\n1,2\n")
    (folder / "b.csv").write_text("b,a,c\n4,3,5\n")
    got = sorted((r["a"], r["b"], r["c"]) for r in feeds.scan_csv(spark, str(folder)).collect())
    assert got == [("1", "2", None), ("3", "4", "5")]
    with pytest.raises(Exception):
        feeds.scan_csv(spark, str(folder), header=["a", "b"]).collect()
    (tmp_path / "q.csv").write_text('a,b\n"x\ny",2\n')
    assert feeds.scan_csv(spark, str(tmp_path / "q.csv"), multi_line=True).first().asDict() == {"a": "x\ny", "b": "2"}


def test_table_replaced_in_place(spark, tmp_path):
    from plumeworks.sources.tables import update_table

    path = str(tmp_path / "board")
    update_table(spark, path, lambda old: spark.range(2) if old is None else old)
    assert update_table(spark, path, lambda old: old.union(spark.range(5, 6))).count() == 3
