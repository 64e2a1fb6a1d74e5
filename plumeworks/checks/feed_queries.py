"""Queries over sources, scalar functions, daily roll-ups and fire features."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions import coerce, geo, levels, names, weather
from ..functions.calendar import calendar_parts, season_of
from ..operators import daily as D
from ..operators import fire as FI
from ..operators import spine as S
from ..session import materialise, new_path
from ..sources import air_api, documents, feeds as source
from ..sources.tables import read_table, write_locations
from .adapters import (
    feature_docs, feed, land_csv, land_fire_drift, table, land_json, land_one_document, land_weather_drift, land_weather_years, land_zip, land_zip_single,
    location_docs, measurement_docs,
)
from .registry import query
from .sql import FIRE, LAT, LON, angle_diff, bearing, hav, kind, wrap

# ---- sources ----


@query("scan_pm25_csv", "date:s value:s location_name:s",
       "SELECT date, CASE WHEN value='n/a' THEN NULL ELSE value END AS value, location_name FROM fx_pm25")
def _(spark, sf):
    return source.scan_csv(spark, land_csv(feed(spark, sf, "fx_pm25"), "pm25"))


_DRIFT = "date_time_lst:s temp_c:d rel_hum:d precip_amount_mm:d visibility_km:d wind_spd_km_h:d"


@query("scan_weather_dir", _DRIFT,
       "SELECT date_time_lst, temp_c, rel_hum, precip_amount_mm, "
       "CASE WHEN CAST(substr(date_time_lst,1,4) AS INT)%2=0 THEN visibility_km END AS visibility_km, "
       "CASE WHEN CAST(substr(date_time_lst,1,4) AS INT)%2=0 THEN wind_spd_km_h END AS wind_spd_km_h FROM fx_weather")
def _(spark, sf):
    raw = source.scan_weather_dir(spark, land_weather_drift(spark, sf), "part-*.csv")
    return raw.select("date_time_lst", *[coerce.to_number(c).alias(c) for c in raw.columns if c != "date_time_lst"])


@query("scan_zip_csv", "valid_time:s u10:d v10:d t2m:d d2m:d sp:d", "SELECT * FROM fx_era5")
def _(spark, sf):
    raw = source.scan_zip_csv(spark, land_zip(feed(spark, sf, "fx_era5"), "era5"), pattern="part-*.csv")
    return raw.select("valid_time", *[coerce.to_number(c).alias(c) for c in ("u10", "v10", "t2m", "d2m", "sp")])


@query("scan_fire_csv", "latitude:d longitude:d acq_date:s acq_time:s frp:d", "SELECT * FROM fx_fire")
def _(spark, sf):
    return source.scan_fire_csv(spark, land_csv(feed(spark, sf, "fx_fire"), "fire"))


@query("scan_csv_drifted", "latitude:d longitude:d acq_date:s frp:d",
       "SELECT latitude, longitude, acq_date, frp FROM fx_fire")
def _(spark, sf):
    raw = source.scan_fire_csv(spark, land_fire_drift(spark, sf))
    return raw.select(*[coerce.to_number(c).alias(c) for c in ("latitude", "longitude", "frp")], "acq_date")


@query("scan_zip_members", "valid_time:s u10:d t2m:d", "SELECT valid_time, u10, NULL AS t2m FROM fx_era5 UNION ALL SELECT valid_time, NULL, t2m FROM fx_era5")
def _(spark, sf):
    raw = source.scan_zip_csv(spark, land_zip(feed(spark, sf, "fx_era5"), "era5", members=(("valid_time", "u10"), ("valid_time", "t2m"))), pattern="part-*.csv")
    return raw.select("valid_time", *[coerce.to_number(c).alias(c) for c in ("u10", "t2m")])


@query("scan_zip_single", "valid_time:s u10:d t2m:d tasks:b", "SELECT valid_time, u10, t2m, true AS tasks FROM fx_era5")
def _(spark, sf):
    """One archive with one member; ``tasks`` tells whether more than one task parsed it."""
    path = land_zip_single(feed(spark, sf, "fx_era5"), "era5-single")
    raw = source.scan_zip_csv(spark, path, columns=["valid_time", "u10", "t2m"], pattern="part-*.csv", block_bytes=1 << 17)
    rows = materialise(raw.select("valid_time", *[coerce.to_number(c).alias(c) for c in ("u10", "t2m")], F.spark_partition_id().alias("task")), "single-archive")
    return rows.withColumn("tasks", F.lit(rows.select("task").distinct().count() > 1))


@query("load_events", "event_id:i date:t y:i", "SELECT event_id, CAST(date AS DATE) AS date, y FROM fx_scores")
def _(spark, sf):
    path = land_csv(feed(spark, sf, "fx_scores").select("event_id", "date", "y"), "events")
    raw = source.read_events(source.scan_csv(spark, path))
    return raw.select(coerce.to_number("event_id").cast("bigint").alias("event_id"), "date", coerce.to_number("y").cast("int").alias("y"))


@query("scan_geojson", "name:s segment:s geometry_type:s",
       "SELECT CASE WHEN c_custkey%10<>0 THEN c_name END AS name, CASE WHEN c_custkey%10<>0 THEN c_mktsegment END AS segment, "
       "CASE WHEN c_custkey%4=0 THEN NULL WHEN c_custkey%2=0 THEN 'Polygon' ELSE 'Point' END AS geometry_type FROM customer")
def _(spark, sf):
    return documents.scan_geojson(spark, land_json(feature_docs(spark, sf), "features"), multi_line=False)


@query("scan_geojson_split", "name:s segment:s geometry_type:s",
       "SELECT CASE WHEN c_custkey%10<>0 THEN c_name END AS name, CASE WHEN c_custkey%10<>0 THEN c_mktsegment END AS segment, "
       "CASE WHEN c_custkey%4=0 THEN NULL WHEN c_custkey%2=0 THEN 'Polygon' ELSE 'Point' END AS geometry_type FROM customer")
def _(spark, sf):
    """One document that holds every customer, read in ranges of bytes by many tasks."""
    return documents.scan_geojson(spark, land_one_document(feature_docs(spark, sf), "one-document"), split_bytes=1 << 10, range_bytes=1 << 16)


@query("scan_grouped", "acq_date:s acq_time:s date:s frp:d latitude:d location_name:s longitude:d value:s",
       "SELECT acq_date, acq_time, date, frp, latitude, location_name, longitude, value FROM "
       "(SELECT * FROM fx_fire UNION ALL BY NAME SELECT date, CASE WHEN value='n/a' THEN NULL ELSE value END AS value, location_name FROM fx_pm25)")
def _(spark, sf):
    fire, pm25 = land_csv(feed(spark, sf, "fx_fire"), "fire"), land_csv(feed(spark, sf, "fx_pm25"), "pm25")
    return documents.scan_grouped(spark, [fire, os.path.join(fire, "not-there"), pm25])


_LOC = ("location_id:i location_name:s provider:s owner:s latitude:d longitude:d is_mobile:b datetime_first_utc:s "
        "datetime_last_utc:s n_sensors:i")


def _locations(spark, sf):
    pages = air_api.read_pages(spark, land_json(location_docs(spark, sf), "locations"), air_api.LOCATION_PAGE, multi_line=False)
    return air_api.flatten_locations(pages)


@query("flatten_locations", _LOC, "SELECT * FROM api_locations")
def _(spark, sf):
    return _locations(spark, sf).withColumn("n_sensors", F.size("sensors"))


@query("locations_files", "fmt:s location_id:i location_name:s latitude:d longitude:d sensors:i",
       "SELECT f.fmt, location_id, location_name, latitude, longitude, CASE WHEN f.fmt='parquet' THEN n_sensors END AS sensors "
       "FROM api_locations, (SELECT unnest(['csv','parquet']) AS fmt) f")
def _(spark, sf):
    """Locations written flat and whole, and read again."""
    locations, out = _locations(spark, sf), None
    for fmt in ("csv", "parquet"):
        path = new_path(spark, f"locations-{fmt}")
        write_locations(locations, path, fmt)
        read = source.scan_csv(spark, path) if fmt == "csv" else read_table(spark, path)
        typed = read.select(
            F.lit(fmt).alias("fmt"), F.col("location_id").cast("bigint").alias("location_id"), "location_name", *[F.col(c).cast("double").alias(c) for c in ("latitude", "longitude")],
            (F.size("sensors") if fmt == "parquet" else F.lit(None)).cast("bigint").alias("sensors"),
        )
        out = typed if out is None else out.unionByName(typed)
    return out


_SENSOR = ("location_id:i location_name:s sensor_id:i parameter_id:i parameter_name:s units:s coverage_datetime_from:s "
           "coverage_datetime_to:s")


@query("explode_sensors", _SENSOR, "SELECT * FROM api_sensors")
def _(spark, sf):
    return air_api.explode_sensors(_locations(spark, sf))


_BEST = "coverage_datetime_from NULLS LAST, coverage_datetime_to DESC NULLS LAST, sensor_id"


@query("best_sensor", _SENSOR, f"SELECT * FROM api_sensors ORDER BY {_BEST} LIMIT 1")
def _(spark, sf):
    return air_api.best_sensor(air_api.explode_sensors(_locations(spark, sf)))


@query("best_sensor_per_location", _SENSOR,
       f"SELECT * FROM api_sensors QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY {_BEST})=1")
def _(spark, sf):
    return air_api.best_sensor(air_api.explode_sensors(_locations(spark, sf)), keys=("location_id",))


@query("stations_in_radius", "location_id:i location_name:s distance_km:e",
       f"SELECT *, {hav(LAT, LON, 'latitude', 'longitude')} AS distance_km FROM api_locations WHERE has_pm25 "
       f"AND {hav(LAT, LON, 'latitude', 'longitude')}<=25e0")
def _(spark, sf):
    return air_api.stations_in_radius(_locations(spark, sf), geo.CENTRE_LAT, geo.CENTRE_LON)


_K8 = "CAST(o_orderkey%8 AS STRING)"
_ODAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_ONEXT = "CAST(CAST(o_orderdate AS DATE)+1 AS STRING)"
_MEAS = (
    "SELECT {d}||'T0'||{k}||':00:00Z' AS date_utc_from, {d}||'T00:00:00-0'||{k}||':00' AS date_local_from, "
    "CASE WHEN o_orderkey%17<>0 THEN {n}||'T0'||{k}||':00:00Z' END AS date_utc_to, "
    "CASE WHEN o_orderkey%17<>0 THEN {n}||'T00:00:00-0'||{k}||':00' END AS date_local_to, "
    "CASE WHEN o_orderkey%97<>0 THEN o_totalprice END AS value, CASE WHEN o_orderkey%13<>0 THEN 'ug/m3' END AS unit, "
    "CASE WHEN o_orderkey%13<>0 THEN 'pm25' END AS parameter_name, CAST(o_orderdate AS DATE) AS date FROM orders"
).format(d=_ODAY, n=_ONEXT, k=_K8)
_MEAS_SPEC = "date_utc_from:s date_local_from:s date_utc_to:s date_local_to:s value:d unit:s parameter_name:s"


def _measurements(spark, sf):
    path = land_json(measurement_docs(spark, sf), "measurements")
    return air_api.flatten_measurements(air_api.read_pages(spark, path, air_api.MEASUREMENT_PAGE, multi_line=False))


@query("flatten_measurements", _MEAS_SPEC, _MEAS)
def _(spark, sf):
    return _measurements(spark, sf)


@query("sensor_daily_rows", f"{_MEAS_SPEC} sensor_id:i location_name:s date:t",
       f"SELECT m.*, b.sensor_id, b.location_name FROM ({_MEAS}) m, (SELECT * FROM api_sensors ORDER BY {_BEST} LIMIT 1) b")
def _(spark, sf):
    best = air_api.best_sensor(air_api.explode_sensors(_locations(spark, sf)))
    return air_api.measurement_rows(_measurements(spark, sf), best)


@query("validate_landing", "yr:i accepted:b", "SELECT DISTINCT CAST(substr(date_time_lst,1,4) AS INT) AS yr, "
       "CAST(substr(date_time_lst,1,4) AS INT)%2=0 AS accepted FROM fx_weather")
def _(spark, sf):
    good, bad = documents.validate_landing(spark, land_weather_years(spark, sf), "part-*.txt")
    both = good.withColumn("accepted", F.lit(True)).unionByName(bad.withColumn("accepted", F.lit(False)))
    year = F.regexp_extract("path", r"yr=(\d+)", 1).cast("int")
    return both.groupBy(year.alias("yr")).agg(F.bool_and("accepted").alias("accepted"))


@query("union_by_name", "date:s value:s latitude:d frp:d",
       "SELECT date, value, latitude, frp FROM (SELECT * FROM fx_pm25 UNION ALL BY NAME SELECT * FROM fx_fire)")
def _(spark, sf):
    return source.union_all([feed(spark, sf, "fx_pm25"), feed(spark, sf, "fx_fire")])


# ---- scalar functions ----


@query("coerce_numeric", "id:i number:d",
       "SELECT id, CASE WHEN regexp_matches(num, '^\\s*[+-]?[0-9]') AND NOT regexp_matches(num, '[a-cf-z]\\s*$') "
       "THEN TRY_CAST(trim(num) AS DOUBLE) END AS number FROM fx_texts")
def _(spark, sf):
    return feed(spark, sf, "fx_texts").select("id", coerce.to_number("num").alias("number"))


@query("coerce_date", "id:i day:t", "SELECT id, CAST(TRY_CAST(day AS TIMESTAMP) AS DATE) AS day FROM fx_texts")
def _(spark, sf):
    return feed(spark, sf, "fx_texts").select("id", coerce.to_day("day").alias("day"))


_FORM_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_FORMS = (
    f"CASE id%7 WHEN 0 THEN concat(substr(d,1,4),'/',substr(d,6,2),'/',substr(d,9,2)) WHEN 1 THEN concat(substr(d,6,2),'/',substr(d,9,2),'/',substr(d,1,4),' 23:59') "
    "WHEN 2 THEN concat(substr(d,1,4),substr(d,6,2),substr(d,9,2)) WHEN 3 THEN concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec',CAST(substr(d,6,2) AS INT)*3-2,3),' ',substr(d,9,2),', ',substr(d,1,4)) "
    "WHEN 4 THEN concat(substr(d,9,2),' ',substr('JanFebMarAprMayJunJulAugSepOctNovDec',CAST(substr(d,6,2) AS INT)*3-2,3),' ',substr(d,1,4)) WHEN 5 THEN concat(d,'T23:05-06:00') ELSE concat('13/',d) END"
)


@query("date_forms", "id:i day:t utc:t",
       f"SELECT o_orderkey AS id, CASE WHEN o_orderkey%7<6 THEN CAST(o_orderdate AS DATE) END AS day, CASE WHEN o_orderkey%7=5 THEN CAST(o_orderdate AS DATE)+1 WHEN o_orderkey%7<5 THEN CAST(o_orderdate AS DATE) END AS utc FROM orders")
def _(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey AS id", f"{_FORM_DAY} AS d").selectExpr("id", f"{_FORMS} AS form")
    return rows.select("id", coerce.to_day("form").alias("day"), coerce.utc_day("form").alias("utc"))


@query("utc_date", "id:i day:t",
       "SELECT id, CAST(TRY_CAST(substr(local,1,19) AS TIMESTAMP) + to_hours(CAST(substr(local,22,1) AS INT)) AS DATE) AS day "
       "FROM (SELECT id, CASE WHEN local<>'bad' THEN local END AS local FROM fx_texts)")
def _(spark, sf):
    return feed(spark, sf, "fx_texts").select("id", coerce.utc_day("local").alias("day"))


@query("parse_fire_datetime", "acq_date:s acq_time:s minute:s rows:i",
       "SELECT acq_date, acq_time, strftime(ts, '%Y-%m-%d %H:%M') AS minute, count(*) AS rows FROM "
       "(SELECT acq_date, acq_time, TRY_CAST(acq_date || ' ' || substr(lpad(acq_time,4,'0'),1,2) || ':' || substr(lpad(acq_time,4,'0'),3,2) AS TIMESTAMP) AS ts "
       "FROM fx_fire) GROUP BY ALL")
def _(spark, sf):
    f = feed(spark, sf, "fx_fire").withColumn("ts", coerce.fire_timestamp("acq_date", "acq_time"))
    return f.groupBy("acq_date", "acq_time", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute")).agg(F.count(F.lit(1)).alias("rows"))


@query("drop_null_points", "latitude:d longitude:d frp:d date:t", "SELECT * FROM fire_pts")
def _(spark, sf):
    return source.parse_fire_points(feed(spark, sf, "fx_fire"))


@query("haversine_km", "id:i km:e", f"SELECT id, {hav(LAT, LON, 'lat', 'lon')} AS km FROM fx_angles")
def _(spark, sf):
    return feed(spark, sf, "fx_angles").select("id", geo.haversine_km(geo.CENTRE_LAT, geo.CENTRE_LON, F.col("lat"), F.col("lon")).alias("km"))


@query("bearing_deg", "id:i bearing:e", f"SELECT id, {bearing(LAT, LON, 'lat', 'lon')} AS bearing FROM fx_angles")
def _(spark, sf):
    return feed(spark, sf, "fx_angles").select("id", geo.bearing_deg(geo.CENTRE_LAT, geo.CENTRE_LON, F.col("lat"), F.col("lon")).alias("bearing"))


@query("angular_diff", "id:i diff:e", f"SELECT id, {angle_diff('a', 'b')} AS diff FROM fx_angles")
def _(spark, sf):
    return feed(spark, sf, "fx_angles").select("id", geo.angular_diff_deg(F.col("a"), F.col("b")).alias("diff"))


@query("wind_speed", "id:i speed:e", "SELECT id, sqrt(u*u+v*v) AS speed FROM fx_angles")
def _(spark, sf):
    return feed(spark, sf, "fx_angles").select("id", weather.wind_speed(F.col("u"), F.col("v")).alias("speed"))


@query("wind_from_deg", "id:i deg:e", f"SELECT id, {wrap('270e0-degrees(atan2(v,u))')} AS deg FROM fx_angles")
def _(spark, sf):
    return feed(spark, sf, "fx_angles").select("id", weather.wind_from_deg(F.col("u"), F.col("v")).alias("deg"))


@query("unit_convert", "valid_time:s t2m_c:e d2m_c:e sp_hpa:e",
       "SELECT valid_time, t2m-273.15e0 AS t2m_c, d2m-273.15e0 AS d2m_c, sp/1e2 AS sp_hpa FROM fx_era5")
def _(spark, sf):
    return feed(spark, sf, "fx_era5").select(
        "valid_time", weather.kelvin_to_celsius(F.col("t2m")).alias("t2m_c"),
        weather.kelvin_to_celsius(F.col("d2m")).alias("d2m_c"), weather.pascal_to_hectopascal(F.col("sp")).alias("sp_hpa"),
    )


_LEVEL = "(id % 1300)/1e1"


@query("risk_level5", "id:i level:d color:s",
       f"SELECT id, {_LEVEL} AS level, CASE WHEN {_LEVEL}>=100 THEN '#8B0000' WHEN {_LEVEL}>=50 THEN '#DC143C' "
       f"WHEN {_LEVEL}>=35 THEN '#FF4500' WHEN {_LEVEL}>=25 THEN '#FF8C00' ELSE '#90EE90' END AS color FROM fx_angles")
def _(spark, sf):
    f = feed(spark, sf, "fx_angles").selectExpr("id", f"{_LEVEL} AS level")
    return f.withColumn("color", levels.risk_colour(F.col("level")))


@query("risk_level4", "id:i level:d risk:s",
       f"SELECT id, {_LEVEL} AS level, CASE WHEN {_LEVEL}>=50 THEN 'severe' WHEN {_LEVEL}>=35 THEN 'high' "
       f"WHEN {_LEVEL}>=25 THEN 'moderate' ELSE 'low' END AS risk FROM fx_angles")
def _(spark, sf):
    f = feed(spark, sf, "fx_angles").selectExpr("id", f"{_LEVEL} AS level")
    return f.withColumn("risk", levels.risk_name(F.col("level")))


@query("wind_class", "id:i color:s weight:i",
       "SELECT id, CASE WHEN s<2 THEN 'blue' WHEN s<3 THEN 'green' WHEN s<4 THEN 'orange' ELSE 'red' END AS color, "
       "CASE WHEN s<3 THEN 2 WHEN s<4 THEN 3 ELSE 4 END AS weight FROM (SELECT id, sqrt(u*u+v*v) AS s FROM fx_angles)")
def _(spark, sf):
    s = weather.wind_speed(F.col("u"), F.col("v"))
    return feed(spark, sf, "fx_angles").select("id", levels.wind_colour(s).alias("color"), levels.wind_weight(s).alias("weight"))


@query("label_threshold", "date:t y:i", "SELECT date, CASE WHEN pm25>=25e0 THEN 1 ELSE 0 END AS y FROM pm25_all")
def _(spark, sf):
    return D.pm25_daily(feed(spark, sf, "fx_pm25")).select("date", levels.exceeds(F.col("pm25")).alias("y"))


@query("predict_threshold", "event_id:i y_pred:i", "SELECT event_id, CASE WHEN prob>=5e-1 THEN 1 ELSE 0 END AS y_pred FROM fx_scores")
def _(spark, sf):
    return feed(spark, sf, "fx_scores").select("event_id", levels.predicted_label(F.col("prob")).alias("y_pred"))


@query("dispersion_params", "id:i influence_radius:e major_axis:e minor_axis:e direction:e",
       "SELECT id, r AS influence_radius, r*(1e0+0.5e0*s) AS major_axis, r*(1e0-0.3e0*s) AS minor_axis, "
       f"{wrap('a+180e0')} AS direction FROM (SELECT id, a, 50e0*greatest(0.3e0, least(2e0, (id%1300)/1e1/25e0)) AS r, "
       "least(sqrt(u*u+v*v)/5e0,1e0) AS s FROM fx_angles)")
def _(spark, sf):
    f = feed(spark, sf, "fx_angles").selectExpr("*", f"{_LEVEL} AS level")
    plume = levels.dispersion(F.col("level"), weather.wind_speed(F.col("u"), F.col("v")), F.col("a"))
    return f.select("id", *[c.alias(n) for n, c in plume.items()])


@query("calendar_parts", "date:t year:i month:i month_name:s week:i day_of_year:i quarter:i season:s",
       "SELECT date, year(date) AS year, month(date) AS month, strftime(date,'%b') AS month_name, weekofyear(date) AS week, "
       "dayofyear(date) AS day_of_year, quarter(date) AS quarter, CASE WHEN month(date) IN (12,1,2) THEN 'Winter' "
       "WHEN month(date)<=5 THEN 'Spring' WHEN month(date)<=8 THEN 'Summer' ELSE 'Fall' END AS season FROM pm25_all")
def _(spark, sf):
    days = D.pm25_daily(feed(spark, sf, "fx_pm25")).select("date")
    return days.withColumns(calendar_parts(F.col("date"))).withColumn("season", season_of(F.col("month")))


@query("ellipse_polygon", "date:t vertex:i lon:e lat:e",
       f"SELECT date, i AS vertex, {LON}+(x*cos(t)-y*sin(t))/(111e0*cos(radians({LAT}))) AS lon, "
       f"{LAT}+(x*sin(t)+y*cos(t))/111e0 AS lat FROM (SELECT date, i, radians(d) AS t, mj*cos(2e0*pi()*(i%64)/63e0) AS x, "
       "mn*sin(2e0*pi()*(i%64)/63e0) AS y FROM (SELECT date, (w+180e0)%360e0 AS d, r*(1e0+0.5e0*s) AS mj, r*(1e0-0.3e0*s) AS mn, "
       "unnest(range(65)) AS i FROM (SELECT p.date, era5_wind_from_deg AS w, 50e0*greatest(0.3e0,least(2e0,pm25/25e0)) AS r, "
       "least(era5_wind_speed_mean_ms/5e0,1e0) AS s FROM pm25_all p JOIN era5_all e ON p.date=e.date WHERE pm25 IS NOT NULL)))")
def _(spark, sf):
    ring = _plumes(spark, sf).select(
        "date",
        geo.ellipse_polygon(geo.CENTRE_LAT, geo.CENTRE_LON, F.col("major_axis"), F.col("minor_axis"), F.col("direction")).alias("g"),
    )
    points = ring.select("date", F.posexplode(F.col("g.coordinates")[0]).alias("vertex", "p"))
    return points.select("date", "vertex", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"))


def _plumes(spark, sf):
    pm25 = D.pm25_daily(feed(spark, sf, "fx_pm25")).filter("pm25 IS NOT NULL")
    both = pm25.join(D.era5_daily(feed(spark, sf, "fx_era5")), "date")
    return both.withColumns(levels.dispersion(F.col("pm25"), F.col("era5_wind_speed_mean_ms"), F.col("era5_wind_from_deg")))


@query("wind_arrow", "date:t end_lon:e end_lat:e free_lat:e",
       f"SELECT date, {LON}+least(0.3e0,l)*sin(t)/cos(radians({LAT})) AS end_lon, {LAT}+least(0.3e0,l)*cos(t) AS end_lat, "
       f"{LAT}+l*cos(t) AS free_lat FROM (SELECT date, radians((era5_wind_from_deg+180e0)%360e0) AS t, "
       "0.05e0+0.04e0*era5_wind_speed_mean_ms AS l FROM era5_all)")
def _(spark, sf):
    e = D.era5_daily(feed(spark, sf, "fx_era5"))
    args = (geo.CENTRE_LAT, geo.CENTRE_LON, F.col("era5_wind_from_deg"), F.col("era5_wind_speed_mean_ms"))
    lines = e.select("date", geo.wind_arrow(*args).alias("g"), geo.wind_arrow(*args, cap=None).alias("h"))
    tip = F.col("g.coordinates")[1]
    return lines.select("date", tip[0].alias("end_lon"), tip[1].alias("end_lat"), F.col("h.coordinates")[1][1].alias("free_lat"))


# ---- daily roll-ups ----


@query("pm25_daily", "date:t pm25:e pm25_station_count:i", "SELECT * FROM pm25_all")
def _(spark, sf):
    return D.pm25_daily(feed(spark, sf, "fx_pm25"))


def _doubles(columns):
    return " ".join(f"{c}:{kind(c)}" for c in columns)


_WEATHER = [o for stats in D.WEATHER_FEATURES.values() for _, o in stats]


@query("weather_daily", "date:t " + _doubles(_WEATHER), "SELECT * FROM weather_all")
def _(spark, sf):
    return D.weather_daily(feed(spark, sf, "fx_weather"))


_ERA5 = ["era5_u10_mean_ms", "era5_v10_mean_ms", "era5_wind_speed_mean_ms", "era5_wind_speed_max_ms", "era5_wind_from_deg",
         "era5_t2m_mean_c", "era5_t2m_max_c", "era5_t2m_min_c", "era5_d2m_mean_c", "era5_sp_mean_hpa"]


@query("era5_daily", "date:t " + _doubles(_ERA5), "SELECT * FROM era5_all")
def _(spark, sf):
    return D.era5_daily(feed(spark, sf, "fx_era5"))


@query("filter_date_range", "date:t pm25:e", "SELECT * FROM pm25_all WHERE date BETWEEN DATE '1996-06-01' AND DATE '2000-06-30'")
def _(spark, sf):
    return D.filter_days(D.pm25_daily(feed(spark, sf, "fx_pm25")), "1996-06-01", "2000-06-30")


# ---- fire ----


def _points(spark, sf):
    return source.parse_fire_points(feed(spark, sf, "fx_fire"))


def _era5(spark, sf):
    # a written table: it is counted before it is joined
    return materialise(D.era5_daily(feed(spark, sf, "fx_era5")), "era5")


@query("radius_filter", "latitude:d longitude:d frp:d date:t distance_km:e bearing_deg:e", "SELECT * FROM fire_near")
def _(spark, sf):
    return FI.fires_near(_points(spark, sf))


@query("join_fire_wind", "latitude:d longitude:d date:t era5_wind_from_deg:e", "SELECT * FROM fire_wind")
def _(spark, sf):
    return FI.join_wind(FI.fires_near(_points(spark, sf)), _era5(spark, sf))


@query("fire_row_features", "date:t distance_km:e angle_diff_deg:e is_upwind:b frp_over_distance:d transport_weight:d smoke_index:d",
       "SELECT *, frp/(distance_km+1e0) AS frp_over_distance, w AS transport_weight, frp*w/pow(distance_km+1e0,2) AS smoke_index FROM fire_rows")
def _(spark, sf):
    return FI.smoke_rows(FI.join_wind(FI.fires_near(_points(spark, sf)), _era5(spark, sf)))


def _fire_rows(spark, sf):
    return FI.smoke_rows(FI.join_wind(FI.fires_near(_points(spark, sf)), _era5(spark, sf)))


@query("fire_daily", "date:t " + _doubles(FIRE[:7]), "SELECT * FROM fire_day")
def _(spark, sf):
    return _fire_rows(spark, sf).groupBy("date").agg(*FI.all_fire_measures())


@query("fire_upwind_daily", "date:t " + _doubles(FIRE[7:]), "SELECT * FROM fire_day")
def _(spark, sf):
    return _fire_rows(spark, sf).groupBy("date").agg(*FI.upwind_measures())


@query("fire_features", "date:t " + _doubles(FIRE), "SELECT * FROM fire_day")
def fire_features(spark, sf):
    points = source.parse_fire_points(feed(spark, sf, "fx_fire"))
    return FI.fire_features(points, _era5(spark, sf))


@query("join_all_upwind", "date:t fire_count:i upwind_fire_count:i upwind_fire_frp_sum:e upwind_fire_nearest_km:e",
       "SELECT a.date, a.fire_count, coalesce(u.n,0) AS upwind_fire_count, coalesce(u.f,0e0) AS upwind_fire_frp_sum, u.k AS upwind_fire_nearest_km "
       "FROM (SELECT date, count(*) AS fire_count FROM fire_rows GROUP BY 1) a LEFT JOIN (SELECT date, count(*) AS n, coalesce(sum(frp),0e0) AS f, "
       "min(distance_km) AS k FROM fire_rows WHERE is_upwind GROUP BY 1) u ON a.date=u.date")
def _(spark, sf):
    return fire_features(spark, sf)


_SITE_SQL = (
    "SELECT s.site_id, f.date, f.frp, {hav} AS distance_km, {bear} AS bearing_deg FROM fx_sites s JOIN fire_pts f ON {hav} <= 400e0"
).format(hav=hav("s.site_lat", "s.site_lon", "f.latitude", "f.longitude"), bear=bearing("s.site_lat", "s.site_lon", "f.latitude", "f.longitude"))


@query("sites_fire_join", "site_id:i date:t fires:i frp:e nearest_km:e mean_km:e mean_bearing:e",
       f"SELECT site_id, date, count(*) AS fires, sum(frp) AS frp, min(distance_km) AS nearest_km, avg(distance_km) AS mean_km, "
       f"avg(bearing_deg) AS mean_bearing FROM ({_SITE_SQL}) GROUP BY 1,2")
def _(spark, sf):
    pairs = FI.fires_near_sites(_points(spark, sf), feed(spark, sf, "fx_sites"))
    return pairs.groupBy("site_id", "date").agg(
        F.count(F.lit(1)).alias("fires"), F.sum("frp").alias("frp"), F.min("distance_km").alias("nearest_km"),
        F.avg("distance_km").alias("mean_km"), F.avg("bearing_deg").alias("mean_bearing"),
    )


@query("site_fire_counts", "site_id:i date:t fire_count:i fire_frp_sum:e",
       f"SELECT site_id, date, count(*) AS fire_count, coalesce(sum(frp),0e0) AS fire_frp_sum FROM ({_SITE_SQL}) GROUP BY 1,2")
def _(spark, sf):
    return FI.site_fire_counts(_points(spark, sf), feed(spark, sf, "fx_sites"))


@query("site_fire_features", "site_id:i date:t " + _doubles(FIRE),
       "SELECT site_id, date, count(*) AS fire_count, coalesce(sum(frp),0e0) AS fire_frp_sum, avg(frp) AS fire_frp_mean, "
       "min(distance_km) AS fire_nearest_km, avg(distance_km) AS fire_mean_km, coalesce(sum(frp/(distance_km+1e0)),0e0) AS fire_frp_dist_weighted_sum, "
       "coalesce(sum(frp*(CASE WHEN d IS NULL THEN NULL WHEN cos(radians(d))>0e0 THEN cos(radians(d)) ELSE 0e0 END)/pow(distance_km+1e0,2)),0e0) AS fire_smoke_transport_index, "
       "count(*) FILTER (WHERE round(d,9)<=45e0) AS upwind_fire_count, coalesce(sum(frp) FILTER (WHERE round(d,9)<=45e0),0e0) AS upwind_fire_frp_sum, "
       "min(distance_km) FILTER (WHERE round(d,9)<=45e0) AS upwind_fire_nearest_km FROM "
       f"(SELECT f.*, {angle_diff('f.bearing_deg', 'w.deg')} AS d FROM ({_SITE_SQL}) f LEFT JOIN "
       f"(SELECT site_id, CAST(CAST(valid_time AS TIMESTAMP) AS DATE) AS date, {wrap('270e0-degrees(atan2(avg(v10),avg(u10)))')} AS deg "
       "FROM fx_site_era5 GROUP BY 1,2) w ON f.site_id=w.site_id AND f.date=w.date) GROUP BY 1,2")
def _(spark, sf):
    wind = materialise(D.era5_daily(feed(spark, sf, "fx_site_era5"), keys=("site_id",)), "site_era5")
    points = source.parse_fire_points(feed(spark, sf, "fx_fire"))
    return FI.site_fire_features(points, feed(spark, sf, "fx_sites"), wind)


@query("site_pm25_daily", "site_id:i date:t pm25:e",
       "SELECT site_id, CAST(date AS DATE) AS date, avg(CAST(value AS DOUBLE)) AS pm25 FROM fx_site_pm25 GROUP BY 1,2")
def _(spark, sf):
    return D.pm25_daily(feed(spark, sf, "fx_site_pm25"), keys=("site_id",))


@query("buffer_filter", "latitude:d longitude:d date:t distance_km:e", "SELECT * FROM fire_near WHERE distance_km<=150e0")
def _(spark, sf):
    return FI.fires_near(_points(spark, sf), radius_km=150.0)


@query("fire_features_typed", "date:t " + _doubles(FIRE), "SELECT * FROM fire_day")
def _(spark, sf):
    raw = feed(spark, sf, "fx_fire")
    typed = raw.select(F.col("latitude").cast("double"), F.col("longitude").cast("double"), F.to_date("acq_date").alias("acq_date"), "acq_time", F.col("frp").cast("double"))
    return FI.fire_features(source.parse_fire_points(materialise(typed, "fires")), _era5(spark, sf))


@query("date_spine", "date:t", "SELECT date FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date "
       "FROM (SELECT min(date) AS lo, max(date) AS hi FROM pm25_all))")
def _(spark, sf):
    return S.spine_around(D.pm25_daily(feed(spark, sf, "fx_pm25")).select("date"), 0, 0)


@query("future_spine", "date:t", "SELECT CAST(unnest(generate_series(hi+INTERVAL 1 DAY, hi+INTERVAL 365 DAY, INTERVAL 1 DAY)) AS DATE) AS date "
       "FROM (SELECT max(date) AS hi FROM pm25_all)")
def _(spark, sf):
    return S.future_spine(D.pm25_daily(feed(spark, sf, "fx_pm25")).select("date"))


@query("clean_names", "date_time_lst:s wind_spd_km_h:d", "SELECT date_time_lst, wind_spd_km_h FROM fx_weather")
def _(spark, sf):
    f = feed(spark, sf, "fx_weather")
    return names.clean_columns(f.select(F.col("date_time_lst").alias("Date/Time (LST)"), F.col("wind_spd_km_h").alias("Wind Spd (km/h)")))
