"""SQL text of the checks: shared CTEs by name, plus the row shape both sides are cast to."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.daily import WEATHER_FEATURES
from ..operators.spine import NEAREST, ZERO_ON_QUIET_DAYS
from .adapters import END, FEEDS, START, feed_sql

WEATHER = [out for stats in WEATHER_FEATURES.values() for _, out in stats]
ERA5 = [
    "era5_u10_mean_ms", "era5_v10_mean_ms", "era5_wind_speed_mean_ms", "era5_wind_speed_max_ms", "era5_wind_from_deg",
    "era5_t2m_mean_c", "era5_t2m_max_c", "era5_t2m_min_c", "era5_d2m_mean_c", "era5_sp_mean_hpa",
]
FIRE = [
    "fire_count", "fire_frp_sum", "fire_frp_mean", "fire_nearest_km", "fire_mean_km", "fire_frp_dist_weighted_sum",
    "fire_smoke_transport_index", "upwind_fire_count", "upwind_fire_frp_sum", "upwind_fire_nearest_km",
]
FEATURES = ["pm25_station_count", *WEATHER, *ERA5, *FIRE]



def kind(column: str) -> str:
    """Shape letter of a feature: counts are whole, the smoke index is tiny and keeps nine digits."""
    if column.endswith("_count"):
        return "i"
    return "d" if column == "fire_smoke_transport_index" else "e"


LAT, LON = "51.0447e0", "(-114.0719e0)"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2e0*6371.0088e0*asin(sqrt(pow(sin(radians({lat2}-{lat1})/2e0),2)"
        f"+cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians({lon2}-{lon1})/2e0),2)))"
    )


def wrap(x: str) -> str:
    return f"(((({x}) % 360e0)+360e0) % 360e0)"


def bearing(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return wrap(
        f"degrees(atan2(sin(radians({lon2}-{lon1}))*cos(radians({lat2})), "
        f"cos(radians({lat1}))*sin(radians({lat2}))-sin(radians({lat1}))*cos(radians({lat2}))*cos(radians({lon2}-{lon1}))))"
    )


def angle_diff(a: str, b: str) -> str:
    return f"abs({wrap(f'{a}-{b}+180e0')}-180e0)"


def fire_time() -> str:
    t = "CASE WHEN length(acq_time)<4 THEN lpad(acq_time,4,'0') ELSE acq_time END"
    return f"TRY_CAST(acq_date || ' ' || substr({t},1,2) || ':' || substr({t},3) AS TIMESTAMP)"


_UP = "is_upwind"
_FIRE_AGG = (
    "count(*) AS fire_count, coalesce(sum(frp),0e0) AS fire_frp_sum, avg(frp) AS fire_frp_mean, "
    "min(distance_km) AS fire_nearest_km, avg(distance_km) AS fire_mean_km, "
    "coalesce(sum(frp/(distance_km+1e0)),0e0) AS fire_frp_dist_weighted_sum, "
    "coalesce(sum(frp*w/pow(distance_km+1e0,2)),0e0) AS fire_smoke_transport_index, "
    f"count(*) FILTER (WHERE {_UP}) AS upwind_fire_count, "
    f"coalesce(sum(frp) FILTER (WHERE {_UP}),0e0) AS upwind_fire_frp_sum, "
    f"min(distance_km) FILTER (WHERE {_UP}) AS upwind_fire_nearest_km"
)
_SMOKE = (
    "d AS angle_diff_deg, coalesce(round(d,9)<=45e0,false) AS is_upwind, "
    "CASE WHEN d IS NULL THEN NULL WHEN cos(radians(d))>0e0 THEN cos(radians(d)) ELSE 0e0 END AS w"
)
_RANGE = f"date BETWEEN DATE '{START}' AND DATE '{END}'"
_SPINE = f"SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS date"

CTES: dict[str, str] = {
    **{name: feed_sql(name) for name in FEEDS},
    "pm25_all": "SELECT CAST(date AS DATE) AS date, avg(TRY_CAST(value AS DOUBLE)) AS pm25, "
                "count(DISTINCT location_name) AS pm25_station_count FROM fx_pm25 GROUP BY 1",
    "weather_all": "SELECT CAST(CAST(date_time_lst AS TIMESTAMP) AS DATE) AS date, avg(temp_c) AS wx_temp_mean_c, "
                   "max(temp_c) AS wx_temp_max_c, min(temp_c) AS wx_temp_min_c, avg(dew_point_temp_c) AS wx_dewpoint_mean_c, "
                   "avg(rel_hum) AS wx_rh_mean_pct, max(rel_hum) AS wx_rh_max_pct, min(rel_hum) AS wx_rh_min_pct, "
                   "coalesce(sum(precip_amount_mm),0e0) AS wx_precip_total_mm, max(precip_amount_mm) AS wx_precip_max_mm, "
                   "avg(wind_spd_km_h) AS wx_windspd_mean_kmh, max(wind_spd_km_h) AS wx_windspd_max_kmh, "
                   "avg(stn_press_kpa) AS wx_pressure_mean_kpa, avg(visibility_km) AS wx_visibility_mean_km, "
                   "min(visibility_km) AS wx_visibility_min_km FROM fx_weather GROUP BY 1",
    "era5_vec": "SELECT CAST(CAST(valid_time AS TIMESTAMP) AS DATE) AS date, avg(u10) AS era5_u10_mean_ms, "
                "avg(v10) AS era5_v10_mean_ms, avg(sqrt(u10*u10+v10*v10)) AS era5_wind_speed_mean_ms, "
                "max(sqrt(u10*u10+v10*v10)) AS era5_wind_speed_max_ms, avg(t2m)-273.15e0 AS era5_t2m_mean_c, "
                "max(t2m)-273.15e0 AS era5_t2m_max_c, min(t2m)-273.15e0 AS era5_t2m_min_c, "
                "avg(d2m)-273.15e0 AS era5_d2m_mean_c, avg(sp)/1e2 AS era5_sp_mean_hpa FROM fx_era5 GROUP BY 1",
    "era5_all": f"SELECT *, {wrap('270e0-degrees(atan2(era5_v10_mean_ms,era5_u10_mean_ms))')} AS era5_wind_from_deg FROM era5_vec",
    "fire_pts": f"SELECT latitude, longitude, frp, ts AS datetime, CAST(ts AS DATE) AS date FROM "
                f"(SELECT *, {fire_time()} AS ts FROM fx_fire) WHERE ts IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL",
    "fire_near": f"SELECT *, {hav(LAT, LON, 'latitude', 'longitude')} AS distance_km, "
                 f"{bearing(LAT, LON, 'latitude', 'longitude')} AS bearing_deg FROM fire_pts "
                 f"WHERE {hav(LAT, LON, 'latitude', 'longitude')} <= 400e0",
    "fire_wind": "SELECT f.*, e.era5_wind_from_deg FROM fire_near f LEFT JOIN era5_all e ON f.date = e.date",
    "fire_rows": f"SELECT *, {_SMOKE} FROM (SELECT *, {angle_diff('bearing_deg', 'era5_wind_from_deg')} AS d FROM fire_wind)",
    "fire_day": f"SELECT date, {_FIRE_AGG} FROM fire_rows GROUP BY 1",
    "spine": _SPINE,
    "fire_joined": "SELECT s.date, " + ", ".join(
        (f"coalesce(f.{c},0) AS {c}" if c in ZERO_ON_QUIET_DAYS else f"f.{c}") for c in FIRE
    ) + " FROM spine s LEFT JOIN fire_day f ON s.date = f.date",
    "fire_full": "SELECT date, " + ", ".join(
        (f"coalesce({c}, max({c}) OVER (), 400e0) AS {c}" if c in NEAREST else c) for c in FIRE
    ) + " FROM fire_joined",
    "pm25_day": f"SELECT * FROM pm25_all WHERE {_RANGE}",
    "weather_day": f"SELECT * FROM weather_all WHERE {_RANGE}",
    "era5_day": f"SELECT * FROM era5_all WHERE {_RANGE}",
    "master": "SELECT s.date, pm25, pm25_station_count, " + ", ".join([*WEATHER, *ERA5, *FIRE])
              + " FROM spine s LEFT JOIN pm25_day p ON p.date=s.date LEFT JOIN weather_day w ON w.date=s.date "
                "LEFT JOIN era5_day e ON e.date=s.date LEFT JOIN fire_full f ON f.date=s.date",
    "ffilled": "SELECT date, pm25, " + ", ".join(
        f"last_value({c} IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in FEATURES
    ) + " FROM master WHERE pm25 IS NOT NULL",
    "medians": "SELECT " + ", ".join(f"median({c}) AS {c}" for c in FEATURES) + " FROM ffilled",
    "ready": "SELECT f.date, f.pm25, " + ", ".join(f"coalesce(f.{c}, m.{c}) AS {c}" for c in FEATURES) + " FROM ffilled f, medians m",
    "ready_split": "SELECT *, CASE WHEN rn < floor(n*0.7e0) THEN 'train' WHEN rn < floor(n*0.85e0) THEN 'val' ELSE 'test' END AS split "
                   "FROM (SELECT *, row_number() OVER (ORDER BY date)-1 AS rn, count(*) OVER () AS n FROM ready)",
    "high": "SELECT * FROM ready WHERE pm25 >= 25e0",
    # days with a label and a simple rule as the prediction: low visibility or a raised concentration
    "ruled": "SELECT date, pm25, CASE WHEN pm25>=25e0 THEN 1 ELSE 0 END AS y, "
             "CASE WHEN wx_visibility_mean_km < 8e0 THEN 1 ELSE 0 END AS y_pred FROM ready",
    "timeline": "SELECT d.date, CASE WHEN h.date IS NOT NULL THEN h.pm25 ELSE 15e0 END AS pm25, "
                "CASE WHEN h.date IS NOT NULL THEN h.era5_wind_speed_mean_ms ELSE 2.5e0 END AS era5_wind_speed_mean_ms, "
                "CASE WHEN h.date IS NOT NULL THEN h.era5_wind_from_deg ELSE 180e0 END AS era5_wind_from_deg, "
                "CASE WHEN h.date IS NOT NULL THEN CAST(h.fire_count AS DOUBLE) ELSE 0e0 END AS fire_count, "
                "CASE WHEN h.date IS NOT NULL THEN CAST(h.upwind_fire_count AS DOUBLE) ELSE 0e0 END AS upwind_fire_count "
                "FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM "
                "(SELECT min(date)-INTERVAL 3 DAY AS lo, max(date)+INTERVAL 3 DAY AS hi FROM high)) d LEFT JOIN high h ON h.date=d.date",
    "top2": "SELECT *, row_number() OVER (ORDER BY pm25 DESC, date) AS event_rank FROM high ORDER BY pm25 DESC, date LIMIT 2",
    "windows": "SELECT t.event_rank, t.date AS event_date, t.pm25 AS event_pm25, l.* FROM top2 t JOIN timeline l "
               "ON l.date BETWEEN t.date - INTERVAL 3 DAY AND t.date + INTERVAL 4 DAY",
    "frames": "SELECT event_rank, event_date, date, pm25, "
              "row_number() OVER (PARTITION BY event_rank ORDER BY date) AS day_num, "
              "max(pm25) OVER (PARTITION BY event_rank) AS peak_pm25, "
              "row_number() OVER (PARTITION BY event_rank ORDER BY pm25 DESC, date)=1 AS is_peak, "
              "era5_wind_speed_mean_ms AS wind_speed, era5_wind_from_deg AS wind_direction, "
              "50e0*greatest(0.3e0,least(2e0,pm25/25e0))*(1e0+0.5e0*least(era5_wind_speed_mean_ms/5e0,1e0)) AS major_axis, "
              "50e0*greatest(0.3e0,least(2e0,pm25/25e0))*(1e0-0.3e0*least(era5_wind_speed_mean_ms/5e0,1e0)) AS minor_axis, "
              "(era5_wind_from_deg+180e0)%360e0 AS direction, "
              "CASE WHEN pm25>=100 THEN '#8B0000' WHEN pm25>=50 THEN '#DC143C' WHEN pm25>=35 THEN '#FF4500' "
              "WHEN pm25>=25 THEN '#FF8C00' ELSE '#90EE90' END AS color, "
              "CASE WHEN era5_wind_speed_mean_ms<2 THEN 'blue' WHEN era5_wind_speed_mean_ms<3 THEN 'green' "
              "WHEN era5_wind_speed_mean_ms<4 THEN 'orange' ELSE 'red' END AS wind_color, "
              "CASE WHEN era5_wind_speed_mean_ms<3 THEN 2 WHEN era5_wind_speed_mean_ms<4 THEN 3 ELSE 4 END AS wind_weight, "
              "CASE WHEN fire_count>0 THEN 'Yes' ELSE 'No' END AS fire FROM windows",
    # landed API pages, stated flat
    "api_locations": "SELECT s_suppkey//4 AS location_id, concat('loc', CAST(s_suppkey//4 AS STRING)) AS location_name, "
                     "CASE WHEN (s_suppkey//4)%3<>0 THEN 'prov' END AS provider, 'own' AS owner, "
                     "50.8e0+((s_suppkey//4)%40)/80e0 AS latitude, -114.3e0+((s_suppkey//4)%30)/60e0 AS longitude, "
                     "(s_suppkey//4)%2=0 AS is_mobile, '2016-01-01T00:00:00Z' AS datetime_first_utc, "
                     "CASE WHEN (s_suppkey//4)%4<>0 THEN '2024-01-01T00:00:00Z' END AS datetime_last_utc, "
                     "count(*) AS n_sensors, bool_or(s_suppkey%3=2) AS has_pm25 FROM supplier GROUP BY s_suppkey//4",
    "api_sensors": "SELECT s_suppkey//4 AS location_id, concat('loc', CAST(s_suppkey//4 AS STRING)) AS location_name, "
                   "s_suppkey AS sensor_id, s_suppkey%3 AS parameter_id, 'p2' AS parameter_name, 'ug/m3' AS units, "
                   "CASE WHEN s_suppkey%7<>0 THEN CAST(DATE '2016-01-01'+CAST(s_suppkey%900 AS INTEGER) AS STRING)||'T00:00:00Z' END AS coverage_datetime_from, "
                   "CASE WHEN s_suppkey%5<>0 THEN CAST(DATE '2024-01-01'+CAST(s_suppkey%400 AS INTEGER) AS STRING)||'T00:00:00Z' END AS coverage_datetime_to "
                   "FROM supplier WHERE s_suppkey%3=2",
    # scores combined per distinct value, cumulated from the top
    "score_groups": "SELECT model, prob AS threshold, sum(y) AS pos, sum(1-y) AS neg FROM fx_scores GROUP BY 1,2",
    "score_ranks": "SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS p, "
                   "sum(neg) OVER (PARTITION BY model) AS n FROM score_groups WINDOW w AS (PARTITION BY model ORDER BY threshold DESC)",
}


def metric_sql(source: str, by: list[str]) -> str:
    """All six metrics per group straight from the scored rows."""
    group = ", ".join(by)
    sel = f"{group}, " if by else ""
    part = f"PARTITION BY {group}" if by else ""
    gb = f"GROUP BY {group}" if by else ""
    return (
        f"WITH g AS (SELECT {sel}prob, sum(y) AS pos, sum(1-y) AS neg, sum(CASE WHEN prob>=5e-1 THEN y ELSE 0 END) AS tpos, "
        f"sum(CASE WHEN prob>=5e-1 THEN 1-y ELSE 0 END) AS fneg FROM {source} GROUP BY {sel}prob), "
        f"r AS (SELECT *, sum(pos) OVER ({part} ORDER BY prob DESC) AS tp, sum(neg) OVER ({part} ORDER BY prob DESC) AS fp, "
        f"sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS n FROM g) "
        f"SELECT {sel}"
        "CAST(sum(tpos)+max(n)-sum(fneg) AS DOUBLE)/(max(p)+max(n)) AS accuracy, "
        "CASE WHEN sum(tpos)+sum(fneg)=0 THEN 0e0 ELSE CAST(sum(tpos) AS DOUBLE)/(sum(tpos)+sum(fneg)) END AS precision, "
        "CASE WHEN max(p)=0 THEN 0e0 ELSE CAST(sum(tpos) AS DOUBLE)/max(p) END AS recall, "
        "CASE WHEN max(p)+sum(tpos)+sum(fneg)=0 THEN 0e0 ELSE 2e0*sum(tpos)/(max(p)+sum(tpos)+sum(fneg)) END AS f1, "
        "sum(CAST(neg AS DOUBLE)*(tp-pos+pos/2e0))/(CAST(max(p) AS DOUBLE)*max(n)) AS roc_auc, "
        "sum(CAST(pos AS DOUBLE)*tp/(tp+fp))/max(p) AS pr_auc "
        f"FROM r {gb}"
    )


# Many means are short decimals that end exactly on a rounding tie, where the order of a sum would
# decide the last digit. Both sides add the same tiny offset first, which moves them off the tie.
OFF_TIE_9, OFF_TIE_6 = "1.234567e-10", "1.234567e-7"


def _needed(text: str, found: dict[str, None]) -> None:
    for name in CTES:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(CTES[name], found)
            found[name] = None


def full_sql(spec: str, body: str) -> str:
    """Prepend the CTEs the body names and cast the result to the shape."""
    needed: dict[str, None] = {}
    _needed(body, needed)
    ctes = [f"{n} AS ({CTES[n]})" for n in needed] + [f"result AS ({body})"]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(_sql_column(c) for c in spec.split())} FROM result"


def _sql_column(item: str) -> str:
    name, kind = item.split(":")
    cast = {
        "t": f'CAST(CAST("{name}" AS DATE) AS VARCHAR)',
        "s": f'CAST("{name}" AS VARCHAR)',
        "i": f'CAST("{name}" AS BIGINT)',
        "b": f'CAST("{name}" AS BOOLEAN)',
        "d": f'round(CAST("{name}" AS DOUBLE) + {OFF_TIE_9}, 9)',
        "e": f'round(CAST("{name}" AS DOUBLE) + {OFF_TIE_6}, 6)',
    }[kind]
    return f'{cast} AS "{name}"'


def shape(df: DataFrame, spec: str) -> DataFrame:
    """The same casts on the Spark side. Dates become text, doubles are rounded."""
    out = []
    for item in spec.split():
        name, kind = item.split(":")
        c = F.col(f"`{name}`")
        cast = {
            "t": lambda: F.date_format(c, "yyyy-MM-dd"),
            "s": lambda: c.cast("string"),
            "i": lambda: c.cast("bigint"),
            "b": lambda: c.cast("boolean"),
            "d": lambda: F.round(c.cast("double") + F.lit(float(OFF_TIE_9)), 9),
            "e": lambda: F.round(c.cast("double") + F.lit(float(OFF_TIE_6)), 6),
        }[kind]()
        out.append(cast.alias(name))
    return df.select(*out)
