"""Queries over the integrated daily table: filling, scaling, splits, patterns, events, reports."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.calendar import calendar_parts
from ..functions.levels import exceeds
from ..operators import daily as D
from ..operators import events as E
from ..operators import patterns as P
from ..operators import spine as S
from ..operators.ordering import forward_fill
from ..operators.stats import drop_all_null, exact_medians, moments, zscore
from ..plans.pipeline import dataset_profile, master_features, model_ready, preview, run_pipeline, scaled
from ..plans.report import pattern_report
from ..session import new_path
from ..sources.tables import SPLITS, read_table, reload_splits, write_json
from .adapters import END, START, feed
from .feed_queries import fire_features
from .registry import OPTIONS, feeds, kept_folder, master_table, query, ready_table
from .sql import FEATURES, FIRE, kind


def _spec(columns, counts=True):
    return " ".join(f"{c}:{'e' if not counts and kind(c) == 'i' else kind(c)}" for c in columns)


# ---- integration ----


@query("fire_spine_fill", "date:t " + _spec(FIRE), "SELECT * FROM fire_full")
def _(spark, sf):
    fire = D.filter_days(fire_features(spark, sf), START, END)
    return S.fill_fire(S.date_spine(spark, START, END), fire, OPTIONS.radius_km)


@query("master_daily", "date:t pm25:e wx_temp_mean_c:e era5_wind_from_deg:e fire_count:i",
       "SELECT s.date, p.pm25, w.wx_temp_mean_c, e.era5_wind_from_deg, f.fire_count FROM spine s LEFT JOIN pm25_day p ON p.date=s.date "
       "LEFT JOIN weather_day w ON w.date=s.date LEFT JOIN era5_day e ON e.date=s.date LEFT JOIN fire_day f ON f.date=s.date")
def _(spark, sf):
    def within(df):
        return D.filter_days(df, START, END)

    return S.join_master(
        S.date_spine(spark, START, END),
        [
            within(D.pm25_daily(feed(spark, sf, "fx_pm25"))),
            within(D.weather_daily(feed(spark, sf, "fx_weather"))),
            within(D.era5_daily(feed(spark, sf, "fx_era5"))),
            within(fire_features(spark, sf)),
        ],
    )


@query("master_features", "date:t pm25:e " + _spec(FEATURES), "SELECT * FROM master")
def _(spark, sf):
    return master_features(feeds(spark, sf), OPTIONS)


@query("master_zero_fill", "date:t pm25:e " + _spec(FIRE),
       "SELECT s.date, p.pm25, " + ", ".join(
           f"coalesce(f.{c}, max(f.{c}) OVER (), 500e0) AS {c}" if c.endswith("nearest_km") else f"coalesce(f.{c},0) AS {c}" for c in FIRE
       ) + " FROM spine s LEFT JOIN pm25_day p ON p.date=s.date LEFT JOIN (SELECT * FROM fire_day WHERE "
       f"date BETWEEN DATE '{START}' AND DATE '{END}') f ON f.date=s.date")
def _(spark, sf):
    pm25 = D.filter_days(D.pm25_daily(feed(spark, sf, "fx_pm25")), START, END)
    fire = D.filter_days(fire_features(spark, sf), START, END)
    return S.fill_master(S.join_master(S.date_spine(spark, START, END), [pm25, fire]))


@query("forward_fill", "date:t pm25:e " + _spec(FEATURES), "SELECT * FROM ffilled")
def _(spark, sf):
    rows = master_table(spark, sf).filter("pm25 IS NOT NULL")
    return forward_fill(rows, FEATURES)


@query("forward_fill_blocks", "date:t pm25:e " + _spec(FEATURES), "SELECT * FROM ffilled")
def _(spark, sf):
    rows = master_table(spark, sf).filter("pm25 IS NOT NULL")
    return forward_fill(rows, FEATURES, block=F.trunc("date", "month"))


@query("exact_medians", _spec(FEATURES, counts=False), "SELECT * FROM medians")
def _(spark, sf):
    rows = master_table(spark, sf).filter("pm25 IS NOT NULL")
    return exact_medians(forward_fill(rows, FEATURES), FEATURES)


@query("median_price_by_site", "site_id:i pm25:e",
       "SELECT site_id, median(CAST(value AS DOUBLE)) AS pm25 FROM fx_site_pm25 GROUP BY 1")
def _(spark, sf):
    rows = feed(spark, sf, "fx_site_pm25").select("site_id", F.col("value").cast("double").alias("pm25"))
    return exact_medians(rows, ["pm25"], keys=("site_id",))


@query("model_ready", "date:t pm25:e split:s " + _spec(FEATURES, counts=False), "SELECT * FROM ready_split")
def _(spark, sf):
    return model_ready(master_features(feeds(spark, sf), OPTIONS), OPTIONS)


@query("chrono_split", "split:s rows:i first_date:t last_date:t",
       "SELECT split, count(*) AS rows, min(date) AS first_date, max(date) AS last_date FROM ready_split GROUP BY 1")
def _(spark, sf):
    split = S.chrono_split(ready_table(spark, sf).drop("split"))
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("train_val_union", "date:t pm25:e", "SELECT * FROM ready_split WHERE split IN ('train','val')")
def _(spark, sf):
    train, val, _ = S.splits(ready_table(spark, sf))
    return train.unionByName(val)


@query("column_moments", " ".join(f"mean_{c}:e std_{c}:e" for c in FEATURES),
       "SELECT " + ", ".join(f"avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}" for c in FEATURES) + " FROM ready")
def _(spark, sf):
    return moments(ready_table(spark, sf), FEATURES)


def _zsql(source, columns, part=""):
    return ", ".join(
        f"({c}-avg({c}) OVER ({part}))/CASE WHEN stddev_pop({c}) OVER ({part})=0 THEN 1e0 ELSE stddev_pop({c}) OVER ({part}) END AS z_{c}"
        for c in columns
    ) + f" FROM {source}"


@query("zscore", "date:t " + " ".join(f"z_{c}:e" for c in FEATURES), "SELECT date, " + _zsql("ready", FEATURES))
def _(spark, sf):
    return scaled(ready_table(spark, sf))


_SITE_DAY = "SELECT site_id, CAST(date AS DATE) AS date, avg(CAST(value AS DOUBLE)) AS pm25 FROM fx_site_pm25 GROUP BY 1,2"


@query("site_zscore", "site_id:i date:t z_pm25:e", "SELECT site_id, date, " + _zsql(f"({_SITE_DAY})", ["pm25"], "PARTITION BY site_id"))
def _(spark, sf):
    return zscore(D.pm25_daily(feed(spark, sf, "fx_site_pm25"), ("site_id",)), ["pm25"], keys=("site_id",))


@query("drop_allnull_columns", "kept:s", "SELECT kept FROM (SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURES) + "]) AS kept) WHERE kept IN ("
       "SELECT unnest([" + ", ".join(f"CASE WHEN (SELECT count({c}) FROM master WHERE date IN (SELECT date FROM ready_split WHERE split='train'))>0 THEN '{c}' END" for c in FEATURES) + "]))")
def _(spark, sf):
    """Over the whole train split, with two more columns that never hold a value there."""
    days = ready_table(spark, sf).where("split = 'train'").select("date")
    train = master_table(spark, sf).join(days, "date", "left_semi")
    train = train.withColumns({"never": F.lit(None).cast("double"), "never_here": F.when(F.col("pm25").isNull(), 1.0)})
    columns = drop_all_null(train, [*FEATURES, "never", "never_here"])
    return train.sparkSession.createDataFrame([(c,) for c in columns], "kept string")


_SITE_MEDIAN = ["u10", "v10"]


@query("site_medians", "site_id:i u10:e v10:e", "SELECT site_id, median(u10) AS u10, median(v10) AS v10 FROM fx_site_era5 GROUP BY 1")
def _(spark, sf):
    return exact_medians(feed(spark, sf, "fx_site_era5"), _SITE_MEDIAN, keys=("site_id",))


# ---- patterns ----

_PATTERN = ("avg(pm25) AS pm25_mean, stddev_samp(pm25) AS pm25_std, max(pm25) AS pm25_max, "
            "sum(CASE WHEN pm25>=25e0 THEN 1 ELSE 0 END) AS high_pollution_days, count(*) AS total_days")
_MONTHLY = f"SELECT month(date) AS month, {_PATTERN}, min(strftime(date,'%b')) AS month_name FROM pm25_all GROUP BY 1"
_YEARLY = (f"SELECT year(date) AS year, {_PATTERN}, min(pm25) AS pm25_min, "
           "CAST(sum(CASE WHEN pm25>=25e0 THEN 1 ELSE 0 END) AS DOUBLE)/count(*) AS high_pollution_ratio FROM pm25_all GROUP BY 1")
_PSPEC = "pm25_mean:e pm25_std:e pm25_max:e high_pollution_days:i total_days:i"


def _pm25(spark, sf):
    return D.pm25_daily(feed(spark, sf, "fx_pm25"))


@query("event_filter", "date:t pm25:e", "SELECT * FROM pm25_all WHERE pm25>=25e0")
def _(spark, sf):
    return P.high_days(_pm25(spark, sf))


@query("monthly_patterns", f"month:i {_PSPEC} month_name:s", _MONTHLY)
def _(spark, sf):
    return P.monthly_patterns(_pm25(spark, sf))


@query("yearly_patterns", f"year:i {_PSPEC} pm25_min:e high_pollution_ratio:e", _YEARLY)
def _(spark, sf):
    return P.yearly_patterns(_pm25(spark, sf))


@query("site_monthly_patterns", f"site_id:i month:i {_PSPEC}",
       f"SELECT site_id, month(date) AS month, {_PATTERN} FROM ({_SITE_DAY}) GROUP BY 1,2")
def _(spark, sf):
    return P.monthly_patterns(D.pm25_daily(feed(spark, sf, "fx_site_pm25"), ("site_id",)), keys=("site_id",))


_SEASON = "CASE WHEN month(date) IN (12,1,2) THEN 'Winter' WHEN month(date)<=5 THEN 'Spring' WHEN month(date)<=8 THEN 'Summer' ELSE 'Fall' END"


@query("seasonal_means", "season:s pm25_mean:e", f"SELECT {_SEASON} AS season, avg(pm25) AS pm25_mean FROM pm25_all GROUP BY 1")
def _(spark, sf):
    return P.seasonal_means(_pm25(spark, sf))


@query("peak_safest_month", "peak_month:i peak_month_name:s peak_days:i safest_month:i safest_month_name:s safest_days:i",
       f"SELECT a.month AS peak_month, a.month_name AS peak_month_name, a.high_pollution_days AS peak_days, b.month AS safest_month, "
       f"b.month_name AS safest_month_name, b.high_pollution_days AS safest_days FROM "
       f"(SELECT * FROM ({_MONTHLY}) ORDER BY high_pollution_days DESC, month LIMIT 1) a, "
       f"(SELECT * FROM ({_MONTHLY}) ORDER BY high_pollution_days, month LIMIT 1) b")
def _(spark, sf):
    return P.peak_and_safest(P.monthly_patterns(_pm25(spark, sf)))


@query("peak_year", "peak_year:i peak_year_days:i",
       f"SELECT year AS peak_year, high_pollution_days AS peak_year_days FROM ({_YEARLY}) ORDER BY high_pollution_days DESC, year LIMIT 1")
def _(spark, sf):
    return P.peak_year(P.yearly_patterns(_pm25(spark, sf)))


@query("trend_label", "first_year:i last_year:i first_events:i last_events:i trend:s",
       f"SELECT a.year AS first_year, b.year AS last_year, a.high_pollution_days AS first_events, b.high_pollution_days AS last_events, "
       f"CASE WHEN b.high_pollution_days<a.high_pollution_days THEN 'DECREASING' WHEN b.high_pollution_days>a.high_pollution_days THEN 'INCREASING' "
       f"ELSE 'STABLE' END AS trend FROM (SELECT * FROM ({_YEARLY}) ORDER BY year LIMIT 1) a, (SELECT * FROM ({_YEARLY}) ORDER BY year DESC LIMIT 1) b")
def _(spark, sf):
    return P.trend_label(P.yearly_patterns(_pm25(spark, sf)))


@query("month_year_heatmap", "month:i " + " ".join(f"{y}:e" for y in range(1995, 2002)),
       "SELECT month(date) AS month, " + ", ".join(f'avg(pm25) FILTER (WHERE year(date)={y}) AS "{y}"' for y in range(1995, 2002)) + " FROM pm25_all GROUP BY 1")
def _(spark, sf):
    return P.month_year_grid(_pm25(spark, sf))


@query("rolling_30d", "date:t pm25:e pm25_mean_30d:e",
       "SELECT date, pm25, avg(pm25) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS pm25_mean_30d FROM pm25_all")
def _(spark, sf):
    return P.rolling_mean(_pm25(spark, sf))


@query("rolling_30d_hourly", "site_id:i valid_time:s u10:e u10_mean:e",
       "SELECT site_id, valid_time, u10, avg(u10) OVER (PARTITION BY site_id ORDER BY CAST(valid_time AS TIMESTAMP) "
       "RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS u10_mean FROM fx_site_era5")
def _(spark, sf):
    hourly = feed(spark, sf, "fx_site_era5").withColumn("at", F.to_timestamp("valid_time", "yyyy-MM-dd HH:mm"))
    return P.rolling_mean_by_time(hourly, "u10", "at", 30 * 86_400, keys=("site_id",))


def _ruled(spark, sf):
    low_visibility = (F.col("wx_visibility_mean_km") < 8).cast("int")
    return ready_table(spark, sf).select("date", "pm25", exceeds(F.col("pm25")).alias("y"), low_visibility.alias("y_pred"))


_HITS = "avg(CASE WHEN y=y_pred THEN 1e0 ELSE 0e0 END) AS accuracy, sum(y) AS actual_events, sum(y_pred) AS predicted_events"


@query("accuracy_by_month", "month:i accuracy:e actual_events:i predicted_events:i", f"SELECT month(date) AS month, {_HITS} FROM ruled GROUP BY 1")
def _(spark, sf):
    return P.accuracy_by(_ruled(spark, sf), "month")


@query("accuracy_by_year", "year:i accuracy:e actual_events:i predicted_events:i", f"SELECT year(date) AS year, {_HITS} FROM ruled GROUP BY 1")
def _(spark, sf):
    return P.accuracy_by(_ruled(spark, sf), "year")


_OVERALL = ("count(*) AS total_days, min(date) AS first_date, max(date) AS last_date, CAST(max(date)-min(date) AS BIGINT) AS duration_days, "
            "count(*) FILTER (WHERE pm25>=25e0) AS high_days, 1e2*count(*) FILTER (WHERE pm25>=25e0)/count(*) AS high_pct, "
            "avg(pm25) FILTER (WHERE pm25>=25e0) AS high_mean, max(pm25) AS pm25_max, min(pm25) AS pm25_min, "
            "count(*) FILTER (WHERE y=y_pred) AS correct_days, CAST(count(*) FILTER (WHERE y=y_pred) AS DOUBLE)/count(*) AS accuracy FROM ruled")


@query("overall_summary", "total_days:i first_date:t last_date:t duration_days:i high_days:i high_pct:e high_mean:e pm25_max:e pm25_min:e correct_days:i accuracy:e",
       f"SELECT {_OVERALL}")
def _(spark, sf):
    return P.overall_summary(_ruled(spark, sf))


def _report_sql():
    m = _MONTHLY.replace("pm25_all", "ruled")
    y = _YEARLY.replace("pm25_all", "ruled")
    top = f"(SELECT * FROM ({m}) ORDER BY high_pollution_days DESC, month LIMIT 1)"
    low = f"(SELECT * FROM ({m}) ORDER BY high_pollution_days, month LIMIT 1)"
    best = f"(SELECT * FROM ({y}) ORDER BY high_pollution_days DESC, year LIMIT 1)"
    first = f"(SELECT high_pollution_days FROM ({y}) ORDER BY year LIMIT 1)"
    last = f"(SELECT high_pollution_days FROM ({y}) ORDER BY year DESC LIMIT 1)"
    f2 = "printf('%.2f', {})"
    o = f"(SELECT {_OVERALL})"
    rows = [f"SELECT '{i}' AS item, CAST({i} AS VARCHAR) AS value FROM {o}" for i in ("total_days", "first_date", "last_date", "duration_days", "high_days", "correct_days")]
    rows += [f"SELECT '{i}', {f2.format(i)} FROM {o}" for i in ("high_pct", "high_mean", "pm25_max", "pm25_min")]
    rows.append(f"SELECT 'accuracy_pct', {f2.format('1e2*accuracy')} FROM {o}")
    rows += [f"SELECT 'peak_month_name', month_name FROM {top}", f"SELECT 'peak_days', CAST(high_pollution_days AS VARCHAR) FROM {top}",
             f"SELECT 'safest_month_name', month_name FROM {low}", f"SELECT 'safest_days', CAST(high_pollution_days AS VARCHAR) FROM {low}",
             f"SELECT 'peak_year', CAST(year AS VARCHAR) FROM {best}", f"SELECT 'peak_year_days', CAST(high_pollution_days AS VARCHAR) FROM {best}",
             f"SELECT 'first_events', CAST({first} AS VARCHAR)", f"SELECT 'last_events', CAST({last} AS VARCHAR)",
             f"SELECT 'trend', CASE WHEN {last}<{first} THEN 'DECREASING' WHEN {last}>{first} THEN 'INCREASING' ELSE 'STABLE' END",
             f"SELECT lower({_SEASON})||'_avg', printf('%.2f', avg(pm25)) FROM ruled GROUP BY 1"]
    return " UNION ALL ".join(f"({r})" for r in rows)


@query("pattern_report", "item:s value:s", _report_sql())
def _(spark, sf):
    return pattern_report(_ruled(spark, sf))


_FORECAST = ("SELECT date + INTERVAL 1 YEAR AS date, wx_visibility_mean_km/1e2 AS smoke_prob, "
             "CASE WHEN wx_visibility_mean_km>=30e0 THEN 1 ELSE 0 END AS smoke_impact_pred, pm25 AS pred_pm25 FROM ready")


@query("forecast_monthly", "month:s mean_pred_pm25:e mean_smoke_prob:e smoke_days:i",
       f"SELECT strftime(date,'%Y-%m') AS month, avg(pred_pm25) AS mean_pred_pm25, avg(smoke_prob) AS mean_smoke_prob, sum(smoke_impact_pred) AS smoke_days "
       f"FROM ({_FORECAST}) GROUP BY 1")
def _(spark, sf):
    vis = F.col("wx_visibility_mean_km")
    days = ready_table(spark, sf).select(
        F.add_months("date", 12).alias("date"), (vis / 100.0).alias("smoke_prob"),
        (vis >= 30).cast("int").alias("smoke_impact_pred"), F.col("pm25").alias("pred_pm25"),
    )
    return P.forecast_monthly(days)


# ---- events ----


def _high(spark, sf):
    return P.high_days(ready_table(spark, sf))


@query("event_number", "date:t pm25:e event_number:i", "SELECT date, pm25, row_number() OVER (ORDER BY date) AS event_number FROM high")
def _(spark, sf):
    return E.number_events(_high(spark, sf))


@query("events_with_calendar", "date:t pm25:e year:i month:i month_name:s week:i day_of_year:i quarter:i",
       "SELECT date, pm25, year(date) AS year, month(date) AS month, strftime(date,'%b') AS month_name, weekofyear(date) AS week, "
       "dayofyear(date) AS day_of_year, quarter(date) AS quarter FROM high")
def _(spark, sf):
    return _high(spark, sf).withColumns(calendar_parts(F.col("date")))


@query("top_events", "event_rank:i date:t pm25:e", "SELECT * FROM top2")
def _(spark, sf):
    return E.top_events(_high(spark, sf))


@query("top_events_per_site", "site_id:i event_rank:i date:t pm25:e",
       f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY pm25 DESC, date) AS event_rank FROM ({_SITE_DAY})) WHERE event_rank<=2")
def _(spark, sf):
    return E.top_events(D.pm25_daily(feed(spark, sf, "fx_site_pm25"), ("site_id",)), keys=("site_id",))


_TIME = "pm25:e era5_wind_speed_mean_ms:e era5_wind_from_deg:e fire_count:e upwind_fire_count:e"


@query("timeline_overlay", f"date:t {_TIME}", "SELECT * FROM timeline")
def _(spark, sf):
    return E.timeline(_high(spark, sf))


def _windows(spark, sf):
    high = _high(spark, sf)
    return E.event_windows(E.top_events(high), E.timeline(high))


@query("event_windows", f"event_rank:i event_date:t date:t {_TIME}", "SELECT * FROM windows")
def _(spark, sf):
    return _windows(spark, sf)


@query("event_windows_all", f"event_number:i event_date:t date:t {_TIME}",
       "SELECT h.event_number, h.date AS event_date, l.* FROM (SELECT date, row_number() OVER (ORDER BY date) AS event_number FROM high) h "
       "JOIN timeline l ON l.date BETWEEN h.date - INTERVAL 3 DAY AND h.date + INTERVAL 4 DAY")
def _(spark, sf):
    high = _high(spark, sf)
    return E.event_windows(E.number_events(high), E.timeline(high), id_column="event_number")


@query("event_day_number", "event_rank:i date:t day_num:i", "SELECT * FROM frames")
def _(spark, sf):
    return E.number_days(_windows(spark, sf))


@query("peak_day_flag", "event_rank:i date:t peak_pm25:e is_peak:b", "SELECT * FROM frames")
def _(spark, sf):
    return E.number_days(_windows(spark, sf))


@query("playback_7day", "event_number:i event_date:t date:t day_offset:i pm25:e",
       "SELECT h.event_number, h.date AS event_date, r.date, CAST(r.date-h.date AS BIGINT) AS day_offset, r.pm25 FROM "
       "(SELECT date, row_number() OVER (ORDER BY date) AS event_number FROM high) h JOIN ready r ON r.date BETWEEN h.date AND h.date + INTERVAL 6 DAY")
def _(spark, sf):
    return E.playback(_high(spark, sf), ready_table(spark, sf).select("date", F.col("pm25")))


_FRAME = ("event_rank:i date:s day_num:i pm25:e wind_speed:e wind_direction:e is_peak:b major_axis:e minor_axis:e direction:e "
          "color:s wind_color:s fire:s")


# texts round half up, as the formatter does
_NAMED = ("SELECT f.*, printf('Event #%d - PM2.5 Peak: %.1f ug/m3', CAST(f.event_rank AS INTEGER), round(t.pm25, 1)) AS event_name, "
          "printf('Wind: %.2f m/s from %.0f°', round(f.wind_speed, 2), round(f.wind_direction, 0)) AS wind_popup FROM frames f JOIN top2 t USING (event_rank)")


@query("event_day_frames", f"{_FRAME} event_date:t peak_pm25:e wind_weight:i event_name:s wind_popup:s", _NAMED)
def _(spark, sf):
    return E.day_frames(_windows(spark, sf))


@query("event_frames_json", _FRAME, "SELECT * FROM frames")
def _(spark, sf):
    frames = E.day_frames(_windows(spark, sf))
    packed = E.frames_json(frames)
    fields = StructType([frames.schema[f] for f in E.FRAME_FIELDS])
    opened = packed.select("event_rank", F.explode(F.from_json("frames", f"array<{fields.simpleString()}>")).alias("f"))
    return opened.select("event_rank", "f.*")


# ---- profile of the written tables ----

_CLEAN = {"pm25_daily": "pm25_day", "weather_daily": "weather_day", "era5_daily": "era5_day", "fire_daily": "fire_full", "master_daily": "master", "model_ready": "ready_split"}
_COLUMNS = {"pm25_daily": ["date", "pm25", "pm25_station_count"], "master_daily": ["date", "pm25", *FEATURES], "model_ready": ["date", "pm25", *FEATURES, "split"],
            "fire_daily": ["date", *FIRE], "weather_daily": ["date", *FEATURES[1:15]], "era5_daily": ["date", *FEATURES[15:25]]}


def _written(spark, sf):
    """The folder of all tables of the pipeline, written once for a state of the source files."""
    return kept_folder(spark, sf, "tables", lambda to: run_pipeline(feeds(spark, sf), OPTIONS, to))


@query("cleaned_report", "dataset:s rows:i columns:i missing_cells:i", " UNION ALL ".join(
    f"(SELECT '{n}' AS dataset, count(*) AS rows, {len(_COLUMNS[n])} AS columns, " + "+".join(f"count(*)-count({c})" for c in _COLUMNS[n]) + f" AS missing_cells FROM {src})"
    for n, src in _CLEAN.items()))
def _(spark, sf):
    root = _written(spark, sf)
    return dataset_profile({n: read_table(spark, f"{root}/{n}") for n in _CLEAN})


@query("sorted_outputs", "dataset:s rows:i out_of_order:i", " UNION ALL ".join(f"(SELECT '{n}' AS dataset, count(*) AS rows, 0 AS out_of_order FROM {src})" for n, src in _CLEAN.items()))
def _(spark, sf):
    """Rows of the written tables that stand before an earlier day in their file."""
    root, out = _written(spark, sf), None
    for name in _CLEAN:
        rows = read_table(spark, f"{root}/{name}").select("date", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
        late = rows.withColumn("late", F.lag("date").over(W.partitionBy("file").orderBy("at")) > F.col("date"))
        part = late.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("out_of_order"))
        out = part if out is None else out.unionByName(part)
    return out


@query("reload_splits", "split:s rows:i first:t last:t pm25:e", "SELECT split, count(*) AS rows, min(date) AS first, max(date) AS last, sum(pm25) AS pm25 FROM ready_split GROUP BY 1")
def _(spark, sf):
    out = None
    for name, part in zip(SPLITS, reload_splits(spark, _written(spark, sf))):
        row = part.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("rows"), F.min("date").alias("first"), F.max("date").alias("last"), F.sum("pm25").alias("pm25"))
        out = row if out is None else out.unionByName(row)
    return out


@query("preview", "date:t pm25:e", "SELECT date, pm25 FROM pm25_day ORDER BY date LIMIT 5")
def _(spark, sf):
    return preview(read_table(spark, f"{_written(spark, sf)}/pm25_daily"))


@query("event_frames_file", _FRAME, "SELECT * FROM frames")
def _(spark, sf):
    """The frames, written as JSON lines and read again."""
    frames, path = E.day_frames(_windows(spark, sf)), new_path(spark, "frames")
    write_json(E.frames_json(frames), path)
    fields = StructType([frames.schema[f] for f in E.FRAME_FIELDS])
    packed = spark.read.schema("event_rank long, frames string").json(path)
    opened = packed.select("event_rank", F.explode(F.from_json("frames", f"array<{fields.simpleString()}>")).alias("f"))
    return opened.select("event_rank", "f.*")


@query("dataset_profile", "dataset:s rows:i columns:i missing_cells:i", " UNION ALL ".join(
    f"(SELECT '{n}' AS dataset, count(*) AS rows, {len(cols)} AS columns, " + "+".join(f"count(*)-count({c})" for c in cols) + f" AS missing_cells FROM {n})"
    for n, cols in {
        "fx_pm25": ["date", "value", "location_name"],
        "fx_fire": ["latitude", "longitude", "acq_date", "acq_time", "frp"],
        "fx_weather": ["date_time_lst", "temp_c", "precip_amount_mm"],
    }.items()).replace("3 AS columns, count(*)-count(date_time_lst)", "8 AS columns, count(*)-count(date_time_lst)"))
def _(spark, sf):
    return dataset_profile({n: feed(spark, sf, n) for n in ("fx_pm25", "fx_fire", "fx_weather")})
