"""Pollution events, their day windows and the frames drawn for each day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geo import CENTRE_LAT, CENTRE_LON, ellipse_polygon, wind_arrow
from ..functions.levels import dispersion, risk_colour, wind_colour, wind_weight
from ..functions.names import column_or
from .spine import spine_around

# What a timeline day shows when no event was recorded.
TIMELINE_DEFAULTS = {
    "pm25": 15.0,
    "era5_wind_speed_mean_ms": 2.5,
    "era5_wind_from_deg": 180.0,
    "fire_count": 0.0,
    "upwind_fire_count": 0.0,
}
# Stand-ins for a column the frame table does not have.
FRAME_DEFAULTS = {"era5_wind_speed_mean_ms": 2.5, "era5_wind_from_deg": 180.0, "fire_count": 0.0}


def number_events(events: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Chronological ``event_number`` per key (one row per day: bounded by the calendar)."""
    return events.withColumn("event_number", F.row_number().over(W.partitionBy(*keys).orderBy("date")))


def top_events(events: DataFrame, n: int = 2, keys: Sequence[str] = ()) -> DataFrame:
    """The ``n`` highest days as ``event_rank`` 1..n; the earlier day wins ties."""
    order = [F.desc_nulls_last("pm25"), F.asc("date")]
    if keys:
        ranked = events.withColumn("event_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        return ranked.filter(F.col("event_rank") <= n)
    best = events.filter(F.col("pm25").isNotNull()).orderBy(*order).limit(n)
    # at most n rows are left
    return best.withColumn("event_rank", F.row_number().over(W.orderBy(*order)))


def timeline(events: DataFrame, margin_days: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """Every day around the events with default values; an event day shows its own values, NULLs included."""
    days = spine_around(events, margin_days, margin_days, keys)
    shown = events.select(
        *keys, "date", F.lit(True).alias("_event"),
        *[column_or(events, c, 0.0).cast("double").alias(f"_e_{c}") for c in TIMELINE_DEFAULTS],
    )
    laid = days.join(shown, [*keys, "date"], "left")
    return laid.select(
        *keys, "date",
        *[F.when(F.col("_event"), F.col(f"_e_{c}")).otherwise(F.lit(v)).alias(c) for c, v in TIMELINE_DEFAULTS.items()],
    )


def event_windows(
    events: DataFrame, days: DataFrame, before: int = 3, after: int = 4, id_column: str = "event_rank",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Timeline rows from ``before`` days ahead of each event to ``after`` days past it.

    Written as an equi-join: each event is expanded to its few days. Overlapping
    windows repeat rows, once per event.
    """
    wanted = events.select(
        *keys, id_column, F.col("date").alias("event_date"), F.col("pm25").alias("event_pm25"),
        F.explode(F.sequence(F.date_sub("date", before), F.date_add("date", after), F.expr("interval 1 day"))).alias("date"),
    )
    return wanted.join(days, [*keys, "date"])


def playback(events: DataFrame, daily: DataFrame, days: int = 7, keys: Sequence[str] = ()) -> DataFrame:
    """For each event, numbered in time, its day and the following ones (``days`` in all)."""
    numbered = number_events(events, keys)
    shown = event_windows(numbered, daily, 0, days - 1, "event_number", keys)
    return shown.withColumn("day_offset", F.datediff("date", "event_date"))


def number_days(windows: DataFrame, id_column: str = "event_rank", keys: Sequence[str] = ()) -> DataFrame:
    """``day_num`` within each window, the window's ``peak_pm25`` and ``is_peak`` (earliest day of the maximum)."""
    group = W.partitionBy(*keys, id_column)
    best_first = group.orderBy(F.desc_nulls_last("pm25"), F.asc("date"))
    return windows.withColumns(
        {
            "day_num": F.row_number().over(group.orderBy("date")),
            "peak_pm25": F.max("pm25").over(group),
            "is_peak": F.row_number().over(best_first) == 1,
        }
    )


def day_frames(
    windows: DataFrame, id_column: str = "event_rank", keys: Sequence[str] = (), lat=CENTRE_LAT, lon=CENTRE_LON,
    geometry: bool = False, arrow_cap: float | None = None,
) -> DataFrame:
    """One drawable row per event day: axes, direction, colours, and optionally the shapes themselves."""
    numbered = number_days(windows, id_column, keys)
    speed = column_or(windows, "era5_wind_speed_mean_ms", FRAME_DEFAULTS["era5_wind_speed_mean_ms"])
    wind_from = column_or(windows, "era5_wind_from_deg", FRAME_DEFAULTS["era5_wind_from_deg"])
    fires = column_or(windows, "fire_count", FRAME_DEFAULTS["fire_count"])
    plume = dispersion(F.col("pm25"), speed, wind_from)
    frames = numbered.select(
        *keys, id_column, "event_date",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "day_num", "pm25", "peak_pm25",
        speed.alias("wind_speed"),
        wind_from.alias("wind_direction"),
        "is_peak",
        plume["major_axis"].alias("major_axis"),
        plume["minor_axis"].alias("minor_axis"),
        plume["direction"].alias("direction"),
        risk_colour(F.col("pm25")).alias("color"),
        wind_colour(speed).alias("wind_color"),
        wind_weight(speed).alias("wind_weight"),
        F.when(fires > 0, "Yes").otherwise("No").alias("fire"),
        F.format_string("Event #%d - PM2.5 Peak: %.1f ug/m3", F.col(id_column).cast("int"), F.col("event_pm25")).alias("event_name"),
        F.format_string("Wind: %.2f m/s from %.0f°", speed, wind_from).alias("wind_popup"),
    )
    if not geometry:
        return frames
    return frames.withColumns(
        {
            "ellipse": ellipse_polygon(lat, lon, F.col("major_axis"), F.col("minor_axis"), F.col("direction")),
            "arrow": wind_arrow(lat, lon, F.col("wind_direction"), F.col("wind_speed"), cap=arrow_cap),
        }
    )


FRAME_FIELDS = [
    "date", "day_num", "pm25", "wind_speed", "wind_direction", "is_peak", "major_axis", "minor_axis", "direction",
    "color", "wind_color", "fire",
]


def frames_json(frames: DataFrame, id_column: str = "event_rank", keys: Sequence[str] = ()) -> DataFrame:
    """One JSON array per event with its frames in day order (a window has only a few days)."""
    packed = F.sort_array(F.collect_list(F.struct("day_num", F.struct(*FRAME_FIELDS).alias("frame"))))
    return frames.groupBy(*keys, id_column).agg(F.to_json(F.transform(packed, lambda s: s["frame"])).alias("frames"))
