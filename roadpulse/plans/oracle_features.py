"""Oracle SQL for the feature-stage queries (plain SQL windows and joins)."""

from __future__ import annotations

from ..functions import constants as K
from .oracle import ORACLE, with_inc

_DAY = 86_400_000_000
_HOUR = 3_600_000_000


def _in(xs) -> str:
    return "(" + ", ".join(str(x) for x in xs) + ")"


_PEAK = K.MORNING_PEAK_HOURS + K.EVENING_PEAK_HOURS

FEAT = f"""
t0 AS (
  SELECT *,
    CAST(coalesce(hour(start_datetime), 0) AS INTEGER) AS hour,
    CAST(coalesce(minute(start_datetime), 0) AS INTEGER) AS minute,
    CAST(coalesce(day(start_datetime), 1) AS INTEGER) AS day,
    CAST(coalesce(isodow(start_datetime) - 1, 0) AS INTEGER) AS weekday,
    CAST(coalesce(month(start_datetime), 1) AS INTEGER) AS month,
    CAST(coalesce(weekofyear(start_datetime), 1) AS INTEGER) AS week_of_year
  FROM inc
),
t1 AS (
  SELECT *,
    CAST(weekday >= 5 AS INTEGER) AS is_weekend,
    CAST(hour IN {_in(_PEAK)} AS INTEGER) AS is_peak,
    CAST(hour IN {_in(K.NIGHT_HOURS)} AS INTEGER) AS is_night,
    CAST(hour IN {_in(K.MORNING_PEAK_HOURS)} AS INTEGER) AS is_morning_peak,
    CAST(hour IN {_in(K.EVENING_PEAK_HOURS)} AS INTEGER) AS is_evening_peak,
    hour * 3600 + minute * 60 AS time_since_midnight,
    sin(2 * pi() * hour / 24.0) AS hour_sin, cos(2 * pi() * hour / 24.0) AS hour_cos,
    sin(2 * pi() * weekday / 7.0) AS weekday_sin, cos(2 * pi() * weekday / 7.0) AS weekday_cos,
    sin(2 * pi() * month / 12.0) AS month_sin, cos(2 * pi() * month / 12.0) AS month_cos
  FROM t0
),
s0 AS (
  SELECT *,
    2 * 6371.0 * asin(sqrt(pow(sin((radians(latitude) - radians(12.9716)) / 2), 2)
      + cos(radians(latitude)) * cos(radians(12.9716)) * pow(sin((radians(longitude) - radians(77.5946)) / 2), 2))) AS dist_from_center_km,
    coalesce(CAST(floor((latitude - 12.0) / 0.05) * 1000 + floor((longitude - 77.0) / 0.05) AS INTEGER), -1) AS spatial_cluster
  FROM t1
),
s1 AS (
  SELECT *, count(*) OVER (PARTITION BY spatial_cluster) AS cluster_density,
    CAST(coalesce(junction, 'None') <> 'None' AS INTEGER) AS has_junction
  FROM s0
),
e0 AS (
  SELECT *,
    CAST(dense_rank() OVER (ORDER BY coalesce(zone, 'Unknown')) - 1 AS INTEGER) AS zone_enc,
    CAST(dense_rank() OVER (ORDER BY coalesce(police_station, 'Unknown')) - 1 AS INTEGER) AS police_station_enc,
    CAST(dense_rank() OVER (ORDER BY coalesce(corridor, 'Unknown')) - 1 AS INTEGER) AS corridor_enc,
    CAST(dense_rank() OVER (ORDER BY coalesce(event_cause, 'Unknown')) - 1 AS INTEGER) AS event_cause_enc,
    CAST(dense_rank() OVER (ORDER BY coalesce(veh_type, 'Unknown')) - 1 AS INTEGER) AS veh_type_enc,
    CAST(coalesce(event_type = 'unplanned', false) AS INTEGER) AS event_type_enc,
    CAST(coalesce(priority, 'Low') = 'High' AS INTEGER) AS priority_enc,
    CAST(coalesce(requires_road_closure, false) AS INTEGER) AS road_closure_enc,
    CAST(coalesce(veh_no, 'Unknown') <> 'Unknown' AS INTEGER) AS has_veh_no,
    CAST(lower(coalesce(authenticated, 'false')) = 'true' AS INTEGER) AS authenticated_enc,
    count(*) OVER (PARTITION BY corridor) / count(*) OVER () AS corridor_freq
  FROM s1
),
te AS (SELECT event_cause AS te_key, avg(congestion_severity) AS te FROM inc WHERE event_cause IS NOT NULL GROUP BY event_cause),
e1 AS (
  SELECT e0.*, coalesce(te.te, (SELECT avg(te) FROM te)) AS cause_target_enc
  FROM e0 LEFT JOIN te ON e0.event_cause = te.te_key
),
h0 AS (SELECT *, epoch_us(start_datetime) AS tus FROM e1),
hw AS (
  SELECT incident_id AS hw_id, zone AS hw_zone,
    CAST(count(*) OVER (PARTITION BY zone ORDER BY tus RANGE BETWEEN {1 * _DAY - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) AS w1,
    CAST(count(*) OVER (PARTITION BY zone ORDER BY tus RANGE BETWEEN {7 * _DAY - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) AS w7,
    CAST(count(*) OVER (PARTITION BY zone ORDER BY tus RANGE BETWEEN {30 * _DAY - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) AS w30
  FROM h0 WHERE tus IS NOT NULL
),
hz AS (SELECT hw_zone AS hz_zone, avg(w1) AS m1, avg(w7) AS m7, avg(w30) AS m30 FROM hw GROUP BY hw_zone),
h2 AS (
  SELECT h0.*,
    CASE WHEN h0.tus IS NULL THEN coalesce(hz.m1, 0.0) ELSE hw.w1 END AS zone_events_1d,
    CASE WHEN h0.tus IS NULL THEN coalesce(hz.m7, 0.0) ELSE hw.w7 END AS zone_events_7d,
    CASE WHEN h0.tus IS NULL THEN coalesce(hz.m30, 0.0) ELSE hw.w30 END AS zone_events_30d
  FROM h0 LEFT JOIN hw ON h0.incident_id = hw.hw_id LEFT JOIN hz ON h0.zone = hz.hz_zone
),
h3 AS (
  SELECT *,
    coalesce(CAST(lag(congestion_severity) OVER (PARTITION BY zone ORDER BY start_datetime ASC NULLS LAST, incident_id ASC) AS DOUBLE),
             (SELECT CAST(quantile_cont(congestion_severity, 0.5) AS DOUBLE) FROM inc)) AS prev_severity_zone,
    avg(congestion_severity) OVER (PARTITION BY zone) AS zone_mean_severity,
    CASE WHEN event_cause IS NOT NULL THEN avg(duration_min) OVER (PARTITION BY event_cause, zone) END AS cause_zone_avg_dur,
    avg(duration_min) OVER (PARTITION BY police_station) AS station_avg_dur
  FROM h2
),
x0 AS (
  SELECT *,
    event_cause_enc * is_peak AS cause_x_peak,
    event_cause_enc * is_weekend AS cause_x_weekend,
    zone_enc * priority_enc AS zone_x_priority,
    dist_from_center_km * priority_enc AS dist_x_priority,
    spatial_cluster * event_cause_enc AS cluster_x_cause,
    hour * event_type_enc AS hour_x_event_type,
    road_closure_enc * priority_enc AS closure_x_priority,
    congestion_severity * cluster_density AS sev_x_cluster
  FROM h3
)"""

_NULLABLE = [
    "latitude", "longitude", "dist_from_center_km", "dist_x_priority", "cause_zone_avg_dur",
    "station_avg_dur", "zone_mean_severity", "cause_target_enc",
]
_DOUBLES = {
    "hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "month_sin", "month_cos", "latitude", "longitude",
    "dist_from_center_km", "corridor_freq", "cause_target_enc", "zone_events_1d", "zone_events_7d", "zone_events_30d",
    "prev_severity_zone", "zone_mean_severity", "cause_zone_avg_dur", "station_avg_dur", "dist_x_priority", "duration_min",
}


def _final_col(c: str, digits: int = 6) -> str:
    e = f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM x0))" if c in _NULLABLE else c
    return f"round({e}, {digits}) AS {c}" if c in _DOUBLES else f"{e} AS {c}"


def _feat(body: str) -> str:
    return with_inc(body, extra=FEAT)


ORACLE["feature_matrix"] = _feat(
    "SELECT incident_id, " + ", ".join(_final_col(c) for c in K.FEATURE_COLUMNS + K.TARGET_COLUMNS) + " FROM x0"
)

ORACLE["interaction_features"] = _feat(
    "SELECT incident_id, " + ", ".join(_final_col(c) for c in K.FEATURE_COLUMNS if "_x_" in c) + " FROM x0"
)

ORACLE["time_features"] = _feat(
    "SELECT incident_id, "
    + ", ".join(f"round({c}, 9) AS {c}" if c in _DOUBLES else c for c in K.FEATURE_COLUMNS[:18])
    + " FROM t1"
)

ORACLE["spatial_features"] = _feat(
    "SELECT incident_id, round(dist_from_center_km, 6) AS dist_from_center_km, spatial_cluster, cluster_density, has_junction FROM s1"
)

ORACLE["encoded_categoricals"] = _feat(
    "SELECT incident_id, zone_enc, police_station_enc, corridor_enc, event_cause_enc, veh_type_enc, event_type_enc, "
    "priority_enc, road_closure_enc, has_veh_no, authenticated_enc, round(corridor_freq, 9) AS corridor_freq, "
    "round(cause_target_enc, 9) AS cause_target_enc FROM e1"
)

ORACLE["zone_event_windows"] = _feat(
    "SELECT incident_id, round(zone_events_1d, 6) AS zone_events_1d, round(zone_events_7d, 6) AS zone_events_7d, "
    "round(zone_events_30d, 6) AS zone_events_30d FROM h2"
)

ORACLE["prev_severity_zone"] = _feat("SELECT incident_id, round(prev_severity_zone, 6) AS prev_severity_zone FROM h3")

ORACLE["zone_group_means"] = _feat(
    "SELECT incident_id, round(zone_mean_severity, 6) AS zone_mean_severity, round(cause_zone_avg_dur, 6) AS cause_zone_avg_dur, "
    "round(station_avg_dur, 6) AS station_avg_dur FROM h3"
)

B2 = """
b2 AS (
  SELECT event_id AS incident_id, ts AS start_datetime, event_type AS event_cause,
    'Z' || CAST(user_id % 10 AS VARCHAR) AS zone, value AS duration_min,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 THEN 'High' ELSE 'Low' END AS priority,
    CAST(least(3, floor(CAST(json_extract_string(props, '$.k') AS INTEGER) / 25)) AS INTEGER) AS congestion_severity
  FROM events
)"""


def with_b2(body: str, extra: str = "") -> str:
    return "WITH " + B2 + ("," + extra if extra else "") + "\n" + body


ORACLE["event_zone_windows"] = with_b2(f"""
SELECT incident_id,
  CAST(count(*) OVER (PARTITION BY zone ORDER BY epoch_us(start_datetime) RANGE BETWEEN {_HOUR - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) AS zone_events_1h,
  CAST(count(*) OVER (PARTITION BY zone ORDER BY epoch_us(start_datetime) RANGE BETWEEN {_DAY - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) AS zone_events_1d,
  CAST(count(*) OVER (PARTITION BY zone ORDER BY epoch_us(start_datetime) RANGE BETWEEN {7 * _DAY - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) AS zone_events_7d
FROM b2 WHERE start_datetime IS NOT NULL
""")

ORACLE["event_prev_severity"] = with_b2("""
SELECT incident_id,
  CAST(lag(congestion_severity) OVER (PARTITION BY zone ORDER BY start_datetime ASC NULLS LAST, incident_id ASC) AS DOUBLE) AS prev_severity
FROM b2
""")

ORACLE["prior_zone_severity"] = with_b2("""
SELECT incident_id,
  round(avg(congestion_severity) OVER (PARTITION BY zone ORDER BY start_datetime ASC NULLS LAST, incident_id ASC
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS prior_zone_severity
FROM b2
""")
