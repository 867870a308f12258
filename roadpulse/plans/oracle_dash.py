"""Oracle SQL for the source, cleaning, dashboard and profiling queries."""

from __future__ import annotations

from .oracle import B1, ORACLE, with_inc

TS = "'%Y-%m-%d %H:%M:%S.%f'"


def ts(c: str) -> str:
    return f"strftime({c}, {TS}) AS {c}"


RAW = "WITH " + B1 + "\n"

ORACLE["incidents_raw"] = RAW + f"""
SELECT * REPLACE ({ts('start_datetime')}, {ts('end_datetime')}, {ts('closed_datetime')}, {ts('resolved_datetime')})
FROM b1
"""

ORACLE["incidents_labelled"] = with_inc(f"""
SELECT * REPLACE ({ts('start_datetime')}, {ts('end_datetime')}, {ts('closed_datetime')}, {ts('resolved_datetime')})
FROM inc
""")

SERVING = """
SELECT incident_id, start_datetime, event_cause, event_type, priority, zone, police_station,
       requires_road_closure, latitude, longitude, congestion_severity, duration_min,
       manpower_req, barricade_req, diversion_req, coalesce(status, 'closed') AS status
FROM inc"""

ORACLE["serving_events"] = with_inc(f"SELECT * REPLACE ({ts('start_datetime')}) FROM ({SERVING})")

ORACLE["kpis"] = with_inc("""
SELECT count(*) AS total_events,
  CASE WHEN count(*) > 0 THEN round_even(coalesce(avg(congestion_severity), 0.0), 2) END AS avg_severity,
  CASE WHEN count(*) > 0 THEN round_even(coalesce(quantile_cont(duration_min, 0.5), 0.0), 0) END AS median_duration,
  CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE congestion_severity = 3) END AS severe_events,
  CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE requires_road_closure) END AS road_closures,
  CASE WHEN count(*) > 0 THEN round_even(CAST(count(*) FILTER (WHERE status = 'closed') AS DOUBLE) * 100.0 / count(*), 1) END AS closed_pct
FROM inc
""")

ORACLE["cause_counts"] = with_inc("""
SELECT event_cause AS cause, count(*) AS count FROM inc
GROUP BY event_cause ORDER BY count DESC, cause ASC NULLS LAST LIMIT 14
""")

ORACLE["duration_histogram"] = with_inc("""
SELECT CAST(least(floor(duration_min / 30) * 30, 1440) AS BIGINT) AS duration, count(*) AS count
FROM inc WHERE duration_min IS NOT NULL GROUP BY 1
""")

ORACLE["history_page"] = with_inc(f"""
SELECT * REPLACE ({ts('start_datetime')}) FROM ({SERVING})
ORDER BY start_datetime DESC NULLS LAST, incident_id ASC LIMIT 500 OFFSET 100
""")

ORACLE["map_points"] = with_inc("""
SELECT incident_id, latitude AS lat, longitude AS lon, congestion_severity AS severity, event_cause AS cause, zone,
  CASE congestion_severity WHEN 0 THEN 'green' WHEN 1 THEN 'yellow' WHEN 2 THEN 'orange' WHEN 3 THEN 'red' ELSE 'grey' END AS colour
FROM inc WHERE latitude IS NOT NULL
ORDER BY start_datetime DESC NULLS LAST, incident_id ASC LIMIT 1000
""")

ORACLE["class_distribution"] = with_inc("""
SELECT target, class, count(*) AS count FROM (
  SELECT 'congestion_severity' AS target, congestion_severity AS class FROM inc
  UNION ALL SELECT 'manpower_req', manpower_req FROM inc
  UNION ALL SELECT 'barricade_req', barricade_req FROM inc
  UNION ALL SELECT 'diversion_req', diversion_req FROM inc
) GROUP BY target, class
""")

ORACLE["interpolated_classes"] = with_inc("""
SELECT congestion_severity AS label, count(*) AS rows_before, max(count(*)) OVER () AS rows_after, 0::bigint AS outside
FROM inc WHERE congestion_severity IS NOT NULL GROUP BY congestion_severity
""")

_SEV_COUNTS = ", ".join(f"count(*) FILTER (WHERE congestion_severity = {i}) AS sev_{i}" for i in range(4))

ORACLE["cause_severity_crosstab"] = with_inc(f"SELECT event_cause, {_SEV_COUNTS} FROM inc GROUP BY event_cause")

ORACLE["hour_severity_crosstab"] = with_inc(
    f"SELECT CAST(coalesce(hour(start_datetime), 0) AS INTEGER) AS hour, {_SEV_COUNTS} FROM inc GROUP BY 1"
)

ORACLE["cause_median_duration"] = with_inc("""
SELECT event_cause, quantile_cont(duration_min, 0.5) AS median_duration
FROM inc WHERE event_cause IS NOT NULL AND duration_min IS NOT NULL GROUP BY event_cause
""")

ORACLE["zone_stats"] = with_inc("""
SELECT zone, round(avg(congestion_severity), 6) AS mean, count(*) AS count FROM inc GROUP BY zone
""")

_RAW_COLS = [
    "incident_id", "start_datetime", "end_datetime", "closed_datetime", "resolved_datetime", "event_cause",
    "event_type", "priority", "requires_road_closure", "zone", "police_station", "corridor", "status",
    "latitude", "longitude", "veh_type", "veh_no", "reason_breakdown", "kgid", "authenticated", "junction",
]
_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS total FROM b1" for c in _RAW_COLS
)
ORACLE["missing_report"] = RAW + f"""
SELECT "column", missing, round_even(CAST(missing AS DOUBLE) * 100.0 / total, 2) AS pct
FROM ({_MISSING}) WHERE missing > 0
"""


def _describe_num(c: str) -> str:
    return f"""SELECT '{c}' AS column, count({c}) AS count, CAST(NULL AS DOUBLE) AS unique, CAST(NULL AS VARCHAR) AS top,
  CAST(NULL AS DOUBLE) AS freq, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
  round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
  round(CAST(max({c}) AS DOUBLE), 6) AS max FROM inc"""


def _describe_cat(c: str) -> str:
    return f"""SELECT '{c}' AS column, count({c}) AS count, CAST(count(DISTINCT {c}) AS DOUBLE) AS unique,
  (SELECT {c} FROM inc WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1) AS top,
  CAST((SELECT count(*) FROM inc WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1) AS DOUBLE) AS freq,
  CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS q25,
  CAST(NULL AS DOUBLE) AS q50, CAST(NULL AS DOUBLE) AS q75, CAST(NULL AS DOUBLE) AS max FROM inc"""


ORACLE["describe_incidents"] = with_inc(
    " UNION ALL ".join(
        [_describe_num(c) for c in ("duration_min", "congestion_severity", "latitude", "longitude")]
        + [_describe_cat(c) for c in ("event_cause", "zone", "corridor", "priority")]
    )
)

_CORR_COLS = ["duration_min", "congestion_severity", "manpower_req", "barricade_req", "diversion_req", "latitude", "longitude"]
_CORR = " UNION ALL ".join(
    f"""SELECT '{a}' AS col_a, '{b}' AS col_b,
      CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN round(corr({a}, {b}), 6) END AS corr FROM inc"""
    for i, a in enumerate(_CORR_COLS)
    for b in _CORR_COLS[i + 1 :]
)
ORACLE["correlation_matrix"] = with_inc(_CORR)

ORACLE["duration_bins"] = with_inc(
    """
SELECT bin, round(mn + w * bin / 50.0, 6) AS lower, count(*) AS count FROM (
  SELECT CAST(CASE WHEN mx - mn = 0 THEN 0 ELSE least(floor((duration_min - mn) / (mx - mn) * 50.0), 49) END AS INTEGER) AS bin,
         mn, mx - mn AS w
  FROM inc, mm WHERE duration_min IS NOT NULL
) GROUP BY bin, mn, w
""",
    extra="mm AS (SELECT CAST(min(duration_min) AS DOUBLE) AS mn, CAST(max(duration_min) AS DOUBLE) AS mx FROM inc)",
)

_NULL_MAP = ["closed_datetime", "resolved_datetime", "end_datetime", "event_cause", "priority", "zone", "latitude"]
ORACLE["null_map"] = RAW + "SELECT incident_id, " + ", ".join(
    f"CAST({c} IS NULL AS INTEGER) AS {c}_isnull" for c in _NULL_MAP
) + " FROM b1"

ORACLE["station_modal_corridor"] = with_inc(
    """
SELECT vc.police_station, min(vc.corridor) AS mode, vc.freq
FROM vc JOIN best ON vc.police_station = best.police_station AND vc.freq = best.freq
GROUP BY vc.police_station, vc.freq
""",
    extra="""vc AS (SELECT police_station, corridor, count(*) AS freq FROM inc WHERE corridor IS NOT NULL GROUP BY police_station, corridor),
best AS (SELECT police_station, max(freq) AS freq FROM vc GROUP BY police_station)""",
)

ORACLE["duration_quantiles"] = with_inc("""
SELECT priority, quantile_cont(duration_min, 0.01) AS p01, quantile_cont(duration_min, 0.5) AS p50,
       quantile_cont(duration_min, 0.99) AS p99
FROM inc WHERE duration_min IS NOT NULL GROUP BY priority
""")

ORACLE["table_counts"] = RAW + """
SELECT count(*) AS rows, count(event_cause) AS nonnull_event_cause, count(priority) AS nonnull_priority,
  count(zone) AS nonnull_zone, count(closed_datetime) AS nonnull_closed_datetime,
  count(DISTINCT zone) AS distinct_zone, count(DISTINCT event_cause) AS distinct_event_cause,
  count(DISTINCT police_station) AS distinct_police_station
FROM b1
"""

ORACLE["corridor_frequency"] = with_inc(
    "SELECT corridor, count(*) / (SELECT count(*) FROM inc) AS corridor_freq FROM inc GROUP BY corridor"
)
