"""Oracle SQL for `catalog_more`."""

from __future__ import annotations

from .oracle import B1, ORACLE, with_inc
from .oracle_eval import B4, _cls, with_b3
from .oracle_features import with_b2
from . import oracle_streams  # noqa: F401  (the stream oracle is reused)

_DAY = 86_400_000_000
_UNTIMED = "ev AS (SELECT * REPLACE (CASE WHEN incident_id % 13 <> 0 THEN start_datetime END AS start_datetime) FROM b2)"

ORACLE["event_time_features"] = with_b2(f"""
SELECT incident_id, h AS hour, m AS minute, wd AS weekday, CAST(h IN (7, 8, 9, 10, 17, 18, 19, 20, 21) AS INTEGER) AS is_peak,
  CAST(h IN (22, 23, 0, 1, 2, 3, 4, 5) AS INTEGER) AS is_night, CAST(wd >= 5 AS INTEGER) AS is_weekend, h * 3600 + m * 60 AS time_since_midnight,
  round(sin(2 * pi() * h / 24.0), 6) AS hour_sin, round(cos(2 * pi() * h / 24.0), 6) AS hour_cos
FROM (WITH {_UNTIMED} SELECT incident_id, CAST(coalesce(hour(start_datetime), 0) AS INTEGER) AS h, CAST(coalesce(minute(start_datetime), 0) AS INTEGER) AS m,
  CAST(coalesce(isodow(start_datetime) - 1, 0) AS INTEGER) AS wd FROM ev)
""")

ORACLE["event_hour_crosstab"] = with_b2("""
SELECT CAST(hour(start_datetime) AS INTEGER) AS hour, """ + ", ".join(f"count(*) FILTER (WHERE congestion_severity = {k}) AS sev_{k}" for k in range(4)) + """
FROM b2 GROUP BY 1
""")

_COUNTS = ", ".join(
    f"CAST(count(*) OVER (PARTITION BY zone ORDER BY epoch_us(start_datetime) RANGE BETWEEN {n * _DAY - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) AS c{n}" for n in (1, 7)
)
ORACLE["event_untimed_windows"] = with_b2(f"""
, {_UNTIMED}, timed AS (SELECT incident_id, zone, {_COUNTS} FROM ev WHERE start_datetime IS NOT NULL),
means AS (SELECT zone, avg(c1) AS m1, avg(c7) AS m7 FROM timed GROUP BY zone)
SELECT ev.incident_id, round(CASE WHEN start_datetime IS NULL THEN coalesce(m1, 0) ELSE c1 END, 6) AS zone_events_1d,
  round(CASE WHEN start_datetime IS NULL THEN coalesce(m7, 0) ELSE c7 END, 6) AS zone_events_7d
FROM ev LEFT JOIN timed ON ev.incident_id = timed.incident_id LEFT JOIN means ON ev.zone = means.zone
""")

ORACLE["event_untimed_previous"] = with_b2(f"""
, {_UNTIMED}
SELECT incident_id, CAST(lag(congestion_severity) OVER (PARTITION BY zone ORDER BY start_datetime ASC NULLS LAST, incident_id) AS DOUBLE) AS prev_severity FROM ev
""")

ORACLE["time_order"] = with_b2(f"""
, {_UNTIMED}
SELECT incident_id, row_number() OVER (ORDER BY start_datetime ASC NULLS LAST, incident_id) AS place FROM ev
""")

ORACLE["severity_grid"] = with_inc("""
SELECT CAST(floor(round(latitude * 100, 6)) AS INTEGER) AS lat_cell, CAST(floor(round(longitude * 100, 6)) AS INTEGER) AS lon_cell,
  count(*) AS events, round(avg(congestion_severity), 6) AS mean_sev
FROM inc WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2
""")

_HIST = """
SELECT '{c}' AS "column", CAST(g.bin AS INTEGER) AS bin, round(mn + (mx - mn) * g.bin / 30.0, 6) AS lower, count(x) AS count
FROM (SELECT min({c}::DOUBLE) AS mn, max({c}::DOUBLE) AS mx FROM inc) CROSS JOIN range(30) g(bin)
LEFT JOIN (SELECT {c}::DOUBLE AS x FROM inc WHERE {c} IS NOT NULL) ON
  CASE WHEN mx = mn THEN 0 ELSE least(floor((x - mn) / (mx - mn) * 30.0), 29) END = g.bin
WHERE mn IS NOT NULL GROUP BY g.bin, mn, mx"""
ORACLE["numeric_histograms"] = with_inc(" UNION ALL ".join(_HIST.format(c=c) for c in ("incident_id", "duration_min", "latitude", "longitude")))
ORACLE["duration_bins"] = with_inc(_HIST.format(c="duration_min").replace("30.0", "50.0").replace("range(30)", "range(50)").replace("29)", "49)").replace("""'duration_min' AS "column", """, ""))

_NUMERIC = ["duration_min", "latitude", "longitude", "congestion_severity", "manpower_req", "barricade_req", "diversion_req"]
ORACLE["numeric_column_list"] = with_inc(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS nonnull FROM inc""" for c in _NUMERIC))

ORACLE["request_summaries"] = with_b2("""
SELECT incident_id AS request_id, printf('%.4f, %.4f', 12.9716 + (incident_id % 100) * 0.001, 77.5946 - (incident_id % 90) * 0.001) AS location,
  strftime(date_trunc('day', start_datetime) + to_hours(CAST(incident_id % 24 AS INTEGER)) + (start_datetime - date_trunc('hour', start_datetime)), '%Y-%m-%d %H:%M:%S')
  || CASE WHEN epoch_us(start_datetime) % 1000000 = 0 THEN '' ELSE printf('.%06d', epoch_us(start_datetime) % 1000000) END AS timestamp
FROM b2
""")

_EVAL = "WITH " + B4 + "," + _cls() + "\n"
ORACLE["report_json"] = _EVAL + "SELECT target, model, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM evalt"
ORACLE["published_metrics"] = _EVAL + " UNION ALL ".join(
    f"SELECT 'classification' AS report, target, model, 'test' AS split, '{m}' AS metric, round({m}, 6) AS value FROM evalt" for m in ("accuracy", "f1")
)

ORACLE["feedback_log"] = with_b3("""
SELECT prediction_id, event_cause, pred_severity, round(pred_duration_min, 6) AS pred_duration_min, CAST(actual_severity AS DOUBLE) AS actual_severity FROM b3
""")

ORACLE["appended_events"] = """
WITH scored AS (""" + ORACLE["stream_rule_scores"] + """)
SELECT event_id AS incident_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS start, severity_class AS severity, officers_required AS officers, 'open' AS status
FROM events JOIN scored ON events.event_id = scored.request_id
"""

_COORDS = [("endlatitude", 0), ("endlongitude", 1), ("resolved_at_latitude", 2), ("resolved_at_longitude", 3)]
ORACLE["clean_columns"] = (
    "WITH " + B1 + ", src AS (SELECT incident_id, "
    + ", ".join(f"CASE WHEN incident_id % {5 + i} <> 0 THEN latitude + {i} END AS {c}" for c, i in _COORDS)
    + " FROM b1) SELECT incident_id, "
    + ", ".join(f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM src)), 6) AS {c}" for c, _ in _COORDS)
    + " FROM src"
)
