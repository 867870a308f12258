"""Batch-twin oracle SQL for the streaming queries."""

from __future__ import annotations

from ..functions import constants as K
from .oracle import ORACLE, _quote
from .oracle_eval import with_b3
from .oracle_features import with_b2

_FMT = "'%Y-%m-%d %H:%M:%S.%f'"
_SEV = "CASE lower(event_cause) " + " ".join(f"WHEN {_quote(k)} THEN {v}" for k, v in K.CAUSE_SEVERITY.items()) + " ELSE 1 END"
_DIV = "(" + ", ".join(_quote(c) for c in K.DIVERSION_CAUSES) + ")"

ORACLE["stream_rule_scores"] = with_b2(f"""
SELECT request_id, sev AS severity_class,
  CASE sev WHEN 0 THEN 'Low' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'High' WHEN 3 THEN 'Severe' ELSE 'Unknown' END AS severity_label,
  CAST(CASE sev WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 8 WHEN 3 THEN 12 WHEN 4 THEN 20 ELSE 8 END AS INTEGER) AS officers_required,
  CAST(least(sev, 3) AS INTEGER) AS barricade_class,
  CAST(coalesce(lower(event_cause) IN {_DIV}, false) AS INTEGER) AS diversion_class
FROM (SELECT incident_id AS request_id, event_cause, CAST({_SEV} AS INTEGER) AS sev FROM b2)
""")

ORACLE["stream_zone_daily"] = with_b2(f"""
SELECT zone, strftime(d, {_FMT}) AS window_start, strftime(d + INTERVAL 1 DAY, {_FMT}) AS window_end, count(*) AS events
FROM (SELECT zone, date_trunc('day', start_datetime) AS d FROM b2) GROUP BY zone, d
""")

ORACLE["stream_zone_weekly"] = with_b2(f"""
SELECT zone, strftime(ws, {_FMT}) AS window_start, strftime(ws + INTERVAL 7 DAY, {_FMT}) AS window_end, count(*) AS events
FROM (SELECT zone, date_trunc('day', start_datetime) - to_days(CAST(k AS INTEGER)) AS ws FROM b2, range(7) t(k))
GROUP BY zone, ws
""")

_BOUNDED = """
SELECT prediction_id, timestamp, pred_severity, pred_duration_min,
  CASE WHEN prediction_id % 72 <= 48 THEN actual_severity END AS act_sev,
  CASE WHEN prediction_id % 72 <= 48 THEN actual_duration_min END AS act_dur
FROM b3"""

ORACLE["stream_actuals_join"] = with_b3(f"""
SELECT prediction_id, pred_severity, CAST(act_sev AS DOUBLE) AS actual_severity, round(pred_duration_min, 6) AS pred_duration_min,
  round(act_dur, 6) AS actual_duration_min
FROM ({_BOUNDED})
""")

ORACLE["stream_late_actuals"] = with_b3("""
SELECT prediction_id, CAST(actual_severity AS DOUBLE) AS actual_severity, round(actual_duration_min, 6) AS actual_duration_min, 'beyond_bound' AS reason
FROM b3 WHERE prediction_id % 72 > 48
""")

ORACLE["stream_drift_daily"] = with_b3(f"""
SELECT strftime(date_trunc('day', timestamp), {_FMT}) AS window_start, count(*) AS predictions,
  count(*) FILTER (WHERE act_sev IS NOT NULL AND pred_severity IS NOT NULL) AS evaluated,
  count(*) FILTER (WHERE act_sev IS NOT NULL AND pred_severity IS NOT NULL AND act_sev = pred_severity) AS hits,
  round(avg(abs(act_dur - pred_duration_min)), 6) AS duration_mae
FROM ({_BOUNDED}) GROUP BY date_trunc('day', timestamp)
""")

ORACLE["stream_prev_severity"] = with_b2("""
SELECT incident_id, zone,
  CAST(lag(congestion_severity) OVER (PARTITION BY zone ORDER BY start_datetime ASC NULLS LAST, incident_id ASC) AS DOUBLE) AS prev_severity
FROM b2
""")
