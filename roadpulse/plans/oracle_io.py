"""Oracle SQL for the source / sink round trips."""

from __future__ import annotations

from .oracle import B1, ORACLE, with_inc
from .oracle_eval import B4, _cls

_F = "'%Y-%m-%d %H:%M:%S'"

ORACLE["csv_roundtrip"] = "WITH " + B1 + f"""
SELECT 'x, y' AS remark, * REPLACE ('INC' || CAST(incident_id AS VARCHAR) AS incident_id, strftime(start_datetime, {_F}) AS start_datetime, strftime(end_datetime, {_F}) AS end_datetime,
  strftime(closed_datetime, {_F}) AS closed_datetime, strftime(resolved_datetime, {_F}) AS resolved_datetime)
FROM b1
"""

_METRICS = ["accuracy", "balanced_accuracy", "f1", "roc_auc", "cohen_kappa"]
ORACLE["metrics_report"] = "WITH " + B4 + "," + _cls() + "\n" + " UNION ALL ".join(
    f"SELECT 'classification_results' AS report, target, model, 'test' AS split, '{m}' AS metric, round({m}, 6) AS value FROM evalt"
    for m in _METRICS
)

ORACLE["published_events"] = with_inc("""
SELECT strftime(start_datetime, '%Y-%m') AS start_month, coalesce(status, 'closed') AS status, count(*) AS events
FROM inc WHERE strftime(start_datetime, '%Y-%m') >= '1998-01' GROUP BY 1, 2
""")

_FITS = "incident_id % 97 <> 0 AND incident_id % 89 <> 0 AND incident_id % 83 <> 0"

ORACLE["published_version"] = with_inc(f"""
SELECT strftime(start_datetime, '%Y-%m') AS start_month, status, count(*) AS events,
  sum(congestion_severity)::bigint AS severity, round(sum(duration_min), 3) AS minutes
FROM inc WHERE {_FITS} GROUP BY 1, 2
""")

ORACLE["quarantined_events"] = with_inc(f"""
SELECT concat_ws(', ', CASE WHEN incident_id % 89 = 0 THEN 'bad congestion_severity' END, CASE WHEN incident_id % 97 = 0 THEN 'bad duration_min' END,
  CASE WHEN incident_id % 83 = 0 THEN 'no incident_id' END) AS reasons, count(*) AS rows
FROM inc WHERE NOT ({_FITS}) GROUP BY 1
""")
