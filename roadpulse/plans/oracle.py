"""Independent DuckDB SQL for every SQL-checkable query in `catalog`.

Written directly in SQL over the driver's tables (pre-registered views), not
generated from the Spark plans. Shared CTE text (the table bindings and the
cleaning stage) is composed with plain string functions.
"""

from __future__ import annotations

from ..functions import constants as K
from ..sources.bind import CAUSE_CYCLE


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_CAUSE_LIST = "[" + ", ".join(_quote(c) for c in CAUSE_CYCLE) + "]"
_SCORE_CASE = "CASE ncause " + " ".join(f"WHEN {_quote(k)} THEN {v}" for k, v in K.CAUSE_SEVERITY.items()) + " ELSE 0 END"
_DIV_LIST = "(" + ", ".join(_quote(c) for c in K.DIVERSION_CAUSES) + ")"


def mins(a: str, b: str) -> str:
    return f"(CAST(epoch_us({b}) - epoch_us({a}) AS DOUBLE) / 60000000.0)"


B1 = f"""
ship AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship, min(l_shipdate) AS first_ship
  FROM lineitem GROUP BY l_orderkey
),
b1 AS (
  SELECT o.o_orderkey AS incident_id,
         o.o_orderdate AS start_datetime,
         CASE WHEN o.o_orderkey % 3 = 0 THEN o.o_orderdate + INTERVAL 90 MINUTE END AS end_datetime,
         CASE WHEN o.o_orderkey % 5 <> 0 THEN s.last_ship END AS closed_datetime,
         CASE WHEN o.o_orderkey % 7 <> 0 THEN s.first_ship END AS resolved_datetime,
         CASE WHEN o.o_orderkey % 101 <> 0 THEN ({_CAUSE_LIST})[CAST(o.o_orderkey % 17 AS INTEGER) + 1] END AS event_cause,
         CASE WHEN o.o_orderstatus = 'P' THEN 'planned' ELSE 'unplanned' END AS event_type,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'High'
              WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'Low' END AS priority,
         (o.o_orderkey % 11 = 0) AS requires_road_closure,
         CASE WHEN o.o_custkey % 10 <> 0 THEN n.n_name END AS zone,
         'PS_' || CAST(o.o_custkey % 50 AS VARCHAR) AS police_station,
         c.c_mktsegment AS corridor,
         CASE WHEN o.o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS status,
         CAST(12.9716 AS DOUBLE) + CAST((o.o_custkey % 201) - 100 AS DOUBLE) * CAST(0.001 AS DOUBLE) AS latitude,
         CAST(77.5946 AS DOUBLE) + CAST((o.o_custkey % 151) - 75 AS DOUBLE) * CAST(0.001 AS DOUBLE) AS longitude,
         CAST(NULL AS VARCHAR) AS veh_type, CAST(NULL AS VARCHAR) AS veh_no, CAST(NULL AS VARCHAR) AS reason_breakdown,
         CAST(NULL AS VARCHAR) AS kgid, CAST(NULL AS VARCHAR) AS authenticated, CAST(NULL AS VARCHAR) AS junction
  FROM orders o
  LEFT JOIN ship s ON o.o_orderkey = s.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

# Cleaning + labelling stage on b1 -> table `inc` (zone imputation off).
CLEAN = f"""
d0 AS (
  SELECT *, CASE
      WHEN start_datetime IS NOT NULL AND closed_datetime IS NOT NULL THEN {mins('start_datetime', 'closed_datetime')}
      WHEN start_datetime IS NOT NULL AND resolved_datetime IS NOT NULL THEN {mins('start_datetime', 'resolved_datetime')}
      WHEN start_datetime IS NOT NULL AND end_datetime IS NOT NULL THEN {mins('start_datetime', 'end_datetime')}
    END AS dur0
  FROM b1
),
d1 AS (SELECT * EXCLUDE (dur0), CASE WHEN dur0 IS NOT NULL THEN greatest(dur0, 0.0) END AS dur1 FROM d0),
dcap AS (SELECT quantile_cont(dur1, 0.99) AS cap FROM d1),
d2 AS (SELECT d1.* EXCLUDE (dur1), CASE WHEN dur1 IS NOT NULL THEN least(dur1, dcap.cap) END AS duration_min FROM d1, dcap),
n0 AS (
  SELECT *,
    CASE WHEN lower(trim(coalesce(event_cause, 'others'))) = 'debris' THEN 'debris_'
         ELSE lower(trim(coalesce(event_cause, 'others'))) END AS ncause,
    CAST(trim(coalesce(priority, 'Low')) = 'High' AS INTEGER) AS hp,
    coalesce(requires_road_closure, false) AS clo
  FROM d2
),
n1 AS (
  SELECT *, least(greatest({_SCORE_CASE} + hp
        + 0.5 * CAST(coalesce(event_type, 'unplanned') = 'unplanned' AS INTEGER)
        + 0.5 * CAST(coalesce(duration_min, 0.0) > 120 AS INTEGER), 0.0), 4.0) AS raw_score
  FROM n0
),
n2 AS (
  SELECT * EXCLUDE (raw_score),
    CAST(CASE WHEN clo THEN 3
         WHEN raw_score > -0.1 AND raw_score <= 0.9 THEN 0
         WHEN raw_score > 0.9 AND raw_score <= 1.9 THEN 1
         WHEN raw_score > 1.9 AND raw_score <= 2.9 THEN 2
         WHEN raw_score > 2.9 AND raw_score <= 10 THEN 3 END AS INTEGER) AS congestion_severity
  FROM n1
),
gmed AS (
  SELECT event_cause, priority, quantile_cont(duration_min, 0.5) AS gm
  FROM n2 WHERE event_cause IS NOT NULL AND priority IS NOT NULL GROUP BY event_cause, priority
),
n3 AS (
  SELECT n2.* REPLACE (coalesce(n2.duration_min, gmed.gm) AS duration_min)
  FROM n2 LEFT JOIN gmed ON n2.event_cause = gmed.event_cause AND n2.priority = gmed.priority
),
allmed AS (SELECT quantile_cont(duration_min, 0.5) AS am FROM n3),
n4 AS (SELECT n3.* REPLACE (coalesce(n3.duration_min, allmed.am) AS duration_min) FROM n3, allmed),
n5 AS (
  SELECT * EXCLUDE (ncause, hp, clo),
    CAST(CASE WHEN clo AND congestion_severity = 3 THEN 4 ELSE congestion_severity END AS INTEGER) AS manpower_req,
    CAST(least(greatest(CASE WHEN NOT clo AND congestion_severity = 3 THEN 2 ELSE congestion_severity END, 0), 3) AS INTEGER) AS barricade_req,
    CAST(clo OR (coalesce(event_cause IN {_DIV_LIST}, false) AND hp = 1) AS INTEGER) AS diversion_req
  FROM n4
),
llq AS (
  SELECT quantile_cont(latitude, 0.01) AS lat_lo, quantile_cont(latitude, 0.99) AS lat_hi,
         quantile_cont(longitude, 0.01) AS lon_lo, quantile_cont(longitude, 0.99) AS lon_hi FROM n5
),
inc AS (
  SELECT n5.* REPLACE (
      coalesce(n5.zone, 'Unknown') AS zone,
      coalesce(n5.police_station, 'Unknown') AS police_station,
      coalesce(n5.corridor, 'Unknown') AS corridor,
      coalesce(n5.veh_type, 'Unknown') AS veh_type, coalesce(n5.veh_no, 'Unknown') AS veh_no,
      coalesce(n5.reason_breakdown, 'None') AS reason_breakdown, coalesce(n5.kgid, 'Unknown') AS kgid,
      coalesce(n5.junction, 'None') AS junction,
      CASE WHEN n5.latitude IS NOT NULL THEN least(greatest(n5.latitude, llq.lat_lo), llq.lat_hi) END AS latitude,
      CASE WHEN n5.longitude IS NOT NULL THEN least(greatest(n5.longitude, llq.lon_lo), llq.lon_hi) END AS longitude)
  FROM n5, llq
)"""

INC = "WITH " + B1 + "," + CLEAN + "\n"


def with_inc(body: str, extra: str = "") -> str:
    """SQL over the cleaned incident table `inc` (+ optional extra CTEs)."""
    return INC + ("," + extra if extra else "") + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["zone_severity"] = with_inc("""
SELECT CASE WHEN zone IS NULL OR zone = '' THEN 'Unknown' ELSE zone END AS zone,
       round_even(coalesce(avg(congestion_severity), 0.0), 2) AS mean_sev,
       count(*) AS count
FROM inc GROUP BY 1
""")
