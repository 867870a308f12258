"""Oracle SQL for feedback, scoring and evaluation queries."""

from __future__ import annotations

from ..functions import constants as K
from .oracle import ORACLE, _quote, with_inc
from .oracle_features import B2

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

B3 = f"""{B2},
b3 AS (
  SELECT incident_id AS prediction_id, start_datetime AS timestamp, event_cause, 'unplanned' AS event_type, priority,
    false AS requires_road_closure, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
    congestion_severity AS pred_severity, duration_min AS pred_duration_min,
    CAST(CASE congestion_severity WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 8 WHEN 3 THEN 12 WHEN 4 THEN 20 END AS INTEGER) AS pred_officers,
    CAST(least(congestion_severity, 3) AS INTEGER) AS pred_barricade_class, 0 AS pred_diversion,
    CAST(CASE WHEN incident_id % 3 = 0 THEN (incident_id + congestion_severity) % 4
              WHEN incident_id % 3 = 1 THEN congestion_severity END AS INTEGER) AS actual_severity,
    CASE WHEN incident_id % 3 <> 2 THEN duration_min * 1.25 END AS actual_duration_min
  FROM b2
)"""


def with_b3(body: str, extra: str = "") -> str:
    return "WITH " + B3 + ("," + extra if extra else "") + "\n" + body


UPDATES = """
upd AS (
  SELECT prediction_id, 1 AS update_seq, actual_severity, actual_duration_min FROM b3
  UNION ALL
  SELECT prediction_id, 2, CAST(NULL AS INTEGER), pred_duration_min * 2.0 FROM b3 WHERE prediction_id % 4 = 0
  UNION ALL
  SELECT prediction_id + 1000000000, 1, 1, 1.0 FROM b3 WHERE prediction_id % 50 = 0
),
latest AS (
  SELECT prediction_id AS lid,
    arg_max(actual_severity, update_seq) FILTER (WHERE actual_severity IS NOT NULL) AS new_sev,
    arg_max(actual_duration_min, update_seq) FILTER (WHERE actual_duration_min IS NOT NULL) AS new_dur
  FROM upd GROUP BY prediction_id
)"""

ORACLE["record_actuals"] = with_b3(
    """
SELECT b3.prediction_id, b3.pred_severity, round(b3.pred_duration_min, 6) AS pred_duration_min,
  CAST(latest.new_sev AS DOUBLE) AS actual_severity, round(latest.new_dur, 6) AS actual_duration_min
FROM b3 LEFT JOIN latest ON b3.prediction_id = latest.lid
""",
    extra=UPDATES,
)

ORACLE["rejected_actuals"] = with_b3(
    "SELECT prediction_id, update_seq FROM upd WHERE prediction_id NOT IN (SELECT prediction_id FROM b3)", extra=UPDATES
)

ORACLE["drift_report"] = with_b3("""
SELECT total_predictions, evaluated_records,
  round_even(hits / evaluated_records, 4) AS severity_accuracy,
  round_even(err, 3) AS severity_mean_error,
  round_even(mae, 2) AS duration_mae,
  (hits / evaluated_records) < 0.7 AS retrain,
  CASE WHEN (hits / evaluated_records) < 0.7 THEN '⚠ Significant drift detected — RETRAIN RECOMMENDED'
       ELSE '✓ Model performance acceptable. No retraining needed.' END AS recommendation
FROM (
  SELECT count(*) AS total_predictions,
    count(*) FILTER (WHERE actual_severity IS NOT NULL AND pred_severity IS NOT NULL) AS evaluated_records,
    count(*) FILTER (WHERE actual_severity IS NOT NULL AND pred_severity IS NOT NULL AND actual_severity = pred_severity) AS hits,
    avg(abs(CAST(actual_severity AS DOUBLE) - pred_severity)) FILTER (WHERE actual_severity IS NOT NULL AND pred_severity IS NOT NULL) AS err,
    avg(abs(actual_duration_min - pred_duration_min)) FILTER (WHERE actual_duration_min IS NOT NULL AND pred_duration_min IS NOT NULL) AS mae
  FROM b3
) WHERE evaluated_records > 0
""")

ORACLE["feedback_log_union"] = with_b3("""
SELECT * REPLACE (strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp) FROM (
  SELECT * REPLACE (CAST(NULL AS INTEGER) AS actual_severity, CAST(NULL AS DOUBLE) AS actual_duration_min),
    CAST(NULL AS INTEGER) AS actual_officers, CAST(NULL AS INTEGER) AS actual_barricade_class, CAST(NULL AS INTEGER) AS actual_diversion
  FROM b3
)
""")

# ---------------------------------------------------------------- rule scoring
_SEV = "CASE lower(event_cause) " + " ".join(f"WHEN {_quote(k)} THEN {v}" for k, v in K.CAUSE_SEVERITY.items()) + " ELSE 1 END"
_DIV = "(" + ", ".join(_quote(c) for c in K.DIVERSION_CAUSES) + ")"

RULES = f"""
req AS (
  SELECT incident_id AS request_id, event_cause, coalesce(requires_road_closure, false) AS road_closure,
    latitude AS lat, longitude AS lon
  FROM inc
),
rs AS (
  SELECT request_id, lat, lon, CAST({_SEV} AS INTEGER) AS sev,
    CAST(road_closure OR coalesce(lower(event_cause) IN {_DIV}, false) AS INTEGER) AS div
  FROM req
),
plan AS (
  SELECT request_id,
    sev AS severity_class,
    CASE sev WHEN 0 THEN 'Low' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'High' WHEN 3 THEN 'Severe' ELSE 'Unknown' END AS severity_label,
    60.0 AS severity_confidence, 180.0 AS predicted_duration_min, round_even(180.0 / 60.0, 2) AS predicted_duration_hr,
    sev AS manpower_class,
    CAST(CASE sev WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 8 WHEN 3 THEN 12 WHEN 4 THEN 20 ELSE 8 END AS INTEGER) AS officers_required,
    70.0 AS manpower_confidence,
    CAST(least(sev, 3) AS INTEGER) AS barricade_class,
    CASE least(sev, 3) WHEN 0 THEN 'None' WHEN 1 THEN 'Light' WHEN 2 THEN 'Medium' WHEN 3 THEN 'Heavy' ELSE 'Unknown' END AS barricade_label,
    CAST(CASE least(sev, 3) WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 5 WHEN 3 THEN 10 ELSE 5 END AS INTEGER) AS barricade_count,
    div AS diversion_class,
    CASE div WHEN 0 THEN 'No Diversion' WHEN 1 THEN 'Diversion Required' END AS diversion_label,
    printf('%.4f, %.4f', lat, lon) AS location
  FROM rs
)"""

ORACLE["rule_scores"] = with_inc(
    "SELECT request_id, severity_class, severity_label, CAST(severity_confidence AS DOUBLE) AS severity_confidence, "
    "CAST(predicted_duration_min AS DOUBLE) AS predicted_duration_min, CAST(predicted_duration_hr AS DOUBLE) AS predicted_duration_hr, "
    "manpower_class, officers_required, CAST(manpower_confidence AS DOUBLE) AS manpower_confidence, barricade_class, barricade_label, "
    "barricade_count, diversion_class, diversion_label, location FROM plan",
    extra=RULES,
)

ORACLE["action_plans"] = with_inc(
    """
SELECT request_id, CAST(line_no AS INTEGER) AS line_no, text FROM (
  SELECT request_id, 0 AS line_no, printf('Deploy %d officers to the site', officers_required) AS text FROM plan
  UNION ALL SELECT request_id, 1, printf('Set up %d %s barricades', [0, 2, 5, 10][barricade_class + 1], ['', 'low', 'medium', 'high'][barricade_class + 1]) FROM plan
  UNION ALL SELECT request_id, 2, CASE WHEN diversion_class = 1 THEN 'Implement immediate traffic diversion' ELSE 'No diversion needed at this time' END FROM plan
  UNION ALL SELECT request_id, 3, 'Expect incident to last approximately 180 minutes (3.0 hours)' FROM plan
  UNION ALL SELECT request_id, 4, printf('Severity Level: %s — coordinate with %d officers', severity_label, officers_required) FROM plan
)
""",
    extra=RULES,
)

ORACLE["zone_history_asof"] = (
    "WITH "
    + B2
    + """,
req AS (SELECT incident_id AS request_id, zone, start_datetime + INTERVAL 90 MINUTE AS request_time FROM b2),
hist AS (
  SELECT zone, date_trunc('hour', start_datetime) + INTERVAL 1 HOUR AS hour_end, count(*) AS n_events,
    avg(congestion_severity) AS mean_severity
  FROM b2 GROUP BY zone, date_trunc('hour', start_datetime)
)
SELECT req.request_id, req.zone, hist.n_events, round(hist.mean_severity, 6) AS mean_severity
FROM req ASOF LEFT JOIN hist ON req.zone = hist.zone AND req.request_time >= hist.hour_end
"""
)

# ---------------------------------------------------------------- evaluation tables
B4 = f"""
ev AS (SELECT event_id AS incident_id, {_K} AS k, CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000.0 AS score FROM events),
variants AS (SELECT * FROM (VALUES ('ModelA', 10), ('ModelB', 9), ('ModelC', 8)) t(model, m)),
base AS (
  SELECT ev.incident_id, ev.score, v.model, v.m, t.target, t.ncls,
    CASE WHEN t.target = 'congestion_severity' THEN CAST(least(3, floor(ev.k / 25)) AS INTEGER) ELSE CAST(ev.k >= 50 AS INTEGER) END AS label
  FROM ev CROSS JOIN variants v CROSS JOIN (VALUES ('congestion_severity', 4), ('diversion_req', 2)) t(target, ncls)
),
scored AS (
  SELECT incident_id, target, model, label, score, ncls,
    CAST(CASE WHEN incident_id % m < m - 2 THEN label ELSE (label + 1) % ncls END AS INTEGER) AS prediction
  FROM base
),
probs AS (
  SELECT s.*, c.cls,
    CASE WHEN c.cls = s.prediction THEN 0.4 + 0.6 * s.score ELSE (1.0 - (0.4 + 0.6 * s.score)) / (s.ncls - 1) END AS p
  FROM scored s JOIN (SELECT unnest(range(4)) AS cls) c ON c.cls < s.ncls
)"""

CLS_METRICS = """
cc AS (SELECT {keys}, label, prediction, count(*) AS n FROM {src} GROUP BY ALL),
tot AS (SELECT {keys}, sum(n) AS big_n, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS hits FROM cc GROUP BY ALL),
sup AS (SELECT {keys}, label AS k, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cc GROUP BY ALL),
prd AS (SELECT {keys}, prediction AS k, sum(n) AS predicted FROM cc GROUP BY ALL),
per0 AS (
  SELECT coalesce(sup.target, prd.target) AS target, coalesce(sup.model, prd.model) AS model, coalesce(sup.k, prd.k) AS k,
    coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted
  FROM sup FULL JOIN prd ON sup.target = prd.target AND sup.model = prd.model AND sup.k = prd.k
),
per1 AS (
  SELECT *, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec,
    CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pre FROM per0
),
per AS (
  SELECT *, CASE WHEN rec + pre > 0 THEN 2 * rec * pre / (rec + pre) ELSE 0.0 END AS f1,
    count(*) OVER (PARTITION BY target, model) AS n_classes FROM per1
),
agg AS (
  SELECT per.target, per.model, any_value(tot.big_n) AS big_n, any_value(tot.hits) AS hits, any_value(n_classes) AS n_classes,
    avg(rec) FILTER (WHERE support > 0) AS balanced_accuracy,
    sum(support * rec) AS w_rec, sum(support * pre) AS w_pre, sum(support * f1) AS w_f1,
    max(rec) FILTER (WHERE n_classes = 2 AND k = 1) AS b_rec, max(pre) FILTER (WHERE n_classes = 2 AND k = 1) AS b_pre,
    max(f1) FILTER (WHERE n_classes = 2 AND k = 1) AS b_f1,
    sum(CAST(support AS DOUBLE) * predicted) AS pe_num
  FROM per JOIN tot ON per.target = tot.target AND per.model = tot.model GROUP BY per.target, per.model
),
clsm AS (
  SELECT target, model, hits / big_n AS accuracy, balanced_accuracy,
    CASE WHEN n_classes = 2 THEN coalesce(b_f1, 0.0) ELSE w_f1 / big_n END AS f1,
    CASE WHEN n_classes = 2 THEN coalesce(b_pre, 0.0) ELSE w_pre / big_n END AS precision,
    CASE WHEN n_classes = 2 THEN coalesce(b_rec, 0.0) ELSE w_rec / big_n END AS recall,
    CASE WHEN pe_num / (big_n * big_n) < 1 THEN (hits / big_n - pe_num / (big_n * big_n)) / (1 - pe_num / (big_n * big_n)) END AS cohen_kappa
  FROM agg
),
rk AS (
  SELECT target, model, cls, p, CAST(label = cls AS INTEGER) AS pos,
    rank() OVER (PARTITION BY target, model, cls ORDER BY p) + (count(*) OVER (PARTITION BY target, model, cls, p) - 1) / 2.0 AS r
  FROM {psrc} WHERE ncls > 2 OR cls = 1
),
aucc AS (
  SELECT target, model, cls, sum(pos) AS pp, count(*) - sum(pos) AS nn, sum(CASE WHEN pos = 1 THEN r ELSE 0 END) AS rs
  FROM rk GROUP BY ALL
),
auc AS (
  SELECT target, model, avg(CASE WHEN pp > 0 AND nn > 0 THEN (rs - pp * (pp + 1) / 2.0) / (pp * nn) END) AS roc_auc
  FROM aucc GROUP BY ALL
),
evalt AS (SELECT clsm.*, auc.roc_auc FROM clsm LEFT JOIN auc ON clsm.target = auc.target AND clsm.model = auc.model)"""


def _cls(src: str = "scored", psrc: str = "probs", prefix: str = "") -> str:
    body = CLS_METRICS.format(keys="target, model", src=src, psrc=psrc)
    if prefix:
        import re

        for name in ("cc", "tot", "sup", "prd", "per0", "per1", "per", "agg", "clsm", "rk", "aucc", "auc", "evalt"):
            body = re.sub(rf"(^|\n|,\s*){name} AS \(", rf"\g<1>{prefix}{name} AS (", body)
        for name in ("cc", "tot", "sup", "prd", "per0", "per1", "per", "agg", "clsm", "rk", "aucc", "auc", "evalt"):
            body = re.sub(rf"(FROM|JOIN) {name}\b", rf"\1 {prefix}{name}", body)
            body = re.sub(rf"\b{name}\.", f"{prefix}{name}.", body)
    return body


_M = ["accuracy", "balanced_accuracy", "f1", "precision", "recall", "cohen_kappa", "roc_auc"]
_MR = ", ".join(f"round({m}, 6) AS {m}" for m in _M)

ORACLE["classification_metrics"] = "WITH " + B4 + "," + _cls() + f"\nSELECT target, model, {_MR} FROM evalt"

ORACLE["confusion_matrix"] = "WITH " + B4 + "\nSELECT target, model, label, " + ", ".join(
    f"count(*) FILTER (WHERE prediction = {i}) AS pred_{i}" for i in range(4)
) + " FROM scored GROUP BY target, model, label"

DUR = with_b3  # duration pairs come from b3

ORACLE["regression_metrics"] = with_b3("""
SELECT event_cause, round(avg(abs(y - p)), 6) AS MAE, round(sqrt(avg((y - p) * (y - p))), 6) AS RMSE,
  round(avg(abs((y - p) / y)) FILTER (WHERE y <> 0) * 100, 6) AS MAPE,
  round(CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)) END, 6) AS R2
FROM (SELECT event_cause, actual_duration_min AS y, greatest(pred_duration_min, 0.0) AS p FROM b3
      WHERE actual_duration_min IS NOT NULL AND pred_duration_min IS NOT NULL)
GROUP BY event_cause
""")

ORACLE["residuals"] = with_b3("""
SELECT prediction_id, round(actual_duration_min, 6) AS actual, round(greatest(pred_duration_min, 0.0), 6) AS predicted,
  round(actual_duration_min - greatest(pred_duration_min, 0.0), 6) AS residual
FROM b3 WHERE actual_duration_min IS NOT NULL
""")

ORACLE["soft_vote"] = "WITH " + B4 + """,
av AS (SELECT incident_id, target, cls, round(avg(p), 9) AS p FROM probs GROUP BY ALL),
best AS (SELECT incident_id, target, max(p) AS mp FROM av GROUP BY ALL)
SELECT av.incident_id, av.target, CAST(min(av.cls) AS INTEGER) AS prediction, round(best.mp, 6) AS confidence
FROM av JOIN best ON av.incident_id = best.incident_id AND av.target = best.target AND av.p = best.mp
GROUP BY av.incident_id, av.target, best.mp
"""

ORACLE["top_models"] = "WITH " + B4 + "," + _cls() + """
SELECT target, model, round(balanced_accuracy, 6) AS balanced_accuracy, CAST(rank AS INTEGER) AS rank FROM (
  SELECT target, model, balanced_accuracy,
    row_number() OVER (PARTITION BY target ORDER BY balanced_accuracy DESC NULLS LAST, model ASC) AS rank
  FROM clsm
) WHERE rank <= 2
"""

ORACLE["model_comparison"] = "WITH " + B4 + "," + _cls() + """
SELECT model,
  max(round(balanced_accuracy, 6)) FILTER (WHERE target = 'congestion_severity') AS "Congestion Severity",
  max(round(balanced_accuracy, 6)) FILTER (WHERE target = 'diversion_req') AS "Diversion Req"
FROM clsm GROUP BY model
"""

ORACLE["best_model_metrics"] = (
    "WITH "
    + B4
    + """,
vscored AS (SELECT * FROM scored WHERE incident_id % 2 = 0), vprobs AS (SELECT * FROM probs WHERE incident_id % 2 = 0),
tscored AS (SELECT * FROM scored WHERE incident_id % 2 = 1), tprobs AS (SELECT * FROM probs WHERE incident_id % 2 = 1),"""
    + _cls("vscored", "vprobs", "v_")
    + ","
    + _cls("tscored", "tprobs", "t_")
    + f"""
, win AS (
  SELECT target, model AS best_model FROM (
    SELECT target, model, row_number() OVER (PARTITION BY target ORDER BY balanced_accuracy DESC NULLS LAST, model ASC) AS rn
    FROM v_evalt) WHERE rn = 1
)
SELECT win.target, win.best_model, {", ".join(f"round(t_evalt.{m}, 6) AS {m}" for m in _M)}
FROM win JOIN t_evalt ON win.target = t_evalt.target AND win.best_model = t_evalt.model
"""
)

ORACLE["split_assignment"] = with_inc("""
SELECT incident_id, congestion_severity,
  CASE WHEN u < 0.70 THEN 'train' WHEN u < 0.85 THEN 'val' ELSE 'test' END AS split
FROM (SELECT incident_id, congestion_severity,
        CAST('0x' || substr(md5(CAST(incident_id AS VARCHAR) || ':0'), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM inc)
""")

_U = "CAST('0x' || substr(md5(CAST(incident_id AS VARCHAR) || ':{salt}'), 1, 8) AS BIGINT) / 4294967296.0"

ORACLE["stratified_split"] = with_inc(f"""
SELECT incident_id, congestion_severity, CASE WHEN u <= t1 THEN 'train' WHEN u <= t2 THEN 'val' ELSE 'test' END AS split
FROM (SELECT incident_id, congestion_severity, {_U.format(salt=0)} AS u FROM inc) a
JOIN (SELECT congestion_severity AS c, quantile_cont(u, 0.70) AS t1, quantile_cont(u, 0.85) AS t2
      FROM (SELECT congestion_severity, {_U.format(salt=0)} AS u FROM inc) GROUP BY 1) b ON a.congestion_severity = b.c
""")

ORACLE["fold_assignment"] = with_inc(f"""
SELECT incident_id, CASE WHEN u0 < 0.70 THEN 'train' WHEN u0 < 0.85 THEN 'val' ELSE 'test' END AS split,
  u3 < 0.70 AS sampled, CAST(least(floor(u7 * 5), 4) AS INTEGER) AS fold5, CAST(least(floor(u11 * 3), 2) AS INTEGER) AS fold3
FROM (SELECT incident_id, {_U.format(salt=0)} AS u0, {_U.format(salt=3)} AS u3, {_U.format(salt=7)} AS u7, {_U.format(salt=11)} AS u11 FROM inc)
""")
