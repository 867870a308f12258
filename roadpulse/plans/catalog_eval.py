"""Feedback, scoring and evaluation queries (JN5, JN6, AG18, SO1, LB6–LB8,
ML1, ML5, ML11–ML15, TK5, AG19, AG20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import feedback, metrics, score
from ..sources import bind
from .catalog import _inc, register, ts_strings
from .catalog_features import rounded



# ---------------------------------------------------------------- feedback
def _log(spark, sf) -> DataFrame:
    """The prediction log as written at prediction time (no actuals yet)."""
    b3 = bind.feedback_pairs(spark, sf)
    return b3.select(*[F.lit(None).cast(t).alias(c) if c in feedback.ACTUAL_COLUMNS else F.col(c) for c, t in b3.dtypes if c != "actual_at"])


def _updates(spark, sf) -> DataFrame:
    """Actual-value updates: the B3 actuals, a later duration correction for
    every 4th prediction, and updates for unknown ids (to be rejected)."""
    b3 = bind.feedback_pairs(spark, sf)
    pid = F.col("prediction_id")
    first = b3.select("prediction_id", F.lit(1).alias("update_seq"), "actual_severity", "actual_duration_min")
    second = b3.where(pid % 4 == 0).select(
        "prediction_id", F.lit(2).alias("update_seq"), F.lit(None).cast("int").alias("actual_severity"),
        (F.col("pred_duration_min") * 2.0).alias("actual_duration_min"),
    )
    unknown = b3.where(pid % 50 == 0).select(
        (pid + F.lit(1_000_000_000)).alias("prediction_id"), F.lit(1).alias("update_seq"),
        F.lit(1).alias("actual_severity"), F.lit(1.0).alias("actual_duration_min"),
    )
    return first.unionByName(second).unionByName(unknown)


@register("record_actuals")
def q_record_actuals(spark, sf):
    """JN5: latest non-null actual per prediction overwrites the stored value."""
    out, _ = feedback.record_actuals(_log(spark, sf), _updates(spark, sf))
    return rounded(out.select("prediction_id", "pred_severity", "pred_duration_min", F.col("actual_severity").cast("double"), "actual_duration_min"))


@register("rejected_actuals")
def q_rejected_actuals(spark, sf):
    """JN5: updates addressed to unknown predictions (left-anti join)."""
    _, rej = feedback.record_actuals(_log(spark, sf), _updates(spark, sf))
    return rej.select("prediction_id", "update_seq")


@register("drift_report")
def q_drift_report(spark, sf):
    """AG18: accuracy, mean error, duration MAE and retrain flag."""
    return feedback.drift_report(bind.feedback_pairs(spark, sf))


@register("feedback_log_union")
def q_feedback_log_union(spark, sf):
    """SO1: append a batch missing some columns to the log (by name)."""
    log = _log(spark, sf)
    older = log.where(F.col("prediction_id") % 2 == 0)
    newer = log.where(F.col("prediction_id") % 2 == 1).drop("latitude", "longitude")
    return ts_strings(feedback.append_rows(older, newer))


# ---------------------------------------------------------------- rule scoring
def _requests(spark, sf) -> DataFrame:
    return score.requests_from_incidents(_inc(spark, sf))


PLAN_COLS = [
    "request_id", "severity_class", "severity_label", "severity_confidence", "predicted_duration_min", "predicted_duration_hr",
    "manpower_class", "officers_required", "manpower_confidence", "barricade_class", "barricade_label", "barricade_count",
    "diversion_class", "diversion_label", "location",
]


@register("rule_scores")
def q_rule_scores(spark, sf):
    """LB6 + LB7: rule fallback predictions and the resource plan per request."""
    return score.resource_plan(score.rule_fallback(_requests(spark, sf))).select(*PLAN_COLS)


@register("action_plans")
def q_action_plans(spark, sf):
    """LB8: five action-plan lines per request."""
    return score.action_plan(score.resource_plan(score.rule_fallback(_requests(spark, sf))))


@register("zone_history_asof")
def q_zone_history_asof(spark, sf):
    """JN6: latest completed hourly zone statistics as of each request (events + 90 min)."""
    ev = bind.event_incidents(spark, sf)
    req = ev.select(
        F.col("incident_id").alias("request_id"), "zone",
        (F.col("start_datetime") + F.expr("INTERVAL 90 MINUTES")).alias("request_time"),
    )
    hist = ev.groupBy("zone", F.date_trunc("hour", F.col("start_datetime")).alias("hour_start")).agg(
        F.count(F.lit(1)).alias("n_events"), F.avg("congestion_severity").alias("mean_severity")
    ).withColumn("hour_end", F.col("hour_start") + F.expr("INTERVAL 1 HOUR"))
    out = score.asof_join(req, hist, ["zone"], "request_time", "hour_end", ["n_events", "mean_severity"], bucket_us=6 * 3_600_000_000)
    return rounded(out.select("request_id", "zone", "n_events", "mean_severity"))


# ---------------------------------------------------------------- evaluation tables
def _scored(spark, sf) -> DataFrame:
    """B4 scored rows, written once per session and input snapshot (the
    prediction log every evaluation table reads)."""
    from ..session import materialize, stage

    return stage(spark, "scored", bind.source_paths(sf, ("events",)), lambda: materialize(bind.scored(spark, sf), "scored"))


@register("classification_metrics")
def q_classification_metrics(spark, sf):
    """ML11 + ML12: metric table per (target, model)."""
    return rounded(metrics.evaluation_table(_scored(spark, sf)))


@register("confusion_matrix")
def q_confusion_matrix(spark, sf):
    """ML13: confusion counts per (target, model, label)."""
    return metrics.confusion_matrix(_scored(spark, sf), [0, 1, 2, 3])


def _durations(spark, sf) -> DataFrame:
    b3 = bind.feedback_pairs(spark, sf)
    return b3.select("prediction_id", "event_cause", F.col("actual_duration_min").alias("label"), F.col("pred_duration_min").alias("prediction"))


@register("regression_metrics")
def q_regression_metrics(spark, sf):
    """ML14: MAE, RMSE, MAPE, R² of duration predictions per cause."""
    return rounded(metrics.regression_metrics(_durations(spark, sf), keys=["event_cause"]))


@register("residuals")
def q_residuals(spark, sf):
    """ML15: actual, clipped prediction and residual per prediction."""
    d = _durations(spark, sf).where(F.col("label").isNotNull())
    return rounded(metrics.residuals(d, "prediction_id"))


@register("soft_vote")
def q_soft_vote(spark, sf):
    """ML5: soft voting of the three model variants per incident and target."""
    return rounded(metrics.soft_vote(_scored(spark, sf)))


@register("top_models")
def q_top_models(spark, sf):
    """TK5: two best models per target by balanced accuracy."""
    m = metrics.classification_metrics(_scored(spark, sf))
    return rounded(metrics.top_models(m, n=2).select("target", "model", "balanced_accuracy", "rank"))


@register("model_comparison")
def q_model_comparison(spark, sf):
    """AG19: model x target balanced-accuracy table."""
    m = rounded(metrics.classification_metrics(_scored(spark, sf)))
    return metrics.model_comparison(m, ["congestion_severity", "diversion_req"])


@register("best_model_metrics")
def q_best_model_metrics(spark, sf):
    """AG20: validation winner per target and its test metrics (even / odd ids)."""
    s = _scored(spark, sf)
    val = metrics.evaluation_table(s.where(F.col("incident_id") % 2 == 0))
    test = metrics.evaluation_table(s.where(F.col("incident_id") % 2 == 1))
    return rounded(metrics.best_model_metrics(val, test))


@register("split_assignment")
def q_split_assignment(spark, sf):
    """ML1: deterministic 70/15/15 assignment by a portable key hash."""
    from ..operators.train import split_column

    inc = _inc(spark, sf)
    return inc.select("incident_id", "congestion_severity", split_column("incident_id").alias("split"))


@register("stratified_split")
def q_stratified_split(spark, sf):
    """ML1: 70/15/15 within every severity class, by exact cut points of the key hash."""
    from ..operators.train import stratified_split

    return stratified_split(_inc(spark, sf).select("incident_id", "congestion_severity"), "congestion_severity", "incident_id")


@register("fold_assignment")
def q_fold_assignment(spark, sf):
    """ML16/ML17: split, tuning sample and folds, from hashes that don't depend on each other."""
    from ..operators import train

    inc = _inc(spark, sf)
    return inc.select(
        "incident_id", train.split_column("incident_id").alias("split"), (train.unit_hash("incident_id", 3) < 0.70).alias("sampled"),
        train.fold_column("incident_id", 5).alias("fold5"), train.fold_column("incident_id", 3, salt=11).alias("fold3"),
    )
