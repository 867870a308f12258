"""Queries over intra-day events and over the remaining sources and sinks.

The events table has times of day and, with every 13th time taken away here,
untimed rows; both exercise branches that the day-granular incidents don't.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import clean, features, feedback, history, metrics, profile, score
from ..session import checkpoint_dir, materialize
from ..sources import bind, io
from .catalog import _inc, register
from .catalog_features import rounded

HIST_COLUMNS = ["incident_id", "duration_min", "latitude", "longitude"]
EVENT_HOURS = list(range(24))


def _scratch(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "io", f"{name}-{uuid.uuid4().hex[:8]}")


def untimed_events(spark, sf: str) -> DataFrame:
    """B2 with every 13th time missing, and non-null vehicle and junction columns."""
    ev, eid = bind.event_incidents(spark, sf), F.col("incident_id")
    return ev.select(
        "*",
        F.when(eid % 13 != 0, F.col("start_datetime")).alias("seen"),
        F.when(eid % 4 == 0, F.concat(F.lit("KA"), eid.cast("string"))).alias("veh_no"),
        F.when(eid % 5 == 0, F.concat(F.lit("J"), (eid % 7).cast("string"))).alias("junction"),
        F.when(eid % 2 == 0, F.lit("yes")).otherwise("no").alias("authenticated"),
    ).drop("start_datetime").withColumnRenamed("seen", "start_datetime")


@register("event_time_features")
def q_event_time_features(spark, sf):
    """SC1-SC4 on times of day, untimed rows included."""
    d = features.add_time_features(untimed_events(spark, sf))
    return rounded(d.select("incident_id", "hour", "minute", "weekday", "is_peak", "is_night", "is_weekend", "time_since_midnight", "hour_sin", "hour_cos"))


@register("event_hour_crosstab")
def q_event_hour_crosstab(spark, sf):
    """AG6: severity counts by hour of the day (24 rows)."""
    d = features.add_time_features(bind.event_incidents(spark, sf)).select("hour", "congestion_severity")
    return profile.crosstab(d, "hour", "congestion_severity", [0, 1, 2, 3], "sev_")


@register("event_untimed_windows")
def q_event_untimed_windows(spark, sf):
    """WN1 + WN2 with untimed rows: they take the zone's mean count."""
    ev = untimed_events(spark, sf).select("incident_id", "zone", "start_datetime")
    widths = {"zone_events_1d": history.DAY_US, "zone_events_7d": 7 * history.DAY_US}
    d = materialize(history.trailing_counts(ev, ["zone"], "start_datetime", widths), "counts")
    return rounded(history.fill_untimed_with_group_mean(d, ["zone"], "start_datetime", list(widths)).select("incident_id", *widths))


@register("event_untimed_previous")
def q_event_untimed_previous(spark, sf):
    """WN3 with untimed rows: they follow all timed ones, by id."""
    ev = untimed_events(spark, sf).select("incident_id", "zone", "start_datetime", "congestion_severity")
    d = history.previous_value(ev, ["zone"], "start_datetime", "incident_id", "congestion_severity", "prev_severity")
    return d.select("incident_id", F.col("prev_severity").cast("double").alias("prev_severity"))


@register("time_order")
def q_time_order(spark, sf):
    """TK6: every event's place in time order, untimed ones last, ties by id.

    The sort is range-partitioned; a place is the rows of earlier tasks plus
    the place within the task (a count a task reaches the driver)."""
    ev = untimed_events(spark, sf).select("incident_id", "start_datetime")
    order = [F.col("start_datetime").asc_nulls_last(), F.col("incident_id").asc()]
    d = materialize(ev.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.monotonically_increasing_id()), "time-order")
    task = F.shiftright("_p", 33)
    before = d.groupBy(task.alias("t")).agg(F.count(F.lit(1)).alias("n")).withColumn("b", F.sum("n").over(Window.orderBy("t")) - F.col("n"))
    d = d.withColumn("t", task).join(F.broadcast(before), "t")
    return d.select("incident_id", (F.col("b") + F.col("_p").bitwiseAND((1 << 33) - 1) + 1).alias("place"))


@register("severity_grid")
def q_severity_grid(spark, sf):
    """SP5: the scatter layer on a grid of 0.01 degrees: events and mean severity a cell."""
    inc = _inc(spark, sf).where("latitude is not null and longitude is not null")
    cell = [F.floor(F.round(F.col(c) * 100, 6)).cast("int").alias(n) for c, n in (("latitude", "lat_cell"), ("longitude", "lon_cell"))]
    return rounded(inc.groupBy(*cell).agg(F.count(F.lit(1)).alias("events"), F.avg("congestion_severity").alias("mean_sev")))


@register("numeric_histograms")
def q_numeric_histograms(spark, sf):
    """AG12: 30 equal-width bins of each numeric column, empty bins included."""
    inc = _inc(spark, sf)
    out = None
    for c in HIST_COLUMNS:
        h = profile.equal_width_histogram(inc, c, 30).select(F.lit(c).alias("column"), "bin", F.round("lower", 6).alias("lower"), "count")
        out = h if out is None else out.unionByName(h)
    return out


@register("numeric_column_list")
def q_numeric_column_list(spark, sf):
    """PF20: the numeric columns of the cleaned table, with their non-null counts."""
    inc = _inc(spark, sf)
    cols = [c for c in clean.numeric_columns(inc) if c in ("duration_min", "latitude", "longitude", "congestion_severity", "manpower_req", "barricade_req", "diversion_req")]
    return profile._unpivot(inc, cols, "double").groupBy("column").agg(F.count("value").alias("nonnull"))  # noqa: SLF001


@register("request_summaries")
def q_request_summaries(spark, sf):
    """SC10 + SC13: location and time text of a request whose hour was replaced."""
    ev = bind.event_incidents(spark, sf)
    eid = F.col("incident_id")
    at = score.replace_hour(F.col("start_datetime"), (eid % 24).cast("int"))
    lat, lon = F.lit(K.CITY_LAT) + (eid % 100) * 0.001, F.lit(K.CITY_LON) - (eid % 90) * 0.001
    return ev.select(F.col("incident_id").alias("request_id"), score.location_text(lat, lon).alias("location"), score.time_text(at).alias("timestamp"))


@register("report_json")
def q_report_json(spark, sf):
    """SC12: metric rows encoded as one JSON document a model, and decoded."""
    m = metrics.evaluation_table(bind.scored(spark, sf))
    names = ["accuracy", "f1"]
    doc = m.select(F.to_json(F.struct("target", "model", *[F.round(c, 6).alias(c) for c in names])).alias("doc"))
    return doc.select(F.from_json("doc", "target string, model string, " + ", ".join(f"{c} double" for c in names)).alias("d")).select("d.*")


@register("feedback_log")
def q_feedback_log(spark, sf):
    """IO5 + IO6: predictions appended to the log in two batches, and read back; a missing log is empty."""
    pairs = bind.feedback_pairs(spark, sf).drop("actual_at")
    path = _scratch(spark, "feedback")
    nothing = feedback.read_feedback(spark, path)
    for part in (0, 1):
        feedback.log_predictions(pairs.where(F.col("prediction_id") % 2 == part), path)
    cols = ["prediction_id", "event_cause", "pred_severity", "pred_duration_min", F.col("actual_severity").cast("double").alias("actual_severity")]
    return rounded(feedback.append_rows(nothing, feedback.read_feedback(spark, path)).select(*cols))


@register("appended_events")
def q_appended_events(spark, sf):
    """IO8: scored requests appended to the serving table as open events."""
    ev = bind.event_incidents(spark, sf)
    req = ev.select(
        F.col("incident_id").alias("request_id"), F.col("start_datetime").alias("request_time"), "event_cause", F.lit("unplanned").alias("event_type"), "priority",
        F.lit(False).alias("road_closure"), F.lit(K.CITY_LAT).alias("lat"), F.lit(K.CITY_LON).alias("lon"),
    )
    path = _scratch(spark, "appended")
    io.append_scored(score.resource_plan(score.rule_fallback(req)), path)
    t = io.read_table(spark, path)
    return t.select("incident_id", F.date_format("start_datetime", "yyyy-MM-dd HH:mm:ss").alias("start"), F.col("congestion_severity").cast("int").alias("severity"), F.col("manpower_officers").cast("int").alias("officers"), "status")


@register("published_metrics")
def q_published_metrics(spark, sf):
    """IO9: two reports published to one table, one read back by its key."""
    m = metrics.evaluation_table(bind.scored(spark, sf))
    path = _scratch(spark, "metrics")
    for report in ("other", "classification"):
        io.publish_metrics(io.metrics_long(m, report, "test", ["accuracy", "f1"]), path)
    return rounded(io.read_metrics(spark, path, "classification").select("report", "target", "model", "split", "metric", "value"))


@register("clean_columns")
def q_clean_columns(spark, sf):
    """PF5 + PF7: metadata columns go, nulls of the four coordinates take the median."""
    raw = bind.incidents(spark, sf)
    eid = F.col("incident_id")
    coords = [F.when(eid % (5 + i) != 0, F.col("latitude") + i).alias(c) for i, c in enumerate(K.MEDIAN_FILL_COORDS)]
    d = raw.select("incident_id", *coords, *[F.lit("m").alias(c) for c in K.DROP_COLUMNS if c != "id"])
    return rounded(clean.fill_medians(clean.drop_useless(d), K.MEDIAN_FILL_COORDS))
