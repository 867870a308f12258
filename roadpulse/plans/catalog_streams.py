"""Streaming queries (ST1–ST5): each runs a Structured Streaming query over
the driver's event table to completion (availableNow) into a table in the
shared checkpoint folder and returns that table."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources import bind
from ..streaming import streams as S
from .catalog import register, ts_strings
from .catalog_features import rounded

FLUSH_DAYS = 100


def _events_with_flush(spark, sf: str, max_files: int | None = None, folder: str | None = None) -> tuple[DataFrame, Callable[[], None]]:
    """The event stream with a control source, and what flushes it.

    The control source is an empty folder at first. The flush writes one row
    into it, past the latest event by `FLUSH_DAYS`, which moves the watermark
    past all data; its id (-1) matches no event. It's to be called only when
    the events are drained (see `run_to_table`)."""
    events = S.table_stream(spark, sf, "events", max_files)
    folder = folder or os.path.join(checkpoint_dir(spark), "streams", f"flush-{uuid.uuid4().hex[:8]}")
    spark.createDataFrame([], events.schema).write.mode("ignore").parquet(folder)
    control = spark.readStream.schema(events.schema).parquet(folder)

    def flush() -> None:
        last = spark.read.schema(events.schema).parquet(os.path.join(sf, "events*.parquet")).agg(F.max("ts").alias("ts")).where("ts is not null")
        fixed = {"event_id": -1, "user_id": 0, "event_type": "flush", "value": 0.0, "props": '{"k": 0}'}
        row = [F.lit(fixed[f.name]).cast(f.dataType).alias(f.name) if f.name in fixed else F.col("ts") for f in events.schema.fields]
        last.select((F.col("ts") + F.expr(f"INTERVAL {FLUSH_DAYS} DAYS")).alias("ts")).select(*row).write.mode("append").parquet(folder)

    return events.unionByName(control), flush


@register("stream_rule_scores")
def q_stream_rule_scores(spark, sf):
    """ST1: rule scoring of the event stream (append)."""
    ev = S.event_stream(spark, sf)
    req = ev.select(
        F.col("incident_id").alias("request_id"), "event_cause", F.lit(False).alias("road_closure"),
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"),
    )
    out = S.score_stream(req).select("request_id", "severity_class", "severity_label", "officers_required", "barricade_class", "diversion_class")
    path = S.run_to_table(out, "st1")
    return S.read_table(spark, path, out).drop("_batch")


def _windows(spark, sf, window, slide, name, max_files=None, lateness="1 hour"):
    events, flush = _events_with_flush(spark, sf, max_files)
    out = S.zone_window_counts(bind.event_incidents_from(events), window, slide, lateness)
    path = S.run_to_table(out, name, flush=flush)
    # the flush row's own windows never close
    return ts_strings(S.read_table(spark, path, out).drop("_batch"))


@register("stream_zone_daily")
def q_stream_zone_daily(spark, sf):
    """ST2: events per zone per tumbling 1-day window (append mode)."""
    return _windows(spark, sf, "1 day", None, "st2d")


@register("stream_zone_weekly")
def q_stream_zone_weekly(spark, sf):
    """ST2: events per zone per sliding 7-day window, 1-day slide."""
    return _windows(spark, sf, "7 days", "1 day", "st2w")


def _predictions(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("incident_id").alias("prediction_id"), F.col("start_datetime").alias("timestamp"),
        F.col("congestion_severity").alias("pred_severity"), F.col("duration_min").alias("pred_duration_min"),
    )


def _actuals(ev: DataFrame) -> DataFrame:
    eid = F.col("incident_id")
    return ev.select(
        eid.alias("prediction_id"),
        (F.col("start_datetime") + F.make_dt_interval(hours=(F.abs(eid) % 72).cast("int"))).alias("actual_at"),
        F.when(eid % 3 == 0, ((eid + F.col("congestion_severity")) % 4).cast("int")).when(eid % 3 == 1, F.col("congestion_severity")).alias("actual_severity"),
        F.when(eid % 3 != 2, F.col("duration_min") * 1.25).alias("actual_duration_min"),
    )


def _joined(spark, sf, max_files=None, lateness="2 hours"):
    events, flush = _events_with_flush(spark, sf, max_files)
    ev = bind.event_incidents_from(events)
    return S.join_actuals(_predictions(ev), _actuals(ev), bound_hours=48, watermark=lateness), flush


def actuals_both(spark, sf, max_files=None, lateness="2 hours", root=None):
    """ST3 with its second output over an event folder: (joined, late, all actuals)."""
    root = root or os.path.join(checkpoint_dir(spark), "streams", f"st3b-{uuid.uuid4().hex[:8]}")
    events, flush = _events_with_flush(spark, sf, max_files, os.path.join(root, "flush"))
    ev = bind.event_incidents_from(events)
    out = S.run_actuals(lambda: _predictions(ev), lambda: _actuals(ev), root, 48, lateness, flush)
    return tuple(t.where("prediction_id >= 0") for t in out)


def actuals_join(spark, sf, max_files=None, lateness="2 hours"):
    """ST3 over an event folder; `max_files` and `lateness` as for the stream."""
    out, flush = _joined(spark, sf, max_files, lateness)
    cols = ["prediction_id", "pred_severity", F.col("actual_severity").cast("double").alias("actual_severity"), "pred_duration_min", "actual_duration_min"]
    out = out.select(*cols)
    path = S.run_to_table(out, "st3", flush=flush)
    return rounded(S.read_table(spark, path, out).where(F.col("prediction_id") >= 0).drop("_batch"))


def drift_daily(spark, sf, max_files=None, lateness="2 hours"):
    """ST4 over an event folder."""
    joined, flush = _joined(spark, sf, max_files, lateness)
    out = S.rolling_drift(joined)
    path = S.run_to_table(out, "st4", flush=flush)
    return rounded(ts_strings(S.read_table(spark, path, out).drop("_batch")))


def prev_severity(spark, sf, max_files=None, lateness="2 hours"):
    """ST5 over an event folder."""
    events, flush = _events_with_flush(spark, sf, max_files)
    out = S.previous_severity_state(bind.event_incidents_from(events), lateness)
    path = S.run_to_table(out, "st5", flush=flush)
    return S.read_table(spark, path, out).where(F.col("incident_id") >= 0).drop("_batch")


@register("stream_actuals_join")
def q_stream_actuals_join(spark, sf):
    """ST3: predictions joined with actuals arriving within 48 h (left outer)."""
    return actuals_join(spark, sf)


@register("stream_late_actuals")
def q_stream_late_actuals(spark, sf):
    """ST3's second output: actuals that the bounded join left out, with the reason."""
    _, late, _ = actuals_both(spark, sf)
    return rounded(late.select("prediction_id", F.col("actual_severity").cast("double").alias("actual_severity"), "actual_duration_min", "reason"))


@register("stream_drift_daily")
def q_stream_drift_daily(spark, sf):
    """ST4: daily drift numbers over the joined stream (append after watermark)."""
    return drift_daily(spark, sf)


@register("stream_prev_severity")
def q_stream_prev_severity(spark, sf):
    """ST5: previous severity per zone from streaming state."""
    return prev_severity(spark, sf)
