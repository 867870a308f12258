"""Dashboard queries over the serving table (AG1–AG4, TK1–TK3, SP4).

All are single aggregate or top-k plans; Spark's partial/final aggregation
and TakeOrderedAndProject keep every step distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import round_even
from .stats import global_quantiles


def kpis(events: DataFrame) -> DataFrame:
    """AG1: one row of headline numbers (half-even rounding as Python's round).

    A zero-row input yields total_events = 0 and nulls elsewhere (the short form).
    """
    agg = events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.avg("congestion_severity").alias("_avg"),
        F.count_if(F.col("congestion_severity") == 3).alias("severe_events"),
        F.count_if(F.col("requires_road_closure") == F.lit(True)).alias("road_closures"),
        F.count_if(F.col("status") == "closed").alias("_closed"),
    )
    med = global_quantiles(events, "duration_min", [0.5], ["_med"])
    t = F.col("total_events")
    return agg.crossJoin(F.broadcast(med)).select(
        "total_events",
        F.when(t > 0, round_even(F.coalesce(F.col("_avg"), F.lit(0.0)), 2)).alias("avg_severity"),
        F.when(t > 0, round_even(F.coalesce(F.col("_med"), F.lit(0.0)), 0)).alias("median_duration"),
        F.when(t > 0, F.col("severe_events")).alias("severe_events"),
        F.when(t > 0, F.col("road_closures")).alias("road_closures"),
        F.when(t > 0, round_even(F.try_divide(F.col("_closed") * 100.0, t), 1)).alias("closed_pct"),
    )


def cause_counts(events: DataFrame, n: int = K.TOP_CAUSES) -> DataFrame:
    """AG2/TK3: the n most frequent causes (ties broken by cause)."""
    return (
        events.groupBy(F.col("event_cause").alias("cause"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_last("cause"))
        .limit(n)
    )


def zone_severity(events: DataFrame) -> DataFrame:
    """AG3: mean severity (2 dp) and count per zone; null/empty -> "Unknown" (Q19)."""
    z = F.when(F.col("zone").isNull() | (F.col("zone") == ""), F.lit("Unknown")).otherwise(F.col("zone"))
    return (
        events.groupBy(z.alias("zone"))
        .agg(F.avg("congestion_severity").alias("_m"), F.count(F.lit(1)).alias("count"))
        .select("zone", round_even(F.coalesce(F.col("_m"), F.lit(0.0)), 2).alias("mean_sev"), "count")
        .orderBy(F.desc("mean_sev"), "zone")
    )


def duration_histogram(events: DataFrame, width: int = K.HISTOGRAM_BUCKET_MIN, cap: int = K.HISTOGRAM_CAP_MIN) -> DataFrame:
    """AG4: 30-minute floor buckets, capped at 1440; null durations excluded."""
    b = F.least(F.floor(F.col("duration_min") / width) * width, F.lit(cap)).cast("bigint")
    return (
        events.where(F.col("duration_min").isNotNull())
        .groupBy(b.alias("duration"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("duration")
    )


def history(events: DataFrame, skip: int = 0, limit: int = K.HISTORY_PAGE) -> DataFrame:
    """TK1: newest first, paged (offset + limit); ties by id."""
    order = [F.desc_nulls_last("start_datetime"), F.asc("incident_id")]
    return events.orderBy(*order).offset(skip).limit(limit) if skip else events.orderBy(*order).limit(limit)


def map_points(events: DataFrame, n: int = K.MAP_POINTS) -> DataFrame:
    """TK2/SP4: newest n located events with a colour class."""
    colour = (
        F.when(F.col("congestion_severity") == 0, "green")
        .when(F.col("congestion_severity") == 1, "yellow")
        .when(F.col("congestion_severity") == 2, "orange")
        .when(F.col("congestion_severity") == 3, "red")
        .otherwise("grey")
    )
    return (
        events.where(F.col("latitude").isNotNull())
        .orderBy(F.desc_nulls_last("start_datetime"), F.asc("incident_id"))
        .limit(n)
        .select(
            "incident_id",
            F.col("latitude").alias("lat"),
            F.col("longitude").alias("lon"),
            F.col("congestion_severity").alias("severity"),
            F.col("event_cause").alias("cause"),
            "zone",
            colour.alias("colour"),
        )
    )
