"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the bindings in
`sources.bind`) so its work grows with them. Names match `oracle.ORACLE`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import dashboard
from . import flows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def _inc(spark: SparkSession, sf: str) -> DataFrame:
    return flows.labelled_incidents(spark, sf)


@register("zone_severity")
def q_zone_severity(spark, sf):
    """Flagship: bind -> duration -> p99 cap -> labels -> mean severity by zone."""
    return dashboard.zone_severity(_inc(spark, sf))


# ---------------------------------------------------------------- helpers
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def ts_strings(df: DataFrame) -> DataFrame:
    """Render timestamp columns as text so results compare across engines."""
    from pyspark.sql import functions as F

    out = []
    for name, t in df.dtypes:
        if t.startswith("timestamp"):
            out.append(F.date_format(F.col(name), TS_FORMAT).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def _raw(spark, sf):
    from ..operators import clean
    from ..sources import bind

    return clean.parse_datetimes(bind.incidents(spark, sf))


# ---------------------------------------------------------------- sources / cleaning
@register("incidents_raw")
def q_incidents_raw(spark, sf):
    """IO2 + bind: the incident table read from the driver's parquet tables."""
    return ts_strings(_raw(spark, sf))


@register("incidents_labelled")
def q_incidents_labelled(spark, sf):
    """PF1–PF7, PF9–PF14, LB1–LB5: the whole cleaned + labelled table."""
    return ts_strings(_inc(spark, sf))


@register("serving_events")
def q_serving_events(spark, sf):
    """IO7: the 15-column serving projection (status defaults to closed)."""
    return ts_strings(flows.serving_events(_inc(spark, sf)))


# ---------------------------------------------------------------- dashboard
@register("kpis")
def q_kpis(spark, sf):
    """AG1: headline numbers."""
    return dashboard.kpis(_inc(spark, sf))


@register("cause_counts")
def q_cause_counts(spark, sf):
    """AG2 / TK3: top-14 causes."""
    return dashboard.cause_counts(_inc(spark, sf))


@register("duration_histogram")
def q_duration_histogram(spark, sf):
    """AG4: 30-minute buckets capped at 1440."""
    return dashboard.duration_histogram(_inc(spark, sf))


@register("history_page")
def q_history_page(spark, sf):
    """TK1: newest-first history, second page (offset 100, 500 rows)."""
    from ..functions import constants as K

    ev = flows.serving_events(_inc(spark, sf))
    return ts_strings(dashboard.history(ev, skip=100, limit=K.HISTORY_PAGE))


@register("map_points")
def q_map_points(spark, sf):
    """TK2 / SP4: newest 1,000 located events with colour class."""
    return dashboard.map_points(_inc(spark, sf))


# ---------------------------------------------------------------- profiling
@register("class_distribution")
def q_class_distribution(spark, sf):
    """AG5: class counts of the four label columns."""
    from ..functions import constants as K
    from ..operators import profile

    return profile.class_distribution(_inc(spark, sf), K.CLASS_TARGETS)


@register("cause_severity_crosstab")
def q_cause_severity_crosstab(spark, sf):
    """AG6: cause x severity counts, missing = 0."""
    from ..operators import profile

    return profile.crosstab(_inc(spark, sf), "event_cause", "congestion_severity", [0, 1, 2, 3], "sev_")


@register("hour_severity_crosstab")
def q_hour_severity_crosstab(spark, sf):
    """AG6: hour-of-day x severity counts."""
    from pyspark.sql import functions as F

    from ..operators import profile

    df = _inc(spark, sf).withColumn("hour", F.coalesce(F.hour("start_datetime"), F.lit(0)))
    return profile.crosstab(df, "hour", "congestion_severity", [0, 1, 2, 3], "sev_")


@register("cause_median_duration")
def q_cause_median_duration(spark, sf):
    """AG7: exact median duration per cause."""
    from ..operators import profile

    return profile.median_by(_inc(spark, sf), "event_cause", "duration_min", "median_duration")


@register("zone_stats")
def q_zone_stats(spark, sf):
    """AG8: mean severity and count per zone."""
    from pyspark.sql import functions as F

    from ..operators import profile

    out = profile.mean_count_by(_inc(spark, sf), "zone", "congestion_severity")
    return out.withColumn("mean", F.round("mean", 6))


@register("missing_report")
def q_missing_report(spark, sf):
    """AG9: nulls per column of the raw incident table."""
    from ..operators import profile

    return profile.missing_report(_raw(spark, sf))


DESCRIBE_NUMERIC = ["duration_min", "congestion_severity", "latitude", "longitude"]
DESCRIBE_CATEGORICAL = ["event_cause", "zone", "corridor", "priority"]


@register("describe_incidents")
def q_describe_incidents(spark, sf):
    """AG10: describe(include=all) as a long table."""
    from pyspark.sql import functions as F

    from ..operators import profile

    d = profile.describe_all(_inc(spark, sf), DESCRIBE_NUMERIC, DESCRIBE_CATEGORICAL)
    dbl = ("unique", "freq")
    rnd = ("mean", "std", "min", "q25", "q50", "q75", "max")
    return d.select(*[F.round(c, 6).alias(c) if c in rnd else F.col(c).cast("double").alias(c) if c in dbl else F.col(c) for c in d.columns])


CORR_COLUMNS = ["duration_min", "congestion_severity", "manpower_req", "barricade_req", "diversion_req", "latitude", "longitude"]


@register("correlation_matrix")
def q_correlation_matrix(spark, sf):
    """AG11: Pearson r for all column pairs."""
    from pyspark.sql import functions as F

    from ..operators import profile

    return profile.correlation_pairs(_inc(spark, sf), CORR_COLUMNS).withColumn("corr", F.round("corr", 6))


@register("duration_bins")
def q_duration_bins(spark, sf):
    """AG12: 50 equal-width duration bins."""
    from pyspark.sql import functions as F

    from ..operators import profile

    return profile.equal_width_histogram(_inc(spark, sf), "duration_min", 50).withColumn("lower", F.round("lower", 6))


NULL_MAP_COLUMNS = ["closed_datetime", "resolved_datetime", "end_datetime", "event_cause", "priority", "zone", "latitude"]


@register("null_map")
def q_null_map(spark, sf):
    """AG13: per-row null indicators of the raw table."""
    from ..operators import profile

    return profile.null_map(_raw(spark, sf), NULL_MAP_COLUMNS)


@register("station_modal_corridor")
def q_station_modal_corridor(spark, sf):
    """AG14: modal corridor per police station, ties -> smallest."""
    from ..operators import profile

    return profile.mode_by(_inc(spark, sf), "police_station", "corridor")


@register("duration_quantiles")
def q_duration_quantiles(spark, sf):
    """AG15: exact p1 / p50 / p99 of duration per priority (null priority is a group)."""
    from ..operators.stats import exact_quantiles

    return exact_quantiles(
        _inc(spark, sf), "duration_min", [0.01, 0.5, 0.99], by=["priority"], names=["p01", "p50", "p99"],
    )


@register("table_counts")
def q_table_counts(spark, sf):
    """AG16: row, non-null and distinct counts of the raw table."""
    from ..operators import profile

    return profile.table_counts(_raw(spark, sf), ["event_cause", "priority", "zone", "closed_datetime"], ["zone", "event_cause", "police_station"])


@register("corridor_frequency")
def q_corridor_frequency(spark, sf):
    """AG17: share of rows per corridor."""
    from ..operators import profile

    return profile.relative_frequency(_inc(spark, sf), "corridor", "corridor_freq")
