"""Feature-stage queries (SC1–SC5, SC11, EN1–EN5, WN1–WN8, PF8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import features, history
from ..session import stage
from ..sources import bind
from .catalog import _inc, register

TIME_COLS = K.FEATURE_COLUMNS[:18]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (engines sum floats in different orders)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def feature_table(spark, sf: str, leaky: bool = True) -> DataFrame:
    """Cleaned incidents -> EN5 feature table with grid clusters (written
    once per session and input snapshot: the reference's feature parquet)."""
    return stage(
        spark, f"features-grid-leaky{int(leaky)}", bind.source_paths(sf),
        lambda: features.build_features(_inc(spark, sf), clusters=None, leaky=leaky)[0],
    )


@register("time_features")
def q_time_features(spark, sf):
    """SC1–SC4: calendar parts, flags, seconds since midnight, cyclical encodings."""
    d = features.add_time_features(_inc(spark, sf))
    return rounded(d.select("incident_id", *TIME_COLS), 9)


@register("spatial_features")
def q_spatial_features(spark, sf):
    """SC5 / SP3 distance from centre, grid cluster, density (WN6), junction flag."""
    d = features.add_spatial_features(_inc(spark, sf))
    return rounded(d.select("incident_id", "dist_from_center_km", "spatial_cluster", "cluster_density", "has_junction"))


@register("encoded_categoricals")
def q_encoded_categoricals(spark, sf):
    """EN1–EN3 + binary flags: label codes, corridor frequency, cause target encoding."""
    inc = _inc(spark, sf)
    d = features.apply_encodings(inc, features.fit_encodings(inc))
    cols = [f"{c}_enc" for c in K.LABEL_ENCODED] + [
        "event_type_enc", "priority_enc", "road_closure_enc", "has_veh_no", "authenticated_enc", "corridor_freq", "cause_target_enc",
    ]
    return rounded(d.select("incident_id", *cols), 9)


@register("zone_event_windows")
def q_zone_event_windows(spark, sf):
    """WN1 + WN2: trailing 1/7/30-day zone counts; untimed rows get the zone mean."""
    inc = _inc(spark, sf).select("incident_id", "zone", "start_datetime")
    d = history.trailing_counts(inc, ["zone"], "start_datetime", features.WINDOWS_US)
    d = history.fill_untimed_with_group_mean(d, ["zone"], "start_datetime", list(features.WINDOWS_US))
    return rounded(d.select("incident_id", *features.WINDOWS_US))


@register("event_zone_windows")
def q_event_zone_windows(spark, sf):
    """WN1 on intra-day event timestamps (microseconds; RANGE peers included)."""
    ev = bind.event_incidents(spark, sf).select("incident_id", "zone", "start_datetime")
    widths = {"zone_events_1h": history.HOUR_US, "zone_events_1d": history.DAY_US, "zone_events_7d": 7 * history.DAY_US}
    d = history.trailing_counts(ev, ["zone"], "start_datetime", widths, bucket_us=history.HOUR_US)
    return d.select("incident_id", *widths)


@register("prev_severity_zone")
def q_prev_severity_zone(spark, sf):
    """WN3: previous severity in the zone (time order, id tie-break), first -> median."""
    from ..operators.stats import scalar_quantiles

    inc = _inc(spark, sf).select("incident_id", "zone", "start_datetime", "congestion_severity")
    med = scalar_quantiles(inc, {"congestion_severity": [0.5]})[("congestion_severity", 0.5)]
    d = history.previous_value(inc, ["zone"], "start_datetime", "incident_id", "congestion_severity", "prev_severity_zone")
    return d.select("incident_id", F.coalesce(F.col("prev_severity_zone").cast("double"), F.lit(med)).alias("prev_severity_zone"))


@register("event_prev_severity")
def q_event_prev_severity(spark, sf):
    """WN3 on intra-day events, hour buckets (previous value crosses bucket edges)."""
    ev = bind.event_incidents(spark, sf)
    d = history.previous_value(ev, ["zone"], "start_datetime", "incident_id", "congestion_severity", "prev_severity", bucket_us=history.HOUR_US)
    return d.select("incident_id", F.col("prev_severity").cast("double").alias("prev_severity"))


@register("zone_group_means")
def q_zone_group_means(spark, sf):
    """WN4 / WN5 / JN4: zone mean severity, cause x zone and station mean duration."""
    d = _inc(spark, sf)
    d = history.group_mean(d, ["zone"], "congestion_severity", "zone_mean_severity")
    d = history.group_mean(d, ["event_cause", "zone"], "duration_min", "cause_zone_avg_dur")
    d = history.group_mean(d, ["police_station"], "duration_min", "station_avg_dur")
    return rounded(d.select("incident_id", "zone_mean_severity", "cause_zone_avg_dur", "station_avg_dur"))


@register("prior_zone_severity")
def q_prior_zone_severity(spark, sf):
    """WN8: leakage-safe zone mean severity over strictly earlier events."""
    ev = bind.event_incidents(spark, sf)
    d = history.prior_mean(ev, ["zone"], "start_datetime", "incident_id", "congestion_severity", "prior_zone_severity", bucket_us=history.HOUR_US)
    return rounded(d.select("incident_id", "prior_zone_severity"))


@register("interaction_features")
def q_interaction_features(spark, sf):
    """SC11: the eight interaction products (grid clusters)."""
    f = feature_table(spark, sf)
    cols = [c for c in K.FEATURE_COLUMNS if "_x_" in c]
    return rounded(f.select("incident_id", *cols))


@register("feature_matrix")
def q_feature_matrix(spark, sf):
    """EN5 + PF8: the 51-column feature table and the 5 targets."""
    return rounded(feature_table(spark, sf))
