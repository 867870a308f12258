"""Feature construction (SC1–SC5, SC11, EN1–EN5, WN1–WN6, PF8).

`build_features` is the whole feature stage: one lazy plan from the cleaned
incident table to (incident_id, 51 features, 5 targets). Encoders return the
dictionaries they fit, so scoring reuses the same codes (Q8).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import cyc_cos, cyc_sin, flag, haversine_km
from ..session import materialize
from . import history
from .clean import fill_medians
from .stats import bounded_domain_quantile, dense_index_multi


# ------------------------------------------------------------------ time (SC1–SC4)
def time_columns(ts: str = "start_datetime") -> list[F.Column]:
    t = F.col(ts)
    hour = F.coalesce(F.hour(t), F.lit(0))
    minute = F.coalesce(F.minute(t), F.lit(0))
    weekday = F.coalesce(F.weekday(t), F.lit(0))
    month = F.coalesce(F.month(t), F.lit(1))
    return [
        hour.alias("hour"),
        minute.alias("minute"),
        F.coalesce(F.dayofmonth(t), F.lit(1)).alias("day"),
        weekday.alias("weekday"),
        month.alias("month"),
        F.coalesce(F.weekofyear(t), F.lit(1)).alias("week_of_year"),
    ]


def add_time_features(df: DataFrame, ts: str = "start_datetime") -> DataFrame:
    """SC1–SC4: calendar parts (null ts -> 0/0/1/0/1/1), flags, cyclical encodings."""
    d = df.select("*", *time_columns(ts))
    h = F.col("hour")
    peak = K.MORNING_PEAK_HOURS + K.EVENING_PEAK_HOURS
    return d.select(
        "*",
        (F.col("weekday") >= 5).cast("int").alias("is_weekend"),
        h.isin(*peak).cast("int").alias("is_peak"),
        h.isin(*K.NIGHT_HOURS).cast("int").alias("is_night"),
        h.isin(*K.MORNING_PEAK_HOURS).cast("int").alias("is_morning_peak"),
        h.isin(*K.EVENING_PEAK_HOURS).cast("int").alias("is_evening_peak"),
        (h * 3600 + F.col("minute") * 60).alias("time_since_midnight"),
        cyc_sin("hour", 24).alias("hour_sin"),
        cyc_cos("hour", 24).alias("hour_cos"),
        cyc_sin("weekday", 7).alias("weekday_sin"),
        cyc_cos("weekday", 7).alias("weekday_cos"),
        cyc_sin("month", 12).alias("month_sin"),
        cyc_cos("month", 12).alias("month_cos"),
    )


# ------------------------------------------------------------------ spatial (SC5, SP3)
def grid_cluster(lat: str = "latitude", lon: str = "longitude", cell_deg: float = 0.05) -> F.Column:
    """Deterministic spatial cell id (SQL-checkable stand-in for KMeans labels)."""
    return (
        F.floor((F.col(lat) - F.lit(12.0)) / F.lit(cell_deg)) * 1000 + F.floor((F.col(lon) - F.lit(77.0)) / F.lit(cell_deg))
    ).cast("int")


def add_spatial_features(df: DataFrame, clusters: tuple | None = None) -> DataFrame:
    """SC5 distance, spatial cluster (+ density, WN6) and junction flag.

    `clusters` is (KMeansModel, median fill) from `spatial.fit_clusters`; the
    label is an inline nearest-centre expression. Without it a deterministic
    grid cell is used.
    """
    d = df.withColumn("dist_from_center_km", haversine_km("latitude", "longitude"))
    if clusters is not None:
        from .spatial import nearest_centre

        model, fill = clusters
        lat = F.coalesce(F.col("latitude"), F.lit(fill.get("latitude")))
        lon = F.coalesce(F.col("longitude"), F.lit(fill.get("longitude")))
        d = d.withColumn("_lat", lat).withColumn("_lon", lon)
        d = d.withColumn("spatial_cluster", nearest_centre(model, "_lat", "_lon").cast("int")).drop("_lat", "_lon")
    else:
        d = d.withColumn("spatial_cluster", F.coalesce(grid_cluster(), F.lit(-1)))
    d = history.group_count(d, ["spatial_cluster"], "cluster_density")
    junction = F.col("junction") if "junction" in d.columns else F.lit(None).cast("string")
    return d.withColumn("has_junction", (F.coalesce(junction, F.lit("None")) != "None").cast("int"))


# ------------------------------------------------------------------ encoders (EN1–EN3)
@dataclass
class Encodings:
    """Fitted dictionaries (small DataFrames) reused at scoring time."""

    labels: dict[str, DataFrame] = field(default_factory=dict)  # col -> (value, col_enc)
    corridor_freq: DataFrame | None = None  # (corridor, corridor_freq)
    cause_target: DataFrame | None = None  # (event_cause, cause_target_enc)
    cause_target_default: DataFrame | None = None  # one row: mean of group means


def _filled(c: str) -> F.Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("Unknown"))


def fit_label_encoders(df: DataFrame, columns: Sequence[str] = K.LABEL_ENCODED) -> dict[str, DataFrame]:
    """EN1: alphabetical codes from 0 of each column (null -> "Unknown")."""
    cols = list(columns)
    src = df.select(*[(_filled(c) if c in df.columns else F.lit("Unknown")).alias(c) for c in cols])
    # all dictionaries in one pass, written once (small: distinct labels)
    dims = materialize(dense_index_multi(src, cols), "label-dims")
    return {c: dims.where(F.col("column") == c).select("value", F.col("idx").alias(f"{c}_enc")) for c in cols}


def apply_label_encoders(df: DataFrame, dims: dict[str, DataFrame], unseen: int = -1) -> DataFrame:
    """Join each dictionary (small; AQE broadcasts it). Unseen values -> `unseen`, a code that no label has."""
    d = df
    for c, dim in dims.items():
        key = _filled(c) if c in d.columns else F.lit("Unknown")
        d = d.withColumn(f"_k_{c}", key).join(dim.withColumnRenamed("value", f"_k_{c}"), f"_k_{c}", "left").drop(f"_k_{c}")
        d = d.withColumn(f"{c}_enc", F.coalesce(F.col(f"{c}_enc"), F.lit(unseen)))
    return d


def binary_encodings(df: DataFrame) -> DataFrame:
    """Binary flags: unplanned, high priority, closure, vehicle no., authenticated."""

    def col_or_null(c):
        return F.col(c) if c in df.columns else F.lit(None).cast("string")

    return df.select(
        "*",
        flag(F.col("event_type") == "unplanned").alias("event_type_enc"),
        flag(F.coalesce(F.col("priority"), F.lit("Low")) == "High").alias("priority_enc"),
        flag(F.col("requires_road_closure").cast("boolean")).alias("road_closure_enc"),
        flag(F.coalesce(col_or_null("veh_no"), F.lit("Unknown")) != "Unknown").alias("has_veh_no"),
        flag(F.lower(F.coalesce(col_or_null("authenticated"), F.lit("false"))) == "true").alias("authenticated_enc"),
    )


def fit_frequency(df: DataFrame, column: str = "corridor", name: str = "corridor_freq") -> DataFrame:
    """EN2 / AG17: relative frequency of each value."""
    total = df.agg(F.count(F.lit(1)).alias("_t"))
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("_c")).crossJoin(F.broadcast(total))
        .select(column, (F.col("_c") / F.col("_t")).alias(name))
    )


def fit_target_encoding(df: DataFrame, key: str = "event_cause", target: str = "congestion_severity", name: str = "cause_target_enc"):
    """EN3: mean target per key (null keys dropped); default = mean of group means."""
    te = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(target).alias(name))
    default = te.agg(F.avg(name).alias("_te_default"))
    return te, default


def apply_lookup(df: DataFrame, dim: DataFrame, key: str, name: str, default: float | DataFrame = 0.0) -> DataFrame:
    """JN1: left lookup join with a default on miss (null key misses too)."""
    d = df.join(dim, key, "left")
    if isinstance(default, DataFrame):
        dcol = default.columns[0]
        return d.crossJoin(F.broadcast(default)).withColumn(name, F.coalesce(F.col(name), F.col(dcol))).drop(dcol)
    return d.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def fit_encodings(df: DataFrame) -> Encodings:
    te, te_default = fit_target_encoding(df) if "congestion_severity" in df.columns else (None, None)
    return Encodings(
        labels=fit_label_encoders(df),
        corridor_freq=fit_frequency(df),
        cause_target=te,
        cause_target_default=te_default,
    )


def apply_encodings(df: DataFrame, enc: Encodings) -> DataFrame:
    d = apply_label_encoders(df, enc.labels)
    d = binary_encodings(d)
    d = apply_lookup(d, enc.corridor_freq, "corridor", "corridor_freq", 0.0)
    if enc.cause_target is not None:
        d = apply_lookup(d, enc.cause_target, "event_cause", "cause_target_enc", enc.cause_target_default)
    return d


# ------------------------------------------------------------------ history (WN1–WN5)
WINDOWS_US = {
    "zone_events_1d": 1 * history.DAY_US,
    "zone_events_7d": 7 * history.DAY_US,
    "zone_events_30d": 30 * history.DAY_US,
}


HISTORY_INPUTS = ["zone", "start_datetime", "congestion_severity", "duration_min", "event_cause", "police_station"]


def add_history_features(df: DataFrame, leaky: bool = True, key: str = "incident_id", source: DataFrame | None = None) -> DataFrame:
    """WN1–WN5 (leaky=True, the original definitions) or WN8 variants.

    leaky=False replaces the whole-group means (which include the row's own
    label) with means over strictly earlier rows.

    The history columns are computed on a narrow projection (key + the six
    inputs) of `source` (default: `df`; callers pass the cleaned table so the
    projection reads a few parquet columns) and joined back to the wide rows
    once on the key: the windows shuffle narrow rows, and the wide row table
    is exchanged a single time.
    """
    src = df if source is None else source
    base = src.select(key, *[c for c in HISTORY_INPUTS if c in src.columns])
    # severity is a class label (domain 0..3): a bounded-domain exact median
    med = bounded_domain_quantile(base, "congestion_severity", 0.5) if "congestion_severity" in base.columns else None
    d = history.trailing_counts(base, ["zone"], "start_datetime", WINDOWS_US)
    d = history.fill_untimed_with_group_mean(d, ["zone"], "start_datetime", list(WINDOWS_US))
    new = list(WINDOWS_US)
    if "congestion_severity" in d.columns:
        d = history.previous_value(d, ["zone"], "start_datetime", key, "congestion_severity", "prev_severity_zone")
        d = d.withColumn("prev_severity_zone", F.coalesce(F.col("prev_severity_zone").cast("double"), F.lit(med).cast("double")))
        if leaky:
            d = history.group_mean(d, ["zone"], "congestion_severity", "zone_mean_severity", source=base)
        else:
            d = history.prior_mean(d, ["zone"], "start_datetime", key, "congestion_severity", "zone_mean_severity")
        new += ["prev_severity_zone", "zone_mean_severity"]
    if "duration_min" in d.columns:
        if leaky:
            d = history.group_mean(d, ["event_cause", "zone"], "duration_min", "cause_zone_avg_dur", source=base)
            d = history.group_mean(d, ["police_station"], "duration_min", "station_avg_dur", source=base)
        else:
            d = history.prior_mean(d.withColumn("_cz", F.concat_ws("\u0001", "event_cause", "zone")), ["_cz"], "start_datetime", key, "duration_min", "cause_zone_avg_dur").drop("_cz")
            d = history.prior_mean(d, ["police_station"], "start_datetime", key, "duration_min", "station_avg_dur")
        new += ["cause_zone_avg_dur", "station_avg_dur"]
    hist = d.select(key, *new)
    return df.drop(*[c for c in new if c in df.columns]).join(hist, key, "left")


# ------------------------------------------------------------------ interactions (SC11)
def add_interactions(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        (F.col("event_cause_enc") * F.col("is_peak")).alias("cause_x_peak"),
        (F.col("event_cause_enc") * F.col("is_weekend")).alias("cause_x_weekend"),
        (F.col("zone_enc") * F.col("priority_enc")).alias("zone_x_priority"),
        (F.col("dist_from_center_km") * F.col("priority_enc")).alias("dist_x_priority"),
        (F.col("spatial_cluster") * F.col("event_cause_enc")).alias("cluster_x_cause"),
        (F.col("hour") * F.col("event_type_enc")).alias("hour_x_event_type"),
        (F.col("road_closure_enc") * F.col("priority_enc")).alias("closure_x_priority"),
        *([(F.col("congestion_severity") * F.col("cluster_density")).alias("sev_x_cluster")] if "congestion_severity" in df.columns else []),
    )


# ------------------------------------------------------------------ whole stage (EN5, PF8)
def build_features(
    df: DataFrame,
    clusters: tuple | None = None,
    encodings: Encodings | None = None,
    leaky: bool = True,
) -> tuple[DataFrame, Encodings]:
    """EN5: cleaned incidents -> (incident_id, 51 features, targets).

    Returns the feature table and the fitted encodings. Final nulls in
    features are filled with each column's exact median (PF8, one pass).
    """
    enc = encodings or fit_encodings(df)
    d = add_time_features(df)
    d = add_spatial_features(d, clusters)
    d = apply_encodings(d, enc)
    d = add_history_features(d, leaky=leaky, source=df)
    d = add_interactions(d)
    feats = [c for c in K.FEATURE_COLUMNS if c in d.columns]
    tgts = [c for c in K.TARGET_COLUMNS if c in d.columns]
    # stage output is written once (shared checkpoint folder): the median pass
    # and every consumer read it instead of recomputing the feature plan
    d = d.select("incident_id", *feats, *tgts)
    out = materialize(d, "features")
    # PF8: exact median fill; one aggregate finds the columns that hold nulls,
    # one quantile pass serves them; columns that the plan knows to hold none aren't read
    out = fill_medians(out, [f.name for f in d.schema.fields if f.name in feats and f.nullable])
    return out, enc
