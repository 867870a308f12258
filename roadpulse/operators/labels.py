"""Rule labels (LB1–LB5): severity, imputed duration, manpower, barricades, diversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import flag, lookup, normalized_cause, severity_bin
from ..session import materialize
from .stats import scalar_quantiles, weighted_quantiles


def high_priority() -> F.Column:
    return F.trim(F.coalesce(F.col("priority"), F.lit("Low"))) == "High"


def closure() -> F.Column:
    return F.coalesce(F.col("requires_road_closure").cast("boolean"), F.lit(False))


def severity_score(normalize_causes: bool = False) -> F.Column:
    """Raw score clip(base + high + .5·unplanned + .5·(dur > 120), 0, 4).

    With the default the cause is normalised as the original does, so
    'debris' and 'Fog / Low Visibility' miss the score table (Q1);
    `normalize_causes=True` scores them as the table intends.
    """
    cause = normalized_cause("event_cause")
    scores = K.CAUSE_SEVERITY
    if normalize_causes:
        scores = {k.lower(): v for k, v in K.CAUSE_SEVERITY.items()}
        scores["debris_"] = K.CAUSE_SEVERITY["debris"]
    base = lookup(cause, scores, 0)
    unplanned = F.coalesce(F.col("event_type"), F.lit("unplanned")) == "unplanned"
    long_event = F.coalesce(F.col("duration_min"), F.lit(0.0)) > K.LONG_EVENT_MINUTES
    raw = base + flag(high_priority()) + F.lit(0.5) * flag(unplanned) + F.lit(0.5) * flag(long_event)
    return F.least(F.greatest(raw, F.lit(0.0)), F.lit(4.0))


def add_severity(df: DataFrame, normalize_causes: bool = False) -> DataFrame:
    """LB1: congestion_severity; a road closure forces 3."""
    # the bins name the score eight times: as a column of its own it is computed once a row
    scored = df.withColumn("_score", severity_score(normalize_causes))
    sev = F.when(closure(), F.lit(3)).otherwise(severity_bin("_score"))
    return scored.withColumn("congestion_severity", sev.cast("int")).drop("_score")


def impute_duration(df: DataFrame) -> DataFrame:
    """LB2: fill null duration with the (cause, priority) median, then the
    global median of the partly filled column (Q3). Null keys form no group (Q4).

    One pass collapses rows to (cause, priority, duration) counts, which is
    checkpointed (small next to the rows). Group medians and the global median
    of the partly filled column both come from those counts: the filled
    column's multiset is the known durations plus each group median repeated
    once per null duration of its group.
    """
    keys = ["event_cause", "priority"]
    vc = materialize(df.groupBy(*keys, F.col("duration_min").cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "duration-counts")
    keyed = F.col("event_cause").isNotNull() & F.col("priority").isNotNull()
    # one row per (cause, priority) group, written once: used for the global
    # median below and joined to the rows (AQE broadcasts it when small)
    grp = materialize(weighted_quantiles(vc.where(keyed & F.col("_v").isNotNull()), [0.5], by=keys, names=["_grp_med"]), "group-medians")
    holes = vc.where(keyed & F.col("_v").isNull()).select(*keys, "_n")
    filled = holes.join(grp, keys).select(F.col("_grp_med").alias("_v"), "_n")
    known = vc.where(F.col("_v").isNotNull()).select("_v", "_n")
    allc = known.unionByName(filled).groupBy("_v").agg(F.sum("_n").alias("_n"))
    g = weighted_quantiles(allc, [0.5], names=["m"]).collect()
    glob = g[0]["m"] if g else None
    # one row per (cause, priority) group: small, AQE broadcasts it
    out = df.join(grp, on=keys, how="left").withColumn(
        "duration_min", F.coalesce(F.col("duration_min"), F.col("_grp_med"))
    ).drop("_grp_med")
    if glob is not None:
        out = out.withColumn("duration_min", F.coalesce(F.col("duration_min"), F.lit(float(glob))))
    return out


def add_resource_labels(df: DataFrame) -> DataFrame:
    """LB3–LB5 from severity, closure, raw cause and priority."""
    sev = F.col("congestion_severity")
    manpower = F.when(closure() & (sev == 3), F.lit(4)).otherwise(sev)
    barricade = F.when(~closure() & (sev == 3), F.lit(2)).otherwise(sev)
    barricade = F.least(F.greatest(barricade, F.lit(0)), F.lit(3))
    div_cause = F.coalesce(F.col("event_cause").isin(*K.DIVERSION_CAUSES), F.lit(False))
    diversion = closure() | (div_cause & high_priority())
    return (
        df.withColumn("manpower_req", manpower.cast("int"))
        .withColumn("barricade_req", barricade.cast("int"))
        .withColumn("diversion_req", diversion.cast("int"))
    )


def build_targets(df: DataFrame, normalize_causes: bool = False) -> DataFrame:
    """LB1–LB5 in the original order: severity sees the un-imputed duration."""
    return add_resource_labels(impute_duration(add_severity(df, normalize_causes)))
