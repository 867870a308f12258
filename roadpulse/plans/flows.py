"""Composed flows over the bound tables (the reference's stages, lazily)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import clip
from ..operators import clean, labels
from ..operators.stats import scalar_quantiles
from ..session import materialize, stage
from ..sources import bind


def clean_incidents(raw: DataFrame, impute_zone: bool = False, zone_k: int = 10, normalize_causes: bool = False, guard: clean.Retention | None = None) -> DataFrame:
    """Cleaning + labelling stage: parse, duration, targets, prune, impute.

    Global statistics that only depend on the parsed input (duration p99,
    latitude / longitude p1 and p99) are computed together in one distributed
    pass up front, so the row plan carries them as literals. `impute_zone=True`
    fills missing zones from spatial clusters (SP2, MLlib KMeans fit);
    otherwise missing zones become "Unknown".
    """
    # the parsed input is written once to the shared checkpoint folder: the
    # statistics passes and the row plan read it instead of re-running the
    # source joins (which dominate: a lineitem aggregate + three joins)
    parsed = clean.raw_duration(clean.parse_datetimes(raw)).withColumn("duration_min", clip("duration_min", lower=0.0))
    df = materialize(parsed, "parsed")
    if guard:
        guard.before(df)
    spec = {"duration_min": [0.99]}
    spec.update({c: [0.01, 0.99] for c in ("latitude", "longitude") if c in df.columns})
    stats = scalar_quantiles(df, spec)
    cap = stats[("duration_min", 0.99)]
    if cap is not None:
        df = df.withColumn("duration_min", clip("duration_min", upper=F.lit(float(cap))))
    df = labels.build_targets(df, normalize_causes)
    df = clean.drop_useless(df)
    df = clean.fill_constants(df)
    if impute_zone:
        from ..operators.spatial import impute_zone as _impute

        df = _impute(df, k=zone_k)
    df = df.fillna({"zone": "Unknown", "police_station": "Unknown"})
    df = clean.fill_medians(df, K.MEDIAN_FILL_COORDS)
    df = clean.clip_to_quantiles(df, ("latitude", "longitude"), 0.01, 0.99, bounds=stats)
    return df


def written_clean(raw: DataFrame, pct: float = 90.0, **how) -> DataFrame:
    """The cleaning stage, written; the retention guard (PF18) stops it if under `pct` % of the rows are left."""
    guard = clean.Retention(pct)
    out = guard.after(materialize(clean_incidents(raw, guard=guard, **how), "labelled"))
    guard.check()
    return out


def labelled_incidents(spark: SparkSession, sf_dir: str, impute_zone: bool = False) -> DataFrame:
    """B1 incidents through the cleaning + labelling stage.

    The stage output is written once per session and input snapshot into the
    shared checkpoint folder (the reference's `cleaned.parquet`); queries read
    that table with column pruning and filter pushdown.
    """
    return stage(
        spark,
        f"labelled-zonefill{int(impute_zone)}",
        bind.source_paths(sf_dir),
        lambda: written_clean(bind.incidents(spark, sf_dir), impute_zone=impute_zone),
    )


def serving_events(df: DataFrame) -> DataFrame:
    """IO7 projection: the 15 published columns, status defaulting to closed."""
    cols = []
    for c in K.SERVING_COLUMNS:
        if c == "status":
            cols.append(F.coalesce(F.col("status"), F.lit("closed")).alias("status") if "status" in df.columns else F.lit("closed").alias("status"))
        elif c in df.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).alias(c))
    keep_id = ["incident_id"] if "incident_id" in df.columns else []
    return df.select(*keep_id, *cols)
