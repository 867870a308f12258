"""Spatial clustering (SP1, SP2, WN6) with MLlib KMeans.

KMeans is a distributed estimator (k-means|| init); the fitted centres (k
points) are the only thing on the driver. Labels are not bit-equal to other
implementations, so these operators are checked by invariants.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import mode_by
from .stats import scalar_quantiles

SEED = 42


def _coords(df: DataFrame, fill: dict | None = None) -> DataFrame:
    d = df
    if fill:
        for c, v in fill.items():
            if v is not None:
                d = d.withColumn(c, F.coalesce(F.col(c), F.lit(float(v))))
    return VectorAssembler(inputCols=["latitude", "longitude"], outputCol="_xy", handleInvalid="skip").transform(d)


def fit_clusters(df: DataFrame, k: int = 15, seed: int = SEED, fill_median: bool = True) -> tuple[KMeansModel, dict]:
    """SP1 fit: KMeans on (lat, lon); null coordinates -> the column median."""
    med = scalar_quantiles(df, {"latitude": [0.5], "longitude": [0.5]}) if fill_median else {}
    fill = {"latitude": med.get(("latitude", 0.5)), "longitude": med.get(("longitude", 0.5))} if fill_median else None
    model = KMeans(k=k, seed=seed, featuresCol="_xy", predictionCol="spatial_cluster", maxIter=50).fit(_coords(df, fill))
    return model, fill or {}


def nearest_centre(model: KMeansModel, lat: str = "latitude", lon: str = "longitude") -> F.Column:
    """Cluster index as a column expression: arg-min squared distance to the
    k fitted centres (k literals; ties -> lowest index). No join, no shuffle."""
    items = []
    for i, c in enumerate(model.clusterCenters()):
        d = F.pow(F.col(lat) - F.lit(float(c[0])), 2) + F.pow(F.col(lon) - F.lit(float(c[1])), 2)
        items.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*items))["i"]


def assign_clusters(df: DataFrame, model: KMeansModel, fill: dict | None = None, key: str = "incident_id") -> DataFrame:
    """SP1 predict: (key, spatial_cluster)."""
    d = df.select(key, "latitude", "longitude")
    for c, v in (fill or {}).items():
        if v is not None:
            d = d.withColumn(c, F.coalesce(F.col(c), F.lit(float(v))))
    return d.select(key, nearest_centre(model).cast("int").alias("spatial_cluster"))


def spatial_clusters(df: DataFrame, k: int = 15, seed: int = SEED, key: str = "incident_id") -> DataFrame:
    """SP1 + WN6: cluster label and cluster size per row."""
    model, fill = fit_clusters(df, k, seed)
    lab = assign_clusters(df, model, fill, key)
    sizes = lab.groupBy("spatial_cluster").agg(F.count(F.lit(1)).alias("cluster_density"))
    return lab.join(sizes, "spatial_cluster").select(key, "spatial_cluster", "cluster_density")


def impute_zone(df: DataFrame, k: int = 10, seed: int = SEED, key: str = "incident_id") -> DataFrame:
    """SP2: fill missing zones with the modal zone (ties -> smallest) of their
    spatial cluster, clusters fitted on rows whose zone is known.

    The cluster of each row is an inline nearest-centre expression and the
    cluster -> zone table has k rows, so the row table is never shuffled.
    """
    known = df.where(F.col("zone").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    model = KMeans(k=k, seed=seed, featuresCol="_xy", predictionCol="_zc", maxIter=50).fit(_coords(known))
    zc = nearest_centre(model)
    modal = mode_by(known.select("zone", zc.alias("_zc")), "_zc", "zone").select("_zc", F.col("mode").alias("_zone_fill"))
    out = df.withColumn("_zc", F.when(F.col("zone").isNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), zc))
    out = out.join(F.broadcast(modal), "_zc", "left")  # at most k rows
    return out.withColumn("zone", F.coalesce(F.col("zone"), F.col("_zone_fill"))).drop("_zone_fill", "_zc")
