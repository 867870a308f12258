"""Source / sink round-trip queries (IO1, IO3, IO4, IO7, IO9)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics
from ..session import checkpoint_dir
from ..sources import bind, io, publish
from .catalog import register
from .catalog_features import rounded


def _scratch(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "io", f"{name}-{uuid.uuid4().hex[:8]}")


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    """IO1 + IO3: incidents with text ids, written as CSV in another order of
    columns, with a further column, and read back by header."""
    raw = bind.incidents(spark, sf)
    path = _scratch(spark, "incidents-csv")
    first = ["zone", "event_cause", "latitude"]
    rest = [c for c in raw.columns if c not in first and c != "incident_id"]
    out = raw.select(*first, F.lit("x, y").alias("remark"), F.concat(F.lit("INC"), F.col("incident_id").cast("string")).alias("id"), *rest)
    io.write_incidents_csv(out, path)
    return io.read_incidents_csv(spark, path)


@register("metrics_report")
def q_metrics_report(spark, sf):
    """IO4 + IO9: the metric table as long report rows, through JSON and back."""
    m = metrics.evaluation_table(bind.scored(spark, sf))
    long = io.metrics_long(m, "classification_results", "test", ["accuracy", "balanced_accuracy", "f1", "roc_auc", "cohen_kappa"])
    path = _scratch(spark, "report-json")
    io.write_report(long, path)
    return rounded(io.read_report(spark, path))


@register("published_events")
def q_published_events(spark, sf):
    """IO7: serving table written partitioned by month, read back with a
    month filter that prunes partitions."""
    from . import flows

    inc = flows.labelled_incidents(spark, sf)
    path = _scratch(spark, "serving")
    io.publish_events(inc, path)
    t = io.read_table(spark, path)
    return t.where(F.col("start_month") >= "1998-01").groupBy("start_month", "status").agg(F.count(F.lit(1)).alias("events"))


def _unchecked(inc: DataFrame) -> DataFrame:
    """The cleaned incidents as a feed of text that isn't checked yet: some values don't fit, some ids are missing."""
    n = F.col("incident_id")
    return inc.withColumn("duration_min", F.when(n % 97 == 0, "unknown").otherwise(F.col("duration_min").cast("string"))).withColumn(
        "congestion_severity", F.when(n % 89 == 0, "severe").otherwise(F.col("congestion_severity").cast("string"))
    ).withColumn("incident_id", F.when(n % 83 != 0, n))


@register("published_version")
def q_published_version(spark, sf):
    """IO7: an unchecked feed published as a version; its rows by month, read through the manifest."""
    from . import flows

    path = _scratch(spark, "publication")
    publish.publish(_unchecked(flows.labelled_incidents(spark, sf)), path)
    t = publish.read_published(spark, path).groupBy("start_month", "status")
    return t.agg(F.count(F.lit(1)).alias("events"), F.sum("congestion_severity").alias("severity"), F.round(F.sum("duration_min"), 3).alias("minutes"))


@register("quarantined_events")
def q_quarantined_events(spark, sf):
    """IO7: the rows of the same feed that don't fit the serving table, by reasons."""
    from . import flows

    path = _scratch(spark, "publication")
    publish.publish(_unchecked(flows.labelled_incidents(spark, sf)), path)
    return publish.read_quarantine(spark, path).groupBy(F.array_join("reasons", ", ").alias("reasons")).agg(F.count(F.lit(1)).alias("rows"))
