"""Publication: staged versions, quarantine, failed and repeated runs."""

from __future__ import annotations

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from roadpulse.session import checkpoint_dir
from roadpulse.sources import publish as P

SCHEMA = "incident_id long, start_datetime string, zone string, latitude double, duration_min string, requires_road_closure string, congestion_severity string, extra int"
ROWS = [
    (1, "2024-01-05 10:00:00", "A", 12.5, "30", "true", "2", 1),
    (2, "2024-02-05 10:00:00", None, float("nan"), None, "false", None, 1),
    (3, "not a time", "A", 1.0, "5", "true", "1", 1),
    (4, "2024-02-06 00:00:00", "B", None, "long", "maybe", "3", None),
    (None, "2024-02-07 00:00:00", "B", 1.0, "1", "true", "0", 1),
    (5, None, "C", 1.0, "1.5", None, "1", 1),
    (5, None, "C", 1.0, "1.5", None, "1", 1),
]


def place(spark):
    return os.path.join(checkpoint_dir(spark), f"serving-{uuid.uuid4().hex}")


def ids(df):
    return sorted(r["incident_id"] for r in df.collect())


def test_rows_are_published_or_quarantined(spark):
    path = place(spark)
    got = P.publish(spark.createDataFrame(ROWS, SCHEMA).repartition(3), path)
    assert (got.version, got.rows, got.published, got.quarantined) == (1, 7, 4, 3)
    rows = {r["incident_id"]: r for r in P.read_published(spark, path).collect()}
    assert set(rows) == {1, 2, 5} and rows[2]["latitude"] is None and rows[1]["duration_min"] == 30.0 and rows[1]["status"] == "closed"
    assert {"extra", "quarantined", "original"}.isdisjoint(rows[1].asDict()) and dict(P.read_published(spark, path).dtypes)["start_datetime"] == "timestamp_ntz"
    bad = {r["incident_id"]: r for r in P.read_quarantine(spark, path).collect()}
    assert {i: r["reasons"] for i, r in bad.items()} == {3: ["bad start_datetime"], 4: ["bad requires_road_closure", "bad duration_min"], None: ["no incident_id"]}
    assert json.loads(bad[4]["original"])["duration_min"] == "long"
    plan = P.read_published(spark, path).where("start_month = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "start_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_failed_run_leaves_the_version_before(spark):
    path, df = place(spark), spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError):
        P.read_published(spark, path)
    P.publish(df.where("incident_id < 3"), path, "first")
    broken = df.withColumn("zone", F.when(F.col("incident_id") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("zone")))
    with pytest.raises(Exception, match="broken"):
        P.publish(broken, path, "second")
    assert ids(P.read_published(spark, path)) == [1, 2] and [p.run for p in P.manifests(spark, path)] == ["first"]
    # run again under its name, in full
    assert P.publish(df, path, "second").version == 2
    assert ids(P.read_published(spark, path)) == [1, 2, 5, 5] and ids(P.read_published(spark, path, 1)) == [1, 2]
    # once published, a run's name changes nothing
    assert P.publish(df.limit(0), path, "second").rows == 7 and len(P.manifests(spark, path)) == 2


def test_nothing_to_publish(spark):
    path = place(spark)
    assert P.publish(spark.createDataFrame(ROWS, SCHEMA), path).version == 1
    empty = P.publish(spark.createDataFrame([], SCHEMA), path)
    assert (empty.version, empty.rows) == (2, 0)
    assert P.read_published(spark, path).count() == 0 and P.read_quarantine(spark, path).count() == 0
