"""IO rules, rule scoring, as-of join, streaming = batch, spatial invariants."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from roadpulse.operators import score
from roadpulse.sources import io


def test_csv_skips_only_too_long_lines(spark):
    d = tempfile.mkdtemp(prefix="rp-csv-", dir="/tmp")
    header = ",".join(f.name for f in io.INCIDENT_SCHEMA.fields)
    n = len(io.INCIDENT_SCHEMA.fields)
    good = ",".join(["1"] + [""] * (n - 1))
    short = "2,2024-01-01 00:00:00"
    long = ",".join(["3"] + ["x"] * n)
    long_empty = ",".join(["5"] + [""] * n)
    quoted = ",".join(["4", '"a,b"'] + [""] * (n - 2))
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("\n".join([header, good, short, long, long_empty, quoted]) + "\n")
    ids = sorted(r.incident_id for r in io.read_incidents_csv(spark, d).collect())
    assert ids == ["1", "2", "4"]


def test_csv_is_read_by_header(spark):
    """A file with its own order, more columns than the model, `id` and text ids."""
    d = tempfile.mkdtemp(prefix="rp-csv-", dir="/tmp")
    header = ["id", "event_type", "latitude", *[f"more{i}" for i in range(40)], "zone", "start_datetime"]
    n = len(header)
    lines = [
        ",".join(["A1", "planned", "12.5", *["m"] * 40, '"North, old"', "2024-01-01 10:00:00"]),
        ",".join(["A2", "unplanned", "13.5", *[""] * 40, "South"]),  # short
        ",".join(["A3", *["y"] * n]),  # too long
        ",".join(["A4", *[""] * n]),  # too long, the last one empty
        ",".join(["A5", "planned", "not a number", *["m"] * 40, "East", "2024-01-02"]),
    ]
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("\n".join([",".join(header), *lines]) + "\n")
    got = {r.incident_id: r for r in io.read_incidents_csv(spark, d).collect()}
    assert set(got) == {"A1", "A2", "A5"}
    assert (got["A1"].zone, got["A1"].latitude, got["A1"].start_datetime, got["A1"].corridor) == ("North, old", 12.5, "2024-01-01 10:00:00", None)
    assert got["A2"].start_datetime is None and got["A2"].zone == "South" and got["A5"].latitude is None and got["A5"].more0 == "m"


DEMO = [  # the four demo scenarios (F3)
    ("accident", "unplanned", "High", True, 12.9716, 77.5946),
    ("vip_movement", "planned", "High", True, 12.9352, 77.6245),
    ("vehicle_breakdown", "unplanned", "Low", False, 12.9200, 77.5800),
    ("public_event", "unplanned", "High", False, 13.0200, 77.5700),
]


def test_rule_fallback_demo_scenarios(spark):
    req = spark.createDataFrame([(i, *r) for i, r in enumerate(DEMO)], "request_id int, event_cause string, event_type string, priority string, road_closure boolean, lat double, lon double")
    plan = score.resource_plan(score.rule_fallback(req)).orderBy("request_id").collect()
    assert [p.severity_class for p in plan] == [2, 2, 1, 2]
    assert [p.officers_required for p in plan] == [8, 8, 4, 8]
    assert [p.diversion_class for p in plan] == [1, 1, 0, 1]
    assert plan[0].location == "12.9716, 77.5946" and plan[0].predicted_duration_hr == 3.0
    lines = score.action_plan(score.resource_plan(score.rule_fallback(req))).where("request_id = 2").orderBy("line_no").collect()
    assert lines[1].text == "Set up 2 low barricades"
    assert lines[3].text == "Expect incident to last approximately 180 minutes (3.0 hours)"


def test_asof_join_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    hist = [("z", base + dt.timedelta(hours=h), h) for h in (0, 5, 30, 31)] + [("y", base + dt.timedelta(hours=2), 99)]
    req = [(i, "z", base + dt.timedelta(hours=h)) for i, h in enumerate([0, 4, 6, 29, 31, 100])] + [(10, "y", base), (11, "q", base)]
    r = spark.createDataFrame(req, "rid int, zone string, t timestamp_ntz")
    h = spark.createDataFrame(hist, "zone string, ht timestamp_ntz, v int")
    got = {x.rid: x.v for x in score.asof_join(r, h, ["zone"], "t", "ht", ["v"], bucket_us=3600 * 10**6 * 3).collect()}
    assert got == {0: 0, 1: 0, 2: 5, 3: 5, 4: 31, 5: 31, 10: None, 11: None}


def test_stream_prev_severity_equals_batch(spark, sf_small):
    from roadpulse.plans.registry import QUERIES

    s = QUERIES["stream_prev_severity"](spark, sf_small)
    b = QUERIES["event_prev_severity"](spark, sf_small)
    a = {r.incident_id: r.prev_severity for r in s.collect()}
    for r in b.collect():
        assert a[r.incident_id] == r.prev_severity


def test_stream_windows_equal_batch(spark, sf_small):
    from roadpulse.plans.registry import QUERIES
    from roadpulse.sources import bind

    s = QUERIES["stream_zone_daily"](spark, sf_small)
    ev = bind.event_incidents(spark, sf_small)
    b = ev.groupBy("zone", F.date_format(F.date_trunc("day", "start_datetime"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("window_start")).count()
    assert sorted((r.zone, r.window_start, r.events) for r in s.collect()) == sorted((r.zone, r.window_start, r["count"]) for r in b.collect())


def test_zone_imputation_fills_all_located(spark, sf_small):
    from roadpulse.plans import flows

    inc = flows.labelled_incidents(spark, sf_small, impute_zone=True)
    assert inc.where(F.col("zone").isNull()).count() == 0
    known = set(r.zone for r in flows.labelled_incidents(spark, sf_small).select("zone").distinct().collect())
    assert set(r.zone for r in inc.select("zone").distinct().collect()) <= known


def test_spatial_clusters_in_range(spark, sf_small):
    from roadpulse.operators import spatial
    from roadpulse.plans import flows

    c = spatial.spatial_clusters(flows.labelled_incidents(spark, sf_small), k=5)
    r = c.agg(F.min("spatial_cluster"), F.max("spatial_cluster"), F.count(F.lit(1))).first()
    assert 0 <= r[0] and r[1] < 5
    assert c.groupBy("spatial_cluster").agg(F.count(F.lit(1)).alias("n"), F.first("cluster_density").alias("d")).where("n != d").count() == 0
