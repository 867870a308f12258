"""Work and memory that must not grow faster than the rows."""

from __future__ import annotations

from roadpulse.operators import labels, metrics


def test_soft_vote_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(metrics, "VOTE_ROWS", 100)
    rows = [(i, "t", m, [0.2 * (i % 4), 1 - 0.2 * (i % 4)]) for i in range(500) for m in ("a", "b")]
    df = spark.createDataFrame(rows, "incident_id long, target string, model string, probability array<double>")
    voted = metrics.soft_vote(df)
    assert voted.rdd.getNumPartitions() == 10
    got = {r["incident_id"]: (r["prediction"], round(r["confidence"], 9)) for r in voted.collect()}
    assert got == {i: (int(0.2 * (i % 4) < 0.5), round(max(0.2 * (i % 4), 1 - 0.2 * (i % 4)), 9)) for i in range(500)}
    assert metrics.soft_vote(df.limit(0)).count() == 0


def test_severity_computes_the_score_once(spark):
    rows = [(" Accident ", "High", "planned", False, 60.0), ("others", None, None, None, None), ("pot_holes", "Low", "unplanned", False, 121.0), ("others", "Low", "planned", True, 10.0)]
    df = spark.createDataFrame(rows, "event_cause string, priority string, event_type string, requires_road_closure boolean, duration_min double")
    got = labels.add_severity(df.coalesce(1))
    assert [r["congestion_severity"] for r in got.collect()] == [3, 0, 2, 3] and got.columns == [*df.columns, "congestion_severity"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("greatest(") == 1
