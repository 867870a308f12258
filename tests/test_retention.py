"""The retention guard tells kept rows by the written tables, and stops the stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import clean
from roadpulse.plans import flows
from roadpulse.session import materialize
from roadpulse.sources import bind


def test_guard_counts_what_is_written(spark):
    guard, df = clean.Retention(), spark.range(1000, numPartitions=7)
    guard.after(materialize(guard.before(materialize(df)).where("id % 20 > 0")))
    assert guard.check() == 95.0 and guard.rows() == (1000, 950)
    low = clean.Retention(96.0)
    low.after(materialize(low.before(materialize(df)).where("id % 20 > 0")))
    with pytest.raises(clean.RetentionError, match="950 of 1000"):
        low.check()


def test_no_rows(spark):
    guard = clean.Retention()
    guard.after(materialize(guard.before(materialize(spark.range(5).where("id > 9")))))
    assert guard.check() == 100.0 and guard.rows() == (0, 0)
    gone = clean.Retention()
    gone.after(materialize(gone.before(materialize(spark.range(5))).where("id > 9")))
    with pytest.raises(clean.RetentionError):
        gone.check()


def test_cleaning_stage_is_guarded(spark, sf_small, monkeypatch):
    raw = bind.incidents(spark, sf_small)
    assert flows.written_clean(raw).count() == raw.count()
    monkeypatch.setattr(clean, "drop_useless", lambda df: df.where(F.col("event_type") == "planned"))
    with pytest.raises(clean.RetentionError):
        flows.written_clean(raw)
