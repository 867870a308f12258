"""Nulls of the feature table are looked for where there may be some."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from roadpulse.functions import constants as K
from roadpulse.operators import clean, features


def test_only_columns_that_may_hold_nulls_are_searched(spark, monkeypatch):
    day = dt.datetime(2024, 3, 1, 9)
    rows = [
        (i, day + dt.timedelta(hours=7 * i) if i % 5 else None, 12.9 + i / 100, 77.5, f"Z{i % 2}", "accident" if i % 3 else None, "unplanned", "High", i % 2 == 0, "PS", "C",
         i % 4, float(10 * i) if i % 4 else None)
        for i in range(20)
    ]
    inc = spark.createDataFrame(rows, "incident_id long, start_datetime timestamp_ntz, latitude double, longitude double, zone string, event_cause string, event_type string, "
                                "priority string, requires_road_closure boolean, police_station string, corridor string, congestion_severity int, duration_min double")
    asked = []

    def spy(df, columns):
        asked.append((df, list(columns)))
        return clean.fill_medians(df, columns)

    monkeypatch.setattr(features, "fill_medians", spy)
    out, _ = features.build_features(inc, leaky=False)
    written, searched = asked[0]
    present = [c for c in K.FEATURE_COLUMNS if c in written.columns]
    assert "hour" not in searched and "is_night" not in searched
    held = {c for c in present if written.where(F.col(c).isNull()).count()}
    assert held and held <= set(searched) < set(present)
    want = clean.fill_medians(written, present)
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
