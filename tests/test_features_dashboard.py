"""Time features, dashboard aggregates and their edge cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from roadpulse.operators import dashboard, features, profile


def test_time_features_null_and_iso_week(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 12, 30, 22, 15))], "incident_id int, start_datetime timestamp_ntz")
    r = {x.incident_id: x for x in features.add_time_features(df).collect()}
    n = r[1]
    assert (n.hour, n.minute, n.day, n.weekday, n.month, n.week_of_year, n.is_night) == (0, 0, 1, 0, 1, 1, 1)
    m = r[2]
    assert (m.weekday, m.week_of_year, m.is_night, m.is_peak, m.time_since_midnight) == (0, 1, 1, 0, 22 * 3600 + 15 * 60)


def test_haversine_zero_at_centre(spark):
    df = spark.createDataFrame([(12.9716, 77.5946), (13.0716, 77.5946)], "latitude double, longitude double")
    d = [r.d for r in df.select(features.haversine_km("latitude", "longitude").alias("d")).collect()]
    assert abs(d[0]) < 1e-9 and abs(d[1] - 11.119) < 0.01


def test_duration_histogram_buckets(spark):
    df = spark.createDataFrame([(29.9,), (30.0,), (1439.0,), (1440.0,), (9999.0,), (None,)], "duration_min double")
    got = {r.duration: r["count"] for r in dashboard.duration_histogram(df).collect()}
    assert got == {0: 1, 30: 1, 1410: 1, 1440: 2}


def test_kpis_zero_rows_and_unknown_zone(spark):
    empty = spark.createDataFrame([], "congestion_severity int, requires_road_closure boolean, status string, duration_min double")
    k = dashboard.kpis(empty).first()
    assert k.total_events == 0 and k.avg_severity is None
    z = spark.createDataFrame([(None, 1), ("", 3), ("A", 2)], "zone string, congestion_severity int")
    rows = {r.zone: (r.mean_sev, r["count"]) for r in dashboard.zone_severity(z).collect()}
    assert rows == {"Unknown": (2.0, 2), "A": (2.0, 1)}  # Q19: one Unknown row


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", "a"), ("h", "z")], "g string, v string")
    got = {r.g: (r.mode, r.freq) for r in profile.mode_by(df, "g", "v").collect()}
    assert got == {"g": ("a", 2), "h": ("z", 1)}


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, 6.1)], "a double, c double, b double")
    got = {(r.col_a, r.col_b): r.corr for r in profile.correlation_pairs(df, ["a", "c", "b"]).collect()}
    assert got[("a", "c")] is None and got[("c", "b")] is None  # Q16
    import numpy as np

    assert abs(got[("a", "b")] - np.corrcoef([1.0, 2.0, 3.0], [2.0, 4.0, 6.1])[0, 1]) < 1e-12


def test_equal_width_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    got = {r.bin: r["count"] for r in profile.equal_width_histogram(df, "x", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 1, 3: 0, 4: 1}
    assert sum(got.values()) == 6


def test_repartition_invariance(spark, sf_small):
    from roadpulse.plans import flows

    inc = flows.labelled_incidents(spark, sf_small)
    a = sorted(dashboard.zone_severity(inc).collect())
    b = sorted(dashboard.zone_severity(inc.repartition(13, F.rand(3))).collect())
    assert a == b


def test_describe_categorical_ties_and_all_null_column(spark):
    from roadpulse.operators import profile

    rows = [("b", None, 1.0), ("a", None, 2.0), ("b", None, 3.0), ("a", None, None), (None, None, 5.0)]
    df = spark.createDataFrame(rows, "c string, z string, x double")
    got = {r.column: r for r in profile.describe_all(df, ["x"], ["c", "z"]).collect()}
    # 'a' and 'b' both appear twice: the tie goes to the smallest value
    assert (got["c"]["count"], got["c"]["unique"], got["c"]["top"], got["c"]["freq"]) == (4, 2, "a", 2)
    # an all-null column is still reported
    assert (got["z"]["count"], got["z"]["unique"], got["z"]["top"], got["z"]["freq"]) == (0, 0, None, None)
    assert got["x"]["count"] == 4 and got["x"]["q50"] == 2.5
    same = {r.column: r for r in profile.describe_all(df, ["x"], ["c", "z"]).collect()}
    assert same == got


def test_correlation_pairwise_complete_and_empty_input(spark):
    import pandas as pd

    rows = [(1.0, 2.0, None), (2.0, None, 1.0), (3.0, 7.0, 2.0), (4.0, 1.0, 5.0), (None, 3.0, 3.0), (6.0, 2.5, 8.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.corr for r in profile.correlation_pairs(df, ["a", "b", "c"]).collect()}
    want = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()  # pandas: pairwise-complete Pearson
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    for (x, y), r in got.items():
        assert abs(r - want.loc[x, y]) < 1e-12
    empty = profile.correlation_pairs(df.limit(0), ["a", "b", "c"]).collect()
    assert len(empty) == 3 and all(r.corr is None for r in empty)


def test_correlation_of_many_columns_equals_pandas(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(11)
    x = rng.normal(1e6, 1.0, (600, 14)) + rng.normal(0, 1, (600, 1))
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 5] = np.where(np.isnan(x[:, 5]), np.nan, 0.1)  # constant, not a binary fraction
    x[:, 6] = np.nan
    x[:, 7] = np.where(np.arange(600) < 598, np.nan, x[:, 7])  # at most two values
    cols = [f"c{i}" for i in range(14)]
    pdf = pd.DataFrame(x, columns=cols)
    df = spark.createDataFrame(pdf).repartition(5)  # NaN
    nulls = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(3)
    want = pdf.corr()
    for frame in (df, nulls):
        got = {(r.col_a, r.col_b): r["corr"] for r in profile.correlation_pairs(frame, cols).collect()}
        assert len(got) == 14 * 13 // 2
        for (a, b), r in got.items():
            if "c5" in (a, b) or np.isnan(want.loc[a, b]):
                assert r is None
            else:
                assert abs(r - want.loc[a, b]) < 1e-9
