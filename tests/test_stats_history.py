"""Distributed exact statistics and skew-safe windows vs brute force."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadpulse.operators import history, stats


def test_exact_quantiles_match_numpy(spark):
    rng = random.Random(5)
    rows = []
    for g in ["a", "b", None]:
        n = {"a": 1000, "b": 7, None: 50}[g]
        for _ in range(n):
            v = rng.choice([None, float(rng.randint(0, 40)), rng.random() * 100])
            rows.append((g, v))
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {r.g: r for r in stats.exact_quantiles(df, "v", probs, by=["g"], names=[f"p{i}" for i in range(len(probs))]).collect()}
    for g in ["a", "b", None]:
        vals = np.array([v for gg, v in rows if gg == g and v is not None])
        for i, p in enumerate(probs):
            assert abs(got[g][f"p{i}"] - np.quantile(vals, p)) < 1e-9, (g, p)


def test_scalar_quantiles_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    q = stats.scalar_quantiles(df, {"x": [0.5]})
    assert q[("x", 0.5)] == 1.5
    empty = spark.createDataFrame([(None,)], "x double")
    assert stats.scalar_quantiles(empty, {"x": [0.5]})[("x", 0.5)] is None


def test_dense_index_alphabetical(spark):
    vals = ["b", "a", "Unknown", "c", "a", "B"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    df = df.withColumn("w", F.concat(F.lit("x"), "v"))
    got = {(r.column, r.value): r.idx for r in stats.dense_index_multi(df, ["v", "w"]).collect()}
    want = {("v", v): i for i, v in enumerate(sorted(set(vals)))}
    assert got == want | {("w", "x" + v): i for (_, v), i in want.items()}
    assert stats.dense_index_multi(df.limit(0), ["v"]).count() == 0


def _events(rows):
    return [(i, z, t) for i, (z, t) in enumerate(rows)]


def test_trailing_count_fixture(spark):
    d1 = dt.datetime(2024, 1, 1)
    rows = _events([("z", d1), ("z", d1 + dt.timedelta(days=1)), ("y", d1), ("y", d1 + dt.timedelta(hours=23, minutes=59))])
    df = spark.createDataFrame(rows, "incident_id long, zone string, start_datetime timestamp_ntz")
    got = {r.incident_id: r.c for r in history.trailing_counts(df, ["zone"], "start_datetime", {"c": history.DAY_US}).collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 1.0, 3: 2.0}  # left end open; within a day counts 2


def test_bucketed_windows_equal_plain_windows_with_hot_key(spark):
    rng = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        z = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c"])
        t = None if rng.random() < 0.03 else base + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 20) // 7 * 7)
        rows.append((i, z, t, rng.randint(0, 3)))
    df = spark.createDataFrame(rows, "incident_id long, zone string, start_datetime timestamp_ntz, sev int")
    widths = {"w1": history.DAY_US, "w7": 7 * history.DAY_US}
    got = history.trailing_counts(df, ["zone"], "start_datetime", widths, bucket_us=history.HOUR_US * 6)
    t = F.unix_micros(F.col("start_datetime").cast("timestamp"))
    exp = df.where(F.col("start_datetime").isNotNull()).select(
        "incident_id",
        *[F.count(F.lit(1)).over(Window.partitionBy("zone").orderBy(t).rangeBetween(-(w - 1), 0)).cast("double").alias(n) for n, w in widths.items()],
    )
    g = {r.incident_id: (r.w1, r.w7) for r in got.collect()}
    for r in exp.collect():
        assert g[r.incident_id] == (r.w1, r.w7)
    # previous value and prior mean vs plain windows
    order = [F.col("start_datetime").asc_nulls_last(), F.col("incident_id")]
    w = Window.partitionBy("zone").orderBy(*order)
    pv = history.previous_value(df, ["zone"], "start_datetime", "incident_id", "sev", "prev", bucket_us=history.HOUR_US * 6)
    pe = df.select("incident_id", F.lag("sev").over(w).alias("prev"))
    assert sorted(pv.select("incident_id", "prev").collect()) == sorted(pe.collect())
    pm = history.prior_mean(df, ["zone"], "start_datetime", "incident_id", "sev", "pm", bucket_us=history.HOUR_US * 6)
    pme = df.select("incident_id", F.avg("sev").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("pm"))
    a = {r.incident_id: r.pm for r in pm.collect()}
    for r in pme.collect():
        assert (a[r.incident_id] is None and r.pm is None) or abs(a[r.incident_id] - r.pm) < 1e-9


def test_prefix_sums_before(spark):
    rows = [("g", float(v), 1) for v in range(100)] + [("h", 5.0, 3)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    for slices in (None, 7):
        got = {(r.g, r.v): r._before_n for r in stats.prefix_sums_before(df, ["g"], "v", ["n"], slices=slices).collect()}
        assert got[("g", 0.0)] == 0 and got[("g", 50.0)] == 50 and got[("g", 99.0)] == 99 and got[("h", 5.0)] == 0


def test_quantiles_do_not_depend_on_the_slices(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), float(rng.randint(0, 500)) if rng.random() > 0.1 else rng.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs, names = [0.0, 0.3, 0.5, 0.99, 1.0], list("abcde")

    def run(slices=None):
        return sorted((tuple(r) for r in stats.exact_quantiles(df, "v", probs, ["g"], names, slices=slices).collect()), key=repr)

    few, many = run(2), run(31)
    monkeypatch.setattr(stats, "SLICE_ROWS", 40)  # slices follow the widest group
    for x, y, z in zip(few, many, run()):
        assert x == y == z
        values = [v for g, v in rows if g == x[0]]
        assert np.allclose(x[1:], np.quantile(values, probs))


def test_history_with_text_ids(spark):
    rng = random.Random(12)
    base = dt.datetime(2024, 1, 1)
    rows = [(f"ID{rng.randrange(10**6):06d}x{i}", rng.choice(["a", None, "b"]), None if rng.random() < 0.2 else base + dt.timedelta(hours=rng.randrange(200)), rng.randint(0, 3)) for i in range(600)]
    df = spark.createDataFrame(rows, "incident_id string, zone string, start_datetime timestamp_ntz, sev int")
    got = {r.incident_id: r for r in history.trailing_counts(df, ["zone"], "start_datetime", {"w": history.DAY_US}).collect()}
    assert len(got) == len(rows)
    for i, z, t, _ in rows:
        want = None if t is None else float(sum(zz == z and tt is not None and t - dt.timedelta(days=1) < tt <= t for _, zz, tt, _ in rows))
        assert got[i].w == want
    before = {r.incident_id: r.p for r in history.previous_value(df.where("zone is not null"), ["zone"], "start_datetime", "incident_id", "sev", "p").collect()}
    for z in ("a", "b"):
        own = sorted((r for r in rows if r[1] == z), key=lambda r: (r[2] is None, r[2] or base, r[0]))
        assert [before[r[0]] for r in own] == [None, *[r[3] for r in own[:-1]]]


def test_folds_are_even_inside_splits_and_samples(spark):
    from roadpulse.operators import train

    df = spark.range(1, 60_001).select(F.concat(F.lit("k"), "id").alias("k"))
    split, fold = train.split_column("k"), train.fold_column("k", 5)
    for part in (df.where(split == "train"), df.where(train.unit_hash("k", 3) < 0.7)):
        counts = [r["count"] for r in part.groupBy(fold.alias("f")).count().collect()]
        n = sum(counts)
        assert len(counts) == 5 and max(abs(c - n / 5) for c in counts) < 0.03 * n


def test_stratified_split_by_class(spark):
    from roadpulse.operators import train

    df = spark.range(3000).select("id", F.when(F.col("id") % 100 == 0, 2).when(F.col("id") % 3 == 0, 1).otherwise(0).alias("y"))
    got = {(r.y, r.split): r["count"] for r in train.stratified_split(df, "y", "id").groupBy("y", "split").count().collect()}
    for y in (0, 1, 2):
        n = sum(got[y, s] for s in ("train", "val", "test"))
        for s, share in (("train", 0.7), ("val", 0.15), ("test", 0.15)):
            assert abs(got[y, s] - share * n) <= 0.01 * n + 1
