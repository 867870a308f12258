"""ST3's two outputs together hold every actual once, also behind the watermark and after a restart."""

from __future__ import annotations

import collections
import os
import random
import uuid

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from roadpulse.plans import catalog_streams as CS
from roadpulse.session import checkpoint_dir
from roadpulse.streaming import streams as S


def split(sf, folder, files):
    events = pq.read_table(f"{sf}/events.parquet").sort_by("ts")
    size, order = -(-events.num_rows // files), list(range(files))
    random.Random(3).shuffle(order)
    for k, part in enumerate(order):
        path = f"{folder}/events{f'-{k}' if k else ''}.parquet"
        pq.write_table(events.slice(part * size, size), path)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    return events.num_rows


def keys(df):
    return collections.Counter((r["prediction_id"], r["actual_at"]) for r in df.select("prediction_id", "actual_at").collect())


def test_every_actual_is_in_one_output(spark, sf_small, tmp_path):
    n = split(sf_small, tmp_path, 4)
    root = os.path.join(checkpoint_dir(spark), "streams", f"late-{uuid.uuid4().hex[:8]}")
    run = lambda: CS.actuals_both(spark, str(tmp_path), 1, "2 hours", root)
    joined, late, actuals = run()
    matched = joined.where("actual_at is not null")
    emitted, rest = keys(matched), keys(late)
    assert sum(emitted.values()) + sum(rest.values()) == n == actuals.count()
    assert not emitted.keys() & rest.keys() and emitted + rest == keys(actuals)
    reasons = {r["reason"]: r["count"] for r in late.groupBy("reason").count().collect()}
    # files out of order: rows behind the watermark are lost to the join, and kept here
    assert reasons["behind_watermark"] > 0 and reasons["beyond_bound"] > 0 and set(reasons) == {"behind_watermark", "beyond_bound"}
    assert late.where("reason = 'beyond_bound' and abs(prediction_id) % 72 <= 48").count() == 0

    # the last batch of the join and of a log lose their commits: they run again and replace their folders
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    for name in ("joined", "actuals"):
        commits = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/checkpoint/commits")
        last = max(int(s.getPath().getName()) for s in fs.listStatus(commits) if s.getPath().getName().isdigit())
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{commits.toString()}/{last}"), False)
    joined, late, actuals = run()
    again, left = keys(joined.where("actual_at is not null")), keys(late)
    assert again + left == keys(actuals) and sum((again + left).values()) == n
    assert again == emitted and left == rest


def test_reasons(spark):
    p = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00"), (3, "2024-01-05 00:00:00"), (4, "2024-01-01 00:00:00")], "prediction_id long, timestamp string")
    rows = [(1, "2024-01-01 05:00:00"), (1, "2024-01-09 00:00:00"), (2, "2024-01-01 01:00:00"), (3, "2024-01-04 00:00:00"), (9, "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:00"), (4, None)]
    a = spark.createDataFrame(rows, "prediction_id long, actual_at string")
    at = lambda df, c: df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    a = at(a, "actual_at")
    joined = a.where("prediction_id = 1 and day(actual_at) = 1")
    got = {(r["prediction_id"], str(r["actual_at"])): r["reason"] for r in S.late_actuals(at(p, "timestamp"), a, joined).collect()}
    assert got == {
        (1, "2024-01-09 00:00:00"): "beyond_bound", (2, "2024-01-01 01:00:00"): "behind_watermark", (3, "2024-01-04 00:00:00"): "before_prediction",
        (9, "2024-01-01 00:00:00"): "unmatched", (None, "2024-01-01 00:00:00"): "unmatched", (4, "None"): "unmatched",
    }
