"""Streams over one, two and four files, in order and shuffled, equal the batch result (ST2-ST5)."""

from __future__ import annotations

import os
import random

import duckdb
import pandas as pd
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from roadpulse.plans import catalog_streams as CS

# (files, shuffled, files a trigger, lateness)
RUNS = [(2, False, 1, "2 hours"), (4, True, None, "2 hours"), (4, True, 1, "60 days")]
STREAMS = {
    "stream_zone_daily": lambda spark, d, n, late: CS._windows(spark, d, "1 day", None, "t", n, late),
    "stream_actuals_join": CS.actuals_join,
    "stream_drift_daily": CS.drift_daily,
    "stream_prev_severity": CS.prev_severity,
}


def rows(df):
    plain = lambda v: None if pd.isna(v) else round(v, 5) if isinstance(v, float) else v
    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def batch(sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_small}/events.parquet')")
    return {name: rows(con.execute(E.oracle_sql()[name]).df()) for name in STREAMS}


@pytest.mark.parametrize("files,shuffled,per_trigger,lateness", RUNS)
@pytest.mark.parametrize("name", STREAMS)
def test_stream_equals_batch(spark, sf_small, batch, tmp_path, name, files, shuffled, per_trigger, lateness):
    events = pq.read_table(f"{sf_small}/events.parquet").sort_by("ts")
    size, order = -(-events.num_rows // files), list(range(files))
    if shuffled:
        random.Random(3).shuffle(order)
    for k, part in enumerate(order):
        path = f"{tmp_path}/events{f'-{k}' if k else ''}.parquet"
        pq.write_table(events.slice(part * size, size), path)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))  # the source reads older files first
    assert rows(STREAMS[name](spark, str(tmp_path), per_trigger, lateness).toPandas()) == batch[name]


def test_window_state_is_freed(spark, sf_small, tmp_path):
    """In append mode the state of closed windows goes as the watermark moves."""
    from roadpulse.sources import bind
    from roadpulse.streaming import streams as S

    events = pq.read_table(f"{sf_small}/events.parquet").sort_by("ts")
    size = -(-events.num_rows // 4)
    for k in range(4):
        path = f"{tmp_path}/events{f'-{k}' if k else ''}.parquet"
        pq.write_table(events.slice(k * size, size), path)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    stream = S.zone_window_counts(bind.event_incidents_from(S.table_stream(spark, str(tmp_path), "events", 1)), "1 day")
    q = stream.writeStream.outputMode("append").format("noop").option("checkpointLocation", f"{tmp_path}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(p["stateOperators"][0]["numRowsRemoved"] for p in q.recentProgress if p["stateOperators"]) > 0
