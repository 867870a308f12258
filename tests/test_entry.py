"""Driver contract: entry(), queries() and oracle_sql() on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from roadpulse.sources.bind import TABLES

ROWS_ONLY = {
    "spatial_clusters", "zone_imputation", "oversampled_classes", "severity_models", "classifier_suite",
    "duration_models", "ensemble_metrics", "tuning_trials", "feature_importance", "scored_requests", "request_features",
}
# the SQL-checked queries exercised here (the full set runs in tools/oracle_check.py)
SAMPLE = [
    "zone_severity", "kpis", "cause_counts", "history_page", "describe_incidents", "feature_matrix",
    "classification_metrics", "drift_report", "zone_history_asof", "action_plans", "csv_roundtrip",
]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["zone", "mean_sev", "count"]


def test_every_query_has_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(q) - set(o) - set(E.LLM_QUERIES) == ROWS_ONLY
    assert set(o) <= set(q)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v if isinstance(v, (int, str)) else str(v)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, sf_small, duck, name):
    sdf = E.queries()[name](spark, sf_small).toPandas()
    odf = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    cols = sorted(sdf.columns)

    def rows(df):
        return sorted((tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")), key=repr)

    assert rows(sdf) == rows(odf)
