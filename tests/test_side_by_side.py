"""Targets trained on their own and side by side."""

from __future__ import annotations

import threading

import pytest

from roadpulse.functions import constants as K
from roadpulse.operators import ensembles, train
from roadpulse.plans import catalog_ml


@pytest.fixture(scope="module")
def targets(spark):
    return spark.createDataFrame([tuple(range(len(K.CLASS_TARGETS)))], ", ".join(f"{t} int" for t in K.CLASS_TARGETS))


def test_severity_query_trains_its_own_target_alone(spark, targets, monkeypatch):
    asked = []

    def fake(data, target, sizes, **how):
        asked.append(target)
        table = spark.createDataFrame([(target, "M", 1.0)], "target string, model string, accuracy double")
        return train.TargetResult(target, "M", None, table, table)

    monkeypatch.setattr(train, "train_target", fake)
    monkeypatch.setattr(catalog_ml, "_ml_features", lambda spark, sf: (None, None, targets, None))
    monkeypatch.setattr(catalog_ml, "stage", lambda spark, name, inputs, build: build())
    rows = catalog_ml.q_severity_models(spark, "none").collect()
    assert asked == ["congestion_severity"] and {r["split"] for r in rows} == {"val", "test"}
    asked.clear()
    assert {r["target"] for r in catalog_ml.q_classifier_suite(spark, "none").collect()} == set(K.CLASS_TARGETS)
    assert sorted(asked) == sorted(K.CLASS_TARGETS)


def test_small_targets_are_trained_side_by_side(targets, monkeypatch):
    met = threading.Barrier(len(K.CLASS_TARGETS), timeout=60)

    def fake(data, target, sizes, **how):
        met.wait()  # broken unless all targets are being trained
        return target

    monkeypatch.setattr(train, "train_target", fake)
    assert train.train_classifiers(targets, K.CLASS_TARGETS) == {t: t for t in K.CLASS_TARGETS}


def test_fits_at_once_follow_the_rows():
    assert ensembles.at_once(0) == ensembles.at_once(15_000) == ensembles.MOST_JOBS
    assert ensembles.JOBS < ensembles.at_once(1_000_000) < ensembles.MOST_JOBS
    assert ensembles.at_once(50_000_000) == ensembles.JOBS
