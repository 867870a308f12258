"""Training: balancing, candidates, votes and stacks, saved winners, model scoring."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import ensembles, metrics, train
from roadpulse.session import checkpoint_dir

FEATURES = ["a", "b", "c"]
TINY = train.Sizes(trees=4, gbt_iter=2, depth=3, step=0.3)


def folder(spark):
    return os.path.join(checkpoint_dir(spark), f"test-{uuid.uuid4().hex}")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(900):
        label = int(rng.choice([0, 1, 2], p=[0.65, 0.25, 0.10]))
        a, b, c = rng.normal(size=3) + [2.0 * label, -label, 0]
        rows.append((i, label, float(a), float(b), float(c)))
    rows += [(i, None, 0.0, 0.0, 0.0) for i in range(900, 905)]
    return spark.createDataFrame(rows, "incident_id long, kind int, a double, b double, c double").repartition(3).cache()


@pytest.fixture(scope="module")
def result(spark, data):
    return train.train_target(data, "kind", TINY, features=FEATURES, folds=3, path=folder(spark))


def test_all_candidates_compete(result):
    rows = {r["model"]: r["balanced_accuracy"] for r in result.val_metrics.collect()}
    assert set(rows) == {"RandomForest", "BalancedRF", "GradientBoost", "VotingEnsemble", "StackingEnsemble"}
    best = max(rows.values())
    assert result.best_model == min(n for n, v in rows.items() if v == best) and best > 0.6
    assert [r["model"] for r in result.test_metrics.collect()] == [result.best_model]


def test_balance_choices(data):
    rows = data.where("kind is not null").withColumn("label", F.col("kind").cast("double"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    counts = lambda how: {r["label"]: r["count"] for r in train.balanced(rows, how, "incident_id", FEATURES).groupBy("label").count().collect()}
    assert counts("weight") == sizes
    assert set(counts("interpolate").values()) == {max(sizes.values())}
    assert all(abs(n - max(sizes.values())) < 0.15 * max(sizes.values()) for n in counts("oversample").values())
    weights = train.balanced(rows, "interpolate", "incident_id", FEATURES).agg(F.min("weight"), F.max("weight")).first()
    assert weights[0] == weights[1] == 1.0
    with pytest.raises(ValueError):
        train.balanced(rows, "none", "incident_id", FEATURES)


def test_vote_is_the_mean_of_its_members(result, data):
    vote = result.models["VotingEnsemble"]
    rows = data.where("kind is not null").limit(200)
    got = {r["incident_id"]: r for r in vote.predict(rows).collect()}
    parts = [{r["incident_id"]: r["prob"] for r in result.models[m].predict(rows).collect()} for m in vote.members]
    assert len(parts) == 3
    for i, r in got.items():
        want = np.mean([p[i] for p in parts], axis=0)
        assert np.allclose(r["prob"], want, atol=1e-8) and r["prediction"] == np.argmax(np.round(want, 9))
    assert set(vote.predict(rows).columns) == {*rows.columns, "prob", "prediction"}
    # as the vote over score tables says
    scored = [train.scored_rows(result.models[m].predict(rows), "incident_id", "kind", m, "kind") for m in vote.members]
    table = metrics.soft_vote(scored[0].unionByName(scored[1]).unionByName(scored[2]))
    assert {r["incident_id"]: r["prediction"] for r in table.collect()} == {i: int(r["prediction"]) for i, r in got.items()}


def test_out_of_fold_scores(spark, data):
    """Each row once a member, by a model of the other folds; a second run fits only what is missing."""
    rows = train.balanced(data.where("kind is not null").withColumn("label", F.col("kind").cast("double")), "interpolate", "incident_id", FEATURES).cache()
    members = {n: e for n, e in train.classifiers(3, TINY).items() if n != "GradientBoost"}
    path = folder(spark)
    oof = ensembles.out_of_fold(rows, members, 3, path, folds=3, features=FEATURES)
    assert oof.count() == 2 * rows.count() == oof.select("incident_id", "synthetic", "member").distinct().count()
    assert oof.groupBy("incident_id").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert oof.where(F.abs(F.aggregate("prob", F.lit(0.0), lambda a, b: a + b) - 1) > 1e-6).count() == 0
    model = ensembles.PipelineModel.load(f"{path}/models/fold=1/RandomForest")
    part = rows.join(oof.where("fold = 1 and member = 'RandomForest'").select("incident_id", "synthetic", F.col("prob").alias("told")), ["incident_id", "synthetic"])
    again = ensembles._probabilities(model, part, "p", 3)
    assert part.count() > 0 and again.where(F.exists(F.arrays_zip("p", "told"), lambda x: F.abs(x["p"] - x["told"]) > 1e-9)).count() == 0

    def stamp():
        conf, at = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path(path)
        fs, out = at.getFileSystem(conf), {}
        walk = fs.listFiles(at, True)
        while walk.hasNext():
            f = walk.next()
            out[f.getPath().toString()] = f.getModificationTime()
        return fs, out

    fs, before = stamp()
    lost = f"{path}/scores/fold=2/member=BalancedRF"
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(lost), True)
    twice = ensembles.out_of_fold(rows, members, 3, path, folds=3, features=FEATURES)
    assert twice.count() == 2 * rows.count()
    after = stamp()[1]
    assert {f for f in before if before[f] != after.get(f)} == {f for f in before if "fold=2/member=BalancedRF" in f}


def test_saved_models_predict_alike(spark, result, data):
    rows = data.where("kind is not null").limit(150)
    for name in ("StackingEnsemble", "VotingEnsemble", "GradientBoost"):
        path = folder(spark)
        result.models[name].save(spark, path)
        back = ensembles.Classifier.load(spark, path)
        want = {r["incident_id"]: (r["prob"], r["prediction"]) for r in result.models[name].predict(rows).collect()}
        assert {r["incident_id"]: (r["prob"], r["prediction"]) for r in back.predict(rows).collect()} == want
    path = folder(spark)
    single = result.models["RandomForest"].members["RandomForest"]
    train.save_model(single, path)
    assert [r["prediction"] for r in train.load_model(path).transform(rows).orderBy("incident_id").collect()] == [r["prediction"] for r in single.transform(rows).orderBy("incident_id").collect()]


def test_winners_score_requests(spark, result):
    """Ensembles and single models score requests; absent models leave the rule's answer."""
    from roadpulse.operators import serving

    rows = [(i, "accident", "High", True, 12.97, 77.59, float(i % 5), -float(i % 3), 0.5) for i in range(40)]
    req = spark.createDataFrame(rows, "incident_id long, event_cause string, priority string, road_closure boolean, lat double, lon double, a double, b double, c double")
    want = {r["incident_id"]: int(r["prediction"]) for r in result.models["StackingEnsemble"].predict(req).collect()}
    got = serving.score_requests(req, {"congestion_severity": result.models["StackingEnsemble"], "diversion_req": result.models["RandomForest"]}, None).collect()
    assert {r["request_id"]: r["severity_class"] for r in got} == want
    rule = {r["request_id"]: r["manpower_class"] for r in serving.score_requests(req, {}, None).collect()}
    assert {r["request_id"]: r["manpower_class"] for r in got} == rule
    assert all(0 <= r["severity_confidence"] <= 100 for r in got)
