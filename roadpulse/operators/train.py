"""Model training, selection and scoring with MLlib (ML1–ML4, ML7–ML10,
ML16, ML19, IO10).

Every fit is a distributed MLlib estimator; the driver only loops over a
handful of candidate estimators and reads back small metric tables. Metrics
come from `metrics` (relational, identical for every model type).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import checkpoint_dir, materialize
from . import ensembles, metrics
from .balance import interpolate

SEED = 42


# ------------------------------------------------------------------ ML1 split
def unit_hash(key: str, salt: int = 0) -> F.Column:
    """Portable uniform [0, 1) value of a key of any type: 32 bits of the md5 of
    its text and the salt (the same in any SQL engine). Values under different
    salts are independent, so folds are even inside splits and samples."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def split_column(key: str, train: float = 0.70, val: float = 0.15, salt: int = 0) -> F.Column:
    """ML1: 'train' / 'val' / 'test' by key hash; no shuffle, no window.

    Every row draws independently: a class is split in these proportions in
    expectation only (`stratified_split` does it by count).
    """
    u = unit_hash(key, salt)
    return F.when(u < train, "train").when(u < train + val, "val").otherwise("test")


def stratified_split(df: DataFrame, label: str, key: str, train: float = 0.70, val: float = 0.15, salt: int = 0) -> DataFrame:
    """ML1: 'train' / 'val' / 'test' in these proportions within every class.

    The cut points are exact quantiles of the key hash by class (two numbers a
    class, joined back), so a rare class reaches every split it has rows for.
    """
    from .stats import exact_quantiles

    d = df.withColumn("_u", unit_hash(key, salt))
    cuts = exact_quantiles(d, "_u", [train, train + val], by=[label], names=["_t1", "_t2"]).withColumnRenamed(label, "_label")
    d = d.join(cuts, F.col(label).eqNullSafe(F.col("_label")))
    split = F.when(F.col("_u") <= F.col("_t1"), "train").when(F.col("_u") <= F.col("_t2"), "val").otherwise("test")
    return d.withColumn("split", split).drop("_u", "_label", "_t1", "_t2")


def fold_column(key: str, k: int, salt: int = 7) -> F.Column:
    """ML16: fold id 0..k-1 by key hash."""
    return F.least(F.floor(unit_hash(key, salt) * k).cast("int"), F.lit(k - 1))


# ------------------------------------------------------------------ ML2 balancing
def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """ML2a/ML3: 'balanced' weights n / (n_classes * n_class) as a column."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = counts.crossJoin(F.broadcast(tot)).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(name))
    return df.join(w, label, "left")


def oversample(df: DataFrame, label: str, key: str = "incident_id", salt: int = SEED, copy: str | None = None) -> DataFrame:
    """ML2b: grow every class to the size of the largest by replication.

    Each row is repeated floor(r) times plus once more with probability
    frac(r), r = max_count / class_count (an expected-count balance; no row
    is dropped). The draw is the key's hash, so a task that runs again gives
    the same rows. Replication is a per-row explode, no shuffle. ``copy`` names
    a column for the number of the copy (0 for the row itself).
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    mx = counts.agg(F.max("_nc").alias("_mx"))
    ratio = counts.crossJoin(F.broadcast(mx)).select(label, (F.col("_mx") / F.col("_nc")).alias("_r"))
    d = df.join(ratio, label, "left")
    extra = (unit_hash(key, salt) < (F.col("_r") - F.floor("_r"))).cast("int")
    reps = (F.floor("_r").cast("int") + extra)
    d = d.withColumn(copy or "_rep", F.explode(F.sequence(F.lit(0), F.greatest(reps, F.lit(1)) - 1)))
    return d.drop("_r", "_rep")


# ------------------------------------------------------------------ estimators (ML3, ML4, ML9)
@dataclass
class Sizes:
    """Model sizes; the defaults follow the original settings."""

    trees: int = 200
    gbt_iter: int = 200
    depth: int = 6
    step: float = 0.05
    subsample: float = 0.8
    feature_subset: str = "0.8"


def assembler(features: Sequence[str] = K.FEATURE_COLUMNS) -> VectorAssembler:
    """EN4: ordered feature vector."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def classifiers(n_classes: int, sizes: Sizes = Sizes(), label: str = "label") -> dict:
    """ML3/ML4 candidates (bagged trees weighted, boosted trees)."""
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=sizes.trees, weightCol="weight", seed=SEED, maxDepth=min(sizes.depth * 2, 16))
    brf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=sizes.trees, weightCol="weight", seed=SEED + 1,
                                 subsamplingRate=0.632, featureSubsetStrategy="sqrt", maxDepth=min(sizes.depth * 2, 16))
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=sizes.gbt_iter, maxDepth=sizes.depth, stepSize=sizes.step,
                        subsamplingRate=sizes.subsample, featureSubsetStrategy=sizes.feature_subset, seed=SEED, weightCol="weight")
    boosted = gbt if n_classes <= 2 else OneVsRest(classifier=gbt, labelCol=label, featuresCol="features", weightCol="weight", parallelism=n_classes)
    return {"RandomForest": rf, "BalancedRF": brf, "GradientBoost": boosted}


def regressors(sizes: Sizes = Sizes(), label: str = "label") -> dict:
    """ML9 candidates."""
    return {
        "GradientBoosting": GBTRegressor(labelCol=label, featuresCol="features", maxIter=sizes.gbt_iter, maxDepth=sizes.depth - 1,
                                         stepSize=sizes.step, seed=SEED),
        "BoostedSubsampled": GBTRegressor(labelCol=label, featuresCol="features", maxIter=sizes.gbt_iter, maxDepth=sizes.depth,
                                          stepSize=sizes.step, subsamplingRate=sizes.subsample, featureSubsetStrategy=sizes.feature_subset, seed=SEED),
        "RandomForest": RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=sizes.trees, seed=SEED),
    }


# ------------------------------------------------------------------ probabilities
def probability_array(pred: DataFrame, n_classes: int | None = None) -> DataFrame:
    """Class-probability array for any fitted classifier output.

    OneVsRest over GBT yields raw margins only: p_k = 1/(1+exp(-2 m_k)),
    renormalised to sum to 1.
    """
    if "probability" in pred.columns:
        return pred.withColumn("prob", vector_to_array("probability"))
    raw = vector_to_array("rawPrediction")
    s = F.transform(raw, lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * m)))
    d = pred.withColumn("_s", s)
    tot = F.aggregate(F.col("_s"), F.lit(0.0), lambda a, b: a + b)
    return d.withColumn("prob", F.transform(F.col("_s"), lambda x: x / tot)).drop("_s")


def scored_rows(pred: DataFrame, key: str, target: str, model: str, label: str = "label") -> DataFrame:
    """F6 rows (key, target, model, label, prediction, probability)."""
    return pred.select(
        F.col(key).alias("incident_id"), F.lit(target).alias("target"), F.lit(model).alias("model"),
        F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
        F.col("prob").alias("probability"),
    )


# ------------------------------------------------------------------ ML7 / ML8
@dataclass
class TargetResult:
    target: str
    best_model: str
    model: ensembles.Classifier
    val_metrics: DataFrame
    test_metrics: DataFrame
    models: dict = field(default_factory=dict)


BALANCE = ("weight", "oversample", "interpolate")


def balanced(train: DataFrame, balance: str, key: str, features: Sequence[str]) -> DataFrame:
    """ML2: ``key, synthetic, label, features, weight``, by class weights, replication or interpolation."""
    if balance == "interpolate":
        out = interpolate(train, "label", key, features)
    elif balance == "oversample":
        out = oversample(train, "label", key, copy=ensembles.ROW)
    elif balance == "weight":
        out = train.withColumn(ensembles.ROW, F.lit(0))
    else:
        raise ValueError(f"balance is one of {BALANCE}")
    return class_weights(out.select(key, ensembles.ROW, "label", *features), "label")


def train_target(
    data: DataFrame,
    target: str,
    sizes: Sizes = Sizes(),
    key: str = "incident_id",
    features: Sequence[str] = K.FEATURE_COLUMNS,
    balance: str = "interpolate",
    top: int = 3,
    folds: int = 5,
    path: str | None = None,
    tuned: dict[str, dict] | None = None,
    jobs: int | None = None,
) -> TargetResult:
    """ML7: fit every candidate on train, add the soft vote and the stack of the
    ``top`` best by validation balanced accuracy (TK5), choose among all by the
    same score and report the winner's test metrics (ML11-ML12).

    ``top`` = 0 leaves the ensembles out. ``tuned`` has parameters a candidate from a
    search (ML18), which replace those of ``sizes``. Out-of-fold scores, fold models and the
    winner (``path``/winner) are kept under ``path``, by default a folder of its
    own in the shared checkpoint folder. ``jobs`` models are fitted side by side (by
    default by the rows, `ensembles.at_once`); where every candidate is a member, the fold
    models are fitted beside the candidates.
    """
    path = path or os.path.join(checkpoint_dir(data.sparkSession), "models", f"{target}-{uuid.uuid4().hex}")
    d = materialize(stratified_split(data.where(F.col(target).isNotNull()).withColumn("label", F.col(target).cast("double")), "label", key), "split")
    train, val = materialize(balanced(d.where(F.col("split") == "train"), balance, key, features), "balanced"), d.where(F.col("split") == "val")
    n_classes = int(d.agg(F.max("label")).first()[0]) + 1
    estimators = classifiers(n_classes, sizes)
    if tuned:
        from .search import with_params

        estimators |= {n: with_params(estimators[n], params) for n, params in tuned.items()}

    def fit(name: str) -> ensembles.Classifier:
        model = Pipeline(stages=[assembler(features), estimators[name]]).fit(train)
        return ensembles.Classifier("single", n_classes, {name: model}, list(features))

    def scored(model: ensembles.Classifier, rows: DataFrame, name: str) -> DataFrame:
        return scored_rows(model.predict(rows), key, target, name)

    def evaluated(rows: list[DataFrame]) -> DataFrame:
        # written first: the metrics read the scores more than once
        return metrics.evaluation_table(materialize(reduce(DataFrame.unionByName, rows), "scored"))

    jobs = jobs or ensembles.at_once(train.count())
    folded = {n: e.copy() for n, e in estimators.items()}  # own copies: fits side by side change their parameters
    out_of_fold = lambda: ensembles.out_of_fold(train, folded, n_classes, f"{path}/out-of-fold", folds=folds, key=key, features=features, jobs=jobs)
    tasks = [lambda n=n: fit(n) for n in estimators]
    if top >= len(estimators):
        tasks.append(out_of_fold)
    fitted = dict(zip(estimators, ensembles.side_by_side(tasks, len(tasks))))
    val_m = materialize(evaluated([scored(m, val, n) for n, m in fitted.items()]), "val-metrics")
    if top:
        chosen = [r["model"] for r in metrics.top_models(val_m, n=top).orderBy("rank").collect()]  # a row a member
        single = {n: fitted[n].members[n] for n in chosen}
        fitted["VotingEnsemble"] = ensembles.Classifier("vote", n_classes, single, list(features))
        fitted["StackingEnsemble"] = ensembles.stack(train, folded, single, chosen, n_classes, f"{path}/out-of-fold", folds=folds, key=key, features=features, jobs=jobs)
        rows = [scored(fitted[n], val, n) for n in ("VotingEnsemble", "StackingEnsemble")]
        val_m = materialize(val_m.unionByName(evaluated(rows)), "val-metrics")
    best = metrics.top_models(val_m, n=1).first()["model"]
    fitted[best].save(data.sparkSession, f"{path}/winner")
    winner = ensembles.Classifier.load(data.sparkSession, f"{path}/winner")
    test_m = evaluated([scored(winner, d.where(F.col("split") == "test"), best)])
    return TargetResult(target, best, winner, val_m, test_m, fitted)


def train_classifiers(data: DataFrame, targets: Sequence[str] = K.CLASS_TARGETS, sizes: Sizes = Sizes(), **how) -> dict[str, TargetResult]:
    """ML8: one `train_target` per classification target; targets of small tables side by side."""
    present = [t for t in targets if t in data.columns]
    return targets_side_by_side(data, present, lambda t, jobs: train_target(data, t, sizes, **({"jobs": jobs} | how)))


def targets_side_by_side(data: DataFrame, targets: Sequence[str], fit: Callable[[str, int | None], TargetResult]) -> dict[str, TargetResult]:
    """``fit(target, jobs)`` of every target, as many at once as the rows allow; ``jobs`` is what each may fit side by side (None: its own choice)."""
    together = min(len(targets), ensembles.at_once(data.count()) // ensembles.JOBS)
    return dict(zip(targets, ensembles.side_by_side([lambda t=t: fit(t, ensembles.JOBS if together > 1 else None) for t in targets], together)))


@dataclass
class RegressionResult:
    best_model: str
    model: PipelineModel
    val_metrics: DataFrame
    test_metrics: DataFrame
    cv: DataFrame


def train_duration(data: DataFrame, sizes: Sizes = Sizes(), folds: int = 5, key: str = "incident_id",
                   features: Sequence[str] = K.FEATURE_COLUMNS, target: str = "duration_min") -> RegressionResult:
    """ML10: fit regressors, choose by validation R², test, k-fold CV R²."""
    d = data.where(F.col(target).isNotNull()).withColumn("label", F.col(target).cast("double")).withColumn("split", split_column(key))
    va = assembler(features)
    fitted, vals = {}, None
    for name, est in regressors(sizes).items():
        m = Pipeline(stages=[va, est]).fit(d.where(F.col("split") == "train"))
        fitted[name] = m
        r = metrics.regression_metrics(m.transform(d.where(F.col("split") == "val"))).withColumn("model", F.lit(name))
        vals = r if vals is None else vals.unionByName(r)
    vals = vals.cache()
    best = vals.orderBy(F.desc_nulls_last("R2"), "model").first()["model"]
    test = metrics.regression_metrics(fitted[best].transform(d.where(F.col("split") == "test"))).withColumn("model", F.lit(best))
    cv = cross_validate_r2(d, regressors(sizes)[best], folds, key, features)
    return RegressionResult(best, fitted[best], vals, test, cv)


def cross_validate_r2(d: DataFrame, est, folds: int, key: str, features: Sequence[str]) -> DataFrame:
    """ML16: k-fold R² mean and population sd as a one-row table."""
    f = d.withColumn("_fold", fold_column(key, folds))
    va = assembler(features)
    rows = None
    for i in range(folds):
        m = Pipeline(stages=[va, est]).fit(f.where(F.col("_fold") != i))
        r = metrics.regression_metrics(m.transform(f.where(F.col("_fold") == i))).select(F.lit(i).alias("fold"), "R2")
        rows = r if rows is None else rows.unionByName(r)
    return rows.agg(F.avg("R2").alias("cv_r2_mean"), F.stddev_pop("R2").alias("cv_r2_std"))


# ------------------------------------------------------------------ ML5 votes over score tables
def voting_predictions(scored_by_model: DataFrame, members: Sequence[str]) -> DataFrame:
    """ML5 over real model outputs (F6 rows of several models)."""
    return metrics.soft_vote(scored_by_model, members)


# ------------------------------------------------------------------ ML19 importance
def feature_importance(model: PipelineModel, features: Sequence[str] = K.FEATURE_COLUMNS, top: int = K.TOP_IMPORTANCES) -> DataFrame:
    """ML19 / TK4: top-n importances with the real feature names (Q12)."""
    stage = model.stages[-1]
    members = stage.models if hasattr(stage, "models") else [stage]
    if not all(hasattr(m, "featureImportances") for m in members):
        raise ValueError(f"{type(stage).__name__} has no feature importances")
    # a one-vs-rest model has one member a class: their mean
    arrays = [m.featureImportances.toArray().tolist() for m in members]
    vals = [sum(v) / len(arrays) for v in zip(*arrays)]
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    df = s.createDataFrame([(f, float(v)) for f, v in zip(features, vals)], "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)


# ------------------------------------------------------------------ IO10
def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
