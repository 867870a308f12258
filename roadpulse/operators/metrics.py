"""Model evaluation as relational tables (ML5, ML11–ML15, TK5, AG19, AG20).

Input is a long `scored` table: (incident_id, target, model, label,
prediction[, probability array][, split]). Every metric is derived from
small aggregates of it — the confusion counts per (target, model, label,
prediction), and per-(score) positive/negative counts for ROC-AUC — so
nothing scales with rows beyond one partial + final aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import title_label
from .stats import prefix_sums_before


def confusion_counts(scored: DataFrame, keys: Sequence[str] = ("target", "model")) -> DataFrame:
    """(keys..., label, prediction, n)."""
    return scored.groupBy(*keys, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(scored: DataFrame, keys: Sequence[str] = ("target", "model")) -> DataFrame:
    """ML11: accuracy, balanced accuracy, F1 / precision / recall, Cohen's kappa.

    Binary targets (two classes present) report the positive class 1;
    otherwise support-weighted averages (zero division -> 0). Balanced accuracy
    averages recall over classes that occur as labels.
    """
    keys = list(keys)
    cc = confusion_counts(scored, keys)
    # each confusion cell counts once for its label class (support, hits) and
    # once for its predicted class: one grouped aggregate, no joins
    hit = F.col("label") == F.col("prediction")
    zero = F.lit(0).cast("long")
    ent = cc.select(*keys, F.explode(F.array(
        F.struct(F.col("label").alias("k"), F.col("n").alias("sup"), F.when(hit, F.col("n")).otherwise(zero).alias("tp"), zero.alias("prd")),
        F.struct(F.col("prediction").alias("k"), zero.alias("sup"), zero.alias("tp"), F.col("n").alias("prd")),
    )).alias("_e")).select(*keys, "_e.*")
    per = ent.groupBy(*keys, "k").agg(F.sum("sup").alias("support"), F.sum("tp").alias("tp"), F.sum("prd").alias("predicted"))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    pre = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    per = per.select(*keys, "k", "support", "tp", "predicted", rec.alias("rec"), pre.alias("pre"))
    per = per.withColumn("f1", F.when(F.col("rec") + F.col("pre") > 0, 2 * F.col("rec") * F.col("pre") / (F.col("rec") + F.col("pre"))).otherwise(0.0))
    pos = F.col("k") == 1
    agg = per.groupBy(*keys).agg(
        F.sum("support").alias("N"),
        F.sum("tp").alias("hits"),
        F.count(F.lit(1)).alias("n_classes"),
        F.avg(F.when(F.col("support") > 0, F.col("rec"))).alias("balanced_accuracy"),
        F.sum(F.col("support") * F.col("rec")).alias("w_rec"),
        F.sum(F.col("support") * F.col("pre")).alias("w_pre"),
        F.sum(F.col("support") * F.col("f1")).alias("w_f1"),
        F.max(F.when(pos, F.col("rec"))).alias("b_rec"),
        F.max(F.when(pos, F.col("pre"))).alias("b_pre"),
        F.max(F.when(pos, F.col("f1"))).alias("b_f1"),
        F.sum(F.col("support") * F.col("predicted")).alias("pe_num"),
    )
    n = F.col("N").cast("double")
    acc = F.col("hits") / n
    pe = F.col("pe_num") / (n * n)
    is_bin = F.col("n_classes") == 2
    return agg.select(
        *keys,
        acc.alias("accuracy"),
        F.col("balanced_accuracy"),
        F.when(is_bin, F.coalesce(F.col("b_f1"), F.lit(0.0))).otherwise(F.col("w_f1") / n).alias("f1"),
        F.when(is_bin, F.coalesce(F.col("b_pre"), F.lit(0.0))).otherwise(F.col("w_pre") / n).alias("precision"),
        F.when(is_bin, F.coalesce(F.col("b_rec"), F.lit(0.0))).otherwise(F.col("w_rec") / n).alias("recall"),
        F.when(pe < 1, (acc - pe) / (F.lit(1.0) - pe)).alias("cohen_kappa"),
    )


def roc_auc(scored: DataFrame, keys: Sequence[str] = ("target", "model")) -> DataFrame:
    """ML12: binary AUC on P(class 1), or macro one-vs-rest AUC for >2 classes.

    Rank-sum with average ranks for ties, computed from per-score positive /
    negative counts and the negatives strictly below each score.
    """
    keys = list(keys)
    # each row's probability array has one entry per class of its target
    ex = scored.select(*keys, "label", F.size("probability").alias("_nc"), F.posexplode("probability").alias("cls", "p"))
    # binary: only the positive-class column; multiclass: every class column
    ex = ex.where((F.col("_nc") > 2) | (F.col("cls") == 1))
    pos = (F.col("label") == F.col("cls")).cast("long")
    hist = ex.groupBy(*keys, "cls", "p").agg(F.sum(pos).alias("pos"), F.sum(F.lit(1) - pos).alias("neg"))
    hist = prefix_sums_before(hist, [*keys, "cls"], "p", ["neg"])
    per_cls = hist.groupBy(*keys, "cls").agg(
        F.sum(F.col("pos") * (F.col("_before_neg") + F.col("neg") * 0.5)).alias("u"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("Nn"),
    )
    per_cls = per_cls.select(*keys, "cls", F.when((F.col("P") > 0) & (F.col("Nn") > 0), F.col("u") / (F.col("P") * F.col("Nn"))).alias("auc"))
    return per_cls.groupBy(*keys).agg(F.avg("auc").alias("roc_auc"))


def evaluation_table(scored: DataFrame, keys: Sequence[str] = ("target", "model")) -> DataFrame:
    """ML11 + ML12 in one table per (keys)."""
    keys = list(keys)
    m = classification_metrics(scored, keys)
    if "probability" in scored.columns:
        m = m.join(roc_auc(scored, keys), keys, "left")
    return m


def confusion_matrix(scored: DataFrame, classes: Sequence[int], keys: Sequence[str] = ("target", "model")) -> DataFrame:
    """ML13: rows (keys, label), one count column per predicted class."""
    keys = list(keys)
    out = scored.groupBy(*keys, "label").pivot("prediction", list(classes)).agg(F.count(F.lit(1)))
    for c in classes:
        out = out.withColumnRenamed(str(c), f"pred_{c}")
    return out.fillna(0, [f"pred_{c}" for c in classes])


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction", keys: Sequence[str] = ()) -> DataFrame:
    """ML14: MAE, RMSE, MAPE (% over non-zero labels), R²; predictions clipped at 0."""
    keys = list(keys)
    y = F.col(label).cast("double")
    p = F.greatest(F.col(prediction).cast("double"), F.lit(0.0))
    e = y - p
    agg = pred.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(F.abs(e)).alias("MAE"),
        F.sqrt(F.avg(e * e)).alias("RMSE"),
        (F.avg(F.when(y != 0, F.abs(e / y))) * 100).alias("MAPE"),
        F.sum(e * e).alias("_sse"),
        F.var_pop(y).alias("_vy"),
    )
    r2 = F.when(F.col("_vy") > 0, F.lit(1.0) - F.col("_sse") / (F.col("_n") * F.col("_vy")))
    return agg.select(*keys, "MAE", "RMSE", "MAPE", r2.alias("R2"))


def residuals(pred: DataFrame, key: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """ML15: (key, actual, predicted clipped at 0, residual)."""
    p = F.greatest(F.col(prediction).cast("double"), F.lit(0.0))
    return pred.select(key, F.col(label).cast("double").alias("actual"), p.alias("predicted"), (F.col(label) - p).alias("residual"))


#: Scored rows that a task of `soft_vote` takes.
VOTE_ROWS = 300_000


def soft_vote(scored: DataFrame, members: Sequence[str] | None = None, key: str = "incident_id", digits: int = 9) -> DataFrame:
    """ML5: average member probability vectors per (key, target), arg-max
    (ties -> lowest class). Averages are rounded to `digits` before arg-max.

    Tasks grow in number with the rows (counted first; of a written table by its
    footers), so that a task's aggregates stay of the same size."""
    d = scored if members is None else scored.where(F.col("model").isin(*members))
    tasks = max(1, -(-d.count() // VOTE_ROWS))
    # one exchange on (key, target) serves both aggregates below (their
    # grouping keys contain it), and it moves the rows before the explode
    ex = d.repartition(tasks, key, "target").select(key, "target", F.posexplode("probability").alias("cls", "p"))
    avg = ex.groupBy(key, "target", "cls").agg(F.round(F.avg("p"), digits).alias("p"))
    best = avg.groupBy(key, "target").agg(F.max(F.struct(F.col("p"), (-F.col("cls")).alias("neg_cls"))).alias("_m"))
    return best.select(key, "target", (-F.col("_m.neg_cls")).cast("int").alias("prediction"), F.col("_m.p").alias("confidence"))


def top_models(metrics: DataFrame, by: str = "balanced_accuracy", n: int = 3, group: str = "target") -> DataFrame:
    """TK5: the n best models per target (ties by model name); rank 1 = best.

    The window runs over the small metrics table (models per target)."""
    w = Window.partitionBy(group).orderBy(F.desc_nulls_last(by), F.asc("model"))
    return metrics.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def model_comparison(metrics: DataFrame, targets: Sequence[str], value: str = "balanced_accuracy") -> DataFrame:
    """AG19: model x target pivot of a metric, targets as title-case labels."""
    labels = {t: t.replace("_", " ").title() for t in targets}
    d = metrics.withColumn("_t", title_label("target"))
    out = d.groupBy("model").pivot("_t", list(labels.values())).agg(F.first(value))
    return out


def best_model_metrics(val: DataFrame, test: DataFrame, by: str = "balanced_accuracy") -> DataFrame:
    """AG20: for each target, the validation winner and its test metrics."""
    winners = top_models(val, by, 1).select("target", F.col("model").alias("best_model"))
    return winners.join(test, (winners.target == test.target) & (winners.best_model == test.model)).drop(test.target).drop("model")
