"""Prediction feedback loop (IO5, IO6, SO1, JN5, AG18).

The log is append-only: predictions and actuals are separate rows keyed by
`prediction_id`; `record_actuals` resolves them with one aggregate + join
instead of rewriting a file per update.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.exprs import round_even

ACTUAL_COLUMNS = ["actual_severity", "actual_duration_min", "actual_officers", "actual_barricade_class", "actual_diversion"]

FEEDBACK_SCHEMA = T.StructType(
    [
        T.StructField("prediction_id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("event_cause", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("requires_road_closure", T.BooleanType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("pred_severity", T.IntegerType()),
        T.StructField("pred_duration_min", T.DoubleType()),
        T.StructField("pred_officers", T.IntegerType()),
        T.StructField("pred_barricade_class", T.IntegerType()),
        T.StructField("pred_diversion", T.IntegerType()),
        T.StructField("actual_severity", T.IntegerType()),
        T.StructField("actual_duration_min", T.DoubleType()),
        T.StructField("actual_officers", T.IntegerType()),
        T.StructField("actual_barricade_class", T.IntegerType()),
        T.StructField("actual_diversion", T.IntegerType()),
    ]
)


def append_rows(log: DataFrame, new: DataFrame) -> DataFrame:
    """SO1: UNION ALL by column name (missing columns -> null)."""
    return log.unionByName(new, allowMissingColumns=True)


def log_predictions(predictions: DataFrame, path: str) -> None:
    """IO5: append prediction rows to the feedback log, partitioned by day."""
    (
        predictions.withColumn("log_date", F.to_date("timestamp"))
        .write.mode("append")
        .partitionBy("log_date")
        .parquet(path)
    )


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    """IO6: the feedback log, or an empty frame with the schema if the path is
    missing; any other error (permissions, damaged files) is raised."""
    stored = T.StructType([*FEEDBACK_SCHEMA.fields, T.StructField("log_date", T.DateType())])
    try:
        return spark.read.schema(stored).parquet(path).drop("log_date")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FEEDBACK_SCHEMA)


def record_actuals(
    predictions: DataFrame,
    updates: DataFrame,
    key: str = "prediction_id",
    seq: str = "update_seq",
    columns: Sequence[str] = ACTUAL_COLUMNS,
) -> tuple[DataFrame, DataFrame]:
    """JN5: apply actual-value updates; a null in an update never overwrites.

    `updates` holds (key, seq, some of `columns`). The latest non-null value
    of each column per key wins over the stored one. Returns (updated
    predictions, rejected updates whose key is unknown).
    """
    cols = [c for c in columns if c in updates.columns]
    latest = updates.groupBy(key).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(f"_new_{c}") for c in cols]
    )
    out = predictions.join(latest, key, "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(f"_new_{c}"), F.col(c)) if c in predictions.columns else F.col(f"_new_{c}"))
    out = out.drop(*[f"_new_{c}" for c in cols])
    rejected = updates.join(predictions.select(key), key, "left_anti")
    return out, rejected


# FIXED VALUES: the report's two recommendations.
RETRAIN_TEXT = "⚠ Significant drift detected — RETRAIN RECOMMENDED"
OK_TEXT = "✓ Model performance acceptable. No retraining needed."


def drift_report(feedback: DataFrame, floor: float = K.DRIFT_ACCURACY_FLOOR) -> DataFrame:
    """AG18: one row of drift numbers, or no row when nothing is evaluated.

    accuracy (4 dp) and mean |error| (3 dp) over rows with both severities;
    duration MAE (2 dp) over rows with both durations; retrain when the
    unrounded accuracy is strictly below `floor`.
    """
    both = F.col("actual_severity").isNotNull() & F.col("pred_severity").isNotNull()
    dboth = F.col("actual_duration_min").isNotNull() & F.col("pred_duration_min").isNotNull()
    a = feedback.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(both).alias("evaluated_records"),
        F.count_if(both & (F.col("actual_severity").cast("int") == F.col("pred_severity").cast("int"))).alias("_hits"),
        F.avg(F.when(both, F.abs(F.col("actual_severity").cast("double") - F.col("pred_severity").cast("double")))).alias("_err"),
        F.avg(F.when(dboth, F.abs(F.col("actual_duration_min") - F.col("pred_duration_min")))).alias("_mae"),
    )
    acc = F.col("_hits") / F.col("evaluated_records")
    return a.where(F.col("evaluated_records") > 0).select(
        "total_predictions",
        "evaluated_records",
        round_even(acc, 4).alias("severity_accuracy"),
        round_even(F.col("_err"), 3).alias("severity_mean_error"),
        round_even(F.col("_mae"), 2).alias("duration_mae"),
        (acc < floor).alias("retrain"),
        F.when(acc < floor, RETRAIN_TEXT).otherwise(OK_TEXT).alias("recommendation"),
    )
