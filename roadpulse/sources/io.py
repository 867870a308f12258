"""Sources and sinks (IO1, IO3, IO4, IO7–IO10).

All reads take an explicit schema (no inference pass over the data); all
writes are distributed writer tasks into the caller's storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K

BAD = "_corrupt_record"

INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("incident_id", T.StringType()),
        T.StructField("start_datetime", T.StringType()),
        T.StructField("end_datetime", T.StringType()),
        T.StructField("closed_datetime", T.StringType()),
        T.StructField("resolved_datetime", T.StringType()),
        T.StructField("event_cause", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("requires_road_closure", T.BooleanType()),
        T.StructField("zone", T.StringType()),
        T.StructField("police_station", T.StringType()),
        T.StructField("corridor", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("veh_type", T.StringType()),
        T.StructField("veh_no", T.StringType()),
        T.StructField("reason_breakdown", T.StringType()),
        T.StructField("kgid", T.StringType()),
        T.StructField("authenticated", T.StringType()),
        T.StructField("junction", T.StringType()),
    ]
)


# names in the incident file's header -> names of the data model
HEADER_NAMES = {"id": "incident_id"}


def read_incidents_csv(spark: SparkSession, path: str, schema: T.StructType = INCIDENT_SCHEMA) -> DataFrame:
    """IO1: CSV scan by header; lines with more fields than the header are
    skipped, lines with fewer are kept with nulls (the original reader's rule).

    Columns are found by name, in any order; `id` is the incident id, read as
    text. Columns of `schema` that the file lacks are null, further columns of
    the file are kept as text. All files of a folder must have the same header.

    Spark flags lines of another width, and lines with unreadable values, in
    the corrupt-record column; the fields of a flagged line are counted outside
    quotes against the file's own width.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    types = {f.name: f.dataType for f in schema.fields}
    own = [HEADER_NAMES.get(c, c) for c in header]
    fields = [T.StructField(c, types.get(own[i], T.StringType())) for i, c in enumerate(header)]
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD)
        .schema(T.StructType([*fields, T.StructField(BAD, T.StringType())]))
        .csv(path)
    )
    width = F.size(F.split(F.regexp_replace(F.col(BAD), '"(?:[^"]|"")*"', ""), ","))
    kept = raw.where(F.col(BAD).isNull() | (width <= len(header))).drop(BAD).toDF(*own)
    missing = [f for f in schema.fields if f.name not in own]
    rest = [c for c in own if c not in types]
    return kept.select(
        *[F.col(f.name) if f not in missing else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], *[F.col(c) for c in rest]
    )


def write_incidents_csv(df: DataFrame, path: str) -> None:
    """Counterpart writer (header, ISO timestamps)."""
    df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """IO3: parquet overwrite, optionally partitioned (e.g. by month)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """IO2: parquet scan (filters and projections push down)."""
    return spark.read.parquet(path)


def publish_events(events: DataFrame, path: str) -> None:
    """IO7: the serving table, partitioned by start month (month pruning for
    the dashboard's time filters)."""
    cols = ["incident_id"] + [c for c in K.SERVING_COLUMNS]
    d = events.select(*[F.col(c) if c in events.columns else F.lit(None).alias(c) for c in cols])
    d = d.withColumn("status", F.coalesce(F.col("status"), F.lit("closed")))
    d = d.withColumn("start_month", F.date_format("start_datetime", "yyyy-MM"))
    write_table(d, path, ["start_month"])


def append_scored(scored: DataFrame, path: str) -> None:
    """IO8: append scored requests to the serving table as open events.

    Q9: the class and the officer count are two separate columns."""
    d = scored.select(
        F.col("request_id").alias("incident_id"),
        F.col("request_time").cast("timestamp_ntz").alias("start_datetime") if "request_time" in scored.columns else F.current_timestamp().cast("timestamp_ntz").alias("start_datetime"),
        "event_cause", "event_type", "priority",
        F.lit(None).cast("string").alias("zone"), F.lit(None).cast("string").alias("police_station"),
        F.col("road_closure").alias("requires_road_closure"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.col("severity_class").alias("congestion_severity"), F.col("predicted_duration_min").alias("duration_min"),
        F.col("manpower_class").alias("manpower_req"), F.col("officers_required").alias("manpower_officers"),
        F.col("barricade_class").alias("barricade_req"), F.col("diversion_class").alias("diversion_req"),
        F.lit("open").alias("status"),
    ).withColumn("start_month", F.date_format("start_datetime", "yyyy-MM"))
    d.write.mode("append").partitionBy("start_month").parquet(path)


METRICS_SCHEMA = "report string, target string, model string, split string, metric string, value double"


def metrics_long(table: DataFrame, report: str, split: str, metrics: Sequence[str], keys: Sequence[str] = ("target", "model")) -> DataFrame:
    """IO9 / F5: wide metric table -> (report, target, model, split, metric, value)."""
    keys = list(keys)
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    d = table.select(*keys, rows.alias("_m"))
    tgt = F.col("target") if "target" in keys else F.lit(None).cast("string")
    mdl = F.col("model") if "model" in keys else F.lit(None).cast("string")
    return d.select(F.lit(report).alias("report"), tgt.alias("target"), mdl.alias("model"), F.lit(split).alias("split"), "_m.metric", "_m.value")


def write_report(long: DataFrame, path: str) -> None:
    """IO4: metrics report as JSON lines."""
    long.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """IO4: read a JSON metrics report back with its schema."""
    return spark.read.schema(METRICS_SCHEMA).json(path)


def publish_metrics(long: DataFrame, path: str) -> None:
    """IO9: append report rows to the metrics table (keyed by report)."""
    long.write.mode("append").partitionBy("report").parquet(path)


def read_metrics(spark: SparkSession, path: str, report: str) -> DataFrame:
    """IO9 read side: one report by partition filter (pruned scan)."""
    return spark.read.parquet(path).where(F.col("report") == report)
