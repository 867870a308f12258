"""Bind the driver's tables to the incident data model.

B1 `incidents`       orders ⟕ per-order lineitem dates ⟕ customer ⟕ nation
B2 `event_incidents` events (intra-day timestamps)
B3 `feedback_pairs`  predictions + later actuals derived from B2
B4 `scored`          label / prediction / probability rows derived from B2

Everything is a lazy DataFrame; the per-order lineitem aggregate is the only
wide operation of B1 (a partial + final hash aggregate on l_orderkey whose
output is already partitioned for the join with orders).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import literal_map

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Cause spellings in their listed order; B1 picks one by o_orderkey % 17.
CAUSE_CYCLE = list(K.CAUSE_SEVERITY.keys())

# Columns of the raw incident schema that B1 does not derive (typed nulls).
_EXTRA_STRING_COLUMNS = ["veh_type", "veh_no", "reason_breakdown", "kgid", "authenticated", "junction"]


# driver tables each binding reads (stage outputs are keyed on their files)
INCIDENT_SOURCES = ("orders", "lineitem", "customer", "nation")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def source_paths(sf_dir: str, names=INCIDENT_SOURCES) -> list[str]:
    return [table_path(sf_dir, n) for n in names]


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: one incident per order (schema F1 of FIXTURES.md)."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ship = li.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("_last_ship"), F.min("l_shipdate").alias("_first_ship")
    )
    # nation is a fixed 25-row dimension: joining it to customer first keeps
    # the customer side narrow; AQE decides broadcast vs shuffle at run time.
    cust = c.join(n, c.c_nationkey == n.n_nationkey, "left").select("c_custkey", "c_mktsegment", "n_name")
    j = o.join(ship, o.o_orderkey == ship.l_orderkey, "left").join(cust, o.o_custkey == cust.c_custkey, "left")
    key = F.col("o_orderkey")
    ck = F.col("o_custkey")
    cause_idx = (key % 17).cast("int")
    causes = F.array(*[F.lit(x) for x in CAUSE_CYCLE])
    cols = [
        key.alias("incident_id"),
        F.col("o_orderdate").alias("start_datetime"),
        F.when(key % 3 == 0, F.col("o_orderdate") + F.expr("INTERVAL 90 MINUTES")).alias("end_datetime"),
        F.when(key % 5 != 0, F.col("_last_ship")).alias("closed_datetime"),
        F.when(key % 7 != 0, F.col("_first_ship")).alias("resolved_datetime"),
        F.when(key % 101 != 0, F.element_at(causes, cause_idx + 1)).alias("event_cause"),
        F.when(F.col("o_orderstatus") == "P", "planned").otherwise("unplanned").alias("event_type"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "High")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("string"))
        .otherwise("Low")
        .alias("priority"),
        (key % 11 == 0).alias("requires_road_closure"),
        F.when(ck % 10 != 0, F.col("n_name")).alias("zone"),
        F.concat(F.lit("PS_"), (ck % 50).cast("string")).alias("police_station"),
        F.col("c_mktsegment").alias("corridor"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("status"),
        (F.lit(K.CITY_LAT) + ((ck % 201) - 100).cast("double") * F.lit(0.001)).alias("latitude"),
        (F.lit(K.CITY_LON) + ((ck % 151) - 75).cast("double") * F.lit(0.001)).alias("longitude"),
    ]
    cols += [F.lit(None).cast("string").alias(x) for x in _EXTRA_STRING_COLUMNS]
    return j.select(*cols)


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def event_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: events as intra-day incidents (windows, streams)."""
    e = table(spark, sf_dir, "events")
    return event_incidents_from(e)


def event_incidents_from(e: DataFrame) -> DataFrame:
    k = _k()
    return e.select(
        F.col("event_id").alias("incident_id"),
        F.col("ts").alias("start_datetime"),
        F.col("event_type").alias("event_cause"),
        F.concat(F.lit("Z"), (F.col("user_id") % 10).cast("string")).alias("zone"),
        F.col("value").alias("duration_min"),
        F.when(k >= 50, "High").otherwise("Low").alias("priority"),
        F.least(F.lit(3), F.floor(k / 25)).cast("int").alias("congestion_severity"),
    )


def feedback_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3: prediction log rows joined with their (possibly missing) actuals."""
    b2 = event_incidents(spark, sf_dir)
    eid = F.col("incident_id")
    pred = F.col("congestion_severity")
    officers = literal_map(K.MANPOWER_OFFICERS)
    return b2.select(
        eid.alias("prediction_id"),
        F.col("start_datetime").alias("timestamp"),
        "event_cause",
        F.lit("unplanned").alias("event_type"),
        "priority",
        F.lit(False).alias("requires_road_closure"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        pred.alias("pred_severity"),
        F.col("duration_min").alias("pred_duration_min"),
        officers[pred].alias("pred_officers"),
        F.least(pred, F.lit(3)).alias("pred_barricade_class"),
        F.lit(0).alias("pred_diversion"),
        F.when(eid % 3 == 0, ((eid + pred) % 4).cast("int")).when(eid % 3 == 1, pred).alias("actual_severity"),
        F.when(eid % 3 != 2, F.col("duration_min") * 1.25).alias("actual_duration_min"),
        F.lit(None).cast("int").alias("actual_officers"),
        F.lit(None).cast("int").alias("actual_barricade_class"),
        F.lit(None).cast("int").alias("actual_diversion"),
        (F.col("start_datetime") + F.make_dt_interval(hours=(eid % 72).cast("int"))).alias("actual_at"),
    )


MODEL_VARIANTS = {"ModelA": 10, "ModelB": 9, "ModelC": 8}


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4: (incident_id, target, model, label, prediction, score, probability).

    Two targets: 4-class `congestion_severity` and binary `diversion_req`;
    three model variants that are wrong on the last two residues of their
    modulus. `probability` puts 0.4 + 0.6·score on the predicted class and
    splits the rest evenly.
    """
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    score = ((eid * 7919) % 1000).cast("double") / F.lit(1000.0)
    # one scan; each event yields its six (model, target) rows by exploding
    # constant descriptors, so every expression below is written once
    variants = F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(m).alias("m"), F.lit(target).alias("target"), F.lit(n_cls).alias("n_cls"))
        for model, m in MODEL_VARIANTS.items()
        for target, n_cls in (("congestion_severity", 4), ("diversion_req", 2))
    ])
    x = e.select(eid.alias("incident_id"), _k().alias("_k"), score.alias("score"), F.explode(variants).alias("_v"))
    label = F.when(F.col("_v.n_cls") == 4, F.least(F.lit(3), F.floor(F.col("_k") / 25))).otherwise((F.col("_k") >= 50).cast("long"))
    x = x.select("*", label.cast("int").alias("label"))
    ok = (F.col("incident_id") % F.col("_v.m")) < (F.col("_v.m") - 2)
    x = x.select("*", F.when(ok, F.col("label")).otherwise((F.col("label") + 1) % F.col("_v.n_cls")).cast("int").alias("prediction"))
    top = F.lit(0.4) + F.lit(0.6) * F.col("score")
    rest = (F.lit(1.0) - top) / (F.col("_v.n_cls") - 1).cast("double")
    prob = F.transform(F.sequence(F.lit(0), F.col("_v.n_cls") - 1), lambda i: F.when(i == F.col("prediction"), top).otherwise(rest))
    return x.select(
        "incident_id", F.col("_v.target").alias("target"), F.col("_v.model").alias("model"),
        "label", "prediction", "score", prob.alias("probability"),
    )
