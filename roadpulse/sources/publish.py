"""IO7: publication of the serving table in versions, with a quarantine for bad rows.

A publication is staged in a folder of its own and becomes visible by one manifest file,
renamed into place last. Readers follow the newest manifest: a run that fails, or is still
writing, leaves them on the version before. A row whose values don't fit the serving
columns is kept aside with its reasons and its original values; rows in are rows published
plus rows quarantined. Publishing again under the same run id changes nothing.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: FIXED VALUES: columns of the serving table and their types.
SERVING_TYPES = {
    "start_datetime": "timestamp_ntz", "event_cause": "string", "event_type": "string", "priority": "string", "zone": "string",
    "police_station": "string", "requires_road_closure": "boolean", "latitude": "double", "longitude": "double", "congestion_severity": "int",
    "duration_min": "double", "manpower_req": "int", "barricade_req": "int", "diversion_req": "int", "status": "string",
}
KEY = "incident_id"


@dataclass
class Published:
    """What a manifest says of a version."""

    version: int
    run: str
    rows: int
    published: int
    quarantined: int
    key_type: str


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where  # noqa: SLF001


def manifests(spark: SparkSession, path: str) -> list[Published]:
    """All published versions, oldest first."""
    fs, where = _fs(spark, f"{path}/_manifest")
    if not fs.exists(where):
        return []
    found = [st.getPath().toString() for st in fs.listStatus(where) if st.getPath().getName().endswith(".json")]
    rows = spark.read.text(found).collect() if found else []  # a row a version
    return sorted((Published(**json.loads(r["value"])) for r in rows), key=lambda p: p.version)


def _cast(df: DataFrame, name: str, kind: str) -> tuple[Column, Column | None]:
    """The value in the serving type (NaN is null), and what tells that a value was lost."""
    if name not in df.columns:
        return F.lit(None).cast(kind), None
    value = F.col(name)
    if dict(df.dtypes)[name] in ("double", "float"):
        value = F.when(~F.isnan(value), value)
    cast = value if dict(df.dtypes)[name] == kind else value.try_cast(kind)
    return cast, value.isNotNull() & cast.isNull()


def tagged(events: DataFrame) -> DataFrame:
    """Serving rows with ``start_month``, ``quarantined``, ``reasons`` and, for rejected rows, their ``original`` as JSON."""
    values, lost = {}, []
    for name, kind in SERVING_TYPES.items():
        values[name], gone = _cast(events, name, kind)
        if gone is not None:
            lost.append(F.when(gone, F.lit(f"bad {name}")))
    lost.append(F.when(F.col(KEY).isNull(), F.lit(f"no {KEY}")))
    values["status"] = F.coalesce(values["status"], F.lit("closed"))
    reasons = F.array_compact(F.array(*lost))
    bad = F.size(reasons) > 0
    return events.select(
        KEY, *[c.alias(n) for n, c in values.items()], F.date_format(values["start_datetime"], "yyyy-MM").alias("start_month"),
        bad.alias("quarantined"), reasons.alias("reasons"), F.when(bad, F.to_json(F.struct(*events.columns))).alias("original"),
    )


def publish(events: DataFrame, path: str, run: str | None = None) -> Published:
    """Publish a version of the serving table; ``run`` names the publication for reruns."""
    spark, run = events.sparkSession, run or uuid.uuid4().hex
    for p in manifests(spark, path):
        if p.run == run:
            return p
    staged, kind = f"{path}/_versions/{run}", dict(events.dtypes)[KEY]
    tagged(events).write.mode("overwrite").partitionBy("quarantined", "start_month").parquet(staged)
    written = _staged(spark, kind, staged).groupBy("quarantined").count().collect()  # two rows, from file footers and folder names
    told = {r["quarantined"]: r["count"] for r in written}
    total, bad = sum(told.values()), told.get(True, 0)
    return _commit(spark, path, run, total, bad, kind)


def _commit(spark: SparkSession, path: str, run: str, rows: int, bad: int, key_type: str) -> Published:
    fs, folder = _fs(spark, f"{path}/_manifest")
    fs.mkdirs(folder)
    _, draft = _fs(spark, f"{path}/_manifest/.{run}")
    while True:
        version = max((p.version for p in manifests(spark, path)), default=0) + 1
        out = Published(version, run, rows, rows - bad, bad, key_type)
        stream = fs.create(draft, True)
        stream.write(bytearray(json.dumps(asdict(out)).encode()))
        stream.close()
        _, final = _fs(spark, f"{path}/_manifest/{version:08d}.json")
        # another publication that took this number first makes ours the next
        if not fs.exists(final) and fs.rename(draft, final):
            return out


def _staged(spark: SparkSession, key_type: str, staged: str) -> DataFrame:
    kinds = ", ".join(f"{n} {k}" for n, k in SERVING_TYPES.items())
    return spark.read.schema(f"{KEY} {key_type}, {kinds}, reasons array<string>, original string, quarantined boolean, start_month string").parquet(staged)


def _version(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    known = [p for p in manifests(spark, path) if version in (None, p.version)]
    if not known:
        raise ValueError(f"no such version has been published under {path}")
    return _staged(spark, known[-1].key_type, os.path.join(path, "_versions", known[-1].run))


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The serving rows of a version (the newest): months and the quarantine are pruned as folders."""
    rows = _version(spark, path, version)
    return rows.where(~F.col("quarantined")).drop("quarantined", "reasons", "original")


def read_quarantine(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``incident_id, reasons, original`` of the rows that a version left out."""
    return _version(spark, path, version).where("quarantined").select(KEY, "reasons", "original")
