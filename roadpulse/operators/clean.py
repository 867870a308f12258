"""Cleaning operators (PF1–PF8, PF15–PF18, SC6, SC9).

Each function is DataFrame -> DataFrame and lazy. Global statistics (p99,
p1/p99, medians) are one-row aggregates joined back with a crossJoin; a
one-row side is the only thing ever broadcast explicitly.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.exprs import clip, minutes_between
from .stats import scalar_quantiles


def parse_datetimes(df: DataFrame, columns: Sequence[str] = K.DATETIME_COLUMNS) -> DataFrame:
    """PF1: coerce present datetime columns to naive UTC (TIMESTAMP_NTZ).

    Strings are parsed leniently (`try_to_timestamp`: bad values -> null);
    zone-aware values are converted to UTC first (session zone is UTC).
    """
    out = df
    types = dict(df.dtypes)
    for c in columns:
        if c not in types:
            continue
        t = types[c]
        if t == "string":
            e = F.try_to_timestamp(F.col(c)).cast("timestamp_ntz")
        elif t in ("timestamp", "date"):
            e = F.col(c).cast("timestamp_ntz")
        elif t == "timestamp_ntz":
            continue
        else:
            e = F.lit(None).cast("timestamp_ntz")
        out = out.withColumn(c, e)
    return out


def raw_duration(df: DataFrame) -> DataFrame:
    """PF2: minutes from start to the first present of closed, resolved, end.

    A present but earlier end time still wins (later clipped to 0), it does
    not fall through to the next candidate (Q5).
    """
    start = F.col("start_datetime")
    cands = [c for c in ("closed_datetime", "resolved_datetime", "end_datetime") if c in df.columns]
    e = F.lit(None).cast("double")
    for c in reversed(cands):
        e = F.when(start.isNotNull() & F.col(c).isNotNull(), minutes_between(start, F.col(c))).otherwise(e)
    return df.withColumn("duration_min", e)


def derive_duration(df: DataFrame, cap_quantile: float = 0.99, cap: float | None = None) -> DataFrame:
    """PF2 + PF3: duration, clipped below at 0 and above at its global p99.

    The cap is one exact global quantile (one distributed pass, a scalar back);
    callers that already hold it pass `cap=`.
    """
    d = raw_duration(df).withColumn("duration_min", clip("duration_min", lower=0.0))
    if cap is None:
        cap = scalar_quantiles(d, {"duration_min": [cap_quantile]})[("duration_min", float(cap_quantile))]
    if cap is None:
        return d
    return d.withColumn("duration_min", clip("duration_min", upper=F.lit(float(cap))))


def drop_useless(df: DataFrame, columns: Iterable[str] = K.DROP_COLUMNS) -> DataFrame:
    """PF5: drop listed metadata columns that are present."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present)


def fill_constants(df: DataFrame, fills: Mapping[str, str] = K.CATEGORICAL_FILLS) -> DataFrame:
    """PF6: constant null fill for present columns."""
    present = {k: v for k, v in fills.items() if k in df.columns}
    return df.fillna(present) if present else df


def null_counts(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, int]]:
    """(rows, nulls per present column) from one map-side aggregate."""
    cols = [c for c in columns if c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]).first()
    return row["_rows"], {c: row[f"_n{i}"] for i, c in enumerate(cols)}


def fill_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PF7/PF8: fill nulls of each present column with its exact median.

    One aggregate counts rows and nulls; only columns that hold nulls need a
    median, and those share one distributed quantile pass (a null-free column
    is left as it is, which is what a fill would give)."""
    if not any(c in df.columns for c in columns):
        return df
    _, nulls = null_counts(df, columns)
    cols = [c for c, n in nulls.items() if n]
    if not cols:
        return df
    med = scalar_quantiles(df, {c: [0.5] for c in cols})
    out = df
    for c in cols:
        m = med[(c, 0.5)]
        if m is not None:
            out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(float(m))))
    return out


def clip_to_quantiles(
    df: DataFrame,
    columns: Sequence[str] = ("latitude", "longitude"),
    lo: float = 0.01,
    hi: float = 0.99,
    bounds: dict | None = None,
) -> DataFrame:
    """PF4: clip each column to its global [p_lo, p_hi] (nulls stay null)."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    if bounds is None:
        bounds = scalar_quantiles(df, {c: [lo, hi] for c in cols})
    out = df
    for c in cols:
        lo_v, hi_v = bounds[(c, float(lo))], bounds[(c, float(hi))]
        if lo_v is None:
            continue
        out = out.withColumn(c, clip(c, lower=F.lit(float(lo_v)), upper=F.lit(float(hi_v))))
    return out


def numeric_columns(df: DataFrame) -> list[str]:
    """PF20: numeric columns by schema type."""
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, num)]


class RetentionError(AssertionError):
    """A stage kept too few of its rows."""


class Retention:
    """PF18: the share of rows that a stage keeps.

    ``before`` and ``after`` take written tables, whose rows are told by the file footers
    without reading a column; ``check`` raises if less than ``pct`` % of the rows are left
    and returns the percentage (100 for no rows at all). Spark's own observed metrics
    aren't used: a session that holds some can't ship freshly fitted binary forests, as
    their summaries refer to the session.
    """

    def __init__(self, pct: float = 90.0):
        self.pct = pct
        self._seen: dict[str, int] = {}

    def before(self, written: DataFrame) -> DataFrame:
        self._seen["before"] = written.count()
        return written

    def after(self, written: DataFrame) -> DataFrame:
        self._seen["after"] = written.count()
        return written

    def rows(self) -> tuple[int, int]:
        return self._seen["before"], self._seen["after"]

    def check(self) -> float:
        before, after = self.rows()
        kept = 100.0 * after / before if before else 100.0
        if kept < self.pct:
            raise RetentionError(f"{after} of {before} rows are left ({kept:.1f} %, at least {self.pct:g} % wanted)")
        return kept
