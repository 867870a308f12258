"""Profiling / exploratory aggregates (AG5–AG17).

Wide per-column statistics are computed by unpivoting the columns into
(column, value) rows and running ONE grouped aggregate, instead of one job per
column. Modes and top values use two aggregates (max count, then smallest
value at that count) so a hot group is combined map-side, never collected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import round_even
from .stats import exact_quantiles


def class_distribution(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """AG5 over several label columns at once: (target, class, count)."""
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("int").alias("class")) for t in targets])).alias("_t")
    ).select("_t.target", "_t.class")
    return long.groupBy("target", "class").agg(F.count(F.lit(1)).alias("count"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence, prefix: str) -> DataFrame:
    """AG6: two-key count table, missing cells = 0. Pivot values are given
    explicitly (no extra distinct job)."""
    out = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1)))
    for v in values:
        out = out.withColumnRenamed(str(v), f"{prefix}{v}")
    return out.fillna(0, subset=[f"{prefix}{v}" for v in values])


def median_by(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """AG7: exact median per group (null group keys dropped like pandas)."""
    return exact_quantiles(df.where(F.col(group).isNotNull()), value, [0.5], by=[group], names=[name])


def mean_count_by(df: DataFrame, group: str, value: str) -> DataFrame:
    """AG8: mean and row count per group."""
    return df.groupBy(group).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("count"))


def _unpivot(df: DataFrame, columns: Sequence[str], cast: str | None) -> DataFrame:
    def v(c):
        return F.col(c).cast(cast) if cast else F.col(c)

    return df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), v(c).alias("value")) for c in columns])).alias("_kv")
    ).select("_kv.column", "_kv.value")


def missing_report(df: DataFrame) -> DataFrame:
    """AG9: null count and percentage (2 dp) per column, only columns with nulls."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    stacked = agg.select(
        "_rows",
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing")) for i, c in enumerate(cols)])).alias("_kv"),
    ).select("_rows", "_kv.column", "_kv.missing")
    return stacked.where(F.col("missing") > 0).select(
        "column", "missing", round_even(F.col("missing") * 100.0 / F.col("_rows"), 2).alias("pct")
    )


def describe_all(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """AG10: count, unique, top, freq, mean, std, min, quartiles, max per column.

    One wide aggregate for moments, one unpivoted exact-quantile pass for the
    quartiles, one unpivoted value count for unique/top/freq.
    """
    numeric, categorical = list(numeric), list(categorical)
    parts = []
    if numeric:
        nl = _unpivot(df, numeric, "double")
        mom = nl.groupBy("column").agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        qs = exact_quantiles(nl, "value", [0.25, 0.5, 0.75], by=["column"], names=["q25", "q50", "q75"])
        num = mom.join(qs, "column", "left").select(
            "column", "count", F.lit(None).cast("bigint").alias("unique"), F.lit(None).cast("string").alias("top"),
            F.lit(None).cast("bigint").alias("freq"), "mean", "std", "min", "q25", "q50", "q75", "max",
        )
        parts.append(num)
    if categorical:
        # one (column, value) count table answers count, unique, top and freq;
        # null values form their own group so all-null columns still appear
        cl = _unpivot(df, categorical, "string")
        vc = cl.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
        present = F.col("value").isNotNull()
        cat = vc.groupBy("column").agg(
            F.coalesce(F.sum(F.when(present, F.col("_n"))), F.lit(0)).alias("count"),
            F.count("value").alias("unique"),
            # most frequent value, ties -> smallest (null orderings are skipped)
            F.min_by(F.col("value"), F.when(present, F.struct((-F.col("_n")).alias("nf"), F.col("value")))).alias("top"),
            F.max(F.when(present, F.col("_n"))).alias("freq"),
        ).select(
            "column", "count", "unique", "top", "freq",
            *[F.lit(None).cast("double").alias(x) for x in ("mean", "std", "min", "q25", "q50", "q75", "max")],
        )
        parts.append(cat)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: A variance below this share of the mean square around the shift is taken as zero.
_FLAT = 1e-12


def _gram_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over a task's rows for all pairs of columns ``a <= b`` where both are present:
    rows, values, squares and products, as products of the value matrix and its mask."""
    total = None
    for batch in batches:
        x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
        mask = (~np.isnan(x)).astype(float)
        x = np.where(mask > 0, x, 0.0)
        own = np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
        total = own if total is None else total + own
    if total is not None:
        a, b = np.triu_indices(total.shape[1])
        n, s, q, c = total
        cols = {"a": a, "b": b, "n": n[a, b], "sa": s[a, b], "sb": s[b, a], "qa": q[a, b], "qb": q[b, a], "c": c[a, b]}
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k in "ab" else pa.float64()) for k, v in cols.items()})


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AG11: Pearson r for every pair (a, b) with a before b in `columns`,
    over the rows where both are present (NaN counts as missing, as in pandas).

    A task turns its Arrow batches into Gram matrices of values and null
    masks and emits one row of sums per pair, whatever its number of rows;
    these rows are added up by a grouped aggregate. Values are shifted by
    their column's mean first (by the value itself if it is constant), so
    that sums of squares keep their digits. A task holds four matrices of
    p x p numbers. Constant (or all-null) columns give null (Q16).
    """
    cols = list(columns)
    pairs = [(i, j, a, b) for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    spark = df.sparkSession
    if not pairs:
        return spark.createDataFrame([], "col_a string, col_b string, corr double")
    x = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"_x{i}") for i, c in enumerate(cols)])
    shifts = x.agg(*[
        F.when(F.min(f"_x{i}") == F.max(f"_x{i}"), F.min(f"_x{i}")).otherwise(F.avg(f"_x{i}")).alias(f"_s{i}") for i in range(len(cols))
    ])  # one row
    centred = x.crossJoin(F.broadcast(shifts)).select(*[(F.col(f"_x{i}") - F.col(f"_s{i}")).alias(f"_x{i}") for i in range(len(cols))])
    sums = centred.mapInArrow(_gram_sums, "a int, b int, n double, sa double, sb double, qa double, qb double, c double")
    g = sums.where("a < b").groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "qa", "qb", "c")])

    def spread(s: str, q: str) -> Column:
        v = F.col(q) - F.col(s) * F.col(s) / F.col("n")
        return F.when(v > F.col(q) * _FLAT, F.sqrt(v))

    r = (F.col("c") - F.col("sa") * F.col("sb") / F.col("n")) / (spread("sa", "qa") * spread("sb", "qb"))
    # rounding may carry a perfect correlation past 1
    r = F.when(F.col("n") > 1, F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    named = spark.createDataFrame(pairs, "a int, b int, col_a string, col_b string")
    # least and greatest skip nulls, so a null r must be told apart
    found = g.where(F.col("n") > 0).select("a", "b", F.when(spread("sa", "qa").isNotNull() & spread("sb", "qb").isNotNull(), r).alias("corr"))
    return named.join(found, ["a", "b"], "left").select("col_a", "col_b", "corr")


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """AG12: `bins` equal-width bins over [min, max], last bin closed.

    Returns (bin, lower, count), empty bins included; no rows if there are no
    values. The bounds are a one-row aggregate, the bins at most `bins` rows.
    """
    x = F.col(column).cast("double")
    mm = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx")).where("_mn is not null")
    width = F.col("_mx") - F.col("_mn")
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((x - F.col("_mn")) / width * F.lit(float(bins))), F.lit(bins - 1)))
    counts = df.where(x.isNotNull()).crossJoin(F.broadcast(mm)).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    every = mm.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_mn", width.alias("_w"))
    every = every.select("bin", (F.col("_mn") + F.col("_w") * F.col("bin") / F.lit(float(bins))).alias("lower"))
    return every.join(counts, "bin", "left").select("bin", "lower", F.coalesce("_n", F.lit(0)).alias("count"))


def null_map(df: DataFrame, columns: Sequence[str], key: str = "incident_id") -> DataFrame:
    """AG13: per-row 0/1 null indicators."""
    return df.select(key, *[F.col(c).isNull().cast("int").alias(f"{c}_isnull") for c in columns])


def mode_by(df: DataFrame, group: str, value: str) -> DataFrame:
    """AG14: modal value per group, ties -> smallest value (null values ignored)."""
    vc = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("freq"))
    best = vc.groupBy(group).agg(F.max("freq").alias("freq"))
    return vc.join(best, [group, "freq"]).groupBy(group).agg(F.min(value).alias("mode"), F.first("freq").alias("freq"))


def relative_frequency(df: DataFrame, column: str, name: str = "freq") -> DataFrame:
    """AG17: share of rows per value (count / total)."""
    total = df.agg(F.count(F.lit(1)).alias("_t"))
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("_c"))
        .crossJoin(F.broadcast(total))
        .select(column, (F.col("_c") / F.col("_t")).alias(name))
    )


def table_counts(df: DataFrame, columns: Sequence[str], distinct_of: Sequence[str]) -> DataFrame:
    """AG16: total rows, non-null counts per column, exact distinct counts."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"nonnull_{c}") for c in columns],
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in distinct_of],
    )
