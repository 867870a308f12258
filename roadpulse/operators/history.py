"""History / window features per zone (WN1–WN5, WN8).

A plain `Window.partitionBy(zone)` puts a whole zone into one task; with a
zone holding a third of all rows that task is the job. These operators split
every zone into time buckets instead:

* per-row work is a window over one (zone, bucket) slice only;
* what crosses buckets is carried by a small per-(zone, bucket) summary
  table (sums, counts, last values) and a window over that summary, whose
  size is zones x active buckets — independent of the row count.

Results equal the plain window definitions (checked against SQL windows in
the oracle): RANGE frames include all peers with the same timestamp; ROW
orders break timestamp ties by the incident id; rows without a timestamp sort
after all timed rows, ordered by id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import as_ts

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
DEFAULT_BUCKET_US = DAY_US
# Rows without a timestamp sort last: they get buckets above every timed one.
_NULL_BUCKET_BASE = 1 << 40
_NULL_BUCKET_ROWS = 1 << 16


def _t(ts: str) -> F.Column:
    return F.unix_micros(as_ts(ts))


def _bucket(df: DataFrame, ts: str, key: str, bucket_us: int) -> F.Column:
    """Order-preserving bucket: time buckets, then id buckets for null ts.

    A number's bucket is its multiple of `_NULL_BUCKET_ROWS`, a text's its first
    four bytes; both follow the order of the ids."""
    if isinstance(df.schema[key].dataType, T.NumericType):
        idb = F.floor(F.col(key).cast("double") / _NULL_BUCKET_ROWS).cast("long")
    else:
        lead = F.substring(F.hex(F.encode(F.col(key).cast("string"), "UTF-8")), 1, 8)
        idb = F.conv(F.rpad(lead, 8, "0"), 16, 10).cast("long")
    return F.when(F.col(ts).isNull(), F.lit(_NULL_BUCKET_BASE) + idb).otherwise(F.floor(_t(ts) / F.lit(bucket_us)).cast("long"))


def trailing_counts(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    widths_us: dict[str, int],
    bucket_us: int = DEFAULT_BUCKET_US,
    weight: str | None = None,
) -> DataFrame:
    """WN1: for each timed row, rows of its group with timestamp in (t - w, t].

    With `weight`, each row counts with that weight (0 makes a row a pure
    probe: it gets counts of the other rows without being counted — the
    scoring-time lookup of history counts at request times).

    Rows are first summed to (group, t), which combines map-side and takes
    ties together. Each sum enters at t and leaves at t + w for every width; the
    count at t is the running sum of what has entered or left by t. Running
    sums are split into (group, bucket) slices plus the totals of all earlier
    buckets, from a small per-bucket summary. The counts are joined back once
    on (group, t); untimed rows get nulls.
    """
    by = list(by)
    names = list(widths_us)
    wt = F.sum(F.col(weight).cast("long")) if weight else F.count(F.lit(1))
    sums = df.where(F.col(ts).isNotNull()).groupBy(*by, _t(ts).alias("_t")).agg(wt.alias("_n"))
    zero = F.lit(0).cast("long")
    events = [F.struct(F.col("_t").alias("at"), F.lit(True).alias("probe"), *[F.col("_n").alias(n) for n in names])]
    for n, w in widths_us.items():
        events.append(F.struct((F.col("_t") + F.lit(w)).alias("at"), F.lit(False).alias("probe"), *[(-F.col("_n") if m == n else zero).alias(m) for m in names]))
    e = sums.select(*by, F.explode(F.array(*events)).alias("_e")).select(*by, "_e.*")
    e = e.withColumn("_b", F.floor(F.col("at") / F.lit(bucket_us)).cast("long"))
    w_in = Window.partitionBy(*by, "_b").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.select(*by, "_b", "at", "probe", *[F.sum(n).over(w_in).alias(n) for n in names])
    # totals of a bucket = running sums at its last time; offsets = earlier buckets
    tot = e.groupBy(*by, "_b").agg(*[F.max_by(F.col(n), F.col("at")).alias(f"_tot_{n}") for n in names])
    w_prev = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_b").alias("_by_b"),
        *[F.coalesce(F.sum(f"_tot_{n}").over(w_prev), F.lit(0)).alias(f"_off_{n}") for n in names],
    )
    # null-safe: rows without a group form one
    on = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    counts = e.where("probe").join(tot, [*on, F.col("_b") == F.col("_by_b")]).select(
        *[F.col(f"_by_{c}") for c in by], F.col("at"), *[(F.col(n) + F.col(f"_off_{n}")).cast("double").alias(n) for n in names]
    )
    on = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    return df.join(counts, [*on, _t(ts) == F.col("at")], "left").drop(*[f"_by_{c}" for c in by], "at")


def fill_untimed_with_group_mean(df: DataFrame, by: Sequence[str], ts: str, columns: Sequence[str]) -> DataFrame:
    """WN2: untimed rows take the group's mean over its timed rows (0 if none)."""
    by = list(by)
    means = df.where(F.col(ts).isNotNull()).groupBy(*by).agg(*[F.avg(c).alias(f"_gm_{c}") for c in columns])
    out = df.join(means, on=by, how="left")
    for c in columns:
        out = out.withColumn(c, F.when(F.col(ts).isNull(), F.coalesce(F.col(f"_gm_{c}"), F.lit(0.0))).otherwise(F.col(c)))
    return out.drop(*[f"_gm_{c}" for c in columns])


def previous_value(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    key: str,
    value: str,
    name: str,
    bucket_us: int = DEFAULT_BUCKET_US,
) -> DataFrame:
    """WN3: value of the previous row of the group in (ts asc nulls last, key) order.

    Within a (group, bucket) slice a lag does the work; the first row of a
    slice takes the last value of the nearest earlier non-empty bucket,
    found on the small per-bucket summary.
    """
    by = list(by)
    b = _bucket(df, ts, key, bucket_us)
    tkey = F.coalesce(_t(ts), F.lit(None).cast("long"))
    d = df.withColumn("_b", b).withColumn("_tk", tkey)
    order = [F.col("_tk").asc_nulls_last(), F.col(key).asc()]
    w = Window.partitionBy(*by, "_b").orderBy(*order)
    d = d.withColumn("_lag", F.lag(F.col(value)).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    last = d.groupBy(*by, "_b").agg(
        F.max_by(F.col(value), F.struct(F.coalesce(F.col("_tk"), F.lit(None).cast("long")).isNull(), F.col("_tk"), F.col(key))).alias("_last")
    )
    wp = Window.partitionBy(*by).orderBy("_b")
    last = last.select(*by, "_b", F.lag("_last").over(wp).alias("_prev_bucket_last"))
    d = d.join(last, on=[*by, "_b"], how="left")
    prev = F.when(F.col("_first"), F.col("_prev_bucket_last")).otherwise(F.col("_lag"))
    return d.withColumn(name, prev).drop("_b", "_tk", "_lag", "_first", "_prev_bucket_last")


def group_mean(
    df: DataFrame, by: Sequence[str], value: str, name: str, drop_null_keys: bool = True, source: DataFrame | None = None
) -> DataFrame:
    """WN4/WN5/JN4: mean of `value` over the whole group, on every row.

    A partial+final aggregate joined back (AQE broadcasts the group table
    when small), so the row table is never shuffled by a hot key. Null keys
    get null (pandas drops null group keys) unless drop_null_keys=False.
    `source` computes the statistics from another (upstream) frame, so that
    chaining several of these keeps the plan linear.
    """
    by = list(by)
    src = df if source is None else source
    if drop_null_keys:
        cond = None
        for k in by:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        src = src.where(cond)
    means = src.groupBy(*by).agg(F.avg(value).alias(name))
    return df.join(means, on=by, how="left")


def group_count(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """WN6: rows per group on every row (aggregate + join back)."""
    by = list(by)
    cnt = df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    return df.join(cnt, on=by, how="left")


def prior_mean(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    key: str,
    value: str,
    name: str,
    bucket_us: int = DEFAULT_BUCKET_US,
) -> DataFrame:
    """WN8: leakage-safe mean of `value` over strictly earlier rows of the group
    in (ts asc nulls last, key) order; null for the first row.
    """
    by = list(by)
    d = df.withColumn("_b", _bucket(df, ts, key, bucket_us)).withColumn("_tk", _t(ts))
    order = [F.col("_tk").asc_nulls_last(), F.col(key).asc()]
    w = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    v = F.col(value).cast("double")
    d = d.withColumn("_ps", F.coalesce(F.sum(v).over(w), F.lit(0.0))).withColumn("_pc", F.coalesce(F.count(v).over(w), F.lit(0)))
    summ = d.groupBy(*by, "_b").agg(F.sum(v).alias("_bs"), F.count(v).alias("_bc"))
    wp = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*by, "_b", F.coalesce(F.sum("_bs").over(wp), F.lit(0.0)).alias("_os"), F.coalesce(F.sum("_bc").over(wp), F.lit(0)).alias("_oc"))
    d = d.join(summ, on=[*by, "_b"], how="left")
    s = F.col("_ps") + F.col("_os")
    c = F.col("_pc") + F.col("_oc")
    return d.withColumn(name, F.when(c > 0, s / c)).drop("_b", "_tk", "_ps", "_pc", "_os", "_oc")
