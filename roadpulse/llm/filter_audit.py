"""How filters interact: what each removes before and after the others, in every order.

Each filter has a relation of the ids that fail it. The survivors of a set of filters are
the survivors of a smaller set, left-anti joined with one more relation. What the next
filter removes is its relation left-semi joined with them; what it finds gone already is
its relation left-anti joined with them. An order of filters
meets only such sets, so all orders are put together from 2^n of them.

The id relations are tables bucketed by id: the rows are dealt once, the relations are cut
from them as they lie, and all joins run inside the buckets without another shuffle. The
counts of several sets are summed by one job. Texts are read once.

Defined results: a null text is empty, a null part the empty string. Rows are told apart
by a number of their own, so null and repeated ids count row by row; a row without an id
has no label and is no copy of another (and none of it). Labels that repeat count once.
An empty table has no parts and no rows. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, pick

#: Rows of an id table's bucket (two numbers and a short text each). Small tables have one: the many joins of a level run side by side.
BUCKET_ROWS = 1_000_000
#: Jobs that run side by side.
JOBS = 4
#: Sets of filters that are counted by one job and one shuffle. The plans of all such jobs are equal; they run
#: one after another, as the driver holds the plan of each.
SETS = 4
#: Stands for no filter.
ALL = "-"
SPACE = "[\\x20\\x09-\\x0D]+"


class Relations:
    """Bucketed id tables of one run, registered under names of their own until ``drop``.

    Tables may be stored from several threads.
    """

    def __init__(self, scratch: Scratch, buckets: int):
        self.scratch, self.buckets = scratch, buckets
        self._run, self._names, self._lock = uuid.uuid4().hex, [], threading.Lock()

    def store(self, df: DataFrame, label: str, *, dealt: bool = False) -> DataFrame:
        """``dealt``: the rows come from tables of buckets, or joins inside them, and lie right already."""
        with self._lock:
            name, path = f"ids_{self._run}_{len(self._names)}", self.scratch.path(label)
            self._names.append(name)
        rows = df if dealt else df.repartition(self.buckets, "row")
        rows.write.bucketBy(self.buckets, "row").sortBy("row").option("path", path).saveAsTable(name)
        return self.scratch.spark.table(name)

    def drop(self) -> None:
        for name in self._names:
            self.scratch.spark.sql(f"drop table if exists {name}")


def _with(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    # merge joins keep the left side's buckets, whatever the sizes
    return left.join(right.select("row").hint("merge"), "row", how)


def text_filters(text: Column, *, min_words: int = 100, distinct_percent: int = 80, capital_percent: int = 10, marks: str = "#$%&*|") -> dict[str, Column]:
    """Failure conditions A to D: too few words, too few distinct ones, too many capitals, marks."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < min_words,
        "B": 100 * F.size(F.array_distinct(words)) < distinct_percent * F.size(words),
        "C": 100 * capitals > capital_percent * F.length(text),
        "D": text.rlike("[" + marks + "]"),
    }


def failing_ids(docs: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> tuple[DataFrame, dict[str, DataFrame], Relations]:
    """``row, part, good, toxic`` of every document, and of those that fail each filter.

    Filters A to D look at a text by itself; E fails texts that equal that of a smaller id.
    """
    src = pick(docs, id=id_col, text=text_col, part=part_col)
    src = src.select("id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    conditions = text_filters(F.col("text"))
    facts = src.select(
        F.monotonically_increasing_id().alias("row"), "id", "part", F.unhex(F.sha2("text", 256)).alias("sha"), *[c.alias(f) for f, c in conditions.items()]
    )
    facts = scratch.table(facts, "facts")
    told = pick(labels, id=id_col, quality="quality", toxic="toxic").where("id is not null")
    told = told.groupBy("id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # written, so that both sides of the joins are exchanged as they are and AQE can split a hot key
    told = scratch.table(told, "labels")
    firsts = facts.groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first")
    firsts = scratch.table(firsts, "firsts")
    rows = facts.agg(F.count("*")).first()[0]
    relations = Relations(scratch, -(-rows // BUCKET_ROWS) or 1)
    flag = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    marked = facts.join(told, "id", "left").select("row", "part", "id", "sha", *conditions, flag("good"), flag("toxic"))
    marked = scratch.table(marked, "marked").join(firsts, "sha", "left")
    of = ("row", "part", "good", "toxic")
    # the rows are dealt once; the relations are cut from them where they lie
    dealt = relations.store(marked.select(*of, *conditions, F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("E")), "dealt")
    filters = [*conditions, "E"]
    with ThreadPoolExecutor(JOBS) as pool:
        ids = pool.submit(relations.store, dealt.select(*of), "ids", dealt=True)
        failing = {f: pool.submit(relations.store, dealt.where(f).select(*of), f"fails-{f}", dealt=True) for f in filters}
    return ids.result(), {f: t.result() for f, t in failing.items()}, relations


def audit(ids: DataFrame, failing: dict[str, DataFrame], relations: Relations) -> DataFrame:
    """One row per part, order of all filters and step; see ``orders``.

    ``ids`` and each filter's failing ids (both row, part, good, toxic) are tables of ``relations``.
    """
    scratch, names = relations.scratch, sorted(failing)
    bit = {f: 1 << n for n, f in enumerate(names)}
    survivors, spark, counts = {0: ids}, scratch.spark, scratch.path("counts")
    every = [failing[f].select("row", "part", F.lit(f).alias("filter"), "good", "toxic") for f in names]
    fails = relations.store(reduce(DataFrame.union, every), "fails", dealt=True)

    def store(mask: int) -> None:
        by = max(f for f in names if mask & bit[f])
        left = _with(survivors[mask & ~bit[by]], failing[by], "left_anti")
        survivors[mask] = relations.store(left, f"survivors-{mask}", dealt=True)

    def rows(mask: int) -> DataFrame:
        left = survivors[mask]
        out = left.select("part", F.lit(ALL).alias("filter"), "good", "toxic", F.lit("kept").alias("kind"))
        out = out.union(_with(fails, left, "left_semi").select("part", "filter", "good", "toxic", F.lit("removed")))
        out = out.union(_with(fails, left, "left_anti").select("part", "filter", "good", "toxic", F.lit("redundant")))
        # as text the set is no part of the compiled code
        return out.withColumn("mask", F.lit(str(mask)))

    def count(masks: range) -> None:
        sums = reduce(DataFrame.union, map(rows, masks)).groupBy("part", "filter", "kind", "mask")
        sums = sums.agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
        # the first set stands in the folder's name
        sums.select("part", "filter", "kind", "n", "good", "toxic", F.col("mask").cast("int").alias("mask")).write.parquet(f"{counts}/from={masks[0]}")

    with ThreadPoolExecutor(JOBS) as pool:
        for size in range(1, len(names) + 1):
            list(pool.map(store, [m for m in range(1 << len(names)) if m.bit_count() == size]))
    for at in range(0, 1 << len(names), SETS):
        count(range(at, min(at + SETS, 1 << len(names))))
    schema = "part string, filter string, kind string, n bigint, good bigint, toxic bigint, mask int"
    return orders(spark.read.schema(schema).parquet(counts), names)


def orders(counts: DataFrame, names: list[str]) -> DataFrame:
    """Counts for each set of filters (``mask``: a bit a filter) and next filter, put together to all orders.

    ``part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.
    """
    spark, n = counts.sparkSession, len(names)
    bit = {f: 1 << k for k, f in enumerate(names)}
    steps = [
        ("".join(order), k + 1, f, sum(bit[g] for g in order[:k]), sum(bit[g] for g in order[: k + 1]))
        for order in itertools.permutations(names)
        for k, f in enumerate(order)
    ]
    grid = spark.createDataFrame(steps, "filter_order string, step int, filter string, before int, after int")  # a row a step of an order
    sets = [(m, f) for m in range(1 << n) for f in names if not m & bit[f]]
    parts = counts.where("mask = 0 and kind = 'kept'").select("part")
    places = parts.select("part", F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(f).alias("filter")) for m, f in sets])).alias("p")).select("part", "p.*")
    removed = counts.where("kind = 'removed'").select("part", "mask", "filter", F.col("n").alias("removed"), "good", "toxic")
    redundant = counts.where("kind = 'redundant'").select("part", "mask", "filter", F.col("n").alias("redundant"))
    key = ["part", "mask", "filter"]
    sums = places.join(removed, key, "left").join(redundant, key, "left").na.fill(0)
    alone = sums.select("part", "filter", "mask", F.col("removed").alias("unique_fails"))
    alone = alone.where(F.expr(" or ".join(f"(filter = '{f}' and mask = {(1 << n) - 1 - bit[f]})" for f in names))).drop("mask")
    kept = counts.where("kind = 'kept'").select("part", F.col("mask").alias("after"), F.col("n").alias("kept"))
    out = sums.join(F.broadcast(grid.withColumnRenamed("before", "mask")), ["mask", "filter"])
    share = out.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    out = out.join(kept, ["part", "after"], "left").join(alone, ["part", "filter"]).join(share, ["part", "filter"])
    return out.select(
        "part", "filter_order", "step", "filter", F.coalesce("kept", F.lit(0)).alias("kept"), "removed", "redundant", "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
    )


def audit_documents(docs: DataFrame, labels: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The audit of filters A to E over all documents; the id tables are gone when it returns."""
    ids, failing, relations = failing_ids(docs, labels, scratch, id_col=id_col, text_col=text_col, part_col=part_col)
    try:
        return scratch.table(audit(ids, failing, relations), "audit")
    finally:
        relations.drop()
