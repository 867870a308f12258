"""Connected components of a table of links, by alternating stars.

Each round hangs every node's larger neighbours, then its smaller ones, on the
smallest node it knows (large star, small star); the number of rounds grows with
the logarithm of the longest path. Everything stays in tables: a round is written
to the shared folder, and only counts and checksums reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _stars(links: DataFrame, both: bool) -> DataFrame:
    """Links (node, to) with node > to, hung on the smallest node known.

    ``both``: a node looks at all neighbours and moves the larger ones; else it looks
    at the smaller ones and moves them with itself.
    """
    if both:
        near = links.unionByName(links.select(F.col("to").alias("node"), F.col("node").alias("to")))
    else:
        near = links
    least = near.groupBy("node").agg(F.min("to").alias("m"))
    least = least.select("node", F.least("m", "node").alias("m"))
    # a key of its own kind: both sides are exchanged for the join, so AQE can split the rows of a node that many hang on
    hung = near.withColumn("k", F.struct("node")).join(least.select(F.struct("node").alias("k"), "m"), "k").drop("k")
    if both:
        moved = hung.where("to > node").select(F.col("to").alias("node"), F.col("m").alias("to"))
    else:
        moved = hung.where("to != m").select(F.col("to").alias("node"), F.col("m").alias("to")).unionByName(least.select("node", F.col("m").alias("to")))
    return moved.where("node != to").distinct()


def components(links: DataFrame, scratch: Scratch, *, rounds: int = 60) -> DataFrame:
    """``links`` (a, b) -> ``node, component``: the smallest node reachable.

    Nodes without a link to another node are left out; links may repeat, point to
    themselves, go either way or hold nulls (dropped).
    """
    now = links.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).distinct()
    now, last = scratch.table(now, "links"), None
    for _ in range(rounds):
        then = now
        now = scratch.table(_stars(_stars(now, True), False), "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))).first()
        if then is not now:
            scratch.drop_table(then)
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    roots = now.select(F.col("to").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select("node", F.col("to").alias("component")).unionByName(roots)
