"""Near-duplicate documents by an LSH forest of MinHash signatures.

A document's set holds its distinct shingles. ``TREES`` orders sort all distinct sets
by ``DEPTH`` signature values each; a set's candidates are its neighbours in every
order that share at least the first value, nearest first. Where many sets share a
prefix the neighbours agree on deeper ones, and in sparse regions on shallower ones,
so each region settles its own depth. Candidates pass a size test and a sketch of one
bit a hash (both far on the safe side of the threshold), then the link is confirmed on
the full sets. Links between sets that are already connected need no confirmation, as
only components are asked for.

Equal sets are one node from the start. Orders are dealt by position, not by key, so a
large group of near copies is spread over the tasks; first a node has at most
``2 * NEIGHBOURS`` candidates in an order, and a group is connected through chains of
neighbours. Then regions, sets that share a prefix in an order, that are larger than the
neighbours' window and still hold several components are compared whole: every pair of
different components. A region with more than ``REGION_PAIRS`` of them descends to longer
prefixes, on to the values of the orders that follow, until it fits. Nothing but counts
reaches the driver.

Defined results: a null text, or one without words, has an empty set, is linked with
nothing and is its own component; a text with fewer words than a shingle has its whole
sequence as its only shingle; rows with equal texts are always one component, also if
ids repeat; null ids are ignored for ``component_id`` unless a component has no other,
and then it's null and its rows are kept; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHashes, batch_of, pick, positional, positions, slices, small, worker_state
from .components import components

TREES, DEPTH = 12, 8
HASHES = TREES * DEPTH
#: Neighbours on either side of a position, rows of a block of positions.
NEIGHBOURS, BLOCK_ROWS = 8, 20_000
#: Prefix lengths at which a region is looked at, pairs of different components that it may hold, and rows and shingles of a task's block of it.
DEPTHS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, HASHES)
REGION_PAIRS, REGION_ROWS, REGION_SHINGLES = 1 << 18, 1 << 12, 1 << 21
#: Share of equal signature values this much below the likeness asked for is five deviations below it.
CLOSE = 0.2
#: At a likeness of 0.8, 0.9 of the sketch's bits agree, with a deviation of 0.031; 0.75 is five deviations below.
MIN_SKETCH = 0.75

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SEED = np.random.default_rng(20_240_501)
_XOR = _SEED.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_ODD = _SEED.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    parts = text.encode("utf-8", "replace").translate(_LOWER).split() if text else []
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(worker_state("minhash words", WordHashes).__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(h))
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * _MUL + h[k : len(h) - n + 1 + k]
    return np.unique(_mixed(out + np.uint64(n)))


def signature(own: np.ndarray) -> np.ndarray:
    """The least value of a set under each hash."""
    out = np.empty(HASHES, np.uint32)
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 4096):  # long texts in bounded parts
        part = own[at : at + 4096]
        for k in range(HASHES):
            least[k] = min(least[k], ((part ^ _XOR[k]) * _ODD[k]).min())
    out[:] = least >> np.uint64(32)
    return out


def sign(df: DataFrame, *, id_col: str, text_col: str, words: int) -> DataFrame:
    """``id, text_hash, n, digest, values, sketch`` of every row; one pass over the texts."""
    src = pick(df, id=id_col, text=text_col).withColumn("text_hash", F.xxhash64("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                n, digest, values, sketch = [], [], [], []
                for text in part.column("text").to_pylist():
                    own = shingle_set(text, words)
                    n.append(len(own))
                    if not len(own):
                        digest.append(None)
                        values.append(None)
                        sketch.append(None)
                        continue
                    mins = signature(own)
                    digest.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    values.append(mins.astype(">u4").tobytes())
                    sketch.append(np.packbits((mins & np.uint32(1)).astype(np.uint8)).tobytes())
                schema = pa.schema([("id", part.column("id").type), ("text_hash", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("values", pa.binary()), ("sketch", pa.binary())])
                yield batch_of(schema, [part.column("id"), part.column("text_hash"), n, digest, values, sketch])

    return src.mapInArrow(run, f"id {kind}, text_hash bigint, n bigint, digest binary, values binary, sketch binary")


def neighbours(pdf: pd.DataFrame, likeness: float) -> pd.DataFrame:
    """Candidate pairs among sorted positions: ``a < b`` and their distance in the order."""
    pdf = pdf.sort_values("position")
    node, n = pdf["node"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    tree = pdf["tree"].to_numpy()
    keys = np.frombuffer(b"".join(pdf["key"]), dtype=">u4").reshape(len(pdf), DEPTH)
    bits = np.frombuffer(b"".join(pdf["sketch"]), dtype=np.uint8).reshape(len(pdf), -1)
    same = (keys[1:] == keys[:-1]) & (tree[1:] == tree[:-1])[:, None]
    step = np.cumprod(same, axis=1).sum(axis=1)  # common prefix of adjacent rows
    found, prefix = [], step.copy()
    for d in range(1, min(NEIGHBOURS, len(pdf) - 1) + 1):
        if d > 1:
            prefix = np.minimum(prefix[:-1], step[d - 1 :])
        i = np.flatnonzero(prefix > 0)
        if not len(i):
            break
        j = i + d
        i, j = (x[np.minimum(n[i], n[j]) >= likeness * np.maximum(n[i], n[j])] for x in (i, j))
        agree = 1 - np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1) / HASHES
        i, j, agree = (x[agree >= MIN_SKETCH] for x in (i, j, agree))
        found.append(pd.DataFrame({"a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j]), "tree": tree[i], "distance": d}))
    out = pd.concat(found) if found else pd.DataFrame({"a": [], "b": [], "tree": [], "distance": []})
    return out.astype({"a": np.int64, "b": np.int64, "tree": np.int32, "distance": np.int32})


def candidates(nodes: DataFrame, scratch: Scratch, likeness: float) -> DataFrame:
    """``nodes``: node, n, values, sketch -> a, b, tree, distance."""
    width = 4 * DEPTH
    orders = nodes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))).select(
        "tree", F.expr(f"substring(values, tree * {width} + 1, {width})").alias("key"), "sketch", "n", "node"
    )
    # the node breaks ties, so equal keys may be split between tasks
    position, _ = positions(orders, ["tree", "key", "node"], scratch)
    block = F.floor(F.col("position") / BLOCK_ROWS)
    # the last rows of a block also stand at the head of the next
    again = F.when(F.pmod("position", F.lit(BLOCK_ROWS)) >= BLOCK_ROWS - NEIGHBOURS, F.array(block, block + 1)).otherwise(F.array(block))
    blocks = position.select("tree", "key", "sketch", "n", "node", "position", F.explode(again).alias("block"))
    return blocks.groupBy("block").applyInPandas(lambda pdf: neighbours(pdf, likeness), "a bigint, b bigint, tree int, distance int")


def full_sets(df: DataFrame, wanted: DataFrame, *, id_col: str, text_col: str, words: int) -> DataFrame:
    """``node, shingles`` for ``wanted`` (node, id, text_hash), from the whole texts."""
    src = pick(df, id=id_col, text=text_col).withColumn("text_hash", F.xxhash64("text"))
    found = src.join(wanted.withColumnRenamed("id", "own"), (F.col("id").eqNullSafe(F.col("own"))) & (src["text_hash"] == wanted["text_hash"])).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])
        for b in batches:
            for part in slices(b):
                yield batch_of(schema, [part.column("node"), [shingle_set(t, words).tobytes() for t in part.column("text").to_pylist()]])

    return found.mapInArrow(run, "node bigint, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            for part in slices(batch):
                keep = []
                for x, y in zip(part.column("sa").to_pylist(), part.column("sb").to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                mask = pa.array(keep, pa.bool_())
                yield batch_of(schema, [part.column("a").filter(mask), part.column("b").filter(mask)])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def regions(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of all regions that the windows don't cover whole and that hold several components.

    ``nodes``: node, n, values, component -> node, n, values, component, region, block, main.
    ``main`` tells the rows of a region's largest component; a region of many rows deals them
    to blocks, and its other rows stand in every block, so each pair of different components
    shares a block.
    """
    found = []
    rows = nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    for depth in DEPTHS:
        prefix = F.expr(f"substring(concat(values, values), tree * {4 * DEPTH} + 1, {4 * depth})")
        # at first all nodes, without a join
        own = rows.join(nodes, "node") if found else nodes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
        keyed = own.withColumn("region", F.xxhash64("tree", prefix))
        stats = keyed.groupBy("region", "component").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
        stats = stats.groupBy("region").agg(F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"), F.max("rows").alias("most"), F.max_by("component", "rows").alias("largest"))
        # what a window holds has been compared
        stats = scratch.table(stats.where((F.col("rows") > NEIGHBOURS + 1) & (F.col("most") < F.col("rows"))), "regions")
        fits = F.col("rows") * (F.col("rows") - F.col("most")) <= REGION_PAIRS if depth < HASHES else F.lit(True)
        level = keyed.select("node", "tree", "component", "region").join(small(stats.withColumn("fits", fits)), "region")
        level = scratch.table(level.select("node", "tree", "region", "fits", "rows", "shingles", (F.col("component") == F.col("largest")).alias("main")), "level")
        found.append(level.where("fits").withColumn("region", F.xxhash64(F.lit(depth), "region")))
        rows = level.where("not fits").select("node", "tree")
        if rows.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    blocks = F.greatest(F.ceil(F.col("rows") / REGION_ROWS), F.ceil(F.col("shingles") / REGION_SHINGLES)).cast("int")
    dealt = F.when(F.col("main"), F.array(F.pmod(F.xxhash64("node"), blocks).cast("int"))).otherwise(F.sequence(F.lit(0), blocks - 1))
    return out.select("node", "region", "main", F.explode(dealt).alias("block")).join(nodes, "node")


def close_rows(pdf: pd.DataFrame, likeness: float) -> pd.DataFrame:
    """The rows of a region's block that may be alike to a row of another component, by size and signature."""
    component, n = pdf["component"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    values = np.frombuffer(b"".join(pdf["values"]), dtype=">u4").reshape(len(pdf), HASHES).astype(np.uint32)
    keep = np.zeros(len(pdf), bool)
    for x in np.flatnonzero(~pdf["main"].to_numpy(bool)):
        near = np.flatnonzero((component != component[x]) & (np.minimum(n, n[x]) >= likeness * np.maximum(n, n[x])))
        near = near[(values[near] == values[x]).mean(axis=1) >= likeness - CLOSE]
        keep[near] = True
        keep[x] |= len(near) > 0
    return pdf.loc[keep, ["region", "block", "node", "component", "main"]]


def region_links(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the components of a region's block, by the full sets; none between rows that are connected already."""
    node = pdf["node"].to_numpy(np.int64)
    sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
    n = np.array([len(x) for x in sets], np.int64)
    starts = np.r_[0, np.cumsum(n)[:-1]]
    words, flat = np.unique(np.concatenate(sets), return_inverse=True)
    root, marks, out = np.unique(pdf["component"].to_numpy(np.int64), return_inverse=True)[1], np.zeros(len(words), np.int32), []
    for x in np.flatnonzero(~pdf["main"].to_numpy(bool)):
        own = flat[starts[x] : starts[x] + n[x]]
        marks[own] = 1
        both = np.add.reduceat(marks[flat], starts)
        marks[own] = 0
        alike = np.flatnonzero((100 * both >= percent * (n + n[x] - both)) & (root != root[x]))
        for y in alike:
            if root[y] != root[x]:
                out.append((min(node[x], node[y]), max(node[x], node[y])))
                root[root == root[y]] = root[x]
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def region_pairs(df: DataFrame, t: DataFrame, nodes: DataFrame, scratch: Scratch, *, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``a, b``: links between components that the neighbours' windows left apart; ``nodes`` as in `regions`."""
    kind = "region bigint, block int, node bigint, component bigint, main boolean"
    close = regions(nodes, scratch).groupBy("region", "block").applyInPandas(lambda pdf: close_rows(pdf, percent / 100), kind)
    close = scratch.table(close, "close")
    wanted = t.select("row", "id", "text_hash").join(small(close.select(F.col("node").alias("row")).distinct()), "row").select(F.col("row").alias("node"), "id", "text_hash")
    sets = full_sets(df, wanted, id_col=id_col, text_col=text_col, words=words)
    sets = sets.groupBy("node").agg(F.first("shingles").alias("shingles"))
    links = close.join(sets, "node").groupBy("region", "block").applyInPandas(lambda pdf: region_links(pdf, percent), "a bigint, b bigint")
    return scratch.table(links, "links")


def near_duplicates(df: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """``id, n_shingles, component_id, kept, text_hash`` of every row."""
    t = scratch.table(sign(df, id_col=id_col, text_col=text_col, words=words).withColumn("row", F.monotonically_increasing_id()), "signatures")
    # equal sets are one node, named by its first row with an id
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("row")))
    nodes = scratch.table(t.where("n > 0").groupBy("digest").agg(first.alias("f"), F.min("id").alias("least_id")).select("digest", F.col("f.row").alias("node"), "least_id"), "nodes")
    signed = t.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "n", "values", "sketch")
    signed = scratch.table(signed, "signed")
    found = candidates(signed, scratch, percent / 100)
    pairs = scratch.table(found.groupBy("a", "b").agg(F.min(F.when(F.col("tree") < 2, F.col("distance")).otherwise(NEIGHBOURS + 1)).alias("first")), "pairs")

    ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    wanted = t.select("row", "id", "text_hash").join(ends, "row").select(F.col("row").alias("node"), "id", "text_hash")
    sets = full_sets(df, wanted, id_col=id_col, text_col=text_col, words=words)
    sets = scratch.table(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")
    # next neighbours of two orders connect most of what is alike; the rest is confirmed where it would connect more
    links = scratch.table(confirmed(pairs.where(F.col("first") == 1).select("a", "b"), sets, percent), "links")
    groups = scratch.table(components(links, scratch), "groups")
    label = lambda end: groups.select(F.col("node").alias(end), F.col("component").alias("c" + end))
    apart = pairs.where(F.col("first") > 1).join(label("a"), "a", "left").join(label("b"), "b", "left")
    apart = apart.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    more = scratch.table(confirmed(apart, sets, percent), "links")
    over = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    groups = scratch.table(components(over, scratch), "groups")
    # what the windows left apart in regions that are larger
    labelled = signed.drop("sketch").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = scratch.table(labelled, "labelled")
    scratch.drop_table(signed)
    last = region_pairs(df, t, labelled, scratch, id_col=id_col, text_col=text_col, words=words, percent=percent)
    if not last.isEmpty():
        over = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
        ends = last.join(label("a"), "a", "left").join(label("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        groups = scratch.table(components(over.unionByName(ends), scratch), "groups")

    named = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = scratch.table(named.groupBy("component").agg(F.min("least_id").alias("component_id")), "least")
    classes = scratch.table(named.select("digest", "component").join(least, "component").select("digest", "component_id"), "classes")
    out = t.select("id", "n", "digest", "text_hash").join(classes, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), "text_hash")
    return out.select(id_col, "n_shingles", "component_id", F.col(id_col).eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")


def keep_one(df: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df``, all columns: one document of each component stays.

    Rows are told apart by id and text. The list of those that go is broadcast if it's
    small, by a count that is checked; else it's joined by a shuffle.
    """
    found = near_duplicates(df, scratch, id_col=id_col, text_col=text_col, words=words, percent=percent)
    gone = scratch.table(found.where(~F.col("kept")).select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_th")).distinct(), "gone")
    flat, names = positional(df)
    key, text = (F.col(f"_c{names.index(c)}") for c in (id_col, text_col))
    flat = flat.withColumn("_h", F.xxhash64(text))
    return flat.join(small(gone), key.eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_th")), "left_anti").drop("_h").toDF(*names)
