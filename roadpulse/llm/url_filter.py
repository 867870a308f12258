"""URL filters over a sorted digest array.

The list's entries are strings ``host/path-prefix`` with a verdict. Their 64-bit
xxhash keys are sorted into arrays that every worker memory-maps; a URL's host
suffixes and path prefixes are hashed on the JVM, probed by vectorised binary
search, and each hit is confirmed against the stored full string, so a collision
of digests never decides.

An entry fits its host and all subdomains if the path starts with the entry's;
the longest fitting entry decides, and a URL that none fits gets ``default``.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
Path: then up to ``?``, ``#`` or the end. A null URL, or one without ``://``, has an
empty host and path and gets ``default``.

Defined results: ids may be null or repeat (every row gives one row); entries that
repeat with the same verdict count once, with different verdicts ``block`` wins;
null entries are dropped; an empty list gives every row ``default``; further columns
are ignored.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, pick

#: Entries of one shard of the index (its arrays are built in one task).
SHARD_ENTRIES = 2_000_000
_SHARD = "shard int, entries bigint, digests binary, ends binary, blocks binary, strings binary"


class Index:
    """Shard files of the list, and what bounds the probes of a URL."""

    def __init__(self, files: list[tuple[str, int]], labels: int, lengths: list[int]):
        self.files, self.labels, self.lengths = files, labels, lengths


def build(rules: DataFrame) -> Index:
    """``rules``: host, path, verdict (``allow`` or ``block``).

    Shards are residues of the digest, each sorted and laid out in a Spark task; the
    driver passes one shard at a time on as a file, so it never holds the list.
    """
    spark = rules.sparkSession
    r = pick(rules, host="host", path="path", verdict="verdict").where("host is not null and path is not null and verdict is not null")
    r = r.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("block")).withColumn("rule", F.concat("host", "path"))
    facts = r.agg(F.count("*").alias("n"), F.max(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    if not facts["n"]:
        return Index([], 0, [])
    shards = -(-facts["n"] // SHARD_ENTRIES)

    def lay_out(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["digest", "rule"])
        strings = [s.encode() for s in pdf["rule"]]
        ends = np.cumsum([len(s) for s in strings], dtype=np.int64)
        row = (int(pdf["shard"].iloc[0]), len(pdf), pdf["digest"].to_numpy(np.int64).tobytes(), ends.tobytes(), pdf["block"].to_numpy(np.uint8).tobytes(), b"".join(strings))
        return pd.DataFrame([row], columns=["shard", "entries", "digests", "ends", "blocks", "strings"])

    digest = F.xxhash64("rule")
    keyed = r.select("rule", "block", digest.alias("digest"), F.pmod(digest, F.lit(shards)).cast("int").alias("shard"))
    files = []
    folder = tempfile.mkdtemp(prefix="url-index-")
    for row in keyed.groupBy("shard").applyInPandas(lay_out, _SHARD).orderBy("shard").toLocalIterator():
        name = f"urls-{uuid.uuid4().hex}.idx"
        with open(os.path.join(folder, name), "wb") as f:
            for part in ("digests", "ends", "blocks", "strings"):
                f.write(row[part])
        spark.sparkContext.addFile(os.path.join(folder, name))
        files.append((name, row["entries"]))
    return Index(files, facts["labels"], sorted(facts["lengths"]))


def open_shard(name: str, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Memory-mapped digests, string ends, block flags and strings."""
    raw = np.memmap(SparkFiles.get(name), dtype=np.uint8, mode="r")
    return raw[: 8 * n].view(np.int64), raw[8 * n : 16 * n].view(np.int64), raw[16 * n : 17 * n], raw[17 * n :]


def lookup(shards: list, digests: np.ndarray, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``digests`` whose full string is listed, and whether it's blocked."""
    at, block = [], []
    for sorted_digests, ends, blocks, strings in shards:
        first = np.searchsorted(sorted_digests, digests)
        hits = np.flatnonzero(sorted_digests[np.minimum(first, len(sorted_digests) - 1)] == digests)
        for i in hits.tolist():
            key, j = keys[i].as_py().encode(), int(first[i])
            while j < len(sorted_digests) and sorted_digests[j] == digests[i]:
                if strings[ends[j - 1] if j else 0 : ends[j]].tobytes() == key:
                    at.append(i)
                    block.append(bool(blocks[j]))
                    break
                j += 1
    return np.asarray(at, dtype=np.int64), np.asarray(block, dtype=bool)


def judge(df: DataFrame, index: Index, *, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``id, host, path, rule, verdict`` of every row; one pass without a shuffle."""
    src = pick(df, id=id_col, url=url_col)
    after = F.when(F.instr("url", "://") > 0, F.substring_index(F.substring(F.col("url"), F.instr("url", "://") + 3, F.length("url")), "#", 1))
    src = src.withColumn("rest", F.coalesce(F.substring_index(after, "?", 1), F.lit("")))
    raw_host = F.substring_index("rest", "/", 1)
    lower = F.translate(raw_host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    src = src.select("id", lower.alias("host"), F.substring(F.col("rest"), F.length(raw_host) + 1, F.length("rest")).alias("path"))
    if not index.files:
        return src.select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # only suffixes of as many labels, and prefixes of as many characters, as some entry has
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(index.labels))), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring(F.col("path"), 1, n)) for n in index.lengths]), lambda p: p.isNotNull())
    keys = F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))))
    src = src.withColumn("keys", keys).withColumn("digests", F.transform("keys", lambda k: F.xxhash64(k)))
    files = index.files
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = [open_shard(*f) for f in files]
        for b in batches:
            lists = b.column("keys")
            row = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            keys = lists.flatten()
            at, blocked = lookup(shards, b.column("digests").flatten().to_numpy(), keys)
            rule, verdict = [None] * b.num_rows, [default] * b.num_rows
            found = [keys[i].as_py() for i in at.tolist()]
            for i, k, stop in sorted(zip(row[at].tolist(), found, blocked.tolist()), key=lambda x: (x[0], len(x[1]), x[1].find("/"))):
                rule[i], verdict[i] = k, "block" if stop else "allow"  # the longest comes last
            kept = [b.column(c) for c in ("id", "host", "path")]
            schema = pa.schema([("id", kept[0].type), *[(c, pa.string()) for c in ("host", "path", "rule", "verdict")]])
            yield batch_of(schema, [*kept, rule, verdict])

    return src.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)
