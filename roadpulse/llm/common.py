"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import checkpoint_dir

#: Rows of a written table of a few numbers a row that is broadcast in a join.
BROADCAST_ROWS = 1_000_000
#: Words whose hashes a worker keeps once they came again, and the longest that is kept.
CACHE_WORDS, CACHE_LENGTH = 120_000, 32
#: Places of a table of words seen before, as a power of two: a byte each.
SEEN_BITS = 21
#: Rows of an Arrow batch that are turned into Python strings at a time.
SLICE = 256


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """``pick(df, out="source")``: the named columns under fixed names.

    Columns are addressed by position, so further columns whose names clash
    (same name again, or another case) do no harm; the first exact match wins.
    """
    names = df.columns
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return flat.select(*[F.col(f"_c{names.index(src)}").alias(out) for out, src in cols.items()])


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with columns ``_c0, _c1, ...`` and its true names."""
    names = df.columns
    return df.toDF(*[f"_c{i}" for i in range(len(names))]), names


class Scratch:
    """Tables of one run in the shared checkpoint folder.

    ``table`` cuts the lineage with a written table, which survives the loss of
    executors; ``drop`` removes the run's tables once its result is written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
        self._n = 0
        self._paths: dict[int, str] = {}

    def path(self, label: str) -> str:
        self._n += 1
        return os.path.join(self.root, f"{self._n:03d}-{label}")

    def table(self, df: DataFrame, label: str = "t") -> DataFrame:
        path = self.path(label)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop_table(self, df: DataFrame) -> None:
        """Remove a table of this run that nothing reads any more; other frames are left alone."""
        if path := self._paths.pop(id(df), None):
            self._delete(path)

    def drop(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()  # noqa: SLF001
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


class SeenBefore:
    """Whether a string was asked for before, told from a bounded table of hash bits.

    Most distinct words of a corpus come once: a cache that takes a word when it comes again
    holds the others only. Strings that share a place may be told as seen too early, and the
    table is emptied when it fills; a cache's results don't depend on either.
    """

    def __init__(self, bits: int = SEEN_BITS):
        self.mask, self.left = (1 << bits) - 1, 1 << (bits - 1)
        self.flags = bytearray(1 << bits)

    def __call__(self, key: str | bytes) -> bool:
        at = hash(key) & self.mask
        if self.flags[at]:
            return True
        if not self.left:
            self.__init__(self.mask.bit_length())
        self.flags[at] = 1
        self.left -= 1
        return False


class WordHashes(dict):
    """Word -> 64-bit hash; a bounded cache of words that came again."""

    def __init__(self):
        self.again = SeenBefore()

    def __missing__(self, word: str | bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_LENGTH and self.again(word):
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = h
        return h


_STATE: dict = {}
_LIBC = ctypes.CDLL(None)


def worker_state(name, build):
    """What a Python worker keeps between tasks: one operator's caches at a time.

    Workers are used again by later stages; were each operator's caches kept, they
    would add up. What the operator before kept is given back to the system, Arrow's
    unused buffers and freed heap too. An operator that keeps nothing calls it with ``dict``.
    """
    if name not in _STATE:
        _STATE.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(_LIBC, "malloc_trim"):  # glibc keeps freed memory for itself otherwise
            _LIBC.malloc_trim(0)
        _STATE[name] = build()
    return _STATE[name]


def once(df: DataFrame) -> DataFrame:
    """The same rows through a generator, below which no filter is pushed: what has been
    computed so far isn't computed again inside filters on it."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_r")).select("_r.*")


def small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its counted rows are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def driver_rows(spark: SparkSession, rows: list[tuple], **columns: pa.DataType) -> DataFrame:
    """A few rows of the driver as a frame, handed over in Arrow's form.

    Plain ``createDataFrame`` has executors unpickle them, which leaves another Python
    daemon and its workers beside those of the Arrow functions.
    """
    values = zip(*rows) if rows else [[] for _ in columns]
    return spark.createDataFrame(pa.table([pa.array(list(v), t) for v, t in zip(values, columns.values())], names=list(columns)))


def positions(df: DataFrame, keys: list[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """The rows with their dense ``position`` (from 0) in the order of ``keys``, and their number.

    The order is dealt to tasks by ranges of the keys and written; only the row count
    of each task reaches the driver. Give keys that no large group shares.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    ordered = scratch.table(ordered, "ordered")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    rows = {r["p"]: r["count"] for r in ordered.groupBy(part.alias("p")).count().collect()}  # a row a task
    before, total = [], 0
    for p in sorted(rows):
        before.append((p, total))
        total += rows[p]
    starts = driver_rows(scratch.spark, before, p=pa.int64(), before=pa.int64())
    placed = ordered.withColumn("p", part).join(F.broadcast(starts), "p")
    return placed.withColumn("position", inside + F.col("before")).drop("p", "before", "place"), total


def slices(batch: pa.RecordBatch, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )
