"""Best-fit packing planned on a histogram of lengths.

1. Documents become pieces of at most ``capacity`` tokens (one pass, written).
2. The pieces are counted by length: at most ``capacity`` counts.
3. Best fit, longest first, is run over the counts: a sequence takes as many
   pieces of a length as fit before the next sequence is tried, so whole runs
   of equal sequences are planned at once.
4. A piece takes the slot planned for its rank among the pieces of its length.

Ranks are dealt within salted parts of a length, so no length, however common,
is sorted in one task.

Defined results: a null or empty text is one piece with the end id alone; ids may
be null or repeat (each row is packed on its own); an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE, Scratch, SeenBefore, batch_of, driver_rows, pick, slices, worker_state

#: Entries of a worker's caches of chunks and of words, and the longest that is kept.
CACHE_CHUNKS, CACHE_WORDS, CACHE_CHARS = 500_000, 300_000, 48
#: Pieces of a length that are ranked together.
RANK_ROWS = 1_000
_RANK_BITS = 48
_MARKS = ".,;:!?"


class WordIds(dict):
    """Lower-case word -> its ids as little-endian unsigned 32-bit numbers; a bounded cache."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.merge = self.library.model.tokenize
        self.to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.again = SeenBefore()

    def encode(self, chunk: str) -> bytes:
        """Ids of any chunk."""
        return np.asarray(self.library.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        """Ids of a word of lower-case letters below U+0250: normalising and splitting would leave it as it is."""
        ids = np.asarray([t.id for t in self.merge(word if word.isascii() else self.to_bytes(word)[0][0])], dtype="<u4").tobytes()
        if len(word) <= CACHE_CHARS and self.again(word):
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids


class ChunkIds(dict):
    """Chunk without spaces -> its ids; a bounded cache.

    The vocabulary's words never hold white space, so a text's ids are those of
    its chunks between spaces and line ends. Most chunks are a word and a mark or
    none: there the ids are those of the lower-case word and of the mark. That is
    done for letters below U+0250 alone, which lower-case one by one and which
    every version of Unicode knows; other chunks are encoded as they stand.
    """

    def __init__(self, path: str):
        self.words = WordIds(path)
        self.marks = {m: self.words.encode(m) for m in _MARKS}
        self.again = SeenBefore()

    def __missing__(self, chunk: str) -> bytes:
        word, mark = (chunk[:-1], chunk[-1]) if chunk and chunk[-1] in _MARKS else (chunk, "")
        if word.isalpha() and max(word) < "\u0250" and (low := word.lower()).isalpha():
            ids = self.words[low] + (self.marks[mark] if mark else b"")
        else:
            ids = self.words.encode(chunk) if chunk else b""
        if len(chunk) <= CACHE_CHARS and self.again(chunk):
            if len(self) >= CACHE_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))) if text else b""


def chunk_ids(path: str) -> ChunkIds:
    """This worker's caches for a vocabulary file."""
    return worker_state(("chunk ids", path), lambda: ChunkIds(path))


def cut_pieces(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` of every piece of every row."""
    src = pick(df, key=id_col, text=text_col)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = chunk_ids(vocabulary)
        for batch in batches:
            for part in slices(batch, SLICE):
                at, piece, start, length, crc = [], [], [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = of.ids(text) + end
                    for k, first in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[first : first + 4 * capacity]
                        at.append(i)
                        piece.append(k)
                        start.append(first // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                key = part.column("key").take(pa.array(at, pa.int64()))
                schema = pa.schema([("id", key.type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
                yield batch_of(schema, [key, piece, start, length, crc])

    kind = src.schema["key"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots for ``counts[length]`` pieces: ``(length, first rank, first sequence, pieces a sequence, first offset)``.

    Rank ``r`` of a length belongs to the last entry with ``first rank <= r``; there
    it goes to sequence ``first + (r - rank) // k`` at ``offset + (r - rank) % k * length``.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of open sequences (first, how many)
    free: list[int] = []  # the keys of room, ascending
    opened = 0

    def give(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                bisect.insort(free, left)
            room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        todo, rank = counts[length], 0
        while todo:
            k = bisect.bisect_left(free, length)
            if k < len(free):  # the fullest sequences that still take it
                left = free[k]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], free[k]
            else:
                left, first, n = capacity, opened, -(-todo // (capacity // length))
                opened += n
            each = left // length
            full = min(n, todo // each)
            if full:
                slots.append((length, rank, first, each, capacity - left))
                give(left - each * length, first, full)
                rank, todo = rank + full * each, todo - full * each
            if full < n:
                if todo:  # fewer than a sequence takes
                    slots.append((length, rank, first + full, todo, capacity - left))
                    give(left - todo * length, first + full, 1)
                    rank, todo, full = rank + todo, 0, full + 1
                give(left, first + full, n - full)
    return slots


def pack(pieces: DataFrame, scratch: Scratch, *, capacity: int = 4096, max_plan_bytes: int = 256 << 20) -> DataFrame:
    """``pieces`` (from ``cut_pieces``) with ``sequence_id`` and ``offset``."""
    spark = scratch.spark
    # a row's number is stored, so it can't change when a task runs again
    pieces = scratch.table(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    slots = np.asarray(plan(counts, capacity), dtype=np.int64).reshape(-1, 5)
    if slots.nbytes > max_plan_bytes:
        raise ValueError(f"the plan takes {slots.nbytes} bytes; raise max_plan_bytes above that or lower the capacity")
    shared = spark.sparkContext.broadcast(slots)

    parts = driver_rows(spark, [(n, -(-c // RANK_ROWS)) for n, c in counts.items()], length=pa.int64(), parts=pa.int64())
    dealt = pieces.join(F.broadcast(parts), "length").withColumn("part", F.pmod(F.xxhash64("row"), "parts")).drop("parts")
    sizes = dealt.groupBy("length", "part").count()
    before = sizes.select("length", "part", (F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")).alias("before"))
    ranked = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("length", "part").orderBy("row"))).join(before, ["length", "part"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("nth") - 1 + F.col("before")).alias("rank"))
    kind = ranked.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, first, each, offset = shared.value.T
        keys = (length << _RANK_BITS) + rank
        order = np.argsort(keys)
        keys = keys[order]
        for b in batches:
            own, r = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = order[np.searchsorted(keys, (own << _RANK_BITS) + r, side="right") - 1]
            past = r - rank[at]
            kept = [b.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")]
            schema = pa.schema([("id", kept[0].type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
            yield batch_of(schema, [*kept, first[at] + past // each[at], offset[at] + past % each[at] * own])

    return ranked.mapInArrow(place, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack_documents(df: DataFrame, vocabulary: str, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of all rows of ``df`` with their places, in as few sequences as best fit finds."""
    pieces = cut_pieces(df, vocabulary, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id)
    return pack(pieces, scratch, capacity=capacity).withColumnRenamed("id", id_col)
