"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as one symbol per byte. The adjacent pair of lowest merge rank is
popped from a heap again and again and merged in a linked list; the word's count
is its initial symbols minus its merges. No identifiers are produced.

Words repeat, so each Python worker keeps the counts of the chunks it has seen
in a dictionary of bounded size.

Defined results: a null or empty text has 0 bytes and 0 tokens; an id may be
null or repeat (every row gives one row); further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import batch_of, pick, slices, worker_state

#: Entries of the chunk cache of a worker; it starts anew beyond them.
CACHE_CHUNKS = 600_000
#: Longer chunks are counted but not cached (characters).
CACHE_CHARS = 48
#: White space, a space, and white space or the end: there, cutting at spaces could cut inside a word of the pattern.
_EDGE = re.compile(r" (?<=\s )(?:\s|\Z)")


def merges_left(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols that remain after all merges, lowest rank first, leftmost among equals."""
    n = len(symbols)
    if n < 2:
        return n
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    get = ranks.get
    heap = [(r, i) for i in range(n - 1) if (r := get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    merged = 0
    while heap:
        rank, i = heapq.heappop(heap)
        a = symbols[i]
        j = right[i]
        if not a or j >= n or get((a, symbols[j])) != rank:
            continue  # one side has been merged away meanwhile
        symbols[i] = a + symbols[j]
        symbols[j] = ""
        merged += 1
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            if (r := get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i))
        h = left[i]
        if h >= 0 and (r := get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - merged


class ChunkCounter(dict):
    """Chunk of text after a space -> tokens of the space and the chunk; missing chunks are counted and kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(spec["model"]["merges"])}
        # the library's own splitting into words, already one character per byte
        self.words = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def count(self, text: str) -> int:
        """Tokens of a text by itself; a special string in it is one token."""
        if self.special and (found := self.special.findall(text)):
            return len(found) + sum(self.count_plain(part) for part in self.special.split(text))
        return self.count_plain(text)

    def count_plain(self, text: str) -> int:
        return sum(merges_left(list(word), self.ranks) for word, _ in self.words(text)) if text else 0

    def __missing__(self, chunk: str) -> int:
        n = self.count(" " + chunk)
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE_CHUNKS:
                self.clear()
            self[chunk] = n
        return n

    def tokens(self, text: str | None) -> int:
        """Tokens of a whole text.

        Every word of the pattern that holds a space begins with it, so a text may
        be cut before each space that doesn't stand between other white space.
        """
        if not text:
            return 0
        if _EDGE.search(text) or (self.special and self.special.search(text)):
            return self.count(text)
        chunks = text.split(" ")
        return self.count(chunks[0]) + sum(map(self.__getitem__, chunks[1:]))


def counter(path: str) -> ChunkCounter:
    """This worker's counter for a vocabulary file."""
    return worker_state(("token counts", path), lambda: ChunkCounter(path))


def count_tokens(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every row.

    ``vocabulary`` is the path of a byte-level BPE tokenizer file, present on
    every executor. One pass over the texts without a shuffle.
    """
    src = pick(df, key=id_col, text=text_col)
    kind = src.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(vocabulary)
        for batch in batches:
            for part in slices(batch):
                text = part.column("text")
                size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
                counts = [of.tokens(t) for t in text.to_pylist()]
                schema = pa.schema([("id", part.column("key").type), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
                yield batch_of(schema, [part.column("key"), size, counts, [n > limit for n in counts]])

    return src.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("id", id_col)
