"""Benchmark decontamination by SimHash windows.

An item is hashed by windows of one size: the largest step of ``LADDER`` that leaves out a
quarter of its shingles, so that edits at its ends, or a document's edge, lie outside one of
its three windows (at its start, middle and end). All windows of that size within a document
get a 64-bit SimHash of their words, for each size in use. Hashes are cut into ``BLOCKS``
blocks. Two hashes within ``RADIUS`` differ by ``BLOCK_RADIUS`` bits at most in one of them, so
an index a block, which lists every value that near an item's, misses no pair of fingerprints
within the radius; the candidates' distance is counted then.

A candidate places the whole item in the document. Verification begins with a bound: there must
be as many of the items' shingles around as the item's heaviest need for the likeness, counted by
running sums over hashed shingles. Every start around it, from which the
item's number of words is clipped to the document's bounds, is verified: distinct shingles of
five words, weighted by their characters, with a weighted Jaccard similarity of 0.8 or more.
Sums are kept from start to start. Verified starts less than half an item apart are one place,
told by the likest. The radius holds what the likeness leaves unchanged of a window with a
wide margin, but a likeness is no bound of a Hamming distance: the tests hold the result
against brute force.

Window hashes come from running sums of eight packed counters a 64-bit number, over
many documents at once; windows across documents are discarded.

The items' index is broadcast below ``MAX_ITEM_BYTES`` of text, which are about ten times
as many bytes of arrays; more items are taken in several passes. Shingles of items are made
when a candidate needs them and kept for ``CACHE_ITEMS`` of them. Documents aren't shuffled.

Words are runs of letters and digits, lower-cased; in scripts that are written without
spaces (Han, kana, Thai, Lao, Burmese, Khmer) every letter is a word. Defined results:
items and documents that are null or have fewer than five words match nothing; ids may be
null or repeat; items with equal texts are all reported; further columns are ignored (or
kept, by ``clean``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, batch_of, pick, positional, slices, worker_state

SHINGLE, LIKENESS = 5, 0.8
#: Blocks of a fingerprint, bits that may differ within one, and the distance up to which no pair is missed.
BLOCKS, BLOCK_RADIUS = 4, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Window sizes: steps of a fifth, up to what the packed counters hold.
LADDER = [5, 6, 7, 8, 10, 12, 14, 17, 20, 24, 29, 35, 42, 50, 60, 72, 86, 103, 124, 149, 179, 215]
#: Words that are windowed at once; item text of one pass; items whose shingles are kept.
CHUNK_WORDS, MAX_ITEM_BYTES, CACHE_ITEMS = 200_000, 4 << 20, 2_000

#: Scripts without spaces between words.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(r"[^\W_]+")
_WORD_OR_LETTER = re.compile(rf"(?=[^\W_])[{_UNSPACED}]|[^\W_{_UNSPACED}]+")
_LANES = np.uint64(0x0101010101010101)
_TOP_BITS = np.uint64(0x8080808080808080)


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    unspaced = not text.isascii() and _HAS_UNSPACED.search(text)
    return (_WORD_OR_LETTER if unspaced else _WORD).findall(text.lower())


def hashes_of(words: list[str]) -> np.ndarray:
    return np.fromiter(map(worker_state("decontamination words", WordHashes).__getitem__, words), np.uint64, len(words))


def running_sums(h: np.ndarray) -> list[np.ndarray]:
    """For each residue k: sums over the words before of bits k, k+8, ..., a byte a bit (modulo 2^64)."""
    out = []
    for k in range(8):
        sums = np.empty(len(h) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((h >> np.uint64(k)) & _LANES, out=sums[1:])
        out.append(sums)
    return out


def window_hashes(sums: list[np.ndarray], size: int) -> np.ndarray:
    """SimHash of every window of ``size`` words: a bit is set if most words have it."""
    lift = _LANES * np.uint64(128 - (size // 2 + 1))
    out = np.zeros(max(0, len(sums[0]) - size), np.uint64)
    counts = np.empty_like(out)
    for k, s in enumerate(sums):
        np.subtract(s[size:], s[:-size], out=counts)
        counts += lift
        counts &= _TOP_BITS
        if k < 7:
            counts >>= np.uint64(7 - k)
        out |= counts
    return out


def shingles_of(words: list[str]) -> Iterator[tuple]:
    return zip(*(words[k:] for k in range(SHINGLE)))


def weights(words: list[str]) -> dict[tuple, int]:
    return {s: sum(map(len, s)) for s in set(shingles_of(words))}


def likeness(a: dict[tuple, int], b: dict[tuple, int]) -> float:
    both = sum(w for s, w in a.items() if s in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


def shingle_hashes(h: np.ndarray) -> np.ndarray:
    """A hash of every ``SHINGLE`` words that follow each other; equal shingles have equal ones."""
    out = h[: max(0, len(h) - SHINGLE + 1)].copy()
    for k in range(1, SHINGLE):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[k : k + len(out)]
    return out


def window_size(words: int) -> int:
    """Size of the windows of an item: all but a quarter of its shingles, down to a step of the ladder."""
    return max(s for s in LADDER if s <= words - (words - SHINGLE + 1) // 4)


def near_masks() -> np.ndarray:
    """What differs between two block values that are within ``BLOCK_RADIUS``."""
    return np.flatnonzero(np.bitwise_count(np.arange(1 << 16, dtype=np.uint16)) <= BLOCK_RADIUS).astype(np.uint16)


class Windows:
    """The items' windows of one size: fingerprints, and for every block the entries near each value."""

    def __init__(self, prints: np.ndarray, item: np.ndarray, offset: np.ndarray):
        self.prints, self.item, self.offset = prints, item, offset
        self.blocks = []
        masks = near_masks()
        for b in range(BLOCKS):
            value = (prints.view(np.uint16).reshape(-1, BLOCKS)[:, b, None] ^ masks).ravel()
            order = np.argsort(value, kind="stable")
            count = np.bincount(value, minlength=1 << 16).astype(np.int32)
            starts = (np.cumsum(count) - count).astype(np.int32)
            self.blocks.append(((order // len(masks)).astype(np.int32), starts, count, count > 0))

    def near(self, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(place in own, entry)`` of all pairs within the radius, block by block (a pair may come again)."""
        values = own.view(np.uint16).reshape(-1, BLOCKS)
        for b, (entries, starts, count, listed) in enumerate(self.blocks):
            hit = np.flatnonzero(listed.take(values[:, b]))
            if len(hit):
                value = values[hit, b]
                n = count[value]
                place = np.repeat(hit, n)
                entry = entries[np.repeat(starts[value] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                close = np.bitwise_count(own[place] ^ self.prints[entry]) <= RADIUS
                yield place[close], entry[close]


class Items:
    """The items' windows by size, and their texts."""

    def __init__(self, items: list[tuple]):
        self.ids, self.texts, self.lengths, need = [], [], [], []
        hashed = [np.empty(0, np.uint64)]
        own: dict[int, list[tuple[int, int, int]]] = {}
        for key, text in items:
            words = words_of(text)
            if len(words) < SHINGLE:
                continue
            n, size = len(words), window_size(len(words))
            h = hashes_of(words)
            hashed.append(shingle_hashes(h))
            prints = window_hashes(running_sums(h), size)
            heaviest = np.cumsum(sorted(weights(words).values(), reverse=True))
            need.append(1 + int(np.searchsorted(heaviest, LIKENESS * heaviest[-1] - 1e-6)))
            own.setdefault(size, []).extend((int(prints[at]), len(self.ids), at) for at in sorted({0, (n - size) // 2, n - size}))
            self.ids.append(key)
            self.texts.append(text)
            self.lengths.append(n)
        self.sizes = {}
        for size, entries in sorted(own.items()):
            prints, item, offset = zip(*entries)
            self.sizes[size] = Windows(np.array(prints, np.uint64), np.array(item, np.int64), np.array(offset, np.int64))
        self.kept: dict[int, tuple[dict, int]] = {}
        # fewest shingles that an item shares with a place alike enough, and the hashes of all shingles as a table of bits
        self.need, self.size = np.array(need, np.int64), np.array(self.lengths, np.int64)
        self.around = np.array([max(2, n - window_size(n)) for n in self.lengths], np.int64)
        hashed = np.concatenate(hashed)
        self.shift = np.uint64(64 - max(16, (16 * len(hashed)).bit_length()))
        self.known = np.zeros(1 << (64 - int(self.shift)), bool)
        self.known[hashed >> self.shift] = True

    def shingles(self, i: int) -> tuple[dict[tuple, int], int]:
        """An item's weighted shingles and their sum."""
        if i not in self.kept:
            if len(self.kept) >= CACHE_ITEMS:
                self.kept.clear()
            own = weights(words_of(self.texts[i]))
            self.kept[i] = (own, sum(own.values()))
        return self.kept[i]

    def candidates(self, h: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], set[int]]:
        """``(document, item)`` -> words at which the whole item would start, by windows within the radius.

        The windows lie in a document that ends before ``ends``; the whole item may stick out of it.
        Those with too few known shingles around are left out.
        """
        found: dict[tuple[int, int], set[int]] = {}
        most = max(self.sizes, default=0)
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        before = np.zeros(len(h) + 1, np.int64)  # known shingles that start before a word
        known = self.known[shingle_hashes(h) >> self.shift]
        np.cumsum(known, out=before[1 : len(known) + 1])
        before[len(known) + 1 :] = before[len(known)]
        for at in range(0, len(h) if most else 0, CHUNK_WORDS):
            sums = running_sums(h[at : at + CHUNK_WORDS + most - 1])
            for size, windows in self.sizes.items():
                for place, entry in windows.near(window_hashes(sums, size)[:CHUNK_WORDS]):
                    first = at + place
                    doc = np.searchsorted(ends, first, side="right")
                    item, start = windows.item[entry], first - windows.offset[entry]
                    lo = np.maximum(start - self.around[item], begins[doc])
                    hi = np.minimum(start + self.size[item] + self.around[item], ends[doc]) - SHINGLE + 1
                    real = (first + size <= ends[doc]) & (before[hi] - before[lo] >= self.need[item])
                    for d, i, s in zip(doc[real].tolist(), item[real].tolist(), start[real].tolist()):
                        found.setdefault((d, i), set()).add(s)
        return found

    def places(self, words: list[str], i: int, starts: list[int]) -> Iterator[tuple[int, float]]:
        """``(first word, likeness)`` of the item's places in a document's words, around the ascending ``starts``."""
        size, n = self.lengths[i], len(words)
        around = int(self.around[i])
        ranges: list[list[int]] = []
        for start in starts:
            lo, hi = max(start - around, SHINGLE - size), min(start + around, n - SHINGLE)
            if ranges and lo <= ranges[-1][1] + 1:
                ranges[-1][1] = hi
            elif lo <= hi:
                ranges.append([lo, hi])
        best, last = None, 0
        for lo, hi in ranges:
            for at, like in self.verified(words, i, lo, hi):
                if best and 2 * (at - last) >= size:
                    yield best
                    best = None
                if best is None or like > best[1]:
                    best = (max(at, 0), like)
                last = at
        if best:
            yield best

    def verified(self, words: list[str], i: int, lo: int, hi: int) -> Iterator[tuple[int, float]]:
        """``(start, likeness)`` of those among the starts ``lo`` to ``hi`` that are alike enough."""
        (own, total), size = self.shingles(i), self.lengths[i]
        base, last = max(lo, 0), min(hi + size, len(words)) - SHINGLE
        at_hand = list(shingles_of(words[base : last + SHINGLE]))
        if sum(own[s] for s in own.keys() & set(at_hand)) < LIKENESS * total - 1e-6:
            return
        counts: dict[tuple, int] = {}
        weight = both = 0  # of the distinct shingles in the window
        begin = end = base
        for at in range(lo, hi + 1):
            to = min(at + size, len(words)) - SHINGLE + 1
            while end < to:
                s = at_hand[end - base]
                counts[s] = counts.get(s, 0) + 1
                if counts[s] == 1:
                    w = sum(map(len, s))
                    weight += w
                    both += w if s in own else 0
                end += 1
            while begin < at:
                s = at_hand[begin - base]
                counts[s] -= 1
                if not counts[s]:
                    w = sum(map(len, s))
                    weight -= w
                    both -= w if s in own else 0
                begin += 1
            like = both / (total + weight - both)
            if like >= LIKENESS:
                yield at, like

    def leaks(self, texts: list[str | None]) -> list[tuple[int, int, int, float]]:
        """``(text, item, first word, likeness)`` of every verified place, clipped to the text."""
        lists = [words_of(t) for t in texts]
        ends = np.cumsum([len(w) for w in lists])
        found = self.candidates(hashes_of([w for words in lists for w in words]), ends)
        out = []
        for (doc, i), starts in found.items():
            begin = int(ends[doc]) - len(lists[doc])
            out += [(doc, i, first, like) for first, like in self.places(lists[doc], i, sorted(s - begin for s in starts))]
        return out


def passes(benchmark: DataFrame, *, item_col: str = "item_id", text_col: str = "text", max_bytes: int = MAX_ITEM_BYTES) -> Iterator:
    """A broadcast index for every pass: one, unless the items' text is above ``max_bytes``."""
    items = pick(benchmark, id=item_col, text=text_col).where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // max_bytes))
    for k in range(n):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect() if n > 1 else items.collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Items([tuple(r) for r in own]))


def find(df: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", max_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """``id, item, places, first_word, likeness``: a row for each document and item it holds."""
    src = pick(df, key=id_col, text=text_col)
    kind, item_kind = src.schema["key"].dataType.simpleString(), benchmark.schema[item_col].dataType
    out = None
    for shared in passes(benchmark, item_col=item_col, max_bytes=max_bytes):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type

            items = shared.value
            for batch in batches:
                for part in slices(batch):
                    places: dict[tuple[int, int], list] = {}
                    for doc, i, first, like in items.leaks(part.column("text").to_pylist()):
                        at = places.setdefault((doc, i), [0, first, like])
                        places[doc, i] = [at[0] + 1, min(at[1], first), max(at[2], like)]
                    keys = sorted(places)
                    key = part.column("key").take(pa.array([d for d, _ in keys], pa.int64()))
                    schema = pa.schema([("id", key.type), ("item", to_arrow_type(item_kind)), ("places", pa.int64()), ("first_word", pa.int64()), ("likeness", pa.float64())])
                    yield batch_of(schema, [key, [items.ids[i] for _, i in keys], *([places[k][c] for k in keys] for c in range(3))])

        own = src.mapInArrow(run, f"id {kind}, item {item_kind.simpleString()}, places bigint, first_word bigint, likeness double")
        out = own if out is None else out.unionByName(own)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def clean(df: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", max_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """The rows of ``df``, all columns, that hold no item."""
    flat, names = positional(df)
    text = names.index(text_col)
    for shared in passes(benchmark, item_col=item_col, max_bytes=max_bytes):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                for part in slices(batch):
                    keep = np.ones(part.num_rows, bool)
                    keep[[doc for doc, *_ in items.leaks(part.column(text).to_pylist())]] = False
                    yield part.filter(pa.array(keep))

        flat = flat.mapInArrow(run, flat.schema)
    return flat.toDF(*names)
