"""Byte-level BPE encoding and decoding.

Encoding: a word of the vocabulary's pattern starts as one identifier per byte in a
doubly linked list. A priority queue holds the merge rank and place of every adjacent
pair that merges; the lowest rank, leftmost among equals, is popped first, and entries
whose pair has changed meanwhile are skipped. Decoding concatenates the vocabulary's
byte strings.

Identifiers travel packed: little-endian unsigned 32-bit integers in a binary column
(``unpack`` gives an array). Words repeat, so each Python worker keeps what it has
encoded in two generations of bounded size: when the younger is full it becomes the
older, and words that are seen again move on.

Defined results: a null or empty text has no identifiers, and no identifiers decode to
the empty text; an id may be null or repeat (every row gives one row); identifiers that
the vocabulary lacks decode to nothing; bytes that aren't UTF-8 decode to U+FFFD; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, pick, slices, worker_state

#: Entries of one generation of a worker's caches (words, chunks of text between spaces), and the longest that is kept (characters).
CACHE_WORDS, CACHE_CHUNKS, CACHE_CHARS = 300_000, 300_000, 48
#: White space, a space, and white space or the end: there, cutting at spaces could cut inside a word of the pattern.
_EDGE = re.compile(r" (?<=\s )(?:\s|\Z)")
#: Text whose letters, digits and white space the next pattern tells as the library does.
_PLAIN = re.compile("[\0-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
#: FIXED VALUE: the vocabulary's splitting pattern, written out for such text.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+| ?[0-9]+| ?[^\sA-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff]+|\s+(?!\S)|\s+", re.ASCII)
_PLACE = 32
_AT = (1 << _PLACE) - 1


def merge(ids: list[int], ranks: dict[tuple[int, int], int], product: list[int]) -> list[int]:
    """The identifiers of a word after all merges; ``product[rank]`` is what a merge makes."""
    n = len(ids)
    if n < 2:
        return ids
    get = ranks.get
    queue = [r << _PLACE | i for i, pair in enumerate(zip(ids, ids[1:])) if (r := get(pair)) is not None]
    if not queue:
        return ids
    heapq.heapify(queue)
    ids = ids[:]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while queue:
        entry = heapq.heappop(queue)
        i, rank = entry & _AT, entry >> _PLACE
        j = after[i]
        if j >= n or get((ids[i], ids[j])) != rank:
            continue  # stale: one of the two has been merged meanwhile
        ids[i] = new = product[rank]
        ids[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := get((new, ids[k]))) is not None:
                heapq.heappush(queue, r << _PLACE | i)
        h = before[i]
        if h >= 0 and (r := get((ids[h], new))) is not None:
            heapq.heappush(queue, r << _PLACE | h)
    return [x for x in ids if x >= 0]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 itself, the others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(others)}


class Kept(dict):
    """What has been made of a string lately; ``make`` is asked for the rest."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= CACHE_CHARS:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


class Codec:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.product = [vocab[a + b] for a, b in pairs]
        self.start = [vocab[c] for c, _ in sorted(letters.items(), key=lambda item: item[1])]
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in what stands around them aren't supported")
        self.special = {s: self.pack([i]) for s, i in special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        named = vocab | special
        self.strings = [b""] * (max(named.values(), default=-1) + 1)
        for token, i in named.items():
            try:
                self.strings[i] = bytes(map(letters.__getitem__, token))
            except KeyError:  # not in the byte alphabet: itself
                self.strings[i] = token.encode()
        self.words = Kept(self._word, CACHE_WORDS)
        self.chunks = Kept(lambda chunk: self._plain(" " + chunk), CACHE_CHUNKS)

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    @staticmethod
    def unpack(packed: bytes) -> list[int]:
        ids = array("I")
        ids.frombytes(packed)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tolist()

    def _word(self, word: str) -> bytes:
        return self.pack(merge([self.start[b] for b in word.encode()], self.ranks, self.product))

    def split_words(self, text: str) -> list[str]:
        """The words of the pattern, by the library's own splitter where the text isn't plain."""
        if _PLAIN.fullmatch(text):
            return _WORDS.findall(text)
        return [text[a:b] for _, (a, b) in self.split(text)]

    def _plain(self, text: str) -> bytes:
        """Identifiers of a text without special strings."""
        return b"".join(map(self.words.__getitem__, self.split_words(text))) if text else b""

    def _whole(self, text: str) -> bytes:
        if self.cut is None:
            return self._plain(text)
        return b"".join([self.special[p] if n % 2 else self._plain(p) for n, p in enumerate(self.cut.split(text))])

    def encode(self, text: str | None) -> bytes:
        """Packed identifiers of a whole text.

        Every word of the pattern that holds a space begins with it, so a text may be
        cut before each space that doesn't stand between other white space.
        """
        if not text:
            return b""
        if _EDGE.search(text) or (self.cut and self.cut.search(text)):
            return self._whole(text)
        first, *rest = text.split(" ")
        return self._plain(first) + b"".join(map(self.chunks.__getitem__, rest))

    def decode(self, packed: bytes | None) -> str:
        """The text of packed identifiers."""
        if not packed:
            return ""
        ids, strings = self.unpack(packed), self.strings
        try:
            found = b"".join(map(strings.__getitem__, ids))
        except IndexError:
            found = b"".join([strings[i] for i in ids if i < len(strings)])
        return found.decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """This worker's codec for a vocabulary file."""
    return worker_state(("bpe codec", path), lambda: Codec(path))


def _mapped(df: DataFrame, vocabulary: str, column: str, name: str, kind: str, method: str, id_col: str) -> DataFrame:
    src = pick(df, key=id_col, value=column)
    id_kind = src.schema["key"].dataType.simpleString()
    arrow = {"binary": pa.binary(), "string": pa.string()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = getattr(codec(vocabulary), method)
        for batch in batches:
            for part in slices(batch):
                schema = pa.schema([("id", part.column("key").type), (name, arrow)])
                yield batch_of(schema, [part.column("key"), [of(v) for v in part.column("value").to_pylist()]])

    return src.mapInArrow(run, f"id {id_kind}, {name} {kind}").withColumnRenamed("id", id_col)


def encode(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids`` of every row, ``ids`` packed (4 bytes an identifier).

    ``vocabulary`` is the path of a byte-level BPE tokenizer file, present on every
    executor. One pass over the texts without a shuffle.
    """
    return _mapped(df, vocabulary, text_col, "ids", "binary", "encode", id_col)


def decode(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` of every row of packed identifiers, without a shuffle."""
    return _mapped(df, vocabulary, ids_col, "text", "string", "decode", id_col)


def unpack(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """The frame with packed identifiers as ``array<bigint>``."""
    n = (F.octet_length(ids_col) / 4).cast("int")
    byte = lambda at: F.conv(F.hex(F.substring(F.col(ids_col), at, 1)), 16, 10).cast("bigint")
    number = lambda i: sum((F.shiftleft(byte(i * 4 + k + 1), 8 * k) for k in range(1, 4)), byte(i * 4 + 1))
    ids = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), number))
    return df.withColumn(ids_col, F.coalesce(ids, F.array().cast("array<bigint>")))


def round_trip(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: every text encoded, and its identifiers decoded again."""
    src = pick(df, key=id_col, text=text_col)
    packed = encode(src, vocabulary, id_col="key")
    # the identifiers ride along under the row's key, so that decoding needs no join
    carried = packed.select(F.struct("key", (F.octet_length("ids") / 4).cast("bigint").alias("n"), F.sha2("ids", 256).alias("sha")).alias("key"), "ids")
    texts = decode(carried, vocabulary, id_col="key")
    return texts.select(
        F.col("key.key").alias(id_col), F.col("key.n").alias("n_tokens"), F.col("key.sha").alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    )
