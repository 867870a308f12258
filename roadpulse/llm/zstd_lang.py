"""Language identification by compression.

Every language has a raw-content zstandard dictionary made of a bounded sample of
its labelled texts. A text is encoded with each dictionary; the language whose
dictionary gives the fewest bytes is predicted, and the score is the margin to the
runner-up as a share of the runner-up's bytes. A narrow margin means rejection
(``rejected``).

The whole text is encoded, window by window, so that a long text can't become its
own dictionary. Texts shorter than ``SHORT`` bytes are repeated up to it: zstandard
stores such texts plainly otherwise, and no margin would show.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and
so is every text when nothing could be learned; equal sizes go to the language with
more labelled rows, then to the first by name, with score 0; with a single learned
language the score is 1. Ids may be null or repeat; a null id is neither held out
nor learned from. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, driver_rows, pick, positional, slices, worker_state

#: Bounds of the sample that a language is learned from: rows, bytes of a row, bytes in all.
SAMPLE_ROWS, ROW_CHARS, DICT_BYTES = 256, 1024, 110_000
LEVEL, WINDOW, SHORT = 6, 2048, 256
#: Smaller margins are rejected.
MIN_SCORE = 0.01

_REST = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """Lower-case words only; what isn't part of a word says little about a language."""
    return _REST.sub(" ", text.lower()).encode("utf-8", "replace")


def learn(df: DataFrame, labelled: Column, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> list[tuple[str, bytes]]:
    """``(language, dictionary)``, languages with more labelled rows first.

    ``labelled`` is a condition over ``key``, ``text`` and ``lang``. Rows are drawn
    by a hash of their text, in two passes: counts by language, then the rows under
    a threshold that leaves a few times ``SAMPLE_ROWS`` of them, equal texts once.
    """
    rows = pick(df, key=id_col, text=text_col, lang=lang_col).where(labelled & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = rows.groupBy("lang").count().collect()  # one row a language
    if not counts:
        return []
    share = driver_rows(df.sparkSession, [(r["lang"], min(1.0, 8.0 * SAMPLE_ROWS / r["count"])) for r in counts], lang=pa.string(), share=pa.float64())
    drawn = (
        rows.withColumn("h", F.xxhash64("text"))
        .join(F.broadcast(share), "lang")
        .where(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
        .groupBy("lang", "h")
        .agg(F.first(F.substring("text", 1, 2 * ROW_CHARS)).alias("text"))
        .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
        .where(F.col("nth") <= SAMPLE_ROWS)
        .orderBy("lang", "h")
    )
    texts: dict[str, list[bytes]] = {}
    for r in drawn.collect():  # at most SAMPLE_ROWS a language
        texts.setdefault(r["lang"], []).append(letters(r["text"])[:ROW_CHARS])
    by_count = sorted(counts, key=lambda r: (-r["count"], r["lang"]))
    return [(r["lang"], b" ".join(texts[r["lang"]])[:DICT_BYTES]) for r in by_count if r["lang"] in texts]


class Classifier:
    def __init__(self, model: list[tuple[str, bytes]]):
        import zstandard

        self.langs = [lang for lang, _ in model]
        self.encoders = []
        for _, content in model:
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=LEVEL)
            self.encoders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False).compress)

    def predict(self, text: str | None) -> tuple[str, float]:
        data = letters(text) if text else b""
        if not self.langs or not any(c.isalpha() for c in data.decode("utf-8")):
            return "und", 0.0
        if len(data) < SHORT:
            data = (data.strip() + b" ") * (SHORT // len(data) + 1)
        windows = [data[at : at + WINDOW] for at in range(0, len(data), WINDOW)]
        sizes = [sum(len(encode(w)) for w in windows) for encode in self.encoders]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.langs[0], 1.0
        second = min(s for i, s in enumerate(sizes) if i != best)
        return self.langs[best], (second - sizes[best]) / second


def predict(df: DataFrame, model: list[tuple[str, bytes]], *, text_col: str = "text", keep: dict[str, str]) -> DataFrame:
    """The columns of ``keep`` (new name -> column), ``lang_pred`` and ``score`` of every row.

    One pass over the texts without a shuffle; the dictionaries go to the executors
    as a broadcast variable (at most ``DICT_BYTES`` a language).
    """
    src = pick(df, text=text_col, **keep)
    names = list(keep)
    schema = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in names) + ", lang_pred string, score double"
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("language id", dict)  # nothing is kept; the caches of a stage before go
        of = Classifier(shared.value)
        for batch in batches:
            for part in slices(batch):
                found = [of.predict(t) for t in part.column("text").to_pylist()]
                kept = [part.column(c) for c in names]
                out = pa.schema([*[(c, k.type) for c, k in zip(names, kept)], ("lang_pred", pa.string()), ("score", pa.float64())])
                yield batch_of(out, [*kept, [f[0] for f in found], [f[1] for f in found]])

    return src.mapInArrow(run, schema)


def rejected(lang: Column, score: Column, min_score: float = MIN_SCORE) -> Column:
    """No language at all, or a margin too narrow to tell."""
    return (lang == "und") | (score < min_score)


def keep_identified(df: DataFrame, model: list[tuple[str, bytes]], *, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``df``, all columns, whose language isn't rejected."""
    flat, names = positional(df)
    found = predict(flat, model, text_col=f"_c{names.index(text_col)}", keep={c: c for c in flat.columns})
    return found.where(~rejected(F.col("lang_pred"), F.col("score"), min_score)).select(*flat.columns).toDF(*names)


def held_out(key: Column) -> Column:
    """A fifth of the documents, by the crc32 of the id's text."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def learned_from(key: Column) -> Column:
    """The other documents that have an id."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 != 0, F.lit(False))
