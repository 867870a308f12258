"""What Python workers keep: caches of what came again, and one daemon for all operators."""

from __future__ import annotations

import pyarrow as pa
import pytest

import public_tokenizers
from roadpulse.llm import best_fit, common

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return b"".join(i.to_bytes(4, "little") for i in library.encode(text, add_special_tokens=False).ids)


def test_packing_caches_take_what_came_again(library):
    of = best_fit.ChunkIds(VOCABULARY)
    text = " ".join(f"Ab{chr(97 + i % 26)}{chr(97 + i // 26)}xu{m}" for i in range(300) for m in ("", ",")) + " été, 3x5 中文 á"
    want = ids_of(library, text)
    assert of.ids(text) == want
    assert len(of) < 10 and len(of.words) <= 301  # a word comes again with its mark, a chunk doesn't
    assert of.ids(text) == want and len(of) > 600
    assert of.ids(text) == want


def test_packing_is_the_same_with_full_caches(library, monkeypatch):
    monkeypatch.setattr(best_fit, "CACHE_CHUNKS", 3)
    monkeypatch.setattr(best_fit, "CACHE_WORDS", 2)
    of = best_fit.ChunkIds(VOCABULARY)
    text = " ".join(["one", "Two,", "three.", "four", "one,", "Two"] * 5)
    for _ in range(3):
        assert of.ids(text) == ids_of(library, text)
        assert len(of) <= 3 and len(of.words) <= 2


def test_word_hashes_take_what_came_again():
    hashes = common.WordHashes()
    first = [hashes[w] for w in ("a", b"b", "c")]
    assert not len(hashes)
    assert [hashes[w] for w in ("a", b"b", "c")] == first and len(hashes) == 3
    assert [hashes[w] for w in ("a", b"b", "c")] == first


def test_seen_before_empties_itself():
    seen = common.SeenBefore(bits=4)
    told = [seen(f"word {i}") for i in range(200)]
    assert not all(told) and sum(seen.flags) <= 8
    assert len(seen.flags) == 16 and seen.mask == 15
    again = common.SeenBefore()
    assert not again("x") and again("x")


def test_rows_of_the_driver_need_no_python_worker(spark):
    frame = common.driver_rows(spark, [(1, "x"), (2, None)], a=pa.int64(), b=pa.string())
    assert [tuple(r) for r in frame.orderBy("a").collect()] == [(1, "x"), (2, None)]
    empty = common.driver_rows(spark, [], a=pa.int64(), b=pa.string())
    assert empty.schema == frame.schema and empty.count() == 0


def test_operators_leave_no_second_python_daemon(spark):
    plans = lambda df: df._jdf.queryExecution().toString()  # noqa: E731, SLF001
    scratch = common.Scratch(spark, "worker-memory")
    placed, total = common.positions(spark.range(50).withColumnRenamed("id", "k"), ["k"], scratch)
    assert total == 50 and sorted(r["position"] for r in placed.collect()) == list(range(50))
    docs = spark.range(6).selectExpr("id AS doc_id", "repeat('word ', int(id) * 3) AS text")
    packed = best_fit.pack_documents(docs, VOCABULARY, scratch)
    assert packed.count() == 6
    for df in (placed, packed):
        # rows that executors would have to unpickle are a scan of an RDD
        assert "ExistingRDD" not in plans(df) and "LogicalRDD" not in plans(df)
    scratch.drop()
