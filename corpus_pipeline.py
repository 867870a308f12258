"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)``. Its result is written as Parquet and read
again as the next stage's ``docs``; all but the last return the columns of ``documents``.
A stage that writes tables of its own removes those of the stage before it, whose result
has been written by then.

ORACLE_SQL is None: compression, edit similarity and the tokenizer can't be put in SQL.
Tests hold the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import best_fit, decontaminate, line_dedup, minhash_forest, zstd_lang
from roadpulse.llm.common import Scratch
from roadpulse.session import ensure_defaults

_before: list[Scratch] = []


def _scratch(spark: SparkSession, name: str) -> Scratch:
    while _before:
        old = _before.pop()
        if old.spark is spark:
            old.drop()
    _before.append(Scratch(spark, name))
    return _before[-1]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear margin stay."""
    model = zstd_lang.learn(docs, zstd_lang.learned_from(F.col("key")))
    return zstd_lang.keep_identified(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; so do documents that are left without words."""
    return line_dedup.drop_lines(docs, line_dedup.find(docs, _scratch(spark, "line-dedup")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, Jaccard of 0.8 or more)."""
    return minhash_forest.keep_one(docs, _scratch(spark, "near-dedup"), words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences of 4096 tokens."""
    return best_fit.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), _scratch(spark, "packing"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ensure_defaults(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written = Scratch(spark, "pipeline")
    *first, (_, last) = STAGES
    for name, stage in first:
        out = written.table(stage(spark, docs, sf_dir), name)
        written.drop_table(docs)
        docs = out
    return last(spark, docs, sf_dir)
