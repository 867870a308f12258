"""Filter audits, the byte-pair codec and centroid clusters, against plain versions."""

from __future__ import annotations

import glob
import hashlib
import itertools
import math
import os
import random
import re
import struct

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadpulse.llm import bpe_codec, filter_audit, ptolemy, queries
from roadpulse.llm.common import Scratch

from .cases import HARD, LONG, SCHEMA, clashing

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", ["op11_filter_audit", "op13_ptolemy_clusters"])
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name]).fetchall()
    cols = [c[0] for c in con.description]
    got = [tuple(r) for r in queries.QUERIES[name](spark, SF).select(*[f"`{c}`" for c in cols]).collect()]
    assert want and sorted(got, key=repr) == sorted(want, key=repr)


# --- op11


def plain_audit(docs, labels):
    """(part, order, step) -> kept, removed, redundant, unique, good, toxic, shapley; documents one by one."""
    seen = {}
    for i, t, _ in docs:
        if i is not None:
            seen[t or ""] = min(i, seen.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    rows = []
    for i, t, lang in docs:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and seen[t] < i,
        }
        rows.append((lang or "", {f for f, x in fails.items() if x}, i in good and i is not None, i in toxic and i is not None))
    out, share = {}, {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in mine if f in r[1]]
                out[part, order, step + 1] = [len(left), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in failing), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                share[part, f] = share.get((part, f), 0) + len(gone)
    return {k: tuple(v + [share[k[0], k[1][k[2] - 1]]]) for k, v in out.items()}


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]) for r in df.collect()}


def test_audit_of_hard_rows(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "BUCKET_ROWS", 7)  # several buckets
    rng = random.Random(3)
    many = [(100 + i, " ".join(rng.choices("Aa b# c d e f g h".split(), k=rng.choice([3, 40, 120]))), rng.choice(["en", "de", "", None]), "s", 1) for i in range(40)]
    many += [(200 + i, "ONE TEXT OF MANY COPIES", "en", "hot", 1) for i in range(30)]
    distinct = (300, " ".join(f"w{i}" for i in range(200)), "fr", "s", 1)
    rows = HARD + many + [distinct]
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (None, 1, 1), (6, None, 1), (105, 1, 0), (210, 1, 1), (999, 1, 1)]
    docs = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audited(filter_audit.audit_documents(docs, told, Scratch(spark, "t11")))
    assert got == plain_audit([r[:3] for r in rows], labels)
    assert got["fr", "ABCDE", 5][0] == 1  # nothing fails: zeros, and it stays
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ids_")]


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_documents(docs, labels, Scratch(spark, "t11e")).collect() == []
    one = spark.createDataFrame(HARD[:1], SCHEMA)
    assert len(filter_audit.audit_documents(one, labels, Scratch(spark, "t11o")).collect()) == 600


def test_joins_stay_inside_buckets(spark):
    """Only the sums are exchanged, never the id tables."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    ids, failing, relations = filter_audit.failing_ids(docs, labels, Scratch(spark, "t11b"))
    try:
        plan = filter_audit._with(ids, failing["A"], "left_anti")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        relations.drop()


def test_rows_are_dealt_once_and_sets_counted_together(spark, monkeypatch):
    """A deal of the rows for every relation and a job for every set took too long where a shuffle has many tasks."""
    deals, store = [], filter_audit.Relations.store
    monkeypatch.setattr(filter_audit.Relations, "store", lambda self, df, label, *, dealt=False: (deals.append(dealt), store(self, df, label, dealt=dealt))[1])
    docs, labels = spark.createDataFrame(HARD, SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scratch = Scratch(spark, "t11d")
    filter_audit.audit_documents(docs, labels, scratch)
    assert deals.count(False) == 1
    counted = [f for f in glob.glob(f"{scratch.root.removeprefix('file:')}/*-counts/*") if os.path.isdir(f)]
    assert 0 < len(counted) <= 32 // filter_audit.SETS


# --- op12

TEXTS = [
    "", " ", "  \n\t x", "don't stop now it's", "<|endoftext|>a<|endoftext|> b <|endoftext", "café naïve über straße 12½ x²", "é́", "漢字かな",
    "\U0001f600\U0001f468‍\U0001f469", "\x00\x01\x1c\x1f\x7f\x85", "a" * 5000, "x  y   z ", " \n \n", LONG[:20_000], "İı ǅ ªºµ×÷",
]


def test_codec_equals_the_library(spark):
    lib = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(5)
    pool = [chr(c) for c in range(0x250)] + list("  \n\t 　 'sdtre 漢é\U0001f600") + ["<|endoftext|>", "<|endoftext", "'ll", "  "]
    texts = TEXTS + ["".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, None), (None, "no id"), (0, "again")], "doc_id long, text string")
    packed = bpe_codec.encode(clashing(df, case=False), VOCABULARY)
    rows = bpe_codec.unpack(packed).collect()
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    got = {r["doc_id"]: r["ids"] for r in rows if r["doc_id"] is not None and r["ids"] != lib.encode("again", add_special_tokens=False).ids}
    assert {i: ids for i, ids in enumerate(want) if i} == {i: ids for i, ids in got.items() if i}
    assert sorted(r["ids"] for r in rows if r["doc_id"] is None) == sorted([[], lib.encode("no id", add_special_tokens=False).ids])
    back = {r["doc_id"]: r["text"] for r in bpe_codec.decode(packed.where("doc_id > 0"), VOCABULARY).collect()}
    assert back == dict(list(enumerate(texts))[1:])


def test_decoding_of_any_identifiers():
    lib, codec = Tokenizer.from_file(VOCABULARY), bpe_codec.Codec(VOCABULARY)
    rng = random.Random(6)
    for _ in range(3000):
        ids = [rng.randrange(50257) if rng.random() < 0.5 else rng.randrange(256) for _ in range(rng.randint(0, 9))]
        assert codec.decode(codec.pack(ids)) == lib.decode(ids, skip_special_tokens=False)
    assert codec.decode(codec.pack([60_000, 39, 4_000_000_000])) == lib.decode([39], skip_special_tokens=False)


def test_caches_are_bounded_and_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe_codec, "CACHE_WORDS", 50)
    monkeypatch.setattr(bpe_codec, "CACHE_CHUNKS", 50)
    codec, lib = bpe_codec.Codec(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    for text in (LONG[:9000], LONG[:9000][::-1], LONG[:9000]):
        assert codec.unpack(codec.encode(text)) == lib.encode(text, add_special_tokens=False).ids
        assert len(codec.words) <= 50 and len(codec.words.older) <= 50 and len(codec.chunks) <= 50


def test_round_trip_digests(spark):
    lib = Tokenizer.from_file(VOCABULARY)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (51, "same"), (51, "same")]
    got = bpe_codec.round_trip(clashing(spark.createDataFrame(rows, "doc_id long, text string")), VOCABULARY).collect()
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(tuple(r) for r in got) == sorted(want)
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    out = {r["doc_id"]: r for r in queries.QUERIES["op12_bpe_codec"](spark, SF).collect()}
    for i, t in zip(docs.doc_id, docs.text):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert (out[i]["n_tokens"], out[i]["ids_sha256"]) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert out[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


# --- op13


def plain_clusters(rows, dims, scale, k, rounds, seed):
    """Every vector against every centroid, in Python's whole numbers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    found = [(i, *near(v)) for i, v in kept]
    inside = {n: sum(d for _, d, m in found if m == n) for n in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, inside[n], sum(inside.values()), sha[n]) for i, d, n in found]


def clustered(df, spark, **how):
    cols = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r[c] for c in cols) for r in ptolemy.cluster(df, Scratch(spark, "t13"), **how).collect()), key=repr)


def test_clusters_of_hard_vectors(spark):
    rng = random.Random(8)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.uniform(-2, 2)]) for _ in range(5)]) for i in range(150)]
    rows += [(1000 + i, [0.25] * 5) for i in range(80)] + [(7, rows[7][1]), (7, [1.0] * 5), (None, [0.5] * 5), (None, [0.5] * 5)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 4), (2003, [1.0] * 6), (2004, [None] + [1.0] * 4), (2005, [nan] + [1.0] * 4), (2006, [1.0] * 4 + [-inf])]
    rows += [(3000, [9e5] * 5), (3001, [-1e6, 1e6, 0.0, 0.0, 0.0])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), case=False).repartition(6)
    for k in (1, 2, 7, 16):
        want = plain_clusters(rows, 5, 64, k, 3, 1)
        assert clustered(df, spark, dims=5, k=k) == sorted(want, key=repr)
    few = [(5, [0.1, 0.2]), (6, [0.1, 0.2]), (None, [3.0, -1.0])]
    got = clustered(spark.createDataFrame(few, "vec_id long, embedding array<float>"), spark, dims=2, k=16, rounds=2)
    want = plain_clusters([(i, [float(np.float32(x)) for x in v]) for i, v in few], 2, 64, 16, 2, 1)
    assert got == sorted(want, key=repr)
    huge = spark.createDataFrame([(1, [1e300, -1e300]), (2, [-1e300, 1e300]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert len(clustered(huge, spark, dims=2, k=1)) == 3
    assert clustered(df.limit(0), spark, dims=5) == []


def test_bounds_hold_and_prune():
    """No bound exceeds the distance, also where it is met; most comparisons are saved where groups lie apart."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-400, 400, (16, 64))
    v = np.concatenate([centres[rng.integers(0, 16, 4000)] + rng.integers(-40, 40, (4000, 64)), centres, rng.integers(-(1 << 27), 1 << 27, (50, 64))])
    pivots = centres + rng.integers(-9, 9, (16, 64))
    pivots[5] = pivots[4]
    by = ptolemy.Pruned(pivots, centres)
    near = np.sqrt(np.array([ptolemy.exact(v, p) for p in pivots], np.float64)).T
    true = np.array([ptolemy.exact(v, c) for c in centres]).T
    assert (by.bounds(near) <= np.sqrt(true.astype(np.float64))).all()
    to, d = by.nearest(v, near)
    assert (to == true.argmin(axis=1)).all() and (d == true.min(axis=1)).all()
    assert by.compared < 0.3 * 15 * len(v)
