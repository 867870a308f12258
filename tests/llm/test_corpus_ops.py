"""Operators over the whole corpus: lines, near duplicates, fingerprints, benchmark items, packing, the pipeline."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from roadpulse.llm import best_fit, components, decontaminate, imatch, line_dedup, minhash_forest, queries
from roadpulse.llm.common import Scratch

from .cases import HARD, LONG, SCHEMA, WORDS, clashing, near_components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def documents():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")


def prose(rng, n):
    return [rng.choice(WORDS) + str(rng.randrange(200)) for _ in range(n)]


def changed(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.randrange(10**6)}"
    return out


# --- components


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1400)] + [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)]
    links += [(5, 5), (None, 3), (3, None), (0, 1), (1, 0)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in list(parent)}


# --- op3


def test_lines_equal_and_near(spark):
    rng = random.Random(3)
    line = prose(rng, 60)
    near = line[:-1] + [line[-1] + "s"]
    far = changed(rng, line, 40)
    own = [" ".join(prose(rng, 20)) for _ in range(6)]
    rows = [
        (1, "\n".join([own[0], " ".join(line), "short one"])),
        (2, "\n".join([own[1], " ".join(line).upper() + "!!", "short one"])),
        (3, "\n".join([" ".join(near), own[2]])),
        (4, "\n".join([" ".join(far), own[3]])),
        (5, " ".join(line)),
    ]
    df = clashing(spark.createDataFrame(rows, DOCS))
    removed = line_dedup.find(df, Scratch(spark, "t"))
    got = {r["doc_id"]: (r["n_lines"], r["removed"]) for r in line_dedup.report(df, removed).collect()}
    assert got[1] == (3, []) and got[2] == (3, [1]) and got[4] == (2, []) and got[5] == (1, [0])
    a, b = (line_dedup_sim(spark, " ".join(x)) for x in (line, near))
    assert got[3] == (2, [0] if bin((a ^ b) & (2**64 - 1)).count("1") <= line_dedup.RADIUS else [])
    kept = line_dedup.drop_lines(df, removed)
    assert kept.columns == df.columns
    texts = {r[0]: r[1] for r in kept.collect()}
    assert texts[2] == own[1] + "\nshort one" and 5 not in texts and texts[1] == rows[0][1]


def line_dedup_sim(spark, text):
    return line_dedup.hashed_lines(spark.createDataFrame([(1, text)], DOCS), "doc_id", "text").first()["sim"]


def test_simhash_equals_the_plain_sum(spark):
    words = ("bark acre nest acre nest acre " * 3 + "tree").split()
    hashes = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()]
    want = 0
    for k in range(64):
        if 2 * sum((h >> k) & 1 for h in hashes) > len(hashes):
            want |= 1 << k
    assert line_dedup_sim(spark, " ".join(words)) & (2**64 - 1) == want
    # words of fewer than four characters count only where there are no others
    assert line_dedup_sim(spark, "the " * 50 + " ".join(words)) & (2**64 - 1) == want
    assert line_dedup_sim(spark, "to be or not") != line_dedup_sim(spark, "to do as one")


def test_blocks_find_all_within_the_radius(spark):
    """Pairs that differ in at most SURE bits always share an index entry."""
    rng = random.Random(4)
    sims = []
    for i in range(200):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.randint(0, line_dedup.SURE)):
            b ^= 1 << k
        sims += [(2 * i, a), (2 * i + 1, b)]
    found = line_dedup.block_pairs(spark.createDataFrame([(n, signed(s)) for n, s in sims], "node long, sim long"))
    got = [(r["a"], r["b"]) for r in found.where("not crowded").collect()]
    assert sorted(got) == [(2 * i + 1, 2 * i) for i in range(200)] and found.where("crowded").isEmpty()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_crowded_entries_are_compared_whole(spark):
    """All candidates between different components are found, however many nodes share an entry."""
    rng = random.Random(44)
    centre = rng.getrandbits(64)
    sims = {}
    for n in range(150):
        sims[n] = centre
        for k in rng.sample(range(64), rng.randint(0, 9)):
            sims[n] ^= 1 << k
    blocks = [((1 << width) - 1) << at for at, width in line_dedup.BLOCKS]
    want = set()
    for a in sims:
        for b in range(a):
            x = sims[a] ^ sims[b]
            if x.bit_count() <= line_dedup.RADIUS and sum(x & m == 0 for m in blocks) >= line_dedup.SHARED:
                want.add((a, b))
    nodes = spark.createDataFrame([(n, signed(s)) for n, s in sims.items()], "node long, sim long")
    scratch = Scratch(spark, "t")
    found = scratch.table(line_dedup.block_pairs(nodes), "found")
    first = [(r["a"], r["b"]) for r in found.where("not crowded").collect()]
    assert len(first) == len(set(first)) and set(first) < want
    keys = found.where("crowded").select("key")
    assert keys.count() == keys.distinct().count() > 0
    # no node linked yet, then the even ones linked: what is within a component isn't compared again
    alone = spark.createDataFrame([], "node long, component long")
    rest = [(r["a"], r["b"]) for r in line_dedup.crowded_pairs(nodes, keys, alone, scratch).collect()]
    assert len(rest) == len(set(rest)) and set(rest) | set(first) == want
    even = spark.createDataFrame([(n, 0) for n in range(0, 150, 2)], "node long, component long")
    apart = {(r["a"], r["b"]) for r in line_dedup.crowded_pairs(nodes, keys, even, scratch).collect()}
    assert apart == {(a, b) for a, b in rest if a % 2 or b % 2}


def test_changed_lines_equal_brute_force(spark):
    """Lines with a word changed, added or left out (edit similarity above 0.8): exactly those whose hashes are
    candidates lose their copy, which most are; unlike lines lose nothing."""
    rng = random.Random(45)
    rows = []
    for i in range(200):
        line = prose(rng, rng.randint(20, 80))
        k = rng.randrange(len(line))
        edited = [line[:k] + ["changed"] + line[k + 1 :], line[:k] + ["added"] + line[k:], line[:k] + line[k + 1 :]][i % 3]
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(edited))]
    df = spark.createDataFrame(rows, DOCS)
    sims = {r["id"]: r["sim"] & (2**64 - 1) for r in line_dedup.hashed_lines(df, "doc_id", "text").collect()}
    want = set()
    for i in range(200):
        x = sims[2 * i] ^ sims[2 * i + 1]
        shared = sum((x >> at) & ((1 << width) - 1) == 0 for at, width in line_dedup.BLOCKS)
        if x.bit_count() <= line_dedup.RADIUS and shared >= line_dedup.SHARED:
            want.add(2 * i + 1)
    removed = [r["id"] for r in line_dedup.find(df, Scratch(spark, "t")).collect()]
    assert sorted(removed) == sorted(want) and len(want) >= 170


def test_large_group_of_near_lines_is_one(spark):
    rng = random.Random(5)
    line = prose(rng, 400)
    rows = [(i, " ".join([*line[:k], "x" + line[k], *line[k + 1 :]])) for i, k in enumerate(rng.sample(range(400), 150))]
    removed = line_dedup.find(spark.createDataFrame(rows, DOCS), Scratch(spark, "t")).count()
    assert removed == 149


def test_repeated_rows_have_the_sims_of_one(spark):
    rng = random.Random(18)
    texts = [" ".join(prose(rng, n)) for n in (20, 60, 127, 128, 300)]
    one = {(r["k1"], r["k2"]): r["sim"] for r in line_dedup.hashed_lines(spark.createDataFrame(list(enumerate(texts)), DOCS), "doc_id", "text").collect()}
    rows = [(k, t) for k, t in enumerate(texts) for _ in range(k + 2)] + [(None, texts[2])] * 3
    df = spark.createDataFrame(rows, DOCS)
    every = line_dedup.hashed_lines(df, "doc_id", "text")
    crowded = {(r["k1"], r["k2"]): r["own"] for r in line_dedup.crowded_sims(df, every, "doc_id", "text").collect()}
    got = every.collect()
    assert len(got) == 6 and len(crowded) == 3 + 1
    assert all((crowded[r["k1"], r["k2"]] if r["sim"] is None else r["sim"]) == one[r["k1"], r["k2"]] for r in got)
    # a near line of one that is repeated is removed, and the others stay
    near = texts[4][:-1] + "zz"
    removed = line_dedup.find(spark.createDataFrame([*rows, (9, near)], DOCS), Scratch(spark, "t"))
    assert sorted((r["id"], r["removed"]) for r in removed.collect()) == [(2, [0]), (9, [0])]


def test_long_lines_are_compared_whole(spark):
    rng = random.Random(19)
    a = "".join(rng.choice("abcdefghij ") for _ in range(20_000))
    b = "y" + a[:500] + "x" * 1500 + a[500:] + "z"
    c = "".join(rng.choice("abcdefghij ") for _ in range(20_000))
    pairs = spark.createDataFrame([(2, 1, a, b), (4, 3, a, c), (6, 5, b, a)], "a long, b long, na string, nb string")
    assert sorted(map(tuple, line_dedup.similar(pairs).collect())) == [(2, 1), (6, 5)]


def test_short_and_unspaced_lines(spark):
    rng = random.Random(20)
    script = lambda first, letters, n: "".join(chr(first + rng.randrange(letters)) for _ in range(n))
    han, thai = script(0x4E00, 3000, 300), script(0x0E01, 46, 12)
    own = [" ".join(prose(rng, 20)) for _ in range(4)]
    rows = [
        (1, "\n".join([own[0], "All rights reserved", han, "Copyright", thai, han[:5], han[:4], "menu"])),
        (2, "\n".join(["all rights reserved.", own[1], han + "\u65b0", "copyright", "x " + thai, han[:5], han[:4], "menu"])),
        (3, "\n".join([own[2], "!!", script(0x4E00, 3000, 300), thai])),
        (4, "\n".join([own[3], "!!", "unsubscribe", "unsubscribe"])),
    ]
    removed = line_dedup.find(spark.createDataFrame(rows, DOCS), Scratch(spark, "t"))
    got = {r["id"]: r["removed"] for r in removed.collect()}
    # less than ten characters, or five letters of a script without spaces, stay; line 4 is two edits in fourteen characters from thai
    assert got == {2: [0, 2, 4, 5], 3: [3], 4: [3]}


def test_line_edges(spark):
    df = clashing(spark.createDataFrame(HARD, SCHEMA))
    removed = line_dedup.find(df, Scratch(spark, "t"))
    got = [(r["doc_id"], r["n_lines"], r["removed"]) for r in line_dedup.report(df, removed).collect()]
    assert len(got) == len(HARD) and (None, 0, []) in got and (3, 1, []) in got
    # document 1 occurs twice and keeps its lines; one of document 2's texts repeats a line of it
    assert [r[2] for r in got if r[0] == 1] == [[], []] and sorted(r[2] for r in got if r[0] == 2) == [[], [0]]
    assert line_dedup.drop_lines(df, removed).count() == len(HARD)
    empty = spark.createDataFrame([], SCHEMA)
    assert line_dedup.find(empty, Scratch(spark, "t")).count() == 0


# --- op4


def brute_leaks(rows, items):
    out = set()
    for d, text in rows:
        w = decontaminate.words_of(text)
        for i, item in items:
            x = decontaminate.words_of(item)
            if len(x) >= 5:
                own = decontaminate.weights(x)
                for at in range(len(w) - len(x) + 1):
                    if decontaminate.likeness(own, decontaminate.weights(w[at : at + len(x)])) >= decontaminate.LIKENESS:
                        out.add((d, i))
    return out


def test_items_are_found(spark):
    rng = random.Random(6)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([5, 9, 16, 33, 61, 130, 300])] + [(90, "too short"), (91, None), (92, "")]
    rows = []
    for i, text in items[:7]:
        before, after = " ".join(prose(rng, 40)), " ".join(prose(rng, 40))
        rows.append((10 * i, f"{before} {text.upper()}!! {after}"))
        rows.append((10 * i + 1, text + "\n" + before))
        words = text.split()
        rows.append((10 * i + 2, f"{before} {' '.join(words[: len(words) // 2])} {after}"))
        rows.append((10 * i + 3, " ".join([*prose(rng, 30), *words[:-1], "other", *prose(rng, 5)])))
    rows += [(900, None), (901, ""), (902, LONG), (None, items[3][1]), (903, items[2][1]), (903, items[2][1])]
    bench = clashing(spark.createDataFrame(items, "item_id long, text string"))
    df = clashing(spark.createDataFrame(rows, DOCS))
    got = decontaminate.find(df, bench).collect()
    want = brute_leaks([r for r in rows if r[0] != 902], items)
    verified = {(r["doc_id"], r["item_id"]) for r in got}
    assert verified <= want and {(10 * i + k, i) for i in range(7) for k in (0, 1)} | {(None, 3), (903, 2)} <= verified
    assert all(r["likeness"] >= 0.8 for r in got)
    several = decontaminate.find(df, bench, max_bytes=1000).collect()
    assert sorted(map(tuple, several), key=repr) == sorted(map(tuple, got), key=repr)
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns and kept.count() == sum(d not in {x for x, _ in verified} for d, _ in rows)
    assert decontaminate.find(df, bench.limit(0)).count() == 0 and decontaminate.find(df.limit(0), bench).count() == 0


def test_window_hashes_equal_the_plain_sum():
    rng = np.random.default_rng(7)
    h = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for size in (5, 42, 215):
        got = decontaminate.window_hashes(decontaminate.running_sums(h), size)
        for at in (0, 17, 400 - size):
            ones = [2 * sum(int(x) >> k & 1 for x in h[at : at + size]) > size for k in range(64)]
            assert int(got[at]) == sum(1 << k for k, one in enumerate(ones) if one)


def test_blocks_hold_every_pair_within_the_radius():
    rng = np.random.default_rng(8)
    prints = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, n, replace=False)) for n in [*range(16), *[decontaminate.RADIUS] * 300]]
    own = np.array([int(prints[k % 40]) ^ f for k, f in enumerate(flips)], np.uint64)
    windows = decontaminate.Windows(prints, np.arange(40), np.zeros(40, np.int64))
    got = {pair for place, entry in windows.near(own) for pair in zip(place.tolist(), entry.tolist())}
    assert got == {(a, b) for a in range(len(own)) for b in range(40) if (int(own[a]) ^ int(prints[b])).bit_count() <= decontaminate.RADIUS}
    assert len(got) >= 300 + decontaminate.RADIUS + 1


def test_leaks_equal_brute_force(spark):
    docs, bench = documents(), pd.read_parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op4_decontaminate"](spark, SF).collect()}
    starts = collections.defaultdict(list)
    items = dict(zip(bench["item_id"], map(decontaminate.words_of, bench["text"])))
    for i, w in items.items():
        for k in range(len(w) - 4):
            starts[tuple(w[k : k + 5])].append((i, k))
    want = set()
    for d, text in zip(docs["doc_id"], docs["text"]):
        w = decontaminate.words_of(text)
        places = {(i, at - k) for at in range(len(w) - 4) for i, k in starts.get(tuple(w[at : at + 5]), ())}
        for i, at in places:
            if at >= 0 and at + len(items[i]) <= len(w) and decontaminate.likeness(decontaminate.weights(items[i]), decontaminate.weights(w[at : at + len(items[i])])) >= 0.8:
                want.add((d, i))
    assert got == want


def clipped_leaks(rows, items):
    """Like ``brute_leaks``, with places that stick out of a document clipped to it."""
    out = set()
    for d, text in rows:
        w = decontaminate.words_of(text)
        for i, item in items:
            x = decontaminate.words_of(item)
            if len(x) >= 5 and len(w) >= 5:
                own = decontaminate.weights(x)
                places = {(max(at, 0), min(at + len(x), len(w))) for at in range(5 - len(x), len(w) - 4)}
                if any(decontaminate.likeness(own, decontaminate.weights(w[a:b])) >= decontaminate.LIKENESS for a, b in places):
                    out.add((d, i))
    return out


def test_places_are_clipped_to_the_document():
    """Documents that start with, end with or consist of an item with one word deleted at its end or start."""
    rng = random.Random(16)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([22, 31, 40, 48, 58, 130])]
    rows = []
    for i, text in items:
        for k, words in enumerate((text.split()[1:], text.split()[:-1])):
            around = prose(rng, 30)
            rows += [(100 * i + 10 * k + n, " ".join(x)) for n, x in enumerate((words, words + around, around + words))]
    got = decontaminate.Items(items).leaks([t for _, t in rows])
    found = {(rows[d][0], i) for d, i, *_ in got}
    assert found == clipped_leaks(rows, items) and len(found) == len(rows)
    assert all(0 <= first < len(rows[d][1].split()) for d, _, first, _ in got)


def test_edited_items_equal_brute_force():
    """Replaced, deleted and added words, alone and next to each other, at any place of an item; also in scripts without spaces."""
    rng = random.Random(17)
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(60))
    items = [(i, " ".join(prose(rng, rng.randint(15, 59)))) for i in range(30)] + [(30, " ".join(prose(rng, 300))), (31, han), (32, "\u0e01\u0e32\u0e23\u0e2d\u0e48\u0e32\u0e19\u0e2b\u0e19\u0e31\u0e07\u0e2a\u0e37\u0e2d\u0e17\u0e38\u0e01\u0e27\u0e31\u0e19")]
    rows = [(9000, "\u3002" + han[:30] + "\u65b0" + han[30:]), (9001, "before " + items[32][1] + " after"), (9002, han[:9])]
    for i, text in items[:31]:
        words = text.split()
        for k in range(12):
            at, n = rng.randrange(len(words) - 1), rng.randint(1, 2)
            new = [f"new{rng.randrange(10**6)}" for _ in range(n)]
            edited = [words[:at] + new + words[at + n :], words[:at] + words[at + n :], words[:at] + new + words[at:]][k % 3]
            around = prose(rng, 20) if k % 2 else []
            rows.append((100 * i + k, " ".join([*around, *edited, *around])))
    want = clipped_leaks(rows, items)
    got = decontaminate.Items(items).leaks([t for _, t in rows])
    assert {(rows[d][0], i) for d, i, *_ in got} == want
    assert {(9000, 31), (9001, 32)} <= want and len(want) > 100
    for d, i, first, like in got:  # every place is told once, as it was verified
        w, x = decontaminate.words_of(rows[d][1]), decontaminate.words_of(items[i][1])
        assert like == max(decontaminate.likeness(decontaminate.weights(x), decontaminate.weights(w[max(at, 0) : at + len(x)])) for at in range(first - len(x), first + 1) if max(at, 0) == first)
    assert len({(d, i) for d, i, *_ in got}) == len(got)


# --- op5


def test_copies_of_one_text_beyond_the_windows_are_linked(spark):
    """Every copy is alike to the first text alone: more of them than its neighbours in all orders."""
    rng, n = random.Random(5), 600
    base = [f"w{rng.randrange(10**9)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, n + 1):
        own = list(base)
        for at in rng.sample(range(5, 115, 5), 3):  # three words, no shingle with two of them
            own[at] = f"x{i}at{at}"
        rows.append((i, " ".join(own)))
    assert n > 2 * minhash_forest.NEIGHBOURS * minhash_forest.TREES
    df = spark.createDataFrame(rows + [(n + 1, "another text of a few words")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash_forest.near_duplicates(df, Scratch(spark, "t"), words=4).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {n + 1: n + 1}


def test_regions_descend_and_are_dealt_to_blocks(spark, monkeypatch):
    """Small regions and blocks: the same links, at longer prefixes and in several blocks."""
    monkeypatch.setattr(minhash_forest, "REGION_PAIRS", 200)
    monkeypatch.setattr(minhash_forest, "REGION_ROWS", 8)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 32, minhash_forest.HASHES, dtype=np.uint32)
    rows = []
    for i in range(60):  # one large component, every fifth row a component of its own
        own = base.copy()
        own[rng.integers(0, minhash_forest.HASHES, 10)] = rng.integers(0, 1 << 32, 10, dtype=np.uint32)
        rows.append((i, 100, bytearray(own.astype(">u4").tobytes()), i if i % 5 == 0 else 1))
    nodes = spark.createDataFrame(rows, "node long, n long, values binary, component long")
    got = minhash_forest.regions(nodes, Scratch(spark, "t")).toPandas()
    assert got.groupby("region").block.nunique().max() > 1
    pairs = {(a, b) for _, g in got.groupby(["region", "block"]) for a, ca in zip(g.node, g.component) for b, cb in zip(g.node, g.component) if a < b and ca != cb}
    sizes = got[["region", "node"]].drop_duplicates().groupby("region").size()
    assert sizes.min() > minhash_forest.NEIGHBOURS + 1
    seen = {x for p in pairs for x in p}
    assert {i for i in range(0, 60, 5)} <= seen


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(8)
    rows = list(zip(*(documents()[c].tolist() for c in ("doc_id", "text"))))
    at = 10_000
    for _ in range(25):  # near copies around the threshold
        words = prose(rng, rng.randint(30, 300))
        for k in range(4):
            rows.append((at, " ".join(changed(rng, words, rng.randint(0, max(1, len(words) // 25))))))
            at += 1
    group = prose(rng, 300)
    for _ in range(60):
        rows.append((at, " ".join(changed(rng, group, 2))))
        at += 1
    rows += [(at, None), (at + 1, ""), (at + 2, " \n"), (at + 3, "one two"), (at + 4, "ONE two"), (at + 5, "one"), (at + 6, LONG), (at + 7, LONG + " end")]
    got = minhash_forest.near_duplicates(clashing(spark.createDataFrame(rows, DOCS)), Scratch(spark, "t"), words=4).collect()
    want, sizes = near_components(rows, 4)
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_edges(spark):
    df = clashing(spark.createDataFrame(HARD, SCHEMA))
    got = minhash_forest.near_duplicates(df, Scratch(spark, "t"), words=4).collect()
    assert len(got) == len(HARD)
    assert {r["component_id"] for r in got if r["doc_id"] == 1} == {1}
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True] * 3
    kept = minhash_forest.keep_one(df, Scratch(spark, "t"))
    assert kept.columns == df.columns and kept.count() == len(HARD)
    assert minhash_forest.near_duplicates(spark.createDataFrame([], SCHEMA), Scratch(spark, "t")).count() == 0


# --- op6


def test_fingerprints(spark):
    docs = documents()
    got = queries.QUERIES["op6_imatch"](spark, SF).toPandas().set_index("doc_id")
    texts = docs["text"].tolist()
    for k, (i, text) in enumerate(zip(docs["doc_id"], texts)):
        n = len(text)
        edited = text[: n - n // 4] + texts[(k + 1) % len(texts)][: n // 4]
        assert (got["n_chars"][i], got["edited_sha256"][i]) == (n, hashlib.sha256(edited.encode()).hexdigest())
    prints = docs["doc_id"].map(got["fingerprint"])
    assert prints.groupby(docs["text"]).nunique().max() == 1
    assert got["near_edited"].between(0, 1).all() and got["near_next"].between(0, 1).all()
    assert got["near_edited"].mean() > 0.3 and got["near_next"].mean() < 0.1


def test_whole_hash_equals_plain_hash(spark):
    """The fingerprint's first part hashes the sorted terms of the band."""
    rows = [(i, "common words " + ("rare alpha" if i < 3 else f"single{i}")) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lex = {r["h"]: r["band"] for r in imatch.lexicon(df, 60).collect()}
    h = {w: spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] for w in ("common", "words", "rare", "alpha")}
    assert lex == {h["common"]: False, h["words"]: False, h["rare"]: True, h["alpha"]: True}


def test_fingerprint_edges(spark):
    df = clashing(spark.createDataFrame(HARD, SCHEMA))
    got = imatch.fingerprint_edits(df, Scratch(spark, "t")).collect()
    assert len(got) == len(HARD)
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 1}) == 1
    one = imatch.fingerprint_edits(df.limit(1), Scratch(spark, "t")).first()
    assert one["near_next"] == 1.0
    assert imatch.fingerprint_edits(spark.createDataFrame([], SCHEMA), Scratch(spark, "t")).count() == 0


# --- op8


def check_packing(rows, got, capacity=4096):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want[i, k, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), sum(r["length"] for r in got)


def test_packing(spark):
    docs = documents()
    n, tokens = check_packing(list(zip(docs["doc_id"], docs["text"])), queries.QUERIES["op8_best_fit_packing"](spark, SF).collect())
    assert n <= -(-tokens // 4096) + 1


def test_packing_edges(spark, monkeypatch):
    monkeypatch.setattr(best_fit, "RANK_ROWS", 3)  # several parts a length
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(i, t) for i, t, *_ in HARD] + [(100 + i, "equal texts") for i in range(50)]
    got = best_fit.pack_documents(clashing(spark.createDataFrame(rows, DOCS)), path, Scratch(spark, "t")).collect()
    check_packing(rows, got)
    assert best_fit.pack_documents(spark.createDataFrame([], DOCS), path, Scratch(spark, "t")).count() == 0


def test_chunked_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, of = Tokenizer.from_file(path), best_fit.chunk_ids(path)
    rng = random.Random(9)
    parts = [" ", "  ", "\n", "\t", "a", "Hello", "'s", "12", ".", " ", "é", "é", "́", "Σ", "ΑΣ", "漢", "<|endoftext|>", "<|startoftext|>", "\r\n", "\x1c", "\x85", "İ", "K"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert of.ids(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_plan_is_best_fit():
    """The plan over counts fills as many sequences as best fit piece by piece."""
    rng = random.Random(10)
    for _ in range(60):
        capacity = rng.choice([10, 37, 100])
        counts = {n: rng.randint(1, 30) for n in rng.sample(range(1, capacity + 1), rng.randint(1, capacity // 2))}
        slots = best_fit.plan(counts, capacity)
        used, places = collections.Counter(), collections.Counter()
        for k, (length, rank, first, each, offset) in enumerate(slots):
            own = [s for s in slots if s[0] == length]
            after = own[own.index(slots[k]) + 1][1] if own.index(slots[k]) + 1 < len(own) else counts[length]
            for r in range(rank, after):
                seq, at = first + (r - rank) // each, offset + (r - rank) % each * length
                used[seq] += length
                places[length] += 1
                assert at + length <= capacity
        assert places == collections.Counter(counts) and max(used.values()) <= capacity
        free = []
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fit = min((f for f in free if f >= length), default=None)
                if fit is None:
                    free.append(capacity - length)
                else:
                    free[free.index(fit)] = fit - length
        assert len(used) == len(free)


# --- pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    written = Scratch(spark, "t")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written.table(stage(spark, docs, SF), name)
        seen[name] = docs.toPandas()
    for name in list(seen)[:-1]:
        assert list(seen[name].columns) == ["doc_id", "text", "lang", "source", "n_chars"]
    lines = collections.Counter(n for t in seen["line_dedup"]["text"] for line in t.split("\n") if len(n := tuple(re.findall(r"[^\W_]+", line.lower()))) >= 5)
    assert max(lines.values()) == 1
    rows = list(zip(seen["line_dedup"]["doc_id"], seen["line_dedup"]["text"]))
    component, _ = near_components(rows, 5)
    assert set(seen["near_dedup"]["doc_id"]) == {i for i, c in component.items() if i == c}
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    rows = list(zip(seen["near_dedup"]["doc_id"], seen["near_dedup"]["text"]))
    items = decontaminate.Items(list(zip(bench["item_id"], bench["text"])))
    leaks = {rows[d][0] for d, *_ in items.leaks([t for _, t in rows])}
    assert leaks and set(seen["decontamination"]["doc_id"]) == {i for i, _ in rows} - leaks
    check_packing(list(zip(seen["decontamination"]["doc_id"], seen["decontamination"]["text"])), seen["packing"].to_dict("records"))
    assert corpus_pipeline.run(spark, SF).select("doc_id", "piece").count() == len(seen["packing"])


def test_pipeline_edges(spark, tmp_path):
    bench = spark.createDataFrame([(1, " ".join(WORDS)), (2, None)], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, rows in enumerate(([], HARD)):
        docs, written = clashing(spark.createDataFrame(rows, SCHEMA), case=False), Scratch(spark, "t")
        for name, stage in corpus_pipeline.STAGES:
            docs = written.table(stage(spark, docs, str(tmp_path)), name)
        assert (docs.count() > 0) == bool(k)
