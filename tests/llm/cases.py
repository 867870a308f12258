"""Plain versions of the operators' results, and rows that are hard to handle."""

from __future__ import annotations

import collections
import math
import re

LONG = " ".join(f"word{i % 977} filler{i % 31}" for i in range(30_000))
WORDS = "a quiet river runs under the old stone bridge while three grey herons wait for fish near the mill".split()

#: doc_id, text, lang, source, n_chars; repeated rows, ids and texts, nulls in any column.
HARD = [
    (1, "the same line of words stands here twice\nand another line that is long enough to count", "en", "s", 10),
    (1, "the same line of words stands here twice\nand another line that is long enough to count", "en", "s", 10),
    (2, "the same line of words stands here twice\nbut this one differs from all of the others", None, None, None),
    (2, "an id that repeats with a text of its own and some more words", "en", "s", None),
    (None, None, None, None, None),
    (None, "a text without an id and still a few words to read", "en", "s", 1),
    (None, "a text without an id and still a few words to read", "en", "s", 1),
    (3, "", "en", "s", 0),
    (4, "   \n\n\t ", "en", "s", 3),
    (5, "12345 !!! 67890", "en", "s", 3),
    (6, LONG, "en", "s", 3),
    (7, "\u0001 \u0002 e\u0301 \u00e9 \U0001f600 \u6f22\u5b57", "fr", "s", 3),
    (8, "x" * 50_000, "en", "s", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def clashing(df, case=True):
    """The same rows with columns whose names clash with those that operators make, also but for their case."""
    from pyspark.sql import functions as F

    out = df
    for name in ("id", "key", "row", "n", "kept", "spans", "verdict", "position", "block", "_h", "_c0"):
        out = out.withColumn(name, F.lit("x"))
    return out.select("*", F.lit("y").alias("Doc_Id"), F.lit("z").alias("TEXT")) if case else out


def shingles(text, words):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def near_components(rows, words, percent=80):
    """doc_id -> smallest doc_id reachable; ids must be distinct."""
    sets = {i: shingles(t, words) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    t = text or ""
    out = [(m.start(), 1, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 2, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return out + [(m.start(), 3, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]


def entropy(window):
    n = len(window)
    return -sum(c / n * math.log2(c / n) for c in collections.Counter(window).values())


def entropy_spans(text, s):
    out = []
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text or ""):
        run, w = m[0], s.WINDOW
        if len(run) < w or not re.search("[0-9]", run) or any(re.search(a, run) for a in s.ALLOW):
            continue
        least = lambda x: s.MIN_HEX if re.fullmatch("[0-9a-fA-F]+", x) else s.MIN_MIXED
        hot = [k for k in range(len(run) - w + 1) if round(entropy(run[k : k + w]), 9) >= least(run[k : k + w])]
        if hot:
            out.append((m.start() + hot[0], 4, m.start() + hot[-1] + w))
    return out
