"""I-Match fingerprints over randomised lexicon subsets.

Native: DataFrame and SQL functions only. The lexicon holds the terms whose document
frequency lies in a band. A text's distinct terms of the lexicon are sorted and
hashed: once whole, and once for each of ``SUBSETS`` random subsets of the lexicon,
``REPEATS`` of every share in ``SHARES``. The fingerprint is the list of these hashes
(empty where a subset holds none of the terms). Likeness is 1 if the whole hashes are
equal; else the best share, over the subset sizes, of subsets with equal hashes among
those in which either text has terms.

Texts of at most ``SHORT`` distinct terms may use all frequent terms, also those above
the band.

The lexicon's size is bounded by the band, not by the corpus: a term needs
``MIN_SHARE`` of all documents, so there are at most (mean distinct terms of a
document) / ``MIN_SHARE`` of them. It is broadcast only below ``MAX_LEXICON`` terms and
joined by a shuffle beyond.

Defined results: a null text is empty; an empty text, or one without a frequent term,
has a fingerprint of its distinct terms' sorted hashes alone (equal for equal texts)
and no subset hashes. Rows that repeat an id and a text are one document: each gives a
row, and the next document is another one; a document alone is its own next. Null ids
come first in the order; rows of one id are ordered by a hash of their text. Further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, pick, positions

#: The band: shares of the documents a term occurs in.
MIN_SHARE, MAX_SHARE, MIN_DOCS = 1e-3, 0.05, 2
#: Random subsets: shares of the lexicon (1 / n), and subsets of each.
SHARES, REPEATS = (4, 16, 64, 256), 8
SUBSETS = len(SHARES) * REPEATS
SHORT, MAX_LEXICON = 32, 4_000_000
#: A subset size with fewer subsets in use counts as so many.
LEAST_IN_USE = 4


def terms(text: Column) -> Column:
    """Hashes of the distinct words: lower-cased runs without ASCII punctuation and space."""
    words = F.array_distinct(F.split(F.lower(text), r"[\x00-/:-@\[-`{-\x7f]+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def lexicon(texts: DataFrame, n_docs: int, *, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """``h, band, subsets`` of the frequent terms; the bits of ``subsets`` tell the subsets a term is in.

    The subsets of one repeat are nested: each keeps a quarter of the one before.
    """
    df = texts.select(F.explode(terms(F.col("text"))).alias("h")).groupBy("h").count()
    member = F.lit(0).cast("bigint")
    for i in range(SUBSETS):
        share, r = SHARES[i // REPEATS], i % REPEATS
        member = member.bitwiseOR(F.when(F.pmod(F.xxhash64("h", F.lit(r)), F.lit(share)) == 0, F.lit(1 << i)).otherwise(0))
    frequent = df.where(F.col("count") >= max(MIN_DOCS, min_share * n_docs))
    return frequent.select("h", (F.col("count") <= max(MIN_DOCS, max_share * n_docs)).alias("band"), member.alias("subsets"))


def fingerprints(texts: DataFrame, lex: DataFrame, keys: list[str], carry: str) -> DataFrame:
    """``keys, carry, fingerprint`` of ``texts`` (keys, carry, text); rows with equal keys must be equal."""
    own = texts.select(*keys, carry, terms(F.col("text")).alias("t"))
    # computed once a text, before its terms become rows
    own = own.select(*keys, carry, "t", (F.size("t") <= SHORT).alias("short"), F.xxhash64(F.sort_array("t")).alias("rest"))
    # a text's first row stands for the text itself, so none is lost in the join
    flat = own.select(*keys, carry, "short", "rest", F.explode(F.concat(F.array(F.lit(None).cast("bigint")), "t")).alias("h"))
    flat = flat.withColumn(carry, F.when(F.col("h").isNull(), F.col(carry)))
    hit = flat.join(lex, "h", "left").where(F.col("h").isNull() | F.col("band") | (F.col("short") & F.col("band").isNotNull()))
    entry = F.when(F.col("h").isNotNull(), F.struct("h", "subsets"))
    rows = hit.groupBy(*keys).agg(F.sort_array(F.collect_set(entry)).alias("s"), F.max("rest").alias("rest"), F.max(carry).alias(carry))
    # each subset is picked from the larger one that holds it, so the sorted terms are gone through about once a repeat
    for level in range(len(SHARES)):
        rows = rows.select("*", *[_inside("s" if not level else f"s{level - 1}_{r}", 1 << (level * REPEATS + r)).alias(f"s{level}_{r}") for r in range(REPEATS)])
    hashed = lambda c: F.xxhash64(F.transform(c, lambda x: x["h"]))
    parts = [F.when(F.size(c) > 0, F.hex(hashed(c).bitwiseAND(0xFFFFFFFF))).otherwise("") for c in (f"s{level}_{r}" for level in range(len(SHARES)) for r in range(REPEATS))]
    whole = F.when(F.size("s") > 0, F.hex(hashed("s"))).otherwise(F.concat(F.lit("t"), F.hex("rest")))
    return rows.select(*keys, carry, F.concat_ws(".", whole, *parts).alias("fingerprint"))


def _inside(terms: str, bit: int) -> Column:
    return F.filter(terms, lambda x: x["subsets"].bitwiseAND(bit) != 0)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""
    x, y = F.split(a, r"\."), F.split(b, r"\.")
    best = [F.lit(0.0)]
    for s in range(len(SHARES)):
        one, two = F.slice(x, 2 + s * REPEATS, REPEATS), F.slice(y, 2 + s * REPEATS, REPEATS)
        pairs = F.arrays_zip(one.alias("p"), two.alias("q"))
        used = F.size(F.filter(pairs, lambda z: (z["p"] != "") | (z["q"] != "")))
        same = F.size(F.filter(pairs, lambda z: (z["p"] != "") & (z["p"] == z["q"])))
        best.append(same / F.greatest(used, F.lit(LEAST_IN_USE)))
    return F.when(F.element_at(x, 1) == F.element_at(y, 1), 1.0).otherwise(F.greatest(*best)).cast("double")


def fingerprint_edits(df: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Edited: the last quarter of the code points is replaced by the first as many of the
    next document, in ascending order of ids (after the last: the first).
    """
    docs = pick(df, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    kid = F.coalesce(F.concat(F.lit("i"), F.col("id").cast("string")), F.lit("n"))
    keyed = docs.select("id", kid.alias("kid"), F.xxhash64("text").alias("th"), "text")
    meta = keyed.select("id", "kid", "th", F.length("text").cast("bigint").alias("n_chars"))
    meta = meta.groupBy("id", "kid", "th", "n_chars").agg(F.count("*").alias("times"))
    placed, total = positions(meta, ["id", "th"], scratch)
    following = placed.select(F.pmod(F.col("position") - 1, F.lit(max(1, total))).alias("position"), F.col("kid").alias("next_kid"), F.col("th").alias("next_th"))
    order = scratch.table(placed.join(following, "position"), "order")
    n_docs = order.agg(F.sum("times")).first()[0] or 0
    lex = scratch.table(lexicon(docs, n_docs), "lexicon")
    if lex.count() <= MAX_LEXICON:
        lex = F.broadcast(lex)

    texts = keyed.select("kid", "th", "text")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    # both joins read one exchange of the texts
    wanted = order.select(F.col("next_kid").alias("kid"), F.col("next_th").alias("th"), F.col("kid").alias("for_kid"), F.col("th").alias("for_th"), quarter.alias("q"))
    heads = texts.join(wanted, ["kid", "th"]).select(F.col("for_kid").alias("kid"), F.col("for_th").alias("th"), F.expr("substring(text, 1, q)").alias("head"))
    heads = heads.dropDuplicates(["kid", "th"])
    both = texts.join(order.select("kid", "th", "n_chars", quarter.alias("q")), ["kid", "th"]).join(heads, ["kid", "th"])
    both = both.select("kid", "th", "text", F.concat(F.expr("substring(text, 1, int(n_chars) - q)"), "head").alias("edited"))
    sides = both.select("kid", "th", F.explode(F.array(F.struct(F.lit(0).alias("side"), "text"), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))).alias("s"))
    sides = sides.select("kid", "th", "s.side", "s.text", F.when(F.col("s.side") == 1, F.sha2(F.col("s.text").cast("binary"), 256)).alias("sha"))
    prints = fingerprints(sides, lex, ["kid", "th", "side"], "sha")
    edited = F.col("side") == 1
    prints = prints.groupBy("kid", "th").agg(
        F.max(F.when(~edited, F.col("fingerprint"))).alias("fingerprint"), F.max(F.when(edited, F.col("fingerprint"))).alias("edited_fingerprint"), F.max("sha").alias("edited_sha256")
    )
    prints = scratch.table(prints, "prints")
    nexts = prints.select(F.col("kid").alias("next_kid"), F.col("th").alias("next_th"), F.col("fingerprint").alias("next"))
    out = order.join(prints, ["kid", "th"]).join(nexts, ["next_kid", "next_th"])
    out = out.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )
