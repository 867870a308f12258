"""Secret scans: known patterns, and sliding-window Shannon entropy.

Native: DataFrame and SQL functions only. A pattern's matches are wrapped in two
control characters, the text is split there, and running sums of the parts' lengths
give the spans (code points, end exclusive).

Entropy: candidates are runs of ``[A-Za-z0-9+/_=-]`` of at least ``WINDOW`` characters
that hold a digit. Over each window of ``WINDOW`` characters the entropy is
``log2 W - S / W`` with ``S`` the sum of ``n log2 n`` over the counts; a step adds the
entering character's change of ``S`` and takes off the leaving one's, both from counts
of that character alone. A window is hot at the threshold of its class: hexadecimal
(all of ``[0-9a-fA-F]``) or mixed. The span goes from the first hot window's start to
the last one's end; candidates on the allow list are suppressed. Long candidates are
cut into overlapping pieces, so a window never needs more than one.

Defined results: a null or empty text has no spans; ids may be null or repeat (every
row gives one row); the text's own U+0001 and U+0002 count as plain characters of no
class; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, pick

#: FIXED VALUES: the base patterns, in the order of their kinds, and the least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
KINDS = ["assign", "access", "hex", "entropy"]

WINDOW, PIECE = 20, 4096
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}+"
#: Bits a character from which a window is hot, by class; random text of the class has about 3.5 and 4.0.
MIN_HEX, MIN_MIXED = 3.1, 3.7
#: Candidates that look like secrets and aren't: placeholders, runs of one character, identifiers, dates and versions.
ALLOW = [
    r"(?i)example|sample|dummy|placeholder|changeme|test",
    r"(.)\1{5,}",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^[0-9=+/_-]+$",
    r"^[a-z]+([/_=-][a-z]*)*[0-9]{0,4}$",
]
_OPEN, _CLOSE, _OTHER = "\u0001", "\u0002", "\u0003"


def _parts(marked: Column, kind: int) -> Column:
    """Parts of a marked text: outside, match, outside, ...; strings only of matches."""
    each = F.transform(
        F.split(marked, f"[{_OPEN}{_CLOSE}]"),
        lambda p, i: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), F.length(p).alias("len"), F.when(i % 2 == 1, p).alias("s")),
    )
    return F.when(F.instr(marked, _OPEN) > 0, each).otherwise(F.array().cast("array<struct<kind:int,i:int,len:int,s:string>>"))


def _n_log_n(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(0.0)


def matches(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, id, kind, start, stop, s``: base spans (kinds 1 to 3), candidates (4), and a row of kind 0 for each text."""
    src = pick(df, id=id_col, text=text_col).withColumn("row", F.monotonically_increasing_id())
    plain = F.translate(F.coalesce("text", F.lit("")), _OPEN + _CLOSE, _OTHER * 2)
    src = src.select("row", "id", plain.alias("t"))
    low = F.lower("t")
    words = ["password", "passwd", "secret", "token", "apikey", "api_key"]
    keyed = low.contains(words[0])
    for w in words[1:]:
        keyed = keyed | low.contains(w)
    mark = lambda pattern: F.regexp_replace("t", pattern, f"{_OPEN}$0{_CLOSE}")
    marked = src.select(
        "row", "id",
        F.when(keyed, mark(ASSIGN)).otherwise("").alias("m1"),
        F.when(F.col("t").contains("AKIA"), mark(ACCESS)).otherwise("").alias("m2"),
        mark(HEX).alias("m3"),
        mark(CANDIDATE).alias("m4"),
    )
    own = F.array(F.struct(F.lit(0).alias("kind"), F.lit(1).alias("i"), F.lit(0).alias("len"), F.lit(None).cast("string").alias("s")))
    items = marked.select("row", "id", F.explode(F.concat(own, *[_parts(F.col(f"m{k}"), k) for k in (1, 2, 3, 4)])).alias("p")).select("row", "id", "p.*")
    stop = F.sum("len").over(Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    found = items.withColumn("stop", stop).where("i % 2 = 1").select("row", "id", "kind", (F.col("stop") - F.col("len")).alias("start"), "stop", "s")
    value = F.regexp_extract("s", "^(?:" + ASSIGN + ")$", 2)
    return found.where((F.col("kind") != 1) | (F.length(value) >= ASSIGN_LEAST))


def hot_spans(candidates: DataFrame, allow: list[str] = ALLOW) -> DataFrame:
    """``row, id, kind, start, stop`` of the candidates (row, id, start, s) with hot windows."""
    for pattern in allow:
        candidates = candidates.where(~F.col("s").rlike(pattern))
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("s") - WINDOW) / PIECE)).cast("int")),
        lambda k: F.struct(k.alias("k"), F.call_function("substring", F.col("s"), k * PIECE + 1, F.lit(PIECE + WINDOW - 1)).alias("own")),
    )
    cut = candidates.select("row", "id", "start", F.explode(pieces).alias("p")).select("row", "id", "start", "p.k", F.posexplode(F.split("p.own", "")).alias("at", "ch"))
    cut = cut.where("ch != ''")
    by = ["row", "start", "k"]
    same = Window.partitionBy(*by, "ch").orderBy("at")
    enters = F.count("*").over(same.rangeBetween(1 - WINDOW, -1))  # of this character, in the window it enters
    leaves = F.count("*").over(same.rangeBetween(0, WINDOW - 1))  # in the window it is the first of
    order = Window.partitionBy(*by).orderBy("at")
    steps = cut.select(
        "id", *by, "at", (~F.col("ch").rlike("[0-9a-fA-F]")).cast("int").alias("other"),
        (_n_log_n(enters + 1) - _n_log_n(enters)).alias("plus"), (_n_log_n(leaves) - _n_log_n(leaves - 1)).alias("minus"),
    )
    steps = steps.withColumn("gone", F.lag("minus", WINDOW, 0.0).over(order))
    s = F.sum(F.col("plus") - F.col("gone")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    entropy = F.log2(F.lit(float(WINDOW))) - s / WINDOW
    others = F.sum("other").over(order.rowsBetween(1 - WINDOW, 0))
    hot = steps.select("id", *by, "at", entropy.alias("h"), others.alias("others"))
    hot = hot.where((F.col("at") >= WINDOW - 1) & (F.round("h", 9) >= F.when(F.col("others") == 0, MIN_HEX).otherwise(MIN_MIXED)))
    end = F.col("start") + F.col("k") * PIECE + F.col("at") + 1
    spans = hot.groupBy("row", "start").agg(F.first("id").alias("id"), F.min(end - WINDOW).alias("first"), F.max(end).alias("stop"))
    return spans.select("row", "id", F.lit(4).alias("kind"), F.col("first").alias("start"), "stop")


def scan(df: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_assign, n_access, n_hex, base_sha256, spans`` of every row."""
    found = scratch.table(matches(df, id_col=id_col, text_col=text_col), "matches")
    spans = found.where("kind < 4").select("row", "id", "kind", "start", "stop").unionByName(hot_spans(found.where("kind = 4").select("row", "id", "start", "s")))
    entry = F.when(F.col("kind") > 0, F.struct("start", "kind", "stop"))
    n = lambda k: F.count(F.when(F.col("kind") == k, 1))
    rows = spans.groupBy("row").agg(F.max("id").alias("id"), n(1).alias("n_assign"), n(2).alias("n_access"), n(3).alias("n_hex"), F.sort_array(F.collect_list(entry)).alias("all"))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"]), x["start"], x["stop"])), ",")
    return rows.select(
        F.col("id").alias(id_col), "n_assign", "n_access", "n_hex",
        F.sha2(text(F.filter("all", lambda x: x["kind"] < 4)).cast("binary"), 256).alias("base_sha256"), text(F.col("all")).alias("spans"),
    )
