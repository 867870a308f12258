"""Fuzzy line deduplication over the whole corpus.

Native: DataFrame and SQL functions only.

1. Lines are normalised (lower case, ASCII punctuation and spaces become single spaces);
   lines of fewer than ``MIN_CHARS`` characters are left alone, except for
   ``MIN_LETTERS`` letters of a script that is written without spaces (Han, kana, Thai,
   Lao, Burmese, Khmer).
2. Each gets a 64-bit SimHash of its words of at least ``WORD`` characters (of all words
   if it has no such), from sums of packed counters, eight a number; short words are the
   same in all lines of a language and would draw their hashes together. Lines in scripts
   without spaces get one of their runs of three characters.
3. Equal normalised lines become one node.
4. The SimHash is cut into six blocks. Two hashes that differ in at most ``SURE`` = 4 bits
   agree on two blocks at least, so all 15 choices of two blocks are indexed. Hashes that
   share an entry and differ in at most ``RADIUS`` = 11 bits are candidates: all of those up to
   four bits, most up to seven. Within an entry a node is paired with the ``NEAR`` nodes before it,
   which is all pairs of an entry of up to ``NEAR`` + 1 nodes. First every node's nearest
   candidate is verified. Of the other candidates only those between different components of these
   links are, the nearest of every two components before the rest; of larger entries all pairs of different components, none inside a
   component, so a large group of near copies isn't squared.
5. Candidates are verified: edit similarity of 0.8 or more. What two lines
   begin and end with alike is cut off first (where lines of as many words differ in few
   words only, the lengths of those are bound enough); the rest is compared in pieces of ``PIECE``
   characters, whose summed distances bound the edit distance from above, and where that is
   too much, whole, in bands of growing width.
6. Of every connected group the first line by (id, line number) stays.

Small tables (by a row count that is checked) are broadcast, which spares a shuffle of
the texts; larger ones are joined by a shuffle.

Defined results: a null text has no lines and stays null; an empty text has one empty
line; ids may be null or repeat: rows are told apart by id and text, and rows that repeat
both are one document (its lines stay in each of them); further columns are ignored (or
kept, by ``drop_lines``).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, once, pick, positional, small
from .components import components

MIN_CHARS, MIN_LETTERS, LIKENESS = 10, 5, 0.8
#: Least characters of the words that are hashed; bits in which candidates may differ; nodes of an entry that a node is compared with at first.
WORD, RADIUS, NEAR = 4, 11, 3
#: Letters of scripts without spaces between words.
UNSPACED = r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\x{20000}-\x{3ffff}]"
#: First bit and width of the blocks. More blocks give more entries a node, each with more bits.
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
#: Blocks of an entry, and so the bits up to which no pair is missed.
SHARED = 2
SURE = len(BLOCKS) - SHARED
#: Words whose bits are counted in bytes (the highest byte of a signed number holds 127).
PART_WORDS = 127
#: Characters that are compared at once; edits that are looked for first.
PIECE, NARROW = 4096, 48
_LANES = 0x0101010101010101


def normal(line: Column) -> Column:
    """Lower case; runs of ASCII characters that are neither letters nor digits become a space."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x00-/:-@\[-`{-\x7f]+", " "))


def unspaced(least: int) -> Column:
    """Whether ``norm`` holds so many letters of scripts without spaces (of three bytes at least)."""
    return (F.octet_length("norm") >= F.length("norm") + 2 * least) & F.col("norm").rlike(f"(?:{UNSPACED}[^\\n]*?){{{least}}}")


def features(norm: str) -> Column:
    """What a line's SimHash is made of: words, without short ones if there are others, or runs of three characters."""
    words = F.split(norm, " ")
    words = F.when(F.col(norm).rlike(f"[^ ]{{{WORD}}}"), F.filter(words, lambda w: F.length(w) >= WORD)).otherwise(words)
    return F.when(unspaced(1), F.regexp_extract_all(norm, F.lit("(?s)(?=(.{3}))"), 1)).otherwise(words)


def lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, th, no, norm, k1, k2`` of every line that is long enough."""
    docs = pick(df, id=id_col, text=text_col)
    flat = docs.select("id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    flat = once(flat.select("id", "th", "no", normal(F.col("line")).alias("norm")))
    flat = flat.where((F.length("norm") >= MIN_CHARS) | unspaced(MIN_LETTERS))
    return flat.select("*", F.xxhash64("norm").alias("k1"), F.xxhash64("norm", F.lit(1)).alias("k2"))


def hashed_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, th, no, k1, k2, sim, chars``: SimHash and length of every line.

    Words are counted in parts of at most 127, so eight counters of a byte fit a
    number; the parts of longer lines are added up counter by counter. Rows that repeat id
    and text are counted together; where that is more than 127 words in a part, the sim is
    null and ``crowded_sims`` has it.
    """
    keys = ["id", "th", "no", "k1", "k2"]
    split = once(lines(df, id_col, text_col).select(*keys, F.length("norm").alias("chars"), features("norm").alias("w")))
    words = split.select(*keys, "chars", F.size("w").alias("n"), F.posexplode("w").alias("at", "w"))
    words = words.select(*keys, "chars", "n", F.floor(F.col("at") / PART_WORDS).cast("int").alias("part"), F.xxhash64("w").alias("h"))
    sums = [F.try_sum(F.shiftrightunsigned("h", k).bitwiseAND(_LANES)).alias(f"s{k}") for k in range(8)]
    # n isn't a key, so both uses of the parts read one exchange
    parts = words.groupBy(*keys, "part").agg(F.max("n").alias("n"), F.max("chars").alias("chars"), F.count("*").alias("m"), *sums)
    lane = lambda b: F.shiftrightunsigned(f"s{b % 8}", b - b % 8).bitwiseAND(255)
    bits = lambda count: sum_bits([F.when(count(b) * 2 > F.col("n"), F.lit(_signed(1 << b)).cast("bigint")) for b in range(64)])
    fits = F.col("m") <= PART_WORDS
    short = parts.where(F.col("n") <= PART_WORDS).select(*keys, F.when(fits, packed_majority("m")).alias("sim"), "chars")
    added = parts.where(F.col("n") > PART_WORDS).groupBy(*keys).agg(F.max("n").alias("n"), F.max("chars").alias("chars"), F.max("m").alias("m"), *[F.sum(F.when(fits, lane(b))).alias(f"b{b}") for b in range(64)])
    return short.unionByName(added.select(*keys, F.when(fits, bits(lambda b: F.col(f"b{b}"))).alias("sim"), "chars"))


def crowded_sims(df: DataFrame, every: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``k1, k2, own``: the sims that are null in ``every``, from one text a line."""
    keys = every.where("sim is null").select("k1", "k2").distinct()
    texts = lines(df, id_col, text_col).select("k1", "k2", "norm").join(keys, ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("norm").alias("norm"))
    hashes = once(texts.select("k1", "k2", F.transform(features("norm"), lambda w: F.xxhash64(w)).alias("h")))
    return hashes.select("k1", "k2", simhash(F.col("h")).alias("own"))


def simhash(hashes: Column) -> Column:
    """Bits that more than half of the hashes have; number k counts bits k and k + 32 in halves."""
    zero = F.struct(*[F.lit(0).cast("bigint").alias(f"s{k}") for k in range(32)])
    add = lambda x, h: F.struct(*[(x[f"s{k}"] + F.shiftrightunsigned(h, k).bitwiseAND(0x100000001)).alias(f"s{k}") for k in range(32)])
    count = lambda x, b: F.shiftrightunsigned(x[f"s{b % 32}"], b - b % 32).bitwiseAND(0xFFFFFFFF)
    bit = lambda x, b: F.when(count(x, b) * 2 > F.size(hashes), F.lit(_signed(1 << b)).cast("bigint"))
    return F.aggregate(hashes, zero, add, lambda x: sum_bits([bit(x, b) for b in range(64)]))


def packed_majority(n: str) -> Column:
    """Bits whose counter, one of eight a number, is above half of column n: adding 128 less the
    least such count sets a counter's highest bit. Halves are added apart, so none overflows."""
    lift = (F.lit(127) - F.floor(F.col(n) / 2)) * F.lit(0x01010101)
    out = F.lit(0).cast("bigint")
    for k in range(8):
        low, high = F.col(f"s{k}").bitwiseAND(0xFFFFFFFF) + lift, F.shiftrightunsigned(f"s{k}", 32) + lift
        set_low, set_high = (F.shiftright(x.bitwiseAND(0x80808080), 7) for x in (low, high))
        out = out.bitwiseOR(F.shiftleft(set_low.bitwiseOR(F.shiftleft(set_high, 32)), k))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def sum_bits(flags: list[Column]) -> Column:
    out = F.lit(0).cast("bigint")
    for flag in flags:
        out = out.bitwiseOR(F.coalesce(flag, F.lit(0).cast("bigint")))
    return out


CHOICES = list(combinations(range(len(BLOCKS)), SHARED))


def entries(nodes: DataFrame) -> DataFrame:
    """``t, node, sim``, dealt by their ``key``: every node once for each choice t of blocks."""
    key = F.col("t").cast("bigint")
    for k in range(SHARED):
        at, mask = (F.array(*[F.lit(x) for x in xs]) for xs in ([BLOCKS[own[k]][0] for own in CHOICES], [(1 << BLOCKS[own[k]][1]) - 1 for own in CHOICES]))
        bits = F.call_function("shiftright", F.col("sim"), F.get(at, F.col("t"))).bitwiseAND(F.get(mask, F.col("t")))
        key = F.shiftleft(key, max(width for _, width in BLOCKS)).bitwiseOR(bits)
    every = nodes.select("node", "sim", F.explode(F.array(*[F.lit(t) for t in range(len(CHOICES))])).alias("t"))
    return every.repartition(key).select(key.alias("key"), "t", "node", "sim")


def near(t: Column, a: Column, b: Column) -> Column:
    """Whether two hashes are within the radius and t is the first entry they share.

    Which blocks are equal is looked up in a table of first entries: few instructions, so the JVM compiles them.
    """
    x = a.bitwiseXOR(b)
    equal = F.lit(0)
    for n, (at, width) in enumerate(BLOCKS):
        equal = equal + F.when(x.bitwiseAND(_signed(((1 << width) - 1) << at)) == 0, 1 << n).otherwise(0)
    first = [next((t for t, own in enumerate(CHOICES) if all(e >> k & 1 for k in own)), -1) for e in range(1 << len(BLOCKS))]
    return (F.bit_count(x) <= RADIUS) & (F.get(F.array(*[F.lit(t) for t in first]), equal) == t)


def block_pairs(nodes: DataFrame) -> DataFrame:
    """``key, crowded, a, b, bits``: pairs ``a > b`` of ``nodes`` (node, sim) that are candidates, each once, and the
    bits in which they differ; where an entry has more than NEAR + 1 nodes, one row with ``crowded`` set and no pair."""
    order = Window.partitionBy("key").orderBy("sim", "node")
    before = [F.lag(F.struct("sim", "node"), k + 1).over(order).alias(f"before{k}") for k in range(NEAR)]
    rows = entries(nodes).select("key", "t", "node", "sim", F.row_number().over(order).alias("place"), *before).where("place > 1")
    other = [F.struct(F.lit(False).alias("crowded"), F.col(f"before{k}.sim").alias("sim"), F.col(f"before{k}.node").alias("node")) for k in range(NEAR)]
    none = F.lit(None).cast("bigint")
    other.append(F.struct((F.col("place") == NEAR + 2).alias("crowded"), none.alias("sim"), none.alias("node")))
    rows = rows.select("key", "t", "node", "sim", F.explode(F.array(*other)).alias("o")).where(F.col("o.crowded") | near(F.col("t"), F.col("sim"), F.col("o.sim")))
    ends = [F.when(~F.col("o.crowded"), f("node", "o.node")) for f in (F.greatest, F.least)]
    return rows.select("key", "o.crowded", ends[0].alias("a"), ends[1].alias("b"), F.bit_count(F.col("sim").bitwiseXOR(F.col("o.sim"))).alias("bits"))


def crowded_pairs(nodes: DataFrame, keys: DataFrame, groups: DataFrame, scratch: Scratch) -> DataFrame:
    """``a, b``: candidates of the entries ``keys`` whose nodes are in different components (``groups``)."""
    index = entries(nodes).join(small(keys), "key", "leftsemi").join(groups, "node", "left")
    index = scratch.table(index.withColumn("component", F.coalesce("component", "node")), "crowded")
    mixed = index.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least != most")
    index = index.join(mixed.select("key"), "key", "leftsemi")
    left, right = (index.select("key", *[F.col(c).alias(f"{c}_{end}") for c in ("t", "node", "sim", "component")]) for end in "ab")
    apart = (F.col("node_a") > F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
    pairs = left.join(right.drop("t_b"), "key").where(apart & near(F.col("t_a"), F.col("sim_a"), F.col("sim_b")))
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def verified(df: DataFrame, nodes: DataFrame, pairs: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    """The ``pairs`` (a, b) whose lines are similar. Only the documents that a node's line occurs in first are read for it."""
    for end in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(end), F.col("chars").alias("chars_" + end)), end)
    alike = F.abs(F.col("chars_a") - F.col("chars_b")) <= F.floor((1 - LIKENESS) * F.greatest("chars_a", "chars_b") + 1e-9)
    pairs = scratch.table(pairs.where(alike).select("a", "b"), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = nodes.join(ends, "node").groupBy("first.id", "first.th").agg(F.collect_list(F.struct("first.no", "node")).alias("wanted"))
    wanted = scratch.table(wanted.select(F.col("id").alias("own"), F.col("th").alias("own_th"), "wanted"), "wanted")
    docs = pick(df, id=id_col, text=text_col).withColumn("th", F.xxhash64("text"))
    texts = docs.join(small(wanted), F.col("id").eqNullSafe(F.col("own")) & (F.col("th") == F.col("own_th")))
    texts = once(texts.select(F.split("text", "\n").alias("line"), "wanted")).select("line", F.explode("wanted").alias("w"))
    texts = texts.select("w.node", normal(F.get("line", F.col("w.no"))).alias("norm"))
    texts = scratch.table(texts.groupBy("node").agg(F.first("norm").alias("norm")), "texts")
    left, right = (texts.select(F.col("node").alias(end), F.col("norm").alias("n" + end)) for end in "ab")
    return scratch.table(similar(pairs.join(left, "a").join(right, "b")), "links")


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix of two texts, by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(24, -1, -1)])
    longer = lambda n, step: F.call_function("startswith", a, F.call_function("substring", b, F.lit(1), n + step)) & (n + step <= F.length(b))
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(longer(n, step), n + step).otherwise(n))


def similar(pairs: DataFrame) -> DataFrame:
    """``a, b`` of the ``pairs`` (a, b and the texts na, nb) whose edit similarity is LIKENESS or more.

    What both texts begin and end with doesn't change their distance and is cut off
    first; the rest is compared in pieces, and where these are too far apart, whole.
    """
    longest = F.greatest(F.length("na"), F.length("nb"))
    changed = F.zip_with(F.split("na", " "), F.split("nb", " "), lambda x, y: F.when(x == y, 0).otherwise(F.greatest(F.length(x), F.length(y))))
    changed = F.aggregate(changed, F.lit(0), lambda x, d: x + d)  # null where one line has more words
    most = F.floor((1 - LIKENESS) * longest + 1e-9).cast("int")
    p = pairs.withColumn("most", most).where(F.abs(F.length("na") - F.length("nb")) <= F.col("most"))
    p = once(p.select("a", "b", "na", "nb", "most", F.coalesce(changed <= F.col("most"), F.lit(False)).alias("sure")))
    p = p.select("a", "b", *[F.when(F.col("sure"), "").otherwise(F.col(c)).alias(c) for c in ("na", "nb")], "most")
    cut = lambda c: F.reverse(F.call_function("substring", F.col(c), F.col("pre") + 1, F.length(c)))
    for _ in range(2):  # the common beginning, then the common end
        p = once(p.select("a", "b", "na", "nb", "most", common_prefix(F.col("na"), F.col("nb")).alias("pre")))
        p = once(p.select("a", "b", cut("na").alias("na"), cut("nb").alias("nb"), "most"))
    last = F.greatest(F.lit(0), F.floor((F.greatest(F.length("na"), F.length("nb")) - 1) / PIECE)).cast("int")
    part = lambda c, i: F.call_function("substring", F.col(c), i * PIECE + 1, F.lit(PIECE))
    # -1: a piece is further apart than the whole may be. A narrow band comes first: it takes far less time, and most pairs end in it
    within = lambda i, k: F.call_function("levenshtein", part("na", i), part("nb", i), k)
    band = lambda i, k: F.nullif(within(i, F.least(F.lit(k), F.col("most"))), F.lit(-1))
    steps = F.transform(F.sequence(F.lit(0), last), lambda i: F.coalesce(band(i, NARROW // 3), band(i, NARROW), within(i, F.col("most"))))
    p = once(p.select("a", "b", "na", "nb", "most", steps.alias("steps")))
    summed = ~F.exists("steps", lambda d: d < 0) & (F.aggregate("steps", F.lit(0), lambda x, d: x + d) <= F.col("most"))
    # several pieces only bound the distance from above; bands of growing width over the whole: a distance within a band is exact
    whole = lambda k: F.call_function("levenshtein", F.col("na"), F.col("nb"), F.least(F.lit(k), F.col("most")))
    distance = F.coalesce(*[F.nullif(whole(NARROW << 6 * step), F.lit(-1)) for step in range(5)])
    return p.where(summed | ((F.size("steps") > 1) & F.coalesce(distance <= F.col("most"), F.lit(False)))).select("a", "b")


def find(df: DataFrame, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, th, removed``: the numbers of the lines to remove, from 0, ascending, of the documents that lose any."""
    every = scratch.table(hashed_lines(df, id_col, text_col), "lines")
    if not every.where("sim is null").isEmpty():
        filled = every.join(crowded_sims(df, every, id_col, text_col), ["k1", "k2"], "left")
        every = scratch.table(filled.select("id", "th", "no", "k1", "k2", F.coalesce("sim", "own").alias("sim"), "chars"), "filled")
    # equal lines: one node, named by its first occurrence
    nodes = every.groupBy("k1", "k2").agg(F.min(F.struct("id", "th", "no")).alias("first"), F.min("sim").alias("sim"), F.min("chars").alias("chars"), F.count("*").alias("times"))
    nodes = scratch.table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = scratch.table(block_pairs(nodes.select("node", "sim")), "candidates")
    pairs = found.where("not crowded")
    nearest = pairs.groupBy("a").agg(F.min_by("b", F.struct("bits", "b")).alias("b"))
    nearest = tried = scratch.table(nearest.select("a", "b"), "nearest")
    groups = scratch.table(components(verified(df, nodes, nearest, scratch, id_col, text_col), scratch), "groups")
    crowded = found.where("crowded").select("key")
    # the rest, between different components only: first the nearest candidate of two components, then all that remain
    for last in (False, True):
        rest = pairs.select("a", "b", "bits")
        for end in "ab":
            rest = rest.join(groups.select(F.col("node").alias(end), F.col("component").alias("c" + end)), end, "left").withColumn("c" + end, F.coalesce("c" + end, end))
        rest = rest.where("ca != cb").join(tried, ["a", "b"], "leftanti")
        if not last:
            rest = rest.groupBy(F.least("ca", "cb").alias("one"), F.greatest("ca", "cb").alias("other")).agg(F.min_by(F.struct("a", "b"), F.struct("bits", "a", "b")).alias("p"))
            rest = scratch.table(rest.select("p.a", "p.b"), "between")
            tried = tried.unionByName(rest)
        elif not crowded.isEmpty():
            rest = rest.select("a", "b").unionByName(crowded_pairs(nodes.select("node", "sim"), crowded, groups, scratch))
        more = verified(df, nodes, rest.select("a", "b"), scratch, id_col, text_col)
        if not more.isEmpty():
            hung = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
            groups = scratch.table(components(hung.unionByName(more), scratch), "groups")
    # what stays of a group: its first occurrence; groups of one line that occurs once need no row
    named = nodes.join(groups, "node", "left").where("times > 1 or component is not null").withColumn("component", F.coalesce("component", "node"))
    named = scratch.table(named.select("k1", "k2", "component", "first"), "named")
    stays = scratch.table(named.groupBy("component").agg(F.min("first").alias("stays")), "stays")
    classes = scratch.table(named.select("k1", "k2", "component").join(stays, "component").select("k1", "k2", "stays"), "classes")
    gone = every.join(classes, ["k1", "k2"]).where(~F.struct("id", "th", "no").eqNullSafe(F.col("stays")))
    return scratch.table(gone.groupBy("id", "th").agg(F.sort_array(F.collect_set("no")).alias("removed")), "removed")


def report(df: DataFrame, removed: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_lines, removed`` of every row (an empty list where all lines stay)."""
    docs = pick(df, id=id_col, text=text_col).select("id", F.xxhash64("text").alias("th"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    docs = docs.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    gone = small(removed).withColumnsRenamed({"id": "own", "th": "own_th"})
    out = docs.join(gone, F.col("id").eqNullSafe(F.col("own")) & (F.col("th") == F.col("own_th")), "left")
    return out.select(F.col("id").alias(id_col), "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def drop_lines(df: DataFrame, removed: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, without the removed lines; rows that lose all their words go."""
    flat, names = positional(df)
    key, text = (F.col(f"_c{names.index(c)}") for c in (id_col, text_col))
    # a flag a line, so that a lookup takes the same time on any line
    runs = F.transform("removed", lambda x, i: F.concat(F.repeat(F.lit("0"), x - F.when(i > 0, F.get("removed", i - 1)).otherwise(-1) - 1), F.lit("1")))
    gone = small(removed.select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.split(F.array_join(runs, ""), "").alias("_flags")))
    joined = flat.withColumn("_h", F.xxhash64(text)).join(gone, key.eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_th")), "left")
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda line, i: F.coalesce(F.get("_flags", i), F.lit("0")) != "1"), "\n")
    joined = joined.withColumn("_kept", F.when(F.col("_flags").isNull(), text).otherwise(kept))
    joined = joined.where(F.col("_flags").isNull() | F.col("_kept").rlike(r"[\p{L}\p{N}]"))
    return joined.select(*[F.col("_kept").alias(c) if c == text_col and i == names.index(text_col) else F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
