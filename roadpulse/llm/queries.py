"""The dealt queries ``opN_<name>``: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document by heap-and-linked-list merging."""
    import public_tokenizers

    from .token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    from .best_fit import pack_documents
    from .common import Scratch

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), Scratch(spark, "op8"), capacity=4096, end_id=1)


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document, learned from four fifths of the labelled ones."""
    from pyspark.sql import functions as F

    from . import zstd_lang

    docs = table(spark, sf_dir, "documents")
    model = zstd_lang.learn(docs, zstd_lang.learned_from(F.col("key")))
    found = zstd_lang.predict(docs, model, keep={"doc_id": "doc_id"})
    return found.select("doc_id", zstd_lang.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", zstd_lang.rejected(F.col("lang_pred"), F.col("score")).alias("rejected"))


#: FIXED VALUES: the rules of op1 (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the longest fitting rule for every page; pages that none fits are allowed."""
    from .url_filter import build, judge

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), build(rules), default="allow")


ORACLE["op1_url_filter"] = """
with cut as (
    select page_id, case when strpos(url, '://') > 0
        then split_part(split_part(substr(url, strpos(url, '://') + 3), '#', 1), '?', 1) else '' end as rest
    from pages
), parts as (
    select page_id, translate(split_part(coalesce(rest, ''), '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        substr(coalesce(rest, ''), length(split_part(coalesce(rest, ''), '/', 1)) + 1) as path
    from cut
), rules(h, p, v) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
select page_id, host, path,
    (select h || p from rules where (host = h or ends_with(host, '.' || h)) and starts_with(path, p) order by length(h || p) desc limit 1) as rule,
    coalesce((select v from rules where (host = h or ends_with(host, '.' || h)) and starts_with(path, p) order by length(h || p) desc limit 1), 'allow') as verdict
from parts
"""


@query
def op7_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record in ZIP archives, read back by byte ranges."""
    from .common import Scratch
    from .zip_warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"), Scratch(spark, "op7"))


ORACLE["op7_zip_warc"] = """
with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
g as (select payload_digest, max(page_id) as first from p where payload_bytes >= 1000 group by payload_digest having count(*) > 1)
select page_id, payload_bytes, p.payload_digest,
    case when first is not null and page_id is distinct from first then 'revisit' else 'response' end as record_type,
    case when first is not null and page_id is distinct from first then first end as refers_to
from p left join g on p.payload_digest = g.payload_digest and payload_bytes >= 1000
"""


@query
def op5_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 4-word shingles, Jaccard of 0.8 or more."""
    from .common import Scratch
    from .minhash_forest import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op5"), words=4, percent=80)


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole document: base patterns, and hot entropy windows."""
    from .common import Scratch
    from .secret_scan import scan

    return scan(table(spark, sf_dir, "documents"), Scratch(spark, "op10"))


@query
def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every whole document and of its edited text."""
    from .common import Scratch
    from .imatch import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents"), Scratch(spark, "op6"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents, with their places and likeness."""
    from .decontaminate import find

    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that repeat or nearly repeat an earlier one."""
    from .common import Scratch
    from .line_dedup import find, report

    docs = table(spark, sf_dir, "documents")
    return report(docs, find(docs, Scratch(spark, "op3")))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents in each of their 120 orders, by language."""
    from .common import Scratch
    from .filter_audit import audit_documents

    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Scratch(spark, "op11"))


ORACLE["op11_filter_audit"] = r"""
with t as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
        coalesce(doc_id > min(doc_id) over (partition by coalesce(text, '')), false) as e
    from documents
), w as (
    select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from t
), told as (
    select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id
), flags as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        (len(words) < 100)::int
        + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::int
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::int
        + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * e::int as fails
    from w left join told using (doc_id)
), sums as (
    select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from flags group by part, fails
), letters(f, b) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
    select v.f || w.f || x.f || y.f || z.f as filter_order
    from letters v, letters w, letters x, letters y, letters z
    where v.b + w.b + x.b + y.b + z.b = 31 and v.b | w.b | x.b | y.b | z.b = 31
), steps as (
    select filter_order, s::int as step, substr(filter_order, s::int, 1) as f,
        (select coalesce(sum(b), 0)::int from letters where strpos(substr(filter_order, 1, s::int - 1), letters.f) > 0) as before
    from orders, range(1, 6) r(s)
), sets as (select distinct f, before from steps),
found as (
    select s.part, t.f, t.before, b,
        sum(case when fails & (before | b) = 0 then n else 0 end) as kept,
        sum(case when fails & b > 0 and fails & before = 0 then n else 0 end) as removed,
        sum(case when fails & b > 0 and fails & before > 0 then n else 0 end) as redundant,
        sum(case when fails = b then n else 0 end) as unique_fails,
        sum(case when fails & b > 0 and fails & before = 0 then good else 0 end) as good_lost,
        sum(case when fails & b > 0 and fails & before = 0 then toxic else 0 end) as toxic_lost
    from sums s, sets t join letters using (f) group by s.part, t.f, t.before, b
)
select part, filter_order, step, f as "filter", kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
    unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
    (sum(removed) over (partition by part, f))::bigint as shapley
from steps join found using (f, before)
"""


@query
def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded by a byte-level BPE vocabulary and decoded again."""
    import public_tokenizers

    from .bpe_codec import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_ptolemy_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 16 clusters after three rounds, in whole numbers."""
    from .common import Scratch
    from .ptolemy import cluster

    return cluster(table(spark, sf_dir, "embeddings"), Scratch(spark, "op13"), dims=64, scale=64, k=16, rounds=3, seed=1)


def _clusters_sql(rounds: int) -> str:
    ctes = [
        """kept as materialized (
    select row_number() over () as rid, vec_id, [floor(64 * x::double)::bigint for x in embedding] as v
    from embeddings where len(embedding) = 64 and len([x for x in embedding if x is not null and isfinite(x)]) = 64
)""",
        """c0 as materialized (
    select row_number() over (order by sha256('1:' || vec_id), v) - 1 as c, v from kept
    qualify row_number() over (order by sha256('1:' || vec_id), v) <= 16
)""",
    ]
    for n in range(rounds + 1):
        ctes.append(f"""a{n} as materialized (
    select rid, vec_id, kept.v, c, list_sum([(kept.v[i] - c{n}.v[i]) * (kept.v[i] - c{n}.v[i]) for i in range(1, 65)])::bigint as d
    from kept, c{n} qualify row_number() over (partition by rid order by d, c) = 1
)""")
        if n < rounds:
            ctes.append(f"""c{n + 1} as materialized (
    with m as (
        select c, i, sum(x)::bigint as s, count(*) as n from (select c, unnest(v) as x, unnest(range(64)) as i from a{n}) group by c, i
    ), moved as (select c, list((s - ((s % n) + n) % n) // n order by i) as v from m group by c)
    select c, coalesce(moved.v, c{n}.v) as v from c{n} left join moved using (c)
)""")
    return f"""with {", ".join(ctes)}
select vec_id, c::int as cluster, d as distance, (sum(d) over (partition by c))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
    sha256(array_to_string(c{rounds}.v, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (c)"""


ORACLE["op13_ptolemy_clusters"] = _clusters_sql(3)
