"""The registered queries of this subpackage, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from veilspark.llm import credentials, merkle
from veilspark.llm.common import importable, table
from veilspark.llm.fingerprint import fingerprint_documents
from veilspark.llm.knn import top_k
from veilspark.llm.graph_search import search
from veilspark.llm.hard_negatives import mine
from veilspark.llm.language import identify
from veilspark.llm.main_text import extract
from veilspark.llm.packing import pack_documents
from veilspark.llm.pieces import decode_documents, encode_documents
from veilspark.llm.simhash import near_duplicates
from veilspark.llm.token_files import read_token_files, write_token_files
from veilspark.llm.url_lists import evaluate
from veilspark.sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return run


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), capacity=2048, end_id=1)
    return packed.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, end_id=2)
    return read_token_files(spark, path, with_ids=False)


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op2_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), every=20, k=20, factor=64, all_rows=True)


SQL["op2_knn"] = """
WITH v AS (
    SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = credentials.scan(table(spark, sf_dir, "documents"))
    joined = lambda some: F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["stop"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*credentials.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    sha = F.sha2(joined(base).cast("binary"), 256).alias("base_sha256")
    return spans.select("doc_id", *map(count, credentials.BASE), sha, joined(F.col("spans")).alias("spans"))


@query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def captures(pages: DataFrame) -> DataFrame:
    """Every page as a capture, fetched on a day and hour that its page_id gives."""
    hours = F.col("page_id") * 7919 % (365 * 24)
    fetched = F.timestamp_seconds(F.lit(1704067200) + hours * 3600)
    return pages.select(F.col("page_id").alias("capture_id"), "url", fetched.alias("fetched"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """Lists of the pages' own hosts, domains and first path parts, added and removed on days that their names give."""
    name = F.regexp_extract(F.lower("url"), r"^[a-z]+://([^/?#:@]+)", 1)
    part = F.regexp_extract("url", r"^[A-Za-z]+://[^/?#]+/([^/?#]+)", 1)
    seen = pages.where("url is not null").select(name.alias("host"), part.alias("part")).where("host <> ''").distinct()
    kinds = [
        ("blocked_hosts", "host", F.col("host"), "block", 3),
        ("blocked_domains", "domain", F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1), "block", 2),
        ("allowed_paths", "prefix", F.when(F.col("part") != "", F.concat("host", F.lit("/"), "part")), "allow", 4),
    ]
    entries = None
    for number, (list_, scope, pattern, verdict, one_in) in enumerate(kinds):
        own = seen.select(pattern.alias("pattern")).where("pattern <> ''").distinct()
        value = F.conv(F.substring(F.md5(F.concat(F.lit(str(number)), "pattern").cast("binary")), 1, 8), 16, 10).cast("long")
        own = own.withColumn("value", value).where(F.col("value") % one_in == 0)
        dated = F.explode(F.array(*[F.struct(F.lit(a).alias("action"), F.lit(d).alias("after")) for a, d in HISTORY]))
        own = own.withColumn("change", dated)
        days = F.col("value") % 200 + F.col("change.after")
        own = own.select(
            F.lit(list_).alias("list"),
            F.lit(scope).alias("scope"),
            "pattern",
            F.lit(verdict).alias("verdict"),
            F.col("change.action").alias("action"),
            F.timestamp_seconds(F.lit(1704067200) + days * 86400).alias("effective"),
        )
        entries = own if entries is None else entries.unionByName(own)
    return entries


#: When an entry changes, in days after its first.
HISTORY = (("add", 0), ("remove", 45), ("add", 90), ("remove", 150))


@query
def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return evaluate(captures(pages), dated_entries(pages))


SQL["op7_url_lists"] = r"""
WITH c AS (
    SELECT page_id AS capture_id, url, TIMESTAMP '2024-01-01' + to_hours(CAST(page_id * 7919 % (365 * 24) AS INTEGER)) AS fetched,
        regexp_extract(lower(url), '^[a-z]+://([^/?#:@]+)', 1) AS host,
        regexp_extract(url, '^[A-Za-z]+://[^/?#]+/([^/?#]+)', 1) AS part
    FROM pages
), names AS (
    SELECT DISTINCT 0 AS number, 'blocked_hosts' AS list, 'host' AS scope, host AS pattern, 'block' AS verdict, 3 AS one_in FROM c WHERE host <> ''
    UNION SELECT DISTINCT 1, 'blocked_domains', 'domain', regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1), 'block', 2 FROM c
    UNION SELECT DISTINCT 2, 'allowed_paths', 'prefix', host || '/' || part, 'allow', 4 FROM c WHERE host <> '' AND part <> ''
), valued AS (
    SELECT *, CAST('0x' || substr(md5(number || pattern), 1, 8) AS BIGINT) AS value FROM names WHERE pattern <> ''
), active AS (
    SELECT list, scope, pattern, verdict,
        TIMESTAMP '2024-01-01' + to_days(CAST(value % 200 + a AS INTEGER)) AS since,
        TIMESTAMP '2024-01-01' + to_days(CAST(value % 200 + b AS INTEGER)) AS until
    FROM valued, (VALUES (0, 45), (90, 150)) AS spans(a, b) WHERE value % one_in = 0
), met AS (
    SELECT c.capture_id, c.url, c.fetched, a.*,
        CASE a.scope WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END AS rank
    FROM c LEFT JOIN active a ON c.fetched >= a.since AND c.fetched < a.until AND (
        (a.scope = 'host' AND a.pattern = c.host)
        OR (a.scope = 'domain' AND (a.pattern = c.host OR c.host LIKE '%.' || a.pattern))
        OR (a.scope = 'prefix' AND a.pattern = c.host || '/' || c.part))
), ranked AS (
    SELECT *, count(list) OVER (PARTITION BY capture_id) AS active, row_number() OVER (
        PARTITION BY capture_id ORDER BY rank DESC, length(pattern) DESC, verdict = 'allow' DESC, list) AS place
    FROM met
)
SELECT capture_id, url, fetched, active, verdict, scope, pattern, list FROM ranked WHERE place = 1
"""


@query
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    encoded = encode_documents(docs)
    decoded = decode_documents(encoded)
    return decoded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


@query
def op11_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved), every=100, positives=5, negatives=10, factor=256)


SQL["op12_hard_negatives"] = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), a AS (
    SELECT *, row_number() OVER () AS key FROM v WHERE vec_id % 100 = 0
), s AS MATERIALIZED (
    SELECT a.key, a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_dot_product(a.v, v.v) AS BIGINT) AS score
    FROM a JOIN v ON a.label <> v.label OR a.vec_id <> v.vec_id
), p AS (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, vec_id) AS place FROM s WHERE same
), n AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.key, p.place ORDER BY s.score DESC, s.vec_id) AS place
    FROM p JOIN s ON p.place <= 5 AND s.key = p.key AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 10
"""


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    more = (docs["n_chars"].cast("decimal(20)") + 1).cast("string")
    tampered = F.when(hit, more).otherwise(docs["n_chars"].cast("string"))
    rows = merkle.proofs(merkle.build(docs, claimed=merkle.leaf(docs, n_chars=tampered)))
    rows = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest("path").alias("proof_sha256"), merkle.folded("claimed", "path").alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(n_chars: str) -> str:
    parts = [f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")]
    return f"sha256({' || '.join(parts)})"


_PAIRS = "[sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')) for i in range((len(nodes) + 1) // 2)]"
_SIBLING = """CASE WHEN (pos >> level) % 2 = 1 THEN 'L' || nodes[pos >> level]
        WHEN (pos >> level) + 2 <= len(nodes) THEN 'R' || nodes[(pos >> level) + 2] ELSE '-' END"""

SQL["op13_manifest"] = f"""
WITH RECURSIVE d AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(
            [[ord(substr(doc_id::VARCHAR, i + 1, 1))::UBIGINT, 0, 0, 0, 0, 0, 0, 0] for i in range(strlen(doc_id::VARCHAR))])),
        lambda c, b: CASE WHEN xor(c, b) % 2 = 1 THEN xor(xor(c, b) >> 1, 3988292384::UBIGINT) ELSE xor(c, b) >> 1 END
    ), 4294967295::UBIGINT) AS crc FROM documents
), l AS (
    SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
        {_leaf_sql("n_chars::HUGEINT + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END")} AS claimed FROM d
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos FROM l
), up(lang, level, nodes) AS (
    SELECT lang, 0, list(leaf ORDER BY pos) FROM placed GROUP BY lang
    UNION ALL SELECT lang, level + 1, {_PAIRS} FROM up WHERE len(nodes) > 1
), subroots AS (
    SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM up WHERE len(nodes) = 1
), top(level, nodes) AS (
    SELECT 0, list(subroot ORDER BY pos) FROM subroots
    UNION ALL SELECT level + 1, {_PAIRS} FROM top WHERE len(nodes) > 1
), own AS (
    SELECT p.lang, pos, list({_SIBLING} ORDER BY level) AS path
    FROM placed p JOIN up ON p.lang IS NOT DISTINCT FROM up.lang AND len(nodes) > 1 GROUP BY p.lang, pos
), above AS (
    SELECT lang, list({_SIBLING} ORDER BY level) AS path FROM subroots, top WHERE len(nodes) > 1 GROUP BY lang
), p AS (
    SELECT doc_id, leaf, claimed, subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
        coalesce(own.path, []) || coalesce(above.path, []) AS path
    FROM placed JOIN subroots s ON placed.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN own ON placed.lang IS NOT DISTINCT FROM own.lang AND placed.pos = own.pos
    LEFT JOIN above ON placed.lang IS NOT DISTINCT FROM above.lang
), f AS (
    SELECT *, list_reduce(list_prepend(claimed, path), lambda node, e: CASE e[1]
        WHEN 'L' THEN sha256(e[2:] || node) WHEN 'R' THEN sha256(node || e[2:]) ELSE sha256(node) END) AS folded_root FROM p
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([e[2:] for e in path], '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM f
"""
