"""The registered queries of the training-data operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchlake.llm import (
    chat,
    cosine,
    jaccard,
    mixing,
    neighbours,
    packing,
    ranking,
    secrets,
    sitetree,
    tokencounts,
    tokenfiles,
    toxicity,
    whitening,
)
from dispatchlake.session import configure, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
MIX_TARGETS = {"src0": 0.2, "src1": 0.1}  # the largest source of the given tables held down; the others divide the rest


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(configure(spark), sf_dir)
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_secret_scan(spark, sf):
    scanned = secrets.scan_secrets(table(spark, sf, "documents"))
    return scanned.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", secrets.span_text().alias("spans"), "n_live", "n_copied"
    )


@query
def op4_token_files(spark, sf):
    path = scratch(spark, "token-files")
    tokenfiles.write_tokens(table(spark, sf, "documents"), path)
    return tokenfiles.read_digests(spark, path)


@query
def op3_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"))


@query
def op1_collision_neighbours(spark, sf):
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op10_cosine_near_duplicates(spark, sf):
    return cosine.near_duplicates(table(spark, sf, "embeddings"))


@query
def op2_shingle_jaccard(spark, sf):
    return jaccard.similar_documents(table(spark, sf, "documents"))


@query
def op8_toxicity(spark, sf):
    return toxicity.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op5_pfair_mix(spark, sf):
    return mixing.mix(table(spark, sf, "documents"), MIX_TARGETS).drop("row_hash")


@query
def op6_token_counts(spark, sf):
    return tokencounts.token_counts(table(spark, sf, "documents"))


@query
def op7_chat_format(spark, sf):
    return chat.format_chat(table(spark, sf, "conversations"))


@query
def op11_embedding_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


@query
def op12_ranked_search(spark, sf):
    return ranking.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op13_main_text(spark, sf):
    return sitetree.main_text(table(spark, sf, "pages"))


# Smallest id reachable by links (x, y): labels travel along links until none gets smaller.
_COMPONENTS = """both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(d, r) AS (SELECT {id}, {id} FROM {table} UNION
  SELECT b.y, reach.r FROM reach JOIN both_ways b ON b.x = reach.d WHERE reach.r < b.y),
least AS (SELECT d, MIN(r) AS component_id FROM reach GROUP BY d)"""

SQL["op2_shingle_jaccard"] = f"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(string_split_regex(translate(COALESCE(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS o FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id
    GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * o >= 80 * (p.n + q.n - o)),
{_COMPONENTS.format(id="doc_id", table="documents")}
SELECT doc_id, n AS n_shingles, component_id FROM sizes JOIN least ON d = doc_id"""

SQL["op10_cosine_near_duplicates"] = f"""
WITH RECURSIVE usable AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id < b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
{_COMPONENTS.format(id="vec_id", table="embeddings")},
counts AS (SELECT x, COUNT(*) AS n FROM both_ways GROUP BY x)
SELECT vec_id, COALESCE(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON d = vec_id LEFT JOIN counts ON x = vec_id"""

SQL["op12_ranked_search"] = r"""
WITH parts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(COALESCE(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
asked AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(COALESCE(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
totals AS (SELECT CAST(COUNT(*) AS BIGINT) AS n_docs, CAST(SUM(len(t)) AS BIGINT) AS n_terms FROM parts WHERE len(t) > 0),
postings AS (SELECT r, doc_id, n, term, CAST(COUNT(*) AS BIGINT) AS tf FROM
    (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM parts) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
    FROM postings, totals GROUP BY term, n_docs),
wanted AS (SELECT q, item_id, term, CAST(COUNT(*) AS BIGINT) AS times FROM
    (SELECT q, item_id, unnest(t) AS term FROM asked) GROUP BY ALL),
scores AS (SELECT q, item_id, r, doc_id, CAST(SUM(times * w *
    ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term), totals WHERE doc_id IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""
