"""Queries on what is written: rows, upserts, scans, embeddings, counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from qirtas import providers
from qirtas.operators import ingest as I
from qirtas.operators import retrieval as R
from qirtas.plans import graph as PG
from qirtas.plans import retrieval as PR
from qirtas.plans import sqltext as sql
from qirtas.session import table


def q_scan_documents(spark, d):
    """The documents without a confident topic, as later steps read them."""
    few = PG._links(spark, d).where("confidence > 0.7")
    rows = I.scan_documents(table(spark, d, "legal_documents"), None, few)
    return rows.select("id", "title", "date", "document_type", "number", "issuer", "language", *[F.length(c).alias(f"n_{c[-2:].lower()}") for c in ("contentAr", "contentEn", "contentFr")])


def q_topics_without_embedding(spark, d):
    return I.topics_without_embedding(table(spark, d, "topics"))


def q_topics_with_embedding(spark, d):
    rows = I.topics_with_embedding(table(spark, d, "topics"))
    return rows.select("normalized_name", "name", F.size("embedding").cast("long").alias("n"))


def _topics(spark, d):
    return table(spark, d, "topics").groupBy("normalized_name").agg(*[F.max(c).alias(c) for c in ("name", "confidence", "source", "created_at")])


def q_upsert_topics(spark, d):
    """Topics of before 2020 in the table; later ones, and all that a second run knows without a source, merged in."""
    rows = _topics(spark, d)
    again = rows.select("normalized_name", F.upper("name").alias("name"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("source"), F.lit("2030").alias("created_at"))
    return I.upsert_topics(rows.where("confidence >= 0.5"), rows.where("confidence < 0.5").unionByName(again), "created_at")


def q_upsert_chunks(spark, d):
    """Chunks of the first half of each document in the table, all of known documents written over them without vectors."""
    columns = ["id", "document_id", "language", "chunk_index", "token_count", "created_at"]
    rows = table(spark, d, "chunks").where("id is not null").groupBy("id").agg(*[F.max(c).alias(c) for c in columns if c != "id"], F.max(F.size("embedding")).alias("n"))
    rows = rows.select(*columns, F.col("n").alias("embedding"))
    again = rows.withColumns({"token_count": F.lit(None).cast("int"), "embedding": F.lit(None).cast("int"), "created_at": F.lit("2030")})
    docs = table(spark, d, "legal_documents").select("id")
    return I.upsert_chunks(rows.where("chunk_index < 2"), again, docs, "chunk_index")


def q_topic_embeddings(spark, d):
    """Missing vectors set to hashing ones of the name."""
    topics = table(spark, d, "topics").groupBy("normalized_name").agg(F.max("name").alias("name"), F.max("embedding").alias("embedding"))
    texts = topics.where("embedding is null").select("normalized_name", "name")
    vectors, _ = providers.embed_texts(texts, "name", providers.hashing_embedder(64))
    done = I.set_topic_embeddings(topics, vectors)
    return done.select("normalized_name", F.size("embedding").cast("long").alias("n"), F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("n_used"))


def q_cache_put(spark, d):
    """The cache rows of all chunk texts that no chunk with a vector has."""
    c = table(spark, d, "chunks").where("text is not null")
    model = providers.hashing_embedder(64)
    known = c.where("embedding is not null").select(providers.cache_key(F.col("text"), model.provider, model.model, 64).alias("cache_key"), F.col("embedding").alias("vector"))
    _, put = providers.embed_texts(c.select("id", "text").distinct(), "text", model, known)
    return put.select("cache_key", "provider", "dimensions", F.size("vector").alias("n"))


def q_document_rows(spark, d):
    rows = table(spark, d, "legal_documents").select("id", "title", "number", "pdf_urls", "created_at")
    return I.document_rows(rows).distinct()


def q_ingest(spark, d):
    """Edges that link once all documents are there, and how many documents each has failed on."""
    docs = table(spark, d, "legal_documents").select(*[c for c in I.DOCUMENT_COLUMNS if c != "title_fr"])
    old = docs.where("created_at < '2017'").groupBy("id").agg(*[F.max(c).alias(c) for c in docs.columns if c != "id"])
    out = I.ingest(old, docs.where("created_at >= '2017'"), table(spark, d, "cross_references"), "created_at")
    known = I.counters(documents=out["documents"], edges=out["edges"], quarantine=out["quarantine"].select("id").distinct())
    return known


def q_edge_counts(spark, d):
    return I.edge_counts(PG.q_document_edges(spark, d))


def q_fallback_sort(spark, d):
    """The ten best candidates without a scorer."""
    c = R.score_pairs(PR._candidates(spark, d), PR.QUERY, None)
    return R.ranked(R.rerank(c, F.col("raw_score"), R.candidate_score(c.columns), 10)).select(F.col("rank").cast("long").alias("rank"), "chunk_id", F.round("combined_score", 6).alias("combined_score"))


QUERIES = {name: f for name, f in globals().items() if name.startswith("q_")}

_T = "(SELECT normalized_name, max(name) AS name, max(confidence) AS confidence, max(source) AS source, max(created_at) AS created_at FROM topics GROUP BY 1)"
_C = "(SELECT id, max(document_id) AS document_id, max(language) AS language, max(chunk_index) AS chunk_index, max(token_count) AS token_count, max(created_at) AS created_at, max(len(embedding)) AS embedding FROM chunks WHERE id IS NOT NULL GROUP BY id)"
_WORDS = f"regexp_extract_all(lower(coalesce(name, '')), '[{PR.WORD}]+')"
_D = "(SELECT id, max(title) AS title, max(source_url) AS source_url, max(language) AS language FROM legal_documents GROUP BY id)"
ORACLES = {
    "q_scan_documents": f"""
SELECT id, max(title) AS title, max(date) AS date, max(document_type) AS document_type, max(number) AS number, max(issuer) AS issuer, max(language) AS language,
  len(max(contentAr))::INT AS n_ar, len(max(contentEn))::INT AS n_en, len(max(contentFr))::INT AS n_fr FROM legal_documents WHERE id NOT IN (SELECT document_id FROM ({PG._LINKS}) WHERE confidence > 0.7) GROUP BY id""",
    "q_topics_without_embedding": "SELECT normalized_name, max(name) AS name FROM topics WHERE embedding IS NULL GROUP BY 1",
    "q_topics_with_embedding": "SELECT normalized_name, max(name) AS name, len(max(embedding)) AS n FROM topics WHERE len(embedding) > 0 GROUP BY 1",
    "q_upsert_topics": f"""
SELECT normalized_name, upper(name) AS name, confidence, source, CASE WHEN confidence >= 0.5 THEN created_at ELSE '2030' END AS created_at FROM {_T}""",
    "q_upsert_chunks": f"""
SELECT c.id, document_id, c.language, chunk_index, CASE WHEN d.id IS NULL THEN token_count END AS token_count, CASE WHEN chunk_index < 2 THEN embedding END AS embedding,
  CASE WHEN chunk_index < 2 THEN created_at ELSE '2030' END AS created_at FROM {_C} c LEFT JOIN {_D} d ON d.id = c.document_id WHERE chunk_index < 2 OR d.id IS NOT NULL""",
    "q_topic_embeddings": f"""
WITH t AS (SELECT normalized_name, max(name) AS name, max(embedding) AS v FROM topics GROUP BY 1),
w AS (SELECT normalized_name, unnest(CASE WHEN len({_WORDS}) > 0 THEN {_WORDS} ELSE [coalesce(nullif(name, ''), 'empty')] END) AS w FROM t WHERE v IS NULL),
s AS (SELECT normalized_name, ('0x' || substring(sha256(w), 1, 8))::BIGINT % 64 AS slot, sum(CASE WHEN ('0x' || substring(sha256(w), 9, 2))::BIGINT % 2 = 0 THEN 1 ELSE -1 END) AS x FROM w GROUP BY 1, 2)
SELECT normalized_name, CASE WHEN v IS NULL THEN 64 ELSE len(v) END AS n, CASE WHEN v IS NULL THEN (SELECT count(*) FROM s WHERE s.normalized_name = t.normalized_name AND x <> 0) ELSE len(list_filter(v, lambda x: x <> 0)) END AS n_used FROM t""",
    "q_cache_put": """
SELECT DISTINCT 'hashing:hash-64:64:' || sha256(text) AS cache_key, 'hashing' AS provider, 64 AS dimensions, 64 AS n FROM chunks
WHERE text IS NOT NULL AND text NOT IN (SELECT text FROM chunks WHERE embedding IS NOT NULL AND text IS NOT NULL)""",
    "q_document_rows": f"SELECT DISTINCT id, title, created_at, {sql.doc_number('number')} AS number, CASE WHEN pdf_urls IS NULL OR len(pdf_urls) = 0 THEN '[]' ELSE '[' || array_to_string(list_transform(pdf_urls, lambda x: '\"' || x || '\"'), ',') || ']' END AS pdf_urls_json FROM legal_documents",
    "q_edge_counts": f"SELECT relation, count(*) AS n_edges, count(DISTINCT source) AS n_sources, count(DISTINCT target) AS n_targets FROM ({PG.ORACLES['q_document_edges']}) GROUP BY relation",
    "q_fallback_sort": f"SELECT row_number() OVER (ORDER BY round(combined_score, 9) DESC, position, chunk_id) AS rank, chunk_id, round(combined_score, 6) AS combined_score FROM ({PR._MERGED}) QUALIFY rank <= 10",
}
