"""Queries on retrieval, and the flagship: hybrid search with context."""

from __future__ import annotations

from pyspark.sql import functions as F

from qirtas.functions.text import WORD, normalize_document_number
from qirtas.functions.vectors import cosine, hash_embedding, is_valid
from qirtas.operators import retrieval as R
from qirtas.operators.topics import extract_topics
from qirtas.plans import sqltext as sql
from qirtas.session import table
from qirtas.sources.documents import best_content

QUERY = "What are the duties of the licensed bank about the deposit guarantee and the annual income return?"
VECTOR = hash_embedding(QUERY, 64)
K = 50


def _chunks(spark, d):
    return table(spark, d, "chunks")


def q_vector_topk(spark, d):
    return R.vector_search(_chunks(spark, d), VECTOR, K)


def q_contains_search(spark, d):
    return R.contains_search(_chunks(spark, d), QUERY, K)


def q_bm25(spark, d):
    return R.bm25_search(_chunks(spark, d), QUERY, K).withColumn("score", F.round("score", 6))


def q_min_max(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", F.col("value").alias("score"))
    return R.min_max_by(e, "score", "event_type").select("event_id", F.round("score", 9).alias("score"))


def _candidates(spark, d):
    c = _chunks(spark, d)
    return R.merge_candidates(R.vector_search(c, VECTOR, K), R.keyword_search(c, QUERY, K), K)


def q_hybrid_search(spark, d):
    c = _candidates(spark, d)
    return c.select("chunk_id", F.round("vector_score", 6).alias("vector_score"), F.round("keyword_score", 6).alias("keyword_score"), F.round("combined_score", 6).alias("combined_score"), F.array_join("match_sources", ",").alias("match_sources"), F.col("position").cast("long").alias("position"))


def q_rerank_blend(spark, d):
    c = _candidates(spark, d)
    raw = F.length("chunk_id").cast("double") + F.col("keyword_score") * 3
    return R.rerank(c, raw, F.col("combined_score"), 10).select("chunk_id", F.round("combined_score", 6).alias("combined_score"))


def search(spark, d, n: int = 5):
    """The whole search: candidates of both sides, rerank, context, evidence, rank. The topics are those of the found documents."""
    best = R.rerank(_candidates(spark, d), F.col("keyword_score"), R.candidate_score(["combined_score"]), n)

    def topics_of(docs):
        one = docs.groupBy("id").agg(*[F.max(c).alias(c) for c in ("title", "contentEn", "contentAr")]).withColumn("content", best_content(("contentEn", "contentAr")))
        return extract_topics(one, "id", "title", "content").withColumnRenamed("id", "document_id")

    full = R.ranked(R.expand(best, _chunks(spark, d), table(spark, d, "legal_documents"), topics_of))
    number = normalize_document_number(F.col("number"))
    return full.withColumn("evidence", R.best_evidence(F.col("text"), QUERY)).withColumn("label", R.document_label(F.col("title"), number, F.col("date")))


def q_search(spark, d):
    return search(spark, d).select(F.col("rank").cast("long").alias("rank"), "chunk_id", "document_id", F.round("combined_score", 6).alias("combined_score"), "label", "evidence", F.array_join("topics", ",").alias("topics"), "context")


def q_answer(spark, d):
    return R.extractive_answer(search(spark, d))


def q_index_postings(spark, d):
    """The full-text index of all chunks, counted by term."""
    p = R.postings(_chunks(spark, d))
    return p.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").cast("long").alias("cf"))


def q_vector_similarity(spark, d):
    """Cosine of every valid topic to the first topic by name."""
    t = table(spark, d, "topics").where(is_valid(F.col("embedding"), 64)).groupBy("normalized_name").agg(F.max("embedding").alias("v"))
    first = t.orderBy("normalized_name").limit(1).select(F.col("v").alias("q"))
    return t.join(F.broadcast(first)).select("normalized_name", F.round(cosine(F.col("v"), F.col("q")), 6).alias("similarity"))


QUERIES = {name: f for name, f in globals().items() if name.startswith("q_")}

_TERMS = R.query_terms(QUERY)
_LIST = "[" + ", ".join(f"{x!r}::DOUBLE" for x in VECTOR) + "]"
_VALID = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"
_VECTOR = f"SELECT DISTINCT id AS chunk_id, round(list_cosine_similarity(list_transform(embedding, lambda x: coalesce(x, 0)), CASE WHEN len(embedding) = 64 THEN {_LIST} ELSE list_transform(embedding, lambda x: 1.0) END), 9) AS score FROM chunks WHERE {_VALID} ORDER BY score DESC, chunk_id LIMIT {K}"
_CONTAINS = "SELECT * FROM (SELECT DISTINCT id AS chunk_id, (" + " + ".join(f"contains(lower(text), '{t}')::INT" for t in _TERMS) + f")::DOUBLE AS score FROM chunks WHERE text IS NOT NULL) WHERE score > 0 ORDER BY score DESC, chunk_id LIMIT {K}"
_NORM = "CASE WHEN max(score) OVER () = min(score) OVER () THEN CASE WHEN max(score) OVER () > 0 THEN 1.0 ELSE 0.0 END ELSE (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) END"
_WORDS = f"SELECT id AS chunk_id, regexp_extract_all(lower(max(text)), '[{WORD}]+') AS t FROM chunks WHERE id IS NOT NULL AND text IS NOT NULL GROUP BY id"
_STOP = ", ".join(f"'{w}'" for w in R.STOPWORDS)
_FIRST = ", ".join(f"'{t}'" for t in dict.fromkeys(_TERMS[: R.MAX_TERMS]))
_BM25 = f"""
SELECT chunk_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))) AS score
FROM (SELECT chunk_id, dl, term, count(*) AS tf FROM (SELECT chunk_id, len(list_filter(t, lambda x: len(x) >= 3 AND x NOT IN ({_STOP}))) AS dl, unnest(t) AS term FROM ({_WORDS})) WHERE term IN ({_FIRST}) GROUP BY ALL) p
JOIN (SELECT term, count(*) AS df FROM (SELECT DISTINCT chunk_id, unnest(t) AS term FROM ({_WORDS})) GROUP BY term) f USING (term)
CROSS JOIN (SELECT count(*) AS n, avg(len(list_filter(t, lambda x: len(x) >= 3 AND x NOT IN ({_STOP})))) AS avgdl FROM ({_WORDS})) s
GROUP BY chunk_id ORDER BY score DESC, chunk_id LIMIT {K}""".replace("GROUP BY ALL", "GROUP BY chunk_id, dl, term")
_MERGED = f"""
SELECT *, row_number() OVER (ORDER BY round(combined_score, 9) DESC, rv NULLS LAST, rw NULLS LAST, chunk_id) AS position FROM (
  SELECT chunk_id, coalesce(v, 0.0) AS vector_score, coalesce(w, 0.0) AS keyword_score, coalesce(v, 0.0) * 0.65 + coalesce(w, 0.0) * 0.35 AS combined_score, rv, rw,
         concat_ws(',', CASE WHEN w IS NOT NULL THEN 'keyword' END, CASE WHEN v IS NOT NULL THEN 'vector' END) AS match_sources
  FROM (SELECT chunk_id, {_NORM} AS v, row_number() OVER (ORDER BY score DESC, chunk_id) AS rv FROM ({_VECTOR}))
  FULL JOIN (SELECT chunk_id, {_NORM} AS w, row_number() OVER (ORDER BY score DESC, chunk_id) AS rw FROM ({_BM25})) USING (chunk_id))
ORDER BY position LIMIT {K}"""
# Documents of the results: one row per id, topics by the same rules as q_extract_topics.
_RESULTS = f"""
WITH m AS (SELECT *, keyword_score AS score FROM ({_MERGED})),
b AS (SELECT chunk_id, position, 0.7 * {_NORM} + 0.3 * combined_score AS s FROM m),
r AS (SELECT *, row_number() OVER (ORDER BY round(s, 9) DESC, position, chunk_id) AS rank FROM b QUALIFY rank <= 5),
c AS (SELECT id AS chunk_id, max({{document_id: document_id, text: text, language: language, chunk_index: chunk_index}}) AS c FROM chunks WHERE id IN (SELECT chunk_id FROM r) GROUP BY id),
d AS (SELECT id AS document_id, max(title) AS title, max(number) AS number, max(document_type) AS document_type, max(date) AS date, max(issuer) AS issuer, max(source_url) AS source_url, max(language) AS language FROM legal_documents GROUP BY id),
t AS (SELECT document_id, string_agg(normalized_name, ',' ORDER BY normalized_name) AS topics FROM (SELECT DISTINCT document_id, normalized_name FROM ({{links}})) GROUP BY document_id),
e AS (SELECT chunk_id, unnest(list_filter(regexp_split_to_array(regexp_replace(c.text, '([.!?؟])\\s+', '\\1' || chr(1), 'g'), '[\\n\\x01]+'), lambda x: trim(x) <> '')) AS s, generate_subscripts(list_filter(regexp_split_to_array(regexp_replace(c.text, '([.!?؟])\\s+', '\\1' || chr(1), 'g'), '[\\n\\x01]+'), lambda x: trim(x) <> ''), 1) AS i FROM c),
v AS (SELECT chunk_id, arg_max({sql.squeeze('s')}, (len(list_intersect(list_distinct(regexp_extract_all(lower(s), '[{WORD}]{{3,}}')), [{', '.join(repr(t) for t in sorted(set(_TERMS)))}])), -i)) AS s FROM e GROUP BY chunk_id)
SELECT rank, r.chunk_id, c.document_id AS document_id, round(r.s, 6) AS combined_score, concat_ws(' | ', nullif(title, ''), 'No. ' || {sql.doc_number('number')}, nullif(date, '')) AS label,
  CASE WHEN len(v.s) > 500 THEN substring(v.s, 1, 500) || '...' ELSE v.s END AS evidence, coalesce(topics, '') AS topics,
  'Document title: ' || coalesce(nullif(title, ''), 'Unknown') || chr(10) || 'Document number: ' || coalesce(nullif(number, ''), 'N/A') || chr(10) || 'Document type: ' || coalesce(nullif(document_type, ''), 'N/A') || chr(10)
  || 'Date: ' || coalesce(nullif(date, ''), 'N/A') || chr(10) || 'Issuer: ' || coalesce(nullif(issuer, ''), 'N/A') || chr(10) || 'Source URL: ' || coalesce(nullif(source_url, ''), 'N/A') || chr(10)
  || 'Language: ' || coalesce(nullif(coalesce(c.language, d.language), ''), 'unknown') || chr(10) || 'Linked topics: ' || coalesce(replace(topics, ',', ', '), 'No linked topics') || chr(10) || chr(10) || 'Chunk text:' || chr(10) || coalesce(c.text, '') AS context
FROM r JOIN (SELECT chunk_id, c.document_id AS document_id, c.text AS text, c.language AS language FROM c) c USING (chunk_id) JOIN d ON d.document_id = c.document_id LEFT JOIN t ON t.document_id = c.document_id LEFT JOIN v ON v.chunk_id = r.chunk_id"""


def results_sql(links: str) -> str:
    """The SQL of ``q_search``, given that of the topic links."""
    return _RESULTS.replace("{links}", links)


def answer_sql(links: str) -> str:
    lines = "string_agg(rank || '. ' || label || ' appears relevant. Linked topics: ' || CASE WHEN topics = '' THEN 'no linked topics' ELSE array_to_string(string_split(topics, ',')[1:6], ', ') END || '. Evidence: ' || coalesce(evidence, ''), chr(10) ORDER BY rank)"
    return f"SELECT coalesce('{R.ANSWER_HEAD}' || chr(10) || {lines} || chr(10) || '{R.ANSWER_TAIL}', '{R.NO_CONTEXT}') AS answer FROM ({results_sql(links)})"


ORACLES = {
    "q_vector_topk": _VECTOR,
    "q_contains_search": _CONTAINS,
    "q_bm25": f"SELECT chunk_id, round(score, 6) AS score FROM ({_BM25})",
    "q_index_postings": f"SELECT term, count(DISTINCT chunk_id) AS df, count(*) AS cf FROM (SELECT chunk_id, unnest(t) AS term FROM ({_WORDS})) GROUP BY term",
    "q_min_max": "SELECT event_id, round(CASE WHEN hi = lo THEN CASE WHEN hi > 0 THEN 1.0 ELSE 0.0 END ELSE (value - lo) / (hi - lo) END, 9) AS score FROM (SELECT event_id, value, min(value) OVER w AS lo, max(value) OVER w AS hi FROM events WINDOW w AS (PARTITION BY event_type))",
    "q_hybrid_search": f"SELECT chunk_id, round(vector_score, 6) AS vector_score, round(keyword_score, 6) AS keyword_score, round(combined_score, 6) AS combined_score, match_sources, position FROM ({_MERGED})",
    "q_rerank_blend": f"""
SELECT chunk_id, round(b, 6) AS combined_score FROM (
  SELECT chunk_id, position, 0.7 * {_NORM} + 0.3 * combined_score AS b FROM (SELECT chunk_id, position, combined_score, len(chunk_id)::DOUBLE + keyword_score * 3 AS score FROM ({_MERGED})))
ORDER BY round(b, 9) DESC, position, chunk_id LIMIT 10""",
    "q_vector_similarity": f"""
WITH t AS (SELECT DISTINCT normalized_name, embedding AS v FROM topics WHERE {_VALID}),
q AS (SELECT v AS q FROM t ORDER BY normalized_name LIMIT 1)
SELECT normalized_name, round(list_cosine_similarity(v, q), 6) AS similarity FROM t CROSS JOIN q""",
}
