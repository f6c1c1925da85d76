"""Queries on scalar functions: text, numbers, URLs, identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qirtas.functions import identity, legal, text, urls
from qirtas.functions.vectors import hash_embeddings
from qirtas.operators.chunking import Limits, chunk_documents, section_rows, token_windows
from qirtas.operators.retrieval import document_label, keyword_terms, STOPWORDS
from qirtas.plans import sqltext as sql
from qirtas.session import table
from qirtas.sources import documents as sources


def _table(name):
    return lambda spark, sf_dir: table(spark, sf_dir, name)


legal_docs, corpus, topics, chunks, pages = map(_table, ("legal_documents", "documents", "topics", "chunks", "parsed_documents"))


def q_normalize_number(spark, d):
    n = F.col("number")
    return legal_docs(spark, d).select("id", text.normalize_digits(n).alias("digits"), text.normalize_whitespace(n).alias("spaced"), text.normalize_document_number(n).alias("number")).distinct()


def q_identity_component(spark, d):
    return legal_docs(spark, d).select("id", text.normalize_identity(F.col("document_type")).alias("kind"), text.normalize_identity(F.col("title_ar")).alias("title")).distinct()


def q_topic_name(spark, d):
    return topics(spark, d).select("normalized_name", text.normalize_topic_name(F.col("name")).alias("clean")).distinct()


def _ours(u: Column) -> Column:
    return urls.host(u).endswith(".example")


def q_canonical_url(spark, d):
    u = F.col("source_url")
    return legal_docs(spark, d).select("id", "source_url", urls.canonical_url(u).alias("canonical"), urls.host(u).alias("host"), urls.title_from_url(u).alias("slug")).distinct()


_CANONICAL = (
    "CASE WHEN {u} = '' THEN '' ELSE lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || '://' || {host} || "
    "CASE WHEN {path} = '/' OR regexp_matches({path}, '\\.[A-Za-z0-9]{{2,8}}$') THEN {path} ELSE regexp_replace({path}, '/+$', '') || '/' END || "
    "CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END END"
)


def _canonical_sql(u: str) -> str:
    host = f"lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
    path = f"coalesce(nullif(regexp_replace(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/{{2,}}', '/', 'g'), ''), '/')"
    query = f"array_to_string(list_filter(string_split(regexp_extract({u}, '\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_|fbclid|gclid)')), '&')"
    return _CANONICAL.format(u=u, host=host, path=path, query=query)


_HOST_SQL = "lower(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_PATH_SQL = "lower(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1))"


def q_url_class(spark, d):
    both = legal_docs(spark, d).select(F.explode(F.concat(F.array("source_url"), "pdf_urls")).alias("source_url")).distinct()
    u = F.col("source_url")
    pdf_host = urls.host(u).startswith("files.")
    return both.select("source_url", urls.is_document(u, _ours(u), pdf_host).alias("is_document"), urls.is_listing(u, _ours(u)).alias("is_listing"), urls.is_pdf(u, pdf_host).alias("is_pdf"))


_any = lambda parts, c: "(" + " OR ".join(f"contains({c}, '{p}')" for p in parts) + ")"
Q_URL_CLASS_SQL = f"""
WITH u AS (SELECT DISTINCT unnest(list_concat([source_url], pdf_urls)) AS source_url FROM legal_documents),
p AS (SELECT source_url, {_HOST_SQL} AS host, {_PATH_SQL} AS path FROM u),
c AS (SELECT *, ends_with(host, '.example') AS ours, starts_with(host, 'files.') AND (ends_with(path, '.pdf') OR contains(path, '/pdf/')) AS is_pdf,
      path IN ('', '/', '/p/') AS root, {_any(urls.LISTING_HINTS, 'path')} AS hinted FROM p)
SELECT source_url, is_pdf, ours AND (root OR hinted) AS is_listing,
       ours AND NOT is_pdf AND NOT root AND NOT hinted AND NOT ({' OR '.join(f"ends_with(path, '{e}')" for e in urls.STATIC_EXTENSIONS)}) AND NOT {_any(urls.SYSTEM_PARTS, 'path')} AS is_document
FROM c"""


def q_document_id(spark, d):
    u, t, k, n = map(F.col, ("source_url", "title", "document_type", "number"))
    return legal_docs(spark, d).select("id", "source_url", identity.document_id(u, t, k, n).alias("document_id"), identity.page_document_id(u, t, k, n).alias("page_id")).distinct()


def _short(x: str, n: int) -> str:
    return f"substring(sha1({x}), 1, {n})"


Q_DOCUMENT_ID_SQL = f"""
SELECT DISTINCT id, source_url,
  'doc-' || {_short("coalesce('legal-document:' || nullif(" + sql.identity('document_type') + ", '') || ':' || " + sql.doc_number('number') + ", 'legal-document:url:' || " + _canonical_sql('source_url') + ")", 16)} AS document_id,
  'doc-' || {_short("lower(coalesce(nullif(document_type, '') || ':' || nullif(number, ''), " + _canonical_sql('source_url') + " || ':' || coalesce(title, '')))", 16)} AS page_id
FROM legal_documents"""


def q_chunk_id(spark, d):
    c = chunks(spark, d).where(~text.is_blank(F.col("text")))
    return c.select("id", identity.chunk_id(*map(F.col, ("document_id", "language", "chunk_index", "text"))).alias("chunk_id")).distinct()


def q_token_count(spark, d):
    return corpus(spark, d).select("doc_id", text.token_count(F.col("text")).cast("long").alias("n_tokens"))


def q_keyword_terms(spark, d):
    terms = corpus(spark, d).where("text is not null").select("doc_id", keyword_terms(F.col("text")).alias("t"))
    return terms.select("doc_id", F.size("t").cast("long").alias("n_terms"), F.array_join(F.array_sort(F.array_distinct("t")), " ").alias("terms"))


def q_token_windows(spark, d):
    t = corpus(spark, d).where("text is not null").select("doc_id", token_windows(text.tokens(F.col("text")), 200, 50).alias("w"))
    return t.select("doc_id", F.posexplode("w").alias("no", "w")).select("doc_id", F.col("no").cast("long").alias("window_no"), F.size("w").cast("long").alias("n_tokens"), F.array_join("w", " ").alias("window"))


def q_language_ratio(spark, d):
    return corpus(spark, d).select("doc_id", legal.language_by_ratio(F.col("text")).alias("language"))


def q_relation_hint(spark, d):
    return table(spark, d, "cross_references").select("ref_id", legal.relation_hint(F.col("raw_text")).alias("hint"), legal.document_number(F.col("raw_text")).alias("number")).distinct()


def q_issuer(spark, d):
    return legal_docs(spark, d).select("id", "issuer", F.coalesce(legal.looks_like_issuer(F.col("issuer")), F.lit(False)).alias("is_issuer")).distinct()


def q_preview(spark, d):
    return corpus(spark, d).where("text is not null").select("doc_id", legal.preview(F.col("text")).alias("preview"))


def q_document_label(spark, d):
    return legal_docs(spark, d).select("id", document_label(F.col("title"), text.normalize_document_number(F.col("number")), F.col("date")).alias("label")).distinct()


def q_contents(spark, d):
    rows = sources.contents_by_language(legal_docs(spark, d))
    return rows.select("id", "language", F.length("text").cast("long").alias("n_chars")).distinct()


def q_validate(spark, d):
    checked = legal_docs(spark, d).select("id", "source_url", F.array_join(sources.document_errors(), ", ").alias("errors"))
    return checked.distinct()


def q_hash_embedding(spark, d):
    return hash_embeddings(corpus(spark, d), "doc_id", "text", 384).select("doc_id", F.col("slot").cast("long").alias("slot"), F.round("value", 6).alias("value"))


def q_chunk_documents(spark, d):
    c = sources.contents_by_language(legal_docs(spark, d)).groupBy("id", "language").agg(F.max("text").alias("text"))
    return chunk_documents(c.withColumnRenamed("id", "document_id"), Limits(100, 300, 40))


def q_sections(spark, d):
    """The sections that chunks are packed of, with their sizes."""
    c = sources.contents_by_language(legal_docs(spark, d)).groupBy("id", "language").agg(F.max("text").alias("text"))
    return section_rows(c.withColumnRenamed("id", "document_id")).select("document_id", "language", F.col("section_no").cast("long").alias("section_no"), "title", F.col("n_tokens").cast("long").alias("n_tokens"))


QUERIES = {name: f for name, f in globals().items() if name.startswith("q_")}
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
ORACLES = {
    "q_normalize_number": f"SELECT DISTINCT id, {sql.digits('number')} AS digits, {sql.whitespace('number')} AS spaced, {sql.doc_number('number')} AS number FROM legal_documents",
    "q_identity_component": f"SELECT DISTINCT id, {sql.identity('document_type')} AS kind, {sql.identity('title_ar')} AS title FROM legal_documents",
    "q_topic_name": f"SELECT DISTINCT normalized_name, {sql.topic_name('name')} AS clean FROM topics",
    "q_canonical_url": f"SELECT DISTINCT id, source_url, {_canonical_sql('source_url')} AS canonical, {_HOST_SQL} AS host, {sql.strip('regexp_replace(regexp_extract(regexp_replace(' + _PATH_SQL.replace('lower(', '(') + chr(44) + chr(39) + '/+$' + chr(39) + chr(44) + chr(39) * 2 + ')' + chr(44) + chr(39) + '([^/]*)$' + chr(39) + ', 1)' + chr(44) + chr(39) + '[-_]+' + chr(39) + chr(44) + chr(39) + ' ' + chr(39) + chr(44) + chr(39) + 'g' + chr(39) + ')')} AS slug FROM legal_documents",
    "q_url_class": Q_URL_CLASS_SQL,
    "q_document_id": Q_DOCUMENT_ID_SQL,
    "q_chunk_id": f"SELECT DISTINCT id, 'chunk-' || {_short('(' + repr('chunk:') + ' || document_id || ' + repr(':') + ' || language || ' + repr(':') + ' || chunk_index || ' + repr(':') + ' || ' + _short(sql.strip('text'), 20) + ')', 24)} AS chunk_id FROM chunks WHERE {sql.strip('text')} <> ''",
    "q_token_count": f"SELECT doc_id, {sql.token_count('text')}::BIGINT AS n_tokens FROM documents",
    "q_keyword_terms": f"""
SELECT doc_id, len(t)::BIGINT AS n_terms, array_to_string(list_sort(list_distinct(t)), ' ') AS terms
FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[{text.WORD}]{{3,}}'), lambda x: x NOT IN ({_STOP})) AS t FROM documents WHERE text IS NOT NULL)""",
    "q_token_windows": f"""
WITH t AS (SELECT doc_id, {sql.tokens('text')} AS t FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, t, unnest(range(0, greatest(0, ceil((len(t) - 200) / 150.0))::BIGINT + 1)) AS i FROM t WHERE len(t) > 0)
SELECT doc_id, i AS window_no, len(t[i * 150 + 1 : i * 150 + 200])::BIGINT AS n_tokens, array_to_string(t[i * 150 + 1 : i * 150 + 200], ' ') AS "window" FROM w""",
    "q_language_ratio": r"SELECT doc_id, CASE WHEN coalesce(len(regexp_extract_all(text, '[\x{600}-\x{6FF}]')) >= len(regexp_extract_all(text, '[A-Za-z]')), TRUE) THEN 'ar' ELSE 'en' END AS language FROM documents",
    "q_relation_hint": f"""
SELECT DISTINCT ref_id, CASE WHEN regexp_matches(raw_text, '{legal.AMEND_PATTERN}') THEN 'AMENDS' WHEN regexp_matches(raw_text, '{legal.REPEAL_PATTERN}') THEN 'REPEALS' ELSE 'REFERENCES' END AS hint,
  nullif(regexp_extract({sql.digits('raw_text')}, '(?i){legal.NUMBER}', 1), '') || '/' || regexp_extract({sql.digits('raw_text')}, '(?i){legal.NUMBER}', 2) AS number FROM cross_references""",
    "q_issuer": f"SELECT DISTINCT id, issuer, coalesce(len({sql.whitespace('issuer')}) BETWEEN 3 AND 180 AND ({' OR '.join(f'contains(lower(issuer), {m.lower()!r})' for m in legal.ISSUER_MARKERS)}), FALSE) AS is_issuer FROM legal_documents",
    "q_preview": f"SELECT doc_id, CASE WHEN len(t) > 420 THEN substring(t, 1, 420) || '...' ELSE t END AS preview FROM (SELECT doc_id, {sql.squeeze('text')} AS t FROM documents WHERE text IS NOT NULL)",
    "q_document_label": f"SELECT DISTINCT id, concat_ws(' | ', nullif(title, ''), 'No. ' || {sql.doc_number('number')}, nullif(date, '')) AS label FROM legal_documents",
    "q_contents": f"SELECT DISTINCT id, language, len(text)::BIGINT AS n_chars FROM (SELECT id, 'ar' AS language, contentAr AS text FROM legal_documents UNION ALL SELECT id, 'en', contentEn FROM legal_documents UNION ALL SELECT id, 'fr', contentFr FROM legal_documents) WHERE {sql.strip('text')} <> ''",
    "q_validate": f"""
SELECT DISTINCT id, source_url, concat_ws(', ', CASE WHEN coalesce({sql.strip('title')}, '') = '' THEN 'title is empty' END,
  CASE WHEN NOT coalesce(regexp_matches({sql.strip('source_url')}, '^(?i:https?)://[^/?#]+'), FALSE) THEN 'source_url is not an absolute http(s) URL' END,
  CASE WHEN coalesce(language NOT IN ('ar', 'en', 'fr', 'unknown'), TRUE) THEN 'language is unknown' END) AS errors FROM legal_documents""",
    "q_sections": f"""
WITH t AS (SELECT id, language, max(text) AS text FROM (SELECT id, 'ar' AS language, contentAr AS text FROM legal_documents UNION ALL SELECT id, 'en', contentEn FROM legal_documents UNION ALL SELECT id, 'fr', contentFr FROM legal_documents) WHERE {sql.strip('text')} <> '' GROUP BY id, language),
l AS (SELECT id, language, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM (SELECT id, language, regexp_split_to_array(text, '[\\n\\r\\f\\v\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]') AS ls FROM t)),
h AS (SELECT *, regexp_matches(l, '^\\s*#{{1,6}}\\s+\\S') AS head FROM l),
s AS (SELECT *, sum(head::INT) OVER (PARTITION BY id, language ORDER BY i) AS section FROM h),
g AS (SELECT id, language, section, max(CASE WHEN head THEN {sql.strip("regexp_replace(l, '^[[:space:]]*#+', '')")} END) AS title, sum({sql.token_count('l')})::BIGINT AS n_tokens FROM s GROUP BY id, language, section)
SELECT id AS document_id, language, row_number() OVER (PARTITION BY id, language ORDER BY section) - 1 AS section_no, title, n_tokens FROM g WHERE n_tokens > 0""",
    "q_hash_embedding": f"""
WITH w AS (SELECT doc_id, unnest(CASE WHEN len(ws) > 0 THEN ws ELSE [coalesce(nullif(t, ''), 'empty')] END) AS w
           FROM (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(lower(coalesce(text, '')), '[{text.WORD}]+') AS ws FROM documents)),
h AS (SELECT doc_id, sha256(w) AS x FROM w),
s AS (SELECT doc_id, ('0x' || substring(x, 1, 8))::BIGINT % 384 AS slot, sum(CASE WHEN ('0x' || substring(x, 9, 2))::BIGINT % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS v FROM h GROUP BY 1, 2)
SELECT doc_id, slot, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS value FROM s WHERE v <> 0""",
}
