"""Queries on topics, links, merges and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from qirtas.functions import legal
from qirtas.functions.text import normalize_kind
from qirtas.operators import graph as G
from qirtas.operators import topics as T
from qirtas.operators.html import parse_pages
from qirtas.plans import retrieval
from qirtas.plans import sqltext as sql
from qirtas.plans.retrieval import _VALID
from qirtas.session import table
from qirtas.sources.documents import best_content, contents_by_language

THRESHOLD = 0.88


def _docs(spark, d):
    """One row per document: repeats agree in title and contents; topics are read in English, else in Arabic."""
    columns = ("title", "contentEn", "contentAr", "number", "document_type", "date")
    one = table(spark, d, "legal_documents").groupBy("id").agg(*[F.max(c).alias(c) for c in columns])
    return one.withColumn("content", best_content(("contentEn", "contentAr")))


def _topics(docs):
    return T.extract_topics(docs, "id", "title", "content").select(F.col("id").alias("document_id"), "normalized_name", "confidence")


def _links(spark, d):
    return _topics(_docs(spark, d))


def q_topic_rules(spark, d):
    found = _docs(spark, d).select("id", F.explode(T.rule_topics(F.col("title"), F.col("content"))).alias("t"))
    return found.select("id", F.col("t.name").alias("topic"), F.col("t.confidence").alias("confidence"), (F.length("t.evidence") > 0).alias("has_evidence"))


def q_title_words(spark, d):
    return _docs(spark, d).select("id", F.array_join(T.title_words(F.col("title")), " ").alias("words"))


def q_extract_topics(spark, d):
    return _links(spark, d)


def q_topic_json(spark, d):
    """A model's answers, built from the topics table: plain, fenced and broken ones."""
    t = table(spark, d, "topics").select("normalized_name", "name", "confidence").distinct()
    item = F.to_json(F.struct("name", "confidence"))
    form = F.pmod(F.length("normalized_name"), F.lit(3))
    raw = F.when(form == 0, F.concat(F.lit('{"topics":['), item, F.lit("]}"))).when(form == 1, F.concat(F.lit("answer:\n```json\n["), item, F.lit("]\n```"))).otherwise(F.concat(F.lit("no json "), "name"))
    parsed = t.select("normalized_name", T.parse_topic_json(raw).alias("p"))
    return parsed.select("normalized_name", F.explode("p").alias("p")).select("normalized_name", F.col("p.normalized_name").alias("parsed"), F.round("p.confidence", 6).alias("confidence"))


def q_cross_references(spark, d):
    """The references of all contents of a document, whatever their language."""
    texts = contents_by_language(table(spark, d, "legal_documents")).select("id", "text").distinct()
    return G.cross_references(texts, "id", "text")


def _instruments(spark, d):
    columns = ("id", "number", "document_type")
    return table(spark, d, "legal_documents").select(*columns).unionByName(table(spark, d, "core_instruments").select(*columns))


def q_document_edges(spark, d):
    return G.link_references(table(spark, d, "cross_references"), _instruments(spark, d))


def q_documents_without_topics(spark, d):
    few = _links(spark, d).where("confidence > 0.7")
    return G.documents_without_topics(_docs(spark, d), few).select("id", "date")


def q_link_topics(spark, d):
    """Links of two runs, of which the second has read the titles only; withdrawn documents are no longer known."""
    docs = _docs(spark, d)
    again = _topics(docs.withColumn("content", F.lit(None).cast("string")))
    runs = _topics(docs).withColumn("run", F.lit(1)).unionByName(again.withColumn("run", F.lit(2)))
    known = docs.join(table(spark, d, "withdrawn_documents").select(normalize_kind(F.col("document_id")).alias("id")), "id", "left_anti")
    return G.link_topics(runs, known, "run").select("document_id", "normalized_name", "confidence")


def q_upsert_documents(spark, d):
    """Crawls of before 2017 are in the table, later ones are merged in."""
    rows = table(spark, d, "legal_documents").select("id", "issuer", "date", "source_url", "created_at")
    rows = rows.groupBy("id", "created_at").agg(*[F.max(c).alias(c) for c in ("issuer", "date", "source_url")])
    old = G.latest_per_key(rows.where("created_at < '2017'"), "id", "created_at")
    return G.upsert(old, rows.where("created_at >= '2017'"), "id", "created_at")


def q_merge_payloads(spark, d):
    m = G.merge_payloads(table(spark, d, "legal_documents").dropDuplicates(["id", "created_at", "source_url", "issuer"]))
    return m.select("id", "title", "number", F.array_join("pdf_urls", " ").alias("pdf_urls"), F.array_join(F.array_sort(F.map_keys("language_urls")), " ").alias("languages"))


def q_frontier(spark, d):
    p = table(spark, d, "parsed_documents")
    urls = p.select(F.col("source_url").alias("url"), "page_id")
    return G.frontier_step(urls.where("page_id % 3 = 0"), urls.where("page_id % 3 = 1"), urls.where("page_id % 3 = 2"))


def q_cache_split(spark, d):
    c = table(spark, d, "chunks").select("id", "text").where("text is not null").distinct()
    cache = table(spark, d, "chunks").where(F.col("embedding").isNotNull()).where("text is not null").select(F.concat(F.lit("local:hash:64:"), F.sha2("text", 256)).alias("cache_key")).distinct()
    _, missing = G.cache_split(c, cache, "text", "local", "hash", 64)
    return missing.select("id", "cache_key")


def _pairs(spark, d):
    return T.topic_pairs(table(spark, d, "topics"), THRESHOLD)


def q_topic_pairs(spark, d):
    return _pairs(spark, d).withColumn("similarity", F.round("similarity", 6))


def q_topic_groups(spark, d):
    return T.groups_of(_pairs(spark, d)).select("name", "root")


def _plan(spark, d):
    return T.merge_plan(T.groups_of(_pairs(spark, d)), table(spark, d, "topics"))


def q_merge_plan(spark, d):
    return _plan(spark, d).withColumn("similarity", F.round("similarity", 6))


def _named_links(spark, d):
    """(document_id, normalized_name, confidence): documents linked to the topics that share the start of their hash."""
    start = lambda c: F.substring(F.sha1(c), 1, 3)
    names = table(spark, d, "topics").groupBy("normalized_name").agg(F.max(F.coalesce("confidence", F.lit(0.5))).alias("confidence"))
    docs = table(spark, d, "legal_documents").select(F.col("id").alias("document_id")).distinct()
    met = docs.join(names, start(F.col("document_id")) == start(F.col("normalized_name")))
    return met.select("document_id", "normalized_name", "confidence")


def q_apply_merge(spark, d):
    return T.apply_merge(_named_links(spark, d), _plan(spark, d))


def q_merged_topics(spark, d):
    names = table(spark, d, "topics").groupBy("normalized_name").agg(F.max("name").alias("name"))
    merged = T.merged_topics(names, _named_links(spark, d), _plan(spark, d))
    return merged.select("normalized_name", "name", F.array_join("aliases", "|").alias("aliases"))


def _topic_edges(spark, d):
    return _links(spark, d).select(F.col("document_id").alias("x"), F.col("normalized_name").alias("y"))


def q_modularity(spark, d):
    """Modularity of the communities of documents and topics that share a first rule topic."""
    edges = _topic_edges(spark, d)
    own = edges.groupBy(F.col("x").alias("name")).agg(F.min("y").alias("community"))
    topics = edges.select(F.col("y").alias("name"), F.col("y").alias("community")).distinct()
    return T.modularity(edges, own.unionByName(topics)).select(F.round("modularity", 6).alias("modularity"), "n_communities")


def q_communities(spark, d):
    return T.communities(_topic_edges(spark, d))


def q_parse_pages(spark, d):
    p = table(spark, d, "parsed_documents").dropDuplicates(["page_id"])
    return parse_pages(p).select("page_id", "title", "markdown", F.size("links").alias("n_links"))


def q_page_title(spark, d):
    return parse_pages(table(spark, d, "parsed_documents").dropDuplicates(["page_id"])).select("page_id", "title")


QUERIES = {name: f for name, f in globals().items() if name.startswith("q_")}

_given = lambda c: f"CASE WHEN {sql.strip(c)} <> '' THEN {c} END"
_DOCS = f"(SELECT id, title, date, coalesce({_given('en')}, {_given('ar')}) AS content FROM (SELECT id, max(title) AS title, max(contentEn) AS en, max(contentAr) AS ar, max(date) AS date FROM legal_documents GROUP BY id))"
_HAY = "coalesce(title, '') || chr(10) || substring(coalesce(content, ''), 1, 12000)"
_RULES = " UNION ALL ".join(f"SELECT id, '{n}' AS topic, {c}::DOUBLE AS confidence, {i} AS pos FROM h WHERE regexp_matches(hay, '{legal.rule_pattern(e, a)}')" for i, (n, c, e, a) in enumerate(legal.TOPIC_RULES))
_WORDS = f"""
w AS (SELECT id, pos, lower(regexp_replace(w, '^[-_]+|[-_]+$', '', 'g')) AS w FROM (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
      FROM (SELECT id, regexp_extract_all(title, '[A-Za-z][A-Za-z\\-]{{3,}}|[\\x{{600}}-\\x{{6FF}}]{{4,}}') AS ws FROM {_DOCS}))),
t AS (SELECT id, w, count(*) AS n, min(pos) AS first FROM w WHERE w NOT IN ({', '.join(f"'{x}'" for x in T.TITLE_STOPWORDS)}) AND w <> '' GROUP BY id, w)"""
def _links_sql(docs: str) -> str:
    return f"""
WITH h AS (SELECT id, {_HAY} AS hay FROM {docs}), r AS ({_RULES}), {_WORDS},
c AS (SELECT id, count(*) AS n_rules FROM r GROUP BY id),
x AS (SELECT id, w AS topic, 0.42 AS confidence, 100 + row_number() OVER (PARTITION BY id ORDER BY n DESC, first) AS pos FROM t),
a AS (SELECT * FROM r UNION ALL SELECT x.* FROM x LEFT JOIN c USING (id) WHERE coalesce(n_rules, 0) < 3 AND pos - 100 <= 12 - coalesce(n_rules, 0)),
n AS (SELECT id, {sql.topic_name('topic')} AS normalized_name, confidence, pos FROM a),
b AS (SELECT id, normalized_name, max(confidence) AS confidence, min(pos) AS pos FROM n WHERE normalized_name <> '' GROUP BY id, normalized_name)
SELECT id AS document_id, normalized_name, confidence FROM b QUALIFY row_number() OVER (PARTITION BY id ORDER BY confidence DESC, pos) <= 12"""


_LINKS = _links_sql(_DOCS)
_TITLE_LINKS = _links_sql(f"(SELECT id, title, NULL AS content FROM {_DOCS})")
# All pairs; topics of one vector are a class of their own.
_PAIRS = f"""
WITH o AS (SELECT normalized_name AS name, max(embedding) AS v FROM topics WHERE {_VALID} AND normalized_name IS NOT NULL GROUP BY 1),
t AS (SELECT v, min(name) AS name FROM o GROUP BY v)
SELECT x.name AS a, y.name AS b, list_cosine_similarity(x.v, y.v) AS similarity FROM t x JOIN t y ON x.name < y.name
WHERE list_cosine_similarity(x.v, y.v) >= {THRESHOLD}
UNION ALL SELECT t.name, o.name, 1.0 FROM o JOIN t USING (v) WHERE o.name <> t.name"""
_GROUPS = f"""
WITH RECURSIVE p AS ({_PAIRS}), e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
reach AS (SELECT a AS name, a AS other FROM e UNION SELECT r.name, e.b FROM reach r JOIN e ON r.other = e.a)
SELECT name, min(other) AS root FROM reach GROUP BY name"""
_PLAN = f"""
SELECT keep, g.name AS drop, list_cosine_similarity(x.v, y.v) AS similarity FROM ({_GROUPS}) g
JOIN (SELECT root, arg_min(name, (len(name), name)) AS keep FROM ({_GROUPS}) GROUP BY root) k USING (root)
JOIN (SELECT normalized_name AS name, max(embedding) AS v FROM topics WHERE embedding IS NOT NULL GROUP BY 1) x ON x.name = keep
JOIN (SELECT normalized_name AS name, max(embedding) AS v FROM topics WHERE embedding IS NOT NULL GROUP BY 1) y ON y.name = g.name WHERE g.name <> keep"""
_NAMED = """
SELECT document_id, normalized_name, confidence FROM (SELECT DISTINCT id AS document_id FROM legal_documents WHERE id IS NOT NULL)
JOIN (SELECT normalized_name, max(coalesce(confidence, 0.5)) AS confidence FROM topics WHERE normalized_name IS NOT NULL GROUP BY 1) ON substring(sha1(document_id), 1, 3) = substring(sha1(normalized_name), 1, 3)"""
_SENTENCES = f"list_filter(list_transform(regexp_split_to_array({sql.digits('text')}, '[\\n.;؛]+'), lambda x: {sql.whitespace('x')}), lambda x: x <> '')"


def _unescaped(x: str) -> str:
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", chr(34)), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{sign}')"
    return x


_TYPED = f"(?i)({legal.REFERENCE_TYPES})[^.؛\\n]{{0,120}}?{legal.NUMBER}"
_LABEL = " ".join(f"WHEN regexp_matches(t, '(?i){p}') THEN '{label}'" for p, label in legal.DOCUMENT_TYPES)
ORACLES = {
    "q_topic_rules": f"WITH h AS (SELECT id, {_HAY} AS hay FROM {_DOCS}), r AS ({_RULES}) SELECT id, topic, confidence, TRUE AS has_evidence FROM r",
    "q_title_words": f"WITH {_WORDS} SELECT id, coalesce(string_agg(w, ' ' ORDER BY n DESC, first), '') AS words FROM {_DOCS} LEFT JOIN t USING (id) GROUP BY id",
    "q_extract_topics": _LINKS,
    "q_link_topics": f"""
SELECT document_id, normalized_name, coalesce(n.confidence, o.confidence) AS confidence FROM ({_LINKS}) o FULL JOIN ({_TITLE_LINKS}) n USING (document_id, normalized_name)
WHERE document_id NOT IN (SELECT {sql.kind('document_id')} FROM withdrawn_documents WHERE document_id IS NOT NULL)""",
    "q_topic_json": f"SELECT DISTINCT normalized_name, {sql.topic_name('name')} AS parsed, round(least(1.0, greatest(0.0, coalesce(confidence, 0.5))), 6) AS confidence FROM topics WHERE len(normalized_name) % 3 < 2 AND name IS NOT NULL",
    "q_cross_references": f"""
WITH d AS (SELECT DISTINCT id, text FROM (SELECT id, contentAr AS text FROM legal_documents UNION ALL SELECT id, contentEn FROM legal_documents UNION ALL SELECT id, contentFr FROM legal_documents)),
s AS (SELECT id, unnest({_SENTENCES}) AS s FROM d),
h AS (SELECT id, s, CASE WHEN regexp_matches(s, '{legal.AMEND_PATTERN}') THEN 'AMENDS' WHEN regexp_matches(s, '{legal.REPEAL_PATTERN}') THEN 'REPEALS' ELSE 'REFERENCES' END AS relation FROM s WHERE regexp_matches(s, '\\d\\s*/\\s*\\d{{2}}')),
m AS (SELECT id, relation, unnest(regexp_extract_all(s, '{_TYPED}', 1)) AS t, unnest(regexp_extract_all(s, '{_TYPED}', 2)) AS a, unnest(regexp_extract_all(s, '{_TYPED}', 3)) AS b FROM h)
SELECT DISTINCT id, relation, a || '/' || b AS number, CASE {_LABEL} WHEN regexp_matches(t, '(?i)قانون|law') THEN 'Law' ELSE {sql.whitespace('t')} END AS document_type FROM m
UNION SELECT id, relation, regexp_replace(n, '\\s', '', 'g'), NULL FROM (SELECT id, relation, unnest(regexp_extract_all(s, '\\d{{1,4}}\\s*/\\s*\\d{{2,4}}')) AS n FROM h)""",
    "q_document_edges": f"""
WITH d AS (SELECT DISTINCT {sql.kind('id')} AS target, {sql.doc_number('number')} AS number, {sql.kind('document_type')} AS kind FROM (SELECT id, number, document_type FROM legal_documents UNION ALL SELECT id, number, document_type FROM core_instruments)),
r AS (SELECT DISTINCT {sql.kind('source_document_id')} AS source, upper(trim(relation_type)) AS relation, {sql.kind('target_document_id')} AS id, {sql.doc_number('target_number')} AS number, {sql.kind('target_document_type')} AS kind FROM cross_references),
k AS (SELECT * FROM r WHERE relation IN ('AMENDS', 'REPEALS') AND source IN (SELECT target FROM d))
SELECT source, relation, target FROM k JOIN d ON k.id = d.target WHERE source <> target
UNION SELECT source, relation, target FROM k JOIN d ON k.number = d.number WHERE k.id IS NULL AND (k.kind IS NULL OR k.kind = d.kind) AND source <> target""",
    "q_documents_without_topics": f"SELECT id, date FROM {_DOCS} WHERE id NOT IN (SELECT document_id FROM ({_LINKS}) WHERE confidence > 0.7)",
    "q_upsert_documents": """
WITH g AS (SELECT id, created_at, max(issuer) AS issuer, max(date) AS date, max(source_url) AS source_url FROM legal_documents GROUP BY id, created_at),
o AS (SELECT id, arg_max(created_at, created_at) AS created_at, max_by(struct_pack(issuer, date, source_url), created_at) AS s FROM g WHERE created_at < '2017' GROUP BY id),
n AS (SELECT id, arg_max(created_at, created_at) AS created_at, max_by(issuer, created_at) FILTER (issuer IS NOT NULL) AS issuer, max_by(date, created_at) FILTER (date IS NOT NULL) AS date, max_by(source_url, created_at) FILTER (source_url IS NOT NULL) AS source_url FROM g WHERE created_at >= '2017' GROUP BY id)
SELECT id, coalesce(n.issuer, o.s.issuer) AS issuer, coalesce(n.date, o.s.date) AS date, coalesce(n.source_url, o.s.source_url) AS source_url, coalesce(o.created_at, n.created_at) AS created_at FROM o FULL JOIN n USING (id)""",
    "q_merge_payloads": """
SELECT id, max_by(title, created_at) FILTER (title <> '') AS title, max_by(number, created_at) FILTER (number <> '') AS number,
  array_to_string(list_sort(list_distinct(flatten(list(pdf_urls)))), ' ') AS pdf_urls, array_to_string(list_sort(list_distinct(flatten(list(map_keys(language_urls))))), ' ') AS languages
FROM legal_documents GROUP BY id""",
    "q_frontier": "SELECT DISTINCT source_url AS url FROM parsed_documents WHERE page_id % 3 <> 1 AND source_url <> '' AND source_url NOT IN (SELECT source_url FROM parsed_documents WHERE page_id % 3 = 1 AND source_url IS NOT NULL)",
    "q_cache_split": "SELECT DISTINCT id, 'local:hash:64:' || sha256(text) AS cache_key FROM chunks WHERE text IS NOT NULL AND text NOT IN (SELECT text FROM chunks WHERE embedding IS NOT NULL AND text IS NOT NULL)",
    "q_topic_pairs": f"SELECT a, b, round(similarity, 6) AS similarity FROM ({_PAIRS})",
    "q_topic_groups": _GROUPS,
    "q_merge_plan": f"SELECT keep, drop, round(similarity, 6) AS similarity FROM ({_PLAN})",
    "q_apply_merge": f"""
WITH p AS ({_PLAN}), l AS ({_NAMED})
SELECT document_id, name AS normalized_name, arg_min(confidence, (moved, -confidence)) AS confidence FROM (
  SELECT document_id, coalesce(keep, normalized_name) AS name, (keep IS NOT NULL)::INT AS moved, confidence FROM l LEFT JOIN p ON p.drop = normalized_name)
GROUP BY document_id, name""",
    "q_merged_topics": f"""
WITH p AS ({_PLAN}), l AS ({_NAMED}), t AS (SELECT normalized_name, max(name) AS name FROM topics GROUP BY 1),
g AS (SELECT keep, drop FROM p WHERE drop IN (SELECT normalized_name FROM l))
SELECT normalized_name, name, coalesce((SELECT string_agg(DISTINCT coalesce(a.name, g.drop), '|' ORDER BY coalesce(a.name, g.drop)) FROM g JOIN t a ON a.normalized_name = g.drop WHERE g.keep = t.normalized_name), '') AS aliases
FROM t WHERE normalized_name NOT IN (SELECT drop FROM g)""",
    "q_modularity": f"""
WITH e AS (SELECT document_id AS x, normalized_name AS y FROM ({_LINKS})), c AS (SELECT x, min(y) AS cx FROM e GROUP BY x),
p AS (SELECT cx, y AS cy FROM e JOIN c USING (x)), m AS (SELECT count(*)::DOUBLE AS m FROM e),
d AS (SELECT c, sum(l) AS l, sum(k) AS k FROM (SELECT cx AS c, (cx = cy)::INT AS l, 1 AS k FROM p UNION ALL SELECT cy, 0, 1 FROM p) GROUP BY c)
SELECT round(sum(l / m - (k / (2 * m)) * (k / (2 * m))), 6) AS modularity, count(*) AS n_communities FROM d CROSS JOIN m""",
    "q_page_title": f"""
WITH p AS (SELECT DISTINCT page_id, regexp_replace(coalesce(content_html, ''), '(?is)<!--.*?-->|<(script|style)\\b.*?</(script|style)\\s*>', '', 'g') AS h FROM parsed_documents),
f AS (SELECT page_id, unnest([1, 2, 3]) AS level, unnest([regexp_extract(h, '(?is)<h1[^>]*>(.*?)</h1', 1), regexp_extract(h, '(?is)<h2[^>]*>(.*?)</h2', 1), regexp_extract(h, '(?is)<title[^>]*>(.*?)</title', 1)]) AS t FROM p),
c AS (SELECT page_id, level, {sql.squeeze(_unescaped("regexp_replace(t, '<[^>]*>', ' ', 'g')"))} AS t FROM f)
SELECT page_id, arg_min(t, level) FILTER (t <> '') AS title FROM c GROUP BY page_id""",
}
ORACLES |= {"q_search": retrieval.results_sql(_LINKS), "q_answer": retrieval.answer_sql(_LINKS)}
