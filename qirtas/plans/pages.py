"""Queries on pages: metadata, languages, links, PDF files, language versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from qirtas.functions import legal, urls
from qirtas.functions.text import is_blank
from qirtas.operators import pages as P
from qirtas.plans import sqltext as sql
from qirtas.plans.text import _canonical_sql
from qirtas.session import table
from qirtas.sources import documents as S

#: All hosts of the test data; files and the English version have hosts of their own.
HOSTS = P.Hosts(("example",), ("files.example",), ("en.example", "lawbook.example"))


def _legal(spark, d, *columns):
    """One row per document."""
    return table(spark, d, "legal_documents").groupBy("id").agg(*[F.max(c).alias(c) for c in columns])


def _pages(spark, d):
    p = table(spark, d, "parsed_documents").where("page_id is not null")
    return p.groupBy("page_id").agg(F.max(F.struct("source_url", "content_html")).alias("p")).select("page_id", "p.*")


def _texts(spark, d):
    return S.contents_by_language(_legal(spark, d, "contentAr", "contentEn", "contentFr"))


def q_document_type(spark, d):
    one = _legal(spark, d, "title", "contentEn", "contentAr").withColumn("text", S.best_content(("contentEn", "contentAr")))
    hay = F.concat_ws(" ", F.col("title"), F.substring(F.coalesce("text", F.lit("")), 1, P.TYPE_CHARS))
    return one.select("id", legal.document_type_label(hay).alias("document_type"))


def q_document_number(spark, d):
    """The number that every text names first, with the issue of gazettes."""
    kind = legal.document_type_label(F.substring("text", 1, P.TYPE_CHARS))
    return _texts(spark, d).select("id", "language", legal.document_number(F.substring("text", 1, P.NUMBER_CHARS), kind).alias("number"))


def q_text_date(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", legal.date_in_text(F.col("text")).alias("date"))


def q_issuer_of(spark, d):
    one = _legal(spark, d, "title", "contentEn")
    return one.select("id", legal.issuer_of(F.coalesce("title", F.lit("")), F.array().cast("array<string>"), F.coalesce("contentEn", F.lit(""))).alias("issuer"))


def q_crawlable(spark, d):
    u = table(spark, d, "parsed_documents").select("source_url").where("source_url is not null").distinct()
    hosts = P.Hosts(("gazette.example", "lawbook.example"), ("files.gazette.example",))
    return u.select("source_url", P.is_crawlable(F.col("source_url"), hosts).alias("crawlable"))


def q_page_language(spark, d):
    raw = P.read_pages(_pages(spark, d))
    return raw.select("page_id", P.page_language(F.col("html_language"), F.col("source_url"), HOSTS).alias("language"))


def q_page_blocks(spark, d):
    """Which languages a page has containers of, and how long its main text is."""
    raw = P.read_pages(_pages(spark, d))
    return raw.select("page_id", F.array_join(F.array_sort(F.map_keys("blocks")), ",").alias("languages"), F.length("main_text").alias("n_chars"))


def q_parse_documents(spark, d):
    return P.parse_documents(_pages(spark, d), HOSTS).drop("links", "metadata", "contents", "page_text", "content_text")


def q_discovered_links(spark, d):
    raw = P.read_pages(_pages(spark, d)).select("page_id", F.posexplode("links").alias("pos", "l")).select("page_id", "pos", "l.url", "l.text")
    return P.discovered_links(raw, HOSTS).select("page_id", "kind", "url").distinct()


def q_language_urls(spark, d):
    rows = table(spark, d, "legal_documents").select("id", P.normalized_language_urls(F.col("language_urls")).alias("m"))
    return rows.select("id", F.explode("m").alias("language", "url")).distinct()


def q_language_versions(spark, d):
    one = _legal(spark, d, "title", "source_url", "language", "contentEn", "contentAr").withColumn("content", S.best_content(("contentEn", "contentAr")))
    links = table(spark, d, "legal_documents").select("id", F.explode("language_urls").alias("language", "url")).where(F.col("language").isin("ar", "en"))
    # Addresses are those of the documents, or of their versions under another host.
    merged = P.merge_language_versions(one, links.distinct())
    return merged.select("id", "linked_url", "linked_language_merged", F.length("contentAr").alias("n_ar"), F.length("contentEn").alias("n_en"))


def q_pdf_documents(spark, d):
    """PDF addresses without a text layer: stubs with warnings."""
    files = table(spark, d, "legal_documents").select(F.explode("pdf_urls").alias("source_url")).distinct()
    nothing = F.lit(None).cast("string")
    rows = P.pdf_documents(files.select("source_url", nothing.alias("title"), nothing.alias("text"), F.lit("pdf_text_layer_not_found").alias("warning")), HOSTS)
    return rows.select("id", "source_url", "title", "language", F.array_join("warnings", ",").alias("warnings"), F.length("content").alias("n_chars"))


def q_raw_names(spark, d):
    """Names and kinds of raw files, from address and content type."""
    u = table(spark, d, "parsed_documents").select(F.col("source_url").alias("url"), F.lit("text/html; charset=utf-8").alias("content_type"))
    pdfs = table(spark, d, "legal_documents").select(F.explode("pdf_urls").alias("url"), F.lit("application/octet-stream").alias("content_type"))
    both = u.unionByName(pdfs).where("url is not null").distinct()
    return both.select("url", "content_type", F.concat(urls.raw_file_stem(F.col("url")), S.raw_extension(F.col("content_type"), F.col("url"))).alias("name"), S.is_html(F.col("content_type")).alias("is_html"), S.is_pdf(F.col("content_type"), F.col("url")).alias("is_pdf"))


def q_best_content(spark, d):
    one = _legal(spark, d, "contentEn", "contentAr", "contentFr")
    return one.select("id", F.length(S.best_content()).alias("n_chars"), is_blank(S.best_content()).alias("blank"))


QUERIES = {name: f for name, f in globals().items() if name.startswith("q_")}

_ONE = "(SELECT id, max(title) AS title, max(source_url) AS source_url, max(language) AS language, max(contentAr) AS ar, max(contentEn) AS en, max(contentFr) AS fr FROM legal_documents GROUP BY id)"
_given = lambda c: f"CASE WHEN {sql.strip(c)} <> '' THEN {c} END"
_label = lambda t: "CASE " + " ".join(f"WHEN regexp_matches({t}, '(?i){p}') THEN '{label}'" for p, label in legal.DOCUMENT_TYPES) + " END"
_TEXTS = f"(SELECT id, 'ar' AS language, {_given('ar')} AS text FROM {_ONE} UNION ALL SELECT id, 'en', {_given('en')} FROM {_ONE} UNION ALL SELECT id, 'fr', {_given('fr')} FROM {_ONE})"


def _pair(t: str, p: str) -> str:
    return f"CASE WHEN regexp_matches({t}, '(?i){p}') THEN regexp_extract({t}, '(?i){p}', 1) || '/' || regexp_extract({t}, '(?i){p}', 2) END"


_DATES = ", ".join(f"nullif(regexp_extract(t, '(?i){p}'), '')" for p in legal.DATE_PATTERNS)
_PAGES = "(SELECT page_id, p.source_url AS source_url, coalesce(p.content_html, '') AS html FROM (SELECT page_id, max({source_url: source_url, content_html: content_html}) AS p FROM parsed_documents WHERE page_id IS NOT NULL GROUP BY page_id))"
_host = lambda u: f"lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_below = lambda h, names: "(" + " OR ".join(f"{h} = '{n}' OR ends_with({h}, '.{n}')" for n in names) + ")"
_LINES = f"list_filter(list_transform(string_split(coalesce(en, ''), chr(10)), lambda x: {sql.squeeze('x')}), lambda x: x <> '')"
_IS_ISSUER = f"len(x) BETWEEN 3 AND 180 AND ({' OR '.join(f'contains(lower(x), {m.lower()!r})' for m in legal.ISSUER_MARKERS)})"
_PREFIX = sql.squeeze("split_part(t, ':', 1)")
ORACLES = {
    "q_document_type": f"WITH h AS (SELECT id, coalesce(title || ' ', '') || substring(coalesce({_given('en')}, {_given('ar')}, ''), 1, 2000) AS hay FROM {_ONE}) SELECT id, {_label('hay')} AS document_type FROM h",
    "q_document_number": f"""
WITH t AS (SELECT id, language, {_label('substring(text, 1, 2000)')} AS kind, {sql.digits('substring(text, 1, 1500)')} AS t FROM {_TEXTS} WHERE text IS NOT NULL)
SELECT id, language, coalesce({_pair('t', legal.NUMBER)}, {_pair('t', legal.NUMBER_OF_YEAR)}, CASE WHEN kind = '{legal.GAZETTE}' THEN nullif(regexp_extract(t, '(?i){legal.GAZETTE_ISSUE}', 1), '') END) AS number FROM t""",
    "q_text_date": f"WITH t AS (SELECT doc_id, {sql.digits('text')} AS t FROM documents WHERE text IS NOT NULL), f AS (SELECT doc_id, coalesce({_DATES}) AS f FROM t) SELECT doc_id, {sql.squeeze(chr(34) + 'f' + chr(34))} AS date FROM f",
    "q_issuer_of": f"""
WITH o AS (SELECT id, {sql.squeeze("coalesce(title, '')")} AS t, {_LINES} AS l FROM {_ONE})
SELECT id, coalesce(CASE WHEN contains(t, ':') AND len({_PREFIX}) BETWEEN 3 AND 140 THEN {_PREFIX} END, CASE WHEN regexp_matches(t, '{legal.ROYAL}') THEN '{legal.ROYAL_ISSUER}' END,
  list_filter(list_reverse(l[-{legal.SIGNATURE_LINES}:]), lambda x: {_IS_ISSUER})[1]) AS issuer FROM o""",
    "q_crawlable": f"SELECT DISTINCT source_url, {_below(_host('source_url'), ('gazette.example', 'lawbook.example', 'files.gazette.example'))} AND regexp_matches(source_url, '^(?i:https?):') AS crawlable FROM parsed_documents WHERE source_url IS NOT NULL",
    "q_page_language": f"""
WITH l AS (SELECT page_id, source_url, lower(regexp_extract(html, '(?is)<html[^>]*?\\blang\\s*=\\s*["'']?([A-Za-z-]*)', 1)) AS lang FROM {_PAGES})
SELECT page_id, CASE WHEN starts_with(lang, 'ar') THEN 'ar' WHEN starts_with(lang, 'en') THEN 'en' WHEN {_below(_host("coalesce(source_url, '')"), HOSTS.english)} THEN 'en' ELSE 'ar' END AS language FROM l""",
    "q_language_urls": f"""
WITH e AS (SELECT DISTINCT id, unnest(map_entries(language_urls)) AS e FROM legal_documents), f AS (SELECT id, CASE WHEN {sql.kind('e.key')} IN ('ar', 'en', 'fr', 'unknown') THEN {sql.kind('e.key')} ELSE 'unknown' END AS language, e.value AS u FROM e)
SELECT DISTINCT id, language, {_canonical_sql('u')} AS url FROM f""",
    "q_language_versions": f"""
WITH o AS (SELECT id, title, language, {_canonical_sql('source_url')} AS url, coalesce({_given('en')}, {_given('ar')}) AS content FROM (SELECT id, title, language, source_url, en, ar FROM {_ONE})),
l AS (SELECT id, e.key AS wanted, max({_canonical_sql('e.value')}) AS linked_url FROM (SELECT id, unnest(map_entries(language_urls)) AS e FROM legal_documents) WHERE e.key IN ('ar', 'en') GROUP BY id, e.key),
v AS (SELECT url, arg_min(content, id) AS content, min(id) AS vid FROM (SELECT id, url, coalesce(content, '') AS content FROM o) GROUP BY url),
j AS (SELECT o.id, o.language, o.content, l.linked_url AS u, l.wanted, v.content AS theirs, coalesce(v.vid IS NOT NULL AND l.linked_url <> o.url, FALSE) AS found FROM o
  LEFT JOIN l ON l.id = o.id AND l.wanted = CASE WHEN o.language = 'ar' THEN 'en' ELSE 'ar' END LEFT JOIN v ON v.url = l.linked_url)
SELECT id, CASE WHEN found THEN u END AS linked_url, found AS linked_language_merged, len(CASE WHEN language = 'ar' THEN content WHEN found AND wanted = 'ar' THEN theirs END)::INT AS n_ar, len(CASE WHEN language = 'en' THEN content WHEN found AND wanted = 'en' THEN theirs END)::INT AS n_en FROM j""",
    "q_best_content": f"SELECT id, len(coalesce({_given('en')}, {_given('ar')}, {_given('fr')}))::INT AS n_chars, coalesce({_given('en')}, {_given('ar')}, {_given('fr')}) IS NULL AS blank FROM {_ONE}",
    "q_raw_names": f"""
WITH u AS (SELECT DISTINCT source_url AS url, 'text/html; charset=utf-8' AS content_type FROM parsed_documents WHERE source_url IS NOT NULL UNION SELECT unnest(pdf_urls), 'application/octet-stream' FROM legal_documents),
p AS (SELECT *, regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, content_type = 'text/html; charset=utf-8' AS is_html, ends_with(lower(url), '.pdf') AS is_pdf FROM u WHERE url IS NOT NULL)
SELECT url, content_type, coalesce(nullif(substring(slug, 1, 90), ''), 'root') || '-' || substring(sha1(url), 1, 12) || CASE WHEN is_pdf THEN '.pdf' WHEN is_html THEN '.html' ELSE '.bin' END AS name, is_html, is_pdf FROM p""",
}
