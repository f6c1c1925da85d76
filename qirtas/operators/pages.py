"""Pages to documents: metadata, contents by language, links by kind, and documents of several pages.

HTML is parsed once per page, in Arrow batches, to what needs its tree; all that
can be said of text alone (type, number, date, issuer) are native expressions
on the result.
"""

from __future__ import annotations

from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.functions import legal, urls
from qirtas.functions.identity import page_document_id
from qirtas.functions.text import is_blank, squeeze, strip
from qirtas.operators import html as H

# Marks of the containers of one language, and meta elements that hold a date.
LANGUAGE_MARKS = {
    "ar": (("lang", "ar"), ("lang", "ar-OM"), ("dir", "rtl"), ("class", "arabic"), ("class", "lang-ar"), ("class", "content-ar"), ("class", "ar")),
    "en": (("lang", "en"), ("lang", "en-US"), ("dir", "ltr"), ("class", "english"), ("class", "lang-en"), ("class", "content-en"), ("class", "en")),
}
DATE_METAS = (("property", "article:published_time"), ("name", "date"), ("name", "pubdate"), ("itemprop", "datePublished"))
#: Characters of a page that its type and its number are looked for in.
TYPE_CHARS, NUMBER_CHARS = 2000, 1500

RAW = (
    "page_id long, source_url string, title string, page_text string, html_language string, html_date string, categories string, tags array<string>, "
    "blocks map<string,string>, main_markdown string, main_text string, links array<struct<url:string,text:string>>"
)


class Hosts(NamedTuple):
    """The hosts that are crawled; names below them count too."""

    documents: tuple[str, ...]
    pdfs: tuple[str, ...] = ()
    english: tuple[str, ...] = ()

    @staticmethod
    def matches(host: Column, names: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for name in names:
            out = out | (host == name) | host.endswith("." + name.lstrip("."))
        return out


def _selected(root: H.Node, mark: tuple[str, str]) -> H.Node | None:
    """The first node with the mark that has text."""
    key, value = mark
    for n in root.walk():
        if (value in n.classes() if key == "class" else n.attrs.get(key) == value) and n.text():
            return n
    return None


def _date_of(nodes: list[H.Node]) -> str | None:
    for n in nodes:
        if n.tag == "time" and (found := (n.attrs.get("datetime") or "").strip() or n.text()):
            return " ".join(found.split())
    for key, value in DATE_METAS:
        for n in nodes:
            if n.tag == "meta" and n.attrs.get(key) == value and (n.attrs.get("content") or "").strip():
                return " ".join(n.attrs["content"].split())
    return None


def _linked(nodes: list[H.Node], rel: str, classes: tuple[str, ...]) -> list[str]:
    """Texts of links of a kind: by ``rel``, or inside an element of one of the classes."""
    def inside(n: H.Node) -> bool:
        up = n.parent
        while up is not None:
            if any(c in up.classes() for c in classes):
                return True
            up = up.parent
        return False

    return [t for n in nodes if n.tag == "a" and (n.attrs.get("rel") == rel or inside(n)) and (t := n.text())]


def read_page(html: str, url: str) -> tuple:
    """What needs the tree of one page, in the order of ``RAW`` after the URL."""
    root = H.parse(html)
    nodes = list(root.walk())
    language = next((n.attrs.get("lang") for n in nodes if n.tag == "html"), None)
    title, links, text = H.title_of(root), H.links_of(root, url), root.text()
    date, categories, tags = _date_of(nodes), _linked(nodes, "category tag", ("cat-links", "entry-categories")), _linked(nodes, "tag", ("tags-links", "entry-tags"))
    found = {code: n for code, marks in LANGUAGE_MARKS.items() if (n := next(filter(None, (_selected(root, m) for m in marks)), None))}
    main = H.main_content(root)
    main_text = main.text()
    H.drop_noise(root)
    blocks = {code: H.tidy_markdown("\n\n".join(H.blocks_of(n, url))) for code, n in found.items()}
    # Noise is gone, so the container may have to be chosen again.
    main_markdown = H.tidy_markdown("\n\n".join(H.blocks_of(main if main.text() else H.main_content(root), url)))
    return title, text, (language or "").strip().lower() or None, date, " ".join(categories), tags, blocks, main_markdown, main_text, links


def read_pages(pages: DataFrame) -> DataFrame:
    """``RAW`` rows of (page_id, source_url, content_html); null HTML counts as empty."""
    def read(batches):
        for pdf in batches:
            rows = [(k, u, *read_page(h or "", u or "")) for k, u, h in zip(pdf["page_id"], pdf["source_url"], pdf["content_html"])]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RAW.replace("array<struct<url:string,text:string>>", "x").replace("map<string,string>", "x").split(", ")])

    return pages.select("page_id", "source_url", "content_html").mapInPandas(read, RAW)


def host_language(url: Column, hosts: Hosts) -> Column:
    """English for the English hosts, else Arabic."""
    return F.when(Hosts.matches(urls.host(url), hosts.english), "en").otherwise("ar")


def page_language(html_language: Column, url: Column, hosts: Hosts) -> Column:
    """The page's own statement if it is Arabic or English, else the host's."""
    return F.when(html_language.startswith("ar"), "ar").when(html_language.startswith("en"), "en").otherwise(host_language(url, hosts))


def link_language(text: Column, url: Column, hosts: Hosts) -> Column:
    """The language version that a link leads to, or null."""
    t = F.lower(text)
    return F.when(t.contains("english") | Hosts.matches(urls.host(url), hosts.english), "en").when(t.contains("arabic") | t.contains("العربية"), "ar")


def is_crawlable(url: Column, hosts: Hosts) -> Column:
    """An http(s) URL of one of the hosts."""
    u = urls.canonical_url(url, 6)
    return urls.scheme(u).isin("http", "https") & Hosts.matches(urls.host(u), (*hosts.documents, *hosts.pdfs))


def discovered_links(links: DataFrame, hosts: Hosts) -> DataFrame:
    """(page_id, kind, url, language) of (page_id, url, text): each URL once per kind; kind: pdf, listing, document or language.

    A PDF is nothing else; a link to another language version also has its kind.
    A later link to the same language replaces an earlier one.
    """
    u = F.col("u")
    rows = links.select("page_id", "pos", urls.canonical_url(F.col("url"), 6).alias("u"), "text")
    ours, pdf_host = Hosts.matches(urls.host(u), hosts.documents), Hosts.matches(urls.host(u), hosts.pdfs)
    pdf = ((ours | pdf_host) & (F.lower(urls.path(u)).endswith(".pdf") | F.lower(urls.path(u)).contains("/pdf/"))) | pdf_host
    kind = F.when(pdf, "pdf").when(urls.is_listing(u, ours), "listing").when(urls.is_document(u, ours, pdf_host), "document")
    rows = rows.withColumn("kind", kind)
    plain = rows.where("kind is not null").select("page_id", "kind", F.col("u").alias("url"), F.lit(None).cast("string").alias("language")).distinct()
    language = F.when(F.col("kind").isNull() | (F.col("kind") != "pdf"), link_language(F.col("text"), u, hosts))
    versions = rows.withColumn("language", language).where("language is not null").groupBy("page_id", "language").agg(F.max_by("u", "pos").alias("url"))
    return plain.unionByName(versions.select("page_id", F.lit("language").alias("kind"), "url", "language"))


def crawlable_urls(found: DataFrame) -> DataFrame:
    """(url): document, listing, PDF and language links together, each once."""
    return found.select("url").where("url <> ''").distinct()


def normalized_language_urls(entries: Column) -> Column:
    """A language -> URL map with known lower-case codes (others are ``unknown``) and canonical URLs; the last of equal codes counts."""
    code = lambda e: F.lower(strip(e["key"]))
    named = F.transform(F.map_entries(entries), lambda e: F.struct(F.when(code(e).isin("ar", "en", "fr", "unknown"), code(e)).otherwise("unknown").alias("key"), urls.canonical_url(e["value"]).alias("value")))
    keys = F.array_distinct(F.transform(named, lambda e: e["key"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(named, lambda e: e["key"] == k), -1)["value"].alias("value"))))


def parse_documents(pages: DataFrame, hosts: Hosts) -> DataFrame:
    """One document row per page: identity, metadata, contents by language, links and references' text.

    Columns: page_id, id, title, date, document_type, number, issuer, source_url,
    language, content (Markdown of the page's language), contents (by language),
    content_text, page_text, links, metadata.
    """
    raw = read_pages(pages)
    url = urls.canonical_url(F.col("source_url"), 6)
    title = F.coalesce(F.when(F.col("title") != "", F.col("title")), urls.title_from_url(url))
    rows = raw.withColumns({"source_url": url, "title": title, "language": page_language(F.col("html_language"), url, hosts)})
    # Title, categories and the beginning of the text decide the type.
    hay = F.concat_ws(" ", "title", "categories", F.substring("page_text", 1, TYPE_CHARS))
    rows = rows.withColumn("document_type", legal.document_type_label(hay))
    near = F.concat_ws(" ", "title", F.substring("page_text", 1, NUMBER_CHARS))
    rows = rows.withColumns({
        "number": legal.document_number(near, F.col("document_type")),
        "date": F.coalesce("html_date", legal.date_in_text(F.col("page_text"))),
        "issuer": legal.issuer_of(F.col("title"), F.col("tags"), F.col("page_text")),
    })
    rows = rows.withColumn("id", page_document_id(F.col("source_url"), F.col("title"), F.col("document_type"), F.col("number")))
    own = F.try_element_at("blocks", F.col("language"))
    content = with_first_heading(F.coalesce(F.when(~is_blank(own), own), F.col("main_markdown")), F.col("title"))
    signals = F.col("document_type").isNotNull() | F.col("number").isNotNull()
    return rows.select(
        "page_id", "id", "title", "date", "document_type", "number", "issuer", "source_url", "language", content.alias("content"),
        F.col("blocks").alias("contents"), F.col("main_text").alias("content_text"), "page_text", "links",
        F.create_map(F.lit("has_document_signals"), signals.cast("string"), F.lit("text_length"), F.length("main_text").cast("string")).alias("metadata"),
    )


def with_first_heading(markdown: Column, title: Column) -> Column:
    """The Markdown, with the title as its first heading if it has none."""
    return F.when(markdown.startswith("#") | (title == ""), markdown).otherwise(F.concat(F.lit("# "), title, F.lit("\n\n"), markdown))


def pdf_documents(files: DataFrame, hosts: Hosts) -> DataFrame:
    """(id, title, document_type, number, source_url, language, content, warnings) of (source_url, title, text, warning).

    The title is given or read from the URL; type and number are looked for in it. A PDF without text
    becomes a stub that says so, with its warnings.
    """
    url = urls.canonical_url(F.col("source_url"), 6)
    title = F.coalesce(F.when(F.col("title") != "", F.col("title")), urls.title_from_url(url))
    rows = files.withColumns({"source_url": url, "title": title}).withColumn("document_type", legal.document_type_label(F.col("title")))
    rows = rows.withColumn("number", legal.document_number(F.col("title"), F.col("document_type")))
    body = F.when(is_blank(F.col("text")), F.lit("> PDF text extraction produced no readable text. The raw PDF should be kept for manual inspection or OCR processing.")).otherwise(F.col("text"))
    content = F.concat_ws("\n\n", F.concat(F.lit("# "), "title"), F.concat(F.lit("Source: "), F.when(F.col("source_url") != "", F.col("source_url"))), body)
    warnings = F.array_compact(F.array(F.col("warning"), F.when(is_blank(F.col("text")), F.lit("empty_pdf_text"))))
    return rows.select(
        page_document_id(F.col("source_url"), F.col("title"), F.col("document_type"), F.col("number")).alias("id"), "title", "document_type", "number",
        "source_url", host_language(F.col("source_url"), hosts).alias("language"), content.alias("content"), warnings.alias("warnings"),
    )


def pdf_texts(files: DataFrame) -> DataFrame:
    """(path, text, warning) of (path, content): the text layer under a heading per page, a warning where there is none.

    Needs a PDF library; without one every file is a row with a warning. A page or a file that fails stops no other.
    """
    def read(batches):
        try:
            from pypdf import PdfReader
        except ImportError:
            PdfReader = None
        for pdf in batches:
            yield pd.DataFrame([(p, *_pdf_text(bytes(c) if c is not None else b"", PdfReader)) for p, c in zip(pdf["path"], pdf["content"])], columns=["path", "text", "warning"])

    return files.select("path", "content").mapInPandas(read, "path string, text string, warning string")


def _pdf_text(content: bytes, reader) -> tuple[str, str | None]:
    import io

    if not content:
        return "", "empty_pdf_bytes"
    if reader is None:
        return "", "pdf_library_not_installed"
    try:
        pages = list(reader(io.BytesIO(content)).pages)
    except Exception as error:  # any broken file is a row with a warning
        return "", f"pdf_parse_failed:{type(error).__name__}"
    out = []
    for number, page in enumerate(pages, 1):
        try:
            text = H.tidy_markdown(page.extract_text() or "").strip()
        except Exception:  # as with files
            text = "> Text extraction failed for this page."
        if text:
            out.append(f"## Page {number}\n\n{text}")
    return "\n\n".join(out), None if out else "pdf_text_layer_not_found"


def merge_language_versions(documents: DataFrame, links: DataFrame) -> DataFrame:
    """Documents with the title, content and URL of their linked version in the other of Arabic and English.

    ``documents``: id, title, source_url, language, content, a row per page (versions may
    share an id); ``links``: id, language, url. A version is the page at the linked
    URL, the least id if several are there; without one the document stays as it is,
    ``linked_language_merged`` is false. One row per id.
    """
    pages = documents.withColumn("url", urls.canonical_url(F.col("source_url"), 6)).groupBy("id", "url").agg(F.max(F.struct("title", "source_url", "language", "content")).alias("d")).select("id", "url", "d.*")
    other = F.when(F.col("language") == "ar", "en").otherwise("ar")
    wanted = links.groupBy("id", F.col("language").alias("wanted")).agg(F.max(urls.canonical_url(F.col("url"), 6)).alias("linked_url"))
    at = pages.groupBy(F.col("url").alias("linked_url")).agg(F.min(F.struct("id", "title", "content")).alias("v"))
    # A page that very many link to is one row of ``at``, so the join can be split.
    joined = pages.withColumn("wanted", other).join(wanted, ["id", "wanted"], "left").join(at, "linked_url", "left")
    found = F.col("v").isNotNull() & (F.col("linked_url") != F.col("url"))
    side = lambda code, own, theirs: F.when(F.col("language") == code, own).when(found & (F.col("wanted") == code), theirs)
    rows = joined.select(
        "id", "title", "source_url", "language",
        *[side(c, F.col("title"), F.col("v.title")).alias(f"title_{c}") for c in ("ar", "en")],
        *[side(c, F.col("content"), F.col("v.content")).alias(n) for c, n in (("ar", "contentAr"), ("en", "contentEn"))],
        F.when(found, F.col("linked_url")).alias("linked_url"), F.coalesce(found, F.lit(False)).alias("linked_language_merged"),
    )
    return rows.groupBy("id").agg(*[F.max(c).alias(c) for c in rows.columns if c != "id"])
