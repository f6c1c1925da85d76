"""Pages, writers, providers and the engine on a small corpus."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from qirtas import providers
from qirtas.engine import Engine, show
from qirtas.functions import legal
from qirtas.operators import ingest, pages, retrieval, topics
from qirtas.operators.chunking import Limits

HOSTS = pages.Hosts(("law.example", "en.law.example"), ("files.law.example",), ("en.law.example",))
ARABIC = "<html lang='ar-OM'><head><title>t</title><meta property='article:published_time' content='2020-05-01'></head><body><article class='ar'><h1>مرسوم سلطاني رقم ٥٠ / ٢٠٢٠</h1><p>المادة الأولى</p><p>تحصل ضريبة الدخل على البنك.</p><a href='https://en.law.example/d/fifty/'>English</a><a href='/f/a.pdf?utm_source=x'>PDF</a><a href='/tag/x/'>Tag</a><a href='/d/other/#top'>Other</a></article></body></html>"
ENGLISH = "<html lang='en'><body><article><h1>Royal Decree 50/2020</h1><p>Article 1</p><p>Income tax is collected by the bank. It amends Royal Decree 3/1984.</p></article></body></html>"
PAGES = [(1, "https://law.example/d/fifty", ARABIC), (2, "https://en.law.example/d/fifty/", ENGLISH), (3, "https://law.example/tag/x/", "<a href='/d/fifty'>x</a>"), (4, "https://law.example/d/empty/", None)]


@pytest.fixture(scope="module")
def page_rows(spark):
    return spark.createDataFrame(PAGES, "page_id long, source_url string, content_html string")


def test_page_metadata(spark, page_rows):
    got = {r.page_id: r for r in pages.parse_documents(page_rows, HOSTS).collect()}
    one = got[1]
    assert (one.language, one.document_type, one.number, one.date) == ("ar", "Royal Decree", "50/2020", "2020-05-01")
    assert one.issuer == legal.ROYAL_ISSUER and "### المادة الأولى" in one.content and one.content.startswith("# ")
    assert got[2].language == "en" and got[2].id == got[1].id
    assert got[4].title == "empty" and got[4].document_type is None and got[4].content == "# empty\n\n"


def test_links_by_kind(spark, page_rows):
    raw = pages.read_pages(page_rows).select("page_id", F.posexplode("links").alias("pos", "l")).select("page_id", "pos", "l.url", "l.text")
    got = {(r.page_id, r.kind, r.url, r.language) for r in pages.discovered_links(raw, HOSTS).collect()}
    assert {(1, "pdf", "https://law.example/f/a.pdf", None), (1, "listing", "https://law.example/tag/x/", None), (1, "document", "https://law.example/d/other/", None),
            (1, "language", "https://en.law.example/d/fifty/", "en"), (1, "document", "https://en.law.example/d/fifty/", None), (3, "document", "https://law.example/d/fifty/", None)} == got


def test_numbers_dates_and_issuers(spark):
    rows = [("no. ٥ / ٢٠٢٠ x", None), ("Decree 7 of 1999", None), ("Issue 1234", "Official Gazette"), ("Issue 1234", "Law"), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "t string, k string").coalesce(1)
    assert [r[0] for r in df.select(legal.document_number(F.col("t"), F.col("k"))).collect()] == ["5/2020", "7/1999", "1234", None, None, None]
    texts = ["on 2020-01-02.", "of 3 May 2001", "صدر في ٤ من صفر سنة ١٤٢٠ هـ.", "5/6/99", "nothing", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(legal.date_in_text(F.col("t"))).collect()]
    assert got == ["2020-01-02", "3 May 2001", "4 من صفر سنة 1420 هـ", "5/6/99", None, None]
    rows = [("Ministry of Tax: order", [], "x"), ("Order", ["no", "Ministry of Sea"], "x"), ("Order", [], "text\nMinister of Law\n"), ("Order", [], "")]
    got = [r[0] for r in spark.createDataFrame(rows, "t string, tags array<string>, x string").coalesce(1).select(legal.issuer_of(F.col("t"), F.col("tags"), F.col("x"))).collect()]
    assert got == ["Ministry of Tax", "Ministry of Sea", "Minister of Law", None]


def test_chunk_upsert_overwrites_but_for_vectors(spark):
    schema = "id string, document_id string, text string, embedding array<double>, created_at string, n int"
    old = spark.createDataFrame([("a", "d", "old", [1.0], "1", 0), ("b", "d", "keep", None, "1", 0)], schema)
    new = spark.createDataFrame([("a", "d", None, None, "2", 1), ("c", "d", "first", None, "2", 1), ("c", "d", "last", [2.0], "2", 2), ("x", "unknown", "t", None, "2", 1), (None, "d", "t", None, "2", 1)], schema)
    docs = spark.createDataFrame([("d",)], "id string")
    got = {r.id: (r.text, r.embedding, r.created_at) for r in ingest.upsert_chunks(old, new, docs, "n").collect()}
    assert got == {"a": (None, [1.0], "1"), "b": ("keep", None, "1"), "c": ("last", [2.0], "2")}
    assert ingest.upsert_chunks(old.limit(0), new.limit(0), docs, "n").count() == 0


def test_embedding_cache_and_fallback(spark):
    texts = spark.createDataFrame([(1, "tax law"), (2, "tax law"), (3, None), (4, "sea")], "i int, t string")
    model = providers.Embedder("mine", "m", 3, lambda batch: [[float(len(t)), 0.0, 1.0] for t in batch])
    got, put = providers.embed_texts(texts, "t", model)
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-9 for r in got.collect()) and {r.provider for r in put.collect()} == {"mine"} and put.count() == 3
    _, again = providers.embed_texts(texts, "t", model, put)
    assert again.count() == 0

    def broken(batch):
        raise RuntimeError("no model")

    got, put = providers.embed_texts(texts, "t", providers.Embedder("mine", "m", 16, broken))
    assert {r.provider for r in put.collect()} == {providers.HASHING}
    same = {r.i: r.embedding for r in providers.embed_texts(texts, "t", providers.hashing_embedder(16))[0].collect()}
    assert all(np.allclose(r.embedding, same[r.i]) for r in got.collect())
    assert providers.choose_embedder("hosted", 8, {"hosted": model}).provider == providers.HASHING
    assert providers.choose_embedder("hosted", 8, {"hosted": model}, key="k") is model


def test_merged_lists_keep_their_order_and_topics(spark):
    v = spark.createDataFrame([("b", 0.9, ["x"]), ("a", 0.1, [])], "chunk_id string, score double, topics array<string>")
    w = spark.createDataFrame([("c", 2.0, ["z"]), ("b", 1.0, ["y", "x"])], "chunk_id string, score double, topics array<string>")
    got = [(r.position, r.chunk_id, round(r.combined_score, 3), r.match_sources, r.topics) for r in retrieval.merge_candidates(v, w, 9).orderBy("position").collect()]
    assert got == [(1, "b", 0.65, ["keyword", "vector"], ["x", "y"]), (2, "c", 0.35, ["keyword"], ["z"]), (3, "a", 0.0, ["vector"], [])]


def test_scores_texts_and_failing_scorers(spark):
    df = spark.createDataFrame([("a", None, 0.5, "", "plain"), ("b", 0.7, 0.1, "long", "plain")], "chunk_id string, combined_score double, score double, expanded_text string, text string")
    assert [(r[0], r[1]) for r in df.select(retrieval.candidate_score(df.columns), retrieval.candidate_text(df.columns)).collect()] == [(0.5, "plain"), (0.7, "long")]
    assert [r.chunk_id for r in retrieval.sort_by_score(df).collect()] == ["b", "a"]
    base = retrieval.candidate_score(df.columns)

    def bad(query, texts):
        raise RuntimeError("no model")

    for scorer in (None, bad):
        assert [r.chunk_id for r in retrieval.rerank(retrieval.score_pairs(df, "q", scorer), F.col("raw_score"), base, 5).collect()] == ["b", "a"]
    turned = retrieval.score_pairs(df, "q", lambda q, texts: [float(len(t)) for t in texts])
    assert [r.chunk_id for r in retrieval.rerank(turned, F.col("raw_score"), base, 1).collect()] == ["a"]


def test_answers(spark):
    empty = spark.createDataFrame([], "rank int, label string, topics array<string>, evidence string, text string")
    assert retrieval.answer(empty, "q") == retrieval.NO_CONTEXT
    one = spark.createDataFrame([(2, "B", [], "e2", "t"), (1, "A", list("abcdefgh"), "e1", "t")], empty.schema)
    lines = retrieval.answer(one, "q").split("\n")
    assert lines[1] == "1. A appears relevant. Linked topics: a, b, c, d, e, f. Evidence: e1" and "no linked topics" in lines[2] and len(lines) == 4
    assert retrieval.answer(one, "q", lambda q, contexts: f"{len(contexts)} read") == "2 read"
    assert retrieval.answer(one, "q", lambda q, contexts: 1 / 0) == "\n".join(lines)
    assert retrieval.fulltext_query("What about C++ tax/law?") == "tax" and retrieval.fulltext_query("a b") == "a b" and retrieval.escape_term("a*b") == r"a\*b"


def test_written_index_gives_what_a_scan_gives(spark, tmp_path):
    rows = [(f"c{i}", f"bank deposit {'tax ' * (i % 4)} word{i}") for i in range(40)] + [("c1", "bank deposit tax  word1"), (None, "bank"), ("n", None)]
    chunks = spark.createDataFrame(rows, "id string, text string")
    retrieval.write_index(chunks, str(tmp_path / "index"), 8)
    for query in ("tax deposit of word7", "zz of", "nothingness"):
        scan = [(r.chunk_id, round(r.score, 9)) for r in retrieval.bm25_search(chunks, query, 10).collect()]
        assert [(r.chunk_id, round(r.score, 9)) for r in retrieval.index_search(spark, str(tmp_path / "index"), query, 10).collect()] == scan


def test_merge_keeps_topics_without_documents(spark):
    names = spark.createDataFrame([("tax", "Tax"), ("taxes", "Taxes"), ("taxed", "Taxed"), ("sea", "Sea")], "normalized_name string, name string")
    links = spark.createDataFrame([("d", "taxes", 0.5), ("d", "tax", 0.9)], "document_id string, normalized_name string, confidence double")
    plan = spark.createDataFrame([("tax", "taxes"), ("tax", "taxed")], "keep string, drop string")
    got = {r.normalized_name: r.aliases for r in topics.merged_topics(names, links, plan).collect()}
    assert got == {"tax": ["Taxes"], "taxed": [], "sea": []}


def test_commands(spark, tmp_path, page_rows):
    engine = Engine(spark, str(tmp_path / "db"), HOSTS, providers.hashing_embedder(32), limits=Limits(5, 40, 5))
    assert set(engine.create_tables(dry_run=True)) == set(engine.views())
    engine.create_tables()
    site = {u.rstrip("/") + "/": h for _, u, h in PAGES}

    def fetch(asked):
        rows = [(r.url, site.get(r.url), None if r.url in site and site[r.url] else "not found") for r in asked.collect()]
        return spark.createDataFrame(rows, "url string, content_html string, reason string")

    docs = engine.crawl(fetch, ["https://law.example/d/fifty", "https://else.example/"], budget=3)
    state = {r.url: (r.state, r.reason) for r in engine.table("frontier").collect()}
    assert state["https://else.example/"] == ("visited", "out_of_scope") and state["https://law.example/d/other/"] == ("failed", "not found") and state["https://law.example/d/fifty/"] == ("visited", None)
    refs = spark.createDataFrame([("none", "AMENDS", None, "50/2020", None)], "source_document_id string, relation_type string, target_document_id string, target_number string, target_document_type string")
    out = engine.ingest(docs, refs)
    one = out["documents"].collect()
    assert len(one) == 1 and "ضريبة" in one[0].contentAr and "Income tax" in one[0].contentEn and out["quarantine"].count() == 0
    assert engine.ingest(docs, refs, dry_run=True)["documents"].count() == 1
    links = {r.normalized_name for r in engine.extract_topics().collect()}
    assert {"taxation", "banking regulation"} <= links and engine.extract_topics().count() == len(links)
    made = engine.embed()
    assert made["chunks"].where("embedding is not null").count() == made["chunks"].count() >= 2 and made["topics"].where("embedding is null").count() == 0
    assert engine.embed()["chunks"].count() == made["chunks"].count()
    assert engine.merge_topics().count() == 0 and engine.merge_topics(0.99, apply=True).count() == 0
    found, quality = engine.communities()
    assert quality.first().n_communities >= 1 and found.count() == len(links) + 1
    for mode in ("bm25", "contains"):
        result = engine.search("income tax of the bank", 5, 2, mode)
        rows = result.results.collect()
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1)) and "Income tax" in rows[0].evidence and set(result.seconds) == {"embed", "vector", "keyword", "merge", "expand", "rerank", "synthesize"}
        assert show(result).startswith("  1") and '"rank":1' in show(result, "json")
    assert engine.describe().where("item = 'rows of documents'").first().value == "1"
    engine.vacuum()
    assert all(len(engine._versions(name)) == 1 for name in engine.views())
    assert spark.sql("select count(*) from documents d join chunks c on c.document_id = d.id").first()[0] >= 2
