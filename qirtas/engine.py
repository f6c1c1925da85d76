"""The engine's surface: one object over a folder of tables, with a method per command.

Tables are Parquet below ``root`` (``documents``, ``topics``, ``chunks``,
``document_topics``, ``document_edges``, ``embedding_cache``, ``frontier``), registered as
temporary views, so Spark SQL works on all of them. Methods that write take
``dry_run``, with which they only return what they would write.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.operators import graph as G
from qirtas.operators import ingest as I
from qirtas.operators import pages as P
from qirtas.operators import retrieval as R
from qirtas.operators import topics as T
from qirtas.operators.chunking import Limits, chunk_documents
from qirtas.providers import Embedder, embed_texts, hashing_embedder, topic_answers, topic_prompt
from qirtas.session import cut
from qirtas.sources import documents as S

log = logging.getLogger(__name__)
SCHEMAS = {
    "documents": "id string, title string, title_ar string, title_en string, title_fr string, date string, document_type string, number string, issuer string, "
    "source_url string, language string, contentAr string, contentEn string, contentFr string, created_at string, updated_at string",
    "topics": "normalized_name string, name string, embedding array<double>, confidence double, evidence string, source string, aliases array<string>, created_at string, updated_at string",
    "chunks": "id string, document_id string, language string, text string, chunk_index int, embedding array<double>, heading_context array<string>, token_count int, created_at string, updated_at string",
    "document_topics": "document_id string, normalized_name string, confidence double",
    "document_edges": "source string, relation string, target string",
    "embedding_cache": "cache_key string, provider string, model string, dimensions int, vector array<double>",
    "frontier": "url string, state string, reason string",
}
#: The key of each table that has a unique one.
KEYS = {"documents": "id", "topics": "normalized_name", "chunks": "id", "embedding_cache": "cache_key", "frontier": "url"}


@dataclass
class SearchResult:
    """Ranked results, the answer's text, and the seconds of each stage."""

    results: DataFrame
    answer: str
    seconds: dict[str, float] = field(default_factory=dict)


@dataclass
class Engine:
    spark: SparkSession
    root: str
    hosts: P.Hosts = P.Hosts(())
    embedder: Embedder = field(default_factory=lambda: hashing_embedder(384))
    scorer: Callable | None = None
    writer: Callable | None = None
    topic_model: Callable[[str], str] | None = None
    limits: Limits = Limits()

    # Tables -----------------------------------------------------------------

    def _folder(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self, name: str) -> list[int]:
        """The complete versions of a table. A write makes a new one, so whoever reads the one before still can."""
        fs, path = self._folder(f"{self.root}/{name}/v*/_SUCCESS")
        return sorted(int(s.getPath().getParent().getName()[1:]) for s in fs.globStatus(path) or [])

    def vacuum(self, keep: int = 1) -> None:
        """Delete all versions of every table but the last ``keep``."""
        for name in SCHEMAS:
            for version in self._versions(name)[: -max(1, keep)]:
                fs, path = self._folder(f"{self.root}/{name}/v{version}")
                fs.delete(path, True)

    def table(self, name: str) -> DataFrame:
        """The table, empty if it has not been written yet."""
        versions = self._versions(name)
        if versions:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}/v{versions[-1]}")
        return self.spark.createDataFrame([], SCHEMAS[name])

    def _write(self, name: str, df: DataFrame, dry_run: bool) -> DataFrame:
        """``df`` in the table's columns, missing ones null; written unless it is a dry run."""
        fields = self.spark.createDataFrame([], SCHEMAS[name]).schema
        out = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        if dry_run:
            return out
        # A version that was begun and not finished is written over.
        out.write.mode("overwrite").parquet(f"{self.root}/{name}/v{max(self._versions(name), default=0) + 1}")
        return self.table(name)

    def views(self) -> list[str]:
        """Register every table as a temporary view of its name."""
        for name in SCHEMAS:
            self.table(name).createOrReplaceTempView(name)
        return sorted(SCHEMAS)

    # Commands ---------------------------------------------------------------

    def describe(self) -> DataFrame:
        """(item, value): settings and row counts; no secret is among them."""
        settings = {
            "root": self.root, "spark": self.spark.version, "embedder": f"{self.embedder.provider}:{self.embedder.model}:{self.embedder.dims}",
            "scorer": "given" if self.scorer else "none", "writer": "given" if self.writer else "none", "topic_model": "given" if self.topic_model else "none",
            "chunk_tokens": f"{self.limits.least}-{self.limits.most}, overlap {self.limits.overlap}",
        }
        rows = self.spark.createDataFrame(sorted(settings.items()), "item string, value string")
        counts = I.counters(**{name: self.table(name) for name in SCHEMAS})
        return rows.unionByName(counts.select(F.concat(F.lit("rows of "), "step").alias("item"), F.col("n").cast("string").alias("value")))

    def create_tables(self, dry_run: bool = False) -> dict[str, str]:
        """Missing tables are created empty; the schemas of all. Repeated keys of existing ones raise an error."""
        for name, key in KEYS.items():
            if self._versions(name) and self.table(name).groupBy(key).count().where("count > 1").limit(1).count():
                raise ValueError(f"{name}.{key} is not unique")
        for name, schema in SCHEMAS.items():
            if not dry_run and not self._versions(name):
                self._write(name, self.spark.createDataFrame([], schema), False)
        return dict(SCHEMAS)

    def scrape(self, pages: DataFrame, now: str | None = None) -> DataFrame:
        """Fetched pages (page_id, source_url, content_html) as documents with the contents of linked language versions.

        Pages that are no documents only lend their links.
        """
        parsed = cut(P.parse_documents(pages, self.hosts))
        links = P.discovered_links(parsed.select("page_id", F.posexplode("links").alias("pos", "l")).select("page_id", "pos", "l.url", "l.text"), self.hosts)
        versions = links.where("kind = 'language'").join(parsed.select("page_id", "id"), "page_id").select("id", "language", "url")
        merged = P.merge_language_versions(parsed, versions).select("id", "title_ar", "title_en", "contentAr", "contentEn", "linked_language_merged")
        u = F.col("source_url")
        ours = P.Hosts.matches(P.urls.host(u), self.hosts.documents)
        documents = parsed.where(P.urls.is_document(u, ours, P.Hosts.matches(P.urls.host(u), self.hosts.pdfs)))
        one = documents.groupBy("id").agg(*[F.max(c).alias(c) for c in ("title", "date", "document_type", "number", "issuer", "source_url", "language")])
        return one.join(merged, "id").withColumns({"created_at": F.lit(now), "updated_at": F.lit(now)})

    def crawl(self, fetch: Callable[[DataFrame], DataFrame], start: list[str], budget: int, reset: bool = False, dry_run: bool = False) -> DataFrame:
        """Documents of up to ``budget`` fetched pages, breadth first from ``start`` and the stored frontier.

        ``fetch`` maps (url) to (url, content_html, reason), with a reason and no
        content where it failed; it is the only part that meets a network. A URL that is out of scope, fetched or failed is
        visited and not asked for again.
        """
        known = self.spark.createDataFrame([], SCHEMAS["frontier"]) if reset else self.table("frontier")
        seeds = self.spark.createDataFrame([(u,) for u in start], "url string").select(P.urls.canonical_url(F.col("url"), 6).alias("url"))
        queue, visited, found = seeds.unionByName(known.where("state = 'queued'").select("url")), known.where("state <> 'queued'"), []
        left = budget
        while left > 0:
            step = G.frontier_step(queue, visited, queue.limit(0))
            step = cut(step.withColumn("allowed", P.is_crawlable(F.col("url"), self.hosts)))
            outside = step.where("not allowed").select("url", F.lit("visited").alias("state"), F.lit("out_of_scope").alias("reason"))
            asked = cut(step.where("allowed").select("url").orderBy("url").limit(left))
            if asked.isEmpty():
                visited = cut(visited.unionByName(outside))
                queue = queue.limit(0)
                break
            got = cut(fetch(asked))
            good = got.where("reason is null and content_html is not null")
            done = got.select("url", F.when(F.col("reason").isNull(), "visited").otherwise("failed").alias("state"), "reason")
            visited = cut(visited.unionByName(outside).unionByName(done))
            pages = good.select(F.xxhash64("url").alias("page_id"), F.col("url").alias("source_url"), "content_html")
            found.append(pages)
            raw = P.read_pages(pages).select("page_id", F.posexplode("links").alias("pos", "l")).select("page_id", "pos", "l.url", "l.text")
            rest = step.where("allowed").select("url").join(asked, "url", "left_anti")
            queue = cut(rest.unionByName(P.crawlable_urls(P.discovered_links(raw, self.hosts))))
            left -= good.count()
        waiting = G.frontier_step(queue, visited, queue.limit(0)).select("url", F.lit("queued").alias("state"), F.lit(None).cast("string").alias("reason"))
        self._write("frontier", visited.unionByName(waiting), dry_run)
        pages = found[0] if found else self.spark.createDataFrame([], "page_id long, source_url string, content_html string")
        for more in found[1:]:
            pages = pages.unionByName(more)
        return self.scrape(pages)

    def ingest(self, incoming: DataFrame, references: DataFrame, dry_run: bool = False) -> dict[str, DataFrame]:
        """Documents upserted, then references linked; rows with errors are quarantined."""
        columns = self.table("documents").columns
        rows = incoming.select(*[F.col(c) if c in incoming.columns else F.lit(None).cast("string").alias(c) for c in columns])
        out = I.ingest(self.table("documents"), rows, references)
        documents = self._write("documents", out["documents"], dry_run)
        edges = G.link_references(references, documents)
        return {"documents": documents, "edges": self._write("document_edges", edges, dry_run), "quarantine": out["quarantine"]}

    def extract_topics(self, only_without_topics: bool = True, limit: int | None = None, dry_run: bool = False) -> DataFrame:
        """Topics of documents by the model's answers where there is one and they parse, else by rules; linked and stored."""
        links = self.table("document_topics")
        docs = I.scan_documents(self.table("documents"), limit, links if only_without_topics else None)
        docs = docs.withColumn("content", S.best_content(("contentEn", "contentAr")))
        found = T.extract_topics(docs, "id", "title", "content").withColumnRenamed("id", "document_id")
        if self.topic_model is not None:
            answers = cut(topic_answers(docs, "id", topic_prompt(F.col("title"), F.col("content")), self.topic_model))
            parsed = answers.select(F.col("id").alias("document_id"), T.parse_topic_json(F.col("raw")).alias("t")).where("t is not null")
            rows = parsed.select("document_id", F.posexplode("t").alias("pos", "t")).select("document_id", "pos", "t.*", F.lit("model").alias("source"))
            rows = T.filter_topics(rows, "document_id")
            found = rows.unionByName(found.join(parsed.select("document_id"), "document_id", "left_anti"))
        found = cut(found)
        new = G.link_topics(found.withColumn("run", F.lit(1)).unionByName(links.withColumns({"run": F.lit(0), "name": F.lit(None), "source": F.lit(None)})), self.table("documents"), "run")
        best = found.groupBy("normalized_name").agg(*[F.max_by(c, "confidence").alias(c) for c in ("name", "source")], F.max("confidence").alias("confidence"))
        fields = [c for c in self.table("topics").columns if c not in best.columns]
        types = dict(self.table("topics").dtypes)
        best = best.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in fields])
        topics = I.upsert_topics(self.table("topics"), best)
        self._write("topics", topics, dry_run)
        return self._write("document_topics", new, dry_run)

    def embed(self, limit: int | None = None, dry_run: bool = False) -> dict[str, DataFrame]:
        """Chunks of all contents with vectors, and vectors of the topics that lack one; vectors are cached."""
        texts = S.contents_by_language(I.scan_documents(self.table("documents"), limit)).withColumnRenamed("id", "document_id")
        made = cut(chunk_documents(texts, self.limits).withColumnRenamed("chunk_id", "id"))
        names = I.topics_without_embedding(self.table("topics")).select("normalized_name", F.coalesce("name", "normalized_name").alias("text"))
        both = made.select("id", "text").withColumn("kind", F.lit("chunk")).unionByName(names.select(F.col("normalized_name").alias("id"), "text").withColumn("kind", F.lit("topic")))
        vectors, fresh = embed_texts(both, "text", self.embedder, self.table("embedding_cache"))
        vectors, fresh = cut(vectors), cut(fresh)
        cache = self.table("embedding_cache").unionByName(fresh).dropDuplicates(["cache_key"])
        chunks = made.join(vectors.where("kind = 'chunk'").groupBy("id").agg(F.max("embedding").alias("embedding")), "id").withColumns({"created_at": F.lit(None).cast("string"), "updated_at": F.lit(None).cast("string")})
        # A text that is chunked again replaces the chunks it had.
        again = texts.select("document_id", "language").distinct()
        old = self.table("chunks").join(again, ["document_id", "language"], "left_anti").select(self.table("chunks").columns)
        chunks = I.upsert_chunks(old, chunks, self.table("documents"), "chunk_index")
        topics = I.set_topic_embeddings(self.table("topics"), vectors.where("kind = 'topic'").select(F.col("id").alias("normalized_name"), "embedding"))
        return {"chunks": self._write("chunks", chunks, dry_run), "topics": self._write("topics", topics, dry_run), "embedding_cache": self._write("embedding_cache", cache, dry_run)}

    def merge_topics(self, threshold: float = 0.88, apply: bool = False) -> DataFrame:
        """The merge plan; with ``apply`` links are moved and dropped topics become aliases."""
        topics = self.table("topics")
        plan = cut(T.merge_plan(T.groups_of(T.topic_pairs(topics, threshold, self.embedder.dims)), topics))
        if apply:
            links = self.table("document_topics")
            merged = T.merged_topics(topics.drop("aliases"), links, plan)
            moved = cut(T.apply_merge(links, plan))
            self._write("topics", merged, False)
            self._write("document_topics", moved, False)
        return plan.orderBy(F.desc("similarity"), "keep", "drop")

    def communities(self) -> tuple[DataFrame, DataFrame]:
        """((name, community), (modularity, n_communities)) of documents and topics."""
        edges = self.table("document_topics").select(F.concat(F.lit("d:"), "document_id").alias("x"), F.concat(F.lit("t:"), "normalized_name").alias("y"))
        found = cut(T.communities(edges))
        return found, T.modularity(edges, found)

    def search(self, query: str, top_k: int = 50, top_n: int = 5, mode: str = "bm25") -> SearchResult:
        """Ranked results with context and evidence, an answer, and timings."""
        seconds, chunks = {}, self.table("chunks")

        def timed(stage: str, make: Callable[[], DataFrame]) -> DataFrame:
            began = time.perf_counter()
            out = cut(make())
            seconds[stage] = round(time.perf_counter() - began, 4)
            return out

        began = time.perf_counter()
        vector = embed_texts(self.spark.createDataFrame([(query,)], "q string"), "q", self.embedder)[0].first()["embedding"]
        seconds["embed"] = round(time.perf_counter() - began, 4)
        by_vector = timed("vector", lambda: R.vector_search(chunks, vector, top_k, self.embedder.dims))
        by_keyword = timed("keyword", lambda: R.keyword_search(chunks, query, top_k, mode))
        merged = timed("merge", lambda: R.merge_candidates(by_vector, by_keyword, top_k))
        full = timed("expand", lambda: R.expand(merged, chunks, self.table("documents"), lambda d: self.table("document_topics").join(d.select(F.col("id").alias("document_id")), "document_id", "left_semi")))
        scored = R.score_pairs(full, query, self.scorer)
        best = timed("rerank", lambda: R.ranked(R.rerank(scored, F.col("raw_score"), R.candidate_score(scored.columns), top_n)))
        results = best.withColumn("evidence", R.best_evidence(F.col("text"), query)).withColumn("label", R.document_label(F.col("title"), F.col("number"), F.col("date")))
        began = time.perf_counter()
        text = R.answer(results, query, self.writer)
        seconds["synthesize"] = round(time.perf_counter() - began, 4)
        return SearchResult(results.orderBy("rank"), text, seconds)


def show(result: SearchResult, form: str = "table", n: int = 20) -> str:
    """Results as JSON lines, or as a table of rank, score, label and preview."""
    if form == "json":
        return "\n".join(result.results.limit(n).toJSON().collect())
    rows = result.results.select("rank", F.round("combined_score", 4).alias("score"), "label", "evidence").limit(n).collect()
    return "\n".join([*(f"{r.rank:>3}  {r.score:<7} {r.label}  {r.evidence}" for r in rows), "", result.answer])
