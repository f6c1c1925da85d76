"""Writing the graph: document, topic and chunk rows, links, scans and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.functions.text import normalize_document_number, normalize_topic_name
from qirtas.operators import graph as G
from qirtas.sources.documents import document_errors, validate, with_markdown

DOCUMENT_COLUMNS = (
    "id", "title", "title_ar", "title_en", "title_fr", "date", "document_type", "number", "issuer", "source_url", "language",
    "contentAr", "contentEn", "contentFr", "created_at", "updated_at",
)
#: Nested columns, which a property graph holds as JSON text.
JSON_COLUMNS = ("language_urls", "pdf_urls", "raw_paths", "metadata", "cross_references")


def sorted_json(c: Column, kind: str) -> Column:
    """A map as JSON with its keys in order, anything else as it is; null becomes an empty object or array."""
    if kind == "map":
        entries = F.array_sort(F.map_entries(c))
        return F.coalesce(F.to_json(F.map_from_entries(entries)), F.lit("{}"))
    return F.coalesce(F.to_json(c), F.lit("[]"))


def document_rows(documents: DataFrame) -> DataFrame:
    """The row of each document as a graph stores it: normalised number, nested columns as JSON text."""
    types = dict(documents.dtypes)
    plain = [F.col(c) for c in DOCUMENT_COLUMNS if c in types and c != "number"]
    nested = [sorted_json(F.col(c), types[c][:3]).alias(f"{c}_json") for c in JSON_COLUMNS if c in types]
    return documents.select(*plain, normalize_document_number(F.col("number")).alias("number"), *nested)


def topic_rows(topics: DataFrame) -> DataFrame:
    """Topic rows by key; names without a key are left out, confidences are held between 0 and 1."""
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col("confidence"), F.lit(0.5))))
    return topics.withColumns({"normalized_name": normalize_topic_name(F.col("name")), "confidence": confidence}).where("normalized_name <> ''")


def upsert_topics(old: DataFrame, new: DataFrame, order: str = "updated_at") -> DataFrame:
    return G.upsert(old, new, "normalized_name", order)


def upsert_chunks(old: DataFrame, new: DataFrame, documents: DataFrame, order: str) -> DataFrame:
    """``old`` chunks with ``new`` ones of known documents written over them.

    All columns are overwritten, with nulls too, but for ``embedding``, which a
    null does not replace, and ``created_at``, which stays. Of several new rows of an
    id the last by ``order`` counts; chunks of unknown documents and without an id are left out.
    """
    columns = [c for c in old.columns if c != "id"]
    known = new.where("id is not null").join(documents.select(F.col("id").alias("document_id")).distinct(), "document_id", "left_semi")
    latest = known.groupBy("id").agg(F.max(F.struct(order, *[c for c in columns if c != order])).alias("r")).select("id", *[F.col("r")[c].alias(c) for c in columns], F.lit(True).alias("_new"))
    both = old.where("id is not null").alias("o").join(latest.alias("n"), "id", "full_outer")

    def merged(c: str) -> Column:
        if c == "created_at":
            return F.coalesce(f"o.{c}", f"n.{c}")
        if c == "embedding":
            return F.coalesce(f"n.{c}", f"o.{c}")
        return F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    return both.select("id", *[merged(c).alias(c) for c in columns])


def set_topic_embeddings(topics: DataFrame, vectors: DataFrame) -> DataFrame:
    """``topics`` with the embeddings of ``vectors`` (normalized_name, embedding) set; empty ones are rejected, unknown names left out."""
    given = vectors.where(F.size("embedding") > 0).groupBy("normalized_name").agg(F.max("embedding").alias("_vector"))
    joined = topics.join(given, "normalized_name", "left")
    return joined.withColumn("embedding", F.coalesce("_vector", "embedding")).drop("_vector")


def topics_without_embedding(topics: DataFrame) -> DataFrame:
    """(normalized_name, name) of topics without a vector, by name, a missing name last."""
    return topics.where(F.col("embedding").isNull()).groupBy("normalized_name").agg(F.max("name").alias("name")).orderBy(F.asc_nulls_last("name"), "normalized_name")


def topics_with_embedding(topics: DataFrame) -> DataFrame:
    """(normalized_name, name, embedding) of topics with a vector that is not empty, by key."""
    rows = topics.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0))
    return rows.groupBy("normalized_name").agg(F.max("name").alias("name"), F.max("embedding").alias("embedding")).orderBy("normalized_name")


SCANNED = ("id", "title", "date", "document_type", "number", "issuer", "language", "contentAr", "contentEn", "contentFr")


def scan_documents(documents: DataFrame, limit: int | None = None, document_topics: DataFrame | None = None) -> DataFrame:
    """The columns that later steps read, one row per id, latest date first and missing dates before all.

    With ``document_topics`` only documents without a topic; ``limit`` is the caller's.
    """
    if document_topics is not None:
        documents = documents.join(document_topics.select(F.col("document_id").alias("id")).distinct(), "id", "left_anti")
    one = documents.where("id is not null").groupBy("id").agg(*[F.max(c).alias(c) for c in SCANNED if c != "id"])
    ordered = one.select(*SCANNED).orderBy(F.desc_nulls_first("date"), "id")
    return ordered if limit is None else ordered.limit(limit)


def to_documents(parsed: DataFrame) -> DataFrame:
    """Parsed documents (one Markdown each) as documents: Markdown becomes the language's content, metadata say where they come from."""
    rows = with_markdown(parsed)
    origin = F.map_from_arrays(F.array(F.lit("parsed_at"), F.lit("converted_from")), F.array(F.col("parsed_at").cast("string"), F.lit("ParsedDocument")))
    own = F.map_filter(F.coalesce(F.col("metadata"), F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin("parsed_at", "converted_from"))
    return rows.withColumn("metadata", F.map_concat(own, origin)).drop("markdown", "parsed_at")


def ingest(old: DataFrame, incoming: DataFrame, references: DataFrame, order: str = "updated_at") -> dict[str, DataFrame]:
    """Two phases: all valid documents are upserted before any reference is linked.

    ``documents``, ``edges`` (source, relation, target) and ``quarantine`` (with ``errors``).
    """
    good, bad = validate(incoming, document_errors())
    documents = G.upsert(old, good, "id", order)
    return {"documents": documents, "edges": G.link_references(references, documents), "quarantine": bad}


def edge_counts(edges: DataFrame) -> DataFrame:
    """(relation, n_edges, n_sources, n_targets) of linked references."""
    return edges.groupBy("relation").agg(F.count("*").alias("n_edges"), F.countDistinct("source").alias("n_sources"), F.countDistinct("target").alias("n_targets"))


def counters(**tables: DataFrame) -> DataFrame:
    """(step, n): how many rows each step has made, counted in one job each."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("step"), "n") for name, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
