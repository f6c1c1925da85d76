"""Upserts, links and merges of the document graph as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.legal import NUMBER, REFERENCE_TYPES, reference_type_label, relation_hint, split_sentences
from qirtas.functions.text import normalize_digits, normalize_document_number, normalize_kind


def upsert(old: DataFrame, new: DataFrame, key: str, order: str, keep_old: tuple[str, ...] = ("created_at",)) -> DataFrame:
    """``old`` with the rows of ``new`` merged in by ``key``.

    Within ``new`` the last non-null value by ``order`` wins; a null never
    replaces a value; ``keep_old`` columns keep what they had. Rows without a key
    are left out.
    """
    columns = [c for c in old.columns if c != key]
    latest = new.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(order, F.col(c).cast("string")))).alias(c) for c in columns]
    )
    left, right = old.where(F.col(key).isNotNull()).alias("o"), latest.alias("n")
    merged = [
        (F.coalesce(f"o.{c}", f"n.{c}") if c in keep_old else F.coalesce(f"n.{c}", f"o.{c}")).alias(c) for c in columns
    ]
    return left.join(right, key, "full_outer").select(key, *merged)


def merge_payloads(payloads: DataFrame) -> DataFrame:
    """One row per id: last non-empty scalars, united maps (the later wins), sorted united URLs."""
    scalars = ["title", "document_type", "number", "issuer", "source_url", "language"]
    filled = lambda c: F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.struct("created_at", F.col(c)))
    entries = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("created_at", F.map_entries("language_urls").alias("m")))), lambda x: x["m"]))
    united = F.map_from_entries(F.transform(F.array_distinct(F.transform(entries, lambda e: e["key"])), lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value"))))
    return payloads.where("id is not null").groupBy("id").agg(
        *[F.max_by(c, filled(c)).alias(c) for c in scalars],
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("pdf_urls")))).alias("pdf_urls"),
        united.alias("language_urls"),
    )


def cross_references(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, relation, number, document_type) of the references a text makes.

    Typed references name a type up to 120 characters before the number; every
    number also gives an untyped one. One row per relation, number and type.
    """
    sentence = texts.select(key, F.explode(split_sentences(normalize_digits(F.col(text)))).alias("s"))
    sentence = sentence.withColumn("relation", relation_hint(F.col("s")))
    typed = "(?i)(" + REFERENCE_TYPES + r")[^.؛\n]{0,120}?" + NUMBER
    found = sentence.where(F.col("s").rlike(r"\d\s*/\s*\d{2}"))
    parts = [F.regexp_extract_all("s", F.lit(typed), F.lit(i)) for i in (1, 2, 3)]
    one = found.select(key, "relation", F.explode(F.arrays_zip(*[p.alias(n) for p, n in zip(parts, "tab")])).alias("m")).select(key, "relation", "m.*")
    with_type = one.select(key, "relation", F.concat("a", F.lit("/"), "b").alias("number"), reference_type_label(F.col("t")).alias("document_type"))
    numbers = F.regexp_extract_all("s", F.lit(r"(\d{1,4}\s*/\s*\d{2,4})"), F.lit(1))
    bare = found.select(key, "relation", F.explode(numbers).alias("n"))
    bare = bare.select(key, "relation", F.regexp_replace("n", r"\s", "").alias("number"), F.lit(None).cast("string").alias("document_type"))
    return with_type.unionByName(bare).distinct()


def link_references(refs: DataFrame, documents: DataFrame) -> DataFrame:
    """(source, relation, target): edges of references that amend or repeal a known document.

    A given id decides; otherwise the number does, with the type only if one is
    given. A document is never linked to itself; each edge comes once.
    """
    docs = documents.select(
        normalize_kind(F.col("id")).alias("target"), normalize_document_number(F.col("number")).alias("number"), normalize_kind(F.col("document_type")).alias("kind")
    ).distinct()
    wanted = refs.select(
        normalize_kind(F.col("source_document_id")).alias("source"), F.upper(F.trim("relation_type")).alias("relation"),
        normalize_kind(F.col("target_document_id")).alias("id"), normalize_document_number(F.col("target_number")).alias("number"),
        normalize_kind(F.col("target_document_type")).alias("kind"),
    ).where("relation in ('AMENDS', 'REPEALS') and source is not null").distinct()
    sources = docs.select(F.col("target").alias("source")).distinct()
    wanted = wanted.join(sources, "source", "left_semi")
    ids = docs.select("target").distinct()
    by_id = wanted.where("id is not null").join(ids, F.col("id") == F.col("target")).select("source", "relation", "target")
    numbered = docs.select("target", "number", F.col("kind").alias("target_kind"))
    by_number = wanted.where("id is null and number is not null").join(numbered, "number").where("kind is null or kind = target_kind").select("source", "relation", "target")
    return by_id.unionByName(by_number).where("source <> target").distinct()


def documents_without_topics(documents: DataFrame, document_topics: DataFrame) -> DataFrame:
    """Documents no topic is linked to, latest date first, missing dates before all."""
    left = documents.select("id", "title", "date").dropDuplicates(["id"])
    topics = document_topics.select(F.col("document_id").alias("id")).distinct()
    return left.join(topics, "id", "left_anti").orderBy(F.desc_nulls_first("date"), "id")


def link_topics(topics: DataFrame, documents: DataFrame, order: str) -> DataFrame:
    """(document_id, normalized_name, confidence): links of known documents; the last by ``order`` overwrites, the most confident on ties."""
    known = topics.join(documents.select(F.col("id").alias("document_id")).distinct(), "document_id", "left_semi")
    return known.groupBy("document_id", "normalized_name").agg(F.max_by("confidence", F.struct(order, "confidence")).alias("confidence"))


def frontier_step(queue: DataFrame, visited: DataFrame, found: DataFrame) -> DataFrame:
    """(url) of the next frontier: queued and found, less visited, each once."""
    return queue.select("url").unionByName(found.select("url")).where("url <> ''").distinct().join(visited.select("url"), "url", "left_anti")


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by ``order``; ties by all columns, so the result is fixed."""
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(order), F.xxhash64(*df.columns))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def cache_split(texts: DataFrame, cache: DataFrame, text: str, provider: str, model: str, dims: int) -> tuple[DataFrame, DataFrame]:
    """(texts found in the embedding cache, texts to embed), by provider, model, size and text hash."""
    key = F.concat(F.lit(f"{provider}:{model}:{dims}:"), F.sha2(F.col(text), 256))
    keyed = texts.withColumn("cache_key", key)
    return keyed.join(cache, "cache_key"), keyed.join(cache.select("cache_key"), "cache_key", "left_anti")
