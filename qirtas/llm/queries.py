"""Queries p1_ to p10_ (but p7_) and, where SQL can state them, their equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.llm import alignment, boilerplate, components, mixing, neighbours, packing, scans, splitting, subjects
from qirtas.plans.sqltext import strip, token_count, topic_name
from qirtas.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_sentences(table(spark, sf_dir, "legal_documents")).select("document_id", "ar_pos", "en_pos")


def p1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_sentences(table(spark, sf_dir, "legal_documents"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.Scans(table(spark, sf_dir, "legal_documents")).defects()


def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.Scans(table(spark, sf_dir, "legal_documents")).paragraphs()


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit, overlap = splitting.size_limit(table(spark, sf_dir, "size_limits"), "piece")
    return splitting.split_texts(splitting.legal_texts(table(spark, sf_dir, "legal_documents")), limit, overlap)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_pieces(spark, sf_dir).where("piece_no = 0 and n_pieces > 1").select("document_id", "language")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_runs(table(spark, sf_dir, "parsed_documents")).select("page_id", "run_no")


def p4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_texts(table(spark, sf_dir, "parsed_documents"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.topic_groups(table(spark, sf_dir, "topic_merge_candidates"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = neighbours.embeddings(table(spark, sf_dir, "chunks"), table(spark, sf_dir, "topics"))
    return neighbours.MultiIndex(vectors).pairs(5)


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    capacity, _ = splitting.size_limit(table(spark, sf_dir, "size_limits"), "container")
    return packing.pack_documents(table(spark, sf_dir, "documents"), capacity)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_containers(spark, sf_dir).where("piece = 1").select("doc_id").distinct()


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = p8_containers(spark, sf_dir).groupBy("container").agg(F.sum("length").alias("filled"), F.count("*").alias("items"))
    return filled.groupBy("filled").agg(F.count("*").alias("n_containers"), F.sum("items").alias("n_items"))


def _mixture(spark: SparkSession, sf_dir: str) -> mixing.Mixture:
    return mixing.Mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.short_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir).rows()


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir).report()


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_labels")).select("doc_id", "subject")


def p10_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.composition(p10_found(spark, sf_dir), table(spark, sf_dir, "documents"))


QUERIES = {
    "p1_found": p1_found, "p1_pairs": p1_pairs,
    "p2_found": p2_found, "p2_paragraphs": p2_paragraphs,
    "p3_found": p3_found, "p3_pieces": p3_pieces,
    "p4_found": p4_found, "p4_texts": p4_texts,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p8_found": p8_found, "p8_containers": p8_containers, "p8_report": p8_report,
    "p9_found": p9_found, "p9_mixture": p9_mixture, "p9_shares": p9_shares,
    "p10_found": p10_found, "p10_composition": p10_composition,
}

_SOURCE = f"lower({strip('source')})"
ORACLES = {
    "p3_found": f"""
SELECT DISTINCT document_id, language FROM (
  SELECT id AS document_id, 'ar' AS language, contentAr AS text FROM legal_documents
  UNION ALL SELECT id, 'en', contentEn FROM legal_documents)
WHERE {token_count('text')} > (SELECT max_tokens FROM size_limits WHERE purpose = 'piece')""",
    "p5_found": f"""
WITH RECURSIVE pairs AS (
  SELECT * FROM (SELECT {topic_name('keep_normalized_name')} AS a, {topic_name('drop_normalized_name')} AS b
                 FROM topic_merge_candidates
                 WHERE keep_normalized_name IS NOT NULL AND drop_normalized_name IS NOT NULL)
  WHERE a <> '' AND b <> ''),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT a AS name, a AS other FROM edges
          UNION SELECT r.name, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT name AS normalized_name, min(other) AS group_name FROM reach GROUP BY name""",
    "p8_found": f"""
SELECT doc_id FROM documents
WHERE {token_count('text')} > (SELECT max_tokens FROM size_limits WHERE purpose = 'container')""",
    "p9_found": f"""
WITH sized AS (SELECT {_SOURCE} AS source, {token_count('text')} AS n FROM documents WHERE {strip('source')} <> '')
SELECT m.source FROM (SELECT {_SOURCE} AS source, target_share, max_repeats FROM mix_targets) m
LEFT JOIN (SELECT source, sum(n) AS own FROM sized GROUP BY source) s ON s.source = m.source
WHERE m.target_share * (SELECT sum(n) FROM sized) > m.max_repeats * coalesce(s.own, 0)""",
}
