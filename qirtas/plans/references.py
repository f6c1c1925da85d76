"""Queries on cross references and their equivalents in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qirtas.operators.references import orphan_references, orphan_report
from qirtas.plans.sqltext import doc_number, kind
from qirtas.session import table


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("cross_references", "legal_documents", "core_instruments", "withdrawn_documents")
    return orphan_references(*(table(spark, sf_dir, n) for n in names))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_report(p7_found(spark, sf_dir))


P7_FOUND_SQL = f"""
WITH gone AS (
  SELECT {kind('document_id')} AS id, min(withdrawn_at) AS died FROM withdrawn_documents
  WHERE document_id IS NOT NULL AND withdrawn_at IS NOT NULL GROUP BY 1),
targets AS (
  SELECT p.id, p.number, p.kind, b.born, g.died
  FROM (SELECT DISTINCT {kind('id')} AS id, {doc_number('number')} AS number, {kind('document_type')} AS kind
        FROM (SELECT id, number, document_type FROM legal_documents
              UNION ALL SELECT id, number, document_type FROM core_instruments)) p
  JOIN (SELECT {kind('id')} AS id, min(try_cast(created_at AS TIMESTAMPTZ)) AS born
        FROM (SELECT id, created_at FROM legal_documents
              UNION ALL SELECT id, created_at FROM core_instruments) GROUP BY 1) b ON p.id = b.id
  LEFT JOIN gone g ON g.id = p.id),
refs AS (
  SELECT DISTINCT ref_id, extracted_at, {kind('target_document_id')} AS id,
         {doc_number('target_number')} AS number, {kind('target_document_type')} AS kind
  FROM cross_references WHERE ref_id IS NOT NULL AND extracted_at IS NOT NULL),
pairs AS (
  SELECT r.ref_id, r.extracted_at, t.id AS hit, t.born, t.died FROM refs r JOIN targets t ON r.id = t.id
  UNION ALL
  SELECT r.ref_id, r.extracted_at, t.id, t.born, t.died FROM refs r JOIN targets t ON r.number = t.number
  WHERE r.id IS NULL AND (r.kind IS NULL OR r.kind = t.kind)
  UNION ALL
  SELECT ref_id, extracted_at, NULL, NULL, NULL FROM refs WHERE id IS NOT NULL OR number IS NOT NULL)
SELECT ref_id, strftime(extracted_at AT TIME ZONE 'UTC', '%Y-%m') AS period,
       CASE WHEN count(hit) = 0 THEN 'missing'
            WHEN max(born) > extracted_at THEN 'late' ELSE 'deleted' END AS reason
FROM pairs GROUP BY ref_id, extracted_at
HAVING NOT coalesce(bool_or(born <= extracted_at AND (died IS NULL OR died > extracted_at)), FALSE)
"""

QUERIES = {"p7_found": p7_found, "p7_report": p7_report}
ORACLES = {
    "p7_found": P7_FOUND_SQL,
    "p7_report": f"SELECT period, reason, count(*) AS n_refs FROM ({P7_FOUND_SQL}) GROUP BY period, reason",
}
