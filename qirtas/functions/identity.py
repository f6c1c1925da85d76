"""Deterministic identities of documents and chunks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qirtas.functions.text import normalize_document_number, normalize_identity, strip
from qirtas.functions.urls import canonical_url


def stable_hash(c: Column, length: int = 16) -> Column:
    """A prefix of the SHA-1 in hex; null for null and empty."""
    return F.when(c != "", F.substring(F.sha1(c), 1, length))


def _given(c: Column) -> Column:
    return F.when(c != "", c)


def document_id(source_url: Column, title: Column, document_type: Column, number: Column) -> Column:
    """Type and number if both are known, else the URL, else the title; null if none is."""
    kind, n = _given(normalize_identity(document_type)), normalize_document_number(number)
    basis = F.coalesce(
        F.concat(F.lit("legal-document:"), kind, F.lit(":"), n),
        F.when(source_url != "", F.concat(F.lit("legal-document:url:"), canonical_url(source_url))),
        F.when(title != "", F.concat(F.lit("legal-document:title:"), normalize_identity(title))),
    )
    return F.concat(F.lit("doc-"), stable_hash(basis))


def page_document_id(source_url: Column, title: Column, document_type: Column, number: Column) -> Column:
    """The identity a page gives itself: raw type and number, else URL and title."""
    basis = F.coalesce(
        F.concat(_given(document_type), F.lit(":"), _given(number)),
        F.concat(canonical_url(source_url, 6), F.lit(":"), F.coalesce(title, F.lit(""))),
    )
    return F.concat(F.lit("doc-"), F.substring(F.sha1(F.lower(basis)), 1, 16))


def chunk_id(document: Column, language: Column, index: Column, text: Column) -> Column:
    basis = F.concat(
        F.lit("chunk:"), document, F.lit(":"), language, F.lit(":"), index.cast("string"), F.lit(":"), stable_hash(strip(text), 20)
    )
    return F.concat(F.lit("chunk-"), stable_hash(basis, 24))
