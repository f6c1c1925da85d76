"""Splitting oversized texts at natural boundaries.

Every gap between two tokens has a strength. A sparse table over the strengths
answers in constant time where the strongest gap of a window is, the rightmost
on ties. A piece ends at the strongest gap of its permissible lengths; the next
begins ``overlap`` tokens before that end.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.functions.text import token_count

_TOKEN = re.compile(r"[\w؀-ۿ]+|[^\s]")
#: Strengths of a gap, the strongest kind that applies.
HEADING, PARAGRAPH, LINE, SENTENCE, CLAUSE, SPACE, NONE = 6, 5, 4, 3, 2, 1, 0
_SENTENCE_END, _CLAUSE_END = frozenset(".!?؟"), frozenset(",;:،؛")

SCHEMA = "document_id string, language string, piece_no int, n_pieces int, n_tokens int, first_token int, text string"


def boundary_strengths(text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The strength of the gap before each token; that before the first is ``NONE``."""
    out = np.zeros(len(starts), np.int8)
    for i in np.flatnonzero(starts[1:] > ends[:-1]) + 1:
        gap = text[ends[i - 1] : starts[i]]
        lines = gap.count("\n")
        if lines and text[starts[i]] == "#":
            out[i] = HEADING
        elif lines > 1:
            out[i] = PARAGRAPH
        elif lines:
            out[i] = LINE
        else:
            last = text[ends[i - 1] - 1]
            out[i] = SENTENCE if last in _SENTENCE_END else CLAUSE if last in _CLAUSE_END else SPACE
    return out


class RangeMaximum:
    """Sparse table: where in [lo, hi] the greatest value is, the rightmost on ties."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.levels = [np.arange(len(values))]
        width = 1
        while 2 * width <= len(values):
            a, b = self.levels[-1][:-width], self.levels[-1][width:]
            self.levels.append(np.where(values[a] > values[b], a, b))
            width *= 2

    def query(self, lo: int, hi: int) -> int:
        k = (hi - lo + 1).bit_length() - 1
        a, b = self.levels[k][lo], self.levels[k][hi - (1 << k) + 1]
        return int(a if self.values[a] > self.values[b] else b)


def cuts(strengths: np.ndarray, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(first, end) token of each piece, none longer than ``limit``.

    A piece that is not the last has at least half the limit, and more tokens
    than the overlap, so every piece brings something new.
    """
    n, first, out = len(strengths), 0, []
    table = RangeMaximum(strengths)
    least = max(limit // 2, overlap + 1)
    while n - first > limit:
        end = table.query(first + least, first + limit)
        out.append((first, end))
        first = end - overlap
    out.append((first, n))
    return out


def split_texts(texts: DataFrame, limit: int, overlap: int) -> DataFrame:
    """The pieces of every text (document_id, language, text) of more than ``limit`` tokens.

    Texts within the limit, blank and null ones give no rows. Repeated rows of
    one (document_id, language) count once, the greatest text winning. A text
    without any boundary is cut between tokens at the limit. ``overlap`` must be
    less than ``limit``.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than the limit")
    oversized = (
        texts.where(token_count(F.col("text")) > limit)
        .groupBy("document_id", "language").agg(F.max("text").alias("text"))
    )

    def split(batches):
        for pdf in batches:
            rows = []
            for key, language, text in zip(pdf["document_id"], pdf["language"], pdf["text"]):
                spans = np.array([m.span() for m in _TOKEN.finditer(text)], np.int64)
                starts, ends = spans[:, 0], spans[:, 1]
                pieces = cuts(boundary_strengths(text, starts, ends), limit, overlap)
                rows += [
                    (key, language, i, len(pieces), b - a, a, text[starts[a] : ends[b - 1]])
                    for i, (a, b) in enumerate(pieces)
                ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return oversized.mapInPandas(split, SCHEMA)


def legal_texts(legal: DataFrame) -> DataFrame:
    """(document_id, language, text) of ``contentAr`` and ``contentEn``."""
    both = F.array(
        F.struct(F.lit("ar").alias("language"), F.col("contentAr").alias("text")),
        F.struct(F.lit("en").alias("language"), F.col("contentEn").alias("text")),
    )
    return legal.select(F.col("id").alias("document_id"), F.explode(both).alias("t")).select("document_id", "t.*")


def size_limit(limits: DataFrame, purpose: str) -> tuple[int, int] | None:
    """(max_tokens, overlap_tokens) of a purpose from the table of limits."""
    row = limits.where(F.col("purpose") == purpose).select("max_tokens", "overlap_tokens").first()
    return (row[0], row[1] or 0) if row and row[0] else None
