"""Heading-aware chunks of Markdown: cut positions over token offsets, in an Arrow-batched function.

A text is tokenised once. Its sections are spans of tokens with a heading path;
how many of them fit into a chunk is a search in the running totals of their
sizes. Texts are put together last, from the positions.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[\w؀-ۿ]+|[^\s]")
_HEADING = re.compile(r"^[^\S\n]*(#{1,6})[^\S\n]+(\S.*?)[^\S\n]*$", re.M)
_GAP = re.compile(r"\n[^\S\n]*\n\s*")
#: Tokens that a piece of an oversized section has room for at least, however long its headings.
LEAST_ROOM = 50
SCHEMA = "document_id string, language string, chunk_index int, chunk_id string, text string, token_count int, heading_context array<string>"


class Limits(NamedTuple):
    """``least`` is accepted and has no effect on packing."""

    least: int = 500
    most: int = 900
    overlap: int = 120

    def checked(self) -> "Limits":
        if not 0 < self.least <= self.most or not 0 <= self.overlap < self.most:
            raise ValueError("limits must satisfy 0 < least <= most and 0 <= overlap < most")
        return self


class Span(NamedTuple):
    """Characters ``start`` to ``end``, which hold the tokens ``first`` to ``last``, below the headings ``path``."""

    start: int
    end: int
    first: int
    last: int
    path: tuple[str, ...]


def head_line(path: tuple[str, ...]) -> str:
    return "Context: " + " > ".join(path) if path else ""


class Piece(NamedTuple):
    """A chunk before its text is put together: ``blocks`` below one line of headings each, or the tokens of ``window``.

    ``carried`` tokens of the piece before stand in front of it.
    """

    blocks: tuple[tuple[Span, ...], ...]
    path: tuple[str, ...]
    carried: int = 0
    window: tuple[int, int] | None = None


def tidy(text: str) -> str:
    text = text.replace("\r\n", "\n").replace("\r", "\n").replace(" ", " ")
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", text)).strip()


def count(text: str) -> int:
    return sum(1 for _ in TOKEN.finditer(text))


def detokenize(tokens: list[str]) -> str:
    """Joined by spaces, none before closing and after opening signs."""
    text = re.sub(r"\s+(?=[,.;:!?،؛؟)\]}])", "", " ".join(tokens))
    return re.sub(r"\s+", " ", re.sub(r"(?<=[(\[{])\s+", "", text)).strip()


def window_starts(n: int, size: int, overlap: int) -> range:
    """Where windows of ``size`` start; the first that reaches the end is the last."""
    step = max(1, size - overlap)
    return range(0, max(0, n - size) + step, step) if n else range(0)


def fill(sizes: list[int], room: int, overlap: int = 0) -> list[tuple[int, int, int]]:
    """(from, to, carried) of the fullest runs of items, none larger than ``room``, in order.

    A run lends the next one up to ``overlap`` of its last tokens if they and the
    next item fit together.
    """
    total = [0, *accumulate(sizes)]
    out, at, carried = [], 0, 0
    while at < len(sizes):
        to = bisect_right(total, total[at] + room - carried) - 1
        out.append((at, to, carried))
        lent = min(overlap, carried + total[to] - total[at])
        at, carried = to, lent if to < len(sizes) and lent + sizes[to] <= room else 0
    return out


class Layout:
    """The tokens and sections of one text."""

    def __init__(self, markdown: str | None):
        self.text = "\n".join(tidy(markdown or "").splitlines())
        self.tokens = [(m.start(), m.end()) for m in TOKEN.finditer(self.text)]
        self._starts = [a for a, _ in self.tokens]
        self.sections = self._sections()

    def span(self, start: int, end: int, path: tuple[str, ...]) -> Span:
        return Span(start, end, bisect_left(self._starts, start), bisect_left(self._starts, end), path)

    def _sections(self) -> list[Span]:
        """The parts from heading to heading that hold tokens, each with the titles of all open headings."""
        headings = [(m.start(), len(m.group(1)), m.group(2)) for m in _HEADING.finditer(self.text)]
        opened: list[str | None] = [None] * 7
        out = [self.span(0, headings[0][0] if headings else len(self.text), ())]
        for (start, level, title), end in zip(headings, [*(h[0] for h in headings[1:]), len(self.text)]):
            opened[level:] = [title, *[None] * (6 - level)]
            out.append(self.span(start, end, tuple(t for t in opened if t is not None)))
        return [s for s in out if s.last > s.first]

    def paragraphs(self, section: Span) -> list[Span]:
        gaps = [(m.start(), m.end()) for m in _GAP.finditer(self.text, section.start, section.end)]
        bounds = zip([section.start, *(e for _, e in gaps)], [*(s for s, _ in gaps), section.end])
        return [s for s in (self.span(a, b, section.path) for a, b in bounds) if s.last > s.first]

    def quote(self, first: int, last: int) -> str:
        return detokenize([self.text[a:b] for a, b in self.tokens[first:last]])

    def pieces(self, limits: Limits) -> list[Piece]:
        """Sections packed up to ``most`` tokens, headings counted; those that are larger alone, in pieces."""
        sizes = [s.last - s.first + count(head_line(s.path)) for s in self.sections]
        out: list[Piece] = []
        for kept, large in _between(self.sections, sizes, limits.most):
            for a, b, carried in fill([sizes[i] for i in kept], limits.most, limits.overlap):
                part = [self.sections[i] for i in kept[a:b]]
                out.append(Piece(tuple((s,) for s in part), part[-1].path, carried))
            if large is not None:
                out += self._divided(self.sections[large], limits)
        return out

    def _divided(self, section: Span, limits: Limits) -> list[Piece]:
        room = max(LEAST_ROOM, limits.most - count(head_line(section.path)))
        paragraphs, width = self.paragraphs(section), min(room, limits.most)
        sizes = [p.last - p.first for p in paragraphs]
        out: list[Piece] = []
        for kept, large in _between(paragraphs, sizes, room):
            out += [Piece((tuple(paragraphs[i] for i in kept[a:b]),), section.path) for a, b, _ in fill([sizes[i] for i in kept], room)]
            if large is not None:
                first, last = paragraphs[large].first, paragraphs[large].last
                out += [Piece((), section.path, 0, (i, min(i + width, last))) for i in (first + s for s in window_starts(last - first, width, limits.overlap))]
        return out

    def texts(self, limits: Limits) -> list[tuple[str, list[str]]]:
        """(text, heading context) of each chunk."""
        out: list[tuple[str, list[str]]] = []
        for piece in self.pieces(limits):
            parts = [detokenize(TOKEN.findall(out[-1][0])[-piece.carried :])] if piece.carried else []
            if piece.window:
                parts += [head_line(piece.path), self.quote(*piece.window)]
            for spans in piece.blocks:
                parts += [head_line(spans[0].path), *(self.text[s.start : s.end].strip() for s in spans)]
            out.append((tidy("\n\n".join(filter(None, parts))), list(piece.path)))
        return out


def _between(items: list, sizes: list[int], room: int):
    """(indices of items that fit, index of the larger one after them or None), in order."""
    kept: list[int] = []
    for i, n in enumerate(sizes):
        if n > room:
            yield kept, i
            kept = []
        else:
            kept.append(i)
    yield kept, None


def chunks_of(markdown: str | None, limits: Limits) -> list[tuple[str, list[str]]]:
    """(text, heading context) of each chunk of a text; none for a blank one.

    A chunk that ends because the next section does not fit lends it its last
    ``overlap`` tokens where they fit.
    """
    return Layout(markdown).texts(limits)


def _hash(value: str, length: int) -> str:
    return hashlib.sha1(value.encode("utf-8", "replace")).hexdigest()[:length]


def stored_text(chunk: str) -> str:
    """A chunk as it is stored: no blank lines, single spaces."""
    return re.sub(r"\s*\n\s*", "\n", re.sub(r"[ \t]+", " ", chunk)).strip()


def chunk_documents(texts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``SCHEMA`` rows of (document_id, language, text); stored text has no blank lines.

    The id hashes the stored text; ``token_count`` is that of the chunk. Null and
    blank texts give no rows; repeated rows give their chunks again.
    """
    limits = limits.checked()

    def pack(batches):
        for pdf in batches:
            rows = []
            for key, language, text in zip(pdf["document_id"], pdf["language"], pdf["text"]):
                for i, (chunk, context) in enumerate(chunks_of(text, limits)):
                    stored = stored_text(chunk)
                    name = "chunk-" + _hash(f"chunk:{key}:{language}:{i}:{_hash(stored, 20)}", 24)
                    rows.append((key, language, i, name, stored, count(chunk), context))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return texts.select("document_id", "language", "text").where("text is not null").mapInPandas(pack, SCHEMA)


def section_rows(texts: DataFrame) -> DataFrame:
    """(document_id, language, section_no, title, depth, n_tokens) of the sections of (document_id, language, text) that hold tokens.

    The part before the first heading has no title and depth 0.
    """
    schema = "document_id string, language string, section_no int, title string, depth int, n_tokens int"

    def read(batches):
        for pdf in batches:
            rows = [
                (key, language, i, s.path[-1] if s.path else None, len(s.path), s.last - s.first)
                for key, language, text in zip(pdf["document_id"], pdf["language"], pdf["text"]) for i, s in enumerate(Layout(text).sections)
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return texts.select("document_id", "language", "text").where("text is not null").mapInPandas(read, schema)


def token_windows(tokens: Column, size: int, overlap: int) -> Column:
    """The same windows as a native expression over an array of tokens."""
    step = max(1, size - overlap)
    n = F.size(tokens)
    last = F.greatest(F.lit(0), F.ceil((n - size) / F.lit(step))).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(tokens, i * step + 1, size))
