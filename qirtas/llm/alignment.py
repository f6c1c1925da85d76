"""Pairs of sentences that are translations of each other in bilingual documents.

A lexicon is induced from all documents by the log-likelihood ratio of words
occurring in the same section. Sentence pairs and merged spans of adjacent
sentences are scored by how much of each side's information the other covers; a
maximum-weight assignment (Hungarian method) with null costs picks the pairs.
Spans take part in it: a sentence that two neighbours of the other side share has
a second place for the second of them, and a span of which the optimum takes only
one half is withdrawn before the assignment is solved again.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.text import ARABIC_DIGITS, ASCII_DIGITS, is_blank
from qirtas.session import cut

#: A pair of words enters the lexicon with so many common sections and this ratio.
MIN_TOGETHER, MIN_RATIO = 3, 10.8
#: Translations kept of each word, the most associated ones.
TRANSLATIONS = 8
#: Documents that are aligned together and share the part of the lexicon that their words need.
GROUP_DOCS = 1_000
#: What leaving a sentence unpaired costs: only pairs that score more are made.
NULL_COST = 0.45
#: One side of a pair must be covered by the other at least so far.
FULL_COVER = 0.68
#: Two adjacent sentences are one span for a sentence of the other side if each is
#: covered by it so far, and together cover so much more of it than either.
SPAN_COVER, SPAN_GAIN = 0.62, 0.15
#: What a span's pair is worth beside a rival pair of one of its sentences.
SPAN_BONUS = 0.15
_BLOCK = 400
#: Bounds of a counting task's memory, not of what it counts: words of sections that are held, pairs that are
#: made of them at once, rows of a batch that is handed on.
HELD_WORDS, MADE_PAIRS, BATCH_ROWS = 2_000_000, 500_000, 100_000
#: A row goes to a counting task for so many characters of text: Arrow batches have so many rows, of any length.
ROW_CHARS = 500
#: Documents that are counted in one task: the more, the fewer rows of the same pair are shuffled.
COUNT_DOCS = 10_000

_END = re.compile(r"(?<=[.!?؟])\s+")
_WORD = re.compile(r"\d+|[^\W\d_]+")
_TO_ASCII = str.maketrans(ARABIC_DIGITS, ASCII_DIGITS)


def sentences(text: str) -> list[tuple[int, str]]:
    """(section, sentence): headings and table lines are skipped but end a section."""
    out, section = [], 0
    for line in (text or "").split("\n"):
        if line[:1] in ("#", "|"):
            section += line[:1] == "#"
            continue
        out += [(section, s) for s in _END.split(line) if s.strip()]
    return out


def words(sentence: str) -> list[str]:
    return _WORD.findall(sentence.translate(_TO_ASCII).lower())


def _units(ar: str, en: str) -> list[tuple[set[str], set[str]]]:
    """The words of both sides per section, or of the whole texts if the sections differ in number."""
    sides = []
    for text in (ar, en):
        by: dict[int, set[str]] = {}
        for section, s in sentences(text):
            by.setdefault(section, set()).update(words(s))
        sides.append(by)
    a, e = sides
    if max(a, default=0) == max(e, default=0):
        return [(a[k], e[k]) for k in a if k in e]
    return [(set().union(*a.values()), set().union(*e.values()))]


def bilingual(legal: DataFrame) -> DataFrame:
    """(document_id, ar, en) of documents whose both contents are not blank, one row per id."""
    both = legal.where(~is_blank(F.col("contentAr")) & ~is_blank(F.col("contentEn")) & F.col("id").isNotNull())
    one = both.groupBy(F.col("id").alias("document_id")).agg(F.max(F.struct(F.col("contentAr").alias("ar"), F.col("contentEn").alias("en"))).alias("c"))
    return one.select("document_id", "c.ar", "c.en")


class _Sections:
    """The words of sections, and in how many of them words and pairs of words stand.

    Only the words are held; pairs are made of a stretch of the Arabic words at a time.
    """

    def __init__(self):
        self.known: tuple[dict[str, int], dict[str, int]] = {}, {}
        self.words, self.sizes = (array("i"), array("i")), (array("i"), array("i"))

    def add(self, *sides: set[str]) -> bool:
        """Whether it is full after this section."""
        for side, known, words, sizes in zip(sides, self.known, self.words, self.sizes):
            words.extend([known.setdefault(w, len(known)) for w in side])
            sizes.append(len(side))
        return len(self.words[0]) + len(self.words[1]) >= HELD_WORDS

    def rows(self):
        """(a, e, n) as Arrow batches: with either null the sections with the other, with both null all sections."""
        av, ev = (pa.array(known, pa.string()) for known in self.known)
        a, e = (np.array(words, np.int64) for words in self.words)
        n_a, n_e = (np.array(sizes, np.int64) for sizes in self.sizes)
        yield from _batches(av, None, np.bincount(a, minlength=len(av)))
        yield from _batches(None, ev, np.bincount(e, minlength=len(ev)))
        yield from _batches(None, None, np.array([len(n_a)]))

        # By Arabic word: its sections, which make a pair with each of their English words.
        section = np.repeat(np.arange(len(n_a)), n_a)[np.argsort(a, kind="stable")]
        size, first = n_e[section], (np.cumsum(n_e) - n_e)[section]
        end = np.concatenate([[0], np.cumsum(size)])
        bound = np.concatenate([[0], np.cumsum(np.bincount(a, minlength=len(av)))])

        def english(lo, hi):
            n = size[lo:hi]
            return e[np.arange(n.sum()) + np.repeat(first[lo:hi] - (np.cumsum(n) - n), n)]

        def stretch(ends, lo):
            return max(lo + 1, int(np.searchsorted(ends, ends[lo] + MADE_PAIRS, "right")) - 1)

        word = 0
        while word < len(av):
            lo, after = bound[word], stretch(end[bound], word)
            if after > word + 1:
                words = np.repeat(np.arange(word, after), np.diff(end[bound[word : after + 1]]))
                pairs, counts = np.unique(words << 32 | english(lo, bound[after]), return_counts=True)
                yield from _batches(av.take(pa.array(pairs >> 32)), ev.take(pa.array(pairs & 0xFFFFFFFF)), counts)
            else:
                counts = np.zeros(len(ev), np.int64)
                while lo < bound[after]:
                    hi = min(bound[after], stretch(end, lo))
                    counts += np.bincount(english(lo, hi), minlength=len(ev))
                    lo = hi
                some = np.flatnonzero(counts)
                yield from _batches(av.take(pa.array(np.full(len(some), word))), ev.take(pa.array(some)), counts[some])
            word = after


def _batches(a: pa.Array | None, e: pa.Array | None, n: np.ndarray):
    for lo in range(0, len(n), BATCH_ROWS):
        part = n[lo : lo + BATCH_ROWS]
        sides = [pa.nulls(len(part), pa.string()) if x is None else x[lo : lo + BATCH_ROWS] for x in (a, e)]
        yield pa.RecordBatch.from_arrays([*sides, pa.array(part, pa.int64())], ["a", "e", "n"])


def _count(batches):
    """The rows of all documents; one may come more than once, each time with a part of its number."""
    held = _Sections()
    for batch in batches:
        for ar, en in zip(batch.column("ar"), batch.column("en")):
            if not ar.is_valid:
                continue
            for unit in _units(ar.as_py(), en.as_py()):
                if held.add(*unit):
                    yield from held.rows()
                    held = _Sections()
    yield from held.rows()


def induce_lexicon(docs: DataFrame) -> DataFrame:
    """(a, e, weight, df_a, df_e): associated word pairs; ``weight`` in 0..1 is the Dice coefficient.

    Counts are over all documents; pairs are counted per task before the shuffle, in bounded memory.
    Rows without texts count for nothing.
    """
    summed = docs.mapInArrow(_count, "a string, e string, n long").groupBy("a", "e").agg(F.sum("n").alias("n"))
    counted = cut(summed.where(F.col("a").isNull() | F.col("e").isNull() | (F.col("n") >= MIN_TOGETHER)))
    row = counted.where("a is null and e is null").first()
    total = float(row["n"]) if row else 0.0
    one = counted.where("a is not null and e is null").select("a", F.col("n").alias("na"))
    two = counted.where("a is null and e is not null").select("e", F.col("n").alias("ne"))
    pairs = counted.where("a is not null and e is not null").join(one, "a").join(two, "e")

    def term(k, expected):
        return F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)

    n = F.lit(max(total, 1.0))
    k11, k12, k21 = F.col("n"), F.col("na") - F.col("n"), F.col("ne") - F.col("n")
    k22 = n - F.col("na") - F.col("ne") + F.col("n")
    e11, e12 = F.col("na") * F.col("ne") / n, F.col("na") * (n - F.col("ne")) / n
    e21, e22 = (n - F.col("na")) * F.col("ne") / n, (n - F.col("na")) * (n - F.col("ne")) / n
    ratio = 2 * (term(k11, e11) + term(k12, e12) + term(k21, e21) + term(k22, e22))
    scored = pairs.withColumn("ratio", ratio).where((F.col("ratio") >= MIN_RATIO) & (k11 > e11))
    by_a = Window.partitionBy("a").orderBy(F.desc("ratio"), "e")
    by_e = Window.partitionBy("e").orderBy(F.desc("ratio"), "a")
    ranked = scored.withColumn("ra", F.row_number().over(by_a)).withColumn("re", F.row_number().over(by_e))
    return ranked.where((F.col("ra") <= TRANSLATIONS) & (F.col("re") <= TRANSLATIONS)).select(
        "a", "e", (2 * F.col("n") / (F.col("na") + F.col("ne"))).alias("weight"),
        F.log(n / F.col("na")).alias("idf_a"), F.log(n / F.col("ne")).alias("idf_e"),
    )


def _thinned(docs: DataFrame) -> DataFrame:
    """(ar, en) with null rows after each document by its length, so that a batch of many rows is not a batch of much text."""
    text = F.struct("ar", "en")
    blank = F.struct(F.lit(None).cast("string").alias("ar"), F.lit(None).cast("string").alias("en"))
    chars = F.length("ar") + F.length("en")
    return docs.select(F.explode(F.concat(F.array(text), F.array_repeat(blank, (chars / ROW_CHARS).cast("int")))).alias("c")).select("c.ar", "c.en")


def hungarian(weight: np.ndarray) -> list[tuple[int, int]]:
    """The assignment of greatest total weight; pairs of weight 0 or less are not made."""
    flip = weight.shape[0] > weight.shape[1]
    w = weight.T if flip else weight
    n, m = w.shape
    # Every row has a null column of its own at cost 0.
    cost = np.concatenate([-w, np.where(np.eye(n, dtype=bool), 0.0, 1e6)], axis=1)
    m += n
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    match = np.zeros(m + 1, np.int64)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = match[j0]
            slack = cost[i0 - 1] - u[i0] - v[1:]
            better = ~used[1:] & (slack < least[1:])
            least[1:][better], way[1:][better] = slack[better], j0
            free = np.where(used, np.inf, least)
            free[0] = np.inf
            j1 = int(free.argmin())
            delta = free[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if not match[j0]:
                break
        while j0:
            match[j0], j0 = match[way[j0]], int(way[j0])
    out = [(int(match[j]) - 1, j - 1) for j in range(1, m - n + 1) if match[j] and w[match[j] - 1, j - 1] > 0]
    return [(j, i) for i, j in out] if flip else out


def _components(rows: np.ndarray, cols: np.ndarray):
    """Groups of (row, col) edges that share ends."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for r, c in zip(rows.tolist(), cols.tolist()):
        a, b = find(r), find(-1 - c)
        if a != b:
            root[a] = b
    groups: dict[int, list[int]] = {}
    for k, r in enumerate(rows.tolist()):
        groups.setdefault(find(r), []).append(k)
    return groups.values()


class _Side:
    """The sentences of one side as weighted word vectors over the document's own words."""

    def __init__(self, texts: list[str], idf: dict[str, float], unknown: float):
        self.index: dict[str, int] = {}
        lists = [list(dict.fromkeys(words(t))) for t in texts]
        for ws in lists:
            for w in ws:
                self.index.setdefault(w, len(self.index))
        self.ids = [np.array([self.index[w] for w in ws] or [-1], np.int64) for ws in lists]
        self.weight = np.array([idf.get(w, unknown) for w in self.index] + [0.0])
        self.weight = np.maximum(self.weight, 0.05)
        self.weight[-1] = 0.0

    def spans(self, adjacent: bool) -> list[np.ndarray]:
        if not adjacent:
            return self.ids
        return [np.unique(np.concatenate(p)) for p in zip(self.ids, self.ids[1:])]


def _cover(spans: list[np.ndarray], weight: np.ndarray, strength: np.ndarray, other: list[np.ndarray]) -> np.ndarray:
    """Share of each span's weight that each span of the other side translates."""
    out = np.zeros((len(spans), len(other)))
    starts = np.concatenate([[0], np.cumsum([len(o) for o in other])[:-1]])
    best = np.maximum.reduceat(strength[:, np.concatenate(other)], starts, axis=1)
    flat = np.concatenate(spans)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in spans])[:-1]])
    mass = np.add.reduceat(weight[flat], begin)
    for lo in range(0, len(other), _BLOCK):
        part = best[:, lo : lo + _BLOCK]
        out[:, lo : lo + _BLOCK] = np.add.reduceat(weight[flat][:, None] * part[flat], begin, axis=0)
    return out / np.maximum(mass, 1e-9)[:, None]


def align(ar: list[str], en: list[str], lexicon) -> list[tuple[int, int, float]]:
    """(position in ar, position in en, score) of the sentences that are translations.

    ``lexicon`` is (a -> [(e, weight)], idf of a, idf of e). Numbers translate themselves.
    """
    table, idf_a, idf_e, unknown = lexicon
    if not ar or not en:
        return []
    one, two = _Side(ar, idf_a, unknown), _Side(en, idf_e, unknown)
    strength = np.zeros((len(one.index) + 1, len(two.index) + 1))
    for w, i in one.index.items():
        for e, t in table.get(w, ()):
            if (j := two.index.get(e)) is not None:
                strength[i, j] = t
        if w.isdigit() and (j := two.index.get(w)) is not None:
            strength[i, j] = 1.0
    turned = strength.T
    a1, e1 = one.spans(False), two.spans(False)
    # Strongest translations are relative to the best that the word has in this document.
    ca = _cover(a1, one.weight, strength, e1)
    ce = _cover(e1, two.weight, turned, a1).T
    score = (ca + ce) / 2
    n, m = score.shape

    # Spans (side, i, j): the sentences i, i + 1 of a side that sentence j of the other puts together.
    spans = []
    if n > 1:
        both = _cover(e1, two.weight, turned, one.spans(True)).T
        gain = both - np.maximum(ce[:-1], ce[1:])
        spans += [(0, int(i), int(j)) for i, j in zip(*np.nonzero((gain >= SPAN_GAIN) & (ca[:-1] >= SPAN_COVER) & (ca[1:] >= SPAN_COVER)))]
    if m > 1:
        both = _cover(a1, one.weight, strength, two.spans(True))
        gain = both - np.maximum(ca[:, :-1], ca[:, 1:])
        spans += [(1, int(j), int(i)) for i, j in zip(*np.nonzero((gain >= SPAN_GAIN) & (ce[:, :-1] >= SPAN_COVER) & (ce[:, 1:] >= SPAN_COVER)))]
    near = 1e-3 * (1 - np.abs(np.arange(n)[:, None] / max(1, n) - np.arange(m)[None, :] / max(1, m)))
    value = np.where(np.maximum(ca, ce) >= FULL_COVER, score + near - NULL_COST, -1.0)
    pairs = assign(value, spans, ca, ce)
    return [(i, j, float(score[i, j])) for i, j in sorted(pairs)]


def _span_cells(span: tuple[int, int, int]) -> list[tuple[int, int]]:
    side, first, other = span
    return [(k, other) if side == 0 else (other, k) for k in (first, first + 1)]


def assign(value: np.ndarray, spans: list[tuple[int, int, int]], ca: np.ndarray, ce: np.ndarray) -> set[tuple[int, int]]:
    """The pairs (row, column) of greatest total value, with ``spans`` as candidates.

    A span adds a second place beside its shared sentence, open to its two
    neighbours. A span is only worth anything whole: while the optimum has just
    one of its pairs, the span that is furthest from whole is withdrawn and its group solved again.
    """
    out: set[tuple[int, int]] = set()
    worth: dict[tuple[int, int, int], float] = {}
    by_row: dict[int, list[tuple[int, int, int]]] = {}
    for span in spans:
        cells = _span_cells(span)
        by_row.setdefault(cells[0][0], []).append(span)
        covered = [(ca if span[0] == 0 else ce)[c] for c in cells]
        worth[span] = (min(covered) + 1) / 2 - NULL_COST + SPAN_BONUS
    rows, cols = np.nonzero(value > 0)
    extra = [c for span in spans for c in _span_cells(span)]
    rows = np.concatenate([rows, [r for r, _ in extra]]).astype(np.int64)
    cols = np.concatenate([cols, [c for _, c in extra]]).astype(np.int64)
    for group in _components(rows, cols):
        r, c = np.unique(rows[group]), np.unique(cols[group])
        # Every span lies in one group, whole.
        mine = [s for x in r.tolist() for s in by_row.get(x, ())]
        while True:
            got = _solve(value, r, c, mine, worth)
            broken = [s for s in mine if sum(x in got for x in _span_cells(s)) < 2]
            if not broken:
                break
            # Of spans without any pair all go, else the least worthy half one.
            none = [s for s in broken if not any(x in got for x in _span_cells(s))]
            gone = set(none) or {min(broken, key=lambda s: (worth[s], s))}
            mine = [s for s in mine if s not in gone]
        out |= got
    return out


def _solve(value: np.ndarray, r: np.ndarray, c: np.ndarray, spans: list[tuple[int, int, int]], worth: dict) -> set[tuple[int, int]]:
    """The assignment of one group; each span has a row or column of its own beside those of ``r`` and ``c``."""
    at_r, at_c = {int(x): k for k, x in enumerate(r)}, {int(x): k for k, x in enumerate(c)}
    more_c, more_r = [s for s in spans if s[0] == 0], [s for s in spans if s[0] == 1]
    names_r, names_c = [*map(int, r), *(s[2] for s in more_r)], [*map(int, c), *(s[2] for s in more_c)]
    w = np.full((len(names_r), len(names_c)), -1.0)
    w[: len(r), : len(c)] = value[np.ix_(r, c)]
    for s in spans:
        for i, j in _span_cells(s):
            w[at_r[i], at_c[j]] = max(w[at_r[i], at_c[j]], worth[s])
    for k, s in enumerate(more_c):
        for i, _ in _span_cells(s):
            w[at_r[i], len(c) + k] = worth[s]
    for k, s in enumerate(more_r):
        for _, j in _span_cells(s):
            w[len(r) + k, at_c[j]] = worth[s]
    if 1 in w.shape:
        i, j = np.unravel_index(w.argmax(), w.shape)
        return {(names_r[i], names_c[j])} if w[i, j] > 0 else set()
    return {(names_r[i], names_c[j]) for i, j in hungarian(w)}


def _lexicon(rows: pd.DataFrame):
    table: dict[str, list[tuple[str, float]]] = {}
    entries, others = rows[rows["a"].notna()], rows[rows["a"].isna()]
    for a, e, w in zip(entries["a"], entries["e"], entries["weight"]):
        table.setdefault(a, []).append((e, w))
    return table, dict(zip(entries["a"], entries["idf_a"])), dict(zip(others["e"], others["idf_e"])), 1.0


def aligned_sentences(legal: DataFrame) -> DataFrame:
    """(document_id, ar_pos, en_pos, score, ar_text, en_text) of all bilingual documents.

    Documents with a blank side, or without sentences on one, give no rows.
    Several rows of an id count once, the greatest contents winning. Documents are
    aligned in groups of about ``GROUP_DOCS``; a group is joined with the entries of its own
    words, so the lexicon is nowhere whole. Documents without any entry still pair by numbers.
    """
    docs = cut(bilingual(legal))
    n_docs, cores = docs.count(), docs.sparkSession.sparkContext.defaultParallelism
    lexicon = cut(induce_lexicon(_thinned(docs.coalesce(max(cores, -(-n_docs // COUNT_DOCS))))))
    groups = max(cores, -(-n_docs // GROUP_DOCS))
    # As many partitions as groups: few bytes can be much work.
    docs = docs.withColumn("group", F.pmod(F.xxhash64("document_id"), F.lit(groups))).repartition(groups, "group")
    schema = "document_id string, ar_pos int, en_pos int, score double, ar_text string, en_text string"
    names = [c.split()[0] for c in schema.split(", ")]

    def vocabulary(batches):
        for pdf in batches:
            found = set()
            for g, *both in zip(pdf["group"], pdf["ar"], pdf["en"]):
                found.update((g, side, w) for side, text in zip("ae", both) for _, s in sentences(text) for w in words(s))
            yield pd.DataFrame(list(found), columns=["group", "side", "w"])

    # Entries of the group's Arabic words, and the weights of its English words, also of those without an entry there.
    own = docs.select("group", "ar", "en").mapInPandas(vocabulary, "group long, side string, w string").distinct()
    own = cut(own)
    entries = own.where("side = 'a'").select("group", F.col("w").alias("a")).join(lexicon, "a").select("group", "a", "e", "weight", "idf_a", F.lit(0.0).alias("idf_e"))
    idf_e = lexicon.groupBy("e").agg(F.first("idf_e").alias("idf_e"))
    english = own.where("side = 'e'").select("group", F.col("w").alias("e")).join(idf_e, "e").select(
        "group", F.lit(None).cast("string").alias("a"), "e", F.lit(0.0).alias("weight"), F.lit(0.0).alias("idf_a"), "idf_e"
    )

    def pair(group: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        known, rows = _lexicon(entries), []
        for k, ar, en in zip(group["document_id"], group["ar"], group["en"]):
            a, e = [s for _, s in sentences(ar)], [s for _, s in sentences(en)]
            rows += [(k, i, j, s, a[i], e[j]) for i, j, s in align(a, e, known)]
        return pd.DataFrame(rows, columns=names)

    return docs.groupBy("group").cogroup(entries.unionByName(english).groupBy("group")).applyInPandas(pair, schema)
