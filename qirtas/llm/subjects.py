"""Subject areas of documents by mined class-association rules.

Documents are cut into statements, citations of other instruments are left out,
and each statement into phrases of telling words. Parallel FP-growth mines the
frequent word sets together with a subject; a set that predicts a subject becomes
a rule unless a smaller set predicts it as well. The first rules come from the
labels. They mark the statements of all documents, which propose more rules;
how far a rule is believed is measured on labelled documents, and on what the
rest of each document says, so that a formula, which stands in documents of all
subjects, can't bear itself out. A document has the subjects that its statements' matching
rules give enough evidence for, calibrated per subject on labelled documents that
no rule has seen.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.functions.text import is_blank, strip
from qirtas.session import cut

#: Rules are fitted on so many labelled documents at most, those of the least hashes.
FIT_DOCS = 20_000
#: Evidence from which on a statement counts as having a subject.
CLEAR = 1.0
#: Phrases that must support a rule, and the share of them that must have its subject.
MIN_SUPPORT, MIN_CONFIDENCE = 3, 0.4
#: A larger set must beat every smaller one by so much to be a rule of its own.
GAIN = 0.05
#: Telling words: standard deviations above what chance would give some subject.
MIN_Z = 3.0
#: A rule's words stand within so many telling words that follow on one another.
MAX_PHRASE = 5
#: Labelled documents that a rule's confidence on the statements of all documents counts for beside those with its words.
OWN_WEIGHT = 3
#: One labelled document in so many is held out of the rules, for the calibration.
HELD_OUT = 4
#: Documents that the common threshold counts for in a subject's own.
POOLED = 20
#: Characters of statements that are packed together, and counts that a task holds before it hands them on.
PACK_CHARS, HELD = 200_000, 200_000
#: Stands for the words between two runs of telling words.
GAP = "|"

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_STATEMENT = re.compile(r"(?<=[.!?؟;؛])\s+|\n+")
_NUMBER = re.compile(r"[0-9٠-٩]+\s*/\s*[0-9٠-٩]{4}")
_PARENTHESIS = re.compile(r"\([^()]*\)")
_CLAUSE = re.compile(r"[,،:]\s+")


def without_citations(statement: str) -> str:
    """The statement without the clauses that name another instrument.

    An instrument is named by number and year. What is named with it goes too: the
    clause or brackets it is in, brackets right after it, and a clause that goes
    on in lower case right after it.
    """
    if "/" not in statement or not _NUMBER.search(statement):
        return statement
    statement = re.sub(r"([0-9٠-٩]+\s*/\s*[0-9٠-٩]{4})\s*\([^()]*\)", r"\1", statement)
    statement = _PARENTHESIS.sub(lambda m: " " if _NUMBER.search(m.group()) else m.group(), statement)
    kept, cited = [], False
    for clause in _CLAUSE.split(statement):
        named = list(_NUMBER.finditer(clause))
        if named:
            cited = not clause[named[-1].end() :].strip()
        elif cited and clause[:1].islower() and clause[:1].upper() != clause[:1]:
            cited = False
        else:
            cited = False
            kept.append(clause)
    return ", ".join(kept)


def statements(text: str) -> list[list[str]]:
    """The words of each statement of a text, lower-case, citations left out."""
    out = []
    for part in _STATEMENT.split(text or ""):
        if words := _WORD.findall(without_citations(part).lower()):
            out.append(words)
    return out


def runs(words: list[str], telling) -> tuple[tuple[str, ...], ...]:
    """The telling words of a statement that follow on one another."""
    out, run = [], []
    for w in words:
        if w in telling:
            run.append(w)
        elif run:
            out.append(tuple(run))
            run = []
    if run:
        out.append(tuple(run))
    return tuple(out)


def phrases(found: tuple[tuple[str, ...], ...]) -> list[tuple[str, ...]]:
    """Every ``MAX_PHRASE`` words of each of the ``runs`` that follow on one another, or fewer where it is shorter, as sorted sets."""
    return [
        tuple(sorted(set(run[i : i + MAX_PHRASE])))
        for run in found for i in range(max(1, len(run) - MAX_PHRASE + 1))
    ]


#: The words of a statement, or its telling words alone as ``with_only`` leaves them.
Statement = list[str] | str


class RuleSet:
    """Rules {word set: (subject, confidence)} and the evidence from which on each subject is given."""

    def __init__(self, rules: dict[tuple[str, ...], tuple[str, float]], thresholds: dict[str, float] | None = None):
        self.rules, self.thresholds = rules, thresholds or {}
        self.telling = {w for a in rules for w in a}
        self.sizes = sorted({len(a) for a in rules}, reverse=True)

    def match(self, phrase: tuple[str, ...]) -> tuple[tuple[str, ...], str, float] | None:
        """(word set, subject, log odds) of the most specific matching rule, the most confident of that size."""
        for size in self.sizes:
            if size <= len(phrase):
                hits = [(self.rules[a][1], self.rules[a][0], a) for a in combinations(phrase, size) if a in self.rules]
                if hits:
                    confidence, subject, a = max(hits)
                    return a, subject, max(math.log(confidence / (1 - confidence)) + 1.0, 0.05)
        return None

    def _kept(self, name: str, statement: Statement, make: Callable):
        """``make(runs)``, remembered; statements differ far more than their telling words do."""
        memo = self.__dict__.setdefault("_memo", {}).setdefault(name, {})
        # What has only telling words left is looked up as it is.
        key = statement if isinstance(statement, str) else runs(statement, self.telling)
        found = memo.get(key)
        if found is None:
            if len(memo) > 200_000:
                memo.clear()
            found = memo[key] = make(runs(statement.split(" "), self.telling) if isinstance(statement, str) else key)
        return found

    def contained(self, statement: Statement) -> frozenset[tuple[str, ...]]:
        """The word sets of all rules in a statement's phrases, also of those that a larger one overrules."""
        return self._kept("within", statement, lambda found: frozenset(
            a for p in phrases(found) for size in self.sizes if size <= len(p) for a in combinations(p, size) if a in self.rules
        ))

    def subjects(self) -> list[str]:
        """The subject of each rule, by the rule's number."""
        if "_subjects" not in self.__dict__:
            self._subjects = [s for s, _ in self.rules.values()]
            self._number = {a: i for i, a in enumerate(self.rules)}
        return self._subjects

    def numbered(self, statement: Statement) -> tuple[str | None, tuple[int, ...], tuple[int, ...]]:
        """(the statement's clear subject, the rules with that subject whose words stand in it, the other ones)."""
        def make(found):
            of = self.subjects()
            subject = next((s for s, e in weighed(self.hits(found)).items() if e >= CLEAR), None)
            inside = {self._number[a] for p in phrases(found) for size in self.sizes if size <= len(p) for a in combinations(p, size) if a in self.rules}
            return subject, tuple(i for i in inside if of[i] == subject), tuple(i for i in inside if of[i] != subject)

        return self._kept("numbered", statement, make)

    def hits(self, found: tuple[tuple[str, ...], ...]) -> dict[tuple[str, ...], tuple[str, float]]:
        """Word set -> (subject, log odds) of the rules that the phrases of ``runs`` match, each once."""
        return {hit[0]: hit[1:] for p in phrases(found) if (hit := self.match(p))}

    def statement(self, statement: Statement) -> dict[str, float]:
        """Subject -> evidence in log odds, less what other subjects have, where positive."""
        return self._kept("weighed", statement, lambda found: weighed(self.hits(found)))

    def clear(self, statement: Statement) -> tuple[str, ...]:
        """The subjects (one at most) that a statement has enough evidence for."""
        return self._kept("clear", statement, lambda found: tuple(s for s, e in weighed(self.hits(found)).items() if e >= CLEAR))

    def strongest(self, parts: list[Statement]) -> dict[str, float]:
        """Subject -> the evidence of the strongest of the statements for it."""
        best: dict[str, float] = {}
        for part in parts:
            for s, e in self.statement(part).items():
                if e > best.get(s, 0.0):
                    best[s] = e
        return best

    def given(self, parts: list[Statement]) -> list[tuple[str, float]]:
        """(subject, evidence) of the subjects of a document."""
        return [(s, e) for s, e in self.strongest(parts).items() if e >= self.thresholds.get(s, 0.0)]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_memo", "_subjects", "_number")}


def weighed(hits: dict[tuple[str, ...], tuple[str, float]]) -> dict[str, float]:
    total: dict[str, float] = {}
    for s, odds in hits.values():
        total[s] = total.get(s, 0.0) + odds
    whole = sum(total.values())
    return {s: 2 * e - whole for s, e in total.items() if 2 * e > whole}


def labelled_texts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, subjects) of at most ``FIT_DOCS`` labelled documents with text."""
    named = labels.select("doc_id", F.lower(strip(F.col("subject"))).alias("subject")).where("doc_id is not null and subject <> ''")
    known = named.groupBy("doc_id").agg(F.array_sort(F.collect_set("subject")).alias("subjects"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCS)
    texts = documents.where(~is_blank(F.col("text"))).select("doc_id", "text")
    return texts.join(chosen, "doc_id")


def packed_statements(texts: DataFrame) -> DataFrame:
    """(ids, packed): the statements of all texts, cut once and read by ``unpacked``."""
    def pack(batches):
        for b in batches:
            ids, lines, chars, out = [], [], 0, []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids.append(i)
                lines.append("\n".join(" ".join(w) for w in statements(t)))
                chars += len(lines[-1])
                if chars > PACK_CHARS:
                    out.append((ids, zlib.compress("\0".join(lines).encode(), 1)))
                    ids, lines, chars = [], [], 0
            if ids:
                out.append((ids, zlib.compress("\0".join(lines).encode(), 1)))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.list_(pa.int64())), pa.array([z for _, z in out], pa.binary())], ["ids", "packed"])

    return texts.select("doc_id", "text").mapInArrow(pack, "ids array<long>, packed binary")


def unpacked(batches, split: bool = True):
    """(doc_id, statements) of each document; without ``split`` each statement as one string."""
    for b in batches:
        for ids, z in zip(b.column("ids"), b.column("packed")):
            texts = zlib.decompress(z.as_py()).decode().split("\0")
            for i, text in zip(ids.as_py(), texts):
                yield i, [line.split(" ") if split else line for line in text.split("\n") if line]


def _shortened(words: list[str], telling: set[str]) -> str:
    return f" {GAP} ".join(" ".join(run) for run in runs(words, telling))


def with_only(packed: DataFrame, telling: set[str]) -> DataFrame:
    """``packed`` with only the ``telling`` words of each statement and a mark where others stood; read by ``unpacked`` too.

    Statements without any are left out. What is mined and scored of such words is the same as of whole statements.
    """
    known = packed.sparkSession.sparkContext.broadcast(telling)

    def shorten(batches):
        telling = known.value
        for b in batches:
            out = []
            for z in b.column("packed"):
                texts = zlib.decompress(z.as_py()).decode().split("\0")
                short = "\0".join("\n".join(filter(None, (_shortened(line.split(" "), telling) for line in text.split("\n")))) for text in texts)
                out.append(zlib.compress(short.encode(), 1))
            yield pa.RecordBatch.from_arrays([b.column("ids"), pa.array(out, pa.binary())], ["ids", "packed"])

    return packed.mapInArrow(shorten, "ids array<long>, packed binary")


def labelled_documents(batches):
    """([statements], subjects, 1) of labelled documents: what a document repeats is one witness of its labels."""
    for b in batches:
        for t, subjects in zip(b.column("text").to_pylist(), b.column("subjects").to_pylist()):
            yield statements(t), subjects, 1


def own_statements(rules: Broadcast):
    """Reads packed statements as ([words], subjects, 1), with the one subject that the ``RuleSet`` sees in each; others are left out."""
    def read(batches):
        clear = rules.value.clear
        for _, parts in unpacked(batches):
            for words in parts:
                if seen := clear(words):
                    yield [words], seen, 1

    return read


def own_lines(rules: Broadcast, unknown: bool):
    """Reads (line, n) as ([line], subjects, n), in the same way; with ``unknown`` also those without a subject."""
    def read(batches):
        clear = rules.value.clear
        for b in batches:
            for line, n in zip(b.column("line").to_pylist(), b.column("n").to_pylist()):
                seen = clear(line)
                if seen or unknown:
                    yield [line], seen, n

    return read


def lines_of(short: DataFrame) -> DataFrame:
    """(line, n): the statements of ``with_only``, equal ones counted; what is left of them repeats often."""
    types = pa.schema([("line", pa.string()), ("n", pa.int64())])

    def count(batches):
        held: Counter = Counter()
        for _, parts in unpacked(batches, split=False):
            held.update(parts)
            if len(held) > HELD:
                yield pa.RecordBatch.from_pydict({"line": list(held), "n": list(held.values())}, types)
                held.clear()
        yield pa.RecordBatch.from_pydict({"line": list(held), "n": list(held.values())}, types)

    return short.mapInArrow(count, "line string, n long").groupBy("line").agg(F.sum("n").alias("n"))


def _counted(source: DataFrame, keys: Callable) -> DataFrame:
    """(w, n): what ``keys(batches)`` of each task gives as (w, n), added up, handed on before it becomes too much."""
    types = pa.schema([("w", pa.list_(pa.string())), ("n", pa.int64())])

    def count(batches):
        held: Counter = Counter()
        for key, n in keys(batches):
            held[key] += n
            if len(held) > HELD:
                yield pa.RecordBatch.from_pydict({"w": list(held), "n": list(held.values())}, types)
                held.clear()
        yield pa.RecordBatch.from_pydict({"w": list(held), "n": list(held.values())}, types)

    return source.mapInArrow(count, "w array<string>, n long")


def telling_words(source: DataFrame, read: Callable) -> tuple[set[str], dict[str, float]]:
    """The words that tell a subject in the cases ([statements], subjects, number) that ``read`` gives, and the subjects' shares.

    Every case counts once, a word once in it.
    """
    types = pa.schema([("w", pa.string()), ("s", pa.string()), ("n", pa.int64())])

    def count(batches):
        # Subjects -> word -> number; "" counts the cases.
        held: dict[tuple[str, ...], Counter] = {}

        def batch():
            out: dict[str | None, Counter] = {None: Counter()}
            for subjects, words in held.items():
                for s in (None, *subjects):
                    out.setdefault(s, Counter()).update(words)
            rows = [(w or None, s, n) for s, c in out.items() for w, n in c.items()]
            return pa.RecordBatch.from_pydict({"w": [r[0] for r in rows], "s": [r[1] for r in rows], "n": [r[2] for r in rows]}, types)

        for cases, (parts, subjects, _) in enumerate(read(batches), 1):
            words = set(parts[0]).union(*parts[1:]) if parts else set()
            words.add("")
            counter = held.get(key := tuple(subjects))
            if counter is None:
                counter = held[key] = Counter()
            counter.update(words)
            if cases % 1000 == 0 and sum(map(len, held.values())) > HELD:
                yield batch()
                held = {}
        yield batch()

    counted = cut(source.mapInArrow(count, "w string, s string, n long").groupBy("w", "s").agg(F.sum("n").alias("n")))
    whole = {r["s"]: r["n"] for r in counted.where("w is null").collect()}
    total = whole.pop(None, 0)
    if not total or not whole:
        return set(), {}
    prior = {s: n / total for s, n in whole.items()}
    share = source.sparkSession.createDataFrame([(s, p) for s, p in prior.items()], "s string, p double")
    count = counted.where(F.col("w").isNotNull() & F.col("s").isNull() & (F.col("n") >= MIN_SUPPORT)).select("w", "n")
    pair = counted.where("w is not null and s is not null").select("w", "s", F.col("n").alias("k"))
    n, k, p = F.col("n"), F.col("k"), F.col("p")
    z = (k - n * p) / F.sqrt(F.greatest(n * p * (1 - p), F.lit(1e-9)))
    clear = (z >= F.least(F.lit(MIN_Z), F.sqrt(n))) & (k / n >= F.least(1.5 * p, F.lit(0.95))) & (k / n >= 0.15)
    return {r["w"] for r in pair.join(count, "w").join(F.broadcast(share), "s").where(clear).select("w").distinct().collect()}, prior


def mine(source: DataFrame, read: Callable, telling: set[str], prior: dict[str, float]) -> RuleSet:
    """Class-association rules of the cases ([statements], subjects, number) that ``read`` gives of batches of ``source``.

    Every case counts by its number, a phrase once in it. What the driver gets are the sets and rules of the telling words.
    """
    known = source.sparkSession.sparkContext.broadcast(telling)

    def baskets(batches):
        telling = known.value
        for parts, subjects, n in read(batches):
            marks = tuple("=" + s for s in subjects)
            for q in {q for part in parts for q in phrases(runs(part.split(" ") if isinstance(part, str) else part, telling))}:
                yield q + marks, n

    # Equal baskets are kept once, with their number.
    counted = cut(_counted(source, baskets).groupBy("w").agg(F.sum("n").alias("n")))
    found = frequent_sets(counted, MIN_SUPPORT)
    if found is None:
        return RuleSet({})
    subjects = F.filter("items", lambda x: x.startswith("="))
    words = F.array_sort(F.filter("items", lambda x: ~x.startswith("=")))
    split = cut(found.select(words.alias("words"), subjects.alias("s"), "freq").where("size(words) > 0 and size(s) <= 1"))
    alone = split.where("size(s) = 0").select("words", F.col("freq").alias("n"))
    joint = split.where("size(s) = 1").select("words", F.col("s")[0].alias("s"), F.col("freq").alias("k"))
    return RuleSet(prune(best_subjects(joint.join(alone, "words").toPandas(), prior), prior))


def grown(base: dict[tuple[int, ...], int], least: int, suffix: tuple[int, ...], wanted: Callable[[int], bool]):
    """(items, frequency) of the frequent sets that end in ``suffix``, by growth over a conditional pattern base.

    ``base`` has the prefixes of the transactions with the suffix, frequent items first, with their number.
    """
    held: dict[int, dict[tuple[int, ...], int]] = {}
    total: Counter = Counter()
    for prefix, n in base.items():
        for j, item in enumerate(prefix):
            if wanted(item):
                total[item] += n
                under = held.setdefault(item, {})
                under[prefix[:j]] = under.get(prefix[:j], 0) + n
    for item, n in total.items():
        if n >= least:
            yield (item, *suffix), n
            yield from grown(held[item], least, (item, *suffix), lambda _: True)


def frequent_sets(baskets: DataFrame, least: int) -> DataFrame | None:
    """(items, freq) of the sets that are in ``least`` or more of ``baskets`` (w, n), by parallel frequent-pattern growth.

    Items are ordered by frequency and divided into groups; a basket is sent once to
    each group it has items of, cut after the last of them, and each group grows its
    own sets. Baskets carry their number, so what repeats is neither sent nor grown again. None if no item is frequent.
    """
    spark = baskets.sparkSession
    items = baskets.select(F.explode(F.array_distinct("w")).alias("item"), "n").groupBy("item").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas()
    if not len(items):
        return None
    names = items.sort_values(["n", "item"], ascending=[False, True])["item"].tolist()
    shared = spark.sparkContext.broadcast({w: i for i, w in enumerate(names)})
    groups = 8 * spark.sparkContext.defaultParallelism

    def send(batches):
        rank = shared.value
        for b in batches:
            at, prefixes, number = [], [], []
            for w, n in zip(b.column("w").to_pylist(), b.column("n").to_pylist()):
                order = sorted({rank[x] for x in w if x in rank})
                sent = set()
                for j in range(len(order) - 1, -1, -1):
                    if (g := order[j] % groups) not in sent:
                        sent.add(g)
                        at.append(g)
                        prefixes.append(order[: j + 1])
                        number.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(prefixes, pa.list_(pa.int32())), pa.array(number, pa.int64())], ["g", "prefix", "n"])

    def grow(group: pa.Table) -> pa.Table:
        g = group.column("g")[0].as_py()
        base: dict[tuple[int, ...], int] = {}
        for prefix, n in zip(group.column("prefix").to_pylist(), group.column("n").to_pylist()):
            base[tuple(prefix)] = base.get(tuple(prefix), 0) + n
        names = {i: w for w, i in shared.value.items()}
        found = list(grown(base, least, (), lambda item: item % groups == g))
        return pa.table({"items": pa.array([[names[i] for i in a] for a, _ in found], pa.list_(pa.string())), "freq": pa.array([n for _, n in found], pa.int64())})

    routed = baskets.mapInArrow(send, "g int, prefix array<int>, n long")
    return routed.groupBy("g").applyInArrow(grow, "items array<string>, freq long")


def fit_rules(packed: DataFrame, fit: DataFrame) -> tuple[RuleSet, DataFrame]:
    """(rules, the packed statements to score with them): rules from the labels, extended and sharpened on the statements of all documents.

    Labels are few, and hold for whole documents. The first rules therefore mark
    the statements of all documents; what stands in one statement with a
    known phrase is proposed by these. The last round also counts the statements
    without a subject, which ends words that merely occur in formulas. What the
    rules have marked themselves only proposes: every round ends with ``borne_out``.
    """
    cases = fit.select("text", "subjects")
    rules = mine(cases, labelled_documents, *telling_words(cases, labelled_documents))
    shared = packed.sparkSession.sparkContext.broadcast(rules)
    found = telling_words(packed, own_statements(shared))
    if not found[0]:
        return rules, packed
    # All later rules are of these words.
    short = cut(with_only(packed, found[0] | rules.telling))
    lines = cut(lines_of(short))
    rules = borne_out(mine(lines, own_lines(shared, False), *found), None, fit, found[1])
    shared = packed.sparkSession.sparkContext.broadcast(rules)
    return borne_out(mine(lines, own_lines(shared, True), *found), short, fit, found[1]), short


def standing(parts: list[Statement], rules: RuleSet) -> dict[int, bool]:
    """The (numbers of) rules whose words stand in a document, with whether the rest of it has their subject too.

    The rest are the statements without these words, so that a sentence that is
    repeated doesn't confirm its copy. A rest without any subject says nothing; the rule is left out there.
    """
    # Of all statements, and of those with each rule, how many have a subject, and how many the rule's.
    whole: dict[str, int] = {}
    held: dict[int, int] = {}
    same: dict[int, int] = {}
    total = 0
    for part in parts:
        subject, alike, others = rules.numbered(part)
        if subject is not None:
            total += 1
            whole[subject] = whole.get(subject, 0) + 1
        some = subject is not None
        for i in alike:
            held[i] = held.get(i, 0) + 1
            same[i] = same.get(i, 0) + 1
        for i in others:
            held[i] = held.get(i, 0) + some
    of = rules.subjects()
    return {i: whole.get(of[i], 0) > same.get(i, 0) for i, n in held.items() if total > n}


def borne_out(rules: RuleSet, packed: DataFrame | None, fit: DataFrame, prior: dict[str, float]) -> RuleSet:
    """The rules with their confidence measured on what they have not marked themselves.

    Of n labelled documents that a rule's words stand in, k have its subject;
    ``OWN_WEIGHT`` documents more count with the confidence that it had. If of the
    documents whose rest has subjects less than ``MIN_CONFIDENCE`` have the rule's
    there, that share counts where lower: a formula stands in documents of all
    subjects. Without ``packed`` only the labels are asked.
    """
    names = list(rules.rules)
    shared = fit.sparkSession.sparkContext.broadcast((rules, {a: i for i, a in enumerate(names)}))
    schema = "rule long, hit boolean, n long"

    def rest(batches):
        rules, _ = shared.value
        held: Counter = Counter()
        for _, parts in unpacked(batches, split=False):
            held.update(standing(parts, rules).items())
        yield pa.RecordBatch.from_pydict({"rule": [i for i, _ in held], "hit": [h for _, h in held], "n": list(held.values())}, pa.schema([("rule", pa.int64()), ("hit", pa.bool_()), ("n", pa.int64())]))

    def labelled(batches):
        rules, number = shared.value
        held: Counter = Counter()
        for pdf in batches:
            for t, subjects in zip(pdf["text"], pdf["subjects"]):
                held.update((number[a], rules.rules[a][0] in subjects) for a in {a for w in statements(t) for a in rules.contained(w)})
        yield pd.DataFrame([(i, hit, n) for (i, hit), n in held.items()], columns=["rule", "hit", "n"])

    def measured(counted: DataFrame) -> dict[int, tuple[int, int]]:
        total = counted.groupBy("rule").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("k")).toPandas()
        return {int(i): (int(n), int(k)) for i, n, k in total[["rule", "n", "k"]].itertuples(index=False)}

    everywhere = measured(packed.mapInArrow(rest, schema)) if packed is not None else {}
    by_hand = measured(fit.select("text", "subjects").mapInPandas(labelled, schema))
    out = {}
    for i, (a, (subject, confidence)) in enumerate(rules.rules.items()):
        n, k = by_hand.get(i, (0, 0))
        own = (k + OWN_WEIGHT * confidence) / (n + OWN_WEIGHT)
        n, k = everywhere.get(i, (0, 0))
        share = (k + OWN_WEIGHT * confidence) / (n + OWN_WEIGHT)
        out[a] = subject, min(own, share) if share < MIN_CONFIDENCE else own
    return RuleSet(prune(out, prior))


def best_subjects(table: pd.DataFrame, prior: dict[str, float]) -> dict[tuple[str, ...], tuple[str, float]]:
    """The best subject of every word set of (words, s, k, n).

    Confidence is shrunk to the subject's prior, so that few phrases count for little.
    """
    best: dict[tuple[str, ...], tuple[str, float]] = {}
    for words, s, k, n in table[["words", "s", "k", "n"]].itertuples(index=False):
        subject = s[1:]
        confidence = min((k + 2 * prior.get(subject, 0.0)) / (n + 2), 0.995)
        a = tuple(words)
        if a not in best or (confidence, subject) > (best[a][1], best[a][0]):
            best[a] = (subject, confidence)
    return best


def prune(best: dict[tuple[str, ...], tuple[str, float]], prior: dict[str, float]) -> dict[tuple[str, ...], tuple[str, float]]:
    """The rules {word set: (subject, confidence)} but those of which a smaller set says the same as well."""
    kept: dict[tuple[str, ...], tuple[str, float]] = {}
    for a in sorted(best, key=lambda a: (len(a), a)):
        subject, confidence = best[a]
        smaller = [kept[b] for size in range(1, len(a)) for b in combinations(a, size) if b in kept]
        if confidence < MIN_CONFIDENCE or confidence < 1.3 * prior.get(subject, 0.0):
            # A smaller set may predict what this one does not bear out.
            if smaller:
                kept[a] = (subject, confidence)
            continue
        if any(s == subject and c >= confidence - GAIN for s, c in smaller) and not any(s != subject for s, c in smaller):
            continue
        kept[a] = (subject, confidence)
    return kept


def calibrate(rules: RuleSet, held: DataFrame) -> RuleSet:
    """``rules`` with the evidence from which on each subject is given.

    The threshold of a subject has about the best F1 on ``held``, labelled
    documents that the rules have not seen; what all subjects have there counts for a
    share of ``POOLED`` documents, so that a subject with few of them keeps near the
    common threshold. Only the distribution of evidence is collected.
    """
    def score(batches):
        for pdf in batches:
            rows = []
            for t, subjects in zip(pdf["text"], pdf["subjects"]):
                given, seen = set(subjects), rules.strongest(statements(t))
                rows += [(s, round(e, 1), s in given) for s, e in seen.items()]
                rows += [(s, -1.0, True) for s in given if s not in seen]
            yield pd.DataFrame(rows, columns=["s", "e", "hit"])

    counted = held.select("text", "subjects").mapInPandas(score, "s string, e double, hit boolean").groupBy("s", "e", "hit").count().toPandas()
    whole = counted["count"].sum()
    if not whole:
        return rules
    steps = sorted({CLEAR, *counted["e"][counted["e"] > 0]})

    def curve(part):
        """(hits, given, wanted) at each step."""
        wanted = part.loc[part["hit"], "count"].sum()
        above = [part[part["e"] >= t] for t in steps]
        return np.array([[x.loc[x["hit"], "count"].sum(), x["count"].sum(), wanted] for x in above], float)

    common = curve(counted) * (POOLED / whole)
    thresholds = {}
    for s in {s for s, _ in rules.rules.values()}:
        hits, given, wanted = (curve(counted[counted["s"] == s]) + common).T
        f1 = 2 * hits / np.maximum(1e-9, given + wanted)
        # Labels are incomplete, so of thresholds that do about as well the lowest is right.
        thresholds[s] = min(t for t, v in zip(steps, f1) if v >= f1.max() - 0.005) - 0.05
    return RuleSet(rules.rules, thresholds)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, subject, evidence) of every document, one row per subject.

    Blank and null texts have none; documents of which no rule matches have none;
    without labels there are no rules and no rows. Rows of one doc_id are scored
    each; equal results count once.
    """
    fit = cut(labelled_texts(documents, labels))
    packed = packed_statements(documents.where(~is_blank(F.col("text"))))
    spread = documents.sparkSession.sparkContext.defaultParallelism
    # Few files are few tasks; only then is there a shuffle.
    packed = cut(packed.repartition(spread) if packed.rdd.getNumPartitions() < spread else packed)
    out = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(HELD_OUT)) == 0
    rules, packed = fit_rules(packed, fit.where(~out))
    rules = calibrate(rules, fit.where(out))
    shared = documents.sparkSession.sparkContext.broadcast(rules)

    def score(batches):
        rules = shared.value
        for b in batches:
            rows = [
                (i, s, e) for i, parts in unpacked([b], split=False) if i is not None for s, e in rules.given(parts)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.float64())],
                ["doc_id", "subject", "evidence"],
            )

    found = packed.mapInArrow(score, "doc_id long, subject string, evidence double")
    return found.groupBy("doc_id", "subject").agg(F.max("evidence").alias("evidence"))


def composition(found: DataFrame, documents: DataFrame) -> DataFrame:
    """(subject, n_docs, share): the share of the documents that have each subject."""
    total = documents.agg(F.countDistinct("doc_id").alias("total"))
    counted = found.groupBy("subject").agg(F.countDistinct("doc_id").alias("n_docs"))
    return counted.join(F.broadcast(total)).select("subject", "n_docs", (F.col("n_docs") / F.col("total")).alias("share"))
