"""Repair of text from scanned pages.

Lines are classified with SQL windows over each document: page numbers by their
shape, running headers by digit-masked lines that stand at page breaks all over
the corpus or repeat the document's title. Words are grouped by a skeleton in
which glyphs that are easily confused are one; a rare word is misread where a far
more frequent word of its group has the support of its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.text import SPACE, is_blank, normalize_digits, squeeze
from qirtas.session import cut

# Letters that scans confuse, one class a word; each class is
# written as its first letter in a skeleton.
GLYPH_CLASSES = "اأإآل بتثنيىئ جحخ دذ رزو سش صض طظ عغ فق هةم"
#: Hyphens at the end of a line, among them the soft hyphen, the not sign and the tatweel.
HYPHENS = r"\-\x{AD}\x{AC}\x{2010}\x{2011}\x{640}"
#: A mask is a header if it is on the page break in this share of its lines and in so many documents.
BREAK_SHARE, HEADER_DOCS = 0.5, 3
#: Lines a document that a header without a number has, on average at least.
AGAIN = 1.5
#: From this share on, its other lines are headers too.
SURE_SHARE = 0.8
#: The form that a misread word stands for is at least so many times as frequent.
TIMES, LEAST = 6, 5

_LETTER = r"\x{621}-\x{63A}\x{641}-\x{64A}"
_EDGE_OPEN, _EDGE_CLOSE = r"^[«»\"'(\[{“”]+", r"[)\]}.,،؛;:؟!»\"'“”/…\-–—\x{2010}\x{2011}\x{AD}\x{AC}\x{640}]+$"


def skeleton(c: Column) -> Column:
    classes = GLYPH_CLASSES.split()
    return F.translate(c, "".join(k[1:] for k in classes), "".join(k[0] * len(k[1:]) for k in classes))


def clean_word(c: Column) -> Column:
    """A token without punctuation at its ends, tatweel and vowel signs."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, _EDGE_OPEN, ""), _EDGE_CLOSE, ""), r"[\x{640}\x{64B}-\x{65F}\x{200C}-\x{200F}]", "")


def _tokens(c: Column) -> Column:
    return F.filter(F.split(c, rf"[{SPACE}]+"), lambda t: t != "")


def scanned_documents(legal: DataFrame) -> DataFrame:
    """(document_id, text, scanned): every non-blank ``contentAr``, one row per id, the greatest winning.

    Text that comes from pages has Markdown headings; text without any is a scan,
    whatever the metadata say.
    """
    one = (
        legal.where(~is_blank(F.col("contentAr")) & F.col("id").isNotNull())
        .groupBy(F.col("id").alias("document_id")).agg(F.max("contentAr").alias("text"))
    )
    return one.withColumn("scanned", ~F.col("text").rlike(r"(?m)^#{1,6}[ \t]"))


def classified_lines(docs: DataFrame) -> DataFrame:
    """(document_id, line_no, line, kind) of scans; kind: blank, page_number, running_header or text."""
    lines = docs.where("scanned").select("document_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    flat = squeeze(normalize_digits(F.regexp_replace("line", r"\f", " ")))
    # A word in front of the number is the word for page, perhaps misread.
    page = flat.rlike(r"^(\S{3,6} \d+( \S{1,4} \d+)?|\d+|[-–—] ?\d+ ?[-–—]|\[ ?\d+ ?\])$")
    word = F.regexp_extract(flat, r"^(\S{3,6}) \d", 1)
    page = page & ((word == "") | (F.levenshtein(word, F.lit("صفحة")) <= 2) & ~flat.rlike(r"^المادة"))
    by = Window.partitionBy("document_id").orderBy("line_no")
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    marked = (
        lines.withColumn("flat", flat)
        .withColumn("blank", F.col("flat") == "")
        .withColumn("page", page)
        .withColumn("full", F.when(~F.col("blank"), F.col("page")))
        .withColumn("title", F.first(F.when(~F.col("blank") & ~F.col("page"), F.col("flat")), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("first", F.first(F.when(~F.col("blank") & ~F.col("page"), F.col("line_no")), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("beside", F.coalesce(F.last("full", True).over(before), F.lit(False)) | F.coalesce(F.first("full", True).over(after), F.lit(False)) | F.col("line").contains("\f"))
    )
    # A number set off by a wide space is the page's, printed into the header.
    trimmed = F.regexp_replace("line", rf"^[{SPACE}]+|[{SPACE}]+$", "")
    spaced = trimmed.rlike(r"^[0-9٠-٩]+ {2,}\S|\S {2,}[0-9٠-٩]+$")
    core = F.regexp_replace(F.regexp_replace(trimmed, r"^[0-9٠-٩]+ {2,}", ""), r" {2,}[0-9٠-٩]+$", "")
    letters = squeeze(F.regexp_replace(skeleton(normalize_digits(core)), rf"[^{_LETTER}0-9 /]", ""))
    mask = F.regexp_replace(letters, r"\d+", "#")
    marked = marked.withColumn("spaced", spaced).withColumn("core", letters).withColumn("mask", mask)
    own = squeeze(F.regexp_replace(skeleton(F.col("title")), rf"[^{_LETTER}0-9 /]", ""))
    parts = F.split("core", " ")
    start = F.slice(F.split(own, " "), 1, F.size(parts))
    same = F.size(F.filter(F.zip_with(parts, start, lambda a, b: (a == b) | (F.levenshtein(a, b) <= F.when(F.length(a) > 3, 1).otherwise(0))), lambda x: x))
    titled = (F.size(parts) >= 3) & (F.size(parts) < F.size(F.split(own, " "))) & (same >= F.size(parts)) & F.col("core").rlike(r"\d")
    marked = marked.withColumn("titled", titled & (F.col("line_no") > F.col("first")))
    marked = cut(marked.select("document_id", "line_no", "line", "blank", "page", "first", "beside", "spaced", "titled", "mask"))

    # Lines that end a sentence or clause are running text.
    ends_text = F.col("line").rlike(rf"[.،؛][{SPACE}]*$")
    can = marked.where(~F.col("blank") & ~F.col("page") & ~ends_text & (F.col("line_no") > F.col("first")) & (F.length("mask") > 4))
    seen = can.groupBy("mask").agg(
        F.avg((F.col("beside") | F.col("spaced")).cast("double")).alias("share"), F.countDistinct("document_id").alias("n"), F.count("*").alias("lines"),
    )
    # Copies of one text break alike too; a header has a number or comes on several pages of a document.
    numbered = F.col("mask").contains("#")
    header_like = numbered | (F.col("lines") >= AGAIN * F.col("n"))
    heads = seen.where((F.col("share") >= BREAK_SHARE) & (F.col("n") >= HEADER_DOCS) & header_like)
    # A header with one misread word keeps its first or its last two words.
    words = F.split("mask", " ")
    ends = F.array(
        F.concat_ws(" ", F.lit("<"), F.size(words).cast("string"), F.slice(words, 1, 2)),
        F.concat_ws(" ", F.lit(">"), F.size(words).cast("string"), F.slice(words, -2, 2)),
    )
    many = F.size(words) >= 3
    near = heads.where(many).select(F.explode(ends).alias("key")).distinct()
    tried = marked.where(numbered & (F.col("beside") | F.col("spaced")) & ~ends_text & ~F.col("blank") & ~F.col("page") & (F.col("line_no") > F.col("first")) & many)
    fuzzy = tried.select("document_id", "line_no", F.explode(ends).alias("key")).join(near, "key", "left_semi").select("document_id", "line_no").distinct().withColumn("fuzzy", F.lit(True))
    exact = heads.select("mask", (F.col("share") >= SURE_SHARE).alias("sure"), F.lit(True).alias("headed"))
    joined = marked.join(exact, "mask", "left").join(fuzzy, ["document_id", "line_no"], "left")
    at = (F.col("line_no") > F.col("first")) & (F.col("titled") | F.col("fuzzy").isNotNull() | (F.col("headed").isNotNull() & ~ends_text & (F.col("beside") | F.col("spaced") | F.col("sure"))))
    kind = F.when(F.col("blank"), "blank").when(F.col("page"), "page_number").when(at, "running_header").otherwise("text")
    return joined.select("document_id", "line_no", "line", kind.alias("kind"))


def running_words(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines of text with the state of their last word, their tokens).

    A word goes on in the next line of text if a hyphen is right after its last
    letter, unless the line is a mark of a list or heading (one or two words).
    """
    by = Window.partitionBy("document_id").orderBy("line_no")
    toks = _tokens(F.col("line"))
    text = lines.where("kind = 'text'").select("document_id", "line_no", "line", toks.alias("tokens"))
    text = (
        text.withColumn("next_line", F.lead("line_no").over(by))
        .withColumn("next_word", F.lead(F.col("tokens")[0]).over(by))
        .withColumn("last", F.element_at("tokens", -1))
    )
    hyphened = F.col("last").rlike(rf"[{_LETTER}][{HYPHENS}]+$") & (F.size("tokens") >= 3) & F.col("next_word").isNotNull()
    starts = F.col("next_word").rlike(rf"^[^{SPACE}0-9٠-٩(\[]")
    text = text.withColumn("broken", hyphened & starts)
    text = text.withColumn("continues", F.coalesce(F.lag("broken").over(by), F.lit(False)))
    return text, text.select("document_id", "line_no", "broken", "continues", "next_line", "next_word", F.size("tokens").alias("n"), F.posexplode("tokens").alias("pos", "raw"))


def _words(tokens: DataFrame) -> DataFrame:
    """(document_id, line_no, pos, w, head, next_line): broken words joined, at their first part.

    ``head`` is the length of the part in this line.
    """
    whole = tokens.where(~(F.col("continues") & (F.col("pos") == 0)))
    last = F.col("broken") & (F.col("pos") == F.col("n") - 1)
    part = clean_word(F.col("raw"))
    return whole.select(
        "document_id", "line_no", "pos", F.when(last, F.concat(part, clean_word(F.col("next_word")))).otherwise(part).alias("w"),
        F.length(part).alias("head"), F.when(last, F.col("next_line")).alias("next_line"),
    ).where("w <> ''")


def misread_words(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    """(document_id, line_no, pos, w, form, part): misread words; ``form`` is null where none is supported.

    A letter, digit or sign that is not Arabic inside an Arabic word is always a
    misreading. Frequencies are those of all documents, scanned or not.
    """
    foreign = F.col("raw").rlike(rf"[{_LETTER}]") & F.regexp_replace(clean_word(F.col("raw")), rf"[{_LETTER}]", "").rlike(r"[^/\-–.,،؛;:()؟!]")
    strange = tokens.where(foreign).select("document_id", "line_no", "pos", clean_word(F.col("raw")).alias("w"))

    # One row per document with its words in order: neighbours are found inside the row, and only
    # counts and doubtful words leave it.
    masked = lambda w: F.when(w.rlike(r"[0-9٠-٩]"), "#").otherwise(w)
    own = _words(tokens)
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "pos", "w", "head", "next_line")))
    of_scans = own.groupBy("document_id").agg(ordered.alias("ws")).withColumn("scanned", F.lit(True))
    nothing = F.lit(None).cast("int")
    clean = F.filter(F.transform(_tokens(F.col("text")), clean_word), lambda w: w != "")
    plain = docs.where(~F.col("scanned")).select(
        "document_id", F.transform(clean, lambda w: F.struct(nothing.alias("line_no"), nothing.alias("pos"), w.alias("w"), nothing.alias("head"), nothing.alias("next_line"))).alias("ws"), F.lit(False).alias("scanned"),
    )
    every = of_scans.unionByName(plain).withColumn("vs", F.transform("ws", lambda x: masked(x["w"])))
    every = cut(every)
    counts = every.select(F.explode("vs").alias("v")).where("v <> '#'").groupBy("v").agg(F.count("*").alias("n")).where(F.col("v").rlike(rf"^[{_LETTER}]{{2,}}$"))
    counts = cut(counts.withColumn("bones", skeleton(F.col("v"))))
    # Every form of the group that is frequent enough is tried; the condition bounds them.
    forms = counts.where(F.col("n") >= LEAST).select("bones", F.col("v").alias("form"), F.col("n").alias("n_form"))
    doubtful = counts.join(forms, "bones").where((F.col("form") != F.col("v")) & (F.col("n_form") >= TIMES * F.col("n"))).select("v", "form", "n", "n_form")
    doubtful = cut(doubtful)

    following = F.zip_with(F.slice("vs", F.lit(1), F.size("vs") - 1), F.slice("vs", F.lit(2), F.size("vs") - 1), lambda a, b: F.struct(a.alias("x"), b.alias("y")))
    beside = every.where(F.size("vs") > 1).select(F.explode(following).alias("p"))
    pairs = beside.groupBy(F.col("p.x").alias("x"), F.col("p.y").alias("y")).agg(F.count("*").alias("k"))
    about = doubtful.select(F.col("v").alias("u")).unionByName(doubtful.select(F.col("form").alias("u"))).distinct()
    pairs = cut(pairs)
    pairs = cut(pairs.join(about, F.col("x") == F.col("u"), "left_semi").unionByName(pairs.join(about, F.col("y") == F.col("u"), "left_semi")).distinct())
    around = F.transform("ws", lambda x, i: F.struct(x["line_no"].alias("line_no"), x["pos"].alias("pos"), x["w"].alias("w"), F.get("vs", i).alias("v"), F.get("vs", i - 1).alias("before"), F.get("vs", i + 1).alias("after")))
    cases = every.where("scanned").select("document_id", F.explode(around).alias("c")).select("document_id", "c.*").join(doubtful, "v")

    def support(cases: DataFrame, left: str, right: str, name: str) -> DataFrame:
        found = pairs.select(F.col("x").alias(left), F.col("y").alias(right), F.col("k").alias(name))
        return cases.join(found, [left, right], "left").fillna(0, [name])

    for left, right, name in (("before", "form", "f1"), ("form", "after", "f2"), ("before", "v", "c1"), ("v", "after", "c2")):
        cases = support(cases, left, right, name)
    better = (F.col("f1") + F.col("f2")) > 2 * (F.col("c1") + F.col("c2"))
    chosen = cases.where(better).groupBy("document_id", "line_no", "pos", "w").agg(F.max(F.struct(F.col("f1") + F.col("f2"), "n_form", "form"))["form"].alias("form"))
    words = every.where("scanned").select("document_id", F.explode("ws").alias("c")).select("document_id", "c.*")
    placed = words.join(chosen, ["document_id", "line_no", "pos", "w"])
    # In a broken word the line with the first letter that differs has the defect.
    at = F.array_position(F.zip_with(F.split("w", ""), F.split("form", ""), lambda a, b: a.eqNullSafe(b)), False)
    line = F.when(F.col("next_line").isNotNull() & (at > F.col("head")), F.col("next_line")).otherwise(F.col("line_no"))
    good = placed.select("document_id", line.alias("defect_line"), "line_no", "pos", "w", "form")
    odd = strange.select("document_id", F.col("line_no").alias("defect_line"), "line_no", "pos", "w", F.lit(None).cast("string").alias("form"))
    return good.unionByName(odd)


class Scans:
    """The lines of all scans with their defects, and the repaired paragraphs.

    Null and blank contents have no lines; rows of one id count once. Documents
    that are not scans have no defects but lend their words and word pairs.
    """

    def __init__(self, legal: DataFrame):
        self.docs = cut(scanned_documents(legal))
        self.lines = cut(classified_lines(self.docs))
        self.text, self.tokens = running_words(self.lines)
        self.text, self.tokens = cut(self.text), cut(self.tokens)
        self.misread = cut(misread_words(self.docs, self.tokens))

    def defects(self) -> DataFrame:
        """(document_id, line_no, defect)."""
        kinds = self.lines.where(F.col("kind").isin("running_header", "page_number")).select("document_id", "line_no", F.col("kind").alias("defect"))
        broken = self.text.where("broken").select("document_id", "line_no", F.lit("broken_word").alias("defect"))
        wrong = self.misread.select("document_id", F.col("defect_line").alias("line_no"), F.lit("misread").alias("defect")).distinct()
        return kinds.unionByName(broken).unionByName(wrong)

    def paragraphs(self) -> DataFrame:
        """(document_id, paragraph, text): headers and page numbers gone, words joined and corrected, lines reflowed.

        A paragraph ends before a heading or mark and at a blank line that is not at a page break.
        """
        word = F.coalesce("form", "raw")
        fixed = self.tokens.join(self.misread.where("form is not null").select("document_id", "line_no", "pos", "form"), ["document_id", "line_no", "pos"], "left")
        last = F.col("broken") & (F.col("pos") == F.col("n") - 1)
        tail = F.regexp_extract(F.when(last, F.col("next_word")).otherwise(F.col("raw")), r"([.،؛:؟!)]*)$", 1)
        joined = F.when(last & F.col("form").isNull(), F.concat(F.regexp_replace("raw", rf"[{HYPHENS}]+$", ""), "next_word"))
        shown = F.coalesce(joined, F.when(F.col("form").isNotNull(), F.concat("form", tail)), word)
        rows = fixed.where(~(F.col("continues") & (F.col("pos") == 0))).groupBy("document_id", "line_no").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", shown.alias("s")))), lambda x: x["s"]), " ").alias("line")
        )
        by = Window.partitionBy("document_id").orderBy("line_no")
        lines = self.lines.select("document_id", "line_no", "kind").join(rows, ["document_id", "line_no"], "left")
        cuts = F.lag("kind").over(by)
        broke = lines.withColumn("gap", (F.col("kind") == "blank") & ~F.coalesce(cuts.isin("page_number", "running_header"), F.lit(False)) & ~F.coalesce(F.lead("kind").over(by).isin("page_number", "running_header"), F.lit(False)))
        mark = F.col("line").rlike(r"^المادة \S+( [-–:])?$|^\S+ ?[-–]$") | (F.size(F.split("line", " ")) <= 2) & F.col("line").rlike(r"^المادة")
        broke = broke.withColumn("mark", F.coalesce(mark, F.lit(False)))
        start = F.col("gap") | F.col("mark") | F.coalesce(F.lag("mark").over(by), F.lit(False))
        numbered = broke.withColumn("paragraph", F.sum(start.cast("int")).over(by))
        return numbered.where("line is not null").groupBy("document_id", "paragraph").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), " ").alias("text")
        )
