"""Topic extraction by rules and title terms, topic merging, communities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.legal import TOPIC_RULES, rule_pattern
from qirtas.functions.text import normalize_topic_name, normalize_whitespace
from qirtas.functions.vectors import cosine, is_valid
from qirtas.operators.similarity import threshold_pairs
from qirtas.session import cut

MAX_TOPICS, MIN_CONFIDENCE, CONTENT_CHARS, TITLE_CONFIDENCE = 12, 0.25, 12_000, 0.42
# Words of titles that are no topics.
TITLE_STOPWORDS = (
    "royal", "decree", "ministerial", "decision", "law", "laws", "issuing", "promulgating", "regarding", "amending", "oman",
    "sultanate", "number", "no", "article",
    "مرسوم", "سلطاني", "قرار", "وزاري", "قانون", "إصدار", "بإصدار", "تعديل", "شأن", "رقم", "المادة", "المرسوم", "اللائحة",
    "الإداري", "الحكومية", "للدولة", "للإدارة", "للأكاديمية", "السلطاني", "السلطانية",
)


def rule_topics(title: Column, content: Column, with_evidence: bool = True) -> Column:
    """array<struct<name, confidence, evidence>> of the rules that match title or content.

    Without evidence (then empty) each pattern is tried once only.
    """
    hay = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.substring(F.coalesce(content, F.lit("")), 1, CONTENT_CHARS))

    def one(name: str, confidence: float, english: str, arabic: str) -> Column:
        pattern = rule_pattern(english, arabic)
        # 70 characters before and after the first match.
        at = F.position(F.regexp_substr(hay, F.lit(pattern)), hay)
        evidence = normalize_whitespace(F.substr(hay, F.greatest(at - 70, F.lit(1)), F.lit(150))) if with_evidence else F.lit("")
        return F.when(hay.rlike(pattern), F.struct(F.lit(name).alias("name"), F.lit(confidence).alias("confidence"), F.substring(evidence, 1, 220).alias("evidence")))

    return F.array_compact(F.array(*[one(*rule) for rule in TOPIC_RULES]))


def title_words(title: Column) -> Column:
    """Distinct words of a title that can be topics, the most frequent first, then the first seen."""
    words = F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit(r"([A-Za-z][A-Za-z\-]{3,}|[\x{600}-\x{6FF}]{4,})"), F.lit(1))
    words = F.filter(F.transform(words, lambda w: F.lower(F.regexp_replace(w, "^[-_]+|[-_]+$", ""))), lambda w: ~w.isin(*TITLE_STOPWORDS) & (w != ""))
    distinct = F.array_distinct(words)
    ranked = F.array_sort(F.transform(distinct, lambda w, i: F.struct((-F.size(F.filter(words, lambda x: x == w))).alias("n"), i.alias("i"), w.alias("w"))))
    return F.transform(ranked, lambda r: r["w"])


def extract_topics(documents: DataFrame, key: str, title: str, content: str) -> DataFrame:
    """(key, normalized_name, name, confidence, source): at most ``MAX_TOPICS`` a document.

    Title terms are only added where fewer than three rules match.
    """
    base = documents.select(key, rule_topics(F.col(title), F.col(content), False).alias("rules"), title_words(F.col(title)).alias("words"))
    room = F.lit(MAX_TOPICS) - F.size("rules")
    terms = F.when(F.size("rules") < 3, F.slice("words", F.lit(1), room)).otherwise(F.array().cast("array<string>"))
    rows = base.select(key, F.posexplode(F.concat(
        F.transform("rules", lambda r: F.struct(r["name"].alias("name"), r["confidence"].alias("confidence"), F.lit("keyword").alias("source"))),
        F.transform(terms, lambda w: F.struct(w.alias("name"), F.lit(TITLE_CONFIDENCE).alias("confidence"), F.lit("title_term").alias("source"))),
    )).alias("pos", "t")).select(key, "pos", "t.*").withColumn("normalized_name", normalize_topic_name(F.col("name")))
    return filter_topics(rows, key)


def filter_topics(rows: DataFrame, key: str) -> DataFrame:
    """(key, normalized_name, name, confidence, source) of (..., pos): confident topics, the best of each name, at most ``MAX_TOPICS`` a document."""
    rows = rows.where((F.col("confidence") >= MIN_CONFIDENCE) & (F.col("normalized_name") != ""))
    # The rows of one document are few, so both windows stay small.
    best = Window.partitionBy(key, "normalized_name").orderBy(F.desc("confidence"), "pos")
    rank = Window.partitionBy(key).orderBy(F.desc("confidence"), "pos")
    rows = rows.withColumn("r", F.row_number().over(best)).where("r = 1").withColumn("rank", F.row_number().over(rank))
    return rows.where(F.col("rank") <= MAX_TOPICS).select(key, "normalized_name", "name", "confidence", "source")


def parse_topic_json(raw: Column) -> Column:
    """array<struct<name, normalized_name, confidence>> of a model's answer, null if none of its parts parses.

    Tried in order: the whole text, fenced blocks, the outermost braces, the outermost brackets.
    """
    item = "struct<name:string,normalized_name:string,confidence:string>"
    parts = F.array_distinct(F.concat(
        F.array(F.trim(raw)),
        F.regexp_extract_all(raw, F.lit(r"(?s)```(?:json)?\s*(.*?)```"), F.lit(1)),
        F.array(F.regexp_extract(raw, r"(?s)(\{.*\})", 1), F.regexp_extract(raw, r"(?s)(\[.*\])", 1)),
    ))

    def parsed(p: Column) -> Column:
        listed = F.when(F.ltrim(p).startswith("["), F.from_json(p, f"array<{item}>"))
        wrapped = F.from_json(p, f"topics array<{item}>")["topics"]
        single = F.from_json(p, item[7:-1].replace(":", " ").replace(",", ", "))
        alone = F.when(single["name"].isNotNull() & single["confidence"].isNotNull(), F.array(single))
        braces = F.ltrim(p).startswith("{")
        return F.coalesce(listed, F.when(braces, wrapped), F.when(braces, alone))

    first = F.try_element_at(F.filter(F.transform(parts, parsed), lambda x: x.isNotNull()), F.lit(1))
    name = lambda t: F.coalesce(t["name"], t["normalized_name"])
    confidence = lambda t: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t["confidence"].try_cast("double"), F.lit(0.5))))
    return F.transform(F.filter(first, lambda t: name(t).isNotNull()), lambda t: F.struct(name(t).alias("name"), normalize_topic_name(name(t)).alias("normalized_name"), confidence(t).alias("confidence")))


def topic_pairs(topics: DataFrame, threshold: float, dims: int = 64) -> DataFrame:
    """(a, b, similarity): all pairs of topics, a < b, with at least that cosine.

    Topics with equal vectors are one class: its least name stands for it in the
    pairs, and each other member comes once, with that name. Topics without a
    valid vector have no pairs; repeated rows of a name count once.
    """
    one = topics.where(is_valid(F.col("embedding"), dims) & F.col("normalized_name").isNotNull()).groupBy("normalized_name").agg(F.max("embedding").alias("v"))
    # One vector may be that of any share of the topics: names are ranked by a minimum, not in a window.
    heads = cut(one.groupBy("v").agg(F.min("normalized_name").alias("head"), F.count("*").alias("n")))
    members = one.join(heads.where("n > 1"), "v").where("normalized_name <> head")
    equal = members.select(F.col("head").alias("a"), F.col("normalized_name").alias("b"), F.lit(1.0).alias("similarity"))
    return threshold_pairs(heads, "head", "v", threshold, dims).unionByName(equal)


def groups_of(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(name, root): the least name reached, by labels that spread until none changes.

    Each round also follows the label's own label, so chains are halved.
    """
    # Both directions of one reading: the pairs may take long to make.
    both = pairs.select(F.inline(F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")), F.struct(F.col(b).alias("x"), F.col(a).alias("y")))))
    edges = cut(both.distinct())
    labels = cut(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("root")).withColumnRenamed("x", "name"))
    while True:
        near = edges.join(labels.select(F.col("name").alias("y"), "root"), "y").groupBy(F.col("x").alias("name")).agg(F.min("root").alias("near"))
        hop = labels.select(F.col("name").alias("root"), F.col("root").alias("far"))
        following = cut(labels.join(near, "name").join(hop, "root").select("name", F.least("root", "near", "far").alias("root"), (F.least("root", "near", "far") != F.col("root")).alias("moved")))
        if following.where("moved").isEmpty():
            return following.select("name", "root")
        labels = following.drop("moved")


def merge_plan(groups: DataFrame, topics: DataFrame) -> DataFrame:
    """(keep, drop, similarity), the most similar first: the shortest name of each group stays, the first on ties."""
    kept = groups.groupBy("root").agg(F.min(F.struct(F.length("name"), F.col("name")))["name"].alias("keep"))
    pairs = groups.join(kept, "root").where("name <> keep").select("keep", F.col("name").alias("drop"))
    vectors = topics.where("embedding is not null").groupBy("normalized_name").agg(F.max("embedding").alias("v"))
    named = lambda n, v: vectors.select(F.col("normalized_name").alias(n), F.col("v").alias(v))
    plan = pairs.join(named("keep", "vk"), "keep").join(named("drop", "vd"), "drop")
    return plan.select("keep", "drop", cosine(F.col("vk"), F.col("vd")).alias("similarity")).orderBy(F.desc("similarity"), "keep", "drop")


def apply_merge(document_topics: DataFrame, plan: DataFrame) -> DataFrame:
    """Links with dropped topics moved to the kept ones; a link that is there already stays as it is."""
    moved = document_topics.join(plan.select(F.col("drop").alias("normalized_name"), "keep"), "normalized_name", "left")
    own = F.when(F.col("keep").isNull(), 0).otherwise(1)
    rows = moved.select("document_id", F.coalesce("keep", "normalized_name").alias("name"), "confidence", own.alias("moved"))
    best = rows.groupBy("document_id", "name").agg(F.min(F.struct("moved", (-F.col("confidence")).alias("c"))).alias("b"))
    return best.select("document_id", F.col("name").alias("normalized_name"), (-F.col("b.c")).alias("confidence"))


def merged_topics(topics: DataFrame, document_topics: DataFrame, plan: DataFrame) -> DataFrame:
    """``topics`` (normalized_name, name, ...) after the merge, with ``aliases``.

    A dropped topic that documents are linked to becomes an alias of the kept one
    and leaves the table; one without documents stays. Aliases come sorted, each once.
    """
    linked = document_topics.select(F.col("normalized_name").alias("drop")).distinct()
    gone = cut(plan.select("keep", "drop").join(linked, "drop", "left_semi"))
    names = topics.groupBy(F.col("normalized_name").alias("drop")).agg(F.max("name").alias("alias"))
    aliases = gone.join(names, "drop").groupBy(F.col("keep").alias("normalized_name")).agg(F.array_sort(F.collect_set(F.coalesce("alias", "drop"))).alias("aliases"))
    left = topics.join(gone.select(F.col("drop").alias("normalized_name")), "normalized_name", "left_anti")
    return left.join(aliases, "normalized_name", "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))


def modularity(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """(modularity, n_communities) of undirected edges (x, y) under (name, community)."""
    named = lambda n, c: communities.select(F.col("name").alias(n), F.col("community").alias(c))
    placed = edges.join(named("x", "cx"), "x").join(named("y", "cy"), "y")
    inside = placed.groupBy(F.col("cx").alias("c")).agg(F.sum((F.col("cx") == F.col("cy")).cast("double")).alias("l"), F.count("*").alias("d"))
    other = placed.groupBy(F.col("cy").alias("c")).agg(F.count("*").alias("e"))
    m = edges.agg(F.count("*").cast("double").alias("m"))
    each = inside.join(other, "c", "full_outer").join(F.broadcast(m))
    degree = (F.coalesce("d", F.lit(0)) + F.coalesce("e", F.lit(0))) / (2 * F.col("m"))
    return each.agg(F.sum(F.coalesce("l", F.lit(0.0)) / F.col("m") - degree * degree).alias("modularity"), F.count("*").alias("n_communities"))


def communities(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """(name, community): local moving by modularity gain, least community on ties.

    Half of the vertices (by hash, in turn) may move in a round, so that two
    vertices do not swap for ever.
    """
    both = cut(edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))))
    total = float(both.count()) or 1.0
    degree = cut(both.groupBy("x").agg(F.count("*").cast("double").alias("k")))
    state = cut(degree.select(F.col("x").alias("name"), F.col("x").alias("community"), "k"))
    still = 0
    for turn in range(rounds):
        weight = state.groupBy("community").agg(F.sum("k").alias("w"))
        near = both.join(state.select(F.col("name").alias("y"), F.col("community").alias("c")), "y").groupBy(F.col("x").alias("name"), "c").agg(F.count("*").alias("l"))
        gain = near.join(state, "name").join(weight.select(F.col("community").alias("c"), "w"), "c")
        held = F.when(F.col("c") == F.col("community"), F.col("w") - F.col("k")).otherwise(F.col("w"))
        gain = gain.withColumn("gain", F.round(F.col("l") - F.col("k") * held / total, 9))
        best = gain.groupBy("name").agg(
            F.min(F.struct((-F.col("gain")).alias("g"), "c")).alias("b"), F.max(F.when(F.col("c") == F.col("community"), F.col("gain"))).alias("own")
        )
        # Staying alone counts as no gain.
        may = (F.pmod(F.xxhash64("name"), F.lit(2)) == turn % 2) & (-F.col("b.g") > F.greatest(F.coalesce("own", F.lit(0.0)), F.lit(0.0)) + 1e-9)
        following = cut(state.join(best, "name", "left").select("name", F.when(may, F.col("b.c")).otherwise(F.col("community")).alias("community"), "k", F.coalesce(may, F.lit(False)).alias("moved")))
        still = still + 1 if following.where("moved").isEmpty() else 0
        state = following.drop("moved")
        if still == 2:
            break
    return state.select("name", "community")
