"""Keyword, vector and hybrid retrieval; every stage is one lazy plan.

Ranking runs on (key, score) only; texts and document columns are joined to the
few rows that are left after the limit.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.functions.legal import preview
from qirtas.functions.text import WORD
from qirtas.functions.vectors import cosine, is_valid

# Words that are no search terms.
STOPWORDS = (
    "the", "and", "are", "about", "what", "with", "from", "this", "that", "laws", "law",
    "ما", "هي", "في", "من", "على", "عن", "هذا", "هذه", "قانون",
)
# The texts of answers.
NO_CONTEXT = "No matching legal contexts were found. Run scrape, ingest, extract-topics, and embed before searching."
ANSWER_HEAD = "Based on the retrieved graph and chunk context:"
ANSWER_TAIL = "This is a retrieval summary, not legal advice. Verify the cited source documents before relying on the result."
#: Topics of a document that an answer names.
ANSWER_TOPICS = 6
#: Terms of a query that are searched.
MAX_TERMS = 12
K1, B = 1.2, 0.75
VECTOR_WEIGHT, KEYWORD_WEIGHT = 0.65, 0.35


def keyword_terms(text: Column) -> Column:
    """Lower-case words of at least three characters, without stop words, repeats kept."""
    found = F.regexp_extract_all(F.lower(text), F.lit(f"([{WORD}]{{3,}})"), F.lit(1))
    return F.filter(found, lambda t: ~t.isin(*STOPWORDS))


def query_terms(query: str) -> list[str]:
    return [t for t in re.findall(r"[\w؀-ۿ]{3,}", query.lower()) if t not in STOPWORDS]


def min_max(score: Column, *partition: str) -> Column:
    """Scores of one list to 0..1; if all are equal 1.0, or 0.0 if they are not positive."""
    w = Window.partitionBy(*partition)
    low, high = F.min(score).over(w), F.max(score).over(w)
    return F.when(high == low, F.when(high > 0, 1.0).otherwise(0.0)).otherwise((score - low) / (high - low))


def min_max_by(df: DataFrame, score: str, *partition: str) -> DataFrame:
    """``df`` with ``score`` normalised as by ``min_max`` over long lists: bounds are aggregated before the shuffle, whatever share one list has.

    Rows of a null list are one list. The bounds are one row per list, joined, so a hot list can be split.
    """
    bounds = df.groupBy(*partition).agg(F.min(score).alias("_low"), F.max(score).alias("_high"))
    keys = [F.col(f"d.{c}").eqNullSafe(F.col(f"b.{c}")) for c in partition]
    on = keys[0]
    for k in keys[1:]:
        on = on & k
    joined = df.alias("d").join(bounds.alias("b"), on)
    scaled = F.when(F.col("_high") == F.col("_low"), F.when(F.col("_high") > 0, 1.0).otherwise(0.0)).otherwise((F.col(f"d.{score}") - F.col("_low")) / (F.col("_high") - F.col("_low")))
    return joined.select(*[scaled.alias(c) if c == score else F.col(f"d.{c}").alias(c) for c in df.columns])


def first_rows(chunks: DataFrame, columns: list[str]) -> DataFrame:
    """One row per chunk id, the greatest by the columns, so the result is fixed; only these columns are shuffled."""
    return chunks.where("id is not null").groupBy("id").agg(F.max(F.struct(*columns)).alias("r")).select("id", "r.*")


def top(scored: DataFrame, k: int) -> DataFrame:
    """The k best (chunk_id, score); rows of one id count once.

    Ids are made unique only among the candidates that the scores leave: the k-th
    best of the rows' distinct (score, id) bounds them.
    """
    return scored.groupBy("chunk_id").agg(F.max("score").alias("score")).orderBy(F.desc("score"), "chunk_id").limit(k)


def contains_search(chunks: DataFrame, query: str, k: int) -> DataFrame:
    """(chunk_id, score) of the k chunks that contain most of the query's terms (repeats count)."""
    terms = query_terms(query)
    low = F.lower("text")
    score = sum((low.contains(t).cast("int") for t in terms), F.lit(0))
    return top(chunks.select(F.col("id").alias("chunk_id"), score.cast("double").alias("score")).where("score > 0"), k)


def escape_term(term: str) -> str:
    """A term with the signs of the full-text query language escaped."""
    return re.sub(r'([+\-!(){}\[\]^"~*?:\\/])', r"\\\1", term)


def fulltext_query(query: str) -> str:
    """The query's first terms joined by OR; the query itself if it has none."""
    return " OR ".join(escape_term(t) for t in query_terms(query)[:MAX_TERMS]) or query


def fulltext_terms(query: str) -> list[str]:
    """What the full-text index is asked for: the first terms, or the words of a query that has none."""
    return list(dict.fromkeys(query_terms(query)[:MAX_TERMS])) or list(dict.fromkeys(re.findall(r"[\w؀-ۿ]+", query.lower())))


def index_terms(text: Column) -> Column:
    """The words that the full-text index holds: all of a text, lower-case."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"([{WORD}]+)"), F.lit(1))


def postings(chunks: DataFrame) -> DataFrame:
    """(term, chunk_id, dl, tf): the full-text index of the chunks, one row per id.

    ``dl`` counts the words that are no stop words, as terms do. Write it with
    ``write_index`` to reuse it.
    """
    words = chunks.where("id is not null and text is not null").select(F.col("id").alias("chunk_id"), keyword_terms(F.col("text")).alias("terms"), index_terms(F.col("text")).alias("words"))
    rows = words.select("chunk_id", F.size("terms").alias("dl"), F.posexplode(F.array_distinct("words")).alias("_pos", "term"), "words")
    counted = rows.select("term", "chunk_id", "dl", F.size(F.filter("words", lambda w: w == F.col("term"))).alias("tf"))
    return counted.groupBy("term", "chunk_id").agg(F.max("dl").alias("dl"), F.max("tf").alias("tf"))


def write_index(chunks: DataFrame, path: str, buckets: int = 64) -> None:
    """The index and its statistics below ``path``, by a hash of the term, so that a query reads the buckets of its terms only."""
    rows = postings(chunks).withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    lengths = chunks.where("id is not null and text is not null").groupBy("id").agg(F.max(F.size(keyword_terms(F.col("text")))).alias("dl"))
    lengths.agg(F.count("*").cast("double").alias("n"), F.avg("dl").alias("avgdl"), F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/statistics")


def index_search(spark: SparkSession, path: str, query: str, k: int) -> DataFrame:
    """``bm25_search`` from a written index: only the buckets of the query's terms are read."""
    terms = fulltext_terms(query)
    stats = spark.read.parquet(f"{path}/statistics")
    buckets = stats.first()["buckets"]
    wanted = spark.createDataFrame([(t,) for t in terms], "term string").select(F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("b")).distinct()
    read = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(*[r.b for r in wanted.collect()]) & F.col("term").isin(*terms))
    return _bm25(read.select("term", "chunk_id", "dl", "tf"), stats, k)


def _bm25(hits: DataFrame, stats: DataFrame, k: int) -> DataFrame:
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    scored = hits.join(F.broadcast(df), "term").join(F.broadcast(stats.select("n", "avgdl")))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    return scored.groupBy("chunk_id").agg(F.sum(part).alias("score")).orderBy(F.desc("score"), "chunk_id").limit(k)


def bm25_search(chunks: DataFrame, query: str, k: int) -> DataFrame:
    """(chunk_id, score): BM25 over the query's first terms, without an index.

    A chunk is reduced to its length and the counts of the query's terms, a few
    numbers, before anything is shuffled; the corpus statistics are one row.
    """
    terms = fulltext_terms(query)
    words, plain = index_terms(F.col("text")), keyword_terms(F.col("text"))

    def frequency(term: str) -> Column:
        return F.size(F.filter("words", lambda x: x == F.lit(term)))

    counts = F.array(*map(frequency, terms)) if terms else F.array().cast("array<int>")
    rows = chunks.where("id is not null and text is not null").select(F.col("id").alias("chunk_id"), words.alias("words"), F.size(plain).alias("dl"))
    one = rows.select("chunk_id", "dl", counts.alias("tf")).groupBy("chunk_id").agg(F.max(F.struct("dl", "tf")).alias("r")).select("chunk_id", "r.*")
    stats = one.agg(F.count("*").cast("double").alias("n"), F.avg("dl").alias("avgdl"))
    hits = one.where(F.exists("tf", lambda x: x > 0)).select("chunk_id", "dl", F.posexplode("tf").alias("term", "tf")).where("tf > 0")
    return _bm25(hits, stats, k)


def keyword_search(chunks: DataFrame, query: str, k: int, mode: str = "bm25") -> DataFrame:
    """The keyword side of a search: ``bm25``, or ``contains`` where there is no full-text index."""
    if mode not in ("bm25", "contains"):
        raise ValueError("mode must be bm25 or contains")
    return bm25_search(chunks, query, k) if mode == "bm25" else contains_search(chunks, query, k)


def vector_search(chunks: DataFrame, vector: list[float], k: int, dims: int = 64) -> DataFrame:
    """(chunk_id, score): exact cosine top-k; a heap per partition, then one merge."""
    q = F.array(*[F.lit(float(x)) for x in vector])
    valid = chunks.where(is_valid(F.col("embedding"), dims)).select(F.col("id").alias("chunk_id"), F.round(cosine(F.col("embedding"), q), 9).alias("score"))
    return top(valid, k)


def merge_candidates(by_vector: DataFrame, by_keyword: DataFrame, k: int) -> DataFrame:
    """(chunk_id, vector_score, keyword_score, combined_score, match_sources, position) of both lists, normalised.

    Equal scores keep the order of the vector list, then of the keyword list;
    ``position`` is the place from 1. Where both lists bring ``topics``, their union is kept.
    """
    def ranked(df: DataFrame, score: str, rank: str, topics: str) -> DataFrame:
        # Lists of at most k rows, so the window over all is small.
        place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("score"), "chunk_id"))
        own = F.col("topics") if "topics" in df.columns else F.array().cast("array<string>")
        return df.select("chunk_id", min_max(F.col("score")).alias(score), place.alias(rank), own.alias(topics))

    both = ranked(by_vector, "v", "rv", "tv").join(ranked(by_keyword, "w", "rw", "tw"), "chunk_id", "full_outer")
    v, w = F.coalesce("v", F.lit(0.0)), F.coalesce("w", F.lit(0.0))
    sources = F.array_compact(F.array(F.when(F.col("rw").isNotNull(), "keyword"), F.when(F.col("rv").isNotNull(), "vector")))
    none = F.array().cast("array<string>")
    out = both.select(
        "chunk_id", v.alias("vector_score"), w.alias("keyword_score"), (v * VECTOR_WEIGHT + w * KEYWORD_WEIGHT).alias("combined_score"),
        sources.alias("match_sources"), F.array_sort(F.array_union(F.coalesce("tv", none), F.coalesce("tw", none))).alias("topics"), "rv", "rw",
    )
    order = [F.desc(F.round("combined_score", 9)), F.asc_nulls_last("rv"), F.asc_nulls_last("rw"), "chunk_id"]
    if not ("topics" in by_vector.columns or "topics" in by_keyword.columns):
        out = out.drop("topics")
    out = out.orderBy(*order).limit(k)
    return out.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))).drop("rv", "rw")


def candidate_score(columns: list[str]) -> Column:
    """The first of combined, plain, vector and keyword score that is given, else 0."""
    given = [F.col(c) for c in ("combined_score", "score", "vector_score", "keyword_score") if c in columns]
    return F.coalesce(*given, F.lit(0.0)).cast("double")


def candidate_text(columns: list[str]) -> Column:
    """The first of the expanded and the plain text that is not empty, else an empty text."""
    given = [F.when(F.col(c) != "", F.col(c)) for c in ("expanded_text", "context", "text") if c in columns]
    return F.coalesce(*given, F.lit(""))


def sort_by_score(candidates: DataFrame, n: int | None = None) -> DataFrame:
    """Candidates by the score they have, in their order (``position``, else id) on ties."""
    order = [F.desc(F.round(candidate_score(candidates.columns), 9)), *(["position"] if "position" in candidates.columns else []), "chunk_id"]
    out = candidates.orderBy(*order)
    return out if n is None else out.limit(n)


def rerank(candidates: DataFrame, raw: Column, base: Column, n: int) -> DataFrame:
    """Blend a scorer's raw score with the base score: 0.7 of the normalised, 0.3 of the other.

    A raw score that is null for any candidate (a scorer that failed) leaves the order of the base scores.
    """
    whole = F.min(raw.isNotNull()).over(Window.partitionBy(F.lit(1)))
    blended = F.when(whole, min_max(raw) * 0.7 + base * 0.3).otherwise(base)
    return sort_by_score(candidates.withColumn("rerank_score", raw).withColumn("combined_score", blended), n)


def score_pairs(candidates: DataFrame, query: str, scorer: Callable[[str, list[str]], list[float]] | None) -> DataFrame:
    """``candidates`` with ``raw_score`` of a scorer over (query, texts), in Arrow batches; null without one or where it fails."""
    if scorer is None:
        return candidates.withColumn("raw_score", F.lit(None).cast("double"))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        try:
            return pd.Series([float(x) for x in scorer(query, texts.tolist())], dtype="float64")
        except Exception:  # a scorer is optional: search goes on by the base scores
            return pd.Series([None] * len(texts), dtype="float64")

    return candidates.withColumn("raw_score", scored(candidate_text(candidates.columns)))


def document_label(title: Column, number: Column, date: Column) -> Column:
    given = lambda c: F.when(c != "", c)
    return F.concat_ws(" | ", given(title), F.concat(F.lit("No. "), given(number)), given(date))


def expanded_context(row: dict[str, Column]) -> Column:
    """The text that is reranked and quoted: eight lines on the document, then the chunk."""
    def line(name: str, key: str, missing: str) -> Column:
        value = row[key]
        return F.concat(F.lit(name + ": "), F.coalesce(F.when(value != "", value), F.lit(missing)), F.lit("\n"))

    topics = F.coalesce(F.when(F.size(row["topics"]) > 0, F.array_join(row["topics"], ", ")), F.lit("No linked topics"))
    return F.concat(
        line("Document title", "title", "Unknown"), line("Document number", "number", "N/A"), line("Document type", "document_type", "N/A"),
        line("Date", "date", "N/A"), line("Issuer", "issuer", "N/A"), line("Source URL", "source_url", "N/A"), line("Language", "language", "unknown"),
        F.lit("Linked topics: "), topics, F.lit("\n\nChunk text:\n"), F.coalesce(row["text"], F.lit("")),
    )


def expand(candidates: DataFrame, chunks: DataFrame, documents: DataFrame, topics_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Candidates with their chunk, parent document, sorted topics and context.

    ``topics_of`` gives (document_id, normalized_name) of documents: it is asked
    for the candidates' documents only, whatever the size of the corpus.
    """
    asked = F.broadcast(candidates.select(F.col("chunk_id").alias("id")))
    own = first_rows(chunks.join(asked, "id", "left_semi"), ["document_id", "text", "language", "chunk_index"])
    own = own.select(F.col("id").alias("chunk_id"), "document_id", "text", F.col("language").alias("chunk_language"), "chunk_index")
    cols = ["title", "number", "document_type", "date", "issuer", "source_url", "language"]
    parents = documents.join(F.broadcast(own.select(F.col("document_id").alias("id")).distinct()), "id", "left_semi")
    docs = parents.groupBy(F.col("id").alias("document_id")).agg(*[F.max(c).alias(c) for c in cols])
    topics = topics_of(parents).groupBy("document_id").agg(F.array_sort(F.collect_set("normalized_name")).alias("topics"))
    joined = candidates.join(own, "chunk_id").join(docs, "document_id").join(topics, "document_id", "left")
    joined = joined.withColumn("language", F.coalesce("chunk_language", "language")).withColumn("topics", F.coalesce("topics", F.array().cast("array<string>")))
    return joined.withColumn("context", expanded_context({c: F.col(c) for c in [*cols, "topics", "text"]}))


def ranked(candidates: DataFrame) -> DataFrame:
    """``candidates`` with ``rank`` from 1; the few rows that a search has left."""
    ties = [c for c in ("position",) if c in candidates.columns]
    w = Window.partitionBy(F.lit(1)).orderBy(F.desc(F.round(candidate_score(candidates.columns), 9)), *ties, "chunk_id")
    return candidates.withColumn("rank", F.row_number().over(w))


def extractive_answer(results: DataFrame) -> DataFrame:
    """(answer) of ranked results (rank, label, topics, evidence): their evidence, numbered, between fixed lines."""
    named = F.when(F.size("topics") > 0, F.array_join(F.slice("topics", 1, ANSWER_TOPICS), ", ")).otherwise("no linked topics")
    line = F.concat(F.col("rank").cast("string"), F.lit(". "), "label", F.lit(" appears relevant. Linked topics: "), named, F.lit(". Evidence: "), F.coalesce("evidence", F.lit("")))
    lines = results.agg(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))).alias("lines"))
    body = F.array_join(F.concat(F.array(F.lit(ANSWER_HEAD)), F.transform("lines", lambda x: x["line"]), F.array(F.lit(ANSWER_TAIL))), "\n")
    return lines.select(F.when(F.size("lines") > 0, body).otherwise(NO_CONTEXT).alias("answer"))


def answer(results: DataFrame, query: str, writer: Callable[[str, list[str]], str] | None = None) -> str:
    """The answer's text: of ``writer`` (query, contexts) if there is one and it gives any, else the extractive one."""
    if writer is not None:
        try:
            contexts = [r[0] for r in results.orderBy("rank").select(F.substring(candidate_text(results.columns), 1, 3500)).collect()]
            if contexts and (text := writer(query, contexts)):
                return text
        except Exception:  # a writer is optional
            pass
    return extractive_answer(results).first()["answer"]


def best_evidence(text: Column, query: str, length: int = 500) -> Column:
    """The sentence with most of the query's terms, the first on ties, as one line."""
    sentences = F.filter(F.transform(F.split(text, r"(?<=[.!?؟])\s+|\n+"), F.trim), lambda s: s != "")
    wanted = F.array(*[F.lit(t) for t in sorted(set(query_terms(query)))])
    ranked = F.transform(sentences, lambda s, i: F.struct(F.size(F.array_intersect(keyword_terms(s), wanted)).alias("n"), (-i).alias("i"), s.alias("s")))
    return preview(F.array_max(ranked)["s"], length)
