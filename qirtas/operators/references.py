"""References to records that do not exist, arrive late or were withdrawn.

Parents are reduced to one row per key before anything is joined: the spans in
which some target of the key is live, merged into disjoint ones, and the latest
first appearance. A Bloom filter of the parent keys then proves most missing
references without a join; only what passes it is verified exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.bloom import BloomFilter, key_hash
from qirtas.functions.text import normalize_document_number, normalize_kind
from qirtas.session import cut

FOREVER = "timestamp'9999-12-31 00:00:00'"


def _timestamp(c: Column) -> Column:
    return c.try_cast("timestamp")


def parents(legal: DataFrame, core: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """One row per instrument, number and kind: its first appearance and withdrawal.

    Rows without an id or a readable ``created_at`` cannot be live at any time;
    those with an id but no time still count as existing (``born`` is null).
    """
    cols = ["id", "number", "document_type", "created_at"]
    gone = (
        withdrawn.select(normalize_kind(F.col("document_id")).alias("id"), "withdrawn_at")
        .where("id is not null and withdrawn_at is not null")
        .groupBy("id").agg(F.min("withdrawn_at").alias("died"))
    )
    rows = legal.select(*cols).unionByName(core.select(*cols)).select(
        normalize_kind(F.col("id")).alias("id"),
        normalize_document_number(F.col("number")).alias("number"),
        normalize_kind(F.col("document_type")).alias("kind"),
        _timestamp(F.col("created_at")).alias("born"),
    ).where("id is not null")
    born = rows.groupBy("id", "number", "kind").agg(F.min("born").alias("b"))
    first = Window.partitionBy("id")
    return (
        born.withColumn("born", F.min("b").over(first)).drop("b")
        .join(gone, "id", "left")
    )


def key_spans(parent: DataFrame) -> DataFrame:
    """(space, a, b) -> disjoint live spans and the latest ``born``.

    ``space`` is 'id' (a = id), 'number' (a = number) or 'typed' (a = number,
    b = kind). The spans of one key are merged, so a key with very many targets
    still has few spans; the merge is a window over the key's distinct spans.
    """
    none = F.lit("")
    spaces = F.array(
        F.struct(F.lit("id").alias("space"), F.col("id").alias("a"), none.alias("b")),
        F.struct(F.lit("number").alias("space"), F.col("number").alias("a"), none.alias("b")),
        F.struct(F.lit("typed").alias("space"), F.col("number").alias("a"), F.col("kind").alias("b")),
    )
    flat = (
        parent.select(F.explode(spaces).alias("k"), "born",
                      F.when(F.col("born").isNotNull(), F.coalesce("died", F.expr(FOREVER))).alias("died"))
        .select("k.*", "born", "died")
        .where("a is not null and b is not null")
    )
    # For spans that begin at one time the longest holds the others; spans that
    # end together are held by the earliest. Both steps combine before the shuffle.
    latest = flat.groupBy("space", "a", "b", "died").agg(F.min("born").alias("born"), F.max("born").alias("latest"))
    starts = latest.groupBy("space", "a", "b", "born").agg(F.max("died").alias("died"), F.max("latest").alias("latest"))
    key = Window.partitionBy("space", "a", "b").orderBy("born", "died")
    before = key.rowsBetween(Window.unboundedPreceding, -1)
    marked = starts.withColumn("new", (F.max("died").over(before) < F.col("born")).cast("int"))
    marked = marked.withColumn("run", F.sum(F.coalesce("new", F.lit(0))).over(key))
    merged = marked.groupBy("space", "a", "b", "run").agg(
        F.min("born").alias("born"), F.max("died").alias("died"), F.max("latest").alias("latest")
    )
    return merged.groupBy("space", "a", "b").agg(
        F.max("latest").alias("latest"),
        F.collect_list(F.when(F.col("born").isNotNull(), F.struct("born", "died"))).alias("spans"),
    )


def reference_keys(refs: DataFrame) -> DataFrame:
    """One row per ``ref_id`` that names a target, with the key it names.

    Repeated rows agree but for ``ingested_at``; should they not, the greatest
    wins. Rows without ``ref_id`` or ``extracted_at`` are no case.
    """
    target = F.struct("extracted_at", "target_document_id", "target_number", "target_document_type")
    one = (
        refs.where("ref_id is not null and extracted_at is not null")
        .groupBy("ref_id").agg(F.max(target).alias("t")).select("ref_id", "t.*")
        .select(
            "ref_id", "extracted_at",
            normalize_kind(F.col("target_document_id")).alias("id"),
            normalize_document_number(F.col("target_number")).alias("number"),
            normalize_kind(F.col("target_document_type")).alias("kind"),
        )
    )
    by_id, typed = F.col("id").isNotNull(), F.col("kind").isNotNull()
    return one.where("id is not null or number is not null").select(
        "ref_id", "extracted_at",
        F.when(by_id, "id").when(typed, "typed").otherwise("number").alias("space"),
        F.when(by_id, F.col("id")).otherwise(F.col("number")).alias("a"),
        F.when(by_id | ~typed, "").otherwise(F.col("kind")).alias("b"),
    )


def orphan_references(refs: DataFrame, legal: DataFrame, core: DataFrame, withdrawn: DataFrame) -> DataFrame:
    """(ref_id, period, reason) of every reference without a live target when extracted.

    ``reason`` is ``missing`` without any target, ``late`` if a target appears
    after ``extracted_at``, else ``deleted``. Empty tables give no rows (an empty
    parent side makes every reference ``missing``). One key may be named by any
    share of the rows: the parent side has one row per key, so the adaptive join
    can split such a key.
    """
    spans = cut(key_spans(parents(legal, core, withdrawn)))
    bloom = BloomFilter(spans, key_hash("space", "a", "b"), spans.count())
    tested = reference_keys(refs).withColumn("maybe", bloom.might_contain(key_hash("space", "a", "b")))
    tested = cut(tested)
    period = F.date_format("extracted_at", "yyyy-MM").alias("period")
    absent = tested.where("not maybe").select("ref_id", period, F.lit("missing").alias("reason"))
    found = tested.where("maybe").drop("maybe").join(spans, ["space", "a", "b"], "left")
    live = F.exists("spans", lambda s: (s["born"] <= F.col("extracted_at")) & (s["died"] > F.col("extracted_at")))
    verified = (
        found.where(~F.coalesce(live, F.lit(False)))
        .select(
            "ref_id", period,
            F.when(F.col("spans").isNull(), "missing")
            .when(F.col("latest") > F.col("extracted_at"), "late")
            .otherwise("deleted").alias("reason"),
        )
    )
    return absent.unionByName(verified)


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Counts per period and reason."""
    return orphans.groupBy("period", "reason").agg(F.count("*").alias("n_refs"))
