"""Mixing sources to target shares with Pfair scheduling.

The mixture is a sequence of slots of one block each. A source of weight w
releases its j-th block at floor(j / w) and must have it placed by
ceil((j + 1) / w); taking the released block with the earliest deadline keeps
every source within one block of its share at every moment.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.text import strip, token_count
from qirtas.session import cut

#: Slots of the schedule where no block size is given: no source is further from its share than the size of all documents by this.
SLOTS = 50_000
MIN_BLOCK = 1024
#: Running totals of one source are taken in this many independent buckets.
ORDER_BUCKETS = 1024


def schedule(weights: dict[str, float], limits: dict[str, int]) -> list[tuple[str, int]]:
    """(source, block number) per slot, earliest deadline first among released blocks.

    A source stops after ``limits`` blocks; the slots it leaves are closed up, so
    where no block is released the next one to be released is taken.
    """
    waiting, ready, out = [], [], []
    for source, w in sorted(weights.items()):
        if w > 0 and limits.get(source, 0) > 0:
            waiting.append((0, source, 0))
    heapq.heapify(waiting)
    while waiting or ready:
        while waiting and (waiting[0][0] <= len(out) or not ready):
            _, source, j = heapq.heappop(waiting)
            heapq.heappush(ready, (math.ceil((j + 1) / weights[source]), source, j))
        _, source, j = heapq.heappop(ready)
        out.append((source, j))
        if j + 1 < limits[source]:
            heapq.heappush(waiting, (math.floor((j + 1) / weights[source]), source, j + 1))
    return out


class Mixture:
    """The plan of a mixture, and the documents in it.

    ``T`` is the size of all documents whose source is given; a source gives
    ``target_share`` of it, or all it has ``max_repeats`` times if that is less.
    Sources are compared lower-case without outer white space; sources without a
    target count in ``T`` but give nothing; targets that are null give nothing.
    ``block`` is the number of tokens of a slot, and with it the deviation that is
    accepted; the schedule has ``T / block`` slots and is made on the driver. Without it
    the deviation is the same share of ``T`` at every size, 1 in ``SLOTS``.
    """

    def __init__(self, documents: DataFrame, targets: DataFrame, block: int | None = None):
        source = F.lower(strip(F.col("source")))
        self.documents = documents.select("doc_id", source.alias("source"), token_count(F.col("text")).alias("tokens"))
        wanted = targets.select(source.alias("source"), "target_share", "max_repeats").where("source <> ''").toPandas()
        wanted = wanted.groupby("source").max().reset_index()
        self.given = cut(self.documents.where("source <> ''"))
        totals = self.given.groupBy("source").agg(F.sum("tokens").alias("n"))
        # One row of the total, and one per source of the (fixed) table of targets.
        total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        held = totals.where(F.col("source").isin(list(wanted["source"]))).toPandas().set_index("source")["n"].to_dict()
        self.total = int(total)
        self.block = block or max(MIN_BLOCK, math.ceil(self.total / SLOTS))
        rows = []
        for r in wanted.itertuples():
            own = int(held.get(r.source, 0))
            share = 0.0 if pd.isna(r.target_share) else float(r.target_share)
            repeats = 0 if pd.isna(r.max_repeats) else int(r.max_repeats)
            rows.append((r.source, share, repeats, own, share * self.total, repeats * own))
        self.plan = pd.DataFrame(rows, columns=["source", "target_share", "max_repeats", "own_tokens", "target_tokens", "supply_tokens"])
        self.plan["quota_tokens"] = self.plan[["target_tokens", "supply_tokens"]].min(axis=1)
        limits = {r.source: math.ceil(r.quota_tokens / self.block) for r in self.plan.itertuples()}
        self.order = schedule(dict(zip(self.plan["source"], self.plan["target_share"])), limits)

    def report(self) -> DataFrame:
        """(source, target_share, actual_share, own_tokens, target_tokens, mixed_tokens, n_blocks, block_tokens, short).

        ``mixed_tokens`` are those that the schedule has placed; a source is short
        if they are less than its target, as it has been used ``max_repeats`` times then.
        """
        blocks = pd.Series([s for s, _ in self.order], dtype=object).value_counts()
        plan = self.plan.assign(n_blocks=self.plan["source"].map(blocks).fillna(0).astype("int64"))
        spark = self.documents.sparkSession
        schema = "source string, target_share double, own_tokens long, target_tokens double, n_blocks long"
        rows = list(plan[["source", "target_share", "own_tokens", "target_tokens", "n_blocks"]].itertuples(index=False, name=None))
        mixed = self.rows().groupBy("source").agg(F.sum("tokens").alias("mixed_tokens"))
        out = spark.createDataFrame(rows, schema).join(mixed, "source", "left").fillna(0, ["mixed_tokens"])
        # One row per target, so the window over all of them is small.
        whole = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(1)))
        return out.withColumns({
            "block_tokens": F.lit(self.block).cast("long"),
            "short": F.col("mixed_tokens") < F.col("target_tokens"),
            "actual_share": F.coalesce(F.col("mixed_tokens") / F.nullif(whole, F.lit(0)), F.lit(0.0)),
        })

    def rows(self) -> DataFrame:
        """(slot, source, repeat, doc_id, tokens): the mixture in its order.

        A source is read in a fixed pseudo-random order, again for every repeat;
        a document lies in the block that its first token falls into. Totals run
        within (source, bucket) and get the bucket's offset, so a source that
        holds a third of all documents is spread over many tasks.
        """
        spark = self.documents.sparkSession
        quota = spark.createDataFrame(
            [(r.source, float(r.quota_tokens), int(r.own_tokens), int(r.max_repeats)) for r in self.plan.itertuples()],
            "source string, quota double, own long, repeats int",
        )
        docs = (
            self.given.join(F.broadcast(quota), "source").where("tokens > 0 and quota > 0")
            .withColumn("place", F.xxhash64("doc_id", F.lit(17)))
            .withColumn("bucket", F.pmod(F.col("place"), F.lit(ORDER_BUCKETS)))
        )
        sums = docs.groupBy("source", "bucket").agg(F.sum("tokens").alias("n"))
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sums.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
        within = Window.partitionBy("source", "bucket").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
        placed = (
            docs.withColumn("local", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
            .join(F.broadcast(offsets), ["source", "bucket"])
            .withColumn("start", F.col("local") + F.col("offset"))
        )
        last = F.least(F.col("repeats"), F.ceil((F.col("quota") - F.col("start")) / F.col("own")).cast("int"))
        repeated = placed.where("start < quota").withColumn("repeat", F.explode(F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0)))))
        at = F.floor((F.col("start") + F.col("repeat") * F.col("own")) / F.lit(self.block)).cast("long")
        blocks = spark.createDataFrame(
            [(s, j, i) for i, (s, j) in enumerate(self.order)] or [("", -1, 0)], "source string, block long, slot int"
        )
        # One row per slot, so the schedule may be sent to every task.
        return (
            repeated.withColumn("block", at).join(F.broadcast(blocks), ["source", "block"])
            .select("slot", "source", "repeat", "doc_id", "tokens")
        )


def short_sources(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """(source) of the targets that the mixture falls short of, repeats and all."""
    return Mixture(documents, targets).report().where("short").select("source")
