"""Filling fixed-capacity containers: minimum bin slack on the length histogram.

Items of one length are interchangeable, so the packing is planned on the
histogram of lengths (at most ``capacity`` rows, whatever the number of items):
a subset-sum dynamic programme over bitsets finds the fullest combination of
available lengths, which is taken as often as the counts allow and removed.
Items then find their place by their rank among the items of their length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.functions.text import token_count
from qirtas.session import cut

#: Items of one length are ranked in this many independent buckets.
RANK_BUCKETS = 256


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of available lengths with the greatest sum within ``capacity``.

    Lengths are offered from the longest on (long items are the hard ones to
    place), each in binary portions up to its count; bit s of the set says that
    sum s can be reached. The search ends as soon as the full capacity can be.
    """
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, portion = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(portion, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            portion *= 2
        if reach >> capacity & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(combination, how often) until no item is left; all lengths within 1..capacity."""
    counts = {k: n for k, n in histogram.items() if n > 0}
    out = []
    while counts:
        used = fullest(counts, capacity)
        times = min(counts[k] // n for k, n in used.items())
        out.append((used, times))
        for k, n in used.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return out


def split_oversized(items: DataFrame, key: str, size: Column, capacity: int) -> DataFrame:
    """(key, piece, length): items within the capacity whole, others in full pieces and a rest."""
    return (
        items.select(F.col(key), size.cast("long").alias("size"))
        .where("size > 0")
        .select(key, "size", F.posexplode(F.sequence(F.lit(1), F.ceil(F.col("size") / capacity).cast("int"))).alias("piece", "_n"))
        .select(key, "size", "piece", F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity).cast("int").alias("length"))
    )


def pack(pieces: DataFrame, key: str, capacity: int) -> DataFrame:
    """``pieces`` (key, size, piece, length) with ``container``.

    What the driver holds is the histogram and the plan over it, both bounded by
    the capacity. Ranks are taken per (length, bucket) with the buckets' offsets
    added, so a length that a third of all items share is ranked by many tasks.
    """
    # The row's own number is hashed too, so a key that is null or repeated a million times is spread; the cut keeps the choice.
    bucket = F.pmod(F.xxhash64(key, "piece", F.monotonically_increasing_id()), F.lit(RANK_BUCKETS)).cast("int")
    pieces = cut(pieces.withColumn("bucket", bucket))
    sizes = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n")).toPandas().sort_values(["length", "bucket"])
    histogram = sizes.groupby("length")["n"].sum().to_dict()
    starts = sizes.groupby("length")["n"].cumsum() - sizes["n"]
    offset = np.zeros((capacity + 1, RANK_BUCKETS), np.int64)
    offset[sizes["length"], sizes["bucket"]] = starts

    first, rows = 0, {}
    taken = dict.fromkeys(histogram, 0)
    for used, times in plan(histogram, capacity):
        for length, n in used.items():
            rows.setdefault(length, []).append((taken[length], n, first))
            taken[length] += n * times
        first += times
    places = {length: np.array(v, np.int64).T for length, v in rows.items()}
    shared = pieces.sparkSession.sparkContext.broadcast((offset, places))

    def place(batches):
        offset, places = shared.value
        last, carried = -1, 0
        for pdf in batches:
            length, bucket = pdf["length"].to_numpy(np.int64), pdf["bucket"].to_numpy(np.int64)
            ids = length * RANK_BUCKETS + bucket
            starts = np.flatnonzero(np.diff(ids, prepend=-1))
            runs = np.diff(np.append(starts, len(ids)))
            local = np.arange(len(ids)) - np.repeat(starts, runs)
            if ids[0] == last:
                local[: runs[0]] += carried
            last, carried = ids[-1], local[-1] + 1
            rank = local + offset[length, bucket]
            out = np.empty(len(pdf), np.int64)
            for value in np.unique(length):
                at, n, base = places[int(value)]
                mine = np.flatnonzero(length == value)
                j = np.searchsorted(at, rank[mine], side="right") - 1
                out[mine] = base[j] + (rank[mine] - at[j]) // n[j]
            yield pdf.assign(container=out)

    # One (length, bucket) is within one partition, so ranks count on through the
    # batches; the order within it is fixed, so a task run again gives the same.
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", container long"
    ordered = pieces.repartition("length", "bucket").sortWithinPartitions("length", "bucket", key, "piece")
    return ordered.mapInPandas(place, schema).drop("bucket")


def pack_documents(documents: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, size, piece, length, container) of every document that has tokens.

    Blank and null texts have no tokens and take no place; a null id is packed
    like any other; repeated ids are packed as often as they occur.
    """
    sized = documents.select("doc_id", token_count(F.col("text")).alias("tokens"))
    return pack(split_oversized(sized, "doc_id", F.col("tokens"), capacity), "doc_id", capacity)
