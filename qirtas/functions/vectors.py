"""Vector arithmetic on arrays of doubles."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_WORD = re.compile(r"[\w؀-ۿ]+")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0.0 for null, empty, unequal lengths and zero vectors."""
    usable = (F.size(a) > 0) & (F.size(a) == F.size(b))
    length = norm(a) * norm(b)
    return F.coalesce(F.when(usable & (length > 0), dot(a, b) / length), F.lit(0.0))


def normalize_vector(a: Column) -> Column:
    """To length one; a zero vector stays."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(a)


def is_valid(a: Column, dims: int) -> Column:
    """``dims`` finite numbers, not all zero."""
    good = F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(a) == dims) & good & F.exists(a, lambda x: x != 0), F.lit(False))


def _slot(word: str) -> tuple[int, float]:
    """The number and sign that a word's digest gives it."""
    digest = hashlib.sha256(word.encode("utf-8", "replace")).digest()
    return int.from_bytes(digest[:4], "big"), 1.0 if digest[4] % 2 == 0 else -1.0


def _hash_slots(text: str, dims: int, memo: dict[str, tuple[int, float]]) -> dict[int, float]:
    """Slot -> value of the non-zero slots, at length one."""
    sums: dict[int, float] = {}
    for w in _WORD.findall(text.lower()) or [text or "empty"]:
        found = memo.get(w)
        if found is None:
            if len(memo) > 500_000:
                memo.clear()
            found = memo[w] = _slot(w)
        slot = found[0] % dims
        sums[slot] = sums.get(slot, 0.0) + found[1]
    length = math.sqrt(sum(x * x for x in sums.values()))
    return {slot: x / length for slot, x in sums.items() if x}


def hash_embedding(text: str, dims: int) -> list[float]:
    """The hashing embedding of one text; a text without words counts as one word, itself, or ``empty`` if it is empty."""
    out = [0.0] * dims
    for slot, x in _hash_slots(text, dims, {}).items():
        out[slot] = x
    return out


def hash_embeddings(df: DataFrame, key: str, text: str, dims: int) -> DataFrame:
    """(key, slot, value): the non-zero slots of the hashing embedding of every text; null counts as empty.

    A function of one row, so nothing is shuffled: texts go through in Arrow batches, and a word is hashed once per task.
    """
    kind = df.schema[key].dataType.simpleString()

    def embed(batches):
        memo: dict[str, tuple[int, float]] = {}
        for b in batches:
            found = [_hash_slots(t or "", dims, memo) for t in b.column("text").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            slots = pa.array([s for f in found for s in f], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("key").take(at), slots, pa.array([x for f in found for x in f.values()], pa.float64())], [key, "slot", "value"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(embed, f"`{key}` {kind}, slot int, value double")
