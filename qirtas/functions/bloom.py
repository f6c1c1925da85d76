"""A Bloom filter built by Spark, of a size that is fixed before it is built."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

#: No filter is larger than this many bits (16 MB); beyond that the share of
#: false positives rises, and with it only the work of the exact check.
MAX_BITS = 1 << 27
BITS_PER_KEY = 12
HASHES = 6
_CHUNK = 1 << 15


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    h = h.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    rounds = np.arange(HASHES, dtype=np.uint64)[:, None]
    return (h[None, :] + rounds * step[None, :]) % np.uint64(bits)


def key_hash(*key: Column) -> Column:
    return F.xxhash64(*key)


class BloomFilter:
    """``might_contain(hash)`` is false only for hashes that were never added."""

    def __init__(self, df: DataFrame, key: Column, keys: int):
        """Build over ``key`` (a 64-bit hash) of ``df``, which has ``keys`` rows.

        Positions are deduplicated per batch and turned into words on the
        executors, so what reaches the driver is the filter itself, at most
        ``MAX_BITS``, whatever the number of keys.
        """
        self.bits = int(min(MAX_BITS, max(_CHUNK, 1 << int(max(1, keys) * BITS_PER_KEY - 1).bit_length())))
        bits = self.bits

        def fill(batches):
            mine = np.zeros(bits >> 3, np.uint8)
            for pdf in batches:
                p = _positions(pdf["h"].to_numpy(np.int64).view(np.uint64), bits).ravel()
                np.bitwise_or.at(mine, (p >> np.uint64(3)).astype(np.int64), (1 << (p & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
            words = mine.view(np.int64)
            at = np.flatnonzero(words)
            if len(at):
                yield pd.DataFrame({"i": at, "w": words[at]})

        rows = (
            df.select(key.alias("h")).where("h is not null")
            .mapInPandas(fill, "i long, w long")
            .groupBy("i").agg(F.bit_or("w").alias("w"))
            .toPandas()
        )
        words = np.zeros(bits >> 6, np.int64)
        words[rows["i"].to_numpy(np.int64)] = rows["w"].to_numpy(np.int64)
        self.broadcast = df.sparkSession.sparkContext.broadcast(words.view(np.uint8))

    def might_contain(self, key: Column) -> Column:
        bits, held = self.bits, self.broadcast

        @F.pandas_udf(BooleanType())
        def test(h: pd.Series) -> pd.Series:
            p = _positions(h.to_numpy(np.int64).view(np.uint64), bits)
            hit = (held.value[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1
            return pd.Series(hit.all(axis=0))

        return test(key)
