"""Interfaces to models, each with a deterministic offline form; the models themselves are the user's.

Nothing here calls a service. A provider is a plain function over a batch; it is
used only where it is given, and the offline form takes over where it fails.
What the offline forms give is never the output of a model.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.functions.vectors import hash_embedding

#: Names of the offline providers.
HASHING = "hashing"


@dataclass(frozen=True)
class Embedder:
    """Vectors of texts: ``encode`` maps a batch of texts to as many vectors of ``dims`` numbers."""

    provider: str
    model: str
    dims: int
    encode: Callable[[Sequence[str]], Sequence[Sequence[float]]]
    batch: int = 32

    def vectors(self, text: Column) -> Column:
        """(vector, provider): unit vectors, with the provider they really come from; null text counts as empty.

        A batch that ``encode`` fails on, or gives vectors of another size for, gets hashing vectors.
        """
        encode, dims, size, name = self.encode, self.dims, self.batch, self.provider

        @F.pandas_udf("vector array<double>, provider string")
        def embed(texts: pd.Series) -> pd.DataFrame:
            rows = []
            values = texts.fillna("").tolist()
            for lo in range(0, len(values), size):
                part, used = values[lo : lo + size], name
                try:
                    found = [unit(v, dims) for v in encode(part)]
                    if len(found) != len(part):
                        raise ValueError("as many vectors as texts are needed")
                except Exception:  # a model is optional
                    found, used = [hash_embedding(t, dims) for t in part], HASHING
                rows += [(v, used) for v in found]
            return pd.DataFrame(rows, columns=["vector", "provider"])

        return embed(text)


def unit(vector: Sequence[float], dims: int) -> list[float]:
    """The vector at length one, checked; a zero vector stays."""
    values = [float(x) for x in vector]
    if len(values) != dims or not all(abs(x) < float("inf") for x in values):
        raise ValueError(f"a vector of {dims} finite numbers is needed")
    length = sum(x * x for x in values) ** 0.5
    return [x / length for x in values] if length else values


def hashing_embedder(dims: int = 384) -> Embedder:
    return Embedder(HASHING, f"hash-{dims}", dims, _Hashing(dims))


@dataclass(frozen=True)
class _Hashing:
    dims: int

    def __call__(self, texts: Sequence[str]) -> list[list[float]]:
        return [hash_embedding(t, self.dims) for t in texts]


def choose_embedder(name: str, dims: int, known: dict[str, Embedder] | None = None, key: str | None = None) -> Embedder:
    """The named embedder if it is known and, where it needs a ``key`` (hosted), one is given; else the hashing one."""
    found = (known or {}).get(name)
    if found is None or (name.startswith("hosted") and not key):
        return hashing_embedder(dims)
    return found


def cache_key(text: Column, provider: Column | str, model: str, dims: int) -> Column:
    given = F.lit(provider) if isinstance(provider, str) else provider
    return F.concat(given, F.lit(f":{model}:{dims}:"), F.sha2(F.coalesce(text, F.lit("")), 256))


def embed_texts(texts: DataFrame, text: str, embedder: Embedder, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(``texts`` with ``embedding``, new rows of the cache (cache_key, provider, model, dimensions, vector)).

    Each different text is embedded once, and only if the cache lacks it. A vector
    is cached under the provider that has really made it. Write both results, or cut
    them, before using them twice.
    """
    keyed = texts.withColumn("_key", cache_key(F.col(text), embedder.provider, embedder.model, embedder.dims))
    wanted = keyed.groupBy("_key").agg(F.first(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    if cache is not None:
        wanted = wanted.join(cache.select(F.col("cache_key").alias("_key")), "_key", "left_anti")
    made = wanted.select("_key", "_text", embedder.vectors(F.col("_text")).alias("m"))
    fresh = made.select("_key", F.col("m.vector").alias("embedding"))
    known = fresh if cache is None else fresh.unionByName(cache.groupBy(F.col("cache_key").alias("_key")).agg(F.max("vector").alias("embedding")))
    put = made.select(
        cache_key(F.col("_text"), F.col("m.provider"), embedder.model, embedder.dims).alias("cache_key"), F.col("m.provider").alias("provider"),
        F.lit(embedder.model).alias("model"), F.lit(embedder.dims).alias("dimensions"), F.col("m.vector").alias("vector"),
    )
    return keyed.join(known, "_key", "left").drop("_key"), put


def topic_answers(documents: DataFrame, key: str, prompt: Column, model: Callable[[str], str], repair: Callable[[str], str] | None = None) -> DataFrame:
    """(key, raw): a model's answer to each prompt; an answer without JSON is sent to ``repair`` once; null where the model fails."""
    @F.pandas_udf("string")
    def asked(prompts: pd.Series) -> pd.Series:
        def one(p):
            try:
                raw = model(p)
                return repair(raw) if repair is not None and "{" not in raw and "[" not in raw else raw
            except Exception:  # the rules take over
                return None
        return prompts.map(one)

    return documents.select(key, asked(prompt).alias("raw"))


def topic_prompt(title: Column, content: Column, most: int = 12) -> Column:
    """What a model is asked: topics as JSON, from the beginning of the text."""
    return F.concat(
        F.lit(f'List at most {most} legal topics of the document as JSON: {{"topics": [{{"name": "...", "confidence": 0.0, "evidence": "..."}}]}}.\nTitle: '),
        F.coalesce(title, F.lit("")), F.lit("\nText:\n"), F.substring(F.coalesce(content, F.lit("")), 1, 12_000),
    )
