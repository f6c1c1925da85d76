"""The k most similar vectors for every vector, by an inverted multi-index.

The two halves of the unit vectors are quantised separately; a cell is a pair of
centroids. Every vector walks the cells in the order of summed distance with a
heap until it has met enough vectors, and the vectors of those cells are
reranked by their cosine. Cells with near first centroids form a block; a vector
is sent once to each block it has a cell in, together with the list of cells, so
what is shuffled is a small multiple of the collection, and no task holds more
than ``BLOCK`` indexed vectors.
"""

from __future__ import annotations

import heapq
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qirtas.functions.bloom import BloomFilter
from qirtas.session import cut

#: Rows of each collection that the centroids are fitted on, at most.
FIT_ROWS = 20_000
#: Mean number of vectors in a cell, and the most centroids of one half (the cells' counts are broadcast, 64 MB then).
CELL_ROWS, MAX_CENTROIDS = 8, 4096
#: A vector's walk ends when the cells it met hold so many vectors; beyond ``GROWS_FROM`` vectors the number grows
#: with the fourth root of their number.
CANDIDATES, GROWS_FROM = 800, 1e6
#: Indexed vectors in one task, at most.
BLOCK = 32_000
#: Rows of one key up to which repeats are dropped in the task they meet in.
REPEATS = 8
_SCALE = 32767.0


class Codebook(NamedTuple):
    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray
    group_of: np.ndarray
    block_of: np.ndarray
    enough: int
    chunks: np.ndarray
    task_base: np.ndarray


def unit_vectors(values: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows count, their unit vectors): ``dims`` finite numbers, not all zero."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    whole = pc.fill_null(pc.equal(pc.list_value_length(values), dims), False)
    rows = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
    x = values.filter(whole).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    x = x[good]
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return rows[good], x / np.linalg.norm(x, axis=1, keepdims=True)


def _binary(x: np.ndarray) -> pa.Array:
    """Each row of an array as one binary value."""
    x = np.ascontiguousarray(x)
    width = x.shape[1] * x.itemsize
    offsets = np.arange(len(x) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(x)])


def _decode(values: pa.Array, dims: int) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    flat = b"".join(values.to_pylist())
    return np.frombuffer(flat, "<i2").reshape(-1, dims).astype(np.float32) / np.float32(_SCALE)


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant of each row."""
    return (centroids**2).sum(axis=1) - 2 * x @ centroids.T


def fit_centroids(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's algorithm from evenly drawn rows; empty clusters keep their place."""
    if not len(x):
        return np.zeros((1, x.shape[1]), np.float32)
    centroids = x[np.random.default_rng(5).permutation(len(x))[:k]].astype(np.float32)
    for _ in range(rounds):
        of = _nearest(x, centroids).argmin(axis=1)
        order = np.argsort(of, kind="stable")
        used, starts = np.unique(of[order], return_index=True)
        sums = np.add.reduceat(x[order], starts, axis=0)
        centroids[used] = sums / np.diff(np.append(starts, len(x)))[:, None]
    return centroids


def balanced_blocks(centroids: np.ndarray, weight: np.ndarray, blocks: int) -> np.ndarray:
    """Groups of near centroids of about equal weight: the heaviest is halved across its widest axis."""
    groups = [np.arange(len(centroids))]
    while len(groups) < blocks:
        groups.sort(key=lambda g: (weight[g].sum() if len(g) > 1 else -1))
        g = groups.pop()
        if len(g) < 2:
            groups.append(g)
            break
        c = centroids[g] - np.average(centroids[g], axis=0, weights=weight[g] + 1e-9)
        axis = np.linalg.svd(c * np.sqrt(weight[g] + 1e-9)[:, None], full_matrices=False)[2][0]
        g = g[np.argsort(c @ axis, kind="stable")]
        half = np.searchsorted(np.cumsum(weight[g]), weight[g].sum() / 2)
        half = min(max(int(half), 1), len(g) - 1)
        groups += [g[:half], g[half:]]
    of = np.zeros(len(centroids), np.int32)
    for i, g in enumerate(groups):
        of[g] = i
    return of


def walk(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Non-empty cells in the order of summed distance until they hold ``enough`` vectors."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    o1, o2 = o1.tolist(), o2.tolist()
    k1, k2 = len(o1), len(o2)
    heap, met, cells = [(s1[0] + s2[0], 0, 0)], 0, []
    while heap and met < enough:
        _, i, j = heapq.heappop(heap)
        cell = o1[i] * k2 + o2[j]
        n = counts[cell]
        if n:
            met += n
            cells.append(cell)
        if j + 1 < k2:
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
        if j == 0 and i + 1 < k1:
            heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))
    return cells


class MultiIndex:
    """Inverted multi-index over (collection, key, embedding).

    Only embeddings of ``dims`` finite numbers, not all zero, count; rows with a
    null key or collection are left out. Repeated rows of a key agree; should
    they not, each of their vectors is searched for the key. Collections and keys are
    followed through the search by a 64-bit hash. ``candidates`` is the trade of
    accuracy for time; ``exact`` searches without the index.
    """

    def __init__(self, vectors: DataFrame, dims: int = 64, candidates: int = CANDIDATES):
        self.candidates = candidates
        self.spark, self.dims, self.half = vectors.sparkSession, dims, dims // 2
        self.source = vectors.select("collection", F.xxhash64("collection", "key").alias("id"), "key", "embedding").where(
            "key is not null and collection is not null and embedding is not null"
        )
        self._fit()

    def _quantised(self, source: DataFrame | None = None) -> DataFrame:
        """(collection, id, v): unit vectors as 16-bit fixed-point numbers."""
        dims = self.dims
        source = self.source if source is None else source

        def quantise(batches):
            for b in batches:
                rows, x = unit_vectors(b.column("embedding"), dims)
                at = pa.array(rows)
                v = _binary(np.rint(x * _SCALE).astype("<i2"))
                yield pa.RecordBatch.from_arrays([b.column("collection").take(at), b.column("id").take(at), v], ["collection", "id", "v"])

        return source.select("collection", "id", "embedding").mapInArrow(quantise, "collection string, id long, v binary")

    def _fit(self) -> None:
        dims, half = self.dims, self.half
        # Bounded: FIT_ROWS of each collection, the ones with the least hashes.
        least = Window.partitionBy("collection").orderBy(F.xxhash64("id"))
        sizes = {r[0]: r[1] for r in self.source.groupBy("collection").count().collect()}
        share = F.lit(0.0)
        for name, n in sizes.items():
            share = F.when(F.col("collection") == name, F.lit(min(1.0, 1.2 * FIT_ROWS / n))).otherwise(share)
        mixed = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20)) < share * (1 << 20)
        quantised = self._quantised()
        sample = (
            quantised.where(mixed).withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= FIT_ROWS)
            .select("collection", "v").toArrow()
        )
        names = np.array(sample.column("collection").to_pylist(), dtype=object)
        points = _decode(sample.column("v"), dims) if len(names) else np.zeros((0, dims), np.float32)
        books = {}
        for name, n in sizes.items():
            mine = points[names == name]
            k = max(1, min(MAX_CENTROIDS, round(math.sqrt(n / CELL_ROWS))))
            books[name] = (fit_centroids(mine[:, :half], k), fit_centroids(mine[:, half:], k))

        def cells(batches):
            for b in batches:
                x, name = _decode(b.column("v"), dims), np.array(b.column("collection").to_pylist(), dtype=object)
                out = np.zeros(len(x), np.int32)
                for c in set(name.tolist()):
                    m, (one, two) = name == c, books[c]
                    out[m] = _nearest(x[m, :half], one).argmin(axis=1) * len(two) + _nearest(x[m, half:], two).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([b.column("collection"), pa.array(out), b.column("copy")], ["collection", "cell", "copy"])

        placed = quantised.withColumn("copy", F.xxhash64("v")).mapInArrow(cells, "collection string, cell int, copy long")
        self.copies = cut(placed.groupBy("collection", "cell", "copy").count())
        # At most MAX_CENTROIDS ** 2 rows of each collection; copies beyond REPEATS are not indexed and don't count.
        held = F.sum(F.least("count", F.lit(REPEATS))).alias("count")
        counted = self.copies.groupBy("collection", "cell").agg(held).toPandas()
        self.books, task = {}, 0
        for name, (one, two) in books.items():
            mine = counted[counted["collection"] == name]
            counts = np.zeros(len(one) * len(two), np.int32)
            counts[mine["cell"]] = mine["count"]
            square = counts.reshape(len(one), len(two))
            # Near first centroids are a group; a group with too many vectors is divided by near second ones.
            groups = max(1, math.ceil(counts.sum() / BLOCK))
            group_of = balanced_blocks(one, square.sum(axis=1).astype(float), groups)
            block_of, blocks = np.zeros((group_of.max() + 1, len(two)), np.int32), 0
            for g in range(len(block_of)):
                weight = square[group_of == g].sum(axis=0).astype(float)
                parts = math.ceil(weight.sum() / BLOCK) if weight.sum() > 1.5 * BLOCK else 1
                block_of[g] = blocks + (balanced_blocks(two, weight, parts) if parts > 1 else 0)
                blocks = int(block_of[g].max()) + 1
            held = np.zeros(blocks, np.int64)
            for c, g in enumerate(group_of):
                np.add.at(held, block_of[g], square[c])
            # Only one cell that is too full alone is left to be cut into chunks.
            chunks = np.maximum(1, np.ceil(held / (1.5 * BLOCK))).astype(np.int64)
            base = task + np.concatenate([[0], np.cumsum(chunks**2)[:-1]])
            task = int(base[-1] + chunks[-1] ** 2)
            enough = round(self.candidates * max(1.0, counts.sum() / GROWS_FROM) ** 0.25)
            self.books[name] = Codebook(one, two, counts, group_of, block_of, enough, chunks, base)
        self.tasks = task

    def search(self, k: int = 5) -> DataFrame:
        """(id, other, cosine): the k nearest of every vector but itself (see ``_found``)."""
        found, copies = self._found(k)
        return found if copies is None else found.unionByName(copies)

    def _found(self, k: int) -> tuple[DataFrame, DataFrame | None]:
        """The nearest of the indexed vectors, and those of the copies that are not indexed.

        Of more than k + 1 copies of one vector those with the k + 1 least ids
        are indexed and stand for all; the rest get the first k of these, which
        no other vector can be nearer to. Ties go to the least id.
        """
        one = self._without_heavy_repeats()
        many = cut(self.copies.where(F.col("count") > k + 1).select("collection", "copy"))
        if many.isEmpty():
            return self._rerank(one, k), None
        one = cut(one)
        grouped = one.withColumn("copy", F.xxhash64("v"))
        alone = grouped.join(many, ["collection", "copy"], "left_anti").drop("copy")
        group = Window.partitionBy("collection", "v").orderBy("id")
        # Repeated rows of a key are one copy.
        copied = grouped.join(many, ["collection", "copy"], "left_semi").drop("copy").distinct()
        first = cut(copied.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= k + 1))
        rest = copied.join(first.select("collection", "id"), ["collection", "id"], "left_anti")
        heads = first.where(F.col("rank") <= k).groupBy("collection", "v").agg(F.collect_list("id").alias("others"))
        near = rest.join(heads, ["collection", "v"]).select("id", F.explode("others").alias("other"), F.lit(1.0).cast("float").alias("cosine"))
        return self._rerank(alone.unionByName(first.drop("rank")), k), near

    def _without_heavy_repeats(self) -> DataFrame:
        """All vectors; keys with more than ``REPEATS`` rows once.

        Equal rows of a key are sent to the same tasks, which drop them. Only for
        keys with so many rows that this would burden a task is there a shuffle,
        of the rows that pass a Bloom filter of those keys.
        """
        heavy = cut(self.source.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > REPEATS).select("id"))
        n = heavy.count()
        if not n:
            return self._quantised()
        often = BloomFilter(heavy, F.col("id"), n).might_contain(F.col("id"))
        marked = self.source.withColumn("often", often)
        rare = self._quantised(marked.where(~F.col("often")))
        return rare.unionByName(self._quantised(marked.where("often")).distinct())

    def _rerank(self, vectors: DataFrame, k: int) -> DataFrame:
        dims, half = self.dims, self.half
        shared = self.spark.sparkContext.broadcast(self.books)

        def route(batches):
            books = shared.value
            for b in batches:
                x, name = _decode(b.column("v"), dims), b.column("collection").to_pylist()
                ids = b.column("id").to_numpy(zero_copy_only=False)
                at, task, home, role, probes = [], [], [], [], []
                names = np.array(name, dtype=object)
                for c in sorted(set(name)):
                    book, m = books[c], np.flatnonzero(names == c)
                    d1, d2 = _nearest(x[m, :half], book.first), _nearest(x[m, half:], book.second)
                    width = len(book.second)
                    own = d1.argmin(axis=1) * width + d2.argmin(axis=1)
                    for i, row in enumerate(m):
                        by_block: dict[int, list[int]] = {}
                        for cell in walk(d1[i], d2[i], book.counts, book.enough):
                            by_block.setdefault(int(book.block_of[book.group_of[cell // width], cell % width]), []).append(cell)
                        mine = int(book.block_of[book.group_of[own[i] // width], own[i] % width])
                        by_block.setdefault(mine, [])
                        for block, cells in by_block.items():
                            n, base = int(book.chunks[block]), int(book.task_base[block])
                            chunk = int(ids[row]) % n
                            coded = np.array(cells, np.int32).tobytes()
                            for other in range(n):
                                # As a candidate it meets every query salt, as a query every candidate chunk.
                                as_candidate = {base + chunk * n + other} if block == mine else set()
                                as_query = {base + other * n + chunk} if cells else set()
                                for t in as_candidate | as_query:
                                    at.append(row)
                                    task.append(t)
                                    home.append(own[i])
                                    role.append((t in as_candidate) + 2 * (t in as_query))
                                    probes.append(coded if t in as_query else b"")
                take = pa.array(np.array(at, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(task, pa.int32()), pa.array(home, pa.int32()), pa.array(role, pa.int8()),
                     b.column("id").take(take), b.column("v").take(take), pa.array(probes, pa.binary())],
                    ["task", "home", "role", "id", "v", "probes"],
                )

        def rerank(group: pa.Table) -> pa.Table:
            home = group.column("home").to_numpy()
            order = np.lexsort((group.column("id").to_numpy(), home))
            again = (np.diff(home[order], prepend=-1) == 0) & (np.diff(group.column("id").to_numpy()[order], prepend=0) == 0)
            order = order[~again]
            home, role = home[order], group.column("role").to_numpy()[order]
            ids, x = group.column("id").to_numpy()[order], _decode(group.column("v"), dims)[order]
            probes = [np.frombuffer(group.column("probes")[int(i)].as_py(), np.int32) for i in order]
            indexed = np.flatnonzero(role & 1)
            y, yid = x[indexed], ids[indexed]
            cells, starts = np.unique(home[indexed], return_index=True)
            ends = np.append(starts[1:], len(indexed))
            out_id, out_n, out_other, out_cos = [], [], [], []
            queries = np.flatnonzero(role & 2)
            split = np.flatnonzero(np.diff(home[queries], prepend=-1))
            for a, b in zip(split, np.append(split[1:], len(queries))):
                for lo in range(a, b, 512):
                    q = queries[lo : min(b, lo + 512)]
                    wanted = np.unique(np.concatenate([probes[i] for i in q]))
                    hit = np.searchsorted(cells, wanted)
                    hit = hit[hit < len(cells)]
                    hit = hit[np.isin(cells[hit], wanted)]
                    if not len(hit):
                        continue
                    cand = np.concatenate([np.arange(starts[h], ends[h]) for h in hit])
                    scores = x[q] @ y[cand].T
                    scores[ids[q][:, None] == yid[cand][None, :]] = -9
                    n = min(k, len(cand))
                    best = np.argpartition(-scores, n - 1, axis=1)[:, :n] if n < len(cand) else np.broadcast_to(np.arange(n), (len(q), n))
                    got = np.take_along_axis(scores, best, axis=1)
                    row, col = np.nonzero(got > -9)
                    out_id.append(ids[q])
                    out_n.append(np.bincount(row, minlength=len(q)))
                    out_other.append(yid[cand[best[row, col]]])
                    out_cos.append(got[row, col])
            cat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
            ends = pa.array(np.concatenate([[0], np.cumsum(cat(out_n, np.int64))]).astype(np.int32))
            return pa.table({
                "id": cat(out_id, np.int64),
                "d": pa.ListArray.from_arrays(ends, pa.array(-cat(out_cos, np.float32))),
                "other": pa.ListArray.from_arrays(ends, pa.array(cat(out_other, np.int64))),
            })

        routed = vectors.mapInArrow(route, "task int, home int, role byte, id long, v binary, probes binary")
        # Every task has a partition of its own.
        found = routed.repartitionById(max(1, self.tasks), F.col("task")).groupBy("task").applyInArrow(rerank, "id long, d array<float>, other array<long>")
        # A vector has at most one row of k of each block it was sent to.
        best = found.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list(F.arrays_zip("d", "other")))).alias("near"))
        return best.select("id", F.explode(F.slice("near", 1, k)).alias("n")).select("id", F.col("n.other").alias("other"), (-F.col("n.d")).alias("cosine"))

    def exact(self, queries: DataFrame, k: int = 5) -> DataFrame:
        """(id, other, cosine): the k nearest of all vectors, without the index, for the (collection, id) of ``queries``.

        Blocks of queries meet blocks of vectors, each pair of blocks in a task of
        its own, so nothing grows but the number of tasks.
        """
        dims = self.dims
        vectors = cut(self._quantised().dropDuplicates(["collection", "id"]))
        asked = vectors.join(queries.select("collection", "id").distinct(), ["collection", "id"], "left_semi")
        n, m = max(1, math.ceil(vectors.count() / BLOCK)), max(1, math.ceil(asked.count() / BLOCK))
        chunk, salt = F.pmod("id", F.lit(n)).cast("int"), F.pmod(F.xxhash64("id", F.lit(7)), F.lit(m)).cast("int")
        rows = vectors.select("collection", "id", "v", chunk.alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("salt"), F.lit(False).alias("asks"))
        asks = asked.select("collection", "id", "v", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("chunk"), salt.alias("salt"), F.lit(True).alias("asks"))

        def meet(group: pa.Table) -> pa.Table:
            x, ids = _decode(group.column("v"), dims), group.column("id").to_numpy()
            q = np.flatnonzero(group.column("asks").to_numpy(zero_copy_only=False))
            r = np.setdiff1d(np.arange(len(x)), q)
            out = []
            for lo in range(0, len(q) if len(r) else 0, 512):
                part = q[lo : lo + 512]
                scores = np.where(ids[part][:, None] == ids[r][None, :], -9, x[part] @ x[r].T)
                best = np.argpartition(-scores, min(k, len(r)) - 1, axis=1)[:, :k]
                got = np.take_along_axis(scores, best, axis=1)
                row, col = np.nonzero(got > -9)
                out.append((ids[part][row], ids[r][best[row, col]], got[row, col].astype(np.float32)))
            cat = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)]
            return pa.table(dict(zip(("id", "other", "cosine"), cat)))

        met = rows.unionByName(asks).groupBy("collection", "chunk", "salt").applyInArrow(meet, "id long, other long, cosine float")
        best = Window.partitionBy("id").orderBy(F.desc("cosine"), "other")
        return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")

    def pairs(self, k: int = 5) -> DataFrame:
        """(collection, key_a, key_b): pairs of which one is among the k nearest of the other."""
        def ends(found: DataFrame) -> DataFrame:
            return found.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))

        keys = self.source.select("collection", "id", "key").distinct()

        def named(pairs: DataFrame) -> DataFrame:
            one = pairs.join(keys.select(F.col("id").alias("a"), F.col("key").alias("x")), "a")
            two = one.join(keys.select("collection", F.col("id").alias("b"), F.col("key").alias("y")), "b")
            return two.select("collection", F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"))

        found, copies = self._found(k)
        # One shuffle by the first end serves both the removal of doubles and the join.
        out = named(ends(found).repartition("a").dropDuplicates(["a", "b"]))
        # Copies meet only the heads of their group, each once: a hot head is a join that can be split.
        return out if copies is None else out.unionByName(named(ends(copies)))


def embeddings(chunks: DataFrame, topics: DataFrame) -> DataFrame:
    """(collection, key, embedding) of both tables."""
    return chunks.select(F.lit("chunk").alias("collection"), F.col("id").alias("key"), "embedding").unionByName(
        topics.select(F.lit("topic").alias("collection"), F.col("normalized_name").alias("key"), "embedding")
    )
