"""All pairs of vectors with at least a given cosine: an exact join that meets in few, large blocks.

Every vector belongs to the cell of its nearest pivot, and cells that lie side by
side make up a block. By the triangle inequality for angles a vector can only
reach into another cell if the other pivot is nearly as near as its own, or within
the cell's radius and the threshold's angle; it goes only to blocks with such a
cell, so once to a block however many of its cells it may reach. No pair is lost,
however the pivots lie: they only decide how much is compared. Where they rule
nothing out, as with vectors in all directions, each vector goes to each block.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.session import cut

#: Pivots, at most: a bounded sample of the vectors, with its size growing as the root of their number.
MAX_PIVOTS = 2048
#: Vectors of 64 numbers of one side that meet in one task, at most on average; fuller cells are divided.
CELL_ROWS = 40_000
#: Blocks are at least so many, for tasks on all cores, unless they would be smaller than this.
LEAST_BLOCKS, LEAST_ROWS = 5, 4_096
#: Numbers that are held at once on the way: cosines to pivots, vectors in a batch that is handed on.
STRETCH = 1 << 20
#: Vectors of the two sides that are multiplied at a time, pairs in a batch that is handed on.
TILE, PAIRS = (512, 2_048), 16_384
#: Rounding in angles, on the safe side.
_SLACK = 1e-6


def _matrix(values: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _angle(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1.0, 1.0))


def _stretches(b: pa.RecordBatch, pivots: np.ndarray, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, cosines to all pivots) of a few rows at a time."""
    step = max(1, STRETCH // len(pivots))
    for lo in range(0, b.num_rows, step):
        yield lo, _matrix(b.column("v").slice(lo, step), dims) @ pivots.T


def _runs(pivots: np.ndarray, held: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cells in an order in which near ones follow each other, where each run of them begins, and the blocks that a run makes up.

    A run is of one block, but for one full cell that is divided.
    """
    n = int(held.sum())
    room = max(1, min(CELL_ROWS * 64 // max(64, dims), max(LEAST_ROWS, -(-n // LEAST_BLOCKS))))
    order = np.argsort((pivots @ pivots[: max(1, -(-n // room))].T).argmax(axis=1), kind="stable")
    starts, blocks, filled = [], [], 0
    for at, rows in enumerate(held[order].tolist()):
        if not starts or filled + rows > room:
            starts.append(at), blocks.append(max(1, -(-rows // room)))
            filled = 0
        filled += rows
    return order, np.array(starts), np.array(blocks)


def threshold_pairs(vectors: DataFrame, key: str, vector: str, threshold: float, dims: int) -> DataFrame:
    """(a, b, similarity): all pairs a < b of different keys with a cosine of ``threshold`` or more.

    ``vectors`` has one valid vector (``functions.vectors.is_valid``) per key;
    equal vectors should come once (see ``operators.topics.topic_pairs``). The threshold is above 0.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    spark, theta = vectors.sparkSession, math.acos(threshold)
    source = cut(vectors.select(F.col(key).cast("string").alias("k"), F.col(vector).cast("array<double>").alias("v")))
    n = source.count()
    wanted = min(MAX_PIVOTS, max(1, round(2 * math.sqrt(n))))
    sample = source.orderBy(F.xxhash64("k"), "k").limit(wanted).select("v").toArrow()
    if not n:
        return spark.createDataFrame([], "a string, b string, similarity double")
    pivots = _matrix(sample.column("v"), dims)
    shared = spark.sparkContext.broadcast(pivots)

    def cells(batches):
        """The radius and the vectors of each cell; one that is as near to several pivots counts for the radius of each."""
        pivots = shared.value
        radius, held = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
        for b in batches:
            for _, cos in _stretches(b, pivots, dims):
                best = cos.max(axis=1)
                row, cell = np.nonzero(cos >= best[:, None] - 1e-9)
                np.maximum.at(radius, cell, _angle(best)[row])
                held += np.bincount(cos.argmax(axis=1), minlength=len(pivots))
        at = np.flatnonzero(radius >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(radius[at]), pa.array(held[at])], ["cell", "angle", "n"])

    # One row per pivot.
    found = source.select("v").mapInArrow(cells, "cell int, angle double, n long").groupBy("cell").agg(F.max("angle").alias("r"), F.sum("n").alias("n")).toPandas()
    at = found["cell"].to_numpy()
    held, nearest = np.zeros(len(pivots), np.int64), np.full(len(pivots), 2.0)
    held[at] = found["n"]
    # The cosine from which a vector may reach into a cell; nothing reaches into an empty one.
    nearest[at] = np.cos(np.minimum(found["r"].to_numpy() + theta + _SLACK, math.pi))
    layout = spark.sparkContext.broadcast((nearest, *_runs(pivots, held, dims)))

    def route(batches):
        """A vector goes to each pair of its block with a block that it may reach into, its own among them."""
        nearest, order, starts, blocks = layout.value
        first = np.cumsum(blocks) - blocks
        run = np.empty(len(order), np.int64)
        run[order] = np.repeat(np.arange(len(starts)), np.diff([*starts, len(order)]))
        for b in batches:
            part = np.array([zlib.crc32(k.encode()) for k in b.column("k").to_pylist()], np.int64)
            for lo, cos in _stretches(b, shared.value, dims):
                home, own = cos.argmax(axis=1), _angle(cos.max(axis=1))
                reach = cos >= np.maximum(np.cos(np.minimum(own + 2 * theta + _SLACK, math.pi))[:, None], nearest[None, :])
                reach[np.arange(len(home)), home] = True
                row, other = np.nonzero(np.repeat(np.logical_or.reduceat(reach[:, order], starts, axis=1), blocks, axis=1))
                mine = (first[run[home]] + part[lo : lo + len(home)] % blocks[run[home]])[row]
                for at in range(0, len(row), step := max(1, STRETCH // dims)):
                    to, own_block, rows = other[at : at + step], mine[at : at + step], pa.array(row[at : at + step] + lo)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(to, own_block), pa.int32()), pa.array(np.maximum(to, own_block), pa.int32()), pa.array(to < own_block), b.column("k").take(rows), b.column("v").take(rows)],
                        ["l", "r", "right", "k", "v"],
                    )

    # Single numbers only find what may be a pair; doubles decide.
    low = np.float32(threshold - 2e-7 * dims - 1e-6)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("l")[0].as_py() == b.column("r")[0].as_py(), b.column("right").to_numpy(zero_copy_only=False), b.column("k").to_pylist(), _matrix(b.column("v"), dims)) for b in batches if b.num_rows]
        within, right = parts[0][0], np.concatenate([p[1] for p in parts])
        keys, x = np.array([k for p in parts for k in p[2]], object), np.concatenate([p[3] for p in parts])
        del parts
        one, two = (np.arange(len(x)),) * 2 if within else (np.flatnonzero(~right), np.flatnonzero(right))
        left_side, right_side = x[one].astype(np.float32), x[two].astype(np.float32)
        waiting, pairs = [], 0

        def batch() -> pa.RecordBatch:
            i, j, c = (np.concatenate(w) for w in zip(*waiting))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(keys[i], keys[j]), pa.string()), pa.array(np.maximum(keys[i], keys[j]), pa.string()), pa.array(c)], ["a", "b", "similarity"])

        for lo in range(0, len(one), TILE[0]):
            for at in range(lo if within else 0, len(two), TILE[1]):
                cos = left_side[lo : lo + TILE[0]] @ right_side[at : at + TILE[1]].T
                i, j = np.divmod(np.flatnonzero(cos >= low), cos.shape[1])
                i, j = one[lo + i], two[at + j]
                if within:
                    i, j = i[i < j], j[i < j]
                for start in range(0, len(i), PAIRS):
                    a, b = i[start : start + PAIRS], j[start : start + PAIRS]
                    c = np.einsum("ij,ij->i", x[a], x[b])
                    good = c >= threshold
                    waiting.append((a[good], b[good], c[good]))
                    pairs += int(good.sum())
                    if pairs >= PAIRS:
                        yield batch()
                        waiting, pairs = [], 0
        if pairs:
            yield batch()

    routed = source.mapInArrow(route, "l int, r int, right boolean, k string, v array<double>")
    return routed.groupBy("l", "r").applyInArrow(meet, "a string, b string, similarity double")
