"""Groups of directly or indirectly linked names (connected components).

Seed-tree pruning: every vertex points its closed neighbourhood at the
neighbourhood's minimum; vertices that are nobody's minimum leave the graph and
become children in a propagation forest; the rest go on. The graph shrinks by a
constant share per round. When it is empty its seeds (roots) carry the group
names down the forest, one join per round in reverse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.functions.text import normalize_topic_name
from qirtas.session import cut


def _minima(edges: DataFrame) -> DataFrame:
    """(u, m): every edge end with the least vertex of its closed neighbourhood.

    ``edges`` holds both directions, so one grouping suffices; it combines
    before the shuffle, whatever share of the edges one vertex has.
    """
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(vertex, root) with ``root`` the least vertex of the component, by code point.

    A row whose ends are equal makes that vertex known; rows with a null end are
    ignored; repeated rows and both directions count once. An empty table gives
    no rows. Hot vertices are only ever grouped with partial aggregation or
    joined against one row per vertex, which adaptive execution can split.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null")
    # The source is read once; rows of one vertex alone (u = v) are kept beside the edges.
    ends = F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    every = cut(pairs.select(F.explode(ends).alias("e")).select("e.*").distinct())
    active = every.where("u <> v")

    forest: list[DataFrame] = []
    while not active.isEmpty():
        # Every vertex v of u's closed neighbourhood learns of u's minimum.
        minima = _minima(active)
        told = (
            active.join(minima, "u").select(F.col("v").alias("u"), "m")
            .unionByName(minima)
            .distinct()
        )
        # u keeps the least it was told; the others it was told are linked to that one.
        best = told.groupBy("u").agg(F.min("m").alias("best"), F.max(F.col("m") == F.col("u")).alias("stays"))
        best = cut(best)
        links = told.join(best.select("u", "best"), "u").where("m <> best").select(F.col("best").alias("u"), F.col("m").alias("v"))
        active = cut(links.select(F.explode(ends).alias("e")).select("e.*").distinct())
        # A vertex that nobody has as minimum is the child of its own best; the others are their own parents on this level.
        forest.append(best.select(F.col("u").alias("vertex"), F.when(F.col("stays"), F.col("u")).otherwise(F.col("best")).alias("parent")))

    # Down the forest: a level holds only the vertices that were active in it, so all levels together are
    # a small multiple of the vertices. A parent that is not on the next level is a seed, the root of its component.
    known = None
    for level in reversed(forest):
        if known is None:
            known = level.withColumnRenamed("parent", "root")
        else:
            upper = known.select(F.col("vertex").alias("parent"), "root")
            known = cut(level.join(upper, "parent", "left").select("vertex", F.coalesce("root", "parent").alias("root")))
    alone = every.where("u = v").select(F.col("u").alias("vertex"), F.col("u").alias("root"))
    return alone if known is None else known.unionByName(alone.join(known.select("vertex"), "vertex", "left_anti"))


def topic_groups(candidates: DataFrame) -> DataFrame:
    """(normalized_name, group_name) of every topic of a row whose two names are given.

    Names are compared in normal form; names that are empty in it are not given.
    """
    names = candidates.select(
        normalize_topic_name(F.col("keep_normalized_name")).alias("a"),
        normalize_topic_name(F.col("drop_normalized_name")).alias("b"),
    ).where("a <> '' and b <> ''")
    return connected_components(names, "a", "b").select(
        F.col("vertex").alias("normalized_name"), F.col("root").alias("group_name")
    )
