"""Connected components of an edge table, in DataFrame operations only.

Alternating large-star and small-star rounds: every round hangs neighbours below
the smallest node known to be in their component, until only stars are left. The
number of rounds grows with the logarithm of the longest chain, not with its
length. Every round is written to the shared folder, so a lost executor costs one
round at most. Nothing is collected but one row of (count, checksum) per round.

A hub may touch a third of all edges: the minimum per node is a partial
aggregate before its shuffle, it is written, and the join that carries it back to
the edges reads two plain shuffles, which adaptive execution splits when skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, larger node first; loops and nulls dropped."""
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    return edges.where(F.col("a") != F.col("b")).select(hi.alias("a"), lo.alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "cc-min")
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "cc-min")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return int(row[0]), int(row[1] or 0)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of ``edges``; root = smallest node reachable.

    ``edges`` may hold loops, repeats and both directions; edges with a null end
    are ignored. Nodes may be of any ordered type. An empty table gives an empty
    table; a node whose only edges are loops is its own root.
    """
    given = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    given = stored(given, "cc-edges")
    work = stored(_oriented(given), "cc-round")
    before = _state(work)
    while before[0]:
        work = stored(_oriented(_large_star(work)), "cc-round")
        work = stored(_oriented(_small_star(work)), "cc-round")
        now = _state(work)
        if now == before:
            break
        before = now
    tails = work.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = work.select(F.col("b").alias("node"), F.col("b").alias("root"))
    loops = given.where(F.col("a") == F.col("b")).select(F.col("a").alias("node"), F.col("a").alias("root"))
    return tails.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("root").alias("root"))
