"""Connected components and signature stars as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetcraft.llm.common import erase, written


def star_edges(postings: DataFrame, key: str, node: str) -> DataFrame:
    """``(a, b)``, b < a: every node with the smallest node of each key it
    shares.  The nodes of one key are connected by these edges, with a row a
    node, never a row a pair.  Smallest and largest come from an aggregate
    with map-side combine, so a key that a third of the rows hold arrives as a
    row a task; the join back to the postings may be split at hot keys."""
    ends = (
        postings.groupBy(key)
        .agg(F.min(node).alias("b"), F.max(node).alias("z"))
        .where("b < z")
        .select(key, "b")
    )
    return (
        postings.join(ends, key)
        .where(F.col(node) > F.col("b"))
        .select(F.col(node).alias("a"), "b")
        .distinct()
    )


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of an edge: the smallest node reachable.

    Alternates the two star contractions: each node hands its larger
    neighbours, then its smaller ones, to the smallest node it knows.  Rounds
    are written to the shared folder; only two counters reach the driver."""
    now = written(_oriented(edges), "cc")
    seen = _state(now)
    for _ in range(max_rounds):
        before, now = now, written(_small_star(_large_star(now)), "cc")
        erase(before)
        state = _state(now)
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).union(moved).distinct()
