"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwarden.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of `edges` (a, b: long) with the smallest node it is connected to.

    Alternates large-star and small-star steps.  A step only takes minima by node (combined before
    the shuffle) and joins them back, so a node with very many edges is never held in one task.  Each
    round is a table in the shared folder.  Loops, repeated edges and either direction are allowed; edges
    with NULL are ignored.  No edges give no rows.
    """
    current = common.stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = _print(current)
    while seen[0]:
        both = current.union(current.select("b", "a"))
        large = _with_least(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small = _with_least(large)
        small = (
            small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        current = common.stored(small, "edges")
        now = _print(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges with m: the least of a and all its neighbours."""
    least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return edges.join(least, "a")


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first())
