"""Connected components of a table of links, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_lens.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """Rows ``id``, ``component`` for every id in ``links`` (columns a, b): the smallest id that it reaches.

    Large-star and small-star passes alternate until no link changes. A pass regroups links with partial aggregation (the smallest
    neighbour), never a list of neighbours, so a crowded id stays a stream of rows. Each pass is saved in the shared folder.
    """
    edges = store(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _fingerprint(edges)
    while True:
        edges = store(_small_star(_large_star(edges)))
        before, mark = mark, _fingerprint(edges)
        if mark == before:  # once every link goes from an id to its component, a pass changes nothing
            break
    inner = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return inner.union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of links and a checksum of them that does not depend on their order."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of an id is linked to the id's smallest neighbour (or itself)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of an id, and the id itself, is linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.union(own).where("a <> b").distinct()
