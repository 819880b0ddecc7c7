"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark.session import stage_table


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).collect()[0]
    return tuple(row)


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step on (a, b) with a < b; every node's neighbours meet its least one."""
    if small:  # of the neighbours below a node
        near = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("u", "m"))
    # a node with very many neighbours is split by adaptive execution here
    joined = near.join(least, "u")
    if small:
        moved = joined.select(F.col("m").alias("a"), F.col("v").alias("b")).union(
            least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
    else:
        moved = joined.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.where("a < b").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` (the least id reachable) of every id that has a link.

    Links are undirected, may repeat and may join an id with itself; null ends are left
    out. Each round is written to the shared folder; rounds grow with the logarithm of
    the longest chain, and no component is ever in one task.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = stage_table(
        ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = _fingerprint(edges)
    while before[0]:
        edges = stage_table(_star(_star(edges, False), True), "edges")
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    # every edge now leads from the least id of a component to a member
    members = edges.select(F.col("b").alias("id"), F.col("a").alias("component"))
    roots = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return members.union(roots)
