"""Connected components of a graph of links, as joins and minima.

Links are pointed from the larger to the smaller node and rewired until every node points at the
smallest of its component: in turns, each node's larger neighbours are linked to its smallest
neighbour, then its smaller ones are; when all links lead straight to such a node, that is the end. A node with very many links is never gathered: only minima
are taken per node, and the joins can be split. Each round is stored, so no lineage grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.store import broadcast_if_few, saved


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node that links lead to), for each node with a link but the
    smallest of its component.

    ``links`` has columns ``a`` and ``b`` of one orderable type; direction and repeats don't
    matter, links of a node with itself or with null are nothing.
    """
    edges = saved(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while not _stars(edges):
        # larger neighbours of a node go to its smallest one
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        turned = (
            edges.join(least.withColumnRenamed("a", "b"), "b").where(F.col("a") != F.col("m")).select("a", F.col("m").alias("b"))
        )
        # smaller neighbours of a node, and itself, go to its smallest one
        lower = turned.groupBy("a").agg(F.min("b").alias("m"))
        edges = saved(
            turned.join(lower, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
            .where(F.col("a") != F.col("b"))
            .distinct(),
            "links",
        )
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node that is linked to a smaller one has one such link, and that one none."""
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("node"), F.lit(1).alias("links"), F.lit(0).alias("meant")),
            F.struct(F.col("b").alias("node"), F.lit(0).alias("links"), F.lit(1).alias("meant")),
        )
    )
    nodes = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.links").alias("links"), F.max("e.meant").alias("meant"))
    return not nodes.where((F.col("links") > 1) | ((F.col("links") > 0) & (F.col("meant") > 0))).count()


def extended(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups``, as ``components`` gives them, after more links: only those between components count, so a
    component is one node here however large it is. Stored."""
    ends = links.select("a", "b")
    for end in ("a", "b"):
        known = groups.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        ends = ends.join(known, end, "left")
    between = ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    moved = saved(components(between), "moved")
    to = broadcast_if_few(moved.select(F.col("node").alias("component"), F.col("component").alias("to")))
    kept = groups.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return saved(kept.unionByName(moved), "groups")
