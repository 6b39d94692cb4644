"""Connected components of a link table by alternating star operations, in logarithmically many rounds.

A round's state is a table of links (u, v) with u > v. Minima of neighbours are aggregated on the map
side first, and joined by `attach`, so a node that links to a third of all others fills no task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import attach, discard, materialize, scratch


def _with_minimum(links: DataFrame, tag: str) -> DataFrame:
    """Links (u, v) with the smallest v of each u as m."""
    keyed = links.withColumn("key", F.col("u").cast("string"))
    facts = materialize(keyed.groupBy("key").agg(F.min("v").alias("m"), F.count("*").alias("n")), tag)
    return attach(keyed, facts, "key", "m", "n", F.xxhash64("u", "v")).select("u", "v", "m")


def large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _with_minimum(both, "large-star")
    return near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    near = _with_minimum(links, "small-star")
    others = near.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.select("u", F.col("m").alias("v")).union(others).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that is linked to a smaller one; root is the smallest node reachable.

    ``links`` has bigint columns a and b, in any order, repeats and self-links allowed.
    """
    state = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, seen = materialize(state, "links"), None
    while True:
        # Equal rows in equal number: a sum of hashes that wraps round tells states apart.
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, before = mark, state
        with scratch(links.sparkSession) as keep:
            state = materialize(small_star(materialize(large_star(state), "links")), "links")
            keep.append(state)
        discard(before)
