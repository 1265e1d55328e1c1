"""Connected components of a table of links, by alternating large and small stars.

Each round hangs the larger neighbours of every node, then its smaller ones, under its smallest
neighbour, until every node hangs under the smallest of its component. Rounds are few (about the
logarithm of the longest path). Smallest neighbours come from an aggregate that combines before the
shuffle, and go back by a join whose hot keys adaptive execution splits, so that a node with a third
of all links is no task's burden. Nothing is collected but two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskmill.llm.store import stored


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame, one: str = "one", other: str = "other") -> DataFrame:
    """node, component_id: for each node of a link to another node, the smallest id it can reach."""
    edges = stored(links.filter(F.col(one) != F.col(other)).select(
        F.greatest(one, other).alias("u"), F.least(one, other).alias("v")
    ).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component_id"))
