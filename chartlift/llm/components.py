"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.operators.joins import attach
from chartlift.runtime import settle

EDGES_PER_TASK = 100_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is tied to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = attach(both.where("v > u"), least, ["u"])
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and the vertex, are tied to the smallest of them (edges point down)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = attach(edges, least, ["u"]).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links(u, v)`` that is not the smallest of its component.

    A hub with many links is a hot key of joins of two shuffled sides only, which adaptive execution splits; minima
    combine before the shuffle. Only a count and a checksum of the links come to the driver; by the count, each task
    gets about EDGES_PER_TASK links, so that few links do not make many small files in every round.
    """
    edges = settle(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = (edges.count(), None)
    while True:
        tasks = 1 + state[0] // EDGES_PER_TASK
        turned = _large_star(edges.coalesce(tasks)).coalesce(tasks)
        edges = settle(_small_star(turned).coalesce(tasks))
        check = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(check) == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        state = tuple(check)
