"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.sources.staging import settle


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every end of a link (a, b); a component's name is its smallest id.

    Each round links the larger neighbours of every vertex to its smallest one, then the
    smaller ones, which joins the smallest ids of both ends of long chains quickly: the number
    of rounds grows with the logarithm of the input. The minimum of a vertex combines before
    the shuffle, and a hub's links meet it in a join that Spark can split. A round is kept in
    the shared checkpoint folder; only a count and a checksum reach the driver. Links of a
    vertex to itself and links with a null end say nothing and are left out.
    """
    ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), "a", "b")
    edges = settle(ends.where("a is not null and b is not null and a <> b").select("u", "v").distinct())
    state = _state(edges)
    while True:
        edges = settle(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots)


def _state(edges: DataFrame) -> tuple:
    checksum = F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))
    return tuple(edges.agg(F.count("*"), checksum).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
