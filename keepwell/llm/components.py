"""Connected components over an edge table, without gathering links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.session import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", label: str = "components") -> DataFrame:
    """(id, component) for every id that an edge names; component is the smallest id reachable.

    Alternates two rewrites until nothing changes (large star: link a node's larger neighbours to its smallest one;
    small star: link a node and its smaller neighbours to the smallest one). Both are a minimum per node, which is
    combined before the shuffle, and a join back that AQE splits where a node is hot. The number of rounds grows with
    the logarithm of the longest chain. Every round is a written table, so a lost executor costs one round at most.
    Edges with a null end and loops are ignored; repeated edges count once; no edges give no rows.
    """
    links = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), label)
    state = _state(links)
    while state[0]:
        links = stored(_small_star(_large_star(links)), label)
        last, state = state, _state(links)
        if state == last:
            break
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Every link points from larger to smaller, so a node's neighbours here are its smaller ones."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    hung = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
