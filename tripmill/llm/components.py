"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import fitted, saved


def _signature(edges: DataFrame) -> tuple:
    found = edges.agg(
        F.count("*").alias("n"),
        F.expr("bit_xor(xxhash64(hi, lo))").alias("x"),
        F.expr("bit_xor(xxhash64(lo, hi, 1))").alias("y"),
    ).first()
    return tuple(found)


def _large_stars(edges: DataFrame, n: int) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    smallest = fitted(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("least")), n)
    moved = fitted(edges.join(smallest, F.col("lo") == F.col("node"), "left"), n)
    return fitted(moved.select("hi", F.coalesce("least", "lo").alias("lo")).distinct(), n)


def _small_stars(edges: DataFrame, n: int) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    smallest = fitted(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("least")), n)
    moved = fitted(edges.join(smallest, F.col("hi") == F.col("node")).filter("lo <> least"), n)
    links = moved.select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    whole = links.union(smallest.select(F.col("node").alias("hi"), F.col("least").alias("lo")))
    return fitted(fitted(whole, n).distinct(), n)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) of every node that has a link; the smallest id names the component.

    Links are undirected; repeated ones, links of a node to itself and links with a
    null end change nothing. No links give an empty table. The driver sees only the
    number of links and two checksums a round. Group-bys combine before the shuffle,
    and the joins are plain, so that a centre with very many links can be split. Rounds
    run in as many tasks as the links left need.
    """
    edges = saved(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    before = _signature(edges)
    while n := before[0]:
        edges = saved(_small_stars(_large_stars(fitted(edges, n), n), n))
        after = _signature(edges)
        if after == before:
            break
        before = after
    edges = fitted(edges, before[0])
    ends = edges.select(F.col("hi").alias("id"), F.col("lo").alias("component_id"))
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("component_id")).distinct()
    return ends.union(roots)
