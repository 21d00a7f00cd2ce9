"""Connected components of a link table, by stars that shrink in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.staging import stage


def _nearest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of u with the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_nearest(both), "u").filter("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours with the smallest of them."""
    joined = edges.join(_nearest(edges), "u")
    other = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return joined.select(other.alias("u"), F.col("m").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(id, component_id)`` for every id in the links ``(a, b)``; the smallest id names a component.

    A round links ids with smaller ones only and is written before the next; the links stop
    changing when every id hangs on the smallest of its component, after about log(n) rounds.
    Self-links and nulls are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stage(edges.filter("u > v").distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    hung = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return hung.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())
