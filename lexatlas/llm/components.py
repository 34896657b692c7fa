"""Connected components of an edge table, distributed: alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexatlas.llm.common import staged
from lexatlas.llm.uneven import HOT_ROWS, hot_keys, join_dealt


def _linked(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").distinct()


def _near(pairs: DataFrame, least: DataFrame, hot_rows: int) -> DataFrame:
    """b, m: the other end of each pair, and the least of its node a. A node with a large part of all pairs is dealt to several tasks."""
    return join_dealt(pairs, least, {"a": "v"}, hot_keys(pairs, ["a"], hot_rows), by=["b"]).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _large(edges: DataFrame, hot_rows: int) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("m"))
    return _linked(_near(both.where("b > a"), least, hot_rows))


def _small(edges: DataFrame, hot_rows: int) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
    return _linked(_near(down, least, hot_rows).unionByName(least.select(F.col("v").alias("a"), F.col("m").alias("b"))))


def components(edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """edges (a long, b long) -> (node, component): the smallest node that each node of an edge reaches.

    Each half of a round is written to the shared folder, so that a lost executor costs no earlier one. Rounds end when the edges stay.
    Nodes with more than hot_rows edges, and more than one part in 10,000 of all, are dealt to several tasks.
    """

    def stamp(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())

    now = staged(_linked(edges.select("a", "b")), "edges")
    was = None
    while (mark := stamp(now)) != was and mark[0]:
        now, was = staged(_small(staged(_large(now, hot_rows), "star"), hot_rows), "star"), mark
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
