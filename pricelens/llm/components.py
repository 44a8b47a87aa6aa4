"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` with longs -> ``(node, root)``: root is the smallest node reachable.

    Every round points the larger neighbours of a node at its smallest neighbour (large star), then the
    smaller ones (small star). The number of links never grows, no group is gathered in one task (minima are
    partial aggregates and joins have one row per node on one side), and each round is written to the shared
    folder. It ends when a round changes nothing; nodes without a link do not appear.
    """
    edges = materialize(_distinct(links.select("a", "b").where(F.col("a") != F.col("b"))), "cc")
    before = _signature(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges)), "cc")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _distinct(e: DataFrame) -> DataFrame:
    """Each link once, the larger node first."""
    return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    out = both.join(low.hint("merge"), "a").where(F.col("b") > F.col("a"))
    return _distinct(out.select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    out = e.join(low.hint("merge"), "a")
    moved = out.select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
    return _distinct(moved.union(low.select("a", F.col("m").alias("b"))))


def _signature(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]
