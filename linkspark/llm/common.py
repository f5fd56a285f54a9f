"""Helpers shared by the training-data operators: the shared folder, written cuts of lineage, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import delete, fresh_dir, shared_dir, stash  # noqa: F401

#: What separates words: U+0020 and U+0009 to U+000D.
SPACE = "\\x20\\x09-\\x0D"


def words(text) -> F.Column:
    """Array of the words of a text; null counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def n_words(text) -> F.Column:
    """Number of words, without building them: one letter for each run of non-space."""
    return F.size(words(text)).cast("long")


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links(a, b)`` (long, undirected): one row ``(node, component)`` a node, the smallest node reached.

    Alternates large-star and small-star steps. Each step takes minima with
    map-side partial aggregation, so a hub with very many links is summed before it
    is shuffled, and each step's links are written to the shared folder.
    """

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        return moved.union(least.select("a", F.col("m").alias("b"))).distinct()

    edges = stash(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    mark, busy = None, not edges.isEmpty()
    while busy:
        new = stash(small_star(large_star(edges)), "links")
        state = new.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003), F.sum(F.xxhash64("b", "a") % 998244353)).first()
        delete(edges)
        edges, busy, mark = new, state != mark, state
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
