"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.storage import Scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Joins every node's neighbours to the least of them and itself: the larger neighbours, or the smaller ones and
    itself. Nodes with many neighbours meet their least by join, so no list of neighbours is ever built."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    joined = both.join(least, "a")
    moved = joined.where("b > a" if large else "b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        moved = moved.union(least)
    return moved.where("a <> b").distinct()


def components(links: DataFrame, scratch: Scratch, name: str, *, rounds: int = 40) -> DataFrame:
    """The least node each linked node can reach: node, component. ``links`` has a and b, in any order and repeated.

    Nodes that are the least of their component have no row. Each round is stored, so lineage stays short. It ends when a round changes nothing, after at most about the square
    of the logarithm of the number of nodes; should ``rounds`` not suffice, an error says so.
    """
    now = scratch.keep(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    digest = (0, None)
    for round_ in range(1, rounds + 1):
        now = scratch.keep(_star(_star(now, large=True), large=False), f"{name}-{round_}")
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38)"))).first())
        if seen == digest:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        digest = seen
    raise RuntimeError(f"components of {name} did not settle in {rounds} rounds")


def merged(found: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The components ``found`` so far, joined by further links. Only links between components are gone through."""
    known = found.select(F.col("node"), F.col("component"))
    ends = links.select("a", "b")
    for end in ("a", "b"):
        ends = ends.join(known.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component")), end, "left")
    ends = ends.select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b"))
    joined = components(ends, scratch, name)
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("moved"))
    again = known.join(moved, "component", "left").select("node", F.coalesce("moved", "component").alias("component"))
    return scratch.keep(again.union(joined), f"{name}-found")
