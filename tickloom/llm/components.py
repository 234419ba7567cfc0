"""Connected components of a link table, by star joins until nothing changes.

Each round every node links its larger neighbours to the smallest node it knows (large star), then
its smaller ones (small star); the table shrinks to one star per component in a logarithmic number
of rounds. Minima are taken before the shuffle, a hub's links may be split over tasks, and each
round is written to the shared folder. Nothing but two sums reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.llm.batches import keep


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a, b) with a > b, rewired to the least node that the node in the middle knows."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).toDF("u", "v") if large else links.toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = both.join(least, both["u"] == least["w"])
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("w"), F.col("m")))
    return moved.where("a > b").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and root (its component's smallest node) of every node in `links` (a, b).

    Nodes of one orderable type; loops and repeats are harmless; no links give no rows.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links = keep(links, "links")
    before = _mark(links)
    while before[0]:
        links = keep(_star(_star(links, large=True), large=False), "links")
        now = _mark(links)
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))
